r"""Repair of conversation structure by a rank-convergence parallel Viterbi search.

*Rows.* A null in a text or key counts as one space. The rows of a conversation stand in order of turn (nulls first),
then role, then md5 of the text; rows equal in all of these are one row with a number of copies. The first fault of
a row counts: blank, duplicate (role and text seen earlier), truncated.

*Search.* The repaired roles' initials must read ``(s?(ua)+)?``, which four states recognise (nothing yet, behind
s, behind u, behind a). Keep costs 0, Rerole 1, Delete 2, Insert 5, an undeleted truncated row 5 more; blank rows and
duplicates must go. The cost of the best way on from each state is a vector, which a row maps to
another, backwards. All rows are numbered in one order and cut into chunks of ``CHUNK``, so a conversation
of any length is spread over tasks and none holds more than a chunk:

1. Every chunk starts at once, from a *speculative* vector where its last conversation goes on behind it.
2. *Fix-up passes*: the chunks that lie within one conversation are rerun from the vector of the
   chunk behind, in step with the vector they used before, until both differ only by a constant: what lies
   before stays as it is. Passes repeat until no chunk's vector changes. Chunks that still change after
   ``FIXUPS`` passes (only rows of foreign roles carry a difference that far) give their 4 x 4 matrix instead,
   and these are composed by doubling.
3. *Tracing* goes forward through the stitched vectors and takes, of the edits that keep to the least cost, the
   one whose initial comes first (D, I, K, R): that gives the ASCII-least audit. The state at a chunk's start comes
   from the chunk before: maps from state to state, composed by doubling where a chunk doesn't fix it alone.

Vectors are small integers modulo a constant, so steps are looked up. Only one small row a chunk passes
between the passes. The repaired turns are put together by one shuffle and a streaming
merge of texts and edits; a SHA-256 over a whole conversation can't be split, so one task streams each conversation,
in constant memory, for that column alone.

Cases: a null conv_id is a conversation; null turns come first and leave gaps as they are; conversations without
rows after damage have zeros, an empty audit and the hash of the empty string; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordered_row_number
from .common import materialize, table

CHUNK = 4096
FIXUPS = 4
DELETE, INSERT, REROLE, CUT_SHORT = 2, 5, 1, 5
FAR = 1 << 20  # more than any difference between two states
SPACES = "\t\n\x0b\x0c\r "
#: States: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a. What an inserted or reroled row leads to, and what a kept one.
NEXT = (2, 2, 3, 2)
KEPT = {"u": (2, 2, None, 2), "a": (None, None, 3, None), "s": (1, None, None, None), "?": (None,) * 4}
INITIALS = "uas?"
ROLES = {2: "user", 3: "assistant"}
Vector = tuple[int, int, int, int]


def closed(v: tuple[int, ...]) -> Vector:
    """A vector with inserts allowed first."""
    for _ in range(3):
        v = tuple(min(x, INSERT + v[NEXT[s]]) for s, x in enumerate(v))
    return v


def level(v: tuple[int, ...]) -> Vector:
    """A vector less its minimum: equal if two differ only by a constant."""
    low = min(v)
    return tuple(x - low for x in v)


END = closed((0, FAR, FAR, 0))
SPECULATIVE = (0, 0, 0, 0)


def _choices(code: int, behind: Vector, s: int) -> tuple[int, int | None, int]:
    """Costs on from state s of deleting, keeping and reroling a row, if ``behind`` are the costs behind it."""
    fault, initial = divmod(code, 4)
    if fault == 2:
        return DELETE + behind[s], None, FAR * 4
    extra, kept = CUT_SHORT * fault, KEPT[INITIALS[initial]][s]
    return DELETE + behind[s], None if kept is None else extra + behind[kept], REROLE + extra + behind[NEXT[s]]


@lru_cache(maxsize=1 << 16)
def before(code: int, behind: Vector) -> Vector:
    """The levelled vector before a row. ``code``: 4 * (0 sound, 1 truncated, 2 must go) + place in INITIALS."""
    return level(closed(tuple(min(x for x in _choices(code, behind, s) if x is not None) for s in range(4))))


@lru_cache(maxsize=1 << 18)
def edit(code: int, behind: Vector, s: int) -> tuple[str, str, int]:
    """(initials of the roles inserted before, edit, state behind) of a row reached in state s."""
    at = closed(tuple(min(x for x in _choices(code, behind, t) if x is not None) for t in range(4)))
    inserted = ""
    while True:
        delete, keep, rerole = _choices(code, behind, s)
        if delete == at[s]:
            return inserted, "D", s
        if INSERT + at[NEXT[s]] == at[s]:
            s = NEXT[s]
            inserted += ROLES[s][0]
        elif keep == at[s]:
            return inserted, "K", KEPT[INITIALS[code % 4]][s]
        else:
            return inserted, "R", NEXT[s]


def vectors(codes: list[int], end: Vector) -> list[Vector]:
    """The vector behind each row, and last the one before the first."""
    out = [level(end)]
    for code in reversed(codes):
        out.append(before(code, out[-1]))
    return [*out[-2::-1], out[-1]]


def fix_up(codes: list[int], old_end: Vector, new_end: Vector, old_start: Vector) -> Vector:
    """The vector before the first row from ``new_end``, if it was ``old_start`` from ``old_end``: both run in
    step from the last row until they differ only by a constant."""
    old, new = level(old_end), level(new_end)
    for code in reversed(codes):
        if old == new:
            return old_start
        old, new = before(code, old), before(code, new)
    return new


def matrix(codes: list[int]) -> list[list[int]]:
    """Least costs from each state before the rows to each state behind them."""
    columns = []
    for t in range(4):
        v = closed(tuple(0 if s == t else FAR for s in range(4)))
        for code in reversed(codes):
            v = closed(tuple(min(x for x in _choices(code, v, s) if x is not None) for s in range(4)))
        columns.append(v)
    low = min(map(min, columns))  # costs matter up to a constant
    return [[min(c[s] - low, FAR) for c in columns] for s in range(4)]


def trace(codes: list[int], behind: list[Vector], s: int) -> tuple[list[tuple[str, str]], int]:
    """((inserted before, edit) of every row, state at the end) from state s."""
    out = []
    for code, v in zip(codes, behind):
        inserted, what, s = edit(code, v, s)
        out.append((inserted, what))
    return out, s


def finish(s: int) -> str:
    """Initials of the roles to insert behind the last row."""
    out = ""
    while END[s]:
        s = NEXT[s]
        out += ROLES[s][0]
    return out


# --- rows ---------------------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: the rows left after the contract's damage, equal ones counted."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat_ws(":", *spaced[:2]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced[3], "[.!?]", "")).otherwise(spaced[3])
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), kind.alias("kind"),
                                F.when(kind == 4, "user").otherwise(spaced[2]).alias("role"), text.alias("text"))
    return counted(rows.filter("kind != 0"), "if(kind = 3, 2, 1)")


def counted(rows: DataFrame, copies: str = "1") -> DataFrame:
    """(conv_id, turn, role, text, n) of rows without nulls in role and text."""
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum(F.expr(copies)).cast("long").alias("n"))


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, n) with digest, blank, first (no earlier row has its role and text),
    truncated and initial, without the text. First rows are found by an aggregation and a join, which Spark may
    split, so a text that fills a conversation doesn't meet in one task."""
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    rows = turns.select("conv_id", "turn", "role", "digest", "n", (last == "").alias("blank"),
                        (~last.isin("", ".", "!", "?")).alias("truncated"), F.substring("role", 1, 1).alias("initial"))
    firsts = rows.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("low"))
    return (rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                      & (F.col("digest") == F.col("d")))
            .withColumn("first", F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("low")))
            .drop("c", "r", "d", "unnumbered", "low"))


def figures(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated of the rows that ``faults`` gives."""
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.col("first").cast("int"))).alias("duplicate"),
        F.sum((F.col("truncated") & F.col("first")).cast("long")).alias("truncated"))
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])


def chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """One row for each ``chunk`` rows in order: chunk, rows (array), whether its first and last conversation go on
    before and behind it, and the code of the row before it if so."""
    place = F.when(F.col("initial") == "u", 0).when(F.col("initial") == "a", 1).when(F.col("initial") == "s", 2).otherwise(3)
    fault = F.when(F.col("blank") | ~F.col("first"), 2).when(F.col("truncated"), 1).otherwise(0)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    numbered = ordered_row_number(rows.select("conv_id", "turn", "role", "digest", "n", (4 * fault + place).alias("code")),
                                  order, "rank")
    fields = ("rank", "conv_id", "turn", "role", "digest", "n", "code")
    chunks = materialize(
        numbered.withColumn("chunk", F.expr(f"(rank - 1) div {chunk}")).groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows")), "turn-chunks")
    edges = chunks.select("chunk", F.col("rows")[0]["conv_id"].alias("head"), F.element_at("rows", -1).alias("last")).select(
        "chunk", "head", F.col("last.conv_id").alias("tail"), F.col("last.code").alias("code"))
    edges = materialize(edges, "turn-edges")
    past = edges.select((F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("past"), F.col("code").alias("past_code"))
    ahead = edges.select((F.col("chunk") - 1).alias("chunk"), F.col("head").alias("ahead"), F.lit(True).alias("more"))
    known = (edges.join(past, "chunk", "left").join(ahead, "chunk", "left")
             .select("chunk", (F.col("past_code").isNotNull() & F.col("past").eqNullSafe(F.col("head"))).alias("goes_back"),
                     (F.col("more").isNotNull() & F.col("ahead").eqNullSafe(F.col("tail"))).alias("goes_on"), "past_code"))
    return chunks.join(materialize(known, "turn-links"), "chunk")


def segments(convs: list) -> list[tuple[int, int]]:
    """(first, end) of the runs of equal conversations."""
    starts = [i for i, c in enumerate(convs) if i == 0 or c != convs[i - 1]]
    return list(zip(starts, [*starts[1:], len(convs)]))


# --- passes -------------------------------------------------------------------------------------------------------

VECTOR = "array<int>"


def speculated(chunks: DataFrame) -> DataFrame:
    """Pass 1, of chunks that a conversation goes into: chunk, through (it goes on behind the chunk too), used (the
    vector assumed there), start (the vector before the first row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for chunk, convs, codes, goes_on in zip(*(c.to_pylist() for c in b.columns)):
                first, end = segments(convs)[0]
                through = goes_on and end == len(codes)
                used = SPECULATIVE if through else END
                out.append((chunk, through, level(used), vectors(codes[first:end], used)[-1]))
            yield _batch(out, ["chunk", "through", "used", "start"])

    rows = chunks.filter("goes_back").select("chunk", "rows.conv_id", "rows.code", "goes_on")
    return materialize(rows.mapInArrow(run, f"chunk long, through boolean, used {VECTOR}, start {VECTOR}"), "turn-starts")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"chunk": pa.int64(), "through": pa.bool_(), "used": pa.list_(pa.int32()), "start": pa.list_(pa.int32()),
             "ends": pa.list_(pa.int32()), "costs": pa.list_(pa.list_(pa.int32()))}
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[n]) for n, c in zip(names, columns)], names)


def converged(chunks: DataFrame, starts: DataFrame, fixups: int = FIXUPS) -> DataFrame:
    """Pass 2: ``starts`` with vectors that are right up to a constant."""

    def rerun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(chunk, True, level(new), fix_up(codes, tuple(used), tuple(new), tuple(start)))
                   for chunk, codes, used, start, new in zip(*(c.to_pylist() for c in b.columns))]
            yield _batch(out, ["chunk", "through", "used", "start"])

    for k in range(fixups + 1):
        behind = starts.select((F.col("chunk") - 1).alias("chunk"), F.col("start").alias("new"))
        stale = materialize(starts.filter("through").join(behind, "chunk").filter("new != used"), "turn-stale")
        if stale.isEmpty():
            return starts
        if k == fixups:
            break
        fixed = (chunks.select("chunk", "rows.code").join(stale.select("chunk", "used", "start", "new"), "chunk")
                 .mapInArrow(rerun, f"chunk long, through boolean, used {VECTOR}, start {VECTOR}"))
        starts = materialize(starts.join(stale.select("chunk"), "chunk", "left_anti").unionByName(fixed), "turn-starts")
    return composed(chunks, starts)


def composed(chunks: DataFrame, starts: DataFrame) -> DataFrame:
    """``starts`` by the matrices of the chunks that lie within one conversation, composed by doubling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(c, matrix(codes)) for c, codes in zip(*(c.to_pylist() for c in b.columns))], ["chunk", "costs"])

    through = starts.filter("through").select("chunk")
    links = materialize(chunks.select("chunk", "rows.code").join(through, "chunk")
                        .mapInArrow(run, "chunk long, costs array<array<int>>").withColumn("to", F.col("chunk") + 1),
                        "turn-matrices")
    known = starts.filter("not through").select("chunk", "start")
    least = "transform(sequence(0, 3), i -> {}array_min(transform(sequence(0, 3), k -> costs[i][k] + {}))){}"
    vector = "transform({0}, x -> cast(x - array_min({0}) as int))".format(least.format("", "v[k]", ""))
    product = least.format("transform(sequence(0, 3), j -> ", "onward[k][j]", ")")
    capped = f"transform({product}, r -> transform(r, x -> cast(least(x, {FAR}) as int)))"
    while True:
        ends = known.select(F.col("chunk").alias("to"), F.col("start").alias("v"))
        known = materialize(known.unionByName(links.join(ends, "to").select("chunk", F.expr(vector).alias("start"))), "turn-known")
        links = links.join(known.select("chunk"), "chunk", "left_anti")
        onward = links.select(F.col("chunk").alias("to"), F.col("costs").alias("onward"), F.col("to").alias("beyond"))
        links = materialize(links.join(onward, "to", "left").select(
            "chunk", F.when(F.col("onward").isNull(), F.col("costs")).otherwise(F.expr(capped)).alias("costs"),
            F.coalesce("beyond", "to").alias("to")), "turn-matrices")
        if links.isEmpty():
            return starts.drop("start").join(known, "chunk")


def start_states(chunks: DataFrame) -> DataFrame:
    """(chunk, state) at the first row of the chunks that a conversation goes into. ``chunks`` have ``end``, the
    vector behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for chunk, convs, codes, goes_back, end in zip(*(c.to_pylist() for c in b.columns)):
                first, _ = segments(convs)[-1]
                behind = vectors(codes[first:], tuple(end))
                starts = range(4) if goes_back and first == 0 else [0]
                ends = [trace(codes[first:], behind, s)[1] for s in starts]
                out.append((chunk, ends if len(ends) == 4 else ends * 4))
            yield _batch(out, ["chunk", "ends"])

    rows = chunks.filter("goes_on").select("chunk", "rows.conv_id", "rows.code", "goes_back", "end")
    maps = materialize(rows.mapInArrow(run, f"chunk long, ends {VECTOR}").withColumn("since", F.col("chunk")), "turn-maps")
    while not maps.filter("size(array_distinct(ends)) > 1").isEmpty():
        # a chunk whose map isn't constant lies within one conversation, so the chunk before has a map too
        earlier = maps.select((F.col("chunk") + 1).alias("since"), F.col("ends").alias("first"), F.col("since").alias("from"))
        maps = materialize(maps.join(earlier, "since", "left").select(
            "chunk", F.when(F.col("first").isNull() | (F.size(F.array_distinct("ends")) == 1), F.col("ends"))
            .otherwise(F.transform("first", lambda s: F.element_at("ends", s + 1))).alias("ends"),
            F.coalesce("from", "since").alias("since")), "turn-maps")
    return maps.select((F.col("chunk") + 1).alias("chunk"), F.col("ends")[0].alias("state"))


PIECES = "array<struct<conv_id: bigint, cost: bigint, audit: string, illegal: bigint>>"
EDITS = "array<struct<conv_id: bigint, tail: int, turn: bigint, role: string, digest: string, inserted: string, edit: string>>"


def traced(chunks: DataFrame) -> DataFrame:
    """Pass 3: chunk, pieces (of the conversations in it), edits (of the rows that stay, and what is inserted behind
    the last row). ``chunks`` have ``end`` and ``state``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.int64()), ("pieces", _arrow(PIECES)), ("edits", _arrow(EDITS))])
        for b in batches:
            out = []
            for chunk, rows, goes_on, past_code, end, state in zip(*(c.to_pylist() for c in b.columns)):
                pieces, edits = [], []
                codes = [r["code"] for r in rows]
                for first, stop in segments([r["conv_id"] for r in rows]):
                    conv, open_end = rows[first]["conv_id"], goes_on and stop == len(rows)
                    own = codes[first:stop]
                    behind = vectors(own, tuple(end) if open_end else END)
                    s, past = (state, past_code) if first == 0 and state is not None else (0, None)
                    done, s = trace(own, behind, s)
                    cost, audit, illegal = 0, [], 0
                    for row, (inserted, what) in zip(rows[first:stop], done):
                        fault, initial = divmod(row["code"], 4)
                        gone = row["n"] - (what != "D")
                        audit.append("I" * len(inserted) + (what if what != "D" else "") + "D" * gone)
                        cost += INSERT * len(inserted) + DELETE * gone
                        if what != "D":
                            cost += (REROLE if what == "R" else 0) + CUT_SHORT * fault
                            edits.append((conv, 0, row["turn"], row["role"], row["digest"], inserted, what))
                        illegal += row["n"] - 1
                        if past is not None:
                            illegal += (INITIALS[past % 4] + INITIALS[initial]) not in ("su", "ua", "au")
                        past = row["code"]
                    if not open_end and (inserted := finish(s)):
                        audit.append("I" * len(inserted))
                        cost += INSERT * len(inserted)
                        edits.append((conv, 1, None, None, None, inserted, ""))
                    pieces.append((conv, cost, "".join(audit), illegal))
                out.append((chunk, pieces, edits))
            yield _records(out, schema)

    rows = chunks.select("chunk", "rows", "goes_on", F.when(F.col("goes_back"), F.col("past_code")).alias("past_code"),
                         "end", "state")
    return materialize(rows.mapInArrow(run, f"chunk long, pieces {PIECES}, edits {EDITS}"), "turn-edits")


def _arrow(kind: str) -> pa.DataType:
    """The Arrow type of an array of flat structs."""
    plain = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split(": ") for f in kind.removeprefix("array<struct<").removesuffix(">>").split(", ")]
    return pa.list_(pa.struct([(n, plain[k]) for n, k in fields]))


def _records(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = []
    for field, values in zip(schema, columns):
        if pa.types.is_list(field.type):
            names = [f.name for f in field.type.value_type]
            values = [[dict(zip(names, v)) for v in row] for row in values]
        arrays.append(pa.array(list(values), field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns out of rows sorted by conversation and place, edits before their texts."""
    wanted = None
    for b in batches:
        out = []
        for conv, tail, turn, role, digest, is_text, inserted, what, text in zip(*(c.to_pylist() for c in b.columns)):
            if not is_text:
                out += [(conv, turn, "I", ROLES[2 if x == "u" else 3], "") for x in inserted]
                wanted = None if tail else (conv, turn, role, digest, what)
            elif wanted is not None and wanted[:4] == (conv, turn, role, digest):
                out.append((conv, turn, wanted[4], role, text))
                wanted = None
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], pa.int64() if k < 2 else pa.string()) for k in range(5)],
            ["conv_id", "turn", "edit", "role", "text"])


def _rerole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reroled turns take the role that follows from the one before."""
    conv, last = object(), ""
    for b in batches:
        roles = []
        for c, what, role in zip(*(b.column(k).to_pylist() for k in ("conv_id", "edit", "role"))):
            if c != conv:
                conv, last = c, ""
            if what == "R":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            roles.append(role)
        yield b.set_column(b.schema.get_field_index("role"), "role", pa.array(roles, pa.string()))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, out = None, None, []
    for b in batches:
        for c, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
            if digest is None or c != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256(f"{role}:{text}".encode())
            else:
                digest.update(f"\n{role}:{text}".encode())
        if len(out) >= 10_000:
            yield _digest_batch(out)
            out = []
    if digest is not None:
        out.append((conv, digest.hexdigest()))
    yield _digest_batch(out)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                                      ["conv_id", "repaired_sha256"])


class Repair:
    """The repair of ``turns`` (conv_id, turn, role, text, n; see ``counted``). Runs its passes when created."""

    def __init__(self, turns: DataFrame, chunk: int = CHUNK, fixups: int = FIXUPS):
        self.turns = materialize(turns.withColumn("digest", F.md5("text")), "turns")
        self.rows = materialize(faults(self.turns), "turn-faults")
        chunks = chunked(self.rows, chunk)
        starts = converged(chunks, speculated(chunks), fixups)
        ends = starts.select((F.col("chunk") - 1).alias("chunk"), F.col("start").alias("end"))
        chunks = chunks.join(ends, "chunk", "left")
        states = start_states(chunks)
        self.edits = traced(chunks.join(states, "chunk", "left"))

    def audits(self) -> DataFrame:
        """conv_id, illegal, cost, audit."""
        pieces = self.edits.select("chunk", F.explode("pieces").alias("p")).select("chunk", "p.*")
        return pieces.groupBy("conv_id").agg(
            F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "")
            .alias("audit"))

    def repaired(self) -> DataFrame:
        """conv_id, turn, edit (K, R or I), role, text of the repaired turns, in order within partitions, every
        conversation in one of them."""
        edits = self.edits.select(F.explode("edits").alias("e")).select("e.*").select(
            "conv_id", "tail", "turn", "role", "digest", F.lit(False).alias("is_text"), "inserted", "edit",
            F.lit(None).cast("string").alias("text"))
        texts = self.turns.select("conv_id", F.lit(0).alias("tail"), "turn", "role", "digest", F.lit(True).alias("is_text"),
                                  F.lit("").alias("inserted"), F.lit("").alias("edit"), "text")
        keys = ["conv_id", "tail", "turn", "role", "digest", "is_text"]
        rows = edits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*keys)
        schema = "conv_id long, turn long, edit string, role string, text string"
        return rows.mapInArrow(_merge, schema).mapInArrow(_rerole, schema)

    def digests(self) -> DataFrame:
        return self.repaired().mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def repair_figures(conversations: DataFrame, chunk: int = CHUNK, fixups: int = FIXUPS) -> DataFrame:
    """One row for each conv_id of ``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, after damage."""
    found = Repair(damage(conversations), chunk, fixups)
    out = conversations.select(F.col("conv_id").cast("long")).distinct()
    for part in (figures(found.rows), found.audits(), found.digests()):
        part = part.withColumnRenamed("conv_id", "other")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11_repair_conversations(spark, sf_dir: str) -> DataFrame:
    """Faults and repair of every conversation after damage."""
    return repair_figures(table(spark, sf_dir, "conversations"))


ORACLE_OP11 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''),
              lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END),
            4294967295::BIGINT) % 20 AS kind FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, copy,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (VALUES (1), (2)) AS c(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos FROM hurt),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth, left(role, 1) AS ini,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair,
         right(rtrim(text, e'\t\n\x0b\x0c\r '), 1) AS last FROM placed),
judged AS (
  SELECT *, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM seen),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM judged GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS pos, [
    {'c': 0::BIGINT, 'a': '', 't': ''}, {'c': 1000000000::BIGINT, 'a': '', 't': ''},
    {'c': 5::BIGINT, 'a': 'I', 't': e'user:\n'}, {'c': 10::BIGINT, 'a': 'II', 't': e'user:\nassistant:\n'}] AS v
  FROM figures
  UNION ALL
  SELECT w.conv_id, w.pos + 1, (
    SELECT [p[1], p[2], list_min([p[3], i2]),
            list_min([p[4], {'c': list_min([p[3], i2]).c + 5, 'a': list_min([p[3], i2]).a || 'I',
                             't': list_min([p[3], i2]).t || e'assistant:\n'}])]
    FROM (SELECT p, list_min([{'c': x.c + 5, 'a': x.a || 'I', 't': x.t || e'user:\n'} FOR x IN [p[1], p[2], p[4]]]) AS i2
          FROM (SELECT [
            list_min(del[1:1]),
            list_min([del[2]] || CASE WHEN j.ini = 's' AND NOT must THEN [keep[1]] ELSE [] END),
            list_min([del[3]] || CASE WHEN must THEN [] ELSE [again[1], again[2], again[4]]
                                   || CASE WHEN j.ini = 'u' THEN [keep[1], keep[2], keep[4]] ELSE [] END END),
            list_min([del[4]] || CASE WHEN must THEN [] ELSE [asst] || CASE WHEN j.ini = 'a' THEN [keep[3]] ELSE [] END END)] AS p
            FROM (SELECT j.fault IN ('b', 'd') AS must,
                    [{'c': x.c + 2, 'a': x.a || 'D', 't': x.t} FOR x IN w.v] AS del,
                    [{'c': x.c + CASE j.fault WHEN 't' THEN 5 ELSE 0 END, 'a': x.a || 'K',
                      't': x.t || j.role || ':' || j.text || e'\n'} FOR x IN w.v] AS keep,
                    [{'c': x.c + 1 + CASE j.fault WHEN 't' THEN 5 ELSE 0 END, 'a': x.a || 'R',
                      't': x.t || 'user:' || j.text || e'\n'} FOR x IN w.v] AS again,
                    {'c': w.v[3].c + 1 + CASE j.fault WHEN 't' THEN 5 ELSE 0 END, 'a': w.v[3].a || 'R',
                     't': w.v[3].t || 'assistant:' || j.text || e'\n'} AS asst)))) AS v
  FROM walk w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = w.pos + 1),
best AS (
  SELECT w.conv_id, list_min([w.v[1], w.v[4]]) AS x FROM walk w
  JOIN figures f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.pos = f.n)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(x.c, 0)::BIGINT AS cost, coalesce(x.a, '') AS audit,
       sha256(coalesce(left(x.t, greatest(length(x.t) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""
