"""Conversation repair against a plain search over all edits, with chunks down to one row."""
import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pyarrow as pa
import pytest

from channelwise.llm import turn_repair

from .conftest import CLASHING

ROWS = "conv_id long, turn long, role string, text string"
STATES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain(rows):
    """The contract's columns for every conversation of (conv_id, turn, role, text), by trying every edit."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = ":".join(" " if x is None else str(x) for x in (conv, turn))
            kind = zlib.crc32(key.encode()) % 20
            if kind:
                text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in own:
            left = text.rstrip("\t\n\x0b\x0c\r ")
            faults.append("b" if not left else "d" if (role, text) in seen else "t" if left[-1] not in ".!?" else "")
            seen.add((role, text))
        n = len(own)

        @lru_cache(maxsize=None)
        def best(i, state, inserts=0):
            ways = [(0, "")] if i == n and state in ("", "a") else []
            if inserts < 3:
                for to in "ua":
                    if (state, to) in STATES:
                        ways.append((5, "I", i, to, inserts + 1))
            if i < n:
                extra = 5 if faults[i] == "t" else 0
                ways.append((2, "D", i + 1, state))
                if faults[i] not in ("b", "d"):
                    first = own[i][1][:1]
                    if (state, first) in STATES:
                        ways.append((extra, "K", i + 1, first))
                    ways += [(1 + extra, "R", i + 1, to) for to in "ua" if (state, to) in STATES]
            found = []
            for way in ways:
                rest = best(*way[2:]) if len(way) > 2 else (0, "", ())
                if rest is not None:
                    line = ()
                    if way[1] == "K":
                        line = (f"{own[i][1]}:{own[i][2]}",)
                    elif way[1] and way[1] in "IR":
                        role = {"u": "user", "a": "assistant"}[way[3]]
                        line = (f"{role}:{own[i][2] if way[1] == 'R' else ''}",)
                    found.append((way[0] + rest[0], way[1] + rest[1], line + rest[2]))
            return min(found, key=lambda x: x[:2]) if found else None

        cost, audit, lines = best(0, "")
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
                     faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(seed, sizes, foreign=0.1):
    rng = random.Random(seed)
    rows = []
    for conv, n in sizes:
        for turn in range(n):
            role = rng.choice(["system", "bot", "", None, "a", "usher"]) if rng.random() < foreign else (
                "user", "assistant")[turn % 2] if rng.random() < 0.8 else rng.choice(["user", "assistant", "system"])
            text = rng.choice([f"line {rng.randrange(1000)}.", "same text!", "cut short", " \n", "", None, "ends? \t", "Üb. x"])
            number = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 5])
            rows.append((conv, number, role, text))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    return rows


def figures(spark, rows, **limits):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    for name in CLASHING + ("n", "kind", "chunk", "code"):
        df = df.withColumn(name, df.role)
    return {r[0]: tuple(r)[1:] for r in turn_repair.repair_figures(df, **limits).collect()}


@pytest.mark.parametrize("chunk, fixups", [(1, 0), (5, 2), (4096, 4)])
def test_equals_plain_search(spark, chunk, fixups):
    rows = conversations(chunk, [*((k, k % 9) for k in range(60)), (None, 40), (900, 70), (901, 70)], 0.15)
    assert figures(spark, rows, chunk=chunk, fixups=fixups) == plain(rows)


@pytest.mark.parametrize("fixups", [1, 50])
def test_vectors_that_never_converge(spark, fixups):
    """Rows of foreign roles keep the difference between states; rows that must go keep every vector."""
    rows = [(1, t, "bot", f"line {t}.") for t in range(41)] + [(2, t, "user", "again.") for t in range(30)]
    assert figures(spark, rows, chunk=4, fixups=fixups) == plain(rows)


def test_steps_against_matrices():
    rng = random.Random(3)
    for _ in range(50):
        codes = [rng.randrange(12) for _ in range(rng.randrange(1, 30))]
        end = turn_repair.closed(tuple(rng.randrange(9) for _ in range(4)))
        costs = turn_repair.matrix(codes)
        start = turn_repair.level(tuple(min(c + v for c, v in zip(row, end)) for row in costs))
        assert turn_repair.vectors(codes, end)[-1] == start
        old = turn_repair.vectors(codes, turn_repair.SPECULATIVE)[-1]
        assert turn_repair.fix_up(codes, turn_repair.SPECULATIVE, end, old) == start


def test_hot_conversation_spans_chunks_and_repaired_turns_alternate(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(200)] + [(8, 0, "user", "x.")]
    df = spark.createDataFrame(rows, ROWS)
    found = turn_repair.Repair(turn_repair.damage(df), chunk=16)
    assert found.edits.count() > 10
    turns = [r for r in found.repaired().collect() if r.conv_id == 7]
    assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in turns))
    assert figures(spark, rows, chunk=16) == plain(rows)


def test_empty_table_and_sql(spark):
    df = spark.createDataFrame([], ROWS)
    assert turn_repair.repair_figures(df).collect() == []
    rows = conversations(5, [*((k, k % 7) for k in range(30)), (None, 9)])
    con = duckdb.connect()
    con.register("conversations", pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}))
    assert {r[0]: r[1:] for r in con.sql(turn_repair.ORACLE_OP11).fetchall()} == plain(rows)
