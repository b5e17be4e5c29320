"""String, path and array helpers (built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_ci(text: Column | str, term: str) -> Column:
    """Case-insensitive literal substring test; ``%`` and ``_`` in ``term`` are plain characters."""
    return F.lower(_col(text)).contains(term.lower())


def like_ci(text: Column | str, term: str) -> Column:
    """Case-insensitive ``LIKE '%term%'`` where ``%`` and ``_`` in ``term`` act as wildcards."""
    return F.lower(_col(text)).like(f"%{term.lower()}%")


def strip_handle(handle: Column | str) -> Column:
    """Remove leading/trailing ``@`` from a channel handle."""
    return F.regexp_replace(_col(handle), r"^@+|@+$", "")


def channel_from_image_path(path: Column | str) -> Column:
    """Path segment following ``images``: ``.../images/<channel>/<id>.jpg``."""
    v = F.regexp_extract(_col(path), r"(?:^|/)images/([^/]+)/", 1)
    return F.when(v != "", v)


def message_id_from_image_path(path: Column | str) -> Column:
    """Numeric file stem: ``.../<id>.jpg`` -> id."""
    v = F.regexp_extract(_col(path), r"(?:^|/)(\d+)\.[^./]+$", 1)
    return F.when(v != "", v.cast("bigint"))


def strength(text: Column | str, pattern: str = params.STRENGTH_PATTERN) -> Column:
    """First match of the strength pattern, NULL when there is none."""
    return F.regexp_substr(_col(text), F.lit(pattern))


def csv_join(arr: Column | str) -> Column:
    return F.array_join(_col(arr), ",")


def csv_split(text: Column | str) -> Column:
    """Inverse of :func:`csv_join`; the empty string gives an empty array."""
    t = _col(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ","))


def round_each(arr: Column | str, places: int = 3) -> Column:
    return F.transform(_col(arr), lambda x: F.round(x, places))


def map_total(m: Column | str) -> Column:
    """Sum of the values of a map<string,bigint>."""
    return F.aggregate(F.map_values(_col(m)), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def merge_maps(base: Column | str, updates: Column | str) -> Column:
    """``base.update(updates)``: union of two maps where a key in ``updates`` wins, without
    depending on the session's duplicate-key policy."""
    b, u = _col(base), _col(updates)
    kept = F.map_filter(b, lambda k, v: ~F.array_contains(F.map_keys(u), k))
    return F.map_concat(kept, u)
