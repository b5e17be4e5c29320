"""Ordered keyword-rule classifiers and threshold buckets (JVM expressions only)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params
from .calendar import as_of_col

Rules = Sequence[tuple[str, Sequence[str]]]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minimal_keywords(keywords: Sequence[str]) -> list[str]:
    """Drop keywords that contain another keyword of the same rule: ``%pharmacy%``
    can only match where ``%pharma%`` already does, so one substring test suffices."""
    kws = list(dict.fromkeys(keywords))
    return [k for k in kws if not any(o != k and o in k for o in kws)]


def any_substring(text: Column | str, keywords: Sequence[str]) -> Column:
    """``text LIKE '%k1%' OR text LIKE '%k2%' ...`` with literal keywords (no wildcards)."""
    t = _col(text)
    kws = minimal_keywords(keywords)
    if not kws:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [t.contains(k) for k in kws])


def classify_by_rules(text: Column | str, rules: Rules, default: str | None) -> Column:
    """First matching rule wins; ``default`` (may be None) otherwise.

    ``text`` should already be lower-cased by the caller when rules are lower case.
    Null text matches no rule and gets the default, as a searched CASE does.
    """
    t = _col(text)
    expr = None
    for label, keywords in rules:
        cond = any_substring(t, keywords)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def channel_type(name: Column | str, rules: Rules = params.CHANNEL_TYPE_RULES,
                 default: str = params.CHANNEL_TYPE_DEFAULT) -> Column:
    return classify_by_rules(F.lower(_col(name)), rules, default)


def recency_bucket(last_ts: Column | str, as_of, active_days: int = params.ACTIVE_DAYS,
                   moderate_days: int = params.MODERATE_DAYS) -> Column:
    """active if within ``active_days`` of the as-of date (inclusive), moderate within
    ``moderate_days``, else inactive. Bounds are midnight of ``as_of``'s date minus N days."""
    ts = _col(last_ts)
    day = F.to_date(as_of_col(as_of))
    return (F.when(ts >= F.date_sub(day, active_days).cast("timestamp_ntz"), "active")
            .when(ts >= F.date_sub(day, moderate_days).cast("timestamp_ntz"), "moderate")
            .otherwise("inactive"))


def performance_bucket(value: Column | str, high: float = params.PERFORMANCE_HIGH,
                       medium: float = params.PERFORMANCE_MEDIUM) -> Column:
    v = _col(value)
    return (F.when(v > high, "High Performer")
            .when(v > medium, "Medium Performer")
            .otherwise("Low Performer"))


def recommendation(image_pct: Column | str, posts_7d: Column | str, avg_views: Column | str) -> Column:
    return (F.when(_col(image_pct) < params.RECOMMEND_IMAGE_PCT, "Increase visual content")
            .when(_col(posts_7d) < params.RECOMMEND_POSTS_7D, "Increase posting frequency")
            .when(_col(avg_views) < params.RECOMMEND_AVG_VIEWS, "Improve content quality")
            .otherwise("Maintain current strategy"))


def image_category(objects: Column | str,
                   person: Sequence[str] = params.PERSON_OBJECTS,
                   product: Sequence[str] = params.PRODUCT_OBJECTS,
                   medical: Sequence[str] = params.MEDICAL_OBJECTS) -> Column:
    """Per-image category from the detected object list (any-match over object sets)."""
    objs = _col(objects)
    has_person = F.arrays_overlap(objs, F.array(*[F.lit(x) for x in person]))
    has_product = F.arrays_overlap(objs, F.array(*[F.lit(x) for x in product]))
    has_medical = F.arrays_overlap(objs, F.array(*[F.lit(x) for x in medical]))
    return (F.when(objs.isNull() | (F.size(objs) == 0), "no_detection")
            .when(has_person & has_product, "promotional")
            .when(has_product, "product_display")
            .when(has_person, "lifestyle")
            .when(has_medical, "medical_product")
            .otherwise("other_content"))


def box_category(class_name: Column | str, product_words: Sequence[str] = params.BOX_PRODUCT_WORDS) -> Column:
    """Per-box category from one class name (substring tests, lower-cased)."""
    c = F.lower(_col(class_name))
    prod = any_substring(c, product_words)
    return (F.when(c.contains("person") & prod, "promotional")
            .when(c.contains("person"), "lifestyle")
            .when(prod, "product_display")
            .otherwise("other"))
