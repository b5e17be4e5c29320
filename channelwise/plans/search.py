"""M21 message search (paged, with total) and M22 channel search."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.calendar import date_key
from ..functions.text import contains_ci, like_ci
from ..operators.validate import check_range, check_text
from .reports import LIST_COLUMNS

MESSAGE_COLUMNS = ["message_id", "channel_name", "channel_type", "message_date", "message_text", "message_length",
                   "view_count", "forward_count", "has_image"]


def _all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def _date_lit(v) -> Column:
    """A calendar-date literal from a date, datetime or ISO string (no time-zone conversion)."""
    if isinstance(v, _dt.datetime):
        v = v.date()
    return F.lit(v.isoformat() if isinstance(v, _dt.date) else str(v)).cast("date")


def _match(text: Column, term: str, wildcards: bool) -> Column:
    return like_ci(text, term) if wildcards else contains_ci(text, term)


def search_matches(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, query: str,
                   channel: str | None = None, wildcards: bool = False,
                   since=None, until=None) -> DataFrame:
    """All fact messages whose text contains ``query`` (case-insensitive, literal unless
    ``wildcards``), optionally in channels whose name contains ``channel`` and posted on days
    in [``since``, ``until``] (dates; bounds become date_key filters that prune fact files)."""
    check_text("query", query, params.SEARCH_MIN_LENGTH)
    c = dim_channels.select("channel_key", "channel_name", "channel_type")
    if channel:
        c = c.filter(_match(F.col("channel_name"), channel, wildcards))
    f = fct
    if since is not None:
        f = f.filter(F.col("date_key") >= date_key(_date_lit(since)))
    if until is not None:
        f = f.filter(F.col("date_key") <= date_key(_date_lit(until)))
    f = f.filter(_match(F.col("message_text"), query, wildcards))
    j = f.join(c, "channel_key").join(dim_dates.select("date_key", F.col("full_date").alias("message_date")), "date_key")
    return j.select(*MESSAGE_COLUMNS)


def search_messages(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, query: str,
                    channel: str | None = None, limit: int = 20, page: int = 1,
                    wildcards: bool = False, since=None, until=None) -> DataFrame:
    """One page of matches, newest day first (ties by channel, id)."""
    check_range("limit", limit, 1, params.LIMIT_MAX)
    check_range("page", page, 1, None)
    m = search_matches(fct, dim_channels, dim_dates, query, channel, wildcards, since, until)
    ordered = m.orderBy(F.col("message_date").desc(), "channel_name", "message_id")
    return ordered.offset((page - 1) * limit).limit(limit)


def search_messages_after(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, query: str,
                          after: tuple | None = None, channel: str | None = None, limit: int = 20,
                          wildcards: bool = False) -> DataFrame:
    """Keyset page for deep paging: rows strictly after ``after`` = (message_date, channel_name,
    message_id) of the previous page's last row; cost does not grow with the page number."""
    check_range("limit", limit, 1, params.LIMIT_MAX)
    m = search_matches(fct, dim_channels, dim_dates, query, channel, wildcards)
    if after is not None:
        d, name, mid = after
        d, name, mid = F.lit(d), F.lit(name), F.lit(mid)
        m = m.filter((F.col("message_date") < d)
                     | ((F.col("message_date") == d) & (F.col("channel_name") > name))
                     | ((F.col("message_date") == d) & (F.col("channel_name") == name) & (F.col("message_id") > mid)))
    return m.orderBy(F.col("message_date").desc(), "channel_name", "message_id").limit(limit)


def search_count(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, query: str,
                 channel: str | None = None, wildcards: bool = False, since=None, until=None) -> DataFrame:
    """Total number of matches (one row), with the same filters as :func:`search_messages`."""
    m = search_matches(fct, dim_channels, dim_dates, query, channel, wildcards, since, until)
    return m.agg(F.count(F.lit(1)).alias("total_count"))


def search_channels(dim_channels: DataFrame, name: str | None = None, channel_type: str | None = None,
                    activity_status: str | None = None, min_posts: int = 0, wildcards: bool = False) -> DataFrame:
    """Channels filtered by optional predicates (None = no predicate), most posts first."""
    check_range("min_posts", min_posts, 0, None)
    preds = []
    if name:
        preds.append(_match(F.col("channel_name"), name, wildcards))
    if channel_type:
        preds.append(F.col("channel_type") == channel_type)
    if activity_status:
        preds.append(F.col("activity_status") == activity_status)
    if min_posts > 0:
        preds.append(F.col("total_posts") >= min_posts)
    return dim_channels.filter(_all(preds)).select(*LIST_COLUMNS).orderBy(F.col("total_posts").desc(), "channel_key")
