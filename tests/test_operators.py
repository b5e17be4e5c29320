"""Distributed ranker, skew-safe dedupe, quality checks, scalar combination."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from channelwise.operators import quality as Q
from channelwise.operators.dedupe import first_per_key, insert_or_ignore, load_counts
from channelwise.operators.ranking import ordered_row_number
from channelwise.operators.scalars import combine_scalars

from .conftest import AS_OF


def test_ordered_row_number_matches_global_window(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 50), f"n{rnd.randint(0, 9)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, score int, name string").repartition(5)
    order = [F.col("score").desc(), F.col("name"), F.col("id")]
    got = {r.id: r.rn for r in ordered_row_number(df, order, "rn", num_partitions=7).collect()}
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
    assert got == want


def test_ordered_row_number_empty(spark):
    df = spark.createDataFrame([], "id long")
    assert ordered_row_number(df, [F.col("id")]).count() == 0


def test_first_per_key_with_hot_key(spark):
    # one key holds a third of the rows; the earliest copy must win, nulls sort last
    rows = [(1, "hot", f"2024-01-{(i % 28) + 1:02d}", i) for i in range(3000)]
    rows += [(2, "x", None, 1), (2, "x", "2024-02-01", 2), (3, "y", "2024-01-05", 9)]
    rows += [(k, "z", "2024-01-01", k) for k in range(10, 6010)]
    df = spark.createDataFrame(rows, "message_id long, channel_name string, scraped_at string, v long")
    out = {(r.message_id, r.channel_name): r for r in first_per_key(df, ["message_id", "channel_name"],
                                                                    ["scraped_at", "v"]).collect()}
    assert out[(1, "hot")].scraped_at == "2024-01-01" and out[(1, "hot")].v == 0
    assert out[(2, "x")].v == 2
    assert len(out) == 3 + 6000


def test_insert_or_ignore_is_idempotent(spark):
    inc = spark.createDataFrame([(1, "a", "t1"), (1, "a", "t0"), (2, "a", "t5"), (None, "a", "t1"), (3, None, "t1")],
                                "message_id long, channel_name string, scraped_at string")
    first = insert_or_ignore(inc, ["message_id", "channel_name"], ["scraped_at"])
    assert sorted((r.message_id, r.scraped_at) for r in first.collect()) == [(1, "t0"), (2, "t5")]
    again = insert_or_ignore(inc, ["message_id", "channel_name"], ["scraped_at"], existing=first)
    assert again.count() == 0
    c = load_counts(inc, ["message_id", "channel_name"], first).first()
    assert (c.read, c.rejected, c.duplicate, c.inserted) == (5, 2, 1, 2)


def test_row_checks_and_set_checks(spark):
    df = spark.createDataFrame([(1, "A", 5), (1, None, -1), (2, "Z", 0), (None, "A", 3)], "k long, t string, n long")
    rc = {r.test_name: r.result for r in Q.row_checks(df, [
        Q.not_null("nn_k", "k"), Q.accepted_values("av_t", "t", ["A", "Z"]), Q.not_negative("nn_n", "n"),
        Q.accepted_values("av_t2", "t", ["A"])]).collect()}
    assert rc == {"nn_k": 1, "av_t": 0, "nn_n": 1, "av_t2": 1}
    assert Q.unique("u", df, ["k"]).first().result == 1
    parent = spark.createDataFrame([(1,)], "k long")
    assert Q.relationships("r", df, "k", parent, "k").first().result == 1          # null FK passes
    assert Q.relationships("r", df, "k", parent, "k", False).first().result == 2   # null FK fails
    res = Q.with_status(Q.row_checks(df, [Q.not_null("nn_k", "k")]))
    assert res.first().status == "FAIL" and not Q.all_passed(res)


def test_combine_scalars(spark):
    a = spark.range(10).agg(F.count("*"))
    b = spark.range(3).agg(F.sum("id"))
    r = combine_scalars({"a": a, "b": b}).first()
    assert (r.a, r.b) == (10, 3)


@pytest.mark.parametrize("parts", [8, 32])
def test_row_numbers_on_many_rows_with_other_columns(spark, parts):
    df = spark.range(0, 200_000).selectExpr("id", "id * 7919 % 1000 AS g", "uuid() AS other", "cast(id AS string) AS more")
    df = df.drop("other").withColumn("wide", F.repeat("more", 5))
    got = ordered_row_number(df, [F.col("g").desc(), F.col("id")], "rn", num_partitions=parts)
    want = df.select("id", F.row_number().over(Window.orderBy(F.col("g").desc(), "id")).alias("want"))
    assert got.join(want, "id").filter("rn != want").count() == 0 and got.count() == 200_000


def test_sixty_thousand_channels_have_as_many_keys(spark):
    from channelwise.plans.dims import channel_dimension
    stg = spark.range(0, 120_000).selectExpr(
        "concat('c', id % 60000) AS channel_name", "'u' AS channel_username", "'t' AS channel_title",
        "TIMESTAMP_NTZ '2024-01-20 00:00:00' AS message_date", "id AS views", "id AS forwards", "true AS has_media",
        "false AS has_image", "'valid' AS data_quality_status")
    keys = channel_dimension(stg, AS_OF).agg(F.count_distinct("channel_key").alias("n"), F.max("channel_key").alias("m")).first()
    assert (keys.n, keys.m) == (60_000, 60_000)


def test_check_that_cannot_run_is_a_failure(spark):
    from channelwise.operators import quality as q
    df = spark.createDataFrame([(1,), (-1,)], "a long")
    res = q.with_status(q.row_checks(df, [q.not_negative("a", "a"), q.not_null("b", "missing")]))
    assert {r.test_name: (r.status, r.result) for r in res.collect()} == {"a": ("FAIL", 1), "b": ("FAIL", None)}
    assert not q.all_passed(res.filter("test_name = 'b'"))


def test_scratch_folder_is_refused_off_local_masters(monkeypatch):
    from channelwise import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
