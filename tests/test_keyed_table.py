"""Loads by key: figures and rows against a dictionary, and what a load reads."""
import random
import re

import pytest
from pyspark.sql import functions as F

from channelwise.sources.keyed_table import KeyedTable

SCHEMA = "message_id long, channel_name string, scraped_at timestamp_ntz, views long"


def batch(spark, rows):
    return (spark.createDataFrame(rows, "message_id long, channel_name string, hour long, views long").repartition(3)
            .select("message_id", "channel_name", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, hour)").alias("scraped_at"),
                    "views"))


def rows_of(rng, n, channels=4, ids=300):
    return [(rng.choice([None] + list(range(ids)) * 3), rng.choice([None] + [f"c{k}" for k in range(channels)] * 9), rng.randrange(50),
             rng.randrange(1000)) for _ in range(n)]


def test_loads_equal_a_dictionary(spark, tmp_path):
    rng, held = random.Random(4), {}
    table = KeyedTable(spark, str(tmp_path / "t"), buckets=8, pages=1)
    for n in (0, 400, 900, 50, 0):
        rows = rows_of(rng, n)
        load = table.load(batch(spark, rows))
        good = [r for r in rows if r[0] is not None and r[1] is not None]
        first = {}
        for r in sorted(good, key=lambda r: (r[2], r[3])):
            first.setdefault(r[:2], r)
        new = {k: r for k, r in first.items() if k not in held}
        assert load.counts.first().asDict() == {
            "read": len(rows), "rejected": len(rows) - len(good), "duplicate": len(good) - len(first),
            "already_loaded": len(first) - len(new), "inserted": len(new)}
        assert {(r.message_id, r.channel_name): r.views for r in load.inserted.collect()} == {k: r[3] for k, r in new.items()}
        held |= new
        if held:
            got = table.rows().select("message_id", "channel_name", "views").collect()
            assert len(got) == len(held) and {tuple(r)[:2]: r.views for r in got} == {k: r[3] for k, r in held.items()}
    again = KeyedTable(spark, str(tmp_path / "t"), buckets=99)  # another session: the table keeps its own shape
    assert (again.buckets, again.pages) == (8, 1)
    again.compact_index()
    assert again.load(batch(spark, [(*k, 9, 9) for k in held])).counts.first().inserted == 0


def per_channel(channels, ids):
    return [(i, f"channel {c}", 0, 1) for c in channels for i in ids]


def test_a_load_reads_only_buckets_that_it_may_repeat(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), buckets=64)
    table.load(batch(spark, per_channel(range(60), range(100))))  # the same ids in every channel
    new = table.load(batch(spark, per_channel(range(60, 90), range(100))))
    assert len(new.buckets_read) <= 30 and new.counts.first().inserted == 3000  # false hits of the index at most
    mixed = table.load(batch(spark, per_channel([3, 95], range(100))))
    assert mixed.counts.first().asDict()["already_loaded"] == 100
    named = {r.bucket for r in batch(spark, per_channel([3, 95], range(100))).select(table.bucket().alias("bucket")).collect()}
    assert set(mixed.buckets_read) <= named and len(named) <= 2
    part = table.rows(mixed.buckets_read)
    files = [r.f for r in part.select(F.input_file_name().alias("f")).distinct().collect()]
    assert {f.split("bucket=")[1].split("/")[0] for f in files} == {str(b) for b in mixed.buckets_read}
    plan = part.select("views")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert table.rows().select("bucket").distinct().count() > 30


def test_an_interrupted_load_is_made_up_for(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.load(batch(spark, per_channel([1], range(10))))
    lost = batch(spark, per_channel([1], range(10, 30)))
    table._page_rows(lost.select(*table.keys)).write.mode("append").parquet(f"{table.index_path}/pages")  # rows never followed
    assert table.load(lost).counts.first().inserted == 20
    assert table.load(lost).counts.first().inserted == 0


def test_index_has_no_false_negatives_and_few_false_hits(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), buckets=2, pages=2)
    keys = spark.range(8000).select(F.col("id").alias("message_id"), F.lit("c").alias("channel_name"))
    table.load(keys.withColumn("scraped_at", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("views", F.lit(1)))
    assert table.possible(keys).count() == 8000
    others = keys.withColumn("message_id", F.col("message_id") + 8000)
    assert table.possible(others).count() < 240


def test_a_table_without_an_index_is_refused(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"))
