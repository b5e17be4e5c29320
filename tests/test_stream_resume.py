"""Streams over one checkpoint: several runs, resumed results, days that are emitted once and forgotten."""
import datetime as dt

from pyspark.sql import functions as F

from channelwise import queries
from channelwise.sources import fixtures
from channelwise.streaming import jobs


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def test_update_table_resumes_from_its_last_result(spark, tmp_path):
    schema, src, out, ckpt = "k string, v long", tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    put(spark, src, [("a", 1), ("b", 2)], schema)

    def run():
        stream = spark.readStream.schema(schema).parquet(str(src))
        path = jobs.run_to_table(stream.groupBy("k").agg(F.sum("v").alias("v")), "upd", "update", ["k"], ckpt, out)
        return {r.k: r.v for r in spark.read.parquet(path).collect()}

    assert run() == {"a": 1, "b": 2}
    put(spark, src, [("c", 5), ("a", 10)], schema)
    assert run() == {"a": 11, "b": 2, "c": 5}
    assert run() == {"a": 11, "b": 2, "c": 5}  # nothing new


STAGED = "message_id long, channel_name string, hour long, views long, has_image boolean, data_quality_status string"


def staged(spark, src):
    rows = spark.readStream.schema(STAGED).option("maxFilesPerTrigger", 1).parquet(str(src))
    return rows.withColumn("message_date", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, hour)"))


def day(n, channels, copies=2):
    return [(n * 100 + i, c, n * 24 + 1 + i, 5, i == 0, "valid") for c in channels for i in range(copies)]


def test_closed_days_are_emitted_once_and_leave_the_state(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    for batch in (day(0, "abc") + day(1, "ab"), day(4, "abcd"), day(7, "a") + [(1, "q", 1, 1, True, "needs_review")],
                  day(9, "a") + day(0, "z")):  # a batch drops what the one before it found closed
        put(spark, src, batch, STAGED)
    run = jobs.run_append(jobs.closed_days(staged(spark, src)), "closed", ckpt, out)
    got = {r.full_date: (r.post_count, r.total_views, r.image_posts, r.channels_active) for r in spark.read.parquet(out).collect()}
    d = dt.date(2024, 1, 1)
    assert got == {d: (6, 30, 3, 3), d + dt.timedelta(1): (4, 20, 2, 2), d + dt.timedelta(4): (8, 40, 4, 4),
                   d + dt.timedelta(7): (2, 10, 1, 1)}
    assert run.late_groups == 1  # channel z of the first day
    assert run.state_rows[-1] < max(run.state_rows)
    put(spark, src, day(0, "y") + day(20, "a"), STAGED)
    again = jobs.run_append(jobs.closed_days(staged(spark, src)), "closed", ckpt, out)
    days = [r.full_date for r in spark.read.parquet(out).collect()]
    assert len(days) == len(set(days)) == 5 and again.late_groups == 1


RAW = "message_id long, channel_name string, hour long, views long"


def test_state_load_inserts_once_and_forgets_old_keys(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = (spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(str(src))
                  .withColumn("scraped_at", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, hour)")))
        q = jobs.state_load(stream, out, ckpt, "2 days", ["message_id", "channel_name", "views"])
        q.awaitTermination()
        got = sorted((r.channel_name, r.message_id, r.views) for r in spark.read.parquet(out).collect())
        return got, [sum(op.numRowsTotal for op in p.stateOperators) for p in q.recentProgress]

    put(spark, src, [(i, c, 1, 0) for c in "ab" for i in range(20)], RAW)
    put(spark, src, [(i, "a", 5, 9) for i in range(10, 30)], RAW)  # ten of them again
    want = sorted([(c, i, 0) for c in "ab" for i in range(20)] + [("a", i, 9) for i in range(20, 30)])
    assert run()[0] == want
    put(spark, src, [(i, "b", 9, 7) for i in range(20)] + [(1, "c", 200, 1)], RAW)  # again in a later run
    got, held = run()
    assert got == sorted(want + [("c", 1, 1)]) and held[0] == 51 and held[-1] < 51
    assert run()[0] == got


def test_arrivals_are_whole_batches_of_equal_numbers_of_files(spark, tmp_path):
    src, rows = str(tmp_path / "in"), spark.range(1000).withColumn("b", F.col("id") % 3)
    batches = [rows.filter("b = 0"), rows.filter("b = 1 AND id < 5"), rows.filter("b = 7"), rows.filter("b = 2")]
    for n, batch in enumerate(batches, 1):
        fixtures.write_arrivals(batch, src, 4)  # few or no rows: still four files
        assert len(spark.read.schema(batch.schema).parquet(src).inputFiles()) == 4 * n
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(src)
    q = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [p.numInputRows for p in q.recentProgress] == [b.count() for b in batches]


def test_streams_write_their_batches_in_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures.files_per_batch, "__defaults__", (300,))
    seen, write = [], fixtures.write_arrivals

    def watched(batch, path, files):
        write(batch, path, files)
        seen.append(len(spark.read.schema(batch.schema).parquet(path).inputFiles()))

    monkeypatch.setattr(fixtures, "write_arrivals", watched)
    sf = "/root/testdata/sf0.001"
    got = queries.queries()["q_stream_state_load"](spark, sf)
    assert seen == [4, 8, 12]
    raw = fixtures.raw_messages(spark, sf)
    assert got.exceptAll(raw).count() == raw.exceptAll(got).count() == 0
    assert queries.queries()["q_stream_closed_days"](spark, sf).count() > 0 and seen[3:] == [4, 8, 12]
