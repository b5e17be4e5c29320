"""The text index gives the plain search's rows and reads only blocks that hold a term's grams."""
import random

import pytest
from pyspark.sql import functions as F

from channelwise.plans import search
from channelwise.plans.text_index import build_text_index, grams_of

FACT = ("message_id long, channel_key int, date_key int, message_text string, message_length int, view_count long, "
        "forward_count long, has_image boolean")


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    rng, words = random.Random(7), ["Tablet", "pill", "Ünit", "ዜና አዲስ", "50%", "a_b", "  x ", "ab", "abc"]
    rows = [(i, i % 5, 20240101 + i % 3, None if i % 17 == 0 else " ".join(rng.choice(words) for _ in range(rng.randrange(4))),
             1, i, 0, False) for i in range(400)] + [(900, 4, 20240102, "rare zebra", 1, 1, 0, False)]
    fct = spark.createDataFrame(rows, FACT).repartition(4)
    channels = spark.createDataFrame([(k, f"chan{k}", "Other") for k in range(5)], "channel_key int, channel_name string, channel_type string")
    dates = spark.createDataFrame([(20240101 + k,) for k in range(3)], "date_key int").withColumn(
        "full_date", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    return fct, channels, dates, build_text_index(fct, str(tmp_path_factory.mktemp("index") / "t"), 10)


@pytest.mark.parametrize("term, wildcards", [("tablet", False), ("ab", False), ("ዜና አዲስ", False), ("50%", False), ("A_B", False),
                                             ("t ü", False), ("zebra", False), ("nothing", False), ("ta%let", True), ("a_c", True)])
def test_same_rows_as_the_plain_search(served, term, wildcards):
    fct, channels, dates, index = served
    plain = search.search_matches(fct, channels, dates, term, None, wildcards).collect()
    found = search.search_matches(index.messages(term, wildcards), channels, dates, term, None, wildcards).collect()
    assert sorted(found) == sorted(plain)
    assert index.count(channels, dates, term, wildcards=wildcards).first().total_count == len(plain)


def test_reads_only_candidate_blocks(served):
    index = served[3]

    def blocks_read(term):
        files = index.messages(term).select(F.input_file_name().alias("f")).distinct().collect()
        return {r.f.split("block=")[1].split("/")[0] for r in files}

    everything = blocks_read("ab")
    assert len(everything) == 41 and len(blocks_read("zebra")) == 1 and blocks_read("nothing") == set()
    plan = index.messages("zebra").select("view_count")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "block" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_grams():
    assert grams_of("Abcd") == ["abc", "bcd"] and grams_of("ab") == [] and grams_of("ab%cde_f", True) == ["cde"]
