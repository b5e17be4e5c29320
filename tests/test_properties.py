"""Property tests: the rule classifier and the distributed ranker against plain-Python
references on generated inputs (several cases per Spark job)."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from channelwise.functions.rules import classify_by_rules, channel_type
from channelwise.operators.ranking import ordered_row_number
from channelwise import params

ALPHA = "abcdemp"
words = st.text(alphabet=ALPHA, min_size=1, max_size=3)
rules_st = st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.lists(words, min_size=1, max_size=3)),
                    min_size=1, max_size=4)
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHA, max_size=8)), min_size=1, max_size=25)

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def first_match(text, rules, default):
    if text is None:
        return default
    for label, kws in rules:
        if any(k in text for k in kws):
            return label
    return default


@SLOW
@given(rules=rules_st, values=texts)
def test_classifier_matches_first_match(spark, rules, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", classify_by_rules("t", rules, "Z").alias("c")).collect()}
    got_col = {r.i: r.c for r in df.select("i", classify_by_rules(F.col("t"), rules, "Z").alias("c")).collect()}
    want = {i: first_match(v, rules, "Z") for i, v in enumerate(values)}
    assert got == want == got_col


@SLOW
@given(names=st.lists(st.text(alphabet=string.ascii_letters + string.digits, max_size=12), min_size=1, max_size=20))
def test_channel_type_matches_first_match(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r.i: r.c for r in df.select("i", channel_type("n").alias("c")).collect()}
    want = {i: first_match(n.lower(), params.CHANNEL_TYPE_RULES, "Other") for i, n in enumerate(names)}
    assert got == want


@SLOW
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.text(alphabet="xyz", max_size=2)), min_size=0, max_size=60),
       parts=st.integers(1, 9))
def test_ranker_matches_sorted_position(spark, rows, parts):
    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, a int, b string")
    order = [F.col("a").desc(), F.col("b"), F.col("id")]
    got = {r.id: r.rn for r in ordered_row_number(df, order, "rn", num_partitions=parts).collect()}
    ranked = sorted(data, key=lambda r: (-r[1], r[2], r[0]))
    assert got == {r[0]: pos + 1 for pos, r in enumerate(ranked)}
    if data:
        w = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
        assert got == w
