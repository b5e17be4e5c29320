"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long): root is the smallest node that
    links lead to. Each round takes the smallest root of the neighbours and then the root's root,
    so that chains halve; every round is written to the shared folder. A neighbourhood is only ever
    reduced to its minimum, with map-side combining."""
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                        .select("node", F.least("node", "m").alias("root")), "roots")
    while True:
        of = roots.select(F.col("node").alias("b"), F.col("root").alias("r"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("m"))
        step = roots.join(near, "node").select("node", "root", F.least("root", "m").alias("low"))
        up = roots.select(F.col("node").alias("low"), F.col("root").alias("top"))
        new = materialize(step.join(up, "low").select(
            "node", F.least("low", "top").alias("root"), (F.least("low", "top") != F.col("root")).alias("moved")),
            "roots")
        roots = new.select("node", "root")
        if new.filter("moved").isEmpty():
            return roots
