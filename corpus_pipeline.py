"""The corpus pipeline: toxic documents go, one document of each group of near copies stays,
repeated passages are cut out, sources are mixed to their target weights, and the rest is encoded.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet below the shared
checkpoint folder and read again as the next stage's documents. All but the last return the columns
of ``documents``. SQL can express neither the trained toxicity score nor the tokenizer, so
``ORACLE_SQL`` is None. tests/llm compares the operators with brute-force versions or held-out labels, each
on its own. Of the stages in a row it checks ids and columns: the first two against their operators' own
results, the third by its operator's own rule, mixing for ids that were there before, encoding for ids and
columns but not for digests. ``run`` itself is not called by a test.
"""

from __future__ import annotations

from channelwise.llm import bpe, minhash, mixing, toxicity, unit_dedup
from channelwise.llm.common import materialize, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("minhash_near_dedup", minhash.stage),
    ("substring_dedup", unit_dedup.stage),
    ("mix_sources", mixing.stage),
    ("bpe_encode_decode", bpe.stage),
]
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
