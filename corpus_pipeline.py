"""A training corpus out of ``documents``: quality rules, near-duplicates, secrets, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import bpe, mixing, quality, secrets, simhash
from weftline.llm.common import Stored, drop_but, table, written

#: Each takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns the columns of
#: documents; the last adds the ids of the tokens and their number.
STAGES = [
    ("quality_rules", quality.stage),
    ("simhash_near_dedup", simhash.stage),
    ("secret_scan", secrets.stage),
    ("mixing", mixing.stage),
    ("bpe_encoding", bpe.stage),
]

#: SQL can't express SimHash, the tokenizer's measures or BPE; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each one's result is written to the shared folder and read again. Of what a stage
    has stored on its way nothing stays once its result is written, nor does the result before."""
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        before = written() - {last.path if last else ""}
        last = Stored(stage(spark, docs, sf_dir))
        drop_but(last, before)
        docs = last.df
    return STAGES[-1][1](spark, docs, sf_dir)
