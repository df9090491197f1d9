"""The corpus pipeline: from raw documents to encoded training rows.

Each stage works on all that its predecessor kept, and its decisions take effect: unidentified
documents go, one document of each near-duplicate group stays, repeated passages are cut out,
documents are dropped or repeated to meet the sources' weights, and the rest is encoded.
All but the last stage return the columns they were given.

Defined results: documents with null or empty texts, or texts without a letter, leave at the first stage; a null id is an
id of its own that comes first; rows repeating an id are told apart by their texts, and of rows equal in both one
stays; ties go to the least id; a null source is a source of its own; columns beyond those of documents pass
through up to the last stage, whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from readloom.llm.bpe import encode_stage
from readloom.llm.common import forget, save, table
from readloom.llm.language_id import keep_identified
from readloom.llm.minhash import keep_one_of_each
from readloom.llm.mixing import mix_stage
from readloom.llm.repeats import drop_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keeps_columns(stage):
    """Run ``stage`` with columns beyond those of documents under names that it does not use."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = docs.toDF(*(c if c in COLUMNS else f"_own{i}" for i, c in enumerate(docs.columns)))
        return stage(spark, plain, sf_dir).toDF(*docs.columns)

    return run


STAGES = [
    ("language_id", _keeps_columns(keep_identified)),
    ("minhash", _keeps_columns(keep_one_of_each)),
    ("suffix_dedup", _keeps_columns(drop_repeats)),
    ("mixing", _keeps_columns(mix_stage)),
    ("bpe", encode_stage),
]

#: SQL expresses none of the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written, read again, and deleted when the next stage's are there."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, save(stage(spark, docs, sf_dir), name)
        if k:
            forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
