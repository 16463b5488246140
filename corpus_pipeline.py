"""A corpus pipeline of five stages over the documents table.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept.
All but the last return the columns of documents, whatever further columns docs has and
whatever they are called.  An empty table gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, table
from tessera.llm.decontamination import decontaminate
from tessera.llm.mixing import mix
from tessera.llm.near_duplicates import near_duplicates
from tessera.llm.quality_rules import quality_rules
from tessera.llm.queries import tokenizer_path
from tessera.llm.tokens import tokenize

#: Near duplicates in the pipeline: five-word shingles, similarity of 0.8 or more.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts have too few words and go.  Rows are judged one by one; rows of
    one doc_id, repeated ones and those without an id included, stay if one of them is kept.
    """
    verdict = quality_rules(docs, table(spark, sf_dir, "labels"))
    return _only(docs, verdict.filter("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id.

    Null and empty texts are duplicates of nothing and stay, as do rows without an id.  Repeated
    rows of a doc_id stay or go together.
    """
    return _only(docs, near_duplicates(docs, NEAR_PERCENT).filter("kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, judged row by row; null and empty texts stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it.

    Null and empty texts have no words: they are taken as often as their keys say, which costs
    nothing.  The null source is a source of its own; repeated rows are taken alike.
    """
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as seekable shards; per written document its place, length and checksum.

    Rows come in order of doc_id (null first), then text; every row is written, null and empty
    texts as their end id alone.
    """
    return tokenize(docs, tokenizer_path())


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is among the kept ones; rows of one doc_id, null included, stay or go together."""
    ids = kept.select(F.col("doc_id").alias("id")).distinct()
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    return whole.join(ids, F.col("row.doc_id").eqNullSafe(F.col("id")), "left_semi").select("row.*")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: The isolation forest's random splits can't be expressed in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
