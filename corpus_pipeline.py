"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``. Null and empty texts are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import op1_packing, op2_decontamination, op3_substring, op6_near_dup, op10_quality
from footfall.llm.common import ship, stored
from footfall.llm.queries import table, vocabulary

#: Words that a passage needs at least to count as repeated.
PASSAGE_WORDS = 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither junk nor toxic."""
    ship(spark)
    return op10_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles.

    Rows are told apart by a key of their own, so rows with repeated or null ids are judged like
    any others: of equal rows one stays, and a null id stays only if no row of its group has one.
    """
    ship(spark)
    key = "_".join(["row", *docs.columns])  # no column's name
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    found = op6_near_dup.near_duplicates(texts, width=5, threshold=0.8)
    groups = found.select(F.col("doc_id").alias(key), "component_id").join(keyed.select(key, "doc_id"), key)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    first = groups.groupBy("component_id").agg(F.min_by(key, order).alias(key)).select(key)
    return keyed.join(first, key, "left_semi").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier; all documents stay."""
    ship(spark)
    out = op3_substring.remove_repeats(docs, PASSAGE_WORDS, with_text=True).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by its own text."""
    ship(spark)
    return op2_decontamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return op1_packing.pack(docs, vocabulary()).drop("loss")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't express these stages; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
