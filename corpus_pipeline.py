"""From raw documents to packed sequences: five stages, each a table in and a table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.llm import decontaminate, line_dedup, ngram_join, packing, quality
from commentlens.llm.common import table
from commentlens.llm.tokens import public_tokenizer
from commentlens.spark_env import scratch_path

# Near-duplicate stages work on shingles of five words and a similarity of 0.8.
WORDS, PERCENT = 5, 80


def _named(docs: DataFrame) -> DataFrame:
    """Rows with a name by id and text: rows that share an id, or have none, are decided one by one."""
    return docs.withColumn("_name", F.xxhash64("doc_id", "text"))


def _keep(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whole rows whose ``key`` is among ``ids.doc_id``; a missing id is a name too."""
    names = ids.select(F.col("doc_id").alias("_kept")).distinct().hint("merge")
    return docs.join(names, docs[key].eqNullSafe(F.col("_kept")), "left_semi").drop("_name")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    rows = _named(docs)
    return _keep(rows, quality.judge(rows, "_name").filter("kept"), "_name")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that many share; one that loses all its words goes."""
    kept = line_dedup.drop_shared_lines(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")])
    with_text = kept.filter((F.col("n_dropped") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    counted = with_text.withColumn("n_chars", F.length("text").cast("long"))
    return counted.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    groups = ngram_join.jaccard_components(docs, WORDS, PERCENT)
    return _keep(docs, groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    rows = _named(docs)
    clean = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), doc_id="_name").filter("not contaminated")
    return _keep(rows, clean, "_name")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    return packing.pack(docs, public_tokenizer())


STAGES = [
    ("quality", quality_rules),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", near_duplicates),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

# Tokenizing and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
