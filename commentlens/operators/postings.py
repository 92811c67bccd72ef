"""Token tables, and phrase search over stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import english_tokens, query_terms, tokens

# Folders of a stored token table; a query opens those of its words.
BUCKETS = 64


def postings(docs: DataFrame, doc_id: str = "id_submission", text: str = "text_data") -> DataFrame:
    """One row per word occurrence: ``doc_id, field, term, pos``; both analyzers, no shuffle."""
    words = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("_standard"))
    both = words.select(
        "doc_id",
        F.explode(
            F.array(
                F.struct(F.lit("standard").alias("field"), F.col("_standard").alias("terms")),
                F.struct(F.lit("english").alias("field"), english_tokens(F.col("_standard")).alias("terms")),
            )
        ).alias("f"),
    )
    return both.select("doc_id", F.col("f.field").alias("field"), F.posexplode("f.terms").alias("pos", "term"))


def term_counts(docs: DataFrame, text: str = "text_data", english: bool = False) -> DataFrame:
    """Occurrences and document frequency per word.

    A document emits each occurrence and, apart from that, each distinct word once; one partial
    aggregation per map task then covers both counts.
    """
    words = tokens(F.col(text))
    if english:
        words = english_tokens(words)
    marked = docs.select(words.alias("_w")).select(
        F.explode(
            F.concat(
                F.transform("_w", lambda t: F.struct(t.alias("term"), F.lit(1).alias("n"), F.lit(0).alias("d"))),
                F.transform(F.array_distinct("_w"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("n"), F.lit(1).alias("d"))),
            )
        ).alias("p")
    )
    return marked.groupBy(F.col("p.term").alias("term")).agg(
        F.sum("p.n").alias("occurrences"), F.sum("p.d").alias("docs")
    )


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_postings(
    docs: DataFrame, path: str, doc_id: str = "id_submission", text: str = "text_data", buckets: int = BUCKETS
) -> None:
    """Store ``term, doc_id, pos`` of every word, in folders by word and sorted within files.

    For corpora that are searched again and again: a phrase then reads the folders of its words,
    and of these the row groups that hold them, instead of tokenizing all texts. The rebalance
    spreads the folder of a very common word over many files.
    """
    words = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(tokens(F.col(text))).alias("pos", "term"))
    rows = words.withColumn("bucket", _bucket(F.col("term"), buckets)).hint("rebalance", "bucket")
    rows.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_words(spark: SparkSession, path: str, words: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``term, doc_id, pos`` of the given words from a table that ``write_postings`` made."""
    wanted = sorted(set(words))
    numbers = spark.createDataFrame([(w,) for w in wanted], "term string").select(_bucket(F.col("term"), buckets)).distinct().collect()
    stored = spark.read.parquet(path).filter(F.col("bucket").isin([r[0] for r in numbers]))
    return stored.filter(F.col("term").isin(wanted)).drop("bucket")


def find_phrases(spark: SparkSession, path: str, phrases: Sequence[str], slop: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, phrase`` for each phrase a document holds, from stored words alone.

    A word at place ``pos`` that is the ``off``-th of a phrase votes for the start ``pos - off``. The
    phrase is there when, from some start on, all its words vote within ``slop``; words that it
    repeats need as many occurrences as places, in every run of these places. Both are windows with
    a range of values over the votes of one document for one phrase.
    """
    table = {p: query_terms(p) for p in dict.fromkeys(phrases)}
    if any(not 0 < len(terms) < 63 for terms in table.values()):
        raise ValueError("phrases must have 1 to 62 words")
    spelled = spark.createDataFrame([(p, i, t) for p, terms in table.items() for i, t in enumerate(terms)], "phrase string, off int, term string")
    found = read_words(spark, path, [t for terms in table.values() for t in terms], buckets)
    votes = found.join(F.broadcast(spelled), "term").select("doc_id", "phrase", "off", (F.col("pos") - F.col("off")).alias("start"))

    by_start = Window.partitionBy("doc_id", "phrase").orderBy("start")
    held = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("off"))).over(by_start.rangeBetween(0, slop))
    fits = F.lit(False)
    for phrase, terms in table.items():
        whole = held == F.lit((1 << len(terms)) - 1)
        for first, last, places in _repeats(terms):
            among = by_start.rangeBetween(0, last - first + slop)
            whole = whole & (F.sum(F.when(F.col("off") == first, 1)).over(among) >= places)
        fits = F.when(F.col("phrase") == phrase, whole).otherwise(fits)
    return votes.select("doc_id", "phrase", fits.alias("fits")).filter("fits").select("doc_id", "phrase").distinct()


def _repeats(terms: list[str]) -> list[tuple[int, int, int]]:
    """First and last place and number of places of every run of places of one word."""
    runs = []
    for word in dict.fromkeys(terms):
        at = [i for i, t in enumerate(terms) if t == word]
        runs += [(at[i], at[j], j - i + 1) for i in range(len(at)) for j in range(i + 1, len(at))]
    return runs
