"""Words that set one group of documents apart from another, by mutual information."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens


def _cell(nij: Column, ni: Column, nj: Column, n: Column) -> Column:
    return F.when(nij > 0, nij / n * F.log(n * nij / (ni * nj))).otherwise(F.lit(0.0))


def mutual_information(n11: Column, n10: Column, n1: Column, n0: Column) -> Column:
    """``n11``/``n10``: documents with the word inside/outside the group; ``n1``/``n0``: group sizes."""
    n11, n10, n1, n0 = (c.cast("double") for c in (n11, n10, n1, n0))
    n01, n00 = n1 - n11, n0 - n10
    n = n1 + n0
    has, lacks = n11 + n10, n01 + n00
    return (
        _cell(n11, has, n1, n)
        + _cell(n10, has, n0, n)
        + _cell(n01, lacks, n1, n)
        + _cell(n00, lacks, n0, n)
    )


def significant_terms(
    docs: DataFrame,
    foreground: Column,
    background: Column | None = None,
    min_docs: int = 3,
    size: int = 10,
    text: str = "text_data",
) -> DataFrame:
    """Top words of ``foreground`` against ``background``.

    Without a background the whole corpus is compared: foreground documents are taken out of it
    first, so the two groups never overlap. With one, rows in neither group are ignored and a row
    in both counts as foreground only. Words more common in the background are dropped.
    """
    fg = F.coalesce(foreground, F.lit(False))
    bg = F.lit(True) if background is None else F.coalesce(background, F.lit(False))
    grouped = docs.select(F.col(text).alias("_text"), fg.alias("_fg"), (bg & ~fg).alias("_bg")).filter(
        F.col("_fg") | F.col("_bg")
    )
    sizes = grouped.agg(
        F.sum(F.col("_fg").cast("long")).alias("n1"), F.sum(F.col("_bg").cast("long")).alias("n0")
    )
    # Distinct words are taken inside the row, so the only shuffle is the final count per word.
    terms = grouped.select("_fg", F.explode(F.array_distinct(tokens(F.col("_text")))).alias("term"))
    counts = terms.groupBy("term").agg(
        F.sum(F.col("_fg").cast("long")).alias("n11"), F.sum((~F.col("_fg")).cast("long")).alias("n10")
    )
    scored = (
        counts.filter(F.col("n11") >= min_docs)
        .crossJoin(F.broadcast(sizes))
        .filter(F.col("n11") * F.col("n0") > F.col("n10") * F.col("n1"))
        .withColumn("mi", F.round(mutual_information(F.col("n11"), F.col("n10"), F.col("n1"), F.col("n0")), 9))
    )
    return scored.orderBy(F.desc("mi"), "term").limit(size).select("term", "n11", "n10", "mi")


def term_consensus(term_lists: list[DataFrame], at_least: int = 2) -> DataFrame:
    """Words that recur in several lists, with the number of lists."""
    stacked = reduce(DataFrame.unionByName, (t.select("term") for t in term_lists))
    return stacked.groupBy("term").agg(F.count(F.lit(1)).alias("lists")).filter(F.col("lists") >= at_least)
