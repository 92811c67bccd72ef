"""Reports by source and position.

All counts come from one pass: rows are reduced to one line per source, and every report is cut
from that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates
from ..functions.predicates import Reviewed, Tags
from ..spark_env import cut_lineage


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def by_source(
    comments: DataFrame, reviewed: Reviewed, tags: Tags | None = None, breached: Column | None = None,
    when: Column | None = None,
) -> DataFrame:
    """One row per source with every count the reports use.

    Computed at once and checkpointed: the reports read it several times, each with other columns,
    and would otherwise go through the whole corpus each time.
    """
    tags = tags or Tags()
    breached = F.col("analysis.breached") if breached is None else breached
    when = F.col("date_disseminated") if when is None else when
    pos, neg = predicates.positive(tags, reviewed), predicates.negative(tags, reviewed)
    flat = comments.select(
        tags.source.alias("source"),
        pos.alias("pos"),
        neg.alias("neg"),
        tags.sig_terms.alias("sig"),
        breached.alias("breached"),
        when.alias("when"),
    )
    counts = flat.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"),
        F.max("when").alias("latest"),
        _count(F.col("pos")).alias("positive"),
        _count(F.col("neg")).alias("negative"),
        _count(F.col("pos") & F.col("neg")).alias("conflict"),
        _count(F.col("pos") & F.col("sig")).alias("sig_true"),
        _count(F.col("pos") & ~F.col("sig")).alias("sig_false"),
        _count(F.col("breached")).alias("breached"),
        _count(~F.col("breached")).alias("unbreached"),
    )
    return cut_lineage(counts)


def corpus_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("total").alias("total"), F.max("latest").alias("latest"))


def position_by_source(counts: DataFrame, side: str, size: int = 25) -> DataFrame:
    """Top sources of one side. ``unknown`` takes a place in the list and is removed afterwards."""
    top = counts.filter(F.col(side) > 0).orderBy(F.desc(side), "source").limit(size)
    return top.filter(F.col("source") != "unknown").select("source", F.col(side).alias("n"))


def breach_by_source(counts: DataFrame, size: int = 25) -> DataFrame:
    """Breached and unbreached comments of the sources with most checked addresses."""
    checked = counts.withColumn("checked", F.col("breached") + F.col("unbreached")).filter("checked > 0")
    return checked.orderBy(F.desc("checked"), "source").limit(size).select("source", "breached", "unbreached")


def _percent(part: Column, whole: Column) -> Column:
    """Rounds half up."""
    return F.floor(F.lit(100) * part / whole + F.lit(0.5)).cast("long")


def breach_percentages(breach_counts: DataFrame) -> DataFrame:
    whole = F.col("breached") + F.col("unbreached")
    return breach_counts.select(
        "source",
        _percent(F.col("breached"), whole).alias("breached_pct"),
        _percent(F.col("unbreached"), whole).alias("unbreached_pct"),
        whole.alias("comments"),
    )


def catalogue_counts(catalogue: DataFrame, counts: DataFrame) -> DataFrame:
    """Catalogue rows with the count of their own side, whatever its rank; 0 where there is none."""
    side = lambda name: counts.select("source", F.lit(name).alias("stance"), F.col(name).alias("n"))
    listed = side("positive").unionByName(side("negative")).filter(F.col("source") != "unknown")
    return catalogue.join(listed, ["source", "stance"], "left").select(
        *catalogue.columns, F.coalesce(F.col("n"), F.lit(0)).alias("n")
    )


def exemplars(comments: DataFrame, source: Column, doc_id: str = "id_submission", text: str = "text_data") -> DataFrame:
    """Sample text per source: the comment with the smallest id."""
    return comments.groupBy(source.alias("source")).agg(F.min_by(text, doc_id).alias("sample"))


def _as_map(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Short report table as one map. Rows are bounded by the report's size."""
    return df.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("source"), value.alias("v"))))).alias(name)
    )


def full_report(counts: DataFrame, catalogue: DataFrame | None = None, size: int = 25) -> DataFrame:
    """The whole report as one row."""
    # Every input is an ungrouped aggregate and so has exactly one row.
    totals = counts.agg(
        F.sum("total").alias("total"),
        F.max("latest").alias("latest"),
        F.sum("positive").alias("total_positive"),
        F.sum("negative").alias("total_negative"),
        F.sum("conflict").alias("conflict"),
        F.nullif(F.greatest(F.sum("sig_true"), F.sum("sig_false")), F.lit(0)).alias("sig_terms"),
    )
    pieces = [
        _as_map(position_by_source(counts, "positive", size), F.col("n"), "positive_by_source"),
        _as_map(position_by_source(counts, "negative", size), F.col("n"), "negative_by_source"),
        _as_map(breach_by_source(counts, size), F.struct("breached", "unbreached"), "breached"),
    ]
    if catalogue is not None:
        pieces.append(_as_map(catalogue, F.struct(*(c for c in catalogue.columns if c != "source")), "sources"))
    row = totals
    for piece in pieces:
        row = row.crossJoin(F.broadcast(piece))
    with_sig = F.when(
        F.col("sig_terms").isNotNull(),
        F.map_concat(
            F.map_filter("positive_by_source", lambda k, v: k != "sig_terms"),
            F.create_map(F.lit("sig_terms"), F.col("sig_terms")),
        ),
    ).otherwise(F.col("positive_by_source"))
    return row.withColumn("positive_by_source", with_sig).drop("sig_terms")
