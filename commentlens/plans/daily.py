"""Batch jobs over the comment table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates
from ..operators.annotate import annotate
from ..schema import ROW_LEAVES
from ..sources import filings, store


def default_day(today: date | None = None) -> str:
    return ((today or date.today()) - timedelta(days=2)).isoformat()


def ingest(spark: SparkSession, raw: DataFrame, table: str, **rules) -> None:
    """Annotate filings and replace the stored rows with the same id."""
    stamped = annotate(raw, **rules).withColumn(store.ORDER, F.current_timestamp())
    store.upsert(spark, table, stamped)


def run_day(
    spark: SparkSession, source: str, table: str, day: str | None = None, docket: str | None = None, landed: bool = False, **rules
) -> None:
    """One day, optionally of one docket, from the filing files into the table. A second run gives
    the same table. Of files that ``filings.land`` has written (``landed``) only that day's are read."""
    day = day or default_day()
    raw = filings.read_landed(spark, source, day, day, docket) if landed else filings.read_filings(spark, source, docket)
    ingest(spark, raw.filter(predicates.on_day(F.col("date_disseminated"), day)), table, **rules)


def reannotate_patch(comments: DataFrame, day: str | None = None, limit: int | None = None, **rules) -> DataFrame:
    """New row-derived leaves for one day, or for all rows whose source is unknown.

    ``titleii`` and ``untaggable`` are listed as present only when the new annotation sets them, so
    an earlier value stays otherwise. ``limit`` is for trial runs and takes the smallest ids.
    """
    if day is not None:
        chosen = comments.filter(predicates.on_day(F.col("date_disseminated"), day))
        if store.DAY in comments.columns:  # the stored table is partitioned by it
            chosen = chosen.filter(F.col(store.DAY) == F.lit(day).cast(comments.schema[store.DAY].dataType))
    else:
        chosen = comments.filter(predicates.is_value(F.col("analysis.source"), "unknown"))
    if limit is not None:
        chosen = chosen.orderBy(store.KEY).limit(limit)
    fresh = annotate(chosen.drop("analysis"), **rules)
    names = [f.name for f in ROW_LEAVES]
    sparse = {"titleii": F.col("analysis.titleii").isNotNull(), "untaggable": F.col("analysis.untaggable")}
    present = F.filter(
        F.array(*(F.when(sparse.get(n, F.lit(True)), F.lit(n)) for n in names)), lambda n: n.isNotNull()
    )
    return fresh.select(store.KEY, *(F.col(f"analysis.{n}").alias(n) for n in names), present.alias("present"))


def reannotate(spark: SparkSession, table: str, day: str | None = None, limit: int | None = None, **rules) -> None:
    patch = reannotate_patch(store.read_comments(spark, table, None), day, limit, **rules)
    store.update_analysis(spark, table, patch, present="present")
