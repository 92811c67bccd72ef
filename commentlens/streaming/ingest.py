"""Continuous ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.annotate import annotate
from ..sources import filings, store


def filing_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, docket: str | None = None) -> DataFrame:
    """New filing files as a stream, optionally those of one docket."""
    raw = spark.readStream.schema(filings.RAW).option("maxFilesPerTrigger", files_per_batch).json(path)
    return filings.shape_filings(filings.of_docket(raw, docket))


def drop_repeats(stream: DataFrame, key: str | list[str], when: str, horizon: str) -> DataFrame:
    """First arrival of each key. State is dropped once the watermark has passed ``horizon``."""
    keys = [key] if isinstance(key, str) else key
    return stream.withWatermark(when, horizon).dropDuplicatesWithinWatermark(keys)


def drop_repeated_versions(stream: DataFrame, key: str = store.KEY, horizon: str = "7 days") -> DataFrame:
    """Each version of a filing once: rows with the same id and content that arrive within ``horizon``
    of the first are dropped, a correction of the same id is not.

    The clock is the arrival (the time of the batch), so a filing of any date is never too late.
    """
    content = F.sha2(F.to_json(F.struct(*stream.columns)), 256)
    arrived = stream.withColumns({"_content": content, "_arrived": F.current_timestamp()})
    return drop_repeats(arrived, [key, "_content"], "_arrived", horizon).drop("_content", "_arrived")


def daily_volume(stream: DataFrame, when: str, by: list[Column], horizon: str, window: str = "1 day") -> DataFrame:
    """Comments per day and group over event time."""
    return (
        stream.withWatermark(when, horizon)
        .groupBy(F.window(when, window).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def volume_by_source(
    stream: DataFrame, horizon: str, window: str = "1 day", when: str = "date_disseminated", **rules
) -> DataFrame:
    """Filings per window of event time, source and stance (``positive``, ``negative`` or ``none``).

    Filings may come in any order; those more than ``horizon`` behind the latest are left out, and
    a window is given out once it can no longer change. Filings without a date are in no window.
    """
    stance = F.col("analysis.titleii")
    by = [
        F.col("analysis.source").alias("source"),
        F.when(stance, "positive").when(~stance, "negative").otherwise("none").alias("stance"),
    ]
    return daily_volume(annotate(stream, **rules), when, by, horizon, window)


def upsert_stream(
    stream: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, repeats: str | None = "7 days", **rules
) -> StreamingQuery:
    """Annotate each batch and upsert it. Late rows rewrite their own day and no other.

    ``trigger`` goes to the stream writer; without one all available rows are taken and it ends.
    Versions that arrive again within ``repeats`` are dropped before the batch (``None`` keeps them);
    what has been seen is kept in ``checkpoint`` and outlives a restart.

    The upsert is idempotent and becomes visible as a whole, so a batch that is replayed after a
    failure leaves the same table.
    """
    if repeats is not None:
        stream = drop_repeated_versions(stream, horizon=repeats)

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = annotate(batch, **rules).withColumn(store.ORDER, F.current_timestamp())
        store.upsert(batch.sparkSession, table, stamped)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Closed results to Parquet files, each row once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
