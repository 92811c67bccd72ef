"""Reading raw filings."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.flags import shrink_proceedings
from ..schema import ADDRESS, ADDRESSES, FILING

EARLIEST = "2000-01-01"
NO_DAY = "1970-01-01"

# The address comes as one object or as a list of them, so the reader keeps its JSON text.
RAW = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "addressentity" else f for f in FILING.fields]
)


def parse_addresses(raw: Column) -> Column:
    """JSON text of an address object or list, as a list."""
    trimmed = F.ltrim(raw)
    return F.when(trimmed.startswith("["), F.from_json(raw, ADDRESSES)).when(
        trimmed.startswith("{"), F.array(F.from_json(raw, ADDRESS))
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on input that comes in fewer splits than there are cores.

    Text work is far dearer than the read, so a few big row groups would leave most cores idle.
    Larger inputs have more splits than that and are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def shape_filings(raw: DataFrame) -> DataFrame:
    """Rows read with ``RAW``, brought to the ``FILING`` schema."""
    return raw.withColumns(
        {
            "addressentity": parse_addresses(F.col("addressentity")),
            "proceedings": shrink_proceedings(F.col("proceedings")),
        }
    ).select(*FILING.fieldNames())


def read_filings(spark: SparkSession, path: str, docket: str | None = None) -> DataFrame:
    """JSON-lines filings. The explicit schema is the whitelist: other fields are never parsed.

    ``docket`` keeps the filings of one proceeding. Files are split by Spark's own reader settings (``spark.sql.files.*``).
    """
    return shape_filings(of_docket(spark.read.schema(RAW).json(path), docket))


def land(spark: SparkSession, path: str, landing: str, batch: str) -> None:
    """Copy raw JSON lines to ``<landing>/day=<day>/batch=<batch>``, by day of dissemination.

    Lines stay as they came, so fields outside today's whitelist are kept. Only the date is parsed;
    lines without one go to 1970-01-01. Landing a batch again replaces it.
    """
    lines = spark.read.text(path)
    when = F.from_json("value", "date_disseminated timestamp")["date_disseminated"]
    day = F.coalesce(F.to_date(when), F.to_date(F.lit(NO_DAY))).alias("day")
    (
        lines.select("value", day, F.lit(batch).alias("batch"))
        .hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch")
        .text(landing)
    )


def read_landed(
    spark: SparkSession, landing: str, first: str | None = None, last: str | None = None, docket: str | None = None
) -> DataFrame:
    """Landed filings of the days from ``first`` to ``last``, both included. Other days' files are not
    opened. An id that several batches hold comes as often."""
    raw = spark.read.schema(T.StructType([*RAW.fields, T.StructField("day", T.DateType())])).json(landing)
    if first is not None:
        raw = raw.filter(F.col("day") >= F.to_date(F.lit(first)))
    if last is not None:
        raw = raw.filter(F.col("day") <= F.to_date(F.lit(last)))
    return shape_filings(of_docket(raw, docket))


def of_docket(raw: DataFrame, docket: str | None) -> DataFrame:
    """Raw rows of one docket, or all. Its name is gone once proceedings are shrunk."""
    return raw if docket is None else raw.filter(in_docket(F.col("proceedings"), docket))


def in_docket(proceedings: Column, name: str) -> Column:
    """Some proceeding entry carries this docket name. Apply before the entries are shrunk."""
    return F.exists(proceedings, lambda p: F.coalesce(p["name"] == name, F.lit(False)))


def between(
    filings: DataFrame, gte: str | None = None, lte: str | None = None, column: str = "date_disseminated"
) -> DataFrame:
    """Rows inside both inclusive bounds. One bound alone implies the other: now, or 2000-01-01."""
    if gte is None and lte is None:
        return filings
    gte = gte or EARLIEST
    lte = lte or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return filings.filter(F.col(column).between(F.to_timestamp(F.lit(gte)), F.to_timestamp(F.lit(lte))))


def by_date(filings: DataFrame, column: str = "date_disseminated", doc_id: str = "id_submission") -> DataFrame:
    """Ascending by date, ties by id. A range-partitioned sort; use it for exports only."""
    return filings.orderBy(column, doc_id)
