"""Shared steps: reading inputs, hashes of texts, sums along an order that no single task holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..spark_env import materialize

WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inputs(df: DataFrame, doc_id: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """Only ``doc_id, text`` and ``more``: other columns cannot clash with an operator's own."""
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *more)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_hash(text: Column) -> Column:
    """With the id, this names a row by content: equal rows share results, others do not."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def running_sums(
    df: DataFrame, order: list[str], sums: dict[str, Column], name: str, within: str | None = None
) -> DataFrame:
    """``df`` with, for each of ``sums``, the sum over all earlier rows (of the same ``within``).

    Rows are dealt out by ranges of ``order`` and written with their range's number. Each range
    adds up by itself; what lies before it comes from one small row per range.
    """
    keys = [within] if within else []
    ranged = materialize(
        df.repartitionByRange(*keys, *order).select("*", F.spark_partition_id().alias("_range")), name
    )
    totals = ranged.groupBy("_range", *keys).agg(*(F.sum(v).alias(k) for k, v in sums.items()))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_range", *keys, *(F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"_b_{k}") for k in sums))
    own = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(F.broadcast(before), ["_range", *keys])  # one row a range
    return joined.select(
        *df.columns,
        *((F.col(f"_b_{k}") + F.coalesce(F.sum(v).over(own), F.lit(0))).cast("long").alias(k) for k, v in sums.items()),
    )


def ship(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, once: their functions import it."""
    import shutil
    import tempfile
    from pathlib import Path

    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if getattr(context, "_shipped_package", None) == str(package):
        return
    folder = tempfile.mkdtemp(prefix="package-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    context._shipped_package = str(package)
