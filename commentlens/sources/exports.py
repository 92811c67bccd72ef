"""Files for people and for the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tab_separated(rows: DataFrame, path: str, by: str = "source") -> None:
    """Header line, tabs, quotes only where needed; one folder per source."""
    rows.write.mode("overwrite").partitionBy(by).option("sep", "\t").option("header", True).option(
        "quote", '"'
    ).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def report_json(report: DataFrame) -> DataFrame:
    """The one-row report as one JSON text with the time it was made."""
    stamped = report.withColumn("updated", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return stamped.select(F.to_json(F.struct(*stamped.columns)).alias("value"))


def write_report(report: DataFrame, path: str) -> None:
    report_json(report).coalesce(1).write.mode("overwrite").text(path)
