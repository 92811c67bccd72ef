"""Reproducible random samples per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import has_email
from .similarity import sample_order


# A group is cut to its first rows in this many lots before they meet in one task.
LOTS = 256


def _first_rows(rows: DataFrame, n: int, by: str, order: list[str], spread: str) -> DataFrame:
    """The ``n`` first rows of each ``by``, numbered in ``_r``; one task sees ``n * LOTS`` of a group at most."""
    lot = Window.partitionBy(by, F.pmod(F.xxhash64(spread), F.lit(LOTS))).orderBy(*order)
    cut = rows.withColumn("_r", F.row_number().over(lot)).filter(F.col("_r") <= n)
    whole = Window.partitionBy(by).orderBy(*order)
    return cut.withColumn("_r", F.row_number().over(whole)).filter(F.col("_r") <= n)


def random_sample(
    comments: DataFrame,
    n: int,
    seed: str,
    by: str | None = None,
    doc_id: str = "id_submission",
) -> DataFrame:
    """``n`` random rows of each ``by`` group (or of all rows), the same for the same ``seed``.

    Each group is first cut to ``n`` rows in every one of ``LOTS`` lots, which keeps the sample the same.
    """
    ordered = comments.withColumn("_order", sample_order(F.col(doc_id), seed))
    if by is None:
        return ordered.orderBy("_order", doc_id).limit(n).drop("_order")
    return _first_rows(ordered, n, by, ["_order", doc_id], doc_id).drop("_r", "_order")


def breach_candidates(
    comments: DataFrame,
    n: int,
    seed: str,
    by: str | None = None,
    email: str = "contact_email",
    breached: str = "breached",
    doc_id: str = "id_submission",
) -> DataFrame:
    """Addresses to check next: distinct e-mails of ``n`` random unchecked rows per source."""
    open_rows = comments.filter(has_email(F.col(email)) & F.col(breached).isNull())
    keys = [by] if by else []
    narrow = open_rows.select(doc_id, email, *keys)
    return random_sample(narrow, n, seed, by, doc_id).select(*keys, email).distinct()


def contact_sample(
    comments: DataFrame,
    seed: str,
    n: int = 200,
    max_rows: int | None = None,
    email: str = "contact_email",
    by: str = "source",
    doc_id: str = "id_submission",
) -> DataFrame:
    """``n`` random distinct contacts per source: ``by, email, doc_id, pick``.

    ``max_rows`` looks only at that many random rows per source, as a paged reader would.
    """
    rows = comments.filter(has_email(F.col(email))).select(doc_id, email, by)
    if max_rows is not None:
        rows = random_sample(rows, max_rows, seed, by, doc_id)
    first = (
        rows.withColumn("_pick", F.struct(sample_order(F.col(doc_id), seed).alias("order"), F.col(doc_id).alias("id")))
        .groupBy(by, email)
        .agg(F.min("_pick").alias("_pick"))
    )
    picked = _first_rows(first, n, by, ["_pick"], email)
    return picked.select(by, email, F.col("_pick.id").alias(doc_id), F.col("_r").alias("pick"))


def contact_rows(comments: DataFrame, sample: DataFrame, url_prefix: str, doc_id: str = "id_submission") -> DataFrame:
    """Export columns of the sampled contacts."""
    detail = comments.select(
        doc_id,
        F.get("filers", F.lit(0))["name"].alias("name"),
        F.col("date_received").alias("date"),
        F.col("text_data").alias("comment"),
    )
    return detail.join(sample, doc_id).select(
        "source",
        F.col("contact_email").alias("email"),
        "name",
        "date",
        "comment",
        F.concat(F.lit(url_prefix), F.col(doc_id)).alias("url"),
    )
