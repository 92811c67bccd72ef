"""Join-based enrichment: breach lists, manual labels, the source catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import has_email
from ..rules import domain
from .skew import lookup


def email_breach_flags(comments: DataFrame, breaches: DataFrame, email: str = "contact_email") -> DataFrame:
    """``email, rows, breached`` per distinct address: true when the breach list names it.

    Addresses are reduced to one row each before the join, so an address that a large share of the
    comments uses costs one row in the shuffle.
    """
    used = comments.filter(has_email(F.col(email))).groupBy(F.col(email).alias("email")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    listed = breaches.select(F.col("email")).filter(has_email(F.col("email"))).distinct().withColumn(
        "_listed", F.lit(True)
    )
    return used.join(listed, "email", "left").select(
        "email", "rows", F.col("_listed").isNotNull().alias("breached")
    )


def breach_patch(
    comments: DataFrame,
    flags: DataFrame,
    email: str = "contact_email",
    doc_id: str = "id_submission",
) -> DataFrame:
    """Patch rows ``doc_id, breached`` for all comments with a checked address.

    ``flags`` has ``email, rows, breached``; the most used addresses go by broadcast.
    """
    keyed = comments.filter(has_email(F.col(email))).select(doc_id, F.col(email).alias("email"))
    return lookup(keyed, flags, "email", "rows", F.col(doc_id)).select(doc_id, "breached")


def manual_label_patch(
    comments: DataFrame, labels: DataFrame, label: str, doc_id: str = "id_submission"
) -> DataFrame:
    """Patch rows ``doc_id, sentiment_manual`` for labelled ids that exist in ``comments``."""
    wanted = labels.select(doc_id, F.col(label).alias("sentiment_manual"))
    return comments.select(doc_id).join(wanted, doc_id)


def catalogue(spark: SparkSession) -> DataFrame:
    """Source catalogue as a table: ``source, icon, stance, url``. Fixed size."""
    return spark.createDataFrame(domain.CATALOGUE, "source string, icon string, stance string, url string")
