"""Jobs that find tags and write them into the comment table.

Every job reads the table, makes a patch with one of the operators and merges it; only the days that
the patched rows live in are rewritten. ``begin`` and ``end`` limit the rows to ``[begin, end)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates
from ..functions.predicates import Reviewed, Tags
from ..operators.clusters import cluster_patch
from ..operators.enrich import breach_patch, email_breach_flags, manual_label_patch
from ..operators.phrases import phrase_tag
from ..operators.ranking import bm25_scores, relevance_tag
from ..operators.similarity import Params, build_index
from ..rules import domain
from ..sources import store

PHRASES = {"positive": domain.SUPPORT_PHRASES, "negative": domain.OPPOSE_PHRASES}


def in_window(comments: DataFrame, begin: str | None = None, end: str | None = None, when: str = "date_disseminated") -> DataFrame:
    """Rows in ``[begin, end)``; of the stored table only the partitions of these days are read."""
    partitioned = store.DAY in comments.columns
    if begin is not None:
        start = F.to_timestamp(F.lit(begin))
        comments = comments.filter(F.col(when) >= start)
        comments = comments.filter(F.col(store.DAY) >= F.to_date(start)) if partitioned else comments
    if end is not None:
        stop = F.to_timestamp(F.lit(end))
        comments = comments.filter(F.col(when) < stop)
        comments = comments.filter(F.col(store.DAY) <= F.to_date(stop)) if partitioned else comments
    return comments


def _untagged(spark: SparkSession, table: str, reviewed: Reviewed, begin: str | None, end: str | None) -> DataFrame:
    return in_window(store.read_comments(spark, table, None), begin, end).filter(predicates.untagged(Tags(), reviewed))


def tag_phrases(
    spark: SparkSession, table: str, side: str, reviewed: Reviewed = Reviewed(), begin: str | None = None, end: str | None = None
) -> None:
    """Untagged comments that hold one of the side's phrases (slop 3) get its source label."""
    found = phrase_tag(_untagged(spark, table, reviewed, begin, end), PHRASES[side], domain.PHRASE_LABELS[side])
    store.update_analysis(spark, table, found)


def tag_relevance(
    spark: SparkSession, table: str, k: int, reviewed: Reviewed = Reviewed(), begin: str | None = None, end: str | None = None
) -> None:
    """The ``k`` untagged comments that the ranking query fits best get the significant-terms tag.

    Word statistics come from the whole table.
    """
    rows = _untagged(spark, table, reviewed, begin, end)
    scores = bm25_scores(rows, domain.RANKING_CLAUSES, domain.RANKING_PHRASE, corpus=store.read_comments(spark, table, None))
    store.update_analysis(spark, table, relevance_tag(scores, k))


def cluster_day(spark: SparkSession, table: str, day: str | None = None, params: Params = Params(), min_cluster: int = 100) -> None:
    """Clusters that start from the comments of one day, or from all; any comment may join them."""
    comments = store.read_comments(spark, table, None)
    patch = cluster_patch(comments, build_index(comments, params), day=day, min_cluster=min_cluster)
    store.update_analysis(spark, table, patch)


def flag_breaches(spark: SparkSession, table: str, breaches: DataFrame, begin: str | None = None, end: str | None = None) -> None:
    """Sets ``breached`` where it is not set yet; ``breaches`` has a column ``email``."""
    rows = in_window(store.read_comments(spark, table, None), begin, end).filter(F.col("analysis.breached").isNull())
    store.update_analysis(spark, table, breach_patch(rows, email_breach_flags(rows, breaches)))


def label_manually(spark: SparkSession, table: str, labels: DataFrame, label: str = "label") -> None:
    """Writes the positions that people gave: ``labels`` has the comment id and a boolean."""
    store.update_analysis(spark, table, manual_label_patch(store.read_comments(spark, table, None), labels, label, store.KEY))
