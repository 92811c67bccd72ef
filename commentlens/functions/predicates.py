"""Named row filters. Every one is a pure function that returns a boolean column, never null."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reviewed:
    """Lists a person has reviewed: source labels and cluster ids per position."""

    positive_sources: Sequence[str] = ()
    negative_sources: Sequence[str] = ()
    positive_clusters: Sequence[str] = ()
    negative_clusters: Sequence[str] = ()


@dataclass(frozen=True)
class Tags:
    """The columns a position is read from; override to match another layout."""

    source: Column = field(default_factory=lambda: F.col("analysis.source"))
    stance: Column = field(default_factory=lambda: F.col("analysis.titleii"))
    manual: Column = field(default_factory=lambda: F.col("analysis.sentiment_manual"))
    sig_terms: Column = field(default_factory=lambda: F.col("analysis.sentiment_sig_terms_ordered"))
    untaggable: Column = field(default_factory=lambda: F.col("analysis.untaggable"))
    cluster: Column = field(default_factory=lambda: F.col("analysis.more_like_this.src_doc_id"))


def is_value(column: Column, value) -> Column:
    """``column == value`` with null counted as no."""
    return column.eqNullSafe(F.lit(value))


def in_list(column: Column, values: Sequence[str]) -> Column:
    """Membership with null counted as no; an empty list matches nothing."""
    if not values:
        return F.lit(False)
    return F.coalesce(column.isin(list(values)), F.lit(False))


def _position(tags: Tags, value: bool, sources: Sequence[str], clusters: Sequence[str]) -> Column:
    return (
        is_value(tags.manual, value)
        | is_value(tags.stance, value)
        | is_value(tags.sig_terms, value)
        | in_list(tags.source, sources)
        | in_list(tags.cluster, clusters)
    )


def positive(tags: Tags, reviewed: Reviewed) -> Column:
    return _position(tags, True, reviewed.positive_sources, reviewed.positive_clusters)


def negative(tags: Tags, reviewed: Reviewed) -> Column:
    return _position(tags, False, reviewed.negative_sources, reviewed.negative_clusters)


def untagged(tags: Tags, reviewed: Reviewed) -> Column:
    """Unknown source, long enough to tag, and nothing has set a position yet."""
    known_clusters = [*reviewed.negative_clusters, *reviewed.positive_clusters]
    return (
        is_value(tags.source, "unknown")
        & ~is_value(tags.untaggable, True)
        & tags.manual.isNull()
        & tags.stance.isNull()
        & tags.sig_terms.isNull()
        & ~in_list(tags.cluster, known_clusters)
    )


def needs_review(tags: Tags, reviewed: Reviewed) -> Column:
    """No position tag, and the source is on no reviewed list."""
    known = [*reviewed.positive_sources, *reviewed.negative_sources]
    return (
        tags.stance.isNull()
        & tags.manual.isNull()
        & tags.sig_terms.isNull()
        & ~in_list(tags.source, known)
    )


def seed_eligible(tags: Tags) -> Column:
    """May start a cluster: unknown source, no cluster yet, no position from text or source."""
    return is_value(tags.source, "unknown") & tags.cluster.isNull() & tags.stance.isNull()


def has_email(email: Column) -> Column:
    return F.coalesce(email != "", F.lit(False))


def on_day(when: Column, day: str) -> Column:
    """Half-open one-day range; prunes partitions when ``when`` is the partition column."""
    start = F.to_timestamp(F.lit(day))
    return (when >= start) & (when < start + F.expr("interval 1 day"))


def between_days(when: Column, start: str, end: str) -> Column:
    """``[start, end)``."""
    return (when >= F.to_timestamp(F.lit(start))) & (when < F.to_timestamp(F.lit(end)))
