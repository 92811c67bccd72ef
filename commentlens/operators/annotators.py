"""Annotators by name: each turns a filing into one leaf of its ``analysis`` struct.

``annotate`` runs all that are registered. A job adds its own with ``register``; it becomes a further
leaf, after the fixed ones, without another pass over the filings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import flags, text
from ..schema import ANALYSIS


@dataclass(frozen=True)
class Row:
    """What annotators look at. ``source`` and ``stance`` are found once per row, before them."""

    columns: frozenset[str]
    source: Column
    stance: Column
    source_stance: Column

    def column(self, name: str, kind: str) -> Column:
        """The filing's column, or null where the filings have none."""
        return F.col(name) if name in self.columns else F.lit(None).cast(kind)

    @property
    def body(self) -> Column:
        return F.col("text_data")

    @property
    def proceedings(self) -> Column:
        return self.column("proceedings", "array<map<string,string>>")


Annotator = Callable[[Row], Column]

_REGISTERED: dict[str, Annotator] = {}


def register(name: str) -> Callable[[Annotator], Annotator]:
    """Names an annotator; a name has one annotator at a time."""

    def add(annotator: Annotator) -> Annotator:
        if name in _REGISTERED:
            raise ValueError(f"annotator {name!r} is registered already")
        _REGISTERED[name] = annotator
        return annotator

    return add


def unregister(name: str) -> None:
    del _REGISTERED[name]


def leaves(row: Row) -> list[Column]:
    """The leaves of ``analysis`` in schema order, then those of further annotators by name.

    A leaf without an annotator belongs to another job and starts as null.
    """
    kinds = {f.name: f.dataType for f in ANALYSIS.fields}
    more = sorted(set(_REGISTERED) - set(kinds))
    fixed = [(_REGISTERED[n](row) if n in _REGISTERED else F.lit(None).cast(kind)).alias(n) for n, kind in kinds.items()]
    return fixed + [_REGISTERED[n](row).alias(n) for n in more]


@register("fulladdress")
def _full_address(row: Row) -> Column:
    return flags.full_address(F.col("addressentity")) if "addressentity" in row.columns else F.lit(False)


@register("capsemail")
def _caps_email(row: Row) -> Column:
    return flags.caps_email(row.column("contact_email", "string"))


@register("source")
def _source(row: Row) -> Column:
    return row.source


@register("proceedings_keys")
def _proceedings_keys(row: Row) -> Column:
    return flags.proceeding_keys(row.proceedings)


@register("onsite")
def _onsite(row: Row) -> Column:
    return flags.onsite(row.proceedings)


@register("ingestion_method")
def _ingestion_method(row: Row) -> Column:
    return flags.ingestion_method(row.column("browser", "string"), row.proceedings)


@register("fingerprint")
def _fingerprint(row: Row) -> Column:
    return text.fingerprint(row.body)


@register("titleii")
def _title_ii(row: Row) -> Column:
    return F.coalesce(row.source_stance, row.stance)


@register("words")
def _words(row: Row) -> Column:
    return text.word_count(row.body)


@register("untaggable")
def _untaggable(row: Row) -> Column:
    return text.untaggable(row.body)
