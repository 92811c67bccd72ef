"""The annotation job: one narrow projection over the filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import source_label, text_stance
from ..rules import domain
from ..rules.model import Rule
from .annotators import Row, leaves


def stance_labels(derive: str = "catalogue") -> dict[str, bool]:
    """Position of each known source label.

    ``catalogue`` uses the source catalogue. ``lists`` leaves out the labels that older stance
    lists did not carry, to reproduce results made with those lists.
    """
    if derive not in ("catalogue", "lists"):
        raise ValueError(f"derive must be 'catalogue' or 'lists', not {derive!r}")
    labels = {label: stance == "positive" for label, _, stance, _ in domain.CATALOGUE}
    if derive == "lists":
        for label in domain.UNLISTED:
            labels.pop(label)
    labels[domain.PHRASE_LABELS["positive"]] = True
    labels[domain.PHRASE_LABELS["negative"]] = False
    return labels


def source_stance(source: Column, labels: dict[str, bool]) -> Column:
    """Position implied by the source. The label list is fixed and short, so it is an IN-list."""
    pro = [k for k, v in labels.items() if v]
    con = [k for k, v in labels.items() if not v]
    return F.when(source.isin(pro), F.lit(True)).when(source.isin(con), F.lit(False))


def annotate(
    filings: DataFrame,
    rules: list[Rule] = domain.SOURCE_RULES,
    labels: dict[str, bool] | None = None,
    support: list[str] = domain.SUPPORT_PATTERNS,
    oppose: list[str] = domain.OPPOSE_PATTERNS,
    support_needs: list[str] | None = None,
    oppose_needs: list[str] | None = None,
) -> DataFrame:
    """Add the ``analysis`` struct: one leaf per registered annotator. Leaves that other jobs own
    start as null.

    ``support_needs`` and ``oppose_needs`` are literals of which every match of the patterns holds
    one; they default to those of the docket's own patterns and to none for others.
    """
    if support_needs is None:
        support_needs = domain.SUPPORT_NEEDS if support is domain.SUPPORT_PATTERNS else []
    if oppose_needs is None:
        oppose_needs = domain.OPPOSE_NEEDS if oppose is domain.OPPOSE_PATTERNS else []
    labels = stance_labels() if labels is None else labels
    body = F.col("text_data")
    # The optimizer keeps this as its own projection because the rules use it many times, so the
    # text is lower-cased and the source is found once per row.
    lowered = F.col("_lower")
    staged = filings.withColumn("_lower", F.lower(body)).withColumns(
        {
            "_source": source_label(rules, body, lowered),
            "_stance": text_stance(body, support, oppose, lowered, support_needs, oppose_needs),
        }
    )
    source = F.col("_source")
    row = Row(frozenset(filings.columns), source, F.col("_stance"), source_stance(source, labels))
    return staged.withColumn("analysis", F.struct(*leaves(row))).drop("_lower", "_source", "_stance")
