"""Turn rule data into one first-match expression."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules.model import Rule
from .binding import let


def last_sentence(text: Column) -> Column:
    """Second-last piece between full stops; null when there is no full stop."""
    return F.try_element_at(F.split(text, r"\.", -1), F.lit(-2))


def _any(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


def _all(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)


def literal_in(text: Column, phrase: str) -> Column:
    """Plain substring test.

    A literal regular expression is found with the skipping search of Boyer and Moore. For long
    texts that is several times faster than ``contains``, which looks at every byte.
    """
    if len(phrase) < 4 or "\\E" in phrase:
        return text.contains(phrase)
    return text.rlike(f"\\Q{phrase}\\E")


# Letters outside ASCII that a case-blind match treats as one of ``i``, ``k`` or ``s``.
_FOLDING_LETTERS = "[\u0130\u0131\u017f\u212a]"


def _may_match(text: Column, lowered: Column, needs: Iterable[str], ignore_case: bool) -> Column:
    if not ignore_case:
        return _any(literal_in(text, n) for n in needs)
    return _any(literal_in(lowered, n.lower()) for n in needs) | text.rlike(_FOLDING_LETTERS)


def regex_any(
    text: Column,
    patterns: Iterable[str],
    ignore_case: bool = True,
    needs: Iterable[str] = (),
    lowered: Column | None = None,
) -> Column:
    """True when any pattern is found; case folding covers all of Unicode.

    ``needs`` are literals of which every match holds one; other texts skip the patterns.
    """
    flags = "(?iu)" if ignore_case else ""
    found = text.rlike(flags + "|".join(f"(?:{p})" for p in patterns))
    needs = list(needs)
    if not needs:
        return found
    return _may_match(text, F.lower(text) if lowered is None else lowered, needs, ignore_case) & found


def _group(rule: Rule, patterns: tuple[str, ...], text: Column, lowered: Column) -> Column:
    if rule.mode == "regex_search":
        return regex_any(text, patterns, rule.ignore_case, rule.needs, lowered)
    if rule.mode == "regex_anchored":
        flags = "(?iuU)" if rule.ignore_case else "(?U)"
        return text.rlike(flags + r"^\s*(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")
    side = lowered if rule.ignore_case else text
    wanted = [p.lower() if rule.ignore_case else p for p in patterns]
    if rule.mode == "prefix":
        return _any(side.startswith(p) for p in wanted)
    return _any(literal_in(side, p) for p in wanted)


def rule_condition(rule: Rule, text: Column, lowered: Column) -> Column:
    if rule.target == "last_sentence":
        sentence = last_sentence(text)
        cond = _all(_group(rule, g, sentence, F.lower(sentence)) for g in rule.groups)
        if rule.needs:
            cond = _may_match(text, lowered, rule.needs, rule.ignore_case) & cond
        return F.coalesce(cond, F.lit(False))
    return _all(_group(rule, g, text, lowered) for g in rule.groups)


def _anchor(phrase: str) -> str | None:
    """Longest word that any text with this phrase holds between two spaces, in lower case."""
    inner = phrase.lower().split(" ")[1:-1]
    return max(inner, key=len) if inner and any(inner) else None


def anchor_words(rule: Rule) -> list[str] | None:
    """Words of which every text the rule fires on holds one; null when there is no such list."""
    if rule.mode not in ("contains", "prefix") or rule.target != "text":
        return None
    lists = [[_anchor(p) for p in group] for group in rule.groups]
    usable = [words for words in lists if all(words)]
    return min(usable, key=len) if usable else None


def _rule_table(ranked: list[tuple[int, Rule, list[str]]]) -> Column:
    """Phrase rules as a literal array, so that the plan holds data and not one test per phrase."""

    def strings(values: Iterable[str]) -> Column:
        return F.array(*map(F.lit, values))

    rows = []
    for rank, rule, anchors in ranked:
        groups = [strings(p.lower() if rule.ignore_case else p for p in group) for group in rule.groups]
        rows.append(
            F.struct(
                F.lit(rank).alias("rank"),
                F.lit(rule.label).alias("label"),
                F.lit(rule.ignore_case).alias("fold"),
                F.lit(rule.mode == "prefix").alias("head"),
                strings(anchors).alias("anchors"),
                F.array(*groups).alias("groups"),
            )
        )
    return F.array(*rows)


def source_label(rules: list[Rule], text: Column, lowered: Column) -> Column:
    """First rule that fires, ``empty`` for missing text, ``unknown`` when none does.

    ``lowered`` must be a column that already holds ``lower(text)``, so that it is computed once
    per row and not once per rule. Phrase rules are looked up by their anchor words: one hash
    lookup per word of the text finds the few rules worth trying. Rules without anchor words are
    tried in turn. The rule that comes first in the list wins in either case.
    """
    indexed, loose = [], []
    for rank, rule in enumerate(rules):
        anchors = anchor_words(rule)
        indexed.append((rank, rule, anchors)) if anchors else loose.append((rank, rule))

    hit = F.lit(None).cast("struct<rank:int,label:string>")
    for rank, rule in reversed(loose):
        found = F.struct(F.lit(rank).alias("rank"), F.lit(rule.label).alias("label"))
        hit = F.when(rule_condition(rule, text, lowered), found).otherwise(hit)
    if indexed:
        words = sorted({w for _, _, anchors in indexed for w in anchors})
        table = _rule_table(indexed)

        def fires(rule: Column) -> Column:
            def found(p: Column) -> Column:
                return (
                    F.when(rule["head"], F.startswith(text, p))
                    .when(rule["fold"], F.contains(lowered, p))
                    .otherwise(F.contains(text, p))
                )

            return F.forall(rule["groups"], lambda g: F.exists(g, found))

        def first_of(present: Column) -> Column:
            likely = F.filter(table, lambda r: F.arrays_overlap(r["anchors"], present))
            first = F.get(F.filter(likely, fires), F.lit(0))
            named = F.when(first.isNotNull(), F.struct(first["rank"].alias("rank"), first["label"].alias("label")))
            return F.when(F.size(present) > 0, named)

        held = F.array_intersect(F.split(lowered, " ", -1), F.array(*map(F.lit, words)))
        hit = F.array_min(F.array(let(held, first_of), hit))
    label = F.coalesce(hit["label"], F.lit("unknown"))
    return F.when(text.isNull(), F.lit("empty")).otherwise(label)


def text_stance(
    text: Column,
    support: list[str],
    oppose: list[str],
    lowered: Column | None = None,
    support_needs: Iterable[str] = (),
    oppose_needs: Iterable[str] = (),
) -> Column:
    """True on a supporting pattern, else false on an opposing one, else null."""
    pro = regex_any(text, support, True, support_needs, lowered)
    con = regex_any(text, oppose, True, oppose_needs, lowered)
    return F.when(pro, F.lit(True)).when(con, F.lit(False))
