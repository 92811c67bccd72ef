"""Phrase search, exact and with slop, done inside each row.

A document is matched against all phrases where it lies, so no token leaves its task: the words of
the document that occur in any phrase are found with one hash intersection, phrases that miss a
word drop out, and only the rest are checked by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import query_terms, tokens


def _phrase_table(phrases: Sequence[str]) -> list[tuple[str, list[str]]]:
    table = [(p, query_terms(p)) for p in dict.fromkeys(phrases)]
    if any(not terms for _, terms in table):
        raise ValueError("a phrase has no words")
    return table


def _literal_phrases(table: list[tuple[str, list[str]]]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(phrase).alias("phrase"),
                F.array(*map(F.lit, terms)).alias("terms"),
                F.array(*map(F.lit, _repeat_runs(terms) or [0])).alias("runs"),
            )
            for phrase, terms in table
        )
    )


def _repeat_runs(terms: list[str]) -> list[int]:
    """Runs of places that hold the same word, packed as first * 10^6 + last * 10^3 + size.

    A phrase that repeats a word needs a different occurrence for each place. Places of one word
    have windows of equal length, so a choice of different occurrences exists exactly when every
    run of neighbouring places sees at least as many occurrences as it has places.
    """
    runs = []
    for word in dict.fromkeys(terms):
        places = [i for i, t in enumerate(terms) if t == word]
        for i in range(len(places)):
            for j in range(i + 1, len(places)):
                runs.append(places[i] * 1_000_000 + places[j] * 1_000 + (j - i + 1))
    return runs


def _matches_at(words: Column, terms: Column, runs: Column, start: Column, slop: int) -> Column:
    """All terms can be placed with shift-corrected positions in ``[start, start + slop]``."""

    def placed(term: Column, place: Column) -> Column:
        hit = F.get(words, start + place) == term
        for step in range(1, slop + 1):
            hit = hit | F.coalesce(F.get(words, start + place + F.lit(step)) == term, F.lit(False))
        return F.coalesce(hit, F.lit(False))

    spots = F.transform(terms, placed)
    every = F.forall(spots, lambda ok: ok)
    if slop == 0:
        return every

    def enough(run: Column) -> Column:
        first = F.floor(run / F.lit(1_000_000)).cast("int")
        last = F.floor(run % F.lit(1_000_000) / F.lit(1_000)).cast("int")
        size = run % F.lit(1_000)
        span = F.sequence(start + first, start + last + F.lit(slop))
        word = F.get(terms, first)
        return (size == 0) | (F.size(F.filter(span, lambda p: F.get(words, p) == word)) >= size)

    return every & F.forall(runs, enough)


def _has_phrase(words: Column, phrase: Column, slop: int) -> Column:
    """Try every place of the first word; the common start lies at most ``slop`` before it."""
    terms, runs = phrase["terms"], phrase["runs"]
    head = F.get(terms, F.lit(0))
    last = F.size(words) - F.lit(1)
    starts = F.filter(F.sequence(F.lit(0), last), lambda p: F.get(words, p) == head)
    if slop == 0:
        return F.exists(starts, lambda p: _matches_at(words, terms, runs, p, 0))
    shifts = F.sequence(F.lit(0), F.lit(slop))
    return F.exists(
        starts, lambda p: F.exists(shifts, lambda s: _matches_at(words, terms, runs, p - s, slop))
    )


def matched_phrases(words: Column, phrases: Sequence[str], slop: int = 0) -> Column:
    """Array of the phrases found in the word array ``words``."""
    table = _phrase_table(phrases)
    vocabulary = list(dict.fromkeys(t for _, terms in table for t in terms))
    literal = _literal_phrases(table)

    vocabulary_literal = F.array(*map(F.lit, vocabulary))

    def search(words: Column) -> Column:
        def among(present: Column) -> Column:
            candidates = F.filter(literal, lambda p: F.size(F.array_except(p["terms"], present)) == 0)
            found = F.filter(candidates, lambda p: _has_phrase(words, p, slop))
            return F.transform(found, lambda p: p["phrase"])

        return let(F.array_intersect(words, vocabulary_literal), among)

    # The words are bound too: a filter on the result would otherwise be pushed below the
    # projection that computes them and tokenize the text again at every use.
    return let(words, search)


def phrase_frequency(words: Column, phrase: str) -> Column:
    """How often the exact phrase occurs in ``words``."""
    terms = query_terms(phrase)
    distinct = F.array(*map(F.lit, dict.fromkeys(terms)))

    def count(words: Column) -> Column:
        def starts_here(p: Column) -> Column:
            hit = F.lit(True)
            for i, term in enumerate(terms):
                hit = hit & F.coalesce(F.get(words, p + F.lit(i)) == F.lit(term), F.lit(False))
            return hit

        complete = F.size(F.array_intersect(distinct, words)) == len(set(terms))
        places = F.sequence(F.lit(0), F.size(words) - F.lit(1))
        return F.when(complete, F.size(F.filter(places, starts_here))).otherwise(0)

    return let(words, count)


def match_phrases(
    docs: DataFrame,
    phrases: Sequence[str],
    slop: int = 0,
    doc_id: str = "id_submission",
    text: str = "text_data",
) -> DataFrame:
    """``doc_id, phrase`` for each phrase a document holds. No shuffle."""
    staged = docs.select(F.col(doc_id), tokens(F.col(text)).alias("_words"))
    hits = staged.select(doc_id, F.explode(matched_phrases(F.col("_words"), phrases, slop)).alias("phrase"))
    return hits


def phrase_tag(
    untagged: DataFrame,
    phrases: Sequence[str],
    label: str,
    slop: int = 3,
    doc_id: str = "id_submission",
    text: str = "text_data",
) -> DataFrame:
    """Patch rows ``doc_id, source`` for documents that hold any of the phrases."""
    staged = untagged.select(F.col(doc_id), tokens(F.col(text)).alias("_words"))
    return staged.filter(F.size(matched_phrases(F.col("_words"), phrases, slop)) > 0).select(
        doc_id, F.lit(label).alias("source")
    )


def stance_by_phrase(
    comments: DataFrame,
    phrase: str,
    stance: bool,
    current: Column,
    doc_id: str = "id_submission",
    text: str = "text_data",
) -> DataFrame:
    """Patch rows ``doc_id, titleii`` for documents without a stance that hold the exact phrase."""
    open_rows = comments.filter(current.isNull())
    return phrase_tag(open_rows, [phrase], "", 0, doc_id, text).select(
        doc_id, F.lit(stance).alias("titleii")
    )
