"""Text expressions: tokens, fingerprints, counts. All stay inside JVM expressions."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules.domain import STOP_WORDS

# A word is a run of letters and digits; an apostrophe inside a word belongs to it ("obama's").
WORD = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"


def normalize_space(text: Column) -> Column:
    """Newlines and other white space runs become one space (before similarity work)."""
    return F.regexp_replace(text, r"\s+", " ")


def tokens(text: Column) -> Column:
    """Lower-cased words in order; array index = position."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def counted(words: Column) -> Column:
    """``term, n`` of each distinct word of an array without nulls, in order of the words.

    Counted inside the row, so that no table of single words is grouped for it.
    """
    def runs(ordered: Column) -> Column:
        first = lambda w, i: F.when((i == 0) | (w != F.get(ordered, i - 1)), i).otherwise(-1)
        return F.filter(F.transform(ordered, first), lambda i: i >= 0)

    def pairs(bound: Column) -> Column:
        ordered, starts = bound["ordered"], bound["starts"]
        n = lambda at, j: F.coalesce(F.get(starts, j + 1), F.size(ordered)) - at
        return F.transform(starts, lambda at, j: F.struct(F.get(ordered, at).alias("term"), n(at, j).alias("n")))

    # Arrays of one element, so that the sorted words and their runs are computed once.
    bound = F.transform(F.array(F.sort_array(words)), lambda o: F.struct(o.alias("ordered"), runs(o).alias("starts")))
    return F.get(F.transform(bound, pairs), F.lit(0))


def _bare(word: Column) -> Column:
    """Without a possessive ending."""
    apostrophe = word.contains("'") | word.contains("’")
    return F.when(apostrophe, F.regexp_replace(word, "['’]s?$", "")).otherwise(word)


def _stem(w: Column) -> Column:
    """Plural stemmer of Harman (1991)."""
    return (
        F.when(~w.endswith("s") | (F.length(w) < 4), w)
        .when(
            w.endswith("ies"),
            F.when(w.endswith("eies") | w.endswith("aies"), w).otherwise(F.concat(_chop(w, 3), F.lit("y"))),
        )
        .when(
            w.endswith("es"),
            F.when(w.endswith("aes") | w.endswith("ees") | w.endswith("oes"), w).otherwise(_chop(w, 1)),
        )
        .when(w.endswith("us") | w.endswith("ss"), w)
        .otherwise(_chop(w, 1))
    )


def _chop(w: Column, n: int) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - F.lit(n))


def stem_words(words: Column) -> Column:
    # Two passes, so that the bare word is computed once and not at each test of the stemmer.
    return F.transform(F.transform(words, _bare), _stem)


def without_stop_words(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(STOP_WORDS))


def english_tokens(words: Column) -> Column:
    """Stop words dropped, possessive and plural endings removed, order kept."""
    return stem_words(without_stop_words(words))


def english_words(words: Column) -> Column:
    """Stop words dropped, possessive endings removed, not stemmed."""
    return F.transform(without_stop_words(words), _bare)


def surface_forms(stem: str) -> list[str]:
    """All words that ``english_tokens`` turns into ``stem``."""
    bases = [stem, stem + "s"] + ([stem[:-1] + "ies"] if stem.endswith("y") else [])
    forms = [base + tail for base in bases for tail in ("", "'s", "’s")]
    return [w for w in forms if w not in STOP_WORDS and _stem_word(w) == stem]


def query_terms(query: str, english: bool = False) -> list[str]:
    """The analyzers above applied to a short query string on the driver."""
    words = regex.findall(WORD, query.lower())
    if not english:
        return words
    return [_stem_word(w) for w in words if w not in STOP_WORDS]


def _stem_word(word: str) -> str:
    w = regex.sub("['’]s?$", "", word)
    if len(w) < 4:
        return w
    if w.endswith("ies"):
        return w if w.endswith(("eies", "aies")) else w[:-3] + "y"
    if w.endswith("es"):
        return w if w.endswith(("aes", "ees", "oes")) else w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")):
        return w[:-1]
    return w


def word_list(text: Column) -> Column:
    """Distinct a-z words of the text in sorted order.

    Apostrophes and hyphens join their word; every other non-letter separates words.
    """
    joined = F.translate(F.lower(F.coalesce(text, F.lit(""))), "'-", "")
    words = F.sort_array(F.array_distinct(F.array_remove(F.split(joined, "[^a-z]+"), "")))
    return F.array_join(words, " ")


def fingerprint(text: Column) -> Column:
    """The word list, cut at 1000 characters."""
    return F.substring(word_list(text), 1, 1000)


def word_count(text: Column) -> Column:
    """Pieces between single spaces; empty pieces count and missing text has one."""
    return F.size(F.split(F.coalesce(text, F.lit("")), " ", -1))


def untaggable(text: Column) -> Column:
    """Too short to say anything: under 13 characters or under 3 words."""
    return (F.length(F.coalesce(text, F.lit(""))) < 13) | (word_count(text) < 3)
