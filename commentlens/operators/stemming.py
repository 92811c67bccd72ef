"""Porter stems (Porter, 1980, with the two later changes of its author), for a whole vocabulary.

The rules cannot be written as a column expression of bearable size, so they run as an Arrow
function, on the distinct words of a batch of texts; a worker remembers the stems of many words. The
light stemmer in ``functions.text`` does without and stays the default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import counted, english_words, tokens
from ..spark_env import ship_package

# Words whose stems a worker remembers.
REMEMBERED = 400_000

# The suffixes of the published rules, with what takes their place.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _sounds(word: str) -> str:
    """``v`` for vowels and ``c`` for all else; a y is a vowel after a consonant."""
    out = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c", _sounds(stem)))


def _short_end(stem: str) -> bool:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return _sounds(stem).endswith("cvc") and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def _without_ending(word: str) -> str:
    """Past and progressive endings."""
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest(word, ("ed", "ing"))
    stem = word.removesuffix(ending)
    if not ending or "v" not in _sounds(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _sounds(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def porter(word: str) -> str:
    if len(word) <= 2:
        return word
    plural = _longest(word, ("sses", "ies", "ss", "s"))
    word = word.removesuffix(plural) + {"sses": "ss", "ies": "i", "ss": "ss"}.get(plural, "")
    word = _without_ending(word)
    if word.endswith("y") and "v" in _sounds(word[:-1]):
        word = word[:-1] + "i"
    for rules in (STEP_2, STEP_3):
        ending = _longest(word, rules)
        if ending and _measure(word.removesuffix(ending)) > 0:
            word = word.removesuffix(ending) + rules[ending]
    ending = _longest(word, STEP_4)
    stem = word.removesuffix(ending)
    if ending and _measure(stem) > 1 and (ending != "ion" or stem.endswith(("s", "t"))):
        word = stem
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


_remembered = lru_cache(REMEMBERED)(porter)


def _stems(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for words in batches:
        yield words.map(porter, na_action="ignore")


def with_stems(vocabulary: DataFrame, term: str = "term") -> DataFrame:
    """``vocabulary`` (one row per word) with a column ``stem``."""
    ship_package(vocabulary.sparkSession)
    return vocabulary.withColumn("stem", F.pandas_udf(_stems, "string")(F.col(term)))


def _stem_lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Arrays of words to arrays of their stems; each distinct word of a batch is looked up once."""
    none = np.zeros(0, object)
    for lists in batches:
        arrays = [none if words is None else words for words in lists]
        places, distinct = pd.factorize(np.concatenate([none, *arrays]))
        stems = np.array([_remembered(w) for w in distinct], dtype=object)[places]
        ends = np.cumsum([len(words) for words in arrays], dtype=int)
        made = pd.Series(index=lists.index, dtype=object)
        made[:] = np.split(stems, ends[:-1]) if len(arrays) else []
        yield made


def porter_counts(docs: DataFrame, doc_id: str = "id_submission", text: str = "text_data") -> DataFrame:
    """``stem, occurrences, docs`` of the English field under Porter's rules.

    Words are counted and stemmed inside the row of their text, so one row per document and stem is
    shuffled once, and no word meets a vocabulary.
    """
    ship_package(docs.sparkSession)
    held = docs.select(F.col(doc_id).alias("doc_id"), counted(english_words(tokens(F.col(text)))).alias("held"))
    stems = F.pandas_udf(_stem_lists, "array<string>")(F.col("held.term"))
    named = held.select("doc_id", F.explode(F.arrays_zip(stems.alias("stem"), F.col("held.n").alias("n"))).alias("h")).select("doc_id", "h.stem", "h.n")
    # Rows of a document hardly ever share a stem: nothing to add up before the shuffle.
    per_doc = named.repartition("doc_id", "stem").groupBy("doc_id", "stem").agg(F.sum("n").alias("tf"))
    return per_doc.groupBy("stem").agg(F.sum("tf").alias("occurrences"), F.count(F.lit(1)).alias("docs"))
