"""Tokens, fingerprints, phrases against plain Python."""

import itertools
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commentlens.functions import text as T
from commentlens.operators import phrases
from commentlens.rules import domain


def test_fingerprint_against_python(spark):
    samples = ["It's a light-touch rule, isn't it?", "B a B c", "", "Été 99 -- x", "a'b'c d--e\nf\tg", "word " * 400 + "zebra " * 300]
    samples.append(" ".join("".join(p) for p in itertools.product("abcdef", repeat=4)))

    def model(t):
        t = re.sub("[^a-z ]+", " ", re.sub("['-]+", "", t.lower()))
        return " ".join(sorted(set(t.split())))[:1000]

    df = spark.createDataFrame([(t,) for t in samples], "t string")
    assert [r[1] for r in df.select("t", T.fingerprint(F.col("t"))).collect()] == [model(t) for t in samples]


def test_fingerprint_ignores_order_and_case(spark):
    words = "some words that Differ in order".split()
    rows = []
    for seed in range(5):
        random.Random(seed).shuffle(words)
        rows.append((" ".join(w.upper() if seed % 2 else w for w in words),))
    assert spark.createDataFrame(rows, "t string").select(T.fingerprint(F.col("t"))).distinct().count() == 1


def test_query_terms_equal_the_column_analyzers(spark):
    texts = [*domain.SUPPORT_PHRASES, *domain.RANKING_CLAUSES, "Obama's ponies' DOGS classes buses toes bees cries été's 1,000 U.S."]
    words = T.tokens(F.col("t"))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", words, T.english_tokens(words)).collect()
    for t, standard, english in got:
        assert standard == T.query_terms(t) and english == T.query_terms(t, english=True)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeiosuyz'’", min_size=1, max_size=8))
def test_surface_forms_cover_the_stemmer(word):
    for w in T.query_terms(word):
        if w not in domain.STOP_WORDS:
            assert w in T.surface_forms(T._stem_word(w))


def _slop_match(words, terms, slop):
    places = [[i for i, w in enumerate(words) if w == t] for t in terms]
    for choice in itertools.product(*places):
        if len(set(choice)) == len(choice):
            adj = [p - o for o, p in enumerate(choice)]
            if max(adj) - min(adj) <= slop:
                return True
    return False


def test_slop_against_brute_force(spark):
    rng = random.Random(5)
    docs = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(120)]
    wanted = ["a b", "a a", "a b a", "b c d", "a a a", "d c b a", "a b a b"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    for slop in (0, 1, 3):
        got = {tuple(r) for r in phrases.match_phrases(df, wanted, slop, "id", "t").collect()}
        expected = {
            (i, p) for i, d in enumerate(docs) for p in wanted if _slop_match(d.split(), p.split(), slop)
        }
        assert got == expected, slop


def test_docket_phrases(spark):
    rows = [(1, "I really do support the title 2 rules"), (2, "slow, slow lane!"), (3, "title 2: support it"), (4, "neutrality"), (5, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {tuple(r) for r in phrases.match_phrases(df, domain.SUPPORT_PHRASES, 3, "id", "t").collect()}
    assert got == {(1, "support title 2"), (2, "slow lane"), (3, "support title 2")}


def test_phrase_frequency(spark):
    df = spark.createDataFrame([("net neutrality and Net, neutrality net",), ("net",), ("",)], "t string")
    got = [r[0] for r in df.select(phrases.phrase_frequency(T.tokens(F.col("t")), "net neutrality")).collect()]
    assert got == [2, 0, 0]


def test_counted_words(spark):
    rows = [(["b", "a", "b", ""],), ([],), (None,), (["x"],)]
    got = spark.createDataFrame(rows, "w array<string>").select(T.counted(F.col("w")).alias("c")).collect()
    assert [r.c if r.c is None else [tuple(x) for x in r.c] for r in got] == [[("", 1), ("a", 1), ("b", 2)], [], None, [("x", 1)]]
