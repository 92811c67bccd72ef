"""Rule kinds, stance, flags: matching, nearly matching and shadowed texts."""

import pytest
from pyspark.sql import functions as F

from commentlens.functions.rules import anchor_words, source_label, text_stance
from commentlens.operators.annotate import annotate, stance_labels
from commentlens.rules import domain
from commentlens.rules.model import Rule, all_of, any_of, shadowed
from commentlens.schema import FILING

GRAMMAR = "It reversed a pro-consumer approach that functioned very, very well for a long time with broad bipartisan support"

TEXTS = [
    (None, "empty"),
    ("", "unknown"),
    ("Nothing to see here", "unknown"),
    # substring, case-sensitive
    ("We think: Restore privacy by repealing Net Neutrality, please", "bot.best_cop"),
    ("We think: restore privacy by repealing net neutrality, please", "unknown"),
    # any of a list; a substring inside a longer member of the list
    ("Sirs, our internet regulations remain outdated by now", "form.att"),
    ("heavy-handed regulations will do more harm than good!", "form.att"),
    # prefix: only at the start
    ("Net Neutrality is not negotiable to us", "form.freepress"),
    ("To us Net Neutrality is not negotiable", "unknown"),
    # substring of lower-cased text
    ("I SUPPORT THE EXISTING NET NEUTRALITY RULES, WHICH CLASSIFY INTERNET SERVICE PROVIDERS UNDER THE TITLE II act", "blog.venturebeat"),
    # conjunctions
    ("We need net neutralityto continue. Some control should not be at the mercy of corporations", "bot.mercy"),
    ("We need net neutralityto continue. Full stop", "unknown"),
    # all of, case-insensitive
    ("They want the POWER TO BLOCK WEBSITES, slow them down and split the internet into Fast Lanes for companies that pay and slow lanes for the rest", "form.battleforthenet"),
    ("They want the power to block websites, slow them down and split the internet into fast lanes for companies that pay and slow lanes", "unknown"),
    # any-of groups, all of them
    ("The FCC should reject Chairman Ajit Pai now, stripping users of the vital rights. Thankfully, the current FCC regulations mean that it is fine", "form.dearfcc"),
    ("The FCC should reject Chairman Ajit Pai now, stripping users of the vital rights. Thankfully, the current FCC regulations are fine", "unknown"),
    # generated text: second-last piece between full stops, from its start
    (f"Hello. {GRAMMAR}.", "bot.recursive"),
    (f"Hello. {GRAMMAR}. Bye", "bot.recursive"),
    (f"Hello. {GRAMMAR}. Bye. ", "unknown"),
    (f"Hello. So {GRAMMAR}.", "unknown"),
    (GRAMMAR, "unknown"),
    # patterns
    ("strong NET NEUTRALITY rules backed by title two", "johnoliver"),
    ("net neutrality bacKed by title II", "johnoliver"),  # Kelvin sign folds to k
    ("net neutrality supported by title two", "unknown"),
    # first rule wins
    ("Net Neutrality is not negotiable: net neutrality backed by title ii", "form.freepress"),
    ("corrupt result of a corrupt process; our internet regulations remain outdated", "form.att"),
]


def test_source(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "t string").withColumn("l", F.lower("t"))
    got = df.select("t", source_label(domain.SOURCE_RULES, F.col("t"), F.col("l"))).collect()
    assert [tuple(r) for r in got] == TEXTS


STANCES = [
    (None, None),
    ("hello there", None),
    ("Kindly MAINTAIN net neutrality", True),
    ("do not revoke anything", True),
    ("Continue title two", True),
    ("obamas internet takeover must end", False),
    ("Please rollback this", False),
    ("please roll back this but keep net neutrality", True),
    ("Keep net neutral rules", True),
]


def test_stance(spark):
    df = spark.createDataFrame([(t,) for t, _ in STANCES], "t string")
    plain = text_stance(F.col("t"), domain.SUPPORT_PATTERNS, domain.OPPOSE_PATTERNS)
    gated = text_stance(F.col("t"), domain.SUPPORT_PATTERNS, domain.OPPOSE_PATTERNS, None, domain.SUPPORT_NEEDS, domain.OPPOSE_NEEDS)
    assert [tuple(r) for r in df.select("t", plain, gated).collect()] == [(t, s, s) for t, s in STANCES]


def test_every_label_is_known():
    labels = {rule.label for rule in domain.SOURCE_RULES}
    assert labels == {label for label, *_ in domain.CATALOGUE}


def test_no_rule_is_dead():
    assert shadowed(domain.SOURCE_RULES) == []
    dead = [any_of("a", "cat"), any_of("b", "a cat sat"), all_of("c", "dog", "bird")]
    assert shadowed(dead) == [(1, 0)]


def test_anchor_words():
    assert anchor_words(any_of("a", "one three two", "x yy zzz")) == ["three", "yy"]
    assert anchor_words(any_of("a", "two words", "one three two")) is None
    assert anchor_words(Rule("a", (("x y z",),), mode="regex_search")) is None


def test_bad_rules():
    with pytest.raises(ValueError):
        Rule("a", ((),))
    with pytest.raises(ValueError):
        Rule("a", (("x",),), mode="near")


def test_label_lists():
    catalogue, lists = stance_labels(), stance_labels("lists")
    assert catalogue["bot.commonsense"] is False and "bot.commonsense" not in lists
    assert catalogue["johnoliver"] is True and "johnoliver" not in lists
    with pytest.raises(ValueError):
        stance_labels("other")


def test_annotate_one_filing(spark):
    row = {
        "id_submission": "1",
        "text_data": "The unprecedented regulatory power the Obama Administration imposed on the internet isn't light-touch.\n\nEnd it now!",
        "contact_email": "SOMEONE@EXAMPLE.ORG",
        "addressentity": [{"address_line_1": "1 Main St", "city": "Reno", "state": "NV", "zip_code": "89501"}],
        "proceedings": [{"name": "x"}],
    }
    a = annotate(spark.createDataFrame([row], FILING)).select("analysis.*").first()
    assert (a.source, a.titleii, a.fulladdress, a.capsemail) == ("bot.unprecedented", False, True, True)
    assert a.fingerprint == (
        "administration end imposed internet isnt it lighttouch now obama on power regulatory the unprecedented"
    )
    assert (a.onsite, a.ingestion_method, a.proceedings_keys) == (False, "api", "name")
    assert (a.words, a.untaggable) == (len(row["text_data"].split(" ")), False)


def test_annotate_missing_everything(spark):
    a = annotate(spark.createDataFrame([{"id_submission": "1"}], FILING)).select("analysis.*").first()
    assert (a.source, a.titleii, a.words, a.untaggable, a.fulladdress) == ("empty", None, 1, True, False)
    assert (a.capsemail, a.onsite, a.proceedings_keys, a.ingestion_method, a.fingerprint) == (None, None, None, "api", "")
