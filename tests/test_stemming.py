"""Porter's rules on the published examples, and the counts over documents."""

import pytest

from commentlens.operators import annotators, stemming
from commentlens.operators.annotate import annotate
from commentlens.sources import store
from pyspark.sql import functions as F

EXAMPLES = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "fizzed": "fizz",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "rational": "ration", "digitizer": "digit", "vietnamization": "vietnam",
    "operator": "oper", "decisiveness": "decis", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "hopeful": "hope", "revival": "reviv",
    "gyroscopic": "gyroscop", "replacement": "replac", "dependent": "depend", "adoption": "adopt", "effective": "effect", "probate": "probat", "rate": "rate",
    "controll": "control", "roll": "roll", "neutrality": "neutral", "ying": "ying", "as": "as", "": "",
}


def test_published_examples():
    assert {w: stemming.porter(w) for w in EXAMPLES} == EXAMPLES


def test_counts(spark):
    rows = [(1, "Regulations regulate the regulation"), (2, "regulating, and the agency's agencies"), (3, None), (4, "")]
    got = stemming.porter_counts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r.stem: (r.occurrences, r.docs) for r in got} == {"regul": (4, 2), "agenc": (2, 1)}
    empty = spark.createDataFrame([("word",), (None,)], "term string")
    assert {r.term: r.stem for r in stemming.with_stems(empty).collect()} == {"word": "word", None: None}


def test_words_are_shuffled_once(spark):
    """One row per document and stem, and no join with a vocabulary; repeated and missing ids are one document each."""
    rows = [(1, "agency agencies rules"), (1, "the agency"), (None, "rules"), (None, "ruling rules"), (2, "rule")]
    counts = stemming.porter_counts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 2
    assert {r.stem: (r.occurrences, r.docs) for r in counts.collect()} == {"agenc": (3, 1), "rule": (5, 3)}


def test_a_job_adds_an_annotator(spark, tmp_path):
    rows = spark.createDataFrame([("1", "Shout!", "2017-05-01")], "id_submission string, text_data string, date_disseminated string")
    plain = annotate(rows)
    with pytest.raises(ValueError):
        annotators.register("words")(lambda row: F.lit(0))
    annotators.register("shouts")(lambda row: row.body.contains("!"))
    try:
        done = annotate(rows)
        assert done.first().analysis.shouts is True and done.first().analysis.words == 1
        assert done.schema["analysis"].dataType.fieldNames() == [*plain.schema["analysis"].dataType.fieldNames(), "shouts"]
        store.upsert(spark, str(tmp_path / "t"), done.withColumn("date_disseminated", F.to_timestamp("date_disseminated")).withColumn(store.ORDER, F.current_timestamp()))
        assert store.read_comments(spark, str(tmp_path / "t"), None).first().analysis.shouts is True
    finally:
        annotators.unregister("shouts")
    assert annotate(rows).schema == plain.schema
