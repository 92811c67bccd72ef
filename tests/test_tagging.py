"""Tagging jobs, read back from the table; samples in lots; stars without pairs."""

import pytest
from pyspark.sql import functions as F

from commentlens.operators import clusters, similarity
from commentlens.plans import daily, report, tagging
from commentlens.sources import store

TEXTS = [
    ("1", "Companies have to treat all data on the internet the same for every one of us", "2017-05-01", "a@x.org"),
    ("2", "Many people strongly support fully repealing what was decided some years ago", "2017-05-02", "b@x.org"),
    ("3", "isps tell users to stand in one place and keep the current job that they cannot despise", "2017-05-02", "a@x.org"),
    ("4", "A recipe for plum cake with butter and sugar that my neighbour gave to me", "2017-05-03", ""),
]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame(TEXTS, "id_submission string, text_data string, date_disseminated string, contact_email string")
    raw = rows.withColumn("date_disseminated", F.to_timestamp("date_disseminated"))
    daily.ingest(spark, raw, path)
    return path


def _leaf(spark, table, leaf):
    return {r[0]: r[1] for r in store.read_comments(spark, table, None).select("id_submission", f"analysis.{leaf}").collect()}


def test_phrase_jobs(spark, table):
    tagging.tag_phrases(spark, table, "positive", begin="2017-05-02")
    assert _leaf(spark, table, "source")["1"] == "unknown"
    for side in ("positive", "negative"):
        tagging.tag_phrases(spark, table, side)
    got = _leaf(spark, table, "source")
    assert got["1"] == "es_terms_positive" and got["2"] == "es_terms_negative" and got["4"] == "unknown"


def test_relevance_job(spark, table):
    tagging.tag_relevance(spark, table, 1, begin="2017-05-02", end="2017-05-03")
    assert _leaf(spark, table, "sentiment_sig_terms_ordered") == {"1": None, "2": None, "3": True, "4": None}


def test_breach_and_label_jobs(spark, table):
    tagging.flag_breaches(spark, table, spark.createDataFrame([("a@x.org",), ("a@x.org",)], "email string"))
    assert _leaf(spark, table, "breached") == {"1": True, "2": False, "3": True, "4": None}
    tagging.label_manually(spark, table, spark.createDataFrame([("4", False), ("9", True)], "id_submission string, label boolean"))
    assert _leaf(spark, table, "sentiment_manual") == {"1": None, "2": None, "3": None, "4": False}


def test_cluster_job(spark, tmp_path):
    path = str(tmp_path / "table")
    words = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(str(i), f"{words} {'end' if i % 2 else 'close'}", "2017-05-0%d" % (1 + i % 3)) for i in range(6)]
    raw = spark.createDataFrame(rows, "id_submission string, text_data string, date_disseminated string")
    daily.ingest(spark, raw.withColumn("date_disseminated", F.to_timestamp("date_disseminated")), path)
    tagging.cluster_day(spark, path, "2017-05-01", similarity.Params(min_df=2), min_cluster=2)
    got = _leaf(spark, path, "more_like_this")
    assert {m.src_doc_id for m in got.values()} == {"0"} and {m.matches for m in got.values()} == {5}
    assert [i for i, m in got.items() if m.is_source] == ["0"]


def test_window_reads_only_its_days(spark, table):
    rows = tagging.in_window(store.read_comments(spark, table, None), "2017-05-02", "2017-05-03")
    assert sorted(r[0] for r in rows.select(store.KEY).collect()) == ["2", "3"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan


def test_stars_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 90").select("doc_id", "text")
    index = similarity.build_index(docs, similarity.Params(min_df=2, max_df_share=0.5), "doc_id", "text")
    ids = docs.select("doc_id")
    expected = similarity.similar_pairs(index, ids, ids).groupBy("doc_id").agg(F.min("seed").alias("cluster"))
    assert sorted(clusters.star_members(index, ids, ids).collect()) == sorted(expected.collect())


def test_exemplars_take_the_smallest_id(spark):
    rows = spark.createDataFrame([(2, "s", "b"), (1, "s", "a"), (3, None, "c")], "id_submission int, source string, text_data string")
    assert {tuple(r) for r in report.exemplars(rows, F.col("source")).collect()} == {("s", "a"), (None, "c")}
