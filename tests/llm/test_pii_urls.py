"""Personal data and URLs against plain versions, and the models on what they were not trained on."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from commentlens.llm import line_dedup, pii, url_filter

SF = "/root/testdata/sf0.01"
# The contract's patterns, as they stand there.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind: str, found: str) -> bool:
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        double = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(double) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def _plain_spans(text: str) -> list[str]:
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text) if _valid(kind, m.group())
    ]


def test_pii_query_against_plain_patterns(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = pii.op7_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = _plain_spans(texts[r.doc_id])
        counts = [sum(s.startswith(kind) for s in want) for kind in PLAIN]
        assert counts == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        assert hashlib.sha256(",".join(want).encode()).hexdigest() == r.base_sha256
        every = [s for s in (r.spans + "," + r.secrets).split(",") if s]
        assert set(want) <= set(every) and len(every) == r.n_spans and "secret" not in r.spans
    # A marker of a stored token is no prose: every one of them is found, and nothing else is a secret.
    marked = {d for d, t in texts.items() if re.search(r'token = "[0-9a-f]{40}"', t)}
    assert marked and {r.doc_id for r in rows if r.secrets} == marked
    plain = {d for d, t in texts.items() if not _plain_spans(t) and d not in marked}
    assert sum(r.n_spans > 0 for r in rows if r.doc_id in plain) <= 0.01 * len(plain)


def test_pii_held_out(spark):
    for name, (precision, recall) in pii.held_out(spark).items():
        assert precision >= 0.95 and recall >= 0.8, (name, precision, recall)


def test_pii_thresholds():
    scored = [(0, 0.9, 1.0), (0, 0.8, 1.0), (0, 0.8, 0.0), (1, 0.7, 1.0), (1, 0.2, 1.0), (2, 0.9, 0.0)]
    assert pii.thresholds(scored, 1.0) == [0.9, 0.5, 2.0, 2.0, 2.0]
    assert pii.thresholds(scored, 0.6)[:2] == [0.8, 0.5]


def test_pii_secrets_in_odd_texts(spark):
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    long_run = "ab1" * 200_000
    rows = [(1, f'token = "{key}"'), (2, f"commit {key} merged"), (3, None), (4, ""), (5, long_run), (6, f'token = "{key}" token = "{key}"'), (1, f'token = "{key}"'), (None, f"password={key}")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, k long, added string")
    got = [(r.doc_id, sorted((s.k, s.s, s.e) for s in r.added)) for r in pii.find_pii(docs).collect()]
    one = (1, [(pii.SECRET, 9, 49)])
    want = [one, one, (2, []), (3, []), (4, []), (5, []), (6, [(pii.SECRET, 9, 49), (pii.SECRET, 60, 100)]), (None, [(pii.SECRET, 9, 49)])]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_urls_held_out(spark, url_model):
    rows = url_filter.labelled_urls(spark).filter("split = 'test'").withColumn("page_id", F.monotonically_increasing_id())
    judged = url_filter.judge_urls(rows, url_model, rules=()).join(rows.select("page_id", "label"), "page_id")
    took = {(r.label > 0, r.verdict == "block"): r["count"] for r in judged.groupBy("label", "verdict").count().collect()}
    right = took.get((True, True), 0)
    precision, recall = right / (right + took.get((False, True), 0)), right / (right + took.get((True, False), 0))
    assert precision >= 0.9 and recall >= 0.85, (precision, recall)
    trained = {r.url for r in url_filter.labelled_urls(spark).filter("split = 'train'").collect()}
    assert not trained & {r.url for r in rows.collect()}


def test_url_query_against_plain(spark):
    """Host, path and rule of every page, by string operations alone."""
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    judged = url_filter.op3_url_filter(spark, SF).collect()
    assert len(judged) == len(urls)
    for r in judged:
        _, mark, rest = (urls[r.page_id] or "").partition("://")
        ends = [rest.find(c) for c in "?#" if c in rest]
        whole = rest[: min(ends)] if ends else rest
        host, slash, path = whole.partition("/") if mark else ("", "", "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [
            (len(h + p), h + p, kind) for kind, h, p in url_filter.RULES if ("." + host).endswith("." + h) and (slash + path).startswith(p)
        ]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        assert (r.host, r.path, r.rule) == (host, slash + path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_line_buckets_follow_the_lines(spark):
    assert line_dedup.buckets_for(spark, 0) == line_dedup.BUCKETS and line_dedup.buckets_for(spark, 150_000_000) == 150
    assert line_dedup.buckets_for(spark, 10**13) == 100_000


def test_line_runs_compact(spark):
    """Batches enough for a run of level two: counts add up, the first keeper stays, nothing is left behind."""
    before = {t.name for t in spark.catalog.listTables()}
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    for i in range(5, 0, -1):
        runs.add(spark.createDataFrame([("every", 1, i), (f"only{i}", 2, i), (f"pair{i // 2}", 1, i)], "key string, n_docs long, keep long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    got = {r.key: (r.n_docs, r.keep) for r in runs.totals().collect()}
    assert got["every"] == (5, 5) and got["only3"] == (2, 3) and got["pair2"] == (2, 5) and got["pair1"] == (2, 3) and got["pair0"] == (1, 1)
    runs.close()
    assert {t.name for t in spark.catalog.listTables()} == before
