"""Skewed joins, clustering, upserts and files."""

import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commentlens.functions.predicates import Tags
from commentlens.operators import blocks, clusters, merge, sampling, similarity
from commentlens.operators.skew import lookup
from commentlens.plans import daily
from commentlens.sources import filings, store
from commentlens.spark_env import shared_dir
from oracle import storage, textual

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_lookup_with_hot_key(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"))
    dim = big.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("key <> 'k7'")
    expected = big.join(dim, "key")
    for hot in (1, 5, 1000):
        got = lookup(big, dim, "key", "n", F.col("id"), max_hot=hot)
        assert got.count() == expected.count() and got.exceptAll(expected.select(*got.columns)).count() == 0
    left = lookup(big, dim, "key", "n", F.col("id"), how="left", max_hot=3)
    assert left.count() == 3000 and left.filter("n is null").count() == big.filter("key = 'k7'").count()


def test_components_against_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in clusters.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_minima_are_copied_for_salts_that_occur_only(spark, monkeypatch):
    """A node of one edge gets one copy, a hub one for each salt; no step is run twice inside a round."""
    made, real = [], clusters._copies

    def copies(low):
        rows = real(low)
        made.append({k: n for k, n in rows.groupBy("u").count().collect()})
        return rows

    monkeypatch.setattr(clusters, "_copies", copies)
    pairs = [(1000 + i, 2000 + i) for i in range(300)] + [(1, 5000 + i) for i in range(200)]
    got = {r.node: r.component for r in clusters.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: min(p) for p in pairs for x in p}
    assert made[0] == {1: clusters.SALT, **{1000 + i: 1 for i in range(300)}}
    assert all(sum(m.values()) <= len(pairs) for m in made)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(DOCS).filter("doc_id < 90").select("doc_id", "text")


def _index(sample, **kw):
    return similarity.build_index(sample, similarity.Params(min_df=2, max_df_share=0.5, min_terms=3, **kw), "doc_id", "text")


def test_pairs_against_brute_force(spark, sample):
    ids = sample.select("doc_id")
    index = _index(sample)
    rows = index.members.join(index.profiles, "rep").collect()
    terms = {r.doc_id: set(r.terms) for r in rows}
    query = {r.doc_id: {q.term for q in r.query} for r in rows if len(r.query) >= 3}
    expected = {
        (s, d) for s, q in query.items() for d, t in terms.items() if s != d and len(q & t) >= max(1, int(0.8 * len(q)))
    }
    assert expected
    got = similarity.similar_pairs(index, ids, ids).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected
    split = similarity.Index(index.profiles, index.members, similarity.Params(min_df=2, max_df_share=0.5, min_terms=3, split_rows=2))
    assert {tuple(r) for r in similarity.similar_pairs(split, ids, ids).collect()} == expected


def test_index_holds_numbers_and_looks_words_up(spark):
    """What is grouped, stored and joined carries no spelled word; words of equal score still come in order."""
    texts = ["delta alpha alpha charlie", "bravo delta charlie alpha", "Zulu bravo", "bravo  ZULU", None, "!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = similarity.build_index(docs, similarity.Params(min_df=2), "doc_id", "text")
    assert "string" not in index.rows.schema.simpleString()
    plan = similarity.shape_words(index)._jdf.queryExecution().executedPlan().toString()
    assert "term" not in plan and "Join" not in plan
    terms = {r.rep: r.terms for r in index.profiles.collect()}
    assert terms == {0: ["alpha", "charlie", "delta"], 1: ["alpha", "bravo", "charlie", "delta"], 2: ["bravo", "zulu"], 3: ["bravo", "zulu"]}
    ranked = sorted((r.rep, r["rank"], r.term) for r in similarity.query_table(index).collect())
    assert [t for i, _, t in ranked if i == 0] == ["alpha", "charlie", "delta"]
    assert [t for i, _, t in ranked if i == 1] == ["alpha", "charlie", "delta", "bravo"]
    again = {r.rep: [q.term for q in r.query] for r in index.profiles.collect()}
    assert again == {i: [t for j, _, t in ranked if j == i] for i in again}


def test_pairs_are_made_in_blocks(spark, monkeypatch):
    """Neither matches nor pairs are joined or shuffled; lists of members and batches of any size give the same rows."""
    rng = random.Random(8)
    texts = [" ".join(rng.sample([f"word{i}" for i in range(14)], 10)) for _ in range(12)]
    # Copies that differ in case, an id that comes twice, a missing id and a missing text.
    rows = [(f"d{i:03}", t.upper() if i % 5 == 0 else t) for i, t in enumerate(texts * 4 + texts[:1] * 40)]
    docs = spark.createDataFrame([*rows, rows[3], (None, texts[0]), ("none", None)], "doc_id string, text string")
    index = similarity.build_index(docs, similarity.Params(min_df=2, min_terms=3), "doc_id", "text")
    seeds = spark.createDataFrame([(d,) for d, _ in rows if d < "d070"], "doc_id string")
    targets = spark.createDataFrame([(d,) for d, _ in rows if d >= "d010"], "doc_id string")
    times = lambda d: 2 if d == rows[3][0] else 1
    words = {d: set(t.lower().split()) for d, t in rows}
    expected = sorted(
        (a, b) for a in words for b in words for _ in range(times(a) * times(b)) if a < "d070" and b >= "d010" and a != b and len(words[a] & words[b]) >= 8
    )
    assert len(expected) > 1000
    for members in (1_000, 3):
        monkeypatch.setattr(similarity, "MEMBERS", members)
        pairs = similarity.similar_pairs(index, seeds, targets)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        assert sorted((r.seed, r.doc_id) for r in pairs.collect()) == expected
    lists = similarity._member_lists(spark.range(100).select(F.col("id").alias("doc_id"), F.lit("one").alias("shape")), "shape").collect()
    assert len(lists) > 20 and sorted(d for r in lists for d in r.members) == list(range(100))


def test_pairs_leave_a_block_in_bounded_batches(monkeypatch):
    """A block hands on ``OUT_ROWS`` pairs at once, and no more than the last match has beyond."""
    monkeypatch.setattr(blocks, "OUT_ROWS", 50)

    def rows(kind, ids, members):
        n = len(ids)
        return pa.record_batch({
            "block": pa.array([0] * n, pa.int32()), "kind": pa.array([kind] * n, pa.int32()), "id": pa.array([i.encode() for i in ids], pa.binary()),
            "numbers": pa.array([[1, 2, 3]] * n, pa.list_(pa.int64())), "comp": pa.nulls(n, pa.binary()), "probes": pa.array([3 * kind] * n, pa.int32()),
            "need": pa.array([2 * kind] * n, pa.int32()), "hits": pa.array([2 * kind] * n, pa.int32()), "members": pa.array(members, pa.list_(pa.string())),
        })

    held = [[f"t{i}-{j}" for j in range(i)] for i in range(1, 9)]
    asked = [[f"q{i}-{j}" for j in range(i)] for i in range(1, 7)]
    got = list(blocks._meet(iter([rows(0, [f"s{i}" for i in range(8)], held), rows(1, [f"q{i}" for i in range(6)], asked).slice(1)])))
    pairs = [(r["seed"], r["doc_id"]) for b in got for r in b.to_pylist()]
    assert sorted(pairs) == sorted((a, b) for q in asked[1:] for a in q for s in held for b in s)
    assert len(got) > 10 and max(b.num_rows for b in got) < 50 + 48


def test_blocks_against_brute_force(spark):
    """Candidates are neither joined nor shuffled; blocks of any size give the same pairs."""
    rng = random.Random(5)
    held = {f"s{i}": sorted(rng.sample(range(60), rng.randrange(1, 30))) for i in range(80)}
    asked = {f"q{i}": sorted(rng.sample(range(60), rng.randrange(1, 12))) for i in range(50)}
    need = {q: max(1, int(0.6 * len(w))) for q, w in asked.items()}
    shapes = spark.createDataFrame([(s.encode(), [(w, 1) for w in ws], s[-1].encode()) for s, ws in held.items()], "shape binary, words array<struct<number:long,nd:long>>, comp binary")
    rows = []
    for q, ws in asked.items():
        hits = min(3, need[q])
        rows.append((q.encode(), ws, need[q], hits, [(1, w) for w in rng.sample(ws, len(ws) - need[q] + hits)], q[-1].encode()))
    queries = spark.createDataFrame(rows, "query_id binary, numbers array<long>, need int, hits int, probes array<struct<nd:long,number:long>>, comp binary")
    expected = {(q, s) for q, ws in asked.items() for s, held_words in held.items() if len(set(ws) & set(held_words)) >= need[q]}
    assert expected
    for size in (7, 200, 10**6):
        found = blocks.matches(queries.drop("comp"), shapes.drop("comp"), size)
        assert sorted((bytes(r[0]).decode(), bytes(r[1]).decode()) for r in found.collect()) == sorted(expected)
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    apart = blocks.matches(queries, shapes, 200).collect()
    assert sorted((bytes(r[0]).decode(), bytes(r[1]).decode()) for r in apart) == sorted((q, s) for q, s in expected if q[-1] != s[-1])


def test_blocks_give_a_forest(spark):
    """Texts that all match each other are as many pairs as texts, not as pairs; what they connect is the same."""
    words = list(range(20))
    comp = lambda name: name.encode()
    held = [(f"s{i}".encode(), words + [100 + i], comp(f"c{i}")) for i in range(120)] + [(b"far", list(range(500, 520)), comp("far"))]
    shapes = spark.createDataFrame(held, "shape binary, words array<long>, comp binary")
    # Half of the queries have components of shapes, half have some that no block holds.
    asked = [(f"q{i}".encode(), words, 16, 5, [(1, w) for w in words[:9]], comp(f"c{i}" if i % 2 else f"x{i}")) for i in range(100)]
    queries = spark.createDataFrame(asked, "query_id binary, numbers array<long>, need int, hits int, probes array<struct<nd:long,number:long>>, comp binary")
    whole = {(bytes(a), bytes(b)) for a, b in blocks.matches(queries, shapes).collect()}
    assert len(whole) == 100 * 120 - 50
    some = [(bytes(a), bytes(b)) for a, b in blocks.matches(queries, shapes, 10**6, words=1, forest=True).collect()]
    assert set(some) <= whole and len(some) <= 120 + 100 * spark.sparkContext.defaultParallelism
    label = {q: c for q, *_, c in map(lambda r: (bytes(r[0]), bytes(r[-1])), asked)} | {s: bytes(c) for s, _, c in held}

    def groups(pairs):
        edges = spark.createDataFrame([(label[a].decode(), label[b].decode()) for a, b in pairs], "a string, b string")
        return {r.node: r.component for r in clusters.connected_components(edges).collect()}

    assert groups(some) == groups(whole)


def test_rows_and_partitions_do_not_matter(spark, sample):
    ids = sample.select("doc_id")
    first = similarity.similar_pairs(_index(sample), ids, ids)
    second = similarity.similar_pairs(_index(sample.orderBy(F.desc("doc_id")).repartition(7)), ids, ids)
    assert sorted(first.collect()) == sorted(second.collect())


def test_clusters_are_components_of_all_pairs(spark, sample):
    index, ids = _index(sample), sample.select("doc_id")
    got = {r.doc_id: r.cluster for r in clusters.cluster_members(index, ids, ids).collect()}
    label = {d: d for d in got}
    pairs = [(r.seed, r.doc_id) for r in similarity.similar_pairs(index, ids, ids).collect()]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    for a, b in pairs:
        assert got[a] == got[b]
    assert len(set(got.values())) >= len({label[d] for p in pairs for d in p})


def test_clusters_store_words_once(spark, sample, monkeypatch):
    """Tables of words go when they are done, and components are stored without words."""
    shared, before, compared, real = Path(shared_dir(spark).removeprefix("file:")), set(), [], similarity.checked
    before.update(p.name for p in shared.iterdir())

    def checked(candidates, queries, shapes):
        compared.append(candidates.count())
        return real(candidates, queries, shapes)

    monkeypatch.setattr(similarity, "checked", checked)
    index, ids = _index(sample), sample.select("doc_id")
    members = clusters.cluster_members(index, ids, ids)
    left = {p.name.rsplit("-", 1)[0] for p in shared.iterdir() if p.name not in before}
    assert not left & {"words", "keys", "texts", "queries", "target-shapes", "placed-query_id", "placed-shape", "placed-queries", "placed-shapes", "late-matches"}, left
    assert members.count() > 0 and len(compared) == 2
    similarity.similar_pairs(index, ids, ids).count()
    assert not {p.name.rsplit("-", 1)[0] for p in shared.iterdir() if p.name not in before} & {"queries", "shapes"}


def test_latest_version_inside_one_run(spark):
    rows = [(2, "2017-05-01 09:00:00", "new"), (2, "2017-05-01 01:00:00", "old"), (3, None, "none"), (3, "2017-05-01 01:00:00", "dated")]
    df = spark.createDataFrame(rows, "id_submission long, date_disseminated string, text_data string").withColumn("ingested_at", F.lit(1))
    assert {r.id_submission: r.text_data for r in merge.latest_by_id(df, "id_submission", "ingested_at").collect()} == {2: "new", 3: "dated"}


def test_patch_with_an_id_twice(spark):
    stored = spark.createDataFrame([("a", (1, 2)), ("b", None)], "id_submission string, analysis struct<x:int,y:int>")
    patch = spark.createDataFrame([("a", 5), ("a", 5), ("a", 7), ("c", 1)], "id_submission string, x int")
    got = merge.merge_analysis(stored, patch).collect()
    assert sorted(r.id_submission for r in got) == ["a", "b"] and {r.id_submission: r.analysis for r in got}["a"].y == 2


def test_cluster_patch_marks_short_and_members(spark):
    text = " ".join(f"word{i} other{i}" for i in range(40))
    rows = [(i, text + (" name" if i % 2 else ""), "form.x" if i > 2 else "unknown") for i in range(6)] + [(9, "short one", "unknown")]
    df = spark.createDataFrame(rows, "id long, text_data string, source string")
    none = lambda kind: F.lit(None).cast(kind)
    tags = Tags(F.col("source"), none("boolean"), none("boolean"), none("boolean"), F.lit(False), none("string"))
    index = similarity.build_index(df, similarity.Params(min_df=2), "id")
    got = {r.id: r.more_like_this for r in clusters.cluster_patch(df, index, tags, "id").collect()}
    assert got[9].too_short and got[9].src_doc_id is None
    assert {got[i].src_doc_id for i in range(6)} == {"0"} and got[0].is_source and not got[5].is_source
    assert got[4].matches == 5 and got[4].source == "form.x"


def test_merge_keeps_absent_and_clears_null(spark):
    stored = spark.sql("select '1' id, struct('a' as source, true as titleii) analysis union all select '2', struct('b', false)")
    patch = spark.createDataFrame([("1", None), ("3", True)], "id string, titleii boolean")
    got = {r.id: tuple(r.analysis) for r in merge.merge_analysis(stored, patch, "id").collect()}
    assert got == {"1": ("a", None), "2": ("b", False)}
    with pytest.raises(ValueError):
        merge.merge_analysis(stored, patch.withColumn("odd", F.lit(1)), "id")


def test_large_samples_are_the_same(spark, monkeypatch):
    rows = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("g"))
    usual = sorted(sampling.random_sample(rows, 40, "s", "g", "id").collect())
    monkeypatch.setattr(sampling, "LOTS", 1)
    assert sorted(sampling.random_sample(rows, 40, "s", "g", "id").collect()) == usual and len(usual) == 120


def _write(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(path)


def test_read_filings_shapes(spark, tmp_path):
    path = str(tmp_path / "in")
    _write(spark, path, [
        '{"id_submission":"1","addressentity":{"city":"Reno"},"proceedings":[{"_index":"x","id":5},{"_index":""},{"name":"n"}],"filingstatus":{"id":1},"date_disseminated":"2017-05-12T20:07:00.000Z"}',
        '{"id_submission":"2","addressentity":[{"city":"Elko"},{"city":"Ely"}],"proceedings":[]}',
        '{"id_submission":"3","addressentity":null}',
    ])
    rows = {r.id_submission: r for r in filings.read_filings(spark, path).collect()}
    assert rows["1"].addressentity[0].city == "Reno" and rows["1"].proceedings == [{"_index": "x"}]
    assert [a.city for a in rows["2"].addressentity] == ["Elko", "Ely"] and rows["2"].proceedings == []
    assert rows["3"].addressentity is None and rows["3"].proceedings is None
    df = filings.read_filings(spark, path)
    assert filings.between(df, gte="2017-05-12 20:07:00").count() == 1
    assert filings.between(df, lte="2017-05-12 20:06:59").count() == 0
    assert filings.between(df).count() == 3


def test_store_moves_rows_between_days_and_is_idempotent(spark, tmp_path):
    table = str(tmp_path / "table")
    make = lambda *rows: spark.createDataFrame([(i, t, d) for i, t, d in rows], "id_submission string, text_data string, date_disseminated string").withColumn("date_disseminated", F.to_timestamp("date_disseminated"))
    show = lambda: sorted((r.id_submission, r.text_data, str(r.day)) for r in store.read_comments(spark, table, None).collect())
    daily.ingest(spark, make(("1", "one", "2017-05-01"), ("2", "two", "2017-05-02"), ("3", "three", "2017-05-02")), table)
    change = make(("1", "uno", "2017-05-03"), ("2", "due", "2017-05-02"), ("4", "quattro", None))
    for _ in range(2):
        daily.ingest(spark, change, table)
        assert show() == [("1", "uno", "2017-05-03"), ("2", "due", "2017-05-02"), ("3", "three", "2017-05-02"), ("4", "quattro", "1970-01-01")]
    daily.reannotate(spark, table)
    assert len(show()) == 4


def test_jobs_leave_no_intermediate_tables(spark, tmp_path):
    left = lambda: {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("*") if p.name.startswith(("incoming-", "places-", "patch-"))}
    before, table = left(), str(tmp_path / "table")
    rows = spark.createDataFrame([("1", "one"), ("2", "two")], "id_submission string, text_data string").withColumn("date_disseminated", F.to_timestamp(F.lit("2017-05-01")))
    for _ in range(2):
        daily.ingest(spark, rows, table)
    daily.reannotate(spark, table)
    assert left() == before and store.read_comments(spark, table, None).count() == 2


def test_variants_of_a_template_are_not_compared_pairwise(spark, monkeypatch):
    """Each variant has words of its own and shares the rest: one cluster, from a few checks per text."""
    rng = random.Random(5)
    count, shared = 1500, [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(shared + rng.sample([f"name{j}" for j in range(300)], 6))) for i in range(count)]
    rows += [(5_000 + i, " ".join(rng.sample([f"other{j}" for j in range(500)], 60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = similarity.build_index(docs, similarity.Params(min_df=5), "doc_id", "text")
    compared, real = [], similarity.checked

    def checked(candidates, queries, shapes):
        kept = candidates.cache()
        compared.append(kept.count())
        return real(kept, queries, shapes)

    monkeypatch.setattr(similarity, "checked", checked)
    ids = docs.select("doc_id")
    got = {r.doc_id: r.cluster for r in clusters.cluster_members(index, ids, ids).collect()}
    assert {got[i] for i in range(count)} == {0} and all(got[5_000 + i] == 5_000 + i for i in range(40) if 5_000 + i in got)
    assert len(compared) == 2 and sum(compared) < 20 * count, compared


@pytest.fixture()
def documents(spark, tmp_path):
    rows = [(i, f"some words of text {i} and some more words", "en", f"src{i % 3}", 40) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(20).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_postings_summary_shuffles_texts_only(spark, documents):
    summary = textual.postings_summary(spark, documents)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    rows = summary.collect()
    assert len(rows) == 800 and {(r.words, r.terms, r.last_pos) for r in rows if r.field == "standard"} == {(9, 7, 8)}


def test_files_grow_with_the_input(spark, documents):
    """The reader makes a split of each file here; the filings must not come down to four files."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert storage.file_count(spark, documents) % 4 == 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        splits = spark.read.parquet(f"{documents}/documents.parquet").rdd.getNumPartitions()
        assert splits >= 20
        assert splits <= storage.file_count(spark, documents) < splits + 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_are_bounded_in_bytes(spark, documents, monkeypatch):
    """A reader that makes one split of everything must not make files that grow with the input."""
    old = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        stored = sum(p.stat().st_size for p in Path(documents, "documents.parquet").glob("*.parquet"))
        assert spark.read.parquet(f"{documents}/documents.parquet").rdd.getNumPartitions() == 1
        monkeypatch.setattr(storage, "FILE_BYTES", 1000, raising=False)
        assert stored / 1000 <= storage.file_count(spark, documents) < stored / 1000 + 5
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
        if old is not None:
            spark.conf.set("spark.sql.files.minPartitionNum", old)
