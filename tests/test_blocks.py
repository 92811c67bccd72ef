import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commentlens.operators import blocks, clusters, similarity
from commentlens.spark_env import shared_dir


def _folders(spark, name):
    return {str(p) for p in Path(shared_dir(spark).removeprefix("file:")).glob(f"{name}-*")}


@pytest.fixture(scope="module")
def variants(spark):
    """Texts of two templates with words of their own, copies, missing sources and a missing text."""
    rng = random.Random(4)
    texts = []
    for t in "ab":
        shared = [f"{t}{i}" for i in range(20)]
        texts += [" ".join(shared + rng.sample([f"{t}own{j}" for j in range(12)], 3)) for _ in range(40)]
    rows = [(f"d{i:03}", text, f"s{i % 3}" if i % 7 else None) for i, text in enumerate(texts + texts[::9])]
    rows += [("d090", None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    return rows, docs, similarity.build_index(docs, similarity.Params(min_df=2, min_terms=3), "doc_id", "text")


def _pairs(rows, seeds, targets):
    """``seed, source, target`` by brute force: both templates have fewer words than a query has, so all words ask."""
    present = [(d, set(t.split()), s) for d, t, s in rows if t is not None]
    return [(a, s, b) for a, x, _ in present for b, y, s in present if seeds(a) and targets(b) and a != b and len(x & y) >= max(1, int(0.8 * len(x)))]


def test_numbers_of_matches_are_added_up_in_blocks(spark, variants):
    """No match is stored: a query has one row a block, however many texts match it."""
    rows, docs, index = variants
    seeds, targets = docs.filter("doc_id < 'd085'").select("doc_id"), docs.filter("doc_id > 'd005'").select("doc_id", "source")
    expected = {}
    for a, s, _ in _pairs(rows, lambda d: d < "d085", lambda d: d > "d005"):
        expected[a, s] = expected.get((a, s), 0) + 1
    before = _folders(spark, "match-counts") | _folders(spark, "matches")
    got = similarity.match_totals(index, seeds, targets, "source").collect()
    assert {(r.seed, r.source): r.n for r in got} == expected and len(got) == len(expected)
    stored = (_folders(spark, "match-counts") | _folders(spark, "matches")) - before
    kept = spark.read.parquet(*stored)
    most = similarity.query_words(index).count() * spark.sparkContext.defaultParallelism
    assert kept.count() <= most < sum(expected.values())


def test_lists_of_values_are_dealt(spark, variants, monkeypatch):
    """Shapes with more values than ``MEMBERS`` go to blocks in several rows; a missing value stays one."""
    rows, docs, index = variants
    whole = sorted(map(str, similarity.match_totals(index, docs.select("doc_id"), docs.select("doc_id", "source"), "source").collect()))
    monkeypatch.setattr(similarity, "MEMBERS", 1)
    monkeypatch.setattr(blocks, "OUT_ROWS", 7)
    assert sorted(map(str, similarity.match_totals(index, docs.select("doc_id"), docs.select("doc_id", "source"), "source").collect())) == whole


def test_a_shape_is_in_two_matches_for_stars(spark, variants):
    rows, docs, index = variants
    ids = docs.select("doc_id")
    before = _folders(spark, "matches")
    got = {r.doc_id: r.cluster for r in clusters.star_members(index, ids, ids).collect()}
    expected = {}
    for a, _, b in _pairs(rows, lambda d: True, lambda d: True):
        expected[b] = min(a, expected.get(b, a))
    assert got == expected
    stored = spark.read.parquet(*(_folders(spark, "matches") - before))
    assert stored.count() <= 2 * similarity.shape_words(index).count()


def test_seeds_that_come_twice_have_one_place():
    """A shape is met by all queries of its two smallest places; those with more come too late."""
    shapes = _rows(0, ["s0", "s1"], [[1, 2, 3], [2, 3, 4]], pa.int32(), place=[None, None])
    numbers = [[1], [1, 2], [2], [3], [3], [4]]
    queries = _rows(1, [f"q{i}" for i in range(6)], numbers, pa.int32(), probes=[len(n) for n in numbers], need=[1] * 6, hits=[1] * 6, place=[0, 0, 4, 4, 9, 9])
    got = sorted((r["query_id"], r["shape"]) for b in blocks._meet(iter([shapes, queries]), most=2) for r in b.to_pylist())
    assert got == sorted([(b"q0", b"s0"), (b"q1", b"s0"), (b"q2", b"s0"), (b"q3", b"s0"), (b"q1", b"s1"), (b"q2", b"s1"), (b"q3", b"s1")])


def test_blocks_are_asked_in_rounds(spark, variants):
    """Copies of the queries are on disk for as many blocks as there are cores, and then for the next."""
    _, _, index = variants
    queries, shapes = similarity.query_words(index), similarity.shape_words(index)
    whole = sorted((bytes(q), bytes(s)) for q, s in blocks.matches(queries, shapes).collect())
    tables = blocks.stored_matches(queries, shapes, "matches", block_words=100)
    assert len(tables) == -(-blocks.word_count(shapes) // (100 * spark.sparkContext.defaultParallelism)) > 1
    assert sorted((bytes(q), bytes(s)) for q, s in blocks.together(tables).collect()) == whole


def test_the_largest_component_has_its_own_blocks(spark):
    """Its queries are not sent there; what is found is the same, in rounds too."""
    words = list(range(20))
    held = [(f"s{i}".encode(), [*words, 100 + i], b"big" if i % 2 else f"c{i}".encode()) for i in range(200)]
    shapes = spark.createDataFrame([*held, (b"none", words, None)], "shape binary, words array<int>, comp binary")
    asked = [(f"q{i}".encode(), words, 16, 5, [(1, w) for w in words[:9]], b"big" if i % 3 else f"c{i}".encode()) for i in range(60)] + [(b"qn", words, 16, 5, [(1, w) for w in words[:9]], None)]
    queries = spark.createDataFrame(asked, "query_id binary, numbers array<int>, need int, hits int, probes array<struct<nd:long,number:int>>, comp binary")
    rows = lambda tables: sorted((bytes(q), bytes(s)) for q, s in blocks.together(tables).collect())
    whole = rows(blocks.stored_matches(queries, shapes, "matches"))
    for size in (10**6, 300):
        assert rows(blocks.stored_matches(queries, shapes, "matches", block_words=size, apart=(b"big", 0.5))) == whole
    assert len(whole) == 40 * 101 + 20 * 201 - 10 + 201

    block, asks = blocks._dealt(8, range(8), (b"big", 0.5))
    own = {r[0] for r in shapes.filter("comp = 'big'").select(block).collect()}
    assert len(own) == 4 and own.isdisjoint({r[0] for r in shapes.filter("comp is null or comp <> 'big'").select(block).collect()})
    sent = {r.query_id: set(r.to) for r in queries.select("query_id", asks.alias("to")).collect()}
    assert sent[b"q1"] == set(range(8)) - own and sent[b"q0"] == sent[b"qn"] == set(range(8))
    assert clusters._largest(shapes.filter("comp is not null")) == (b"big", 0.5)


def test_words_have_four_bytes(variants):
    """Numbers have no gaps and are in the order of the words."""
    index = variants[2]
    assert dict(index.rows.dtypes)["words"] == "array<int>"
    known = sorted((r.number, r.term) for r in index.vocabulary.collect())
    assert [n for n, _ in known] == list(range(len(known))) and [t for _, t in known] == sorted(t for _, t in known)


def _rows(kind, ids, numbers, width, **more):
    n = len(ids)
    columns = {"block": [0] * n, "kind": [kind] * n, "probes": [0] * n, "need": [0] * n, "hits": [0] * n} | more
    types = {"id": pa.binary(), "numbers": pa.list_(width), "comp": pa.binary(), "held": pa.list_(pa.string()), "times": pa.list_(pa.int64()), "place": pa.int64()}
    made = {c: pa.array(v, types.get(c, pa.int32())) for c, v in columns.items()}
    return pa.record_batch(made | {"id": pa.array([i.encode() for i in ids], pa.binary()), "numbers": pa.array(numbers, pa.list_(width)), "comp": pa.array(more.get("comp", [None] * n), pa.binary())})


@pytest.mark.parametrize("few, together, spread", [(64, 10**6, 10**6), (3, 50, 10**6), (0, 10**6, 400), (10**6, 200, 0)])
@pytest.mark.parametrize("width, far", [(pa.int32(), 0), (pa.int64(), 0), (pa.int64(), 1 << 40)])
def test_lists_against_brute_force(monkeypatch, few, together, spread, width, far):
    """Short and long lists, few and many candidates, in one batch and in several, give the same matches."""
    monkeypatch.setattr(blocks, "FEW", few)
    monkeypatch.setattr(blocks, "TOGETHER", together)
    monkeypatch.setattr(blocks, "SPREAD_BYTES", spread)
    rng = random.Random(6)
    weight = lambda k: sorted({far + int(200 * rng.random() ** 3) for _ in range(k)})
    held = [weight(rng.randrange(1, 60)) for _ in range(300)]
    asked = [weight(rng.randrange(1, 30)) for _ in range(150)]
    # Near copies one after the other, one of very many words, and one of words that no shape has.
    asked += [sorted({*asked[0], far + 300 + i}) for i in range(5)] + [list(range(far, far + 280)), [far + 500, far + 501]]
    need = [max(1, int(0.6 * len(w))) for w in asked]
    hits = [min(5, n) for n in need]
    probes = [len(w) - n + h for w, n, h in zip(asked, need, hits)]
    asked = [rng.sample(w, len(w)) for w in asked]
    names = [f"q{i}" for i in range(len(asked))]
    comp = lambda n, k: [None if i % 11 == 0 else f"c{i % k}".encode() for i in range(n)]
    shapes = _rows(0, [f"s{i}" for i in range(300)], held, width, comp=comp(300, 5))
    queries = _rows(1, names, asked, width, probes=probes, need=need, hits=hits, comp=comp(len(asked), 7))
    got = [(r["query_id"], r["shape"]) for b in blocks._meet(iter([shapes, queries.slice(0, 70), queries.slice(70)])) for r in b.to_pylist()]
    apart = lambda a, b: a is None or a != b
    expected = [
        (f"q{i}".encode(), f"s{j}".encode())
        for i, q in enumerate(asked) for j, s in enumerate(held)
        if len(set(q) & set(s)) >= need[i] and apart(queries["comp"][i].as_py(), shapes["comp"][j].as_py())
    ]
    assert sorted(got) == sorted(expected) and len(got) > 300

    # Values added up, a missing one among them.
    values = [[None if i % 4 == 0 else f"v{i % 4}", "all"] for i in range(300)]
    bare = lambda rows: rows.set_column(rows.schema.get_field_index("comp"), "comp", pa.nulls(rows.num_rows, pa.binary()))
    with_values = _rows(0, [f"s{i}" for i in range(300)], held, width, held=values, times=[[i, 1] for i in range(300)])
    sums = {}
    for b in blocks._meet(iter([with_values, bare(queries)])):
        for r in b.to_pylist():
            for v, n in zip(r["held"], r["times"]):
                sums[r["query_id"], v] = sums.get((r["query_id"], v), 0) + n
    wanted = {}
    for i, q in enumerate(asked):
        for j, s in enumerate(held):
            if len(set(q) & set(s)) >= need[i]:
                for v, n in zip(values[j], (j, 1)):
                    wanted[f"q{i}".encode(), v] = wanted.get((f"q{i}".encode(), v), 0) + n
    assert sums == {k: n for k, n in wanted.items() if n}


def test_near_copies_look_up_what_differs(monkeypatch):
    """Of queries that come one after the other and share most words, only the others are counted again."""
    monkeypatch.setattr(blocks, "FEW", 0)
    common = list(range(30))
    shapes = _rows(0, [f"s{i}" for i in range(100)], [[*common, 100 + i % 10] for i in range(100)], pa.int32())
    numbers = [[*common, 100 + i % 10] for i in range(50)]
    queries = _rows(1, [f"q{i}" for i in range(50)], numbers, pa.int32(), probes=[12] * 50, need=[24] * 50, hits=[5] * 50)
    looked, real = [], blocks.Lists._spread
    monkeypatch.setattr(blocks.Lists, "_spread", lambda self, word: looked.append(word) or real(self, word))
    assert sum(b.num_rows for b in blocks._meet(iter([shapes, queries]))) == 50 * 100
    assert 30 <= len(looked) < 30 + 3 * 50
