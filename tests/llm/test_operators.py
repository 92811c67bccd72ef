"""Small tables with nulls, empty and odd texts, ties, repeats and clashing columns, against brute force."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from commentlens.llm import decontaminate, licenses, line_dedup, ngram_join, packing, pii, quality, queries, sharding, token_index, url_filter
from commentlens.llm.tokens import Encoder, in_lots, public_tokenizer
from oracle.compare import compare, connect

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
LINE = "this very line stands in many documents of the table"
ROWS = [
    (1, "A short text.", "en", "s1"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (4, " \n\t ", "de", "s1"),
    (5, LONG, "en", "s2"),
    (6, LONG + " end", "en", "s2"),
    (7, f"{LINE}\nown words of seven\n\n", "en", "s1"),
    (8, f"  {LINE.upper()}  \nown words of eight", "fr", "s1"),
    (9, f"{LINE}\n{LINE}", "en", None),
    (10, LINE, "en", "s1"),
    (11, f"x\n{LINE}\r\ny", "en", "s1"),
    (12, "A short text.", "en", "s1"),
    (12, "A short text.", "en", "s1"),
    (None, "no id here, mail a.b@example.com", "en", "s1"),
    (13, "Straße 日本語 \U0001f600 çà  double  spaces\u2003wide", "de", "s3"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, key int, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), "clash", 0, "clash") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_against_sql(spark, name):
    fn, sql = queries.QUERIES[name]
    assert compare(spark, connect(SF), fn, sql, SF) == ""


def _components(rows, words, percent):
    sets = []
    for _, text, *_ in rows:
        parts = (text or "").encode().lower().split()
        sets.append({tuple(parts[i : i + words]) for i in range(max(len(parts) - words + 1, 1))} if parts else set())
    ids = [-1 if r[0] is None else r[0] for r in rows]
    label = list(ids)
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if (ids[i] == ids[j]) or (a and b and 100 * len(a & b) >= percent * len(a | b)):
                    label[i] = label[j] = min(label[i], label[j])
    return Counter((r[0], len(s), None if c == -1 else c) for r, s, c in zip(rows, sets, label))


@pytest.mark.parametrize("group", [2, 2_000])
def test_jaccard(spark, docs, no_docs, group):
    got = ngram_join.jaccard_components(docs, group=group).collect()
    assert Counter(map(tuple, got)) == _components(ROWS, 4, 85)
    assert ngram_join.jaccard_components(no_docs).count() == 0


def test_jaccard_strays(spark):
    """A family of 12 parts in which nothing links: groups stay bounded and every two members meet."""
    group, count, none = 20, 240, spark.createDataFrame([], "rep long, comp long")
    family = spark.range(1, count + 1).select(F.col("id").alias("rep"), F.lit(50).cast("long").alias("n"), F.lit(0).cast("long").alias("pivot"), (F.col("id") % 12).cast("int").alias("part"))
    groups = defaultdict(set)
    for r in ngram_join.strays(family, none, group).collect():
        groups[r.pivot, r.part].add(r.rep)
    assert max(map(len, groups.values())) <= 4 * group
    assert len({(a, b) for g in groups.values() for a in g for b in g}) == count * count
    joined = spark.range(1, 21).select(F.col("id").alias("rep"), F.lit(0).cast("long").alias("comp")).union(spark.createDataFrame([(0, 0)], "rep long, comp long"))
    groups = defaultdict(set)
    for r in ngram_join.strays(family, joined, group).collect():
        groups[r.pivot, r.part].add(r.rep)
    met = {(a, b) for g in groups.values() for a in g for b in g}
    assert all((a, b) in met for a in range(21, count + 1) for b in range(1, count + 1))
    # Texts over one long template: few links, and the same result in parts as in one piece.
    texts = [(i, " ".join([f"t{j}" for j in range(60)] + [f"u{i // 10 * 10 if i % 10 < 2 else i}x{j}" for j in range(9)] + [f"e{i}"])) for i in range(80)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    shingles = {i: {tuple(t.split()[k : k + 4]) for k in range(len(t.split()) - 3)} for i, t in texts}
    pairs = {(a, b) for a in shingles for b in shingles if a < b and 100 * len(shingles[a] & shingles[b]) >= 85 * len(shingles[a] | shingles[b])}
    name = {i: i for i in shingles}
    for a, b in sorted(pairs):
        name[b] = min(name[b], name[a])
    assert pairs == {(i, i + 1) for i in range(0, 80, 10)}
    got = ngram_join.jaccard_components(table, group=10).collect()
    assert {r.doc_id: r.component_id for r in got} == name


def test_jaccard_family(spark):
    base = [f"t{i}" for i in range(60)]
    rows = []
    for d in range(60):
        own = list(base)
        for k in range(d % 4):
            own[(d * 7 + k * 23) % 60] = f"x{d}-{k}"
        rows.append((d, " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = _components([(d, t, None) for d, t in rows], 4, 85)
    for group, common in ((2_000, 100), (7, 0)):
        got = ngram_join.jaccard_components(table, group=group, common=common).collect()
        assert Counter(map(tuple, got)) == want


def test_bitmaps_bound():
    rng = np.random.default_rng(1)
    for n, m, shared in ((200, 230, 180), (130, 127, 0), (1000, 1030, 990), (1, 1, 1)):
        x = rng.integers(0, 2**62, n)
        y = np.r_[x[:shared], rng.integers(0, 2**62, m - shared)]
        assert shared <= ngram_join.most_overlap(n, ngram_join.parity_bits(x), m, ngram_join.parity_bits(y)) <= min(n, m) + max(n, m)


def test_derived_links():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 10**6, 80))
    sets = [np.unique(np.r_[rng.choice(base, 80 - k, replace=False), rng.integers(0, 10**6, k)]) for k in range(20)]
    got = ngram_join.derived_links(base, sets, 85)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                both = len(np.intersect1d(a, b))
                assert got[i, j] == (100 * both >= 85 * (len(a) + len(b) - both))


def test_worker_remembers_a_word_once():
    """Plain words are remembered under their word only; strings are made of one range of texts at a time."""
    encoder, plain = Encoder(public_tokenizer()), Tokenizer.from_file(public_tokenizer())
    texts = ["alpha beta gamma. delta beta, beta", "gamma alpha delta.", "x42 gamma\ndelta. gamma, epsilon"]
    for text, ids in zip(texts, encoder.texts(texts)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 0]
    assert not {"alpha", " alpha", " epsilon"} & set(encoder.pieces) and {"beta", "\ralpha", "epsilon"} <= set(encoder.known)
    column = pa.array(["abc", None, "\u00e9\u00e9\u00e9", "", "abcdefgh", None])
    assert list(in_lots(column, 6)) == [(0, 3), (3, 5), (5, 6)] and list(in_lots(column[:0], 6)) == []


def test_tokens_equal_the_librarys():
    encoder = Encoder(public_tokenizer(), memory=50)
    odd = ["a  b", "\n x", " \n  y\t z\x0b w", "x\x85 y", " lead", "trail ", " ", "", "\n", "a\n's b", "it's 'll", "<|endoftext|> a", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b.", "\r\n a", "1\n2 3.4", "a\x1c b"]
    texts = [*odd, *(r[1] or "" for r in ROWS)]
    for text, ids in zip(texts, encoder.texts(texts)):
        assert ids.tolist() == _ids(text), text


def _ids(text):
    return [*Tokenizer.from_file(public_tokenizer()).encode(text or "", add_special_tokens=False).ids, 0]


def test_packing(spark, docs, no_docs):
    got = packing.pack(docs, public_tokenizer(), length=64, group=5).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, text, *_ in ROWS:
        ids, copies = np.array(_ids(text), "<u4"), sum(r[0] == doc for r in ROWS)
        assert sum(r.length for r in by_doc[doc]) == copies * len(ids)
        for r in by_doc[doc]:
            assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids[r.start : r.start + r.length].tobytes()))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(no_docs, public_tokenizer()).count() == 0


def test_first_fit():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 100, 300).tolist()
    room, want = [], {}
    for i in sorted(range(300), key=lambda i: -sizes[i]):
        b = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if b == len(room):
            room.append(100)
        want[i] = (b, 100 - room[b])
        room[b] -= sizes[i]
    assert packing.first_fit_decreasing(sizes, 100) == [want[i] for i in range(300)]
    assert packing.first_fit_decreasing([], 100) == []


def test_token_index(spark, docs, no_docs, tmp_path):
    path = str(tmp_path / "index")
    token_index.write_index(docs, path, public_tokenizer())
    got = sorted(token_index.read_documents(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    want = Counter((r[0], len(ids := _ids(r[1])), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in ROWS)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    found = {r.doc_id: r.ids for r in token_index.find_documents(spark, path, [1, 5, 12, 99, -4]).collect()}
    assert found == {d: _ids(t) for d, t in ((1, ROWS[0][1]), (5, LONG), (12, ROWS[0][1]))}
    empty = str(tmp_path / "none")
    token_index.write_index(no_docs, empty, public_tokenizer())
    assert token_index.read_documents(spark, empty).count() == 0


def test_perfect_hash():
    keys = token_index.mix(np.arange(5_000, dtype=np.uint64), 7)
    index = token_index.PerfectHash.load(token_index.PerfectHash.of(keys).dump())
    assert sorted(index.slots(keys)) == list(range(5_000))
    strange = token_index.mix(np.arange(5_000, 9_000, dtype=np.uint64), 7)
    slots = index.slots(strange)
    prints = np.zeros(5_000, "<u4")
    prints[index.slots(keys)] = token_index.fingerprints(keys)
    assert not (prints[slots[slots >= 0]] == token_index.fingerprints(strange[slots >= 0])).any()


def test_url_filter(spark):
    model = url_filter.train(url_filter.labelled_urls(spark))
    urls = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?q#f"), (5, "http://example.net"), (6, "http://net/"), (7, "http://x.org/fr/1"),
        (8, "http://example.com/de/1"), (9, "HTTP://www.casino-win.example.com?x"), (10, "http://library.example.com/en/1"), (10, "http://library.example.com/en/1"), (None, "a://b://c/d"),
    ]
    pages = spark.createDataFrame([(*u, "x") for u in urls], "page_id long, url string, verdict string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, model).collect()}
    exact = {r[:4] for r in got}
    assert {(4, "a.example.net", "/en/x", "example.net/en/"), (5, "example.net", "", None), (6, "net", "/", "net/"), (7, "x.org", "/fr/1", "org/fr/")} <= exact
    assert {(1, "", "", None), (2, "", "", None), (3, "", "", None), (8, "example.com", "/de/1", "example.com/de/"), (None, "b:", "//c/d", None)} <= exact
    assert {(9, "www.casino-win.example.com", "", None, "block"), (10, "library.example.com", "/en/1", None, "allow"), (8, "example.com", "/de/1", "example.com/de/", "block")} <= got
    assert url_filter.judge_urls(pages.limit(0), model).count() == 0


def test_url_model_on_pages(spark):
    """The pages' hosts, none of which is in the labelled table: the six of unwanted kinds are blocked, others are not."""
    judged = url_filter.judge_urls(spark.read.parquet(f"{SF}/pages.parquet"), url_filter.train(url_filter.labelled_urls(spark)), rules=())
    bad = F.col("host").rlike("casino-win|free-bets|cheap-pills|adult-x|spam-farm|ads-track")
    right = judged.select((bad == (F.col("verdict") == "block")).alias("right"), bad.alias("bad")).groupBy("bad").agg(F.avg(F.col("right").cast("int")).alias("share"))
    assert all(r.share >= 0.95 for r in right.collect())


def test_shards(spark, docs, no_docs):
    got = sharding.shard_documents(docs, shards=4).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    texts = defaultdict(set)
    for r in got:
        texts[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    assert sharding.shard_documents(no_docs).count() == 0


def test_smallest_capacity(spark):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 60, 40).tolist() + [300]
    starts = np.r_[0, np.cumsum(sizes)].tolist()
    groups = spark.createDataFrame(list(zip(starts[:-1], starts[1:])), "start long, end long")
    line = sharding.Line(groups, starts[-1])

    def parts(capacity):
        n, room = 1, capacity
        for s in sizes:
            n, room = (n, room - s) if s <= room else (n + 1, capacity - s)
        return n

    want = next(c for c in range(max(sizes), sum(sizes) + 1) if parts(c) <= 5)
    assert sharding.smallest_capacity(line, max(sizes), 5, width=4) == want
    borders = [0, *sharding.cuts(line, want, 5), starts[-1]]
    assert all(b - a <= want for a, b in zip(borders, borders[1:])) and set(borders) <= set(starts)


def _run_sql(sql, tmp_path, docs, **more):
    con = duckdb.connect()
    for name, df in {"documents": docs, **more}.items():
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        con.execute(f"create view {name} as select * from '{tmp_path / name}/*.parquet'")
    return con.execute(sql).fetchall()


def test_quality(spark, docs, no_docs):
    judged = quality.judge(docs.filter("doc_id is null or doc_id <> 12")).collect()
    rows = {r.doc_id: r for r in judged}
    assert rows[2].n_words == rows[3].n_words == rows[4].n_words == 0 and not rows[2].kept
    assert (rows[9].n_dup_lines, rows[9].n_words, rows[9].n_repeat_words) == (1, 20, 20)
    assert rows[5].base_failed and rows[5].n_words == 30_000
    assert quality.judge(no_docs).count() == 0


def test_quality_sketches_merge(spark):
    measures = quality.measured(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source"))
    odd, even = measures.filter("doc_id % 2 = 1"), measures.filter("doc_id % 2 = 0")
    parts = quality.sketches(odd).unionByName(quality.sketches(even))
    whole = quality.sketches(measures)
    key = ["level", "lang", "source"]
    assert sorted(map(str, quality.fences(parts).orderBy(*key).collect())) == sorted(map(str, quality.fences(whole).orderBy(*key).collect()))


def test_quality_fences_follow_their_group(spark):
    """Two sources with other habits get other fences, and the same document another verdict."""
    plain = [f"word{i} " * 1 + " ".join(f"w{(i * 7 + k) % 900}x{k}" for k in range(80)) for i in range(150)]
    rows = [(i, t, "en", "plain") for i, t in enumerate(plain)]
    rows += [(1_000 + i, t + " #" * (20 + i % 20), "en", "symbols") for i, t in enumerate(plain)]
    rows += [(5_000, plain[0] + " #" * 30, "en", "plain"), (5_001, plain[0] + " #" * 30, "en", "symbols"), (5_001, plain[0] + " #" * 30, "en", "symbols")]
    rows += [(6_000, plain[0], "en", "small"), (6_001, plain[0] + " #" * 75, "en", "small")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {(r.level, r.source): r.max_symbols for r in quality.fences(quality.sketches(quality.measured(table))).collect()}
    assert found["source", "plain"] < 300 < found["source", "symbols"] and ("source", "small") not in found
    kept = {r.doc_id: r.kept for r in quality.judge(table).collect()}
    assert not kept[5_000] and kept[5_001] and all(kept[i] and kept[1_000 + i] for i in range(150)) and kept[6_000]


def test_quality_value_on_the_fence(spark):
    names = ["doc_id", *quality.SKETCHED, "lang", "source", "base_failed"]
    rows = [(i, i % 2, 0, 0, 0, 100, 10, 500, "en", "s", False) for i in range(200)]
    limits = quality.fences(quality.sketches(spark.createDataFrame(rows, names))).filter("level = 'source'").first()
    assert limits.max_symbols == 1 + quality.STEPS * 10  # one event in 100 words is 10 per thousand
    edge = [(900 + j, limits.max_symbols + j, 0, 0, 0, 100, 10, 500, "en", "s", False) for j in (0, 1)]
    kept = {r.doc_id: r.kept for r in quality.with_fences(spark.createDataFrame(rows + edge, names)).collect()}
    assert kept[900] and not kept[901]


def test_pii_candidates_beside_longer_ones():
    """A candidate that ends far behind the next one's end hides no exact span from either."""
    text = "x.2125550187[at]10.20.30.40 call"
    base, loose = pii.found_in(text)
    plain = [c for c in set(pii.loose_spans(text)) if all(c[2] <= s or e <= c[1] for _, s, e in base)]
    assert sorted(c[:3] for c in loose) == sorted(plain) and plain


def test_pii_spans():
    text = "x a.b@c.de_f@g.org 1.2.3.4 1.2.3.256 y 4111 1111 1111 1111 +1 (262) 555-7240. @ +1 2 " + "9" * 5_000
    spans = {(pii.KINDS[k], text[s:e]) for k, s, e in pii.base_spans(text)}
    assert spans == {("email", "a.b@c.de"), ("email", "_f@g.org"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (262) 555-7240")}


def test_pii(spark, docs, no_docs):
    got = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert [tuple(s) for s in got[None].base] == [(0, 17, 32)] and all(not r.base for d, r in got.items() if d is not None)
    assert pii.find_pii(docs).count() == len(ROWS) and pii.find_pii(no_docs).count() == 0
    more = spark.createDataFrame([(1, "please call (212) 555-0187 now"), (2, "order 4821-555-0187 shipped"), (3, "sum 7086638319846192 of")], "doc_id long, text string")
    added = {r.doc_id: [tuple(s) for s in r.added] for r in pii.find_pii(more).collect()}
    assert added == {1: [(3, 12, 26)], 2: [], 3: []}
    hidden = pii.find_pii(docs).filter("doc_id is null").crossJoin(docs.filter("doc_id is null").select("text"))
    assert hidden.select(pii.redacted(F.col("text"), F.col("base"))).first()[0] == "no id here, mail [email]"


def test_licenses(spark, docs, no_docs):
    header = "/* Licensed under the Apache License, Version 2.0 (the \"License\");\n you may not use this file except in compliance with the License. */ Released under the MIT License."
    rows = [(1, header), (2, None), (3, "Licensed under CC BY-NC 4.0.\nx"), (4, "licensed under"), (3, "Licensed under CC BY-NC 4.0.\nx")]
    got = [(r.doc_id, ",".join(r.licenses), r.n_known) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [(1, "Apache-2.0,MIT", 3), (2, "", 0), (3, "CC-BY-NC-4.0", 1), (3, "CC-BY-NC-4.0", 1), (4, "", 0)]
    assert licenses.scan(docs).filter("n_known > 0").count() == 0 and licenses.scan(no_docs).count() == 0


def test_decontaminate(spark, docs, no_docs, tmp_path):
    items = spark.createDataFrame([(1, "Own words, of SEVEN"), (2, None), (3, "..."), (4, LINE), (4, LINE), (5, LONG[:200])], "item_id long, text string")
    own = docs.filter("doc_id is not null and doc_id <> 12")
    for part in (1, 200_000):
        got = decontaminate.contamination(own, items, part=part)
        rows = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), r.contaminated) for r in got.collect()]
        want = _run_sql(decontaminate.SQL, tmp_path, own, benchmark=items.filter("text is not null").distinct())
        assert sorted(rows) == sorted((w[0], w[1], w[2], w[3], w[5]) for w in want)
    assert decontaminate.contamination(docs, items).count() == len(ROWS)
    assert decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(no_docs, items).count() == 0


def test_line_dedup(spark, docs, no_docs):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_shared_lines(docs).collect()}
    assert got[7] == (4, 1, "own words of seven\n\n") and got[8] == (2, 1, "own words of eight")
    assert got[9] == (2, 2, "") and got[10] == (1, 1, "") and got[11] == (3, 0, ROWS[10][1]) and got[2] == (1, 0, "") and got[5] == (1, 0, LONG)
    assert line_dedup.drop_shared_lines(docs).count() == len(ROWS) and line_dedup.drop_shared_lines(no_docs).count() == 0


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "ngram_jaccard", "decontaminate", "packing"]
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    left = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert left and left < ids


def test_pipeline_odd_rows(spark, docs):
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF)
        assert rows.count() <= 40 * len(ROWS) and (name == "packing" or rows.columns == at.columns), name
