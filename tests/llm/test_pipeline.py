"""The stages one after the other against a plain chain over lists, with rows that share an id."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
from tokenizers import Tokenizer

import corpus_pipeline
from commentlens.llm import quality
from commentlens.llm.tokens import public_tokenizer

SPACE = " \t\n\x0b\x0c\r"
LINE = "one long line that a good many of these documents hold in common"
PASSAGE = "the quick grey wolf crossed eleven wide rivers before dawn on monday"


def _words(rng, n):
    return " ".join(f"{a}{b}" for a, b in zip(rng.choice(["ka", "lo", "mi", "tu", "re"], n), rng.integers(0, 900, n)))


def _rows():
    rng = np.random.default_rng(6)
    texts = [_words(rng, 70) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, f"{_words(rng, 55)}\n{LINE if i else LINE.upper() + '  '}\n{_words(rng, 5)}") for i in range(7)]
    rows += [(200, texts[3] + " end"), (201, texts[3] + " close"), (202, texts[4]), (203, texts[4].upper())]
    rows += [(300, _words(rng, 60) + " " + PASSAGE), (301, _words(rng, 60) + " " + PASSAGE.title() + "!"), (302, _words(rng, 60) + " the quick grey wolf crossed eleven wide rivers")]
    rows += [(7, "short"), (8, None), (None, _words(rng, 60)), (None, "too short"), (400, ""), (401, "same words " * 40), (402, _words(rng, 60) + " #$%" * 60)]
    rows += [(500 + i, LINE) for i in range(3)]
    return rows


def _kept(rows):
    documents = pd.DataFrame([(i, t, "en", "s") for i, (_, t) in enumerate(rows)], columns=["doc_id", "text", "lang", "source"])  # noqa: F841
    kept = {i for i, k in duckdb.sql(f"select doc_id, kept from ({quality._sql()})").fetchall() if k}
    return [r for i, r in enumerate(rows) if i in kept]


def _deduped(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
    where = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            where[key(line)].add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        gone = lambda line: len(key(line)) >= 40 and len(where[key(line)]) >= 5 and max(where[key(line)]) != (-1 if doc is None else doc)  # noqa: B023, E731
        left = [line for line in (text or "").split("\n") if not gone(line)]
        new = text if len(left) == len((text or "").split("\n")) else "\n".join(left)
        if new == text or new.strip(SPACE):
            out.append((doc, new))
    return out


def _one_of_each(rows, words=5, percent=80):
    sets = []
    for _, text in rows:
        parts = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
        sets.append({tuple(parts[i : i + words]) for i in range(max(len(parts) - words + 1, 1))} if parts else set())
    low = [-1 if d is None else d for d, _ in rows]
    ids = list(low)
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    return [r for r, i, m in zip(rows, ids, low) if i == m]


def _clean(rows):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    item = split(PASSAGE)
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    return [r for r in rows if not any(tuple(w[i : i + 10]) in windows for w in [split(r[1])] for i in range(len(w)))]


def test_stages_against_a_plain_chain(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (_kept, _deduped, _one_of_each, _clean)):
        path, before = str(tmp_path / name), len(rows)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs, rows = spark.read.parquet(path), plain(rows)
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(rows), name
        assert len(rows) < before or name == "line_dedup", name
    assert {7, None, 302, 106} <= {d for d, _ in rows} and not {300, 301, 201, 203, 402} & {d for d, _ in rows}
    tokenizer, pieces = Tokenizer.from_file(public_tokenizer()), Counter()
    for r in corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect():
        pieces[r.doc_id] += r.length
    wanted = Counter()
    for doc, text in rows:
        wanted[doc] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert pieces == wanted


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
