"""Jaccard join of word-shingle sets, with set relations to skip most of the comparisons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clusters import connected_components
from ..operators.skew import lookup
from ..spark_env import discard, materialize
from .common import inputs, ship, table
from .shingles import shingle_set
from .token_index import mix

WORDS = 4
PERCENT = 85
# Shared shingles that go to the end of every set's order, and the texts that one count looks at
# together. The list holds 8 bytes each and is broadcast.
COMMON = 300_000
LOT = 4_000_000
LOT_MIN = 4
# Ids that a broadcast filter may hold; more go through a shuffle.
MAX_IDS = 2_000_000
# Sets that are compared with each other in one group; larger families are split at random.
GROUP = 2_000
# Shingles of one such group: 8 bytes each in the task that compares it.
MASS = 16_000_000
# A set joins the family of a pivot that stands for this share of its prefix, in hundredths.
VOTES = 20
NO_ID = -(2**63)


def least_overlap(n: int, m: int, percent: int) -> int:
    """Shared shingles that sets of ``n`` and ``m`` need: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def probe_length(n: int, percent: int) -> int:
    """Of ``n`` ordered shingles, how many a partner of any size must share one of."""
    return n - -(-percent * n // 100) + 1


def common_shingles(docs: DataFrame, words: int, limit: int = COMMON) -> np.ndarray:
    """The shingles found in most texts, rarest first: at most ``limit``, from counts over all texts.

    Tasks count lots of texts and pass on what a lot holds ``LOT_MIN`` times. The counts only set
    the order of shingles within sets; any order gives the same join.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def lot() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LOT_MIN
            return pa.RecordBatch.from_arrays([pa.array(tokens[often]), pa.array(n[often].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for text in batch.column(0):
                own = shingle_set(text.as_py(), words)
                held.append(own)
                size += len(own)
                if size >= LOT:
                    yield lot()
                    held, size = [], 0
        if held:
            yield lot()

    found = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "token").limit(limit).select("token").toPandas()
    return top["token"].to_numpy(np.int64)[::-1].copy()


def described(docs: DataFrame, common: np.ndarray, words: int, percent: int) -> DataFrame:
    """``id, n, key, prefix``: set size, 128-bit hash of the set, and the shingles that any linked
    set shares one of: the rarest by the common order, then by hash."""
    spark = docs.sparkSession
    order = np.argsort(common)
    shared = spark.sparkContext.broadcast((common[order], order))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, rank = shared.value
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = shingle_set(text.as_py(), words)
                n = len(own)
                prefix = _ordered(own, tokens, rank)[: probe_length(n, percent)] if n else own
                a = int(mix(own.view(np.uint64), 41).sum(dtype=np.uint64)) if n else 0
                b = int(np.bitwise_xor.reduce(mix(own.view(np.uint64), 43))) if n else 0
                rows.append((doc, n, f"{n}-{a:x}-{b:x}", prefix))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                names=["id", "n", "key", "prefix"],
            )

    return docs.select("id", "text").mapInArrow(describe, "id long, n long, key string, prefix array<long>")


def _ordered(own: np.ndarray, tokens: np.ndarray, rank: np.ndarray) -> np.ndarray:
    if not len(tokens):
        return own
    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
    often = tokens[at] == own
    return np.r_[own[~often], own[often][np.argsort(rank[at[often]], kind="stable")]]


def _only(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on the columns of ``ids``, which are broadcast when they are few."""
    small = ids.count() <= MAX_IDS
    return rows.join(F.broadcast(ids) if small else ids.hint("merge"), ids.columns, how)


def shared_entries(prefixes: DataFrame, percent: int) -> DataFrame:
    """``token, block, rep, n, pos``: index lists of prefix shingles that two sets or more share.

    A list is cut into blocks by set size, each as wide as two linked sets can differ, so a set
    looks at its own block and the next ones only. Entries that meet no set there are left out.
    """
    ratio = np.log(100 / percent)
    entries = prefixes.select(
        F.posexplode("prefix").alias("pos", "token"), F.col("id").alias("rep"), "n", F.floor(F.log(F.col("n")) / F.lit(float(ratio))).cast("int").alias("block")
    ).repartition("token")
    seen = entries.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("token")
    several = materialize(entries.join(seen.hint("merge"), "token").select("token", "block", "rep", "n", "pos"), "list-entries")
    sizes = several.groupBy("token", "block").agg(F.count(F.lit(1)).alias("c"))
    near = sizes.select("token", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), "c")
    company = near.groupBy("token", "block").agg(F.sum("c").alias("c")).filter("c > 1").select("token", "block")
    lists = materialize(several.join(company, ["token", "block"], "left_semi"), "list-blocks")
    discard(several)
    return lists


def pivots(lists: DataFrame, percent: int) -> DataFrame:
    """``rep, n, pivot``: for each set the one that it most probably is most similar to, or itself.

    The first set of a block stands for it; the pivot is the one that stands for most of a set's
    blocks, if these are ``VOTES`` hundredths of its prefix or more. Sets that merely share a
    passage stay by themselves. The choice steers the work and never the result.
    """
    first = lists.groupBy("token", "block").agg(F.min("rep").alias("hub"))
    votes = lists.select("token", "block", "rep", "n").join(first, ["token", "block"]).groupBy("rep", "n", "hub").agg(F.count(F.lit(1)).alias("v"))
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100)) + 1
    best = votes.groupBy("rep", "n").agg(
        F.min(F.when(100 * F.col("v") >= VOTES * prefix, F.struct((-F.col("v")).alias("v"), F.col("hub")))).alias("b")
    )
    return best.select("rep", "n", F.coalesce("b.hub", "rep").alias("pivot"))


def with_sets(places: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``places`` (``rep`` and more) with ``tokens``, the sorted shingles of the text as 8-byte numbers.

    Places go to the texts: broadcast when they are few, so that neither texts nor sets are
    shuffled here, and by a shuffle join beyond. Rows that repeat an id with another text are
    sets of their own under one name.
    """
    more = [f for f in places.schema.fields if f.name != "rep"]
    few = places.count() <= MAX_IDS
    texts = docs.select(F.col("id").alias("rep"), "text")
    met = texts.join(F.broadcast(places) if few else places.hint("merge"), "rep").select("rep", "text", *(f.name for f in more))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = "", b""  # the places of one text follow each other
        for batch in batches:
            sets = []
            for text in batch.column(1):
                if (new := text.as_py()) != last:
                    last, own = new, shingle_set(new, words).astype("<i8").tobytes()
                sets.append(own)
            rest = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *rest, pa.array(sets, pa.binary())], names=["rep", *(f.name for f in more), "tokens"])

    return met.mapInArrow(collect, ", ".join(["rep long", *(f"{f.name} {f.dataType.simpleString()}" for f in more), "tokens binary"]))


def derived_links(pivot: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``sets`` link, from what each lacks of the pivot and has besides it.

    With ``-x`` the pivot's shingles that ``x`` lacks and ``+x`` those of ``x`` outside the pivot,
    |x and y| = |pivot| - |-x| - |-y| + |-x and -y| + |+x and +y|.
    """
    count, n = len(sets), np.array([len(s) for s in sets], np.float32)  # exact below 2**24 shingles
    both = np.full((count, count), len(pivot), np.float32)
    lacks, extra = [], []
    for s in sets:
        lacks.append(np.setdiff1d(pivot, s, assume_unique=True))
        extra.append(np.setdiff1d(s, pivot, assume_unique=True))
    missing = np.array([len(x) for x in lacks], np.float32)
    both -= missing[:, None]
    both -= missing[None, :]
    for parts in (lacks, extra):
        _add_shared_counts(both, parts)
    both *= 100 + percent
    return both >= percent * (n[:, None] + n[None, :])


def _add_shared_counts(total: np.ndarray, parts: list[np.ndarray], width: int = 2_048) -> None:
    """Adds how many numbers each two of ``parts`` share; the diagonal does not matter."""
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    if not len(owner):
        return
    _, column, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = owner[keep], place[column[keep]]
    for start in range(0, int(shared.sum()), width):
        own = (column >= start) & (column < start + width)
        block = np.zeros((len(parts), width), np.float32)
        block[row[own], column[own] - start] = 1
        total += block @ block.T


def forest(names: np.ndarray, links: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges that connect what ``links`` connects, one fewer than each component has members."""
    left, a, b = np.ones(len(names), bool), [], []
    for root in range(len(names)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            at = front.pop()
            for new in np.flatnonzero(links[at] & left):
                left[new] = False
                front.append(new)
                a.append(int(names[new]))
                b.append(int(names[at]))
    return a, b


def family_links(groups: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b``: links within each ``pivot, part`` of ``groups`` (``rep, pivot, part``), as forests.

    The pivot is a member of every part, so the parts of a large family meet in it.
    """
    heads = groups.select("pivot", "part").distinct().select("pivot", "part", F.col("pivot").alias("rep"))
    rows = groups.filter(F.col("rep") != F.col("pivot")).select("pivot", "part", "rep").unionByName(heads)
    full = with_sets(rows, docs, words)

    def links(key: tuple, rows: pa.Table) -> pa.Table:
        names = rows.column("rep").to_numpy()
        own = [np.frombuffer(t, "<i8") for t in rows.column("tokens").to_pylist()]
        head = np.flatnonzero(names == key[0].as_py())
        a, b = forest(names, derived_links(own[head[0]] if len(head) else own[0], own, percent)) if len(own) > 1 else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return full.groupBy("pivot", "part").applyInArrow(links, "a long, b long")


def strays(families: DataFrame, component: DataFrame, group: int = GROUP) -> DataFrame:
    """``rep, pivot, part``: large families (``rep, n, pivot, part``) once more, each part with all
    members that lie outside the pivot's component. After that every two members are compared or in
    one component.

    These members are dealt to chunks under the bounds of a part, and each part meets each chunk in
    a group of its own, so a group is at most about twice a part, however many members stray.
    """
    large = families.groupBy("pivot").agg((F.max("part") + 1).alias("parts"), F.count(F.lit(1)).alias("size")).filter("parts > 1")
    members = lookup(families, large, "pivot", "size", F.col("rep")).select("rep", "n", "pivot", "part", "parts")
    placed = members.join(component, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    main = component.select(F.col("rep").alias("pivot"), F.col("comp").alias("main"))
    outside = placed.join(main, "pivot", "left").filter(~F.col("comp").eqNullSafe(F.col("main")))
    enough = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(group)), F.ceil(F.sum("n") / F.lit(MASS))).cast("int")
    chunks = outside.groupBy("pivot").agg(enough.alias("chunks"), F.count(F.lit(1)).alias("strays"))
    # Dealt by another hash than the parts are.
    chunk = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("chunks")).cast("int")
    place = lambda part, chunk: (chunk.cast("long") * F.col("parts") + part).alias("part")
    dealt = lookup(outside, chunks, "pivot", "strays", F.col("rep"))
    everywhere = dealt.select("rep", "pivot", "parts", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("at"))
    everywhere = everywhere.select("rep", "pivot", place(F.col("at"), F.col("chunk")))
    met = lookup(members, chunks, "pivot", "strays", F.col("rep"))
    own = met.select("rep", "pivot", "part", "parts", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return own.select("rep", "pivot", place(F.col("part"), F.col("chunk"))).unionByName(everywhere).distinct()


def bitmaps(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``rep, size, bits``: for each set, which of 4 to 8 times as many places are hit an odd
    number of times."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity_bits(s) for s in sets], pa.binary())],
                names=["rep", "size", "bits"],
            )

    found = _only(docs.select("id", "text"), ids, "left_semi")
    return materialize(found.mapInArrow(collect, "rep long, size long, bits binary"), "bitmaps")


def parity_bits(own: np.ndarray) -> bytes:
    places = 8 * (1 << max(len(own) - 1, 7).bit_length()) // 2
    hits = np.bincount(own & (places - 1), minlength=places) & 1
    return np.packbits(hits.astype(np.uint8)).tobytes()


def most_overlap(n: int, x: bytes, m: int, y: bytes) -> int:
    """No more shingles than this are shared: each place that differs is one that is not."""
    a, b = (np.frombuffer(z, np.uint8) for z in (x, y))
    if len(a) > len(b):
        a, b = b, a
    while len(b) > len(a):  # places are the low bits of a hash, so halves lie on each other
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return (n + m - int(np.bitwise_count(a ^ b).sum())) // 2


def possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` that the bitmaps leave open."""
    side = lambda c: maps.select(F.col("rep").alias(c), F.struct("size", "bits").alias(f"{c}_map")).hint("merge")
    full = pairs.join(side("a"), "a").join(side("b"), "b")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                100 * (i := most_overlap(x["size"], x["bits"], y["size"], y["bits"])) >= percent * (x["size"] + y["size"] - i)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "a_map", "b_map").mapInArrow(look, "a long, b long").distinct()


def open_pairs(lists: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs that may link, are not compared yet and lie in different components.

    ``known`` has ``rep, pivot, comp``; sets of one family have been compared. In each list the component with most entries is
    skipped as one side: a list within one component gives nothing. The other entries meet their
    own and the next blocks, under the bounds on sizes and on places in the prefix.
    """
    entries = lists.join(known.hint("merge"), "rep")
    by_comp = entries.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = by_comp.groupBy("token").agg(F.max(F.struct("c", "comp")).alias("m"), F.count(F.lit(1)).alias("comps"))
    mixed = main.filter("comps > 1").select("token", F.col("m.comp").alias("main"))
    there = materialize(entries.join(mixed, "token"), "mixed-lists")
    left = there.filter(F.col("comp") != F.col("main"))
    names = ["rep", "n", "pos", "comp", "pivot"]
    x = left.select("token", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), *(F.col(c).alias(f"x_{c}") for c in names))
    y = there.select("token", "block", *(F.col(c).alias(f"y_{c}") for c in names))
    n, m = F.col("x_n"), F.col("y_n")
    need = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    reach = 1 + F.least(n - F.col("x_pos") - 1, m - F.col("y_pos") - 1)
    compared = (F.col("x_pivot") == F.col("y_pivot")) | (F.col("x_pivot") == F.col("y_rep")) | (F.col("y_pivot") == F.col("x_rep"))
    met = x.join(y, ["token", "block"]).filter(
        (F.col("x_comp") != F.col("y_comp")) & (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (reach >= need) & ~compared
    )
    return met.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).distinct()


def checked(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``a, b`` that link, by whole sets; ``a``'s set meets at most ``GROUP`` others at once."""
    count = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c"))
    parts = F.ceil(F.col("c") / F.lit(GROUP)).cast("int")
    dealt = pairs.join(count, "a").select("a", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"), "b")
    heads = dealt.select("a", "part").distinct().select("a", "part", F.col("a").alias("rep"), F.lit(True).alias("head"))
    rows = dealt.select("a", "part", F.col("b").alias("rep"), F.lit(False).alias("head")).unionByName(heads)
    full = with_sets(rows, docs, words)

    def links(key: tuple, rows: pa.Table) -> pa.Table:
        heads = np.array(rows.column("head").to_pylist(), bool)
        names = rows.column("rep").to_numpy()
        own = [np.frombuffer(t, "<i8") for t in rows.column("tokens").to_pylist()]
        found: list[int] = []
        for base in (own[i] for i in np.flatnonzero(heads)):
            for i in np.flatnonzero(~heads):
                both = len(np.intersect1d(base, own[i], assume_unique=True))
                if 100 * both >= percent * (len(base) + len(own[i]) - both):
                    found.append(int(names[i]))
        return pa.table({"a": pa.array([key[0].as_py()] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return full.groupBy("a", "part").applyInArrow(links, "a long, b long").distinct()


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", common: int = COMMON, group: int = GROUP
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents joined by chains of linked sets.

    Two sets link when their Jaccard similarity is at least ``percent`` hundredths; every link
    counts. Equal sets are one set from the start. A text without words has an empty set, which
    links with nothing. Rows that repeat an id are one document; a missing id is a document of
    its own that sorts first and is named by null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = inputs(docs, doc_id, text).select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), "text")
    rows = materialize(described(texts, common_shingles(texts, words, common), words, percent), "set-rows")
    classes = materialize(
        rows.filter("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "set-classes"
    )
    several = classes.filter("copies > 1")
    copies = lookup(rows.filter("n > 0").select("id", "key"), several, "key", "copies", F.col("id")).filter(F.col("id") != F.col("rep"))
    lone = _only(rows.filter("n > 0").select("id", "key", "n", "prefix"), materialize(copies.select("id", "key").distinct(), "copies"), "left_anti")
    lists = shared_entries(lone, percent)
    # From here on the prefixes are in the lists.
    wide, rows = rows, materialize(rows.select("id", "n", "key"), "set-sizes")
    discard(wide)
    chosen = pivots(lists, percent)
    sizes = chosen.groupBy("pivot").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("mass"))
    parts = F.greatest(F.ceil(F.col("c") / F.lit(group)), F.ceil(F.col("mass") / F.lit(MASS))).cast("int")
    families = materialize(
        lookup(chosen, sizes.withColumn("size", F.col("c")), "pivot", "size", F.col("rep")).select("rep", "n", "pivot", F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part")),
        "families",
    )
    related = families.filter(F.col("rep") != F.col("pivot"))
    first = materialize(family_links(related, texts, words, percent), "family-links")
    again = materialize(strays(related, _components(first), group), "strays")
    first = materialize(first.unionByName(family_links(again, texts, words, percent)), "family-links")
    component = _components(first)
    known = families.drop("n").join(component, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    pairs = materialize(open_pairs(lists, known, percent), "open-pairs")
    discard(lists)
    maps = bitmaps(texts, _ids(pairs, "a", "b"), words)
    pairs = materialize(possible(pairs, maps, percent), "possible-pairs")
    discard(maps)
    second = materialize(checked(pairs, texts, words, percent), "checked-links")
    final = _components(first.unionByName(second))
    named = classes.join(final, "rep", "left").select("key", "copies", F.coalesce("comp", "rep").alias("component"))
    joined = lookup(rows.select("id", "n", "key"), named, "key", "copies", F.col("id"), "left")
    blank = lambda c: F.when(c != NO_ID, c)
    return joined.select(
        blank(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), blank(F.coalesce("component", "id")).alias("component_id")
    )


def _ids(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(F.explode(F.array(*columns)).alias("id")).distinct()


def _components(edges: DataFrame) -> DataFrame:
    return connected_components(edges).select(F.col("node").alias("rep"), F.col("component").alias("comp"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < {WORDS} then [array_to_string(ws, ' ')]
  else list_transform(range(1, len(ws) - {WORDS - 2}), lambda i: array_to_string(ws[i:i + {WORDS - 1}], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
i as (select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by all),
link as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
reach(a, b) as (select a, b from link union select reach.a, link.b from reach join link on reach.b = link.a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(min(reach.b), w.doc_id)) as component_id
from w left join n using (doc_id) left join reach on reach.a = w.doc_id group by w.doc_id, n.n
"""

QUERIES = {"op1_ngram_jaccard": (op1_ngram_jaccard, SQL)}
