"""More-like-this matching without comparing all pairs.

1. Texts that are equal apart from case and white space collapse to one representative.
2. Each representative keeps its eligible words (document frequency inside the bounds) and its
   query: the words of highest tf-idf.
3. Representatives with the same query words share one *query*, those with the same eligible words
   share one *shape*. A query either matches a whole shape or none of it, so near copies that
   differ only in rare words (names, towns) are compared once.
4. A match needs ``need`` of the ``k`` query words and so misses at most ``k - need``. Of any
   ``k - need + e`` query words it must hold at least ``e``. Candidates are the shapes found in
   the posting lists of ``e`` of that many rarest words; every candidate is then checked exactly.
   No partner is lost, and no cap is set. Lists are met block by block (``blocks``), so candidates
   are neither shuffled nor stored.
5. Words are numbers from the vocabulary on: lists, candidates and checks carry 4 bytes a word.
6. Who only asks for numbers of matches gets them added up inside the blocks (``match_totals``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import counted, english_tokens, fingerprint, normalize_space, tokens, word_count, word_list
from ..rules.domain import NEIGHBOUR_STOP_WORDS
from ..spark_env import discard, materialize, release
from . import blocks
from .ranking import idf as bm25_idf
from .ranking import saturation
from .skew import lookup

# The ``e`` above. More probes read longer lists and make fewer candidates; five is a good balance.
PROBE_HITS = 5
# Documents of one query or shape that go to a block in one row.
MEMBERS = 1_000


@dataclass(frozen=True)
class Params:
    min_df: int = 100
    max_df_share: float | None = None
    max_terms: int = 40
    min_terms: int = 1
    match_share: float = 0.8
    min_words: int = 50
    split_rows: int | None = None  # without effect since lists are met in blocks; callers still pass it


@dataclass(frozen=True)
class Index:
    """``profiles``: one row per distinct text. ``members``: which documents have that text.

    An index that ``build_index`` made also has the stored ``vocabulary``, and its profiles without spelled words
    in ``numbered``: all work is done on these, and ``profiles`` is only a view that looks the words up.
    """

    profiles: DataFrame  # rep, terms array<string>, words array<int>, query array<struct<number,nd,score,term>>, shape, query_id
    members: DataFrame  # doc_id, rep
    params: Params
    numbered: DataFrame | None = None
    vocabulary: DataFrame | None = None  # number, term, nd, idf

    @property
    def rows(self) -> DataFrame:
        return self.profiles if self.numbered is None else self.numbered


def text_key(text: Column) -> Column:
    return F.sha2(F.lower(normalize_space(text)), 256)


def duplicate_groups(docs: DataFrame, text: Column, doc_id: str = "id_submission") -> DataFrame:
    """``fingerprint, representative, copies`` of texts with the same words, from two documents on.

    Groups compare whole word lists; the shown fingerprint is cut. Texts without a-z letters
    compare as they are, so that texts in other scripts are not all alike.
    """
    words = word_list(text)
    key = F.when(words == "", F.concat(F.lit("text "), text_key(F.coalesce(text, F.lit(""))))).otherwise(F.sha2(words, 256))
    return (
        docs.groupBy(key.alias("_key"))
        .agg(F.first(fingerprint(text)).alias("fingerprint"), F.min(doc_id).alias("representative"), F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .drop("_key")
    )


def build_index(
    docs: DataFrame, params: Params = Params(), doc_id: str = "id_submission", text: str = "text_data"
) -> Index:
    """Collapse copies, count document frequencies and pick the query words of each text."""
    present = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    # Each of the three tables below is read several times, so it is written once: the ids and text
    # keys, the words of each distinct text, and the document frequencies.
    keyed = materialize(present.select("doc_id", text_key(F.col("text")).alias("key")), "keys")
    groups = keyed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    groups = materialize(groups, "texts")
    members = materialize(keyed.join(groups.select("key", "rep"), "key").select("doc_id", "rep"), "members")

    # Words are counted inside the row of each text; rows that share an id are one text.
    reps = groups.select("rep", "weight")
    kept = present.join(reps.hint("merge"), present["doc_id"] == reps["rep"]).select("rep", "weight", "text")
    whole = kept.groupBy("rep").agg(F.first("weight").alias("weight"), F.collect_list("text").alias("texts"))
    words = F.flatten(F.transform("texts", tokens))
    held = materialize(whole.select("rep", "weight", counted(words).alias("held")), "words")
    corpus = groups.agg(F.sum("weight").cast("double").alias("n"))
    frequency = held.select("weight", F.explode("held.term").alias("term")).groupBy("term").agg(
        F.sum("weight").alias("df"), F.count(F.lit(1)).alias("nd")
    )
    eligible = frequency.crossJoin(F.broadcast(corpus)).filter(F.col("df") >= params.min_df)
    if params.max_df_share is not None:
        eligible = eligible.filter(F.col("df") <= F.col("n") * params.max_df_share)
    idf = (F.lit(1.0) + F.log(F.col("n") / (F.col("df") + 1))).alias("idf")
    # Numbers rise with the words, so that words of equal score are in order without being spelled.
    numbers = F.monotonically_increasing_id().alias("number")
    eligible = _dense(materialize(eligible.select("term", "nd", idf).orderBy("term").select("*", numbers), "frequencies"))
    # Both sides are stored tables, so Spark broadcasts a vocabulary under its limit of size and
    # otherwise splits the rows of a very common word itself. The rows go flat to the task of their
    # text: arrays of a few words each, made before the shuffle, would be larger.
    weighted = held.select("rep", F.explode("held").alias("h")).select("rep", "h.term", "h.n").join(eligible, "term")
    score = F.round(F.col("n") * F.col("idf"), 6).alias("score")
    per_text = weighted.select("rep", "number", "nd", score).repartition("rep").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("order"), "number", "nd"))).alias("ranked")
    )
    profiles = per_text.select(
        "rep",
        F.sort_array(_numbers(F.col("ranked"))).alias("words"),
        F.transform(F.slice("ranked", 1, params.max_terms), lambda r: F.struct(r["number"].alias("number"), r["nd"].alias("nd"), (-r["order"]).alias("score"))).alias("query"),
    )
    profiles = profiles.withColumns({"shape": _signature(F.col("words")), "query_id": _signature(F.sort_array(_numbers(F.col("query"))))})
    profiles = materialize(profiles, "profiles")
    discard(keyed, groups, held)
    release(docs.sparkSession)
    return Index(_spelled(profiles, eligible), members, params, profiles, eligible)


def _dense(eligible: DataFrame) -> DataFrame:
    """The words with numbers without gaps, in the same order: 4 bytes each. One row a partition goes to the driver."""
    part = F.shiftright("number", 33).cast("int")
    sizes = {r[0]: r[1] for r in eligible.groupBy(part).agg(F.count(F.lit(1))).collect()}
    before = [sum(n for p, n in sizes.items() if p < i) for i in range(max(sizes, default=0) + 1)]
    place = F.get(F.array(*(F.lit(n).cast("long") for n in before)), part) + F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    return eligible.withColumn("number", place.cast("int"))


def _spelled(profiles: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``profiles`` with the sorted words of each text, and the words of its query."""
    held = profiles.select("rep", F.explode("words").alias("number")).join(vocabulary.select("number", "term"), "number")
    names = held.groupBy("rep").agg(F.sort_array(F.collect_list("term")).alias("terms"), F.map_from_entries(F.collect_list(F.struct("number", "term"))).alias("names"))
    spelled = F.transform("query", lambda q: q.withField("term", F.element_at("names", q["number"])))
    return profiles.join(names, "rep").select("rep", "terms", "words", spelled.alias("query"), "shape", "query_id")


def query_table(index: Index) -> DataFrame:
    """Query words of each distinct text: ``rep, rank, term, score``."""
    asked = index.rows.select("rep", F.posexplode("query").alias("pos", "q")).select("rep", (F.col("pos") + 1).alias("rank"), "q.*")
    if index.vocabulary is not None:
        asked = asked.join(index.vocabulary.select("number", "term"), "number")
    return asked.select("rep", "rank", "term", "score")


def _signature(numbers: Column) -> Column:
    """16 bytes that name a sorted array of word numbers."""
    return F.unhex(F.md5(F.array_join(numbers.cast("array<string>"), " ")))


def _numbers(words: Column) -> Column:
    return F.transform(words, lambda w: w["number"])


def shape_of(index: Index) -> DataFrame:
    """``rep, shape`` for every distinct text."""
    return index.rows.select("rep", "shape")


def query_of(index: Index) -> DataFrame:
    """``rep, query_id`` for every distinct text with enough query words."""
    return index.rows.filter(F.size("query") >= index.params.min_terms).select("rep", "query_id")


def query_words(index: Index, seed_reps: DataFrame | None = None) -> DataFrame:
    """``query_id, numbers, need, hits, probes``: the distinct queries of the texts in ``seed_reps``.

    ``probes`` are the rarest words (``number, nd``) of which a match holds ``hits``. Word
    statistics are the same in every profile, so any row of a group can stand for it.
    """
    p = index.params
    seeds = index.rows.filter(F.size("query") >= p.min_terms)
    if seed_reps is not None:
        seeds = seeds.join(seed_reps.select("rep").distinct(), "rep", "left_semi")
    numbers = F.sort_array(_numbers(F.col("query")))
    rarest = F.sort_array(F.transform("query", lambda q: F.struct(q["nd"].alias("nd"), q["number"].alias("number"))))
    need = F.greatest(F.lit(1), F.floor(F.size("query") * F.lit(p.match_share)).cast("int"))
    wanted = seeds.select("query_id", numbers.alias("numbers"), rarest.alias("rarest"), need.alias("need"))
    hits = F.least(F.lit(PROBE_HITS), F.col("need"))
    probes = F.slice("rarest", F.lit(1), F.size("numbers") - F.col("need") + hits)
    return wanted.select("query_id", "numbers", "need", hits.alias("hits"), probes.alias("probes")).dropDuplicates(["query_id"])


def shape_words(index: Index) -> DataFrame:
    """``shape, words`` (their numbers) of the distinct shapes."""
    return index.rows.select("shape", "words").dropDuplicates(["shape"])


def posting_heads(shapes: DataFrame) -> DataFrame:
    """``number, shape``: of the shapes that hold a word, the smallest."""
    return shapes.select("shape", F.explode("words").alias("number")).groupBy("number").agg(F.min("shape").alias("shape"))


def probe_rows(queries: DataFrame) -> DataFrame:
    """``number, query_id, hits``: one row for each probe."""
    return queries.select("query_id", "hits", F.explode("probes.number").alias("number"))


def held_often(met: DataFrame) -> DataFrame:
    """``query_id, shape`` pairs that meet in enough lists."""
    found = met.groupBy("query_id", "shape", "hits").agg(F.count(F.lit(1)).alias("found"))
    return found.filter(F.col("found") >= F.col("hits")).select("query_id", "shape")


def checked(candidates: DataFrame, queries: DataFrame, shapes: DataFrame) -> DataFrame:
    """The candidates whose shape holds enough of the query's words.

    They are written first: when they are few, only the words of those queries and shapes are shuffled.
    """
    candidates = materialize(candidates, "candidates")
    wanted = queries.select("query_id", "numbers", "need").join(candidates.select("query_id"), "query_id", "left_semi")
    held = shapes.select("shape", "words").join(candidates.select("shape"), "shape", "left_semi")
    shared = F.size(F.array_intersect("numbers", "words"))
    return candidates.join(wanted, "query_id").join(held, "shape").filter(shared >= F.col("need")).select("query_id", "shape")


def signature_matches(index: Index, seed_reps: DataFrame | None = None) -> DataFrame:
    """``query_id, shape`` pairs where the shape holds enough of the query's words.

    ``seed_reps`` (column ``rep``) restricts which texts act as queries. Queries and shapes are
    written once; that also tells Spark their sizes, by which it chooses joins.
    """
    queries, shapes = materialize(query_words(index, seed_reps), "queries"), materialize(shape_words(index), "shapes")
    found = blocks.stored_matches(queries, shapes, "matches")
    discard(queries, shapes)
    return blocks.together(found)


def similar_pairs(index: Index, seeds: DataFrame, targets: DataFrame) -> DataFrame:
    """All ``seed, doc_id`` pairs. The result itself is one row per pair; use the counts below
    when only totals are needed. ``seeds`` and ``targets`` have a ``doc_id`` column.

    Ids go with their query or shape to the blocks, which give out pairs of documents: neither matches
    nor pairs are shuffled, and the pairs are stored once.
    """
    doc_rep = index.members
    seed_rows = materialize(seeds.select("doc_id").join(doc_rep, "doc_id").join(query_of(index), "rep"), "seed-rows")
    target_rows = targets.select("doc_id").join(doc_rep, "doc_id").join(shape_of(index), "rep")
    queries = query_words(index, seed_rows.select("rep")).join(_member_lists(seed_rows, "query_id"), "query_id")
    shapes = shape_words(index).join(_member_lists(target_rows, "shape"), "shape")
    queries, shapes = materialize(queries, "queries"), materialize(shapes, "shapes")
    pairs = blocks.together(blocks.stored_matches(queries, shapes, "pairs"))
    discard(seed_rows, queries, shapes)
    return pairs.filter(F.col("seed") != F.col("doc_id"))


def _member_lists(rows: DataFrame, key: str) -> DataFrame:
    """``key, members``: the ids of ``rows`` (``doc_id`` and ``key``) in lists of ``MEMBERS`` on average at most."""
    return _lists(rows.select("doc_id", key), key, "doc_id", F.collect_list("doc_id").alias("members"))


def _lists(rows: DataFrame, key: str, spread: str, *lists: Column) -> DataFrame:
    large = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > MEMBERS)
    part = F.pmod(F.xxhash64(spread), F.ceil(F.col("_size") / MEMBERS))
    dealt = lookup(rows, large, key, "_size", F.col(spread), "left").select(*rows.columns, F.coalesce(part, F.lit(0)).alias("_part"))
    return dealt.groupBy(key, "_part").agg(*lists).drop("_part")


def match_totals(index: Index, seeds: DataFrame, targets: DataFrame, by: str) -> DataFrame:
    """Matches of each seed grouped by a column of the targets: ``seed, <by>, n``.

    Targets are counted per shape first and go with the shape to the blocks, which add them up: no
    match leaves a block, only one row of numbers for each query and block. The seed itself is taken out when it is a target.
    """
    doc_rep = index.members
    seed_rows = materialize(seeds.select("doc_id").join(doc_rep, "doc_id").join(query_of(index), "rep"), "seed-rows")
    rep_counts = targets.select("doc_id", by).join(doc_rep, "doc_id").groupBy("rep", by).agg(F.count(F.lit(1)).alias("n"))
    shape_counts = rep_counts.join(shape_of(index), "rep").groupBy("shape", F.col(by).alias("_by")).agg(F.sum("n").alias("n"))
    # In one order everywhere, so that equal lists compress.
    entries = F.sort_array(F.collect_list(F.struct("_by", "n")))
    lists = _lists(shape_counts, "shape", "_by", entries.alias("e")).select("shape", F.col("e._by").alias("held"), F.col("e.n").alias("times"))
    queries = materialize(query_words(index, seed_rows.select("rep")), "queries")
    shapes = materialize(shape_words(index).join(lists, "shape"), "shapes")
    found = blocks.together(blocks.stored_matches(queries, shapes, "match-counts"))
    discard(queries, shapes)
    # Dealt by query alone, so that lists are shuffled and not their rows.
    rows = found.repartition("query_id").select("query_id", F.explode(F.arrays_zip("held", "times")).alias("v"))
    totals = rows.groupBy("query_id", F.col("v.held").alias(by)).agg(F.sum("v.times").alias("n"))
    own = targets.select("doc_id", F.col(by).alias("_own"), F.lit(True).alias("_self"))
    return (
        seed_rows.join(own, "doc_id", "left")
        .join(totals, "query_id")
        .withColumn(
            "n",
            F.col("n") - F.when(F.col("_self") & F.col(by).eqNullSafe(F.col("_own")), 1).otherwise(0),
        )
        .filter(F.col("n") > 0)
        .select(F.col("doc_id").alias("seed"), by, "n")
    )


def nearest_matches(index: Index, heads: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """``query_id, shape`` as a stored table: of each shape of ``targets`` (``shape``), the matches with the queries of the
    ``most`` smallest different seeds (``heads``: ``query_id, seed``, the smallest of each query, which asks only with it)."""
    leads = materialize(heads.groupBy("query_id").agg(F.min("seed").alias("seed")), "heads")
    # Numbers rise with the seeds; ids that come twice have one.
    places = materialize(leads.select("seed").distinct().orderBy("seed").select("seed", F.monotonically_increasing_id().alias("place")), "places")
    wanted = leads.join(places, "seed").select("query_id", "place")
    queries = materialize(query_words(index, index.rows.join(leads.select("query_id"), "query_id", "left_semi").select("rep")).join(wanted, "query_id"), "queries")
    shapes = materialize(shape_words(index).join(targets.select("shape"), "shape", "left_semi"), "shapes")
    found = blocks.stored_matches(queries, shapes, "matches", most=most)
    discard(leads, places, queries, shapes)
    return blocks.together(found)


def largest_bucket(totals: DataFrame, by: str) -> DataFrame:
    """The most frequent value per seed, ties by value."""
    order = Window.partitionBy("seed").orderBy(F.col("n").desc(), F.col(by))
    return totals.filter(F.col(by).isNotNull()).withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def too_short(text: Column, min_words: int = 50) -> Column:
    return word_count(text) < min_words


def sample_order(doc_id: Column, seed: str) -> Column:
    """Reproducible random order: the same in any engine with MD5."""
    return F.md5(F.concat(doc_id.cast("string"), F.lit(seed)))


def neighbour_vote(
    docs: DataFrame,
    stance: str,
    seed: str = "0",
    samples: int = 10,
    neighbours: int = 10,
    min_df: int = 100,
    max_terms: int = 25,
    min_length: int = 3,
    match_share: float = 0.8,
    doc_id: str = "id_submission",
    text: str = "text_data",
    manual: str | None = None,
) -> DataFrame:
    """Guess the position of a few random untagged documents from their most similar tagged ones.

    ``seed_id, votes, neighbours``: plus one per positive neighbour, minus one per other. With
    ``manual``, a second column of positions, a document is tagged when either is set and positive when
    either is true.

    The corpus is read twice: once without its words for the sample, and once for everything else.
    That pass keeps, of each document, only the words that sampled documents hold; numbers and
    mean length of all documents are taken on the way. What is broadcast are the words of ``samples``
    documents, and at most ``samples * max_terms`` rows of query words.
    """
    english = english_tokens(tokens(F.col(text)))
    long_words = F.filter(
        english, lambda w: (F.length(w) >= min_length) & ~w.isin(NEIGHBOUR_STOP_WORDS)
    )
    given = [F.col(c) for c in (stance, manual) if c is not None]
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias(text),
        F.coalesce(*given).isNotNull().alias("tagged"), F.greatest(F.lit(False), *given).alias("positive"),
    )
    chosen = materialize(
        rows.filter(~F.col("tagged")).orderBy(sample_order(F.col("doc_id"), seed), "doc_id").limit(samples)
        .select(F.col("doc_id").alias("seed_id"), long_words.alias("words")),
        "vote-seeds",
    )
    chosen_terms = chosen.select("seed_id", F.explode("words").alias("term")).groupBy("seed_id", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )
    none = chosen.select("seed_id", F.lit(0).cast("long").alias("votes"), F.lit(0).cast("long").alias("neighbours"))
    if chosen_terms.isEmpty():
        return none
    seen = Observation()
    observed = rows.select("doc_id", "tagged", "positive", long_words.alias("words")).withColumn("len", F.size("words")).observe(
        seen, F.count(F.lit(1)).cast("double").alias("n"), F.avg("len").alias("mean_len")
    )
    vocabulary = chosen_terms.select("term").distinct()
    held = materialize(
        observed.select("doc_id", "tagged", "positive", "len", F.explode("words").alias("term"))
        .join(F.broadcast(vocabulary), "term")
        .groupBy("doc_id", "tagged", "positive", "len", "term")
        .agg(F.count(F.lit(1)).alias("tf")),
        "vote-words",
    )
    n, mean_len = F.lit(seen.get["n"]), F.lit(seen.get["mean_len"])
    frequency = held.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    ranked = chosen_terms.join(frequency, "term").withColumn(
        "weight", F.round(F.col("tf") * (F.lit(1.0) + F.log(n / (F.col("df") + 1))), 6)
    )
    best = Window.partitionBy("seed_id").orderBy(F.col("weight").desc(), F.col("term"))
    query = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= max_terms)
    query = query.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("seed_id"))).select(
        "seed_id", "term", "df", F.greatest(F.lit(1), F.floor(F.col("k") * F.lit(match_share))).alias("need")
    )
    scored = (
        held.filter("tagged")
        .join(F.broadcast(query), "term")
        .groupBy("seed_id", "doc_id", "positive", "need")
        .agg(
            F.count(F.lit(1)).alias("shared"),
            F.round(F.sum(bm25_idf(n, F.col("df")) * saturation(F.col("tf"), F.col("len"), mean_len)), 6).alias("score"),
        )
        .filter(F.col("shared") >= F.col("need"))
    )
    # Each task keeps its own first ``neighbours`` of a seed; only these are shuffled.
    nearest = Window.partitionBy("seed_id").orderBy(F.col("score").desc(), F.col("doc_id"))
    voters = scored.withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= neighbours)
    votes = voters.groupBy("seed_id").agg(
        F.sum(F.when(F.col("positive"), 1).otherwise(-1)).alias("votes"), F.count(F.lit(1)).alias("neighbours")
    )
    return none.select("seed_id").join(votes, "seed_id", "left").select(
        "seed_id",
        F.coalesce(F.col("votes"), F.lit(0)).cast("long").alias("votes"),
        F.coalesce(F.col("neighbours"), F.lit(0)).cast("long").alias("neighbours"),
    )
