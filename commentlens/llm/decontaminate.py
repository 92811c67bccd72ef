"""Finds passages of benchmark items in documents by the rarest words of their windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from ..spark_env import materialize
from .common import inputs, lower_ascii, table, text_hash

WINDOW = 10
# Windows whose anchors one join may broadcast; a larger benchmark is taken in parts of this size.
PART = 200_000
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
NO_ID = -(2**63)


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, window``: arrays of ``size`` words, or all words of a shorter item."""
    split = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    cut = let(
        F.col("w"),
        lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1))), lambda i: F.slice(w, i, size)),
    )
    return split.select("item_id", F.explode(cut).alias("window")).distinct()


def _in_parts(df: DataFrame, key: str, count: int, part: int = PART):
    """``df`` in hash parts of about ``part`` rows each, whatever its size."""
    parts = -(-count // part) or 1
    for i in range(parts):
        yield df if parts == 1 else df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == i)


def anchored(windows: DataFrame, docs: DataFrame, part: int = PART) -> DataFrame:
    """``window, anchor, at``: each distinct window with the word that is rarest in ``docs``.

    A document that holds a window holds all its words, so the rarest one is a sufficient prefix
    of the set in order of rarity.
    """
    distinct = windows.select("window").distinct()
    vocabulary = materialize(distinct.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    counts = None
    for piece in _in_parts(vocabulary, "word", vocabulary.count(), part):
        met = docs.select(F.explode(words(F.col("text"))).alias("word")).join(F.broadcast(piece), "word")
        own = met.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        counts = own if counts is None else counts.unionByName(own)
    counts = materialize(counts, "word-counts")
    placed = distinct.select("window", F.posexplode("window").alias("at", "word")).join(counts, "word", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at"))
    return placed.groupBy("window").agg(rarest.alias("r")).select("window", F.col("r.word").alias("anchor"), F.col("r.at").alias("at"))


def occurrences(docs: DataFrame, windows: DataFrame, part: int = PART) -> DataFrame:
    """``id, row, start, size, window``: every place in ``docs`` where a window stands.

    Words of the documents meet the windows whose anchor they are. The anchor's place gives the
    place of the window; it must lie inside the text, and then all its words are compared. The
    words of a text stay in its row: only verified places leave the step.
    """
    base = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), text_hash(F.col("text")).alias("row"), words(F.col("text")).alias("w")
    )
    out = None
    for piece in _in_parts(windows, "window", windows.count(), part):
        placed = base.select("id", "row", "w", F.posexplode("w").alias("pos", "anchor"))
        start, size = F.col("pos") - F.col("at"), F.size("window")
        met = placed.join(F.broadcast(piece), "anchor").filter((start >= 0) & (start + size <= F.size("w")))
        found = met.filter(F.slice("w", start + 1, size) == F.col("window")).select(
            "id", "row", start.alias("start"), size.alias("size"), "window"
        )
        out = found if out is None else out.unionByName(found)
    return out


def contamination(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", part: int = PART,
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` for each row of ``docs``.

    ``items`` are the sorted ids (as text) of the benchmark items with a window in the document.
    A missing or empty text, or one without words, has no hits; an item without words has no
    windows; an item that repeats counts once; repeated rows get the same result. Without items no
    document is contaminated.
    """
    docs = inputs(docs, doc_id, text)
    items = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    by_item = materialize(item_windows(items, size), "windows")
    windows = materialize(anchored(by_item, docs, part), "anchors")
    found = materialize(occurrences(docs, windows, part).distinct(), "passages")
    per_row = found.groupBy("id", "row").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans"))
    reach = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["start"] + s["size"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
        ),
    )
    named = found.select("id", "row", "window").distinct().join(by_item, "window").filter(F.col("item_id").isNotNull())
    ids = named.groupBy("id", "row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    hits = per_row.select("id", "row", reach["n"].cast("long").alias("n_hit")).join(ids, ["id", "row"], "left")
    rows = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
        text_hash(F.col("text")).alias("row"),
        F.size(words(F.col("text"))).cast("long").alias("n_words"),
    )
    joined = rows.join(hits, ["id", "row"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated")
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
bw as (select distinct item_id, least(len(w), {WINDOW}) as size, unnest(list_transform(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) as g from b where len(w) > 0),
sizes as (select distinct size from bw),
dw as (select doc_id, size, unnest(range(1, len(w) - size + 2)) as start, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as g from d, sizes where len(w) >= size),
f as (select doc_id, start, size, item_id from dw join bw using (size, g)),
hit as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(start, start + size)) as p from f) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item_id from f) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join its using (doc_id)
"""

QUERIES = {"op9_decontaminate": (op9_decontaminate, SQL)}
