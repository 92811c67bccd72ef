"""Near copies among embeddings: cross-polytope hashing, balls of close vectors, verified pairs.

1. Equal vectors of one label are one vector with a count of copies.
2. A hash rotates a vector (random signs and a fast Hadamard transform, three times) and takes the
   largest coordinate with its sign; several such hashes are a bucket code. Each vector stands in its
   own bucket of every table and also looks into the next best buckets.
3. Vectors close to the one that leads their buckets form a ball of half the angle of a link: any two of
   them link, so a large group of near copies is never spelled out in pairs.
4. Balls that meet in a bucket are compared by their centres. The angle between centres and the radii
   decide most of them as a whole; members of the rest are compared in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clusters import connected_components
from ..operators.skew import lookup
from ..spark_env import discard, materialize
from .common import ship, table

COSINE = 0.93
TABLES = 8
PROBES = 3
# A code has so many bits more than the rows of the largest label need numbers.
SLACK = 5
# Coordinates of one rotation that probes choose from.
REACH = 3
# Vectors on each side of a block comparison.
BLOCK = 4_096
# Numbers that a broadcast of leading vectors may hold.
BROADCAST_NUMBERS = 1 << 21
# Angles this close to a border are decided by comparing vectors.
MARGIN = 1e-7
NO_ID = -(2**63)


def code_widths(bits: int, dims: int) -> list[int]:
    """Coordinates that each hash of a code looks at: all ``dims`` (a power of two), fewer in the last."""
    full, widths = dims.bit_length(), []
    while bits > 0:
        widths.append(1 << max(min(full, bits) - 1, 0))
        bits -= full
    return widths


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in ``log2`` steps."""
    rows, n = x.shape
    step = 1
    while step < n:
        pairs = x.reshape(rows, n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        step *= 2
    return x / math.sqrt(n)


def bucket_codes(unit: np.ndarray, table: int, widths: list[int], probes: int) -> np.ndarray:
    """For each row its bucket in ``table`` and then the ``probes`` next best, as whole numbers.

    The loss of a bucket is the sum, over its hashes, of the squared gap between the largest
    coordinate and the one that it takes instead.
    """
    codes, losses = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for k, width in enumerate(widths):
        x = unit
        for turn in range(3):
            signs = np.random.default_rng([table, k, turn]).choice([-1.0, 1.0], unit.shape[1])
            x = hadamard(x * signs)
        x = x[:, :width]
        best = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :REACH]
        value = np.take_along_axis(x, best, 1)
        loss = (np.abs(value[:, :1]) - np.abs(value)) ** 2
        codes = (codes[:, :, None] * (2 * width) + (2 * best + (value < 0))[:, None, :]).reshape(len(unit), -1)
        losses = (losses[:, :, None] + loss[:, None, :]).reshape(len(unit), -1)
        if losses.shape[1] > REACH * (probes + 1):  # only the best can be part of the best
            chosen = np.argsort(losses, axis=1, kind="stable")[:, : probes + 1]
            codes, losses = np.take_along_axis(codes, chosen, 1), np.take_along_axis(losses, chosen, 1)
    return np.take_along_axis(codes, np.argsort(losses, axis=1, kind="stable")[:, : probes + 1], 1)


def unit_rows(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = values.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small or large numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.diff(column.offsets.to_numpy())
    for d in np.unique(lengths):
        yield int(d), np.flatnonzero(lengths == d)


def bucket_entries(classes: DataFrame, tables: int, probes: int, bits: int) -> DataFrame:
    """``node, key, home``: the buckets each vector stands in (``home``) and looks into."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for d, at in _by_length(batch.column(1)):
                unit = unit_rows(batch.column(1).take(pa.array(at)))
                padded = np.zeros((len(unit), 1 << (d - 1).bit_length()))
                padded[:, :d] = unit
                widths = code_widths(bits, padded.shape[1])
                for t in range(tables):
                    codes = bucket_codes(padded, t, widths, probes)
                    count = codes.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(nodes[at], count)), batch.column(2).take(pa.array(np.repeat(at, count))), pa.array(np.full(codes.size, t, np.int32)),
                         pa.array(codes.ravel()), pa.array(np.tile(np.arange(count) == 0, len(codes)))],
                        names=["node", "space", "t", "code", "home"],
                    )

    found = classes.select("node", "vec", "space").mapInArrow(hashed, "node long, space long, t int, code long, home boolean")
    return found.select("node", F.xxhash64("space", "t", "code").alias("key"), "home")


def _cosines(pairs: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """``pairs`` with the cosine of two vector columns in their place."""
    rest = [f for f in pairs.schema.fields if f.name not in (left, right)]

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            out = np.zeros(len(a))
            for _, at in _by_length(a):  # both vectors are of one space and so of one length
                out[at] = (unit_rows(a.take(pa.array(at))) * unit_rows(b.take(pa.array(at)))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(out)], names=[*(f.name for f in rest), name])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rest), f"{name} double"])
    return pairs.select(left, right, *(f.name for f in rest)).mapInArrow(dot, schema)


def ball_members(classes: DataFrame, homes: DataFrame, cosine: float, hot: int) -> DataFrame:
    """``node, ball, close``: each vector's ball, named by the node at its centre, and the cosine to it.

    The first vector of a bucket leads it. A vector joins the one that leads most of its buckets if the
    angle between them is at most half of a link's, and is a ball of its own otherwise.
    """
    hubs = homes.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    votes = lookup(homes, hubs, "key", "c", F.col("node")).groupBy("node", "hub").agg(F.count(F.lit(1)).alias("v"))
    best = votes.groupBy("node").agg(F.min(F.struct((-F.col("v")).alias("v"), F.col("hub"))).alias("b"))
    chosen = materialize(best.select("node", F.col("b.hub").alias("hub")).filter("node != hub"), "leaders")
    led = chosen.groupBy("hub").agg(F.count(F.lit(1)).alias("c"))
    vectors = classes.select("node", "vec")
    centres = led.join(vectors.select(F.col("node").alias("hub"), F.col("vec").alias("hub_vec")).hint("merge"), "hub")
    met = lookup(chosen.join(vectors.hint("merge"), "node"), centres, "hub", "c", F.col("node"), max_hot=hot)
    half = math.cos(math.acos(cosine) / 2 - MARGIN)
    near = _cosines(met.select("node", "hub", "vec", "hub_vec"), "vec", "hub_vec", "close").filter(F.col("close") >= half)
    members = classes.select("node", "rep", "copies").join(near.hint("merge"), "node", "left")
    joined = materialize(
        members.select("node", "rep", "copies", F.coalesce("hub", "node").alias("ball"), F.coalesce("close", F.lit(1.0)).alias("close")), "ball-members"
    )
    discard(chosen)
    return joined


def ball_pairs(entries: DataFrame, members: DataFrame) -> DataFrame:
    """``a, b``: balls of which a member looks into a bucket that a member of the other stands in."""
    placed = entries.join(members.select("node", "ball").hint("merge"), "node").groupBy("key", "ball").agg(F.max("home").alias("home"))
    placed = materialize(placed, "ball-entries")
    x = placed.filter("home").select("key", F.col("ball").alias("x"))
    y = placed.select("key", F.col("ball").alias("y"))
    met = x.join(y.hint("merge"), "key").filter("x != y")
    pairs = materialize(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "ball-pairs")
    discard(placed)
    return pairs


def judged_pairs(pairs: DataFrame, balls: DataFrame, classes: DataFrame, cosine: float, hot: int) -> DataFrame:
    """``a, b, whole``: pairs that link as a whole, or (``whole`` false) whose members must be compared."""
    limit = math.acos(cosine)
    centres = balls.join(classes.select(F.col("node").alias("ball"), "vec").hint("merge"), "ball")
    met = pairs
    for side in ("a", "b"):
        dim = centres.select(F.col("ball").alias(side), F.col("radius").alias(f"{side}_radius"), F.col("vec").alias(f"{side}_vec"), F.col("members").alias(f"{side}_members"))
        met = lookup(met, dim, side, f"{side}_members", F.xxhash64("a", "b"), max_hot=hot)
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("close"))))
    reach = F.col("a_radius") + F.col("b_radius")
    judged = _cosines(met, "a_vec", "b_vec", "close").withColumn("angle", angle)
    whole = F.col("angle") + reach <= limit - MARGIN
    return judged.filter(F.col("angle") - reach <= limit + MARGIN).select("a", "b", whole.alias("whole"), "a_members", "b_members")


def compared_members(undecided: DataFrame, members: DataFrame, classes: DataFrame, cosine: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Links between members of the balls of each pair: ``node, n`` counts, and ``a, b`` balls that link.

    All partners of the larger ball are its *guests*. Hosts and guests of a ball are dealt to
    chunks of at most about ``block`` vectors, and each two chunks meet in a group of their own.
    """
    larger = (F.col("a_members") > F.col("b_members")) | ((F.col("a_members") == F.col("b_members")) & (F.col("a") < F.col("b")))
    sides = undecided.select(F.when(larger, F.col("a")).otherwise(F.col("b")).alias("host"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("ball"))
    sizes = members.groupBy("ball").agg(F.count(F.lit(1)).alias("c"))
    # A large ball is a guest only of larger ones, so this join has no heavier key than its result.
    guests = materialize(sides.join(members.select("node", "ball", "copies").hint("merge"), "ball"), "ball-guests")
    parts = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(block))).cast("int")
    tasks = (
        guests.groupBy("host").agg(F.count(F.lit(1)).alias("g"))
        .join(sizes.select(F.col("ball").alias("host"), "c").hint("merge"), "host")
        .select("host", parts("c").alias("rows"), parts("g").alias("columns"), (F.col("c") + F.col("g")).alias("w"))
    )
    spread = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    hosts = lookup(members.select("node", "copies", F.col("ball").alias("host"), "ball"), tasks, "host", "w", F.col("node"))
    hosts = hosts.select("host", "ball", "node", "copies", spread("rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(True).alias("own"))
    visits = lookup(guests, tasks, "host", "w", F.col("node"))
    visits = visits.select("host", "ball", "node", "copies", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), spread("columns").alias("j"), F.lit(False).alias("own"))
    rows = hosts.unionByName(visits).join(classes.select("node", "vec").hint("merge"), "node")

    def compare(rows: pa.Table) -> pa.Table:
        own = rows.column("own").to_numpy(zero_copy_only=False)
        nodes, balls, copies = (rows.column(c).to_numpy() for c in ("node", "ball", "copies"))
        unit = unit_rows(rows.column("vec").combine_chunks())
        links = unit[own] @ unit[~own].T >= cosine
        count = np.zeros(len(rows), np.int64)
        count[own] = links @ copies[~own]
        count[~own] = links.T @ copies[own]
        met = np.unique(balls[~own][links.any(axis=0)])
        host = rows.column("host")[0].as_py() if len(rows) else 0
        some = np.flatnonzero(count)
        return pa.table({
            "node": pa.array(np.r_[nodes[some], np.full(len(met), -1)], pa.int64()),
            "n": pa.array(np.r_[count[some], np.zeros(len(met), np.int64)], pa.int64()),
            "a": pa.array([None] * len(some) + [host] * len(met), pa.int64()),
            "b": pa.array([None] * len(some) + met.tolist(), pa.int64()),
        })

    found = materialize(rows.groupBy("host", "i", "j").applyInArrow(compare, "node long, n long, a long, b long"), "member-links")
    discard(guests)
    return found.filter("a is null").select("node", "n"), found.filter("a is not null").select("a", "b").distinct()


def linked_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors with equal labels and lengths link when their cosine (in double precision) is at least
    ``cosine``. Null, empty and zero vectors, vectors with null or non-finite components and rows
    without a label link with nothing. Links are those between balls that meet in a bucket: every
    one of them is exact, and the share that is found (0.99 and more at the threshold itself for
    21-bit codes, see README) falls slowly with longer codes. Rows that repeat an id are vectors of
    their own under one name; a missing id sorts first and is named by null. No rows give no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = (F.size("vec") > 0) & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    valid = F.coalesce(F.col("label").isNotNull() & good, F.lit(False))
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    vec = F.col(embedding) if single else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.coalesce(F.col(vec_id), F.lit(NO_ID)).cast("long").alias("id"), vec.alias("vec"), F.col(label).alias("label"))
    rows = rows.withColumn("space", F.when(valid, F.xxhash64("label", F.size("vec"))))
    twin = F.concat_ws("-", F.hex(F.xxhash64(F.lit(1), "space", "vec")), F.hex(F.xxhash64(F.lit(2), "vec", "space")))
    named = materialize(rows.select("id", "space", F.when(F.col("space").isNotNull(), twin).alias("twin"), "vec"), "vectors")
    placed = named.filter("twin is not null")
    grouped = placed.groupBy("twin").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("space").alias("space"), F.first("vec").alias("vec"))
    classes = materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    size = classes.groupBy("space").agg(F.count(F.lit(1)).alias("c"), F.max(F.size("vec")).alias("d")).agg(F.max("c").alias("c"), F.max("d").alias("d")).first()
    bits, hot = int(size["c"] or 1).bit_length() + SLACK, min(20_000, max(1, BROADCAST_NUMBERS // int(size["d"] or 1)))

    entries = materialize(bucket_entries(classes, tables, probes, bits), "bucket-entries")
    members = ball_members(classes, entries.filter("home").select("key", "node"), cosine, hot)
    pairs = ball_pairs(entries, members)
    discard(entries)
    balls = materialize(
        members.groupBy("ball").agg(
            F.acos(F.least(F.lit(1.0), F.min("close"))).alias("radius"), F.count(F.lit(1)).alias("members"), F.sum("copies").alias("copies"), F.min("rep").alias("first")
        ),
        "balls",
    )
    judged = materialize(judged_pairs(pairs, balls, classes, cosine, hot), "judged-pairs")
    discard(pairs)
    whole = judged.filter("whole").select("a", "b")
    counted, crossing = compared_members(judged.filter("not whole"), members, classes, cosine, block)

    both = whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(balls.select(F.col("ball").alias("b"), "copies").hint("merge"), "b").groupBy("a").agg(F.sum("copies").alias("beside"))
    joined = connected_components(whole.unionByName(crossing))
    known = balls.join(joined.select(F.col("node").alias("ball"), "component").hint("merge"), "ball", "left").withColumn("component", F.coalesce("component", "ball"))
    firsts = known.groupBy("component").agg(F.min("first").alias("smallest"), F.count(F.lit(1)).alias("c"))
    described = lookup(known, firsts, "component", "c", F.col("ball")).join(beside.select(F.col("a").alias("ball"), "beside").hint("merge"), "ball", "left")
    per_ball = described.select("ball", "members", (F.col("copies") + F.coalesce("beside", F.lit(0)) - 1).alias("inside"), "smallest")
    extra = counted.groupBy("node").agg(F.sum("n").alias("n"))
    per_node = (
        lookup(members.select("node", "ball"), per_ball, "ball", "members", F.col("node"))
        .join(extra.hint("merge"), "node", "left")
        .select("node", (F.col("inside") + F.coalesce("n", F.lit(0))).alias("n_links"), "smallest")
    )
    per_class = classes.select("node", "twin", "copies").join(per_node.hint("merge"), "node").select("twin", "copies", "n_links", "smallest")
    found = lookup(named.select("id", F.coalesce("twin", F.concat(F.lit("-"), F.col("id").cast("string"))).alias("twin")), per_class, "twin", "copies", F.col("id"), "left")
    blank = lambda c: F.when(c != NO_ID, c)
    return found.select(
        blank(F.col("id")).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        blank(F.coalesce("smallest", "id")).alias("component_id"),
        (F.coalesce("smallest", "id") == F.col("id")).alias("kept"),
    )


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


SQL = f"""
with recursive v as (select vec_id, label, list_transform(embedding, lambda e: cast(e as double)) as x from embeddings
  where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
  and len(list_filter(embedding, lambda e: e <> 0)) > 0),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.x) = len(b.x) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.x, b.x) >= {COSINE}),
reach(a, b) as (select a, b from link union select reach.a, link.b from reach join link on reach.b = link.a),
n as (select a, count(*) as n from link group by a)
select e.vec_id, coalesce(any_value(n.n), 0) as n_links, least(e.vec_id, coalesce(min(reach.b), e.vec_id)) as component_id,
  e.vec_id <= coalesce(min(reach.b), e.vec_id) as kept
from embeddings e left join n on n.a = e.vec_id left join reach on reach.a = e.vec_id group by e.vec_id
"""

QUERIES = {"op12_vector_dedup": (op12_vector_dedup, SQL)}
