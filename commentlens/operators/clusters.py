"""Clusters of similar comments, as one set-based pass instead of a seed-by-seed loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import predicates
from ..functions.predicates import Reviewed, Tags
from ..spark_env import cut_lineage, discard, materialize
from . import blocks, similarity
from .similarity import Index, query_of, shape_of, too_short
from .skew import lookup


# Most copies of a node's minimum in the joins below, so that a hub's edges fall to several tasks; the
# copy also leaves both sides as plain shuffles, which adaptive execution splits further. Only the
# salts that edges of the node have get a copy, so that a node of one edge has one.
SALT = 8


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for an edge table ``a, b``; the component is its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which need a
    logarithmic number of rounds and never hold a node's whole neighbourhood in one task: minima
    are partial aggregates and the join back is salted. A round is two jobs; its table replaces the
    one before.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    current, seen = _written(pairs.distinct())
    for _ in range(max_rounds):
        if not seen[0]:
            break
        before = current
        # Read twice by the next step, which would otherwise run this one twice.
        star = materialize(_large_star(before), "edges")
        current, now = _written(_small_star(star))
        discard(before, star)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and their number and sum of hashes, taken while they are written."""
    seen = Observation()
    # Decimal so that it cannot overflow.
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    table = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("h")), "edges")
    return table, (seen.get["n"], seen.get["h"])


def _salt(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(SALT)).cast("int")


def _salt_bit(name: str) -> Column:
    return F.call_function("shiftleft", F.lit(1), _salt(name))


def _copies(low: DataFrame) -> DataFrame:
    held = F.filter(F.sequence(F.lit(0), F.lit(SALT - 1)), lambda i: F.getbit("salts", i) == 1)
    return low.select("u", "m", F.explode(held).alias("_salt"))


def _with_minimum(edges: DataFrame, low: DataFrame) -> DataFrame:
    """``u, v, m`` of each edge, with ``low`` (``u, m, salts``) joined on; ``salts`` has a bit for each salt of ``edges``."""
    salted = edges.withColumn("_salt", _salt("v"))
    return salted.join(_copies(low).hint("merge"), ["u", "_salt"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    # Of the two directions of an edge, v > u holds for the one from its smaller end.
    upward = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.select("u", "v", F.lit(0).alias("_bit")).unionByName(upward.withColumn("_bit", _salt_bit("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.bit_or("_bit").alias("salts")).select("u", F.least("m", "u").alias("m"), "salts")
    joined = _with_minimum(upward, low)
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.bit_or(_salt_bit("v")).alias("salts"))
    moved = _with_minimum(edges, low).filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _tagged(query: Column) -> Column:
    """Queries and shapes are vertices of one graph; their names must differ."""
    return F.concat(F.unhex(F.lit("01")), query)


def shape_components(index: Index, seed_reps: DataFrame, targets: DataFrame) -> DataFrame:
    """``shape, component``: target shapes (``shape``) connected by the queries of ``seed_reps``, as a stored table.

    First every query meets only one shape of each list that it probes, the same in all lists, and is
    checked against it if it meets it often enough. From then on, queries and shapes that this
    connects are no candidates of each other.
    So thousands of variants of one template cost a few checks each, and all other pairs are found
    as in ``signature_matches``; of those that connect the same components, a block gives one. The shapes
    of the largest component have blocks of their own, which its queries do not ask.
    """
    queries = materialize(similarity.query_words(index, seed_reps), "queries")
    shapes = materialize(similarity.shape_words(index).join(targets, "shape", "left_semi"), "target-shapes")
    own = query_of(index).join(seed_reps, "rep", "left_semi").join(shape_of(index), "rep").select("query_id", "shape").distinct()

    first = similarity.held_often(similarity.probe_rows(queries).join(similarity.posting_heads(shapes), "number"))
    known = similarity.checked(first, queries, shapes).unionByName(own.join(shapes.select("shape"), "shape", "left_semi").select("query_id", "shape"))
    known = materialize(known, "first-matches")
    graph = connected_components(known.select(_tagged(F.col("query_id")).alias("a"), F.col("shape").alias("b")))
    # Only names and components are stored again; the words stay where they are.
    placed = lambda rows, key, name: materialize(
        rows.select(key).join(graph, name == F.col("node"), "left").select(key, F.coalesce("component", name).alias("comp")), f"placed-{key}"
    )
    asking, held = placed(queries, "query_id", _tagged(F.col("query_id"))), placed(shapes, "shape", F.col("shape"))
    late_tables = blocks.stored_matches(queries.join(asking, "query_id"), shapes.join(held, "shape"), "late-matches", blocks.word_count(shapes), forest=True, apart=_largest(held))
    late = blocks.together(late_tables)

    across = lambda rows: rows.join(asking.withColumnRenamed("comp", "a"), "query_id").join(held.withColumnRenamed("comp", "b"), "shape")
    # One pair for each link between two components, whichever of them asked, checked word by word like the first ones.
    links = across(late).groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.min(F.struct("query_id", "shape")).alias("pair")).select("pair.*")
    joined = connected_components(across(similarity.checked(links, queries, shapes)).select("a", "b")).select(F.col("node").alias("comp"), "component")
    # A shape that no query reaches is in no cluster.
    reached = held.join(known.unionByName(late).select("shape").distinct(), "shape", "left_semi")
    found = reached.select("shape", "comp").join(joined, "comp", "left").select("shape", F.coalesce("component", "comp").alias("component"))
    found = materialize(found, "shape-components")
    discard(queries, shapes, known, asking, held, *late_tables)
    return found


def _largest(held: DataFrame) -> tuple[bytes, float] | None:
    """The component with the most shapes, and its share of all."""
    top = held.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "comp").first()
    return None if top is None else (bytes(top["comp"]), top["n"] / held.count())


def cluster_members(index: Index, seeds: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, cluster``: connected groups of texts, named by their smallest target document.

    Every seed searches, at any size of the corpus. Runs jobs while it is built.
    """
    reps = index.members
    target_rows = materialize(targets.select("doc_id").join(reps, "doc_id").join(shape_of(index), "rep").select("doc_id", "shape"), "target-rows")
    nodes = materialize(target_rows.groupBy("shape").agg(F.min("doc_id").alias("node")), "target-nodes")
    seed_reps = materialize(seeds.select("doc_id").join(reps, "doc_id").select("rep").distinct(), "seed-texts")
    found = shape_components(index, seed_reps, nodes.select("shape")).join(nodes, "shape")
    names = materialize(found.groupBy("component").agg(F.min("node").alias("cluster")), "component-names")
    # Stored tables on both sides: a component or shape of very many rows is split by Spark.
    clustered = materialize(found.join(names, "component").select("shape", "cluster"), "shape-clusters")
    return target_rows.join(clustered, "shape").select("doc_id", "cluster")


def cluster_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def star_members(index: Index, seeds: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, cluster``: each target joins the smallest other seed that matches it, without chaining.

    No pair of documents is made: a query passes on its two smallest seeds, a shape keeps the two
    smallest that reach it, and the second serves the document that is the first itself. Queries ask
    in order of their smallest seed, so a shape is in two matches, however many queries match it.
    """
    seed_rows = seeds.select("doc_id").join(index.members, "doc_id").join(query_of(index), "rep")
    two = lambda rows, by: rows.withColumn(
        "_r", F.dense_rank().over(Window.partitionBy(by).orderBy("seed"))
    ).filter("_r <= 2").drop("_r").distinct()
    heads = two(seed_rows.select("query_id", F.col("doc_id").alias("seed")), "query_id")
    target_rows = targets.select("doc_id").join(index.members, "doc_id").join(shape_of(index), "rep").select("doc_id", "shape")
    matches = similarity.nearest_matches(index, heads, target_rows, 2)
    reached = two(matches.join(heads.hint("merge"), "query_id").select("shape", "seed"), "shape")
    best = reached.groupBy("shape").agg(F.min("seed").alias("first"), F.max("seed").alias("second"))
    sizes = target_rows.groupBy("shape").agg(F.count(F.lit(1)).alias("docs"))
    joined = lookup(target_rows, best.join(sizes, "shape"), "shape", "docs", F.col("doc_id"))
    cluster = F.when(F.col("first") != F.col("doc_id"), F.col("first")).otherwise(F.nullif("second", "first"))
    return joined.select("doc_id", cluster.alias("cluster")).filter(F.col("cluster").isNotNull())


def join_existing(
    members: DataFrame, existing: DataFrame, min_cluster: int = 100
) -> DataFrame:
    """``cluster, target``: where a new cluster goes.

    ``existing`` has ``doc_id, src_doc_id``. When the largest existing cluster among the members
    has at least ``min(min_cluster, members)`` documents there, the new one joins it; otherwise it
    keeps its own id.
    """
    sizes = cluster_sizes(members)
    counts = members.join(existing, "doc_id").groupBy("cluster", "src_doc_id").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("cluster").orderBy(F.desc("n"), "src_doc_id")
    top = counts.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")
    absorbed = F.col("n") >= F.least(F.lit(min_cluster), F.col("size"))
    return sizes.join(top, "cluster", "left").select(
        "cluster",
        "size",
        F.when(absorbed, F.col("src_doc_id").cast("string")).otherwise(F.col("cluster").cast("string")).alias("target"),
    )


def majority_source(members: DataFrame, sources: DataFrame) -> DataFrame:
    """``cluster, source``: the most frequent source of the members, left out when ``unknown``."""
    counts = members.join(sources.select("doc_id", "source"), "doc_id").groupBy("cluster", "source").agg(
        F.count(F.lit(1)).alias("n")
    )
    order = Window.partitionBy("cluster").orderBy(F.desc("n"), "source")
    top = counts.withColumn("_r", F.row_number().over(order)).filter("_r = 1")
    return top.filter(F.col("source") != "unknown").select("cluster", "source")


def cluster_patch(
    comments: DataFrame,
    index: Index,
    tags: Tags | None = None,
    doc_id: str = "id_submission",
    text: str = "text_data",
    day: str | None = None,
    when: str = "date_disseminated",
    min_cluster: int = 100,
) -> DataFrame:
    """Patch rows for the ``more_like_this`` struct of every comment the clustering touches.

    Seeds are untagged comments long enough to search (optionally of one day); short ones are
    marked. Members get the cluster id, its size and, when known, its majority source; the
    comment that names the cluster is flagged as its source.
    """
    tags = tags or Tags()
    rows = comments.withColumn("doc_id", F.col(doc_id))
    eligible = predicates.seed_eligible(tags) & F.col(text).isNotNull()
    if day is not None:
        eligible = eligible & predicates.on_day(F.col(when), day)
    long_enough = ~too_short(F.col(text), index.params.min_words)
    seeds = rows.filter(eligible & long_enough).select("doc_id")
    short = rows.filter(eligible & ~long_enough).select("doc_id")
    targets = rows.filter(F.col(text).isNotNull() & ~predicates.is_value(tags.untaggable, True))
    members = cut_lineage(cluster_members(index, seeds, targets.select("doc_id")))

    existing = rows.filter(tags.cluster.isNotNull()).select("doc_id", tags.cluster.alias("src_doc_id"))
    placed = join_existing(members, existing, min_cluster)
    labels = majority_source(members, rows.select("doc_id", tags.source.alias("source")))
    per_cluster = placed.join(labels, "cluster", "left").select("cluster", "size", "target", "source")
    joined = lookup(members, per_cluster, "cluster", "size", F.col("doc_id"))
    changed = joined.join(existing, "doc_id", "left").filter(
        ~F.col("src_doc_id").eqNullSafe(F.col("target"))
    )
    member_rows = changed.select(
        F.col("doc_id").alias(doc_id),
        F.struct(
            F.col("target").alias("src_doc_id"),
            (F.col("doc_id").cast("string") == F.col("target")).alias("is_source"),
            (F.col("size") - 1).alias("matches"),
            F.lit(False).alias("too_short"),
            F.col("source").alias("source"),
        ).alias("more_like_this"),
    )
    short_rows = short.join(members.select("doc_id"), "doc_id", "left_anti").select(
        F.col("doc_id").alias(doc_id),
        F.struct(
            F.lit(None).cast("string").alias("src_doc_id"),
            F.lit(False).alias("is_source"),
            F.lit(None).cast("long").alias("matches"),
            F.lit(True).alias("too_short"),
            F.lit(None).cast("string").alias("source"),
        ).alias("more_like_this"),
    )
    return member_rows.unionByName(short_rows)


def unreviewed_clusters(
    comments: DataFrame,
    reviewed: Reviewed,
    cluster: str,
    size: int = 10,
    doc_id: str = "id_submission",
    text: str = "text_data",
) -> DataFrame:
    """Largest clusters nobody has reviewed, with the text of the comment that names them."""
    known = [*reviewed.positive_clusters, *reviewed.negative_clusters]
    open_rows = comments.filter(F.col(cluster).isNotNull() & ~predicates.in_list(F.col(cluster).cast("string"), known))
    counted = open_rows.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    top = counted.orderBy(F.desc("size"), "cluster").limit(size)
    exemplar = comments.select(F.col(doc_id).alias("cluster"), F.col(text).alias("text"))
    return exemplar.join(F.broadcast(top), "cluster").select("cluster", "size", "text")
