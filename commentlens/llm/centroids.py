"""Centroid clustering on integers, with a distance matrix that is updated instead of recomputed.

Every vector's row keeps its exact dot products with all centroids. When centroids move, only the
components that changed are multiplied again: each product grows by ``sum(x_j * change_j)`` over them.
Distances follow as ``|x|^2 - 2 x.c + |c|^2``, all in whole numbers, so nothing drifts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spark_env import discard, materialize
from .common import ship, table

CENTROIDS = 40
COMPONENTS = 64
ROUNDS = 5
SCALE = 256
SEED = "2"


def whole_numbers(embedding: Column, components: int, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null unless all ``components`` are there and finite."""
    finite = ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fits = (F.size(embedding) == components) & finite
    return F.when(fits, F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def first_centroids(kept: DataFrame, count: int, seed: str) -> np.ndarray:
    """The ``count`` rows of smallest hash, in order: that many rows come to the driver."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(name.alias("name"), "x").orderBy("name", "x").limit(count).collect()
    return np.array([r["x"] for r in rows], np.int64)


def updated(products: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """``products`` (vectors by centroids) after the centroids moved by ``change``."""
    out = products.copy()
    for c in np.flatnonzero(change.any(axis=1)):
        moved = np.flatnonzero(change[c])
        out[:, c] += x[:, moved] @ change[c, moved]
    return out


def assigned(rows: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """``vec_id, x, products, cluster, distance`` after a move; rows without products start at zero."""
    norms = (centroids * centroids).sum(axis=1)
    fresh = "products" not in rows.columns
    k, d = centroids.shape

    def matrix(column: pa.ListArray, width: int) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), width)

    def lists(values: np.ndarray) -> pa.ListArray:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel(), pa.int64()))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), d)
            before = np.zeros((len(x), k), np.int64) if fresh else matrix(batch.column(2), k)
            products = updated(before, x, change)
            distance = (x * x).sum(axis=1)[:, None] - 2 * products + norms
            cluster = distance.argmin(axis=1)  # the first of equal ones
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(products), pa.array(cluster.astype(np.int32)), pa.array(distance.min(axis=1))],
                names=["vec_id", "x", "products", "cluster", "distance"],
            )

    columns = ["vec_id", "x"] if fresh else ["vec_id", "x", "products"]
    return rows.select(*columns).mapInArrow(move, "vec_id long, x array<long>, products array<long>, cluster int, distance long")


def moved_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact ``floor(sum / count)`` of each non-empty cluster: one row per cluster comes to the driver."""
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(centroids.shape[1])]
    out = centroids.copy()
    for row in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[row["cluster"]] = [total // row["n"] for total in row[2:]]
    return out


def cluster_vectors(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    components: int = COMPONENTS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors with exactly ``components`` components, none null or non-finite. Fewer vectors
    than ``centroids`` make fewer centroids; none at all give no rows. Equal distances go to the
    smaller number, and centroids may be equal. Rows that repeat an id are vectors of their own;
    a missing id counts as an empty name. Raises ``ValueError`` when scaled components are so large
    that a sum of their squares could pass 63 bits, instead of giving wrong distances.
    """
    spark = vectors.sparkSession
    ship(spark)
    x = whole_numbers(F.col(embedding), components, scale)
    kept = materialize(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).filter("x is not null"), "whole-vectors")
    largest = kept.agg(F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()[0] or 0
    if components * (2 * largest + 2) ** 2 >= 2**63:
        raise ValueError(f"components up to {largest} are too large for exact 64-bit distances")
    at = first_centroids(kept, centroids, seed)
    if not len(at):
        schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    state = materialize(assigned(kept, at, at), "distances")
    discard(kept)
    for _ in range(rounds):
        new = moved_centroids(state, at)
        if (new == at).all():
            break  # no centroid moves any more
        before, state = state, materialize(assigned(state, new - at, new), "distances")
        discard(before)
        at = new

    # One row per centroid; the whole sum is that of the clusters' sums.
    totals = {r["cluster"]: int(r["s"]) for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    described = spark.createDataFrame(
        [(c, s, sum(totals.values()), digest[c]) for c, s in totals.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """All rounds spelled out: nearest centroid of each vector, then the floored means."""
    parts = [
        f"""v as (select vec_id, list_transform(embedding, lambda e: cast(floor({SCALE} * cast(e as double)) as bigint)) as x from embeddings
  where len(embedding) = {COMPONENTS} and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0)""",
        f"w as (select vec_id, generate_subscripts(x, 1) as j, unnest(x) as e from v)",
        f"""c0 as (select cast(row_number() over (order by name) - 1 as integer) as c, x from
  (select sha256('{SEED}:' || vec_id) as name, x from v order by name limit {CENTROIDS}))""",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"u{r} as (select c, generate_subscripts(x, 1) as j, unnest(x) as e from c{r})")
        parts.append(f"d{r} as (select vec_id, c, sum((w.e - u.e) * (w.e - u.e)) as d from w join u{r} u using (j) group by vec_id, c)")
        parts.append(f"a{r} as (select vec_id, c, d from (select *, row_number() over (partition by vec_id order by d, c) as n from d{r}) where n = 1)")
        if r < ROUNDS:
            parts.append(f"""m{r} as (select c, list(e order by j) as x from (select c, j, cast((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as e
  from a{r} join w using (vec_id) group by c, j) group by c)""")
            parts.append(f"c{r + 1} as (select c0.c, coalesce(m{r}.x, c0.x) as x from c{r} c0 left join m{r} using (c))")
    return "with " + ",\n".join(parts) + f"""
select a.vec_id, a.c as cluster, cast(a.d as bigint) as distance, cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(a.d) over () as bigint) as inertia, sha256(array_to_string(k.x, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} k using (c)"""


SQL = _sql()

QUERIES = {"op13_centroids": (op13_centroids, SQL)}
