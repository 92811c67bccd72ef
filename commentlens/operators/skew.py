"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a lookup side that may be broadcast. The limit is applied in the plan, so the broadcast
# cannot grow with the data; every other key goes through the shuffle join.
MAX_HOT = 20_000


def lookup(
    big: DataFrame,
    dim: DataFrame,
    key: str,
    weight: str,
    spread: Column,
    how: str = "inner",
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """Join ``big`` to ``dim`` (one row per key), safe for hot keys.

    The ``max_hot`` heaviest keys by ``weight`` are broadcast. A row that meets one of them gets a
    join key for the second join that matches nothing and is spread by ``spread``, so hot rows do
    not pile up in one shuffle partition. ``spread`` should be as distinct as a row id.
    ``weight`` must come from ``dim`` and is kept out of the result unless it is also a value.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    values = [c for c in dim.columns if c != key]
    packed = dim.select(key, F.struct(*values).alias("_v"), F.col(weight).alias("_w"))
    hot = (
        packed.orderBy(F.desc("_w"), F.col(key))
        .limit(max_hot)
        .select(F.col(key).alias("_hot_key"), F.col("_v").alias("_hot"))
    )
    first = big.join(F.broadcast(hot), big[key] == F.col("_hot_key"), "left").drop("_hot_key")
    cold_key = F.when(F.col("_hot").isNull(), F.struct(F.lit(0).alias("k"), F.col(key).cast("string").alias("v"))).otherwise(
        F.struct(F.lit(1).alias("k"), spread.cast("string").alias("v"))
    )
    cold = packed.select(
        F.struct(F.lit(0).alias("k"), F.col(key).cast("string").alias("v")).alias("_dim_key"),
        F.col("_v").alias("_cold"),
    )
    second = first.withColumn("_cold_key", cold_key).join(
        cold.hint("merge"), F.col("_cold_key") == F.col("_dim_key"), "left"
    )
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    out = second.withColumn("_found", found)
    if how == "inner":
        out = out.filter(F.col("_found").isNotNull())
    return out.select(*(F.col(c) for c in big.columns), *(F.col(f"_found.{v}").alias(v) for v in values))
