"""Row replacement and partial updates, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DATES = ("date_disseminated", "date_received")


def latest_by_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per id: the latest by ``order``, then by the filing's own dates, then by content.

    All rows of one run carry the same ``order``; the version that was published later wins.

    ``max_by`` keeps one row per id and map task before the shuffle, so an id that was sent very
    often does not collect its history in one task.
    """
    columns = rows.columns
    content = F.sha2(F.to_json(F.struct(*(c for c in columns if c != order))), 256)
    packed = rows.select(key, F.struct(*columns).alias("row"), F.struct(order, *(c for c in DATES if c in columns), content.alias("content")).alias("rank"))
    best = packed.groupBy(key).agg(F.max_by("row", "rank").alias("row"))
    return best.select(*(F.col("row")[c].alias(c) for c in columns))


def replace_rows(stored: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Full-row upsert: the latest version of each id wins; nothing of an older one is kept."""
    return latest_by_id(stored.unionByName(incoming, allowMissingColumns=True), key, order)


def merge_analysis(
    stored: DataFrame,
    patch: DataFrame,
    key: str = "id_submission",
    struct: str = "analysis",
    present: str | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """Deep-merge sparse ``patch`` rows into the ``analysis`` struct.

    A leaf that ``patch`` has as a column is written, null included; a leaf it lacks keeps its old
    value. When rows differ in what they carry, ``present`` names a column of leaf names, and only
    those are written for that row. Ids not in ``stored`` are ignored. Of patch rows with the same
    id one is taken, by content, so that no stored row is ever doubled. With ``broadcast``, for a patch
    of few rows, the stored rows are not shuffled.
    """
    kind = stored.schema[struct].dataType
    leaves = [f.name for f in kind.fields if f.name in patch.columns]
    unknown = set(patch.columns) - set(leaves) - {key, present}
    if unknown:
        raise ValueError(f"not analysis leaves: {sorted(unknown)}")
    values = F.struct(*leaves, *([present] if present else [])).alias("_patch")
    content = F.sha2(F.to_json("_patch"), 256)
    single = patch.select(key, values).groupBy(key).agg(F.max_by("_patch", content).alias("_patch"))
    joined = stored.join(F.broadcast(single) if broadcast else single, key, "left")
    has_patch = F.col("_patch").isNotNull()
    fields = []
    for f in kind.fields:
        old = F.col(f"{struct}.{f.name}")
        if f.name not in leaves:
            fields.append(old.alias(f.name))
            continue
        write = has_patch
        if present:
            write = write & F.array_contains(F.col(f"_patch.{present}"), f.name)
        fields.append(F.when(write, F.col(f"_patch.{f.name}")).otherwise(old).cast(f.dataType).alias(f.name))
    merged = F.when(F.col(struct).isNull() & ~has_patch, F.lit(None)).otherwise(F.struct(*fields))
    return joined.withColumn(struct, merged).select(*stored.columns)
