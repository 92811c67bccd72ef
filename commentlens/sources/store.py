"""The comment table: Parquet by day of dissemination, in versions that a manifest makes visible.

::

    <table>/rows/v=<version>/day=<day>/       all rows of a day, written once and never changed
    <table>/ids/v=<version>/bucket=<bucket>/  which day an id is in, for the ids a version moved or added
    <table>/manifest/<number>.json            the version of every day and bucket; the highest number holds

A job writes whole new folders first and the manifest last, under a name that must not exist yet. If it
dies before, nothing has changed for any reader, and the next run ignores what it left. The ids table tells
which days a batch touches, so no batch reads the ids of all stored rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import merge_analysis, replace_rows
from ..schema import COMMENT
from ..spark_env import discard, materialize

KEY = "id_submission"
DAY = "day"
ORDER = "ingested_at"
TABLE = T.StructType(
    COMMENT.fields + [T.StructField(ORDER, T.TimestampType()), T.StructField(DAY, T.DateType())]
)

# Parts of the ids table, fixed when a table is made (take more for billions of ids), and versions of one part that are read together
# before a commit puts them into one.
BUCKETS = 32
PARTS = 8
# Patch rows that are broadcast at once; a day with more is joined by a shuffle.
PATCH_ROWS = 200_000
# Earlier states of a table that stay readable after a commit.
RETAIN = 1


class ConcurrentCommit(RuntimeError):
    """Another job has committed to the table since this one read it; run it again."""


@dataclass(frozen=True)
class Manifest:
    number: int
    buckets: int
    days: dict[str, str] = field(default_factory=dict)  # day -> version
    ids: dict[str, list[str]] = field(default_factory=dict)  # bucket -> versions, oldest first

    def folders(self) -> set[str]:
        days = {f"rows/v={v}/{DAY}={d}" for d, v in self.days.items()}
        return days | {f"ids/v={v}/bucket={b}" for b, versions in self.ids.items() for v in versions}


def with_day(comments: DataFrame, when: str = "date_disseminated") -> DataFrame:
    """Rows without a date go to the day 1970-01-01, so that no partition value is null."""
    return comments.withColumn(DAY, F.coalesce(F.to_date(when), F.to_date(F.lit("1970-01-01"))))


# --- manifest -----------------------------------------------------------------------------------
def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{path}/manifest") if n.endswith(".json")]


def _load(spark: SparkSession, path: str, number: int) -> Manifest:
    fs, target = _filesystem(spark, f"{path}/manifest/{number:010d}.json")
    stream = fs.open(target)
    try:
        return Manifest(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> Manifest | None:
    numbers = _numbers(spark, path)
    return _load(spark, path, max(numbers)) if numbers else None


def _commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Makes ``manifest`` the state of the table, unless its number is taken."""
    fs, target = _filesystem(spark, f"{path}/manifest/{manifest.number:010d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, target, no_overwrite)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise ConcurrentCommit(f"version {manifest.number} of {path} exists") from error
        raise


def _expire(spark: SparkSession, path: str, retain: int) -> None:
    """Deletes manifests before the last ``retain + 1`` and the folders that only they name."""
    numbers = sorted(_numbers(spark, path))
    old, kept = numbers[: -retain - 1], numbers[-retain - 1 :]
    if not old:
        return
    used = set().union(*(_load(spark, path, n).folders() for n in kept))
    for folder in set().union(*(_load(spark, path, n).folders() for n in old)) - used:
        fs, target = _filesystem(spark, f"{path}/{folder}")
        fs.delete(target, True)
    for number in old:
        fs, target = _filesystem(spark, f"{path}/manifest/{number:010d}.json")
        fs.delete(target, False)


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Deletes what jobs that died have left: version folders that no manifest names.

    Versions of a number above the current one may be of a running job and stay.
    """
    numbers = _numbers(spark, path)
    used = set().union(*(_load(spark, path, n).folders() for n in numbers))
    gone = []
    for kind in ("rows", "ids"):
        for version in _names(spark, f"{path}/{kind}"):
            if not version.startswith("v=") or int(version[2:].split("-")[0]) > max(numbers, default=0):
                continue
            parts = [f"{kind}/{version}/{n}" for n in _names(spark, f"{path}/{kind}/{version}") if "=" in n]
            gone += [p for p in parts if p not in used]
            if not any(p in used for p in parts):
                gone.append(f"{kind}/{version}")
    for folder in gone:
        fs, target = _filesystem(spark, f"{path}/{folder}")
        fs.delete(target, True)
    return gone


# --- reading ------------------------------------------------------------------------------------
def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def _folders(spark: SparkSession, base: str, folders: list[str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", base)
    return (reader.schema(schema) if schema is not None else reader).parquet(*folders).drop("v")


def _read_days(
    spark: SparkSession, path: str, manifest: Manifest, days: set[str] | None, schema: T.StructType | None
) -> DataFrame:
    """Rows of some days or all, with the schema of the files unless one is given."""
    chosen = sorted(d for d in manifest.days if days is None or d in days)
    if not chosen:
        return spark.createDataFrame([], schema or TABLE)
    rows = _folders(spark, f"{path}/rows", [f"{path}/rows/v={manifest.days[d]}/{DAY}={d}" for d in chosen], schema)
    return rows.select(*(schema or rows.schema).fieldNames())


def read_comments(spark: SparkSession, path: str, schema: T.StructType | None = TABLE) -> DataFrame:
    """The table as of the last commit; ``schema=None`` takes the columns of its files.

    A commit that follows does not change what this reads; ``RETAIN`` more must not follow before
    the rows are used.
    """
    manifest = current(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no comment table in {path}")
    return _read_days(spark, path, manifest, None, schema)


def _bucket(manifest: Manifest):
    return F.pmod(F.xxhash64(KEY), F.lit(manifest.buckets)).cast("int")


def _read_ids(spark: SparkSession, path: str, manifest: Manifest, buckets: list[str]) -> DataFrame:
    """``id, day, number`` of some buckets: every entry, so an id that moved has several."""
    folders = [f"{path}/ids/v={v}/bucket={b}" for b in buckets for v in manifest.ids.get(b, [])]
    schema = f"{KEY} string, {DAY} date, number long"
    if not folders:
        return spark.createDataFrame([], schema)
    return _folders(spark, f"{path}/ids", folders, T.StructType.fromDDL(schema)).select(KEY, DAY, "number")


def _last_days(entries: DataFrame) -> DataFrame:
    return entries.groupBy(KEY).agg(F.max_by(DAY, "number").alias(DAY))


def places(spark: SparkSession, path: str, manifest: Manifest, ids: DataFrame) -> DataFrame:
    """``id, day`` of the stored rows among ``ids``. Only the buckets of these ids are read."""
    wanted = ids.select(F.col(KEY).cast("string").alias(KEY)).distinct()
    buckets = [str(r[0]) for r in wanted.select(_bucket(manifest)).distinct().collect()]  # at most ``BUCKETS`` numbers
    return _last_days(_read_ids(spark, path, manifest, buckets).join(wanted, KEY, "left_semi"))


# --- writing ------------------------------------------------------------------------------------
def _write(rows: DataFrame, folder: str, by: str, rebalance: bool = True) -> set[str]:
    """One folder for each value of ``by``; returns the values in ``folder``.

    The rebalance lets adaptive execution split a value with a large share of the data over many
    tasks and put small ones together, so files are neither huge nor tiny. Rows that stayed in the
    tasks that read their files need none: a task writes one file for each value it has read.
    """
    dealt = rows.hint("rebalance", by) if rebalance else rows
    dealt.write.mode("append").option("compression", "zstd").partitionBy(by).parquet(folder)
    return {n.split("=", 1)[1] for n in _names(rows.sparkSession, folder) if n.startswith(f"{by}=")}


def _days_of(rows: DataFrame) -> set[str]:
    # One value per day partition: a few thousand at most over a docket's life.
    return {str(r[0]) for r in rows.select(DAY).distinct().collect()}


def upsert(spark: SparkSession, path: str, incoming: DataFrame, buckets: int = BUCKETS, retain: int = RETAIN) -> None:
    """Replace the stored rows with the same id; the latest ``ingested_at`` wins.

    Only days that hold old or new versions of the incoming ids are rewritten. A row whose date
    moved leaves its old day. Running the same input twice changes nothing. Either all of it
    becomes visible or nothing; raises ``ConcurrentCommit`` when another job was faster.
    """
    before = current(spark, path) or Manifest(0, buckets)
    number = before.number + 1
    version = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    fresh = materialize(with_day(incoming), "incoming")
    stored = materialize(places(spark, path, before, fresh), "places")
    touched = _days_of(fresh) | _days_of(stored)
    old_rows = _read_days(spark, path, before, touched, fresh.schema)
    written = _write(replace_rows(old_rows, fresh, KEY, ORDER), f"{path}/rows/v={version}", DAY)
    days = {d: v for d, v in before.days.items() if d not in touched} | {d: version for d in written}

    after = Manifest(number, before.buckets, days, before.ids)
    now = _read_days(spark, path, after, written, T.StructType.fromDDL(f"{KEY} string, {DAY} date"))
    moved = now.join(fresh.select(KEY).distinct(), KEY, "left_semi").join(stored, [KEY, DAY], "left_anti")
    full = [b for b, versions in before.ids.items() if len(versions) >= PARTS]
    entries = moved.withColumn("number", F.lit(number).cast("long")).unionByName(_read_ids(spark, path, before, full))
    entries = _last_days(entries).withColumn("number", F.lit(number).cast("long")).withColumn("bucket", _bucket(before))
    parts = _write(entries, f"{path}/ids/v={version}", "bucket")
    ids = before.ids | {b: ([] if b in full else before.ids.get(b, [])) + [version] for b in parts}
    _commit(spark, path, Manifest(number, before.buckets, days, ids))
    _expire(spark, path, retain)
    discard(fresh, stored)


def update_analysis(
    spark: SparkSession, path: str, patch: DataFrame, present: str | None = None, retain: int = RETAIN
) -> None:
    """Deep-merge patch rows into stored rows, rewriting only the days they live in."""
    before = current(spark, path)
    if before is None:
        raise FileNotFoundError(f"no comment table in {path}")
    small = materialize(patch, "patch")
    placed = materialize(places(spark, path, before, small), "places")
    # One number per day partition: a few thousand at most over a docket's life.
    counts = {str(r[DAY]): r["count"] for r in placed.groupBy(DAY).count().collect()}
    if counts:
        version = f"{before.number + 1:010d}-{uuid.uuid4().hex[:8]}"
        written = set()
        for days in _day_groups(counts, PATCH_ROWS):
            stored = _read_days(spark, path, before, days, None)
            ids = placed.filter(F.col(DAY).isin([date.fromisoformat(d) for d in days])).select(KEY)
            few = sum(counts[d] for d in days) <= PATCH_ROWS
            merged = merge_analysis(stored, small.join(ids, KEY, "left_semi"), KEY, present=present, broadcast=few)
            written |= _write(merged, f"{path}/rows/v={version}", DAY, rebalance=not few)
        _commit(spark, path, Manifest(before.number + 1, before.buckets, before.days | {d: version for d in written}, before.ids))
        _expire(spark, path, retain)
    discard(small, placed)


def _day_groups(counts: dict[str, int], most: int) -> list[set[str]]:
    """Days that are patched together, by their numbers of patch rows: ``most`` rows a group; all
    days with more than that are one group."""
    groups, room = [], 0
    for day in sorted(d for d in counts if counts[d] <= most):
        if counts[day] > room:
            groups.append(set())
            room = most
        groups[-1].add(day)
        room -= counts[day]
    large = {d for d in counts if counts[d] > most}
    return groups + ([large] if large else [])


def backlog(comments: DataFrame) -> DataFrame:
    """How many rows have not been annotated."""
    return comments.agg(F.count(F.when(F.col("analysis").isNull(), 1)).alias("backlog"))
