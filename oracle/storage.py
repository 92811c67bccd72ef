"""Enrichment joins, samples, upserts, files and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentlens.operators import enrich, merge, sampling
from commentlens.operators.annotate import annotate, stance_labels
from commentlens.plans import daily, report, tagging
from commentlens.rules import domain
from commentlens.sources import exports, filings as filing_source, store
from commentlens.spark_env import scratch_path
from commentlens.streaming import ingest

from . import views as v
from .reports import flat_report, full_report_sql
from .rows import DOCKET_SOURCE, KEYS_SQL
from .textual import phrases_sql

QUERIES: dict = {}
SEED = "42"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return add


# --- joins --------------------------------------------------------------------------------------
_BREACHES_SQL = "breaches AS (SELECT DISTINCT contact_email AS email FROM cv WHERE breached AND contact_email <> '')"


def _flags(spark, sf):
    rows = v.cv(spark, sf)
    breaches = rows.filter("breached").select(F.col("contact_email").alias("email"))
    return enrich.email_breach_flags(rows, breaches)


@query(
    "breach_join",
    f"WITH {v.CV}, {_BREACHES_SQL} SELECT c.contact_email AS email, count(*) AS rows, max(b.email IS NOT NULL) AS breached "
    "FROM cv c LEFT JOIN breaches b ON b.email = c.contact_email WHERE c.contact_email <> '' GROUP BY 1",
)
def breach_join(spark, sf):
    return _flags(spark, sf)


@query(
    "breach_propagate",
    f"WITH {v.CV}, {_BREACHES_SQL} SELECT c.id_submission, b.email IS NOT NULL AS breached FROM cv c "
    "LEFT JOIN breaches b ON b.email = c.contact_email WHERE c.contact_email <> ''",
)
def breach_propagate(spark, sf):
    return enrich.breach_patch(v.cv(spark, sf), _flags(spark, sf))


@query(
    "manual_labels",
    f"WITH {v.CV} SELECT cv.id_submission, l.quality = 1 AS sentiment_manual FROM cv JOIN labels l ON l.doc_id = cv.doc_id",
)
def manual_labels(spark, sf):
    labels = v.table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id_submission"), (F.col("quality") == 1).alias("label")
    )
    return enrich.manual_label_patch(v.cv(spark, sf), labels, "label")


# --- samples ------------------------------------------------------------------------------------
_ORDER = f"md5(concat(id_submission, '{SEED}')), id_submission"


@query(
    "random_sample",
    f"WITH {v.CV} SELECT id_submission, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) AS r FROM cv) WHERE r <= 10",
)
def random_sample(spark, sf):
    return sampling.random_sample(v.cv(spark, sf), 10, SEED, "source").select("id_submission", "source")


@query(
    "breach_candidates",
    f"WITH {v.CV} SELECT DISTINCT source, contact_email FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) AS r "
    "FROM cv WHERE contact_email <> '' AND breached IS NULL) WHERE r <= 20",
)
def breach_candidates(spark, sf):
    return sampling.breach_candidates(v.cv(spark, sf), 20, SEED, "source")


_CONTACTS = (
    f"first AS (SELECT *, row_number() OVER (PARTITION BY source, contact_email ORDER BY {_ORDER}) AS r FROM cv WHERE contact_email <> ''), "
    f"pick AS (SELECT id_submission, source, contact_email, row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) AS pick FROM first WHERE r = 1)"
)


@query(
    "contact_sample",
    f"WITH {v.CV}, {_CONTACTS} SELECT source, contact_email, id_submission, pick FROM pick WHERE pick <= 8",
)
def contact_sample(spark, sf):
    return sampling.contact_sample(v.cv(spark, sf), SEED, 8).withColumn("pick", F.col("pick").cast("long"))


URL = "https://example.org/filing/"


@query(
    "contact_export",
    f"WITH {v.FILINGS}, src AS (SELECT source, doc_id AS d FROM cv), {_CONTACTS} SELECT p.source, p.contact_email AS email, f.filer AS name, "
    f"strftime(f.date_received, '%Y-%m-%d') AS received, md5(coalesce(f.text_data, '')) AS comment_md5, concat('{URL}', p.id_submission) AS url "
    "FROM pick p JOIN filings f ON f.id_submission = p.id_submission WHERE p.pick <= 8",
)
def contact_export(spark, sf):
    """All sampled contacts; a missing and an empty comment are both an empty field."""
    rows = v.filings(spark, sf)
    sample = sampling.contact_sample(v.cv(spark, sf), SEED, 8)
    path = scratch_path(spark, "contacts")
    exports.write_tab_separated(sampling.contact_rows(rows, sample, URL), path)
    back = (
        spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option("escape", '"')
        .schema("email string, name string, date timestamp, comment string, url string, source string").csv(path)
    )
    return back.select(
        "source", "email", "name", F.date_format("date", "yyyy-MM-dd").alias("received"), F.md5(F.coalesce("comment", F.lit(""))).alias("comment_md5"), "url"
    )


# --- upserts ------------------------------------------------------------------------------------
@query(
    "upsert_latest",
    "SELECT user_id, event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM "
    "(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1",
)
def upsert_latest(spark, sf):
    events = v.table(spark, sf, "events")
    kept = merge.replace_rows(events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1"), "user_id", "ts")
    return kept.select("user_id", "event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(
    "partial_merge",
    f"WITH {v.FILINGS}, s AS (SELECT *, {DOCKET_SOURCE} AS src FROM filings) SELECT s.id_submission, "
    "CASE WHEN l.doc_id IS NOT NULL AND l.doc_id % 2 = 0 THEN CASE WHEN l.toxic = 0 THEN 'moved' END ELSE s.src END AS source, "
    "CASE WHEN l.doc_id IS NOT NULL THEN l.quality = 1 END AS sentiment_manual FROM s LEFT JOIN labels l ON l.doc_id = s.doc_id",
)
def partial_merge(spark, sf):
    stored = annotate(v.filings(spark, sf))
    patch = v.table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id_submission"),
        F.when(F.col("toxic") == 0, F.lit("moved")).alias("source"),
        (F.col("quality") == 1).alias("sentiment_manual"),
        F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("source"), F.lit("sentiment_manual")))
        .otherwise(F.array(F.lit("sentiment_manual"))).alias("present"),
    )
    return merge.merge_analysis(stored, patch, present="present").select(
        "id_submission", "analysis.source", "analysis.sentiment_manual"
    )


@query(
    "reannotate",
    f"WITH {v.FILINGS}, s AS (SELECT *, {DOCKET_SOURCE} AS src FROM filings) SELECT id_submission, "
    f"CASE WHEN src = 'unknown' THEN {v.source_sql(v.RULES)} ELSE src END AS source FROM s",
)
def reannotate(spark, sf):
    stored = annotate(v.filings(spark, sf))
    patch = daily.reannotate_patch(stored, rules=v.RULES, labels=v.LABELS, support=v.SUPPORT, oppose=v.OPPOSE)
    return merge.merge_analysis(stored, patch, present="present").select("id_submission", "analysis.source")


# --- files --------------------------------------------------------------------------------------
# Stored bytes of documents that go to one file of filings at most, on average.
FILE_BYTES = 64 << 20


def file_count(spark, sf: str, parts: int = 4) -> int:
    """Files to write: ``parts`` of a small table, and so many times more of a larger one that a file is no
    larger than a split of the input, nor than ``FILE_BYTES`` where cores and settings make large splits."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stored = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return parts * -(-max(docs.rdd.getNumPartitions(), -(-stored // FILE_BYTES)) // parts)


def write_json(rows, path: str, files: int) -> None:
    """Filings as JSON lines with fields outside the whitelist; every other address is an object."""
    names = [c for c in rows.columns if c not in ("doc_id", "addressentity")]
    extra = F.struct(F.lit(30).alias("id"), F.lit("DISSEMINATED").alias("description")).alias("filingstatus")
    one = F.to_json(F.struct(*names, F.get("addressentity", F.lit(0)).alias("addressentity"), extra))
    many = F.to_json(F.struct(*names, "addressentity", extra))
    rows.repartition(files, "id_submission").select(
        F.when(F.col("doc_id") % 2 == 0, one).otherwise(many).alias("value")
    ).write.text(path)


@query(
    "read_filings",
    f"WITH {v.FILINGS} SELECT id_submission, text_data, strftime(date_disseminated, '%Y-%m-%d %H:%M:%S') AS disseminated, contact_email, "
    "browser, filer AS filer, CASE WHEN has_address THEN state END AS state, CASE WHEN has_address THEN zip_code END AS zip_code, "
    "CAST(len(list_filter(proceedings, lambda p: coalesce(p['_index'], '') <> '')) AS INTEGER) AS proceedings FROM filings",
)
def read_filings(spark, sf):
    path = scratch_path(spark, "filings")
    write_json(v.filings(spark, sf), path, file_count(spark, sf))
    first = F.get("addressentity", F.lit(0))
    return filing_source.read_filings(spark, path).select(
        "id_submission",
        "text_data",
        F.date_format("date_disseminated", "yyyy-MM-dd HH:mm:ss").alias("disseminated"),
        "contact_email",
        "browser",
        F.get("filers", F.lit(0))["name"].alias("filer"),
        first["state"].alias("state"),
        first["zip_code"].alias("zip_code"),
        F.when(F.col("proceedings").isNotNull(), F.size("proceedings")).alias("proceedings"),
    )


@query("docket_filter", f"WITH {v.FILINGS} SELECT id_submission FROM filings WHERE len(list_filter(proceedings, lambda p: coalesce(p['name'] = '17-108', false))) > 0")
def docket_filter(spark, sf):
    path = scratch_path(spark, "filings")
    write_json(v.filings(spark, sf), path, file_count(spark, sf))
    return filing_source.read_filings(spark, path, "17-108").select("id_submission")


@query(
    "project_filing",
    f"WITH {v.FILINGS} SELECT id_submission, filer AS name, {KEYS_SQL} AS keys FROM filings",
)
def project_filing(spark, sf):
    done = annotate(v.filings(spark, sf))
    return done.select("id_submission", F.get("filers", F.lit(0))["name"].alias("name"), F.col("analysis.proceedings_keys").alias("keys"))


_DAY = "2017-05-10"


@query(
    "daily_increment",
    f"WITH {v.FILINGS} SELECT id_submission, CAST(CAST(date_disseminated AS DATE) AS VARCHAR) AS day, {DOCKET_SOURCE} AS source FROM filings "
    f"WHERE doc_id % 2 = 0 OR CAST(date_disseminated AS DATE) = DATE '{_DAY}'",
)
def daily_increment(spark, sf):
    """Half of the filings are stored already; one day is then run from the files, twice."""
    path, target = scratch_path(spark, "filings"), scratch_path(spark, "comments")
    rows = v.filings(spark, sf)
    write_json(rows, path, file_count(spark, sf))
    daily.ingest(spark, filing_source.read_filings(spark, path).join(rows.filter("doc_id % 2 = 0").select("id_submission"), "id_submission", "left_semi"), target)
    daily.run_day(spark, path, target, _DAY)
    daily.run_day(spark, path, target, _DAY)
    return store.read_comments(spark, target).select("id_submission", F.col("day").cast("string").alias("day"), "analysis.source")


@query(
    "landed_days",
    f"WITH {v.FILINGS} SELECT id_submission, CAST(CAST(date_disseminated AS DATE) AS VARCHAR) AS day, {DOCKET_SOURCE} AS source FROM filings "
    f"WHERE CAST(date_disseminated AS DATE) IN (DATE '{_DAY}', DATE '2017-05-11') AND len(list_filter(proceedings, lambda p: coalesce(p['name'] = '17-108', false))) > 0",
)
def landed_days(spark, sf):
    """Raw files landed by day in two batches, one of them twice; two days of a docket are then run."""
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "comments")
    rows = v.filings(spark, sf)
    for name, part in (("even", "doc_id % 2 = 0"), ("odd", "doc_id % 2 = 1"), ("even", "doc_id % 2 = 0")):
        path = scratch_path(spark, "filings")
        write_json(rows.filter(part), path, file_count(spark, sf))
        filing_source.land(spark, path, landing, name)
    for day in (_DAY, "2017-05-11"):
        daily.run_day(spark, landing, target, day, docket="17-108", landed=True)
    return store.read_comments(spark, target).select("id_submission", F.col("day").cast("string").alias("day"), "analysis.source")


@query(
    "store_update",
    f"WITH {v.FILINGS} SELECT f.id_submission, {DOCKET_SOURCE} AS source, l.quality = 1 AS sentiment_manual FROM filings f LEFT JOIN labels l ON l.doc_id = f.doc_id",
)
def store_update(spark, sf):
    target = scratch_path(spark, "comments")
    daily.ingest(spark, v.filings(spark, sf).drop("doc_id"), target)
    labels = v.table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id_submission"), (F.col("quality") == 1).alias("label")
    )
    store.update_analysis(spark, target, enrich.manual_label_patch(store.read_comments(spark, target), labels, "label"))
    return store.read_comments(spark, target).select("id_submission", "analysis.source", "analysis.sentiment_manual")


@query("report_json", full_report_sql() + ", true AS has_time")
def report_json(spark, sf):
    """The report as it stands in its file, field by field."""
    path = scratch_path(spark, "report")
    counts = report.by_source(v.tagged(spark, sf), v.REVIEWED, v.tags(), F.col("breached"), F.col("day_seen"))
    made = report.full_report(counts, enrich.catalogue(spark))
    exports.write_report(made, path)
    schema = T.StructType([f if f.name != "latest" else T.StructField("latest", T.StringType()) for f in made.schema.fields])
    parsed = spark.read.text(path).select(F.from_json("value", schema.add("updated", "string")).alias("r")).select("r.*")
    return flat_report(parsed).withColumn("has_time", F.lit(True)) if parsed.filter("updated is null").isEmpty() else parsed


_UNTAGGED = "source = 'unknown' AND NOT untaggable AND stance IS NULL"


@query(
    "tagging_jobs",
    phrases_sql({"positive": tagging.PHRASES["positive"], "negative": tagging.PHRASES["negative"]}, 3, "filings", "text_data", v.FILINGS)
    + f""", a AS (SELECT f.*, {DOCKET_SOURCE} AS source, {v.UNTAGGABLE_SQL} AS untaggable, {v.label_sql(DOCKET_SOURCE, stance_labels())} AS by_source,
      {v.stance_sql('text_data', domain.SUPPORT_PATTERNS, domain.OPPOSE_PATTERNS)} AS by_text FROM filings f),
  b AS (SELECT *, coalesce(by_source, by_text) AS stance FROM a),
  pos AS (SELECT DISTINCT doc_id FROM matched WHERE side = 'positive'), neg AS (SELECT DISTINCT doc_id FROM matched WHERE side = 'negative'),
  t AS (SELECT b.*, CASE WHEN {_UNTAGGED} AND doc_id IN (SELECT doc_id FROM pos) THEN 'es_terms_positive'
    WHEN {_UNTAGGED} AND doc_id IN (SELECT doc_id FROM neg) THEN 'es_terms_negative' ELSE source END AS tag FROM b)
  SELECT t.id_submission, t.tag AS source, CASE WHEN coalesce(t.contact_email, '') <> '' THEN t.contact_email IN (SELECT contact_email FROM cv WHERE breached AND contact_email <> '') END AS breached,
    l.quality = 1 AS sentiment_manual FROM t LEFT JOIN labels l ON l.doc_id = t.doc_id""",
)
def tagging_jobs(spark, sf):
    """Phrase tags of both sides, breached addresses and manual labels, job after job over one table."""
    target = scratch_path(spark, "comments")
    rows = v.filings(spark, sf)
    daily.ingest(spark, rows.drop("doc_id"), target)
    for side in ("positive", "negative"):
        tagging.tag_phrases(spark, target, side)
    tagging.flag_breaches(spark, target, v.cv(spark, sf).filter("breached").select(F.col("contact_email").alias("email")))
    labels = v.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id_submission"), (F.col("quality") == 1).alias("label"))
    tagging.label_manually(spark, target, labels)
    return store.read_comments(spark, target).select("id_submission", "analysis.source", "analysis.breached", "analysis.sentiment_manual")


# --- streams ------------------------------------------------------------------------------------
def _event_stream(spark, sf):
    schema = v.table(spark, sf, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


def _run(stream, spark, name):
    path = scratch_path(spark, name)
    ingest.append_stream(stream, path, scratch_path(spark, name + "-state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query(
    "stream_daily_volume",
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= "
    "(SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2",
)
def stream_daily_volume(spark, sf):
    volume = ingest.daily_volume(_event_stream(spark, sf), "ts", [F.col("event_type")], "1 day")
    return _run(volume, spark, "volume").select(
        F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n"
    )


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def stream_dedupe(spark, sf):
    """Every event arrives twice; one of each pair is kept."""
    twice = _event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    kept = ingest.drop_repeats(twice, "event_id", "ts", "1 day")
    return _run(kept.select("event_id", "user_id", "event_type"), spark, "dedupe")


@query(
    "stream_upsert",
    f"WITH {v.FILINGS} SELECT id_submission, CAST(CAST(date_disseminated AS DATE) AS VARCHAR) AS day, {DOCKET_SOURCE} AS source, "
    f"CAST({v.WORDS_SQL} AS INTEGER) AS words FROM filings",
)
def stream_upsert(spark, sf):
    path, target = scratch_path(spark, "filings"), scratch_path(spark, "comments")
    files = file_count(spark, sf)
    write_json(v.filings(spark, sf), path, files)
    # Two batches at any size.
    ingest.upsert_stream(ingest.filing_stream(spark, path, files // 2), target, scratch_path(spark, "ingest-state")).awaitTermination()
    return store.read_comments(spark, target).select(
        "id_submission", F.col("day").cast("string").alias("day"), "analysis.source", "analysis.words"
    )


@query(
    "stream_late_rows",
    f"WITH {v.FILINGS}, f AS (SELECT id_submission, CASE WHEN doc_id % 3 = 0 THEN 'Net Neutrality is not negotiable' ELSE text_data END AS text_data, "
    "CASE WHEN doc_id % 3 = 0 THEN date_disseminated + INTERVAL 1 DAY ELSE date_disseminated END AS date_disseminated FROM filings) "
    f"SELECT id_submission, CAST(CAST(date_disseminated AS DATE) AS VARCHAR) AS day, {DOCKET_SOURCE} AS source FROM f",
)
def stream_late_rows(spark, sf):
    """Corrections of earlier filings arrive late, with a new text and a day moved by one."""
    first, second, target = (scratch_path(spark, n) for n in ("filings", "filings", "comments"))
    state = scratch_path(spark, "ingest-state")
    rows = v.filings(spark, sf)
    write_json(rows, first, file_count(spark, sf))
    ingest.upsert_stream(ingest.filing_stream(spark, first), target, state).awaitTermination()
    late = rows.filter("doc_id % 3 = 0").withColumns(
        {
            "text_data": F.lit("Net Neutrality is not negotiable"),
            "date_disseminated": F.col("date_disseminated") + F.expr("interval 1 day"),
        }
    )
    write_json(late, second, file_count(spark, sf))
    ingest.upsert_stream(ingest.filing_stream(spark, second), target, scratch_path(spark, "ingest-state")).awaitTermination()
    return store.read_comments(spark, target).select(
        "id_submission", F.col("day").cast("string").alias("day"), "analysis.source"
    )


_SPAN = 23


@query(
    "stream_volume_by_source",
    f"WITH {v.FILINGS}, f AS (SELECT *, {v.source_sql(v.RULES)} AS source, {v.stance_sql('text_data', v.SUPPORT, v.OPPOSE)} AS stance FROM filings), "
    f"g AS (SELECT *, coalesce({v.label_sql('source', v.LABELS)}, stance) AS titleii FROM f) "
    "SELECT CAST(CAST(date_disseminated AS DATE) AS VARCHAR) AS day, source, CASE WHEN titleii THEN 'positive' WHEN NOT titleii THEN 'negative' ELSE 'none' END AS stance, "
    "count(*) AS n FROM g WHERE CAST(date_disseminated AS DATE) + INTERVAL 1 DAY <= (SELECT max(date_disseminated) - INTERVAL 50 DAY FROM filings) GROUP BY 1, 2, 3",
)
def stream_volume_by_source(spark, sf):
    """Files in order of time, but a fifth of the filings come a file later than they should."""
    path, rows = scratch_path(spark, "filings"), v.filings(spark, sf)
    turn = F.floor(F.datediff("date_received", F.lit("2017-05-01")) / _SPAN) + (F.col("doc_id") % 5 == 0).cast("int")
    # The files of a turn make one batch, at any size.
    files = file_count(spark, sf) // 4
    for i in range(90 // _SPAN + 2):
        write_json(rows.filter(turn == i), f"{path}/part={i}", files)
    stream = ingest.filing_stream(spark, f"{path}/*", files)
    rules = {"rules": v.RULES, "labels": v.LABELS, "support": v.SUPPORT, "oppose": v.OPPOSE}
    volume = ingest.volume_by_source(stream, "50 days", **rules)
    return _run(volume, spark, "volume").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "source", "stance", "n")


@query(
    "stream_restart",
    f"WITH {v.FILINGS} SELECT id_submission, CAST(CAST(date_disseminated AS DATE) AS VARCHAR) AS day, {DOCKET_SOURCE} AS source, "
    "CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS run FROM filings "
    "WHERE len(list_filter(proceedings, lambda p: coalesce(p['name'] = '17-108', false))) > 0",
)
def stream_restart(spark, sf):
    """A stream stops and starts again: what comes a second time was seen before and is not written."""
    path, target, state = (scratch_path(spark, n) for n in ("filings", "comments", "ingest-state"))
    rows, files = v.filings(spark, sf), file_count(spark, sf)
    # One batch a run, at any size.
    start = lambda: ingest.upsert_stream(ingest.filing_stream(spark, f"{path}/*", max(100, files), "17-108"), target, state)
    write_json(rows.filter("doc_id % 2 = 0"), f"{path}/part=1", files)
    start().awaitTermination()
    first = store.read_comments(spark, target).agg(F.max(store.ORDER)).first()[0]
    write_json(rows, f"{path}/part=2", files)
    start().awaitTermination()
    run = F.when(F.col(store.ORDER) <= F.lit(first), 1).otherwise(2).alias("run")
    return store.read_comments(spark, target).select("id_submission", F.col("day").cast("string").alias("day"), "analysis.source", run)
