"""Reports by source and position."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.operators.enrich import catalogue
from commentlens.plans import report
from commentlens.rules import domain
from commentlens.sources import store

from . import views as v
from .rows import DOCKET_SOURCE, DOCKET_STANCE

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return add


def _counts(spark, sf):
    return report.by_source(v.tagged(spark, sf), v.REVIEWED, v.tags(), F.col("breached"), F.col("day_seen"))


def _top_sql(predicate: str) -> str:
    return (
        f"SELECT source, n FROM (SELECT source, count(*) AS n FROM tagged WHERE {predicate} GROUP BY source "
        "ORDER BY n DESC, source LIMIT 25) WHERE source <> 'unknown'"
    )


_BREACH = (
    "SELECT source, count(*) FILTER (WHERE breached) AS breached, count(*) FILTER (WHERE NOT breached) AS unbreached FROM tagged "
    "WHERE breached IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 25"
)


@query(
    "report_counts",
    f"WITH {v.TAGGED} SELECT source, count(*) AS total, CAST(max(day_seen) AS VARCHAR) AS latest, "
    f"count(*) FILTER (WHERE {v.POSITIVE_SQL}) AS positive, count(*) FILTER (WHERE {v.NEGATIVE_SQL}) AS negative, "
    f"count(*) FILTER (WHERE {v.POSITIVE_SQL} AND {v.NEGATIVE_SQL}) AS conflict, "
    f"count(*) FILTER (WHERE {v.POSITIVE_SQL} AND sig_terms) AS sig_true, count(*) FILTER (WHERE {v.POSITIVE_SQL} AND NOT sig_terms) AS sig_false, "
    "count(*) FILTER (WHERE breached) AS breached, count(*) FILTER (WHERE NOT breached) AS unbreached FROM tagged GROUP BY source",
)
def report_counts(spark, sf):
    return _counts(spark, sf).withColumn("latest", F.col("latest").cast("string"))


@query("corpus_totals", f"WITH {v.CV} SELECT count(*) AS total, CAST(max(day_seen) AS VARCHAR) AS latest FROM cv")
def corpus_totals(spark, sf):
    return report.corpus_totals(_counts(spark, sf)).select("total", F.col("latest").cast("string").alias("latest"))


@query("positive_by_source", f"WITH {v.TAGGED} {_top_sql(v.POSITIVE_SQL)}")
def positive_by_source(spark, sf):
    return report.position_by_source(_counts(spark, sf), "positive")


@query("negative_by_source", f"WITH {v.TAGGED} {_top_sql(v.NEGATIVE_SQL)}")
def negative_by_source(spark, sf):
    return report.position_by_source(_counts(spark, sf), "negative")


@query(
    "sig_terms_bucket",
    f"WITH {v.TAGGED} SELECT max(n) AS sig_terms FROM (SELECT sig_terms, count(*) AS n FROM tagged WHERE {v.POSITIVE_SQL} AND sig_terms IS NOT NULL GROUP BY 1)",
)
def sig_terms_bucket(spark, sf):
    return report.full_report(_counts(spark, sf)).select(F.col("positive_by_source")["sig_terms"].alias("sig_terms"))


@query("breach_by_source", f"WITH {v.TAGGED} {_BREACH}")
def breach_by_source(spark, sf):
    return report.breach_by_source(_counts(spark, sf))


@query(
    "breach_pct",
    f"WITH {v.TAGGED}, b AS ({_BREACH}) SELECT source, CAST(floor(100.0 * breached / (breached + unbreached) + 0.5) AS BIGINT) AS breached_pct, "
    "CAST(floor(100.0 * unbreached / (breached + unbreached) + 0.5) AS BIGINT) AS unbreached_pct, breached + unbreached AS comments FROM b",
)
def breach_pct(spark, sf):
    return report.breach_percentages(report.breach_by_source(_counts(spark, sf)))


_CAT_SQL = "cat(source, icon, stance) AS (VALUES " + ", ".join(
    f"({v.quote(label)}, {v.quote(icon)}, {v.quote(stance)})" for label, icon, stance, _ in domain.CATALOGUE
) + ")"


@query(
    "catalogue_counts",
    f"WITH {v.FILINGS}, s0 AS (SELECT *, {DOCKET_SOURCE} AS source FROM filings), {_CAT_SQL}, "
    f"s AS (SELECT s0.source, coalesce(c.stance = 'positive', {DOCKET_STANCE}) AS stance FROM s0 LEFT JOIN cat c ON c.source = s0.source), "
    "ranked AS (SELECT source, stance, count(*) AS n FROM s "
    "WHERE stance IS NOT NULL GROUP BY source, stance) "
    "SELECT cat.source, cat.icon, cat.stance, coalesce(ranked.n, 0) AS n FROM cat LEFT JOIN ranked ON ranked.source = cat.source "
    "AND ranked.stance = (cat.stance = 'positive') AND ranked.source <> 'unknown'",
)
def catalogue_counts(spark, sf):
    from commentlens.functions.predicates import Reviewed, Tags
    from commentlens.operators.annotate import annotate

    done = annotate(v.filings(spark, sf)).withColumn("day", F.to_date("date_disseminated"))
    counts = report.by_source(done, Reviewed(), Tags(), when=F.col("day"))
    return report.catalogue_counts(catalogue(spark), counts).select("source", "icon", "stance", "n")


def full_report_sql() -> str:
    return (
        f"WITH {v.TAGGED}, b AS ({_BREACH}), p AS ({_top_sql(v.POSITIVE_SQL)}), g AS ({_top_sql(v.NEGATIVE_SQL)}), "
        f"sig AS (SELECT max(n) AS n FROM (SELECT sig_terms, count(*) AS n FROM tagged WHERE {v.POSITIVE_SQL} AND sig_terms IS NOT NULL GROUP BY 1)) "
        "SELECT (SELECT count(*) FROM tagged) AS total, (SELECT CAST(max(day_seen) AS VARCHAR) FROM tagged) AS latest, "
        f"(SELECT count(*) FROM tagged WHERE {v.POSITIVE_SQL}) AS total_positive, (SELECT count(*) FROM tagged WHERE {v.NEGATIVE_SQL}) AS total_negative, "
        f"(SELECT count(*) FROM tagged WHERE {v.POSITIVE_SQL} AND {v.NEGATIVE_SQL}) AS conflict, "
        "(SELECT string_agg(source || ':' || n, ',' ORDER BY source) FROM (SELECT source, n FROM p UNION ALL SELECT 'sig_terms', n FROM sig WHERE n IS NOT NULL)) AS positive_by_source, "
        "(SELECT string_agg(source || ':' || n, ',' ORDER BY source) FROM g) AS negative_by_source, "
        "(SELECT string_agg(source || ':' || breached || '/' || unbreached, ',' ORDER BY source) FROM b) AS breached"
    )


def flat_report(made):
    """The report with its maps as text."""
    flat = lambda name, value: F.array_join(
        F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit(":"), value(e["value"]))), ","
    )
    number = lambda x: x.cast("string")
    return made.select(
        "total",
        F.col("latest").cast("string").alias("latest"),
        "total_positive",
        "total_negative",
        "conflict",
        flat("positive_by_source", number).alias("positive_by_source"),
        flat("negative_by_source", number).alias("negative_by_source"),
        flat("breached", lambda x: F.concat(number(x["breached"]), F.lit("/"), number(x["unbreached"]))).alias("breached"),
    )


@query("full_report", full_report_sql())
def full_report(spark, sf):
    return flat_report(report.full_report(_counts(spark, sf)))


@query(
    "source_exemplars",
    f"WITH {v.TAGGED}, f AS (SELECT source, min(doc_id) AS doc_id FROM tagged GROUP BY source) "
    "SELECT f.source, t.text_data AS sample FROM f JOIN tagged t ON t.doc_id = f.doc_id",
)
def source_exemplars(spark, sf):
    return report.exemplars(v.tagged(spark, sf), F.col("source"), "doc_id")


@query("backlog_count", f"WITH {v.FILINGS} SELECT count(*) FILTER (WHERE doc_id % 3 = 0) AS backlog FROM filings")
def backlog_count(spark, sf):
    from commentlens.operators.annotate import annotate

    done = annotate(v.filings(spark, sf)).withColumn(
        "analysis", F.when(F.col("doc_id") % 3 != 0, F.col("analysis"))
    )
    return store.backlog(done)
