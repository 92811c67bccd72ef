"""Row-level queries: annotation, flags, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.functions import flags, predicates, text
from commentlens.functions.rules import source_label, text_stance
from commentlens.operators.annotate import annotate, source_stance, stance_labels
from commentlens.operators.enrich import catalogue
from commentlens.operators.similarity import too_short
from commentlens.rules import domain
from commentlens.sources import filings as filing_source

from . import views as v

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return add


DOCKET_SOURCE = v.source_sql(domain.SOURCE_RULES)
DOCKET_STANCE = v.stance_sql("text_data", domain.SUPPORT_PATTERNS, domain.OPPOSE_PATTERNS)
ONSITE_SQL = "CASE WHEN proceedings IS NOT NULL THEN len(list_filter(proceedings, lambda p: list_contains(map_keys(p), '_index'))) > 0 END"
METHOD_SQL = f"CASE WHEN starts_with(browser, 'OpenCSV') THEN 'csv' WHEN coalesce({ONSITE_SQL}, false) THEN 'direct' ELSE 'api' END"
CAPS_SQL = "CASE WHEN contact_email <> '' THEN contact_email = upper(contact_email) END"
ADDRESS_SQL = "(has_address AND coalesce(city, '') <> '' AND coalesce(state, '') <> '' AND coalesce(zip_code, '') <> '')"
KEYS_SQL = "CASE WHEN proceedings IS NOT NULL THEN coalesce(array_to_string(flatten(list_transform(proceedings, lambda p: list_sort(map_keys(p)))), ' '), '') END"
WORD_LIST_SQL = (
    "array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(regexp_replace("
    "lower(coalesce(text_data, '')), '[''-]+', '', 'g'), '[^a-z ]+', ' ', 'g'), ' '), lambda w: w <> ''))), ' ')"
)
FINGERPRINT_SQL = f"substr({WORD_LIST_SQL}, 1, 1000)"


@query("rule_source", f"WITH {v.CV} SELECT id_submission, {v.source_sql(v.RULES)} AS rule_source FROM cv")
def rule_source(spark, sf):
    rows = v.cv(spark, sf).withColumn("lowered", F.lower("text_data"))
    return rows.select("id_submission", source_label(v.RULES, F.col("text_data"), F.col("lowered")).alias("rule_source"))


@query("docket_source", f"WITH {v.FILINGS} SELECT id_submission, {DOCKET_SOURCE} AS rule_source FROM filings")
def docket_source(spark, sf):
    rows = v.filings(spark, sf).withColumn("lowered", F.lower("text_data"))
    return rows.select(
        "id_submission", source_label(domain.SOURCE_RULES, F.col("text_data"), F.col("lowered")).alias("rule_source")
    )


@query("stance_text", f"WITH {v.FILINGS} SELECT id_submission, {DOCKET_STANCE} AS stance FROM filings")
def stance_text(spark, sf):
    return v.filings(spark, sf).select(
        "id_submission",
        text_stance(F.col("text_data"), domain.SUPPORT_PATTERNS, domain.OPPOSE_PATTERNS, None, domain.SUPPORT_NEEDS, domain.OPPOSE_NEEDS).alias("stance"),
    )


@query(
    "stance_resolved",
    f"WITH {v.CV}, s AS (SELECT id_submission, text_data, {v.source_sql(v.RULES)} AS src FROM cv) "
    f"SELECT id_submission, src AS rule_source, coalesce({v.label_sql('src', v.LABELS)}, {v.stance_sql('text_data', v.SUPPORT, v.OPPOSE)}) AS stance FROM s",
)
def stance_resolved(spark, sf):
    done = annotate(v.cv(spark, sf), v.RULES, v.LABELS, v.SUPPORT, v.OPPOSE)
    return done.select(
        "id_submission", F.col("analysis.source").alias("rule_source"), F.col("analysis.titleii").alias("stance")
    )


@query(
    "stance_lists",
    f"WITH {v.FILINGS}, s AS (SELECT id_submission, {DOCKET_SOURCE} AS src FROM filings) "
    f"SELECT id_submission, {v.label_sql('src', stance_labels('catalogue'))} AS by_catalogue, "
    f"{v.label_sql('src', stance_labels('lists'))} AS by_lists FROM s",
)
def stance_lists(spark, sf):
    src = docket_source(spark, sf)
    return src.select(
        "id_submission",
        source_stance(F.col("rule_source"), stance_labels("catalogue")).alias("by_catalogue"),
        source_stance(F.col("rule_source"), stance_labels("lists")).alias("by_lists"),
    )


_CATALOGUE_SQL = "cat(source, stance) AS (VALUES " + ", ".join(
    f"({v.quote(label)}, {v.quote(stance)})" for label, _, stance, _ in domain.CATALOGUE
) + ")"


@query(
    "taxonomy_join",
    f"WITH {v.FILINGS}, s AS (SELECT {DOCKET_SOURCE} AS source FROM filings), {_CATALOGUE_SQL} "
    "SELECT s.source, cat.stance, count(*) AS n FROM s LEFT JOIN cat ON s.source = cat.source GROUP BY 1, 2",
)
def taxonomy_join(spark, sf):
    src = docket_source(spark, sf).select(F.col("rule_source").alias("source"))
    labels = catalogue(spark).select("source", "stance")  # fixed size
    return src.join(F.broadcast(labels), "source", "left").groupBy("source", "stance").agg(F.count(F.lit(1)).alias("n"))


@query(
    "annotate_flags",
    f"WITH {v.FILINGS}, s AS (SELECT *, {DOCKET_SOURCE} AS src FROM filings) "
    f"SELECT id_submission, {ADDRESS_SQL} AS fulladdress, {CAPS_SQL} AS capsemail, src AS source, {KEYS_SQL} AS proceedings_keys, "
    f"{ONSITE_SQL} AS onsite, {METHOD_SQL} AS ingestion_method, {FINGERPRINT_SQL} AS fingerprint, "
    f"coalesce({v.label_sql('src', stance_labels())}, {DOCKET_STANCE}) AS titleii, "
    f"CAST({v.WORDS_SQL} AS INTEGER) AS words, {v.UNTAGGABLE_SQL} AS untaggable FROM s",
)
def annotate_flags(spark, sf):
    done = annotate(v.filings(spark, sf))
    names = ["fulladdress", "capsemail", "source", "proceedings_keys", "onsite", "ingestion_method", "fingerprint", "titleii", "words", "untaggable"]
    return done.select("id_submission", *(F.col(f"analysis.{n}").alias(n) for n in names))


@query("fingerprint", f"WITH {v.CV} SELECT id_submission, {FINGERPRINT_SQL} AS fingerprint FROM cv")
def fingerprint(spark, sf):
    return v.cv(spark, sf).select("id_submission", text.fingerprint(F.col("text_data")).alias("fingerprint"))


@query(
    "word_counts",
    f"WITH {v.FILINGS} SELECT id_submission, CAST({v.WORDS_SQL} AS INTEGER) AS words, {v.UNTAGGABLE_SQL} AS untaggable FROM filings",
)
def word_counts(spark, sf):
    body = F.col("text_data")
    return v.filings(spark, sf).select("id_submission", text.word_count(body).alias("words"), text.untaggable(body).alias("untaggable"))


@query("normalized_space", f"WITH {v.CV} SELECT id_submission, regexp_replace(text_data, '\\s+', ' ', 'g') AS body FROM cv")
def normalized_space(spark, sf):
    return v.cv(spark, sf).select("id_submission", text.normalize_space(F.col("text_data")).alias("body"))


@query("ingestion_method", f"WITH {v.FILINGS} SELECT id_submission, {METHOD_SQL} AS method FROM filings")
def ingestion_method(spark, sf):
    return v.filings(spark, sf).select(
        "id_submission", flags.ingestion_method(F.col("browser"), F.col("proceedings")).alias("method")
    )


@query("caps_email", f"WITH {v.CV} SELECT id_submission, {CAPS_SQL} AS capsemail FROM cv")
def caps_email(spark, sf):
    return v.cv(spark, sf).select("id_submission", flags.caps_email(F.col("contact_email")).alias("capsemail"))


@query("full_address", f"WITH {v.FILINGS} SELECT id_submission, {ADDRESS_SQL} AS fulladdress FROM filings")
def full_address(spark, sf):
    return v.filings(spark, sf).select("id_submission", flags.full_address(F.col("addressentity")).alias("fulladdress"))


@query("proceeding_keys", f"WITH {v.FILINGS} SELECT id_submission, {KEYS_SQL} AS keys FROM filings")
def proceeding_keys(spark, sf):
    return v.filings(spark, sf).select("id_submission", flags.proceeding_keys(F.col("proceedings")).alias("keys"))


@query("onsite_flag", f"WITH {v.FILINGS} SELECT id_submission, {ONSITE_SQL} AS onsite FROM filings")
def onsite_flag(spark, sf):
    return v.filings(spark, sf).select("id_submission", flags.onsite(F.col("proceedings")).alias("onsite"))


@query(
    "shrunk_proceedings",
    f"WITH {v.FILINGS}, k AS (SELECT id_submission, list_transform(list_filter(proceedings, "
    "lambda p: coalesce(p['_index'], '') <> ''), lambda p: p['_index']) AS kept FROM filings) "
    "SELECT id_submission, CASE WHEN len(kept) = 0 THEN '' ELSE array_to_string(kept, ',') END AS kept, CAST(len(kept) AS INTEGER) AS entries FROM k",
)
def shrunk_proceedings(spark, sf):
    kept = flags.shrink_proceedings(F.col("proceedings"))
    return (
        v.filings(spark, sf)
        .select("id_submission", kept.alias("p"))
        .select(
            "id_submission",
            F.array_join(F.flatten(F.transform("p", lambda m: F.map_values(m))), ",").alias("kept"),
            F.when(F.col("p").isNotNull(), F.size("p")).alias("entries"),
        )
    )


# --- predicates ---------------------------------------------------------------------------------
@query("positive_set", f"WITH {v.TAGGED} SELECT id_submission FROM tagged WHERE {v.POSITIVE_SQL}")
def positive_set(spark, sf):
    return v.tagged(spark, sf).filter(predicates.positive(v.tags(), v.REVIEWED)).select("id_submission")


@query("negative_set", f"WITH {v.TAGGED} SELECT id_submission FROM tagged WHERE {v.NEGATIVE_SQL}")
def negative_set(spark, sf):
    return v.tagged(spark, sf).filter(predicates.negative(v.tags(), v.REVIEWED)).select("id_submission")


@query("untagged_set", f"WITH {v.TAGGED} SELECT id_submission FROM tagged WHERE {v.UNTAGGED_SQL}")
def untagged_set(spark, sf):
    return v.tagged(spark, sf).filter(predicates.untagged(v.tags(), v.REVIEWED)).select("id_submission")


@query(
    "review_queue",
    f"WITH {v.TAGGED} SELECT id_submission, source FROM tagged WHERE titleii IS NULL AND sentiment_manual IS NULL AND sig_terms IS NULL "
    f"AND NOT {v.in_sql('source', [*v.REVIEWED.positive_sources, *v.REVIEWED.negative_sources])}",
)
def review_queue(spark, sf):
    return v.tagged(spark, sf).filter(predicates.needs_review(v.tags(), v.REVIEWED)).select("id_submission", "source")


@query(
    "seed_eligible",
    f"WITH {v.TAGGED} SELECT id_submission FROM tagged WHERE source = 'unknown' AND cluster IS NULL AND titleii IS NULL",
)
def seed_eligible(spark, sf):
    return v.tagged(spark, sf).filter(predicates.seed_eligible(v.tags())).select("id_submission")


@query(
    "tag_exists",
    f"WITH {v.TAGGED} SELECT titleii IS NOT NULL AS has_stance, sentiment_manual IS NULL AS no_manual, count(*) AS n FROM tagged GROUP BY 1, 2",
)
def tag_exists(spark, sf):
    return v.tagged(spark, sf).groupBy(
        F.col("titleii").isNotNull().alias("has_stance"), F.col("sentiment_manual").isNull().alias("no_manual")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "day_range",
    f"WITH {v.FILINGS} SELECT id_submission FROM filings WHERE date_disseminated >= TIMESTAMP '2017-05-10' AND date_disseminated < TIMESTAMP '2017-05-11'",
)
def day_range(spark, sf):
    return v.filings(spark, sf).filter(predicates.on_day(F.col("date_disseminated"), "2017-05-10")).select("id_submission")


@query(
    "date_span",
    f"WITH {v.FILINGS} SELECT id_submission FROM filings WHERE date_disseminated >= TIMESTAMP '2017-05-10' AND date_disseminated < TIMESTAMP '2017-05-13'",
)
def date_span(spark, sf):
    return v.filings(spark, sf).filter(
        predicates.between_days(F.col("date_disseminated"), "2017-05-10", "2017-05-13")
    ).select("id_submission")


@query(
    "date_bounds",
    f"WITH {v.FILINGS} SELECT id_submission, strftime(date_disseminated, '%Y-%m-%d %H:%M:%S') AS disseminated FROM filings "
    "WHERE date_disseminated BETWEEN TIMESTAMP '2017-06-01' AND TIMESTAMP '2017-06-03 12:00:00' ORDER BY date_disseminated, id_submission",
)
def date_bounds(spark, sf):
    rows = filing_source.between(v.filings(spark, sf), "2017-06-01", "2017-06-03 12:00:00")
    return filing_source.by_date(rows).select(
        "id_submission", F.date_format("date_disseminated", "yyyy-MM-dd HH:mm:ss").alias("disseminated")
    )


@query(
    "keyword_filter",
    f"WITH {v.CV} SELECT id_submission, source FROM cv WHERE source IN ('src1', 'src7') AND lang = 'en'",
)
def keyword_filter(spark, sf):
    return v.cv(spark, sf).filter(predicates.in_list(F.col("source"), ["src1", "src7"]) & (F.col("lang") == "en")).select(
        "id_submission", "source"
    )


@query(
    "labelled_ids",
    f"WITH {v.CV} SELECT cv.id_submission, cv.source FROM cv JOIN labels l ON l.doc_id = cv.doc_id AND l.quality = 0",
)
def labelled_ids(spark, sf):
    wanted = v.table(spark, sf, "labels").filter("quality = 0").select("doc_id")
    return v.cv(spark, sf).join(wanted, "doc_id", "left_semi").select("id_submission", "source")


@query("with_email", f"WITH {v.CV} SELECT id_submission FROM cv WHERE contact_email <> ''")
def with_email(spark, sf):
    return v.cv(spark, sf).filter(predicates.has_email(F.col("contact_email"))).select("id_submission")


@query(
    "too_short",
    f"WITH {v.TAGGED} SELECT id_submission, CAST({v.WORDS_SQL} AS INTEGER) AS words, {v.WORDS_SQL} < 50 AS too_short FROM tagged "
    "WHERE source = 'unknown' AND cluster IS NULL AND titleii IS NULL",
)
def too_short_seeds(spark, sf):
    body = F.col("text_data")
    return v.tagged(spark, sf).filter(predicates.seed_eligible(v.tags())).select(
        "id_submission", text.word_count(body).alias("words"), too_short(body).alias("too_short")
    )
