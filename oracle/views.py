"""Comment-shaped views of the fixture tables, in Spark and in DuckDB SQL.

The tables hold no filings. ``cv`` reads documents as comments; ``filings`` adds the nested fields
of a filing and works a line of docket text into each document, so that every docket rule meets
rows that match it and rows that nearly do. Both cover all documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.functions.predicates import Reviewed, Tags
from commentlens.sources.filings import spread
from commentlens.rules import domain
from commentlens.rules.model import Rule, all_of, any_of, prefix


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df, "doc_id") if name == "documents" else df


# Rules whose words occur in the fixture documents.
RULES: list[Rule] = [
    any_of("tpl.anea", "The and attion to thanedble the, anea"),
    prefix("tpl.opening", "Is and ", "Du ", "En "),
    any_of("tpl.folded", "HA EDBLE A EAEAOR", "la des et", ignore_case=True),
    all_of("tpl.both", "tion of", "on the"),
    Rule("tpl.cnf", (("the ", "and "), ("tion", "ment"), ("WORTHLESS", "PATHETIC", "ea is")), ignore_case=True),
    any_of("tpl.closing", "(The|Of|And|Le) [a-z]+ ", mode="regex_anchored", target="last_sentence"),
    any_of("tpl.pattern", "th(in|an) (of|the)", "de (la|les) [a-z]+ et", mode="regex_search", ignore_case=True),
]
SUPPORT = ["(is|was) the (er|in)", "ing (a|an) "]
OPPOSE = ["thnt", "enlich", "que (la|las)"]
LABELS = {"tpl.anea": True, "tpl.opening": False, "tpl.both": True, "tpl.closing": False}

REVIEWED = Reviewed(
    positive_sources=("src1", "src2", "src3"),
    negative_sources=("src4", "src5"),
    positive_clusters=("c0", "c1"),
    negative_clusters=("c2",),
)


def tags() -> Tags:
    """Column objects need a running session, so they are made on demand."""
    return Tags(
        source=F.col("source"),
        stance=F.col("titleii"),
        manual=F.col("sentiment_manual"),
        sig_terms=F.col("sig_terms"),
        untaggable=F.col("untaggable"),
        cluster=F.col("cluster"),
    )


# --- cv: documents as comments ------------------------------------------------------------------
def cv(spark: SparkSession, sf: str) -> DataFrame:
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    address = F.concat(
        F.lit("user"), (F.col("doc_id") % 150).cast("string"), F.lit("@"), F.col("source"), F.lit(".example.com")
    )
    return d.join(l, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id_submission"),
        "doc_id",
        F.col("text").alias("text_data"),
        "source",
        "lang",
        F.date_add(F.lit("2017-05-01").cast("date"), (F.col("doc_id") % 90).cast("int")).alias("day_seen"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(None))
        .when(F.col("doc_id") % 3 == 0, F.upper(address))
        .otherwise(address)
        .alias("contact_email"),
        (F.col("quality") == 1).alias("sentiment_manual"),
        (F.col("toxic") == 1).alias("breached"),
    )


CV = """cv AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id_submission, d.doc_id, d.text AS text_data, d.source, d.lang,
    date '2017-05-01' + CAST(d.doc_id % 90 AS INTEGER) AS day_seen,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL
         WHEN d.doc_id % 3 = 0 THEN upper(concat('user', CAST(d.doc_id % 150 AS VARCHAR), '@', d.source, '.example.com'))
         ELSE concat('user', CAST(d.doc_id % 150 AS VARCHAR), '@', d.source, '.example.com') END AS contact_email,
    l.quality = 1 AS sentiment_manual, l.toxic = 1 AS breached
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


# --- tagged: cv with every tag a predicate looks at ---------------------------------------------
def tagged(spark: SparkSession, sf: str) -> DataFrame:
    from commentlens.functions.rules import text_stance
    from commentlens.functions.text import untaggable

    n = F.col("doc_id")
    return cv(spark, sf).withColumns(
        {
            "source": F.when(n % 4 == 0, F.lit("unknown")).otherwise(F.col("source")),
            "titleii": text_stance(F.col("text_data"), SUPPORT, OPPOSE),
            "sig_terms": F.when(n % 9 == 0, F.lit(True)).when(n % 9 == 1, F.lit(False)),
            "cluster": F.when(n % 13 == 0, F.concat(F.lit("c"), (n % 5).cast("string"))),
            "untaggable": untaggable(F.col("text_data")),
        }
    )


def regex_sql(text: str, patterns: list[str] | tuple[str, ...], ignore_case: bool = True) -> str:
    flag = ", 'i'" if ignore_case else ""
    return "(" + " OR ".join(f"regexp_matches({text}, {quote(p)}{flag})" for p in patterns) + ")"


def stance_sql(text: str, support: list[str], oppose: list[str]) -> str:
    return f"CASE WHEN {regex_sql(text, support)} THEN true WHEN {regex_sql(text, oppose)} THEN false END"


WORDS_SQL = "len(string_split(coalesce(text_data, ''), ' '))"
UNTAGGABLE_SQL = f"(length(coalesce(text_data, '')) < 13 OR {WORDS_SQL} < 3)"
TAGGED = CV + f""", tagged AS (
  SELECT id_submission, doc_id, text_data, lang, day_seen, contact_email, sentiment_manual, breached,
    CASE WHEN doc_id % 4 = 0 THEN 'unknown' ELSE source END AS source,
    {stance_sql('text_data', SUPPORT, OPPOSE)} AS titleii,
    CASE WHEN doc_id % 9 = 0 THEN true WHEN doc_id % 9 = 1 THEN false END AS sig_terms,
    CASE WHEN doc_id % 13 = 0 THEN concat('c', CAST(doc_id % 5 AS VARCHAR)) END AS cluster,
    {UNTAGGABLE_SQL} AS untaggable
  FROM cv)"""


def in_sql(column: str, values) -> str:
    return f"coalesce({column} IN ({', '.join(quote(v) for v in values)}), false)"


def position_sql(value: str, sources, clusters) -> str:
    return (
        f"(sentiment_manual IS NOT DISTINCT FROM {value} OR titleii IS NOT DISTINCT FROM {value} "
        f"OR sig_terms IS NOT DISTINCT FROM {value} OR {in_sql('source', sources)} OR {in_sql('cluster', clusters)})"
    )


POSITIVE_SQL = position_sql("true", REVIEWED.positive_sources, REVIEWED.positive_clusters)
NEGATIVE_SQL = position_sql("false", REVIEWED.negative_sources, REVIEWED.negative_clusters)
UNTAGGED_SQL = (
    "(source IS NOT DISTINCT FROM 'unknown' AND NOT untaggable AND sentiment_manual IS NULL AND titleii IS NULL "
    "AND sig_terms IS NULL AND NOT "
    + in_sql("cluster", [*REVIEWED.positive_clusters, *REVIEWED.negative_clusters])
    + ")"
)


# --- filings: nested rows with docket text ------------------------------------------------------
def _rule_line(rule: Rule) -> str:
    if rule.mode.startswith("regex"):
        return ""
    return " ".join(group[-1] for group in rule.groups)


LINES: list[str] = [line for line in map(_rule_line, domain.SOURCE_RULES) if line] + [
    # A sentence of the generated-text grammar, and one that breaks it.
    "It ended a hands-off framework that worked very well for decades with bipartisan support.",
    "It might have ended a hands-off framework that worked very well for decades with bipartisan support.",
    # Own wording around the searched patterns, with near misses.
    "We want strong net neutrality rules backed by Title II and nothing less",
    "I specifically support net neutrality, backed by title two oversight",
    "Net neutrality is backed by many people",
    "Kindly uphold net neutrality for our library",
    "Please continue title II for rural towns",
    "i strongly support title 2 for schools",
    "Do not revoke these protections",
    "End Obamas internet takeover now",
    "please reverse the 2015 order",
    "Please roll back this order",
    "Please roll it back",
    "",
]


def filings(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc_id")
    line = F.element_at(F.array(*map(F.lit, LINES)), (n % len(LINES) + 1).cast("int"))
    line = F.when(n % 11 == 0, F.upper(line)).otherwise(line)
    text = (
        F.when(n % 97 == 5, F.lit(None).cast("string"))
        .when(n % 101 == 5, F.lit(""))
        .when(n % 4 == 3, F.concat("text", F.lit(" "), line))
        .otherwise(F.concat(line, F.lit(" "), "text"))
    )
    entry = lambda **kv: F.create_map(*(F.lit(x) for pair in kv.items() for x in pair))
    proceedings = (
        F.when(n % 5 == 1, F.array().cast("array<map<string,string>>"))
        .when(n % 5 == 2, F.array(entry(name="17-108", id_proceeding="1")))
        .when(n % 5 == 3, F.array(entry(zeta="z", _index="p1", name="17-108"), entry(name="n")))
        .when(n % 5 == 4, F.array(entry(_index="")))
    )
    part = lambda value, keep: F.when(keep, F.lit(value))
    address = F.struct(
        F.lit("1 Main St").alias("address_line_1"),
        F.lit(None).cast("string").alias("address_line_2"),
        F.concat(F.lit("City"), (n % 10).cast("string")).alias("city"),
        part("NV", n % 6 != 3).alias("state"),
        F.when(n % 6 == 2, F.lit("")).otherwise(F.lit("89108")).alias("zip_code"),
        F.lit(None).cast("string").alias("zip4"),
        F.lit(None).cast("struct<addresstext:string>").alias("internationaladdressentity"),
    )
    addresses = F.when(n % 6 == 0, F.lit(None)).when(n % 6 == 1, F.slice(F.array(address), 1, 0)).otherwise(F.array(address))
    base = cv(spark, sf).select("doc_id", "contact_email", "day_seen")
    return (
        table(spark, sf, "documents")
        .select("doc_id", "text")
        .join(base, "doc_id")
        .select(
            F.col("doc_id").cast("string").alias("id_submission"),
            "doc_id",
            text.alias("text_data"),
            F.col("day_seen").cast("timestamp").alias("date_received"),
            (F.col("day_seen").cast("timestamp") + F.make_interval(hours=(n % 24).cast("int"))).alias("date_disseminated"),
            "contact_email",
            F.when(n % 10 == 0, F.lit("OpenCSV 3")).when(n % 10 != 1, F.lit("Mozilla/5.0")).alias("browser"),
            F.array(F.struct(F.concat(F.lit("Filer "), (n % 200).cast("string")).alias("name"))).alias("filers"),
            addresses.alias("addressentity"),
            proceedings.alias("proceedings"),
        )
    )


_LINES_SQL = "[" + ", ".join(quote(line) for line in LINES) + "]"
FILINGS = CV + f""", lined AS (
  SELECT d.doc_id, d.text,
    CASE WHEN d.doc_id % 11 = 0 THEN upper(list_extract({_LINES_SQL}, CAST(d.doc_id % {len(LINES)} + 1 AS INTEGER)))
         ELSE list_extract({_LINES_SQL}, CAST(d.doc_id % {len(LINES)} + 1 AS INTEGER)) END AS line
  FROM documents d),
filings AS (
  SELECT CAST(n.doc_id AS VARCHAR) AS id_submission, n.doc_id,
    CASE WHEN n.doc_id % 97 = 5 THEN NULL WHEN n.doc_id % 101 = 5 THEN ''
         WHEN n.doc_id % 4 = 3 THEN n.text || ' ' || n.line ELSE n.line || ' ' || n.text END AS text_data,
    CAST(cv.day_seen AS TIMESTAMP) AS date_received,
    CAST(cv.day_seen AS TIMESTAMP) + to_hours(CAST(n.doc_id % 24 AS INTEGER)) AS date_disseminated,
    cv.contact_email,
    CASE WHEN n.doc_id % 10 = 0 THEN 'OpenCSV 3' WHEN n.doc_id % 10 <> 1 THEN 'Mozilla/5.0' END AS browser,
    concat('Filer ', CAST(n.doc_id % 200 AS VARCHAR)) AS filer,
    CASE WHEN n.doc_id % 5 = 1 THEN CAST([] AS MAP(VARCHAR, VARCHAR)[])
         WHEN n.doc_id % 5 = 2 THEN [MAP {{'name': '17-108', 'id_proceeding': '1'}}]
         WHEN n.doc_id % 5 = 3 THEN [MAP {{'zeta': 'z', '_index': 'p1', 'name': '17-108'}}, MAP {{'name': 'n'}}]
         WHEN n.doc_id % 5 = 4 THEN [MAP {{'_index': ''}}] END AS proceedings,
    n.doc_id % 6 NOT IN (0, 1) AS has_address,
    CASE WHEN n.doc_id % 6 <> 3 THEN 'NV' END AS state,
    CASE WHEN n.doc_id % 6 = 2 THEN '' ELSE '89108' END AS zip_code,
    concat('City', CAST(n.doc_id % 10 AS VARCHAR)) AS city
  FROM lined n JOIN cv ON cv.doc_id = n.doc_id)"""


# --- rules as SQL -------------------------------------------------------------------------------
def rule_sql(rule: Rule, text: str = "text_data") -> str:
    groups = []
    for group in rule.groups:
        tests = []
        for p in group:
            if rule.mode == "contains":
                tests.append(f"contains(lower({text}), {quote(p.lower())})" if rule.ignore_case else f"contains({text}, {quote(p)})")
            elif rule.mode == "prefix":
                tests.append(f"starts_with({text}, {quote(p)})")
            else:
                side = f"coalesce(string_split({text}, '.')[-2], '')" if rule.target == "last_sentence" else text
                pattern = rf"^\s*(?:{p})" if rule.mode == "regex_anchored" else p
                if rule.target == "last_sentence":
                    tests.append(f"(len(string_split({text}, '.')) > 1 AND {regex_sql(side, [pattern], rule.ignore_case)})")
                else:
                    tests.append(regex_sql(side, [pattern], rule.ignore_case))
        groups.append("(" + " OR ".join(tests) + ")")
    return " AND ".join(groups)


def source_sql(rules: list[Rule], text: str = "text_data") -> str:
    whens = " ".join(f"WHEN {rule_sql(r, text)} THEN {quote(r.label)}" for r in rules)
    return f"CASE WHEN {text} IS NULL THEN 'empty' {whens} ELSE 'unknown' END"


def label_sql(column: str, labels: dict[str, bool]) -> str:
    yes = ", ".join(quote(k) for k, v in labels.items() if v)
    no = ", ".join(quote(k) for k, v in labels.items() if not v)
    return f"CASE WHEN {column} IN ({yes}) THEN true WHEN {column} IN ({no}) THEN false END"


# --- tokens as SQL ------------------------------------------------------------------------------
WORD_SQL = r"'[\p{L}\p{N}]+(?:[''’][\p{L}\p{N}]+)*'"
TOKENS_SQL = f"regexp_extract_all(lower(text), {WORD_SQL})"
_STOP_SQL = ", ".join(quote(w) for w in domain.STOP_WORDS)


def stem_sql(word: str) -> str:
    w = f"regexp_replace({word}, '[''’]s?$', '')"
    chop = lambda n: f"left({w}, length({w}) - {n})"
    return (
        f"CASE WHEN length({w}) < 4 THEN {w} "
        f"WHEN ends_with({w}, 'ies') THEN CASE WHEN ends_with({w}, 'eies') OR ends_with({w}, 'aies') THEN {w} ELSE {chop(3)} || 'y' END "
        f"WHEN ends_with({w}, 'es') THEN CASE WHEN ends_with({w}, 'aes') OR ends_with({w}, 'ees') OR ends_with({w}, 'oes') THEN {w} ELSE {chop(1)} END "
        f"WHEN ends_with({w}, 's') AND NOT ends_with({w}, 'us') AND NOT ends_with({w}, 'ss') THEN {chop(1)} ELSE {w} END"
    )


def english_sql(tokens: str) -> str:
    return f"list_transform(list_filter({tokens}, lambda w: w NOT IN ({_STOP_SQL})), lambda w: {stem_sql('w')})"


def english_words_sql(tokens: str) -> str:
    return f"list_transform(list_filter({tokens}, lambda w: w NOT IN ({_STOP_SQL})), lambda w: regexp_replace(w, '[''’]s?$', ''))"
