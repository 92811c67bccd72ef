"""Tokens, phrases, ranking and significant terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.functions.text import query_terms
from commentlens.operators import phrases, postings, ranking, sigterms, stemming
from commentlens.spark_env import scratch_path

from . import views as v

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return add


def docs(spark, sf):
    return v.table(spark, sf, "documents")


TOK = f"tok AS (SELECT doc_id, lang, source, {v.TOKENS_SQL} AS words FROM documents)"
POST = TOK + ", post AS (SELECT doc_id, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos FROM tok)"


@query("token_counts", f"WITH {POST} SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS docs FROM post GROUP BY term")
def token_counts(spark, sf):
    return postings.term_counts(docs(spark, sf), "text")


@query(
    "english_counts",
    f"WITH {TOK}, e AS (SELECT doc_id, unnest({v.english_sql('words')}) AS term FROM tok) "
    "SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS docs FROM e GROUP BY term",
)
def english_counts(spark, sf):
    return postings.term_counts(docs(spark, sf), "text", english=True)


def _porter_sql() -> str:
    """Stems of ``voc(term)``, step by step. An initial y is written Y: it is never a vowel."""
    c, vowel = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    matches = lambda w, pattern: f"regexp_matches({w}, '{pattern}')"
    some = lambda w: matches(w, f"^({c})?{vowel}{c}")
    more = lambda w: matches(w, f"^({c})?{vowel}{c}{vowel}{c}")
    one = lambda w: matches(w, f"^({c})?{vowel}{c}({vowel})?$")
    spoken = lambda w: matches(w, "[aeiouy]")
    short = lambda w: matches(w, f"^{c}[aeiouy][^aeiouwxy]$")
    cut = lambda w, n: f"left({w}, length({w}) - {n})"

    def longest(rules: dict, test, w: str = "w", extra=lambda ending, stem: "true") -> str:
        cases = []
        for ending in sorted(rules, key=len, reverse=True):
            stem = cut(w, len(ending))
            cases.append(f"WHEN ends_with({w}, '{ending}') THEN CASE WHEN {test(stem)} AND {extra(ending, stem)} THEN {stem} || '{rules[ending]}' ELSE {w} END")
        return f"CASE {' '.join(cases)} ELSE {w} END"

    tail = f"""CASE WHEN ends_with(s, 'at') OR ends_with(s, 'bl') OR ends_with(s, 'iz') THEN s || 'e'
      WHEN length(s) > 1 AND s[-1] = s[-2] AND {matches('s', '[^aeiouy]$|([aeiou]y|[^aeiouy])(yy)+$')} THEN CASE WHEN s[-1] IN ('l', 's', 'z') THEN s ELSE {cut('s', 1)} END
      WHEN {one('s')} AND {short('s')} THEN s || 'e' ELSE s END"""
    ion = lambda ending, stem: matches(stem, "[st]$") if ending == "ion" else "true"
    step_4 = longest(dict.fromkeys(stemming.STEP_4, ""), more, extra=ion)
    return f"""p0 AS (SELECT term, CASE WHEN starts_with(term, 'y') THEN 'Y' || substr(term, 2) ELSE term END AS w FROM voc WHERE length(term) > 2),
      p1 AS (SELECT term, CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {cut('w', 2)} WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {cut('w', 1)} ELSE w END AS w FROM p0),
      p2 AS (SELECT term, w, CASE WHEN ends_with(w, 'eed') THEN NULL WHEN ends_with(w, 'ed') AND {spoken(cut('w', 2))} THEN {cut('w', 2)}
        WHEN ends_with(w, 'ing') AND {spoken(cut('w', 3))} THEN {cut('w', 3)} END AS s FROM p1),
      p3 AS (SELECT term, CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {some(cut('w', 3))} THEN {cut('w', 1)} ELSE w END WHEN s IS NULL THEN w ELSE {tail} END AS w FROM p2),
      p4 AS (SELECT term, CASE WHEN ends_with(w, 'y') AND {spoken(cut('w', 1))} THEN {cut('w', 1)} || 'i' ELSE w END AS w FROM p3),
      p5 AS (SELECT term, {longest(stemming.STEP_2, some)} AS w FROM p4),
      p6 AS (SELECT term, {longest(stemming.STEP_3, some)} AS w FROM p5),
      p7 AS (SELECT term, {step_4} AS w FROM p6),
      p8 AS (SELECT term, CASE WHEN ends_with(w, 'e') AND ({more(cut('w', 1))} OR ({one(cut('w', 1))} AND NOT {short(cut('w', 1))})) THEN {cut('w', 1)} ELSE w END AS w FROM p7),
      p9 AS (SELECT term, CASE WHEN ends_with(w, 'll') AND {more('w')} THEN {cut('w', 1)} ELSE w END AS w FROM p8),
      stems AS (SELECT term, replace(w, 'Y', 'y') AS stem FROM p9 UNION ALL SELECT term, term FROM voc WHERE length(term) <= 2)"""


@query(
    "english_porter",
    f"WITH {TOK}, e AS (SELECT doc_id, unnest({v.english_words_sql('words')}) AS term FROM tok), voc AS (SELECT DISTINCT term FROM e), {_porter_sql()} "
    "SELECT s.stem, count(*) AS occurrences, count(DISTINCT e.doc_id) AS docs FROM e JOIN stems s ON s.term = e.term GROUP BY s.stem",
)
def english_porter(spark, sf):
    return stemming.porter_counts(docs(spark, sf), "doc_id", "text")


@query(
    "postings_summary",
    f"WITH {TOK}, s AS (SELECT doc_id, 'standard' AS field, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos FROM tok), "
    f"en AS (SELECT doc_id, {v.english_sql('words')} AS words FROM tok), "
    "e AS (SELECT doc_id, 'english' AS field, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos FROM en), "
    "a AS (SELECT * FROM s UNION ALL SELECT * FROM e) "
    "SELECT doc_id, field, count(*) AS words, count(DISTINCT term) AS terms, CAST(max(pos) AS INTEGER) AS last_pos, "
    "CAST(sum(pos * length(term)) AS BIGINT) AS weighted FROM a GROUP BY doc_id, field",
)
def postings_summary(spark, sf):
    """The texts are shuffled once by document, so that none of their words is. Parts are small, as a
    task holds the words of its documents apart."""
    parts = 16 * spark.read.parquet(f"{sf}/documents.parquet").rdd.getNumPartitions()
    return postings.postings(docs(spark, sf).repartition(parts, "doc_id"), "doc_id", "text").groupBy("doc_id", "field").agg(
        F.count(F.lit(1)).alias("words"),
        F.countDistinct("term").alias("terms"),
        F.max("pos").alias("last_pos"),
        F.sum(F.col("pos") * F.length("term")).cast("long").alias("weighted"),
    )


# --- phrases ------------------------------------------------------------------------------------
EXACT = ["tion of the", "on the", "of the and", "it is"]
SLOPPY = ["the is of", "to be the", "the to the", "de la et", "worthless thing", "und der die", "the that the the"]


def _phrase_sql(texts: list[str], slop: int, words: str = "") -> str:
    """Range self-join form. Repeated words need as many different positions as every run of them."""
    rows = []
    for p in texts:
        for off, term in enumerate(query_terms(p)):
            rows.append(f"({v.quote(p)}, {off}, {v.quote(term)})")
    ph = "ph(phrase, off, term) AS (VALUES " + ", ".join(rows) + ")"
    runs = []
    for p in texts:
        terms = query_terms(p)
        for term in dict.fromkeys(terms):
            spots = [i for i, t in enumerate(terms) if t == term]
            for i in range(len(spots)):
                for j in range(i + 1, len(spots)):
                    runs.append(f"({v.quote(p)}, {v.quote(term)}, {spots[i]}, {spots[j]}, {j - i + 1})")
    runs = runs or ["('', '', 0, 0, 0)"]
    return f"""WITH {words or POST}, {ph}, runs(phrase, term, lo, hi, need) AS (VALUES {', '.join(runs)}),
      hit AS (SELECT p.doc_id, ph.phrase, ph.off, p.pos, p.pos - ph.off AS adj FROM post p JOIN ph ON p.term = ph.term),
      size AS (SELECT phrase, count(*) AS n FROM ph GROUP BY phrase),
      frames AS (SELECT a.doc_id, a.phrase, a.adj FROM (SELECT DISTINCT doc_id, phrase, adj FROM hit) a
        JOIN hit h ON h.doc_id = a.doc_id AND h.phrase = a.phrase AND h.adj BETWEEN a.adj AND a.adj + {slop}
        JOIN size s ON s.phrase = a.phrase GROUP BY a.doc_id, a.phrase, a.adj, s.n HAVING count(DISTINCT h.off) = s.n),
      bad AS (SELECT f.doc_id, f.phrase, f.adj FROM frames f JOIN runs r ON r.phrase = f.phrase
        LEFT JOIN post p ON p.doc_id = f.doc_id AND p.term = r.term AND p.pos BETWEEN f.adj + r.lo AND f.adj + r.hi + {slop}
        GROUP BY f.doc_id, f.phrase, f.adj, r.lo, r.hi, r.need HAVING count(DISTINCT p.pos) < r.need),
      matched AS (SELECT DISTINCT f.doc_id, f.phrase FROM frames f
        WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.doc_id = f.doc_id AND b.phrase = f.phrase AND b.adj = f.adj))"""


def phrases_sql(sides: dict[str, list[str]], slop: int, table: str, text: str, before: str) -> str:
    """``matched(doc_id, phrase, side)`` for the phrases of several sides, over any table of texts."""
    words = f"""{before}, tok AS (SELECT doc_id, regexp_extract_all(lower({text}), {v.WORD_SQL}) AS words FROM {table}),
      post AS (SELECT doc_id, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos FROM tok)"""
    of = ", ".join(f"({v.quote(p)}, {v.quote(side)})" for side, texts in sides.items() for p in texts)
    found = _phrase_sql(list(dict.fromkeys(p for texts in sides.values() for p in texts)), slop, words).replace("matched AS (", "any_side AS (")
    return f"{found}, sides(phrase, side) AS (VALUES {of}), matched AS (SELECT a.doc_id, a.phrase, s.side FROM any_side a JOIN sides s ON s.phrase = a.phrase)"


@query("phrase_exact", _phrase_sql(EXACT, 0) + " SELECT doc_id, phrase FROM matched")
def phrase_exact(spark, sf):
    return phrases.match_phrases(docs(spark, sf), EXACT, 0, "doc_id", "text")


@query("phrase_slop3", _phrase_sql(SLOPPY, 3) + " SELECT doc_id, phrase FROM matched")
def phrase_slop3(spark, sf):
    return phrases.match_phrases(docs(spark, sf), SLOPPY, 3, "doc_id", "text")


def _stored_words(spark, sf):
    path = scratch_path(spark, "words")
    postings.write_postings(docs(spark, sf), path, "doc_id", "text")
    return path


@query("phrase_postings_exact", _phrase_sql(EXACT, 0) + " SELECT doc_id, phrase FROM matched")
def phrase_postings_exact(spark, sf):
    return postings.find_phrases(spark, _stored_words(spark, sf), EXACT, 0)


@query("phrase_postings_slop3", _phrase_sql(SLOPPY, 3) + " SELECT doc_id, phrase FROM matched")
def phrase_postings_slop3(spark, sf):
    return postings.find_phrases(spark, _stored_words(spark, sf), SLOPPY, 3)


@query(
    "phrase_tag",
    _phrase_sql(SLOPPY, 3)
    + f", {v.TAGGED} SELECT t.doc_id, 'es_terms_positive' AS source FROM tagged t WHERE {v.UNTAGGED_SQL} AND t.doc_id IN (SELECT doc_id FROM matched)",
)
def phrase_tag(spark, sf):
    from commentlens.functions import predicates

    open_rows = v.tagged(spark, sf).filter(predicates.untagged(v.tags(), v.REVIEWED))
    return phrases.phrase_tag(open_rows, SLOPPY, "es_terms_positive", 3, "doc_id")


@query(
    "stance_by_phrase",
    _phrase_sql(EXACT[1:2], 0)
    + f", {v.TAGGED} SELECT t.doc_id, false AS titleii FROM tagged t WHERE t.titleii IS NULL AND t.doc_id IN (SELECT doc_id FROM matched)",
)
def stance_by_phrase(spark, sf):
    return phrases.stance_by_phrase(v.tagged(spark, sf), EXACT[1], False, F.col("titleii"), "doc_id")


# --- ranking ------------------------------------------------------------------------------------
CLAUSES = ["thing thinor the eration ngs tions ernts", "erin anea the"]
PHRASE = "on the"


def _bm25_sql(clauses: list[str], phrase: str | None, where: str = "true") -> str:
    parts = [f"WITH {TOK}", f"fld AS (SELECT doc_id, 'standard' AS field, words FROM tok UNION ALL SELECT doc_id, 'english', {v.english_sql('words')} FROM tok)",
             "lens AS (SELECT doc_id, field, len(words) AS len FROM fld)",
             "stats AS (SELECT field, CAST(count(*) AS DOUBLE) AS n, avg(len) AS mean FROM lens GROUP BY field)",
             "occ AS (SELECT doc_id, field, unnest(words) AS term FROM fld)"]
    q = []
    for english in (False, True):
        for clause in clauses:
            q += [f"({v.quote('english' if english else 'standard')}, {v.quote(t)})" for t in query_terms(clause, english)]
    parts += ["q0(field, term) AS (VALUES " + ", ".join(q) + ")",
              "q AS (SELECT field, term, count(*) AS w FROM q0 GROUP BY field, term)",
              "tf AS (SELECT o.doc_id, o.field, o.term, count(*) AS tf FROM occ o JOIN q ON q.field = o.field AND q.term = o.term GROUP BY 1, 2, 3)",
              "df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY field, term)",
              "part AS (SELECT tf.doc_id, q.w * ln(1 + (s.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * l.len / s.mean)) AS score "
              "FROM tf JOIN q ON q.field = tf.field AND q.term = tf.term JOIN df ON df.field = tf.field AND df.term = tf.term "
              "JOIN lens l ON l.doc_id = tf.doc_id AND l.field = tf.field JOIN stats s ON s.field = tf.field)"]
    if phrase:
        terms = query_terms(phrase)
        cond = " AND ".join(f"words[i + {k}] = {v.quote(t)}" for k, t in enumerate(terms))
        dfs = ", ".join(f"count(*) FILTER (WHERE list_contains(words, {v.quote(t)})) AS d{k}" for k, t in enumerate(terms))
        idf = " + ".join(f"ln(1 + (s.n - pd.d{k} + 0.5) / (pd.d{k} + 0.5))" for k in range(len(terms)))
        parts += [f"pf AS (SELECT doc_id, len(list_filter(range(1, len(words) + 1), lambda i: {cond})) AS tf FROM tok)",
                  f"pd AS (SELECT {dfs} FROM tok)",
                  f"phr AS (SELECT pf.doc_id, ({idf}) * pf.tf * 2.2 / (pf.tf + 1.2 * (0.25 + 0.75 * l.len / s.mean)) AS score "
                  "FROM pf JOIN lens l ON l.doc_id = pf.doc_id AND l.field = 'standard' JOIN stats s ON s.field = 'standard' CROSS JOIN pd WHERE pf.tf > 0)"]
    allparts = "SELECT * FROM part" + (" UNION ALL SELECT * FROM phr" if phrase else "")
    parts.append(f"scores AS (SELECT doc_id, round(sum(score), 6) AS score FROM ({allparts}) WHERE {where} GROUP BY doc_id)")
    return ", ".join(parts)


def _scores(spark, sf, keep=(), only=None):
    corpus = v.tagged(spark, sf)
    rows = corpus if only is None else corpus.filter(only)
    return ranking.bm25_scores(rows, CLAUSES, PHRASE, corpus, doc_id="doc_id", keep=keep)


@query("bm25_topk", _bm25_sql(CLAUSES, PHRASE) + " SELECT doc_id, score FROM scores ORDER BY score DESC, doc_id LIMIT 50")
def bm25_topk(spark, sf):
    return ranking.top_k(_scores(spark, sf), 50, doc_id="doc_id")


@query("bm25_bottomk", _bm25_sql(CLAUSES, PHRASE) + " SELECT doc_id, score FROM scores ORDER BY score, doc_id LIMIT 50")
def bm25_bottomk(spark, sf):
    return ranking.top_k(_scores(spark, sf), 50, worst=True, doc_id="doc_id")


@query("bm25_scores", _bm25_sql(CLAUSES, None) + " SELECT doc_id, score FROM scores")
def bm25_all(spark, sf):
    return ranking.bm25_scores(docs(spark, sf), CLAUSES, doc_id="doc_id", text="text")


@query(
    "relevance_tag",
    _bm25_sql(CLAUSES, PHRASE) + f", {v.TAGGED}, open AS (SELECT s.doc_id, s.score FROM scores s JOIN tagged t ON t.doc_id = s.doc_id WHERE {v.UNTAGGED_SQL}) "
    "SELECT doc_id, true AS sentiment_sig_terms_ordered FROM (SELECT doc_id FROM open ORDER BY score DESC, doc_id LIMIT 40)",
)
def relevance_tag(spark, sf):
    from commentlens.functions import predicates

    return ranking.relevance_tag(_scores(spark, sf, only=predicates.untagged(v.tags(), v.REVIEWED)), 40, "doc_id")


_RANKED = (
    f", {v.TAGGED}, r AS (SELECT s.doc_id, s.score, t.titleii FROM scores s JOIN tagged t ON t.doc_id = s.doc_id WHERE t.titleii IS NOT NULL "
    "ORDER BY s.score DESC, s.doc_id LIMIT 200), "
    "w AS (SELECT doc_id, score, titleii, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r)"
)


@query(
    "ranking_precision",
    _bm25_sql(CLAUSES, PHRASE) + _RANKED + ", c AS (SELECT rank, CAST(sum(CASE WHEN titleii THEN 1 ELSE 0 END) OVER (ORDER BY rank) AS BIGINT) AS positives, count(*) OVER () AS n FROM w) "
    "SELECT rank, positives, round(positives / rank, 6) AS precision FROM c WHERE rank % 25 = 0 OR rank = n",
)
def ranking_precision(spark, sf):
    scores = _scores(spark, sf, ["titleii"], F.col("titleii").isNotNull())
    return ranking.ranking_precision(scores, 200, "titleii", 25, doc_id="doc_id")


@query("ranking_misses", _bm25_sql(CLAUSES, PHRASE) + _RANKED + " SELECT doc_id, score, titleii FROM w WHERE NOT titleii")
def ranking_misses(spark, sf):
    scores = _scores(spark, sf, ["titleii"], F.col("titleii").isNotNull())
    return ranking.ranking_misses(scores, 200, "titleii", doc_id="doc_id")


@query("review_sample", _bm25_sql(CLAUSES, PHRASE) + _RANKED + " SELECT doc_id, score, titleii, rank FROM w WHERE rank % 10 = 0")
def review_sample(spark, sf):
    scores = _scores(spark, sf, ["titleii"], F.col("titleii").isNotNull())
    return ranking.review_sample(scores, 200, 10, "doc_id")


# --- significant terms --------------------------------------------------------------------------
def _mi_sql(fg: str, bg: str) -> str:
    cell = lambda a, b, c: f"CASE WHEN {a} > 0 THEN {a} / n * ln(n * {a} / ({b} * {c})) ELSE 0.0 END"
    return f"""SELECT term, n11, n10, round({cell('a', '(a + b)', 'g1')} + {cell('b', '(a + b)', 'g0')} + {cell('(g1 - a)', '(n - a - b)', 'g1')}
        + {cell('(g0 - b)', '(n - a - b)', 'g0')}, 9) AS mi FROM (
      SELECT term, n11, n10, CAST(n11 AS DOUBLE) AS a, CAST(n10 AS DOUBLE) AS b, CAST(n1 AS DOUBLE) AS g1, CAST(n0 AS DOUBLE) AS g0, CAST(n1 + n0 AS DOUBLE) AS n
      FROM (SELECT term, count(*) FILTER (WHERE fg) AS n11, count(*) FILTER (WHERE NOT fg) AS n10 FROM
        (SELECT DISTINCT g.doc_id, g.fg, unnest(g.words) AS term FROM (SELECT doc_id, words, {fg} AS fg FROM tokt WHERE ({fg}) OR ({bg})) g) GROUP BY term)
      CROSS JOIN (SELECT count(*) FILTER (WHERE {fg}) AS n1, count(*) FILTER (WHERE NOT ({fg}) AND ({bg})) AS n0 FROM tokt)
      WHERE n11 >= 3 AND n11 * n0 > n10 * n1)
      ORDER BY mi DESC, term LIMIT 10"""


TOKT = f"{v.TAGGED}, tokt AS (SELECT t.doc_id, t.lang, t.titleii, k.words FROM tagged t JOIN tok k ON k.doc_id = t.doc_id)"
POS, NEG, NONE = "coalesce(titleii, false)", "coalesce(NOT titleii, false)", "titleii IS NULL"


def _sig(spark, sf, fg, bg=None):
    return sigterms.significant_terms(v.tagged(spark, sf), fg, bg)


@query("sig_terms_disjoint", f"WITH {TOK}, {TOKT} {_mi_sql(POS, NEG)}")
def sig_terms_disjoint(spark, sf):
    return _sig(spark, sf, F.col("titleii"), ~F.col("titleii"))


@query("sig_terms_negative", f"WITH {TOK}, {TOKT} {_mi_sql(NEG, POS)}")
def sig_terms_negative(spark, sf):
    return _sig(spark, sf, ~F.col("titleii"), F.col("titleii"))


@query("sig_terms_untagged", f"WITH {TOK}, {TOKT} {_mi_sql(POS, NONE)}")
def sig_terms_untagged(spark, sf):
    return _sig(spark, sf, F.col("titleii"), F.col("titleii").isNull())


@query("sig_terms_superset", f"WITH {TOK}, {TOKT} {_mi_sql(POS, 'true')}")
def sig_terms_superset(spark, sf):
    return _sig(spark, sf, F.col("titleii"))


@query("sig_terms_lang", f"WITH {TOK}, {TOKT} " + _mi_sql("lang = 'en'", "lang = 'de'"))
def sig_terms_lang(spark, sf):
    return _sig(spark, sf, F.col("lang") == "en", F.col("lang") == "de")


@query(
    "term_consensus",
    f"WITH {TOK}, {TOKT}, a AS ({_mi_sql(POS, NEG)}), b AS ({_mi_sql(POS, NONE)}), c AS ({_mi_sql(POS, 'true')}) "
    "SELECT term, count(*) AS lists FROM (SELECT term FROM a UNION ALL SELECT term FROM b UNION ALL SELECT term FROM c) GROUP BY term HAVING count(*) >= 2",
)
def term_consensus(spark, sf):
    return sigterms.term_consensus(
        [sig_terms_disjoint(spark, sf), sig_terms_untagged(spark, sf), sig_terms_superset(spark, sf)]
    )
