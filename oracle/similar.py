"""Copies, more-like-this matching, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentlens.functions.predicates import Reviewed
from commentlens.functions.text import untaggable
from commentlens.operators import clusters, similarity
from commentlens.rules.domain import NEIGHBOUR_STOP_WORDS

from . import views as v
from .rows import FINGERPRINT_SQL, WORD_LIST_SQL
from .textual import TOK

QUERIES: dict = {}

PARAMS = similarity.Params(min_df=5, max_df_share=0.2, min_terms=10)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return add


def _index(spark, sf, params=PARAMS):
    return similarity.build_index(v.table(spark, sf, "documents"), params, "doc_id", "text")


def _seeds(spark, sf):
    return v.table(spark, sf, "documents").filter(~similarity.too_short(F.col("text"))).select("doc_id")


def _targets(spark, sf):
    return v.table(spark, sf, "documents").filter(~untaggable(F.col("text"))).select("doc_id", "source")


SEEDS_SQL = "SELECT doc_id FROM documents WHERE len(string_split(text, ' ')) >= 50"
TARGETS_SQL = "SELECT doc_id, source FROM documents WHERE length(text) >= 13 AND len(string_split(text, ' ')) >= 3"

def terms_sql(params: similarity.Params) -> str:
    above = f" AND df <= n * {params.max_df_share}" if params.max_df_share is not None else ""
    return f"""WITH RECURSIVE {TOK}, occ AS (SELECT doc_id, unnest(words) AS term FROM tok),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY 1, 2),
  n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  elig AS (SELECT term, df FROM df CROSS JOIN n WHERE df >= {params.min_df}{above}),
  ranked AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY round(tf * (1 + ln(n / (df + 1))), 6) DESC, term) AS rank
    FROM tf JOIN elig USING (term) CROSS JOIN n),
  qt AS (SELECT doc_id, term, rank FROM ranked WHERE rank <= {params.max_terms})"""


TERMS_SQL = terms_sql(PARAMS)


def pairs_sql(seeds: str = SEEDS_SQL, targets: str = TARGETS_SQL, params: similarity.Params = PARAMS) -> str:
    return terms_sql(params) + f""",
  seeds AS ({seeds}), targets AS ({targets}),
  sq AS (SELECT q.doc_id AS seed, q.term, count(*) OVER (PARTITION BY q.doc_id) AS k FROM qt q JOIN seeds s ON s.doc_id = q.doc_id),
  post AS (SELECT t.doc_id, t.term FROM tf t JOIN elig e ON e.term = t.term JOIN targets g ON g.doc_id = t.doc_id),
  selfpairs AS (SELECT sq.seed, p.doc_id FROM sq JOIN post p ON p.term = sq.term WHERE sq.k >= {params.min_terms}
    GROUP BY sq.seed, p.doc_id, sq.k HAVING count(*) >= greatest(1, floor(sq.k * {params.match_share}))),
  pairs AS (SELECT seed, doc_id FROM selfpairs WHERE seed <> doc_id)"""


def components_sql(seeds: str = SEEDS_SQL, targets: str = TARGETS_SQL, params: similarity.Params = PARAMS) -> str:
    return pairs_sql(seeds, targets, params) + """,
  both_ways AS (SELECT seed AS a, doc_id AS b FROM selfpairs UNION SELECT doc_id, seed FROM selfpairs),
  reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON w.a = r.b),
  members AS (SELECT r.a AS doc_id, min(r.b) AS cluster FROM reach r JOIN targets g ON g.doc_id = r.b GROUP BY r.a),
  sizes AS (SELECT cluster, count(*) AS size FROM members GROUP BY cluster)"""


@query(
    "dup_groups",
    f"WITH {v.CV} SELECT any_value({FINGERPRINT_SQL}) AS fingerprint, min(doc_id) AS representative, count(*) AS copies FROM cv "
    f"GROUP BY CASE WHEN {FINGERPRINT_SQL} = '' THEN 'text ' || lower(trim(regexp_replace(text_data, '\\s+', ' ', 'g'))) ELSE {WORD_LIST_SQL} END HAVING count(*) > 1",
)
def dup_groups(spark, sf):
    return similarity.duplicate_groups(v.cv(spark, sf), F.col("text_data"), "doc_id")


@query("mlt_terms", TERMS_SQL + " SELECT doc_id, term, rank FROM qt")
def mlt_terms(spark, sf):
    index = _index(spark, sf)
    return index.members.join(similarity.query_table(index), "rep").select(
        "doc_id", "term", F.col("rank").cast("long").alias("rank")
    )


@query("mlt_pairs", pairs_sql() + " SELECT seed, doc_id FROM pairs")
def mlt_pairs(spark, sf):
    return similarity.similar_pairs(_index(spark, sf), _seeds(spark, sf), _targets(spark, sf))


# The same with the defaults, whose query words may be in any number of texts.
DEFAULTS = similarity.Params()


@query("mlt_terms_default", terms_sql(DEFAULTS) + " SELECT doc_id, term, rank FROM qt")
def mlt_terms_default(spark, sf):
    index = _index(spark, sf, DEFAULTS)
    return index.members.join(similarity.query_table(index), "rep").select("doc_id", "term", F.col("rank").cast("long").alias("rank"))


@query(
    "mlt_match_counts_default",
    pairs_sql(params=DEFAULTS) + " SELECT p.seed, t.source, count(*) AS n FROM pairs p JOIN targets t ON t.doc_id = p.doc_id GROUP BY 1, 2",
)
def mlt_match_counts_default(spark, sf):
    return similarity.match_totals(_index(spark, sf, DEFAULTS), _seeds(spark, sf), _targets(spark, sf), "source")


@query("clusters_default", components_sql(params=DEFAULTS) + " SELECT doc_id, cluster FROM members")
def clusters_default(spark, sf):
    return clusters.cluster_members(_index(spark, sf, DEFAULTS), _seeds(spark, sf), _targets(spark, sf))


@query(
    "mlt_match_counts",
    pairs_sql() + " SELECT p.seed, t.source, count(*) AS n FROM pairs p JOIN targets t ON t.doc_id = p.doc_id GROUP BY 1, 2",
)
def mlt_match_counts(spark, sf):
    return similarity.match_totals(_index(spark, sf), _seeds(spark, sf), _targets(spark, sf), "source")


@query(
    "mlt_source_vote",
    pairs_sql() + ", c AS (SELECT p.seed, t.source, count(*) AS n FROM pairs p JOIN targets t ON t.doc_id = p.doc_id GROUP BY 1, 2) "
    "SELECT seed, source, n FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY n DESC, source) AS r FROM c) WHERE r = 1",
)
def mlt_source_vote(spark, sf):
    return similarity.largest_bucket(mlt_match_counts(spark, sf), "source")


def _members(spark, sf):
    return clusters.cluster_members(_index(spark, sf), _seeds(spark, sf), _targets(spark, sf))


@query("clusters", components_sql() + " SELECT doc_id, cluster FROM members")
def cluster_ids(spark, sf):
    return _members(spark, sf)


@query("cluster_sizes", components_sql() + " SELECT cluster, size FROM sizes")
def cluster_sizes(spark, sf):
    return clusters.cluster_sizes(_members(spark, sf))


@query("star_clusters", pairs_sql() + " SELECT doc_id, min(seed) AS cluster FROM pairs GROUP BY doc_id")
def star_clusters(spark, sf):
    return clusters.star_members(_index(spark, sf), _seeds(spark, sf), _targets(spark, sf))


_EXISTING_SQL = "existing AS (SELECT doc_id, cluster AS src_doc_id FROM tagged WHERE cluster IS NOT NULL)"
_PLACED_SQL = """cnt AS (SELECT m.cluster, e.src_doc_id, count(*) AS n FROM members m JOIN existing e ON e.doc_id = m.doc_id GROUP BY 1, 2),
  topc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, src_doc_id) AS r FROM cnt) WHERE r = 1),
  placed AS (SELECT s.cluster, s.size, CASE WHEN t.n >= least(2, s.size) THEN t.src_doc_id ELSE CAST(s.cluster AS VARCHAR) END AS target
    FROM sizes s LEFT JOIN topc t ON t.cluster = s.cluster)"""


@query(
    "cluster_join_existing",
    components_sql() + f", {v.TAGGED}, {_EXISTING_SQL}, {_PLACED_SQL} SELECT cluster, size, target FROM placed",
)
def cluster_join_existing(spark, sf):
    existing = v.tagged(spark, sf).filter("cluster is not null").select("doc_id", F.col("cluster").alias("src_doc_id"))
    return clusters.join_existing(_members(spark, sf), existing, min_cluster=2)


_OPEN_SQL = "source = 'unknown' AND cluster IS NULL AND titleii IS NULL"
_PATCH_SEEDS = f"SELECT doc_id FROM tagged WHERE {_OPEN_SQL} AND {v.WORDS_SQL} >= 50"
_PATCH_TARGETS = "SELECT doc_id, source FROM tagged WHERE NOT untaggable"


@query(
    "cluster_patch",
    components_sql(_PATCH_SEEDS, _PATCH_TARGETS).replace("WITH RECURSIVE ", f"WITH RECURSIVE {v.TAGGED}, ", 1)
    + f""", {_EXISTING_SQL}, {_PLACED_SQL},
  srcs AS (SELECT m.cluster, t.source, count(*) AS n FROM members m JOIN tagged t ON t.doc_id = m.doc_id GROUP BY 1, 2),
  tops AS (SELECT cluster, source FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, source) AS r FROM srcs) WHERE r = 1 AND source <> 'unknown')
  SELECT m.doc_id, p.target AS src_doc_id, CAST(m.doc_id AS VARCHAR) = p.target AS is_source, p.size - 1 AS matches, false AS too_short, s.source
  FROM members m JOIN placed p ON p.cluster = m.cluster LEFT JOIN tops s ON s.cluster = m.cluster
  LEFT JOIN existing e ON e.doc_id = m.doc_id WHERE e.src_doc_id IS DISTINCT FROM p.target
  UNION ALL SELECT doc_id, NULL, false, NULL, true, NULL FROM tagged WHERE {_OPEN_SQL} AND {v.WORDS_SQL} < 50
    AND doc_id NOT IN (SELECT doc_id FROM members)""",
)
def cluster_patch(spark, sf):
    patch = clusters.cluster_patch(v.tagged(spark, sf), _index(spark, sf), v.tags(), "doc_id", min_cluster=2)
    return patch.select("doc_id", "more_like_this.*")


@query(
    "unreviewed_clusters",
    components_sql() + ", open AS (SELECT cluster, size FROM sizes WHERE cluster NOT IN (0, 1) ORDER BY size DESC, cluster LIMIT 10) "
    "SELECT o.cluster, o.size, d.text FROM open o JOIN documents d ON d.doc_id = o.cluster",
)
def unreviewed(spark, sf):
    labelled = v.table(spark, sf, "documents").select("doc_id", "text").join(_members(spark, sf), "doc_id", "left")
    reviewed = Reviewed(positive_clusters=("0",), negative_clusters=("1",))
    return clusters.unreviewed_clusters(labelled, reviewed, "cluster", 10, "doc_id", "text")


_STOP = ", ".join(v.quote(w) for w in NEIGHBOUR_STOP_WORDS)


def _vote_sql(position: str) -> str:
    return f"""WITH {v.TAGGED}, tok AS (SELECT doc_id, {position} AS titleii, regexp_extract_all(lower(text_data), {v.WORD_SQL}) AS words FROM tagged),
  b AS (SELECT doc_id, titleii, list_filter({v.english_sql('words')}, lambda w: length(w) >= 3 AND w NOT IN ({_STOP})) AS words FROM tok),
  n AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(words)) AS mean_len FROM b),
  chosen AS (SELECT doc_id, words FROM b WHERE titleii IS NULL ORDER BY md5(concat(CAST(doc_id AS VARCHAR), '7')), doc_id LIMIT 10),
  occ AS (SELECT doc_id, titleii, len(words) AS len, unnest(words) AS term FROM b),
  tf AS (SELECT doc_id, titleii, len, term, count(*) AS tf FROM occ GROUP BY 1, 2, 3, 4),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 5),
  ranked AS (SELECT tf.doc_id AS seed_id, tf.term, df.df, row_number() OVER (PARTITION BY tf.doc_id ORDER BY round(tf.tf * (1 + ln(n / (df.df + 1))), 6) DESC, tf.term) AS r
    FROM tf JOIN df ON df.term = tf.term CROSS JOIN n WHERE tf.doc_id IN (SELECT doc_id FROM chosen)),
  q AS (SELECT seed_id, term, df, greatest(1, floor(0.5 * count(*) OVER (PARTITION BY seed_id))) AS need FROM ranked WHERE r <= 25),
  s AS (SELECT q.seed_id, tf.doc_id, tf.titleii, round(sum(ln(1 + (n - q.df + 0.5) / (q.df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * tf.len / mean_len))), 6) AS score
    FROM q JOIN tf ON tf.term = q.term CROSS JOIN n WHERE tf.titleii IS NOT NULL GROUP BY q.seed_id, tf.doc_id, tf.titleii, q.need HAVING count(*) >= q.need),
  k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, doc_id) AS r FROM s) WHERE r <= 10)
  SELECT c.doc_id AS seed_id, CAST(coalesce(sum(CASE WHEN k.titleii THEN 1 WHEN NOT k.titleii THEN -1 END), 0) AS BIGINT) AS votes, count(k.doc_id) AS neighbours
  FROM chosen c LEFT JOIN k ON k.seed_id = c.doc_id GROUP BY c.doc_id"""


@query("neighbour_vote", _vote_sql("titleii"))
def neighbour_vote(spark, sf):
    return similarity.neighbour_vote(v.tagged(spark, sf), "titleii", "7", min_df=5, match_share=0.5, doc_id="doc_id")


@query(
    "neighbour_vote_manual",
    _vote_sql("CASE WHEN coalesce(titleii, sentiment_manual) IS NOT NULL THEN coalesce(titleii, false) OR coalesce(sentiment_manual, false) END"),
)
def neighbour_vote_manual(spark, sf):
    """A position that a person gave counts like one found by pattern."""
    return similarity.neighbour_vote(
        v.tagged(spark, sf), "titleii", "7", min_df=5, match_share=0.5, doc_id="doc_id", manual="sentiment_manual"
    )
