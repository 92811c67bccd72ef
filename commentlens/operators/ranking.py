"""Relevance ranking (BM25), top-k reports and ranking evaluation.

Scores need only corpus totals (document count, mean length, document frequency of the query's
words). Those come from one global aggregate of a few numbers; the scoring pass then works row by
row, so neither pass shuffles text or tokens.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import query_terms, stem_words, surface_forms, tokens, without_stop_words
from .phrases import phrase_frequency

K1 = 1.2
B = 0.75


def _weights(clauses: Sequence[str], english: bool) -> dict[str, int]:
    """How many clauses ask for each word; clause scores add up."""
    return dict(Counter(t for clause in clauses for t in query_terms(clause, english)))


def _tf(words: Column, terms: Sequence[str]) -> Column:
    """Counts of each query word, in query order. The document is walked once."""
    wanted = F.array(*map(F.lit, terms))
    return let(
        F.filter(words, lambda w: w.isin(list(terms))),
        lambda hits: F.transform(wanted, lambda t: F.size(F.filter(hits, lambda w: w == t))),
    )


def idf(n: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))


def saturation(tf: Column, length: Column, mean_length: Column) -> Column:
    return tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / mean_length))


def bm25_scores(
    docs: DataFrame,
    clauses: Sequence[str],
    phrase: str | None = None,
    corpus: DataFrame | None = None,
    fields: Sequence[str] = ("standard", "english"),
    doc_id: str = "id_submission",
    text: str = "text_data",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score of each document that matches at least one clause.

    Clause scores and field scores are summed; ``phrase`` adds an exact-phrase clause on the
    standard field. ``docs`` is what gets ranked; ``corpus`` (default ``docs``) is what the
    document frequencies are taken from.
    """
    corpus = docs if corpus is None else corpus
    phrase_terms = list(dict.fromkeys(query_terms(phrase))) if phrase else []

    def measured(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        wide = df.filter(F.col(text).isNotNull()).select(*columns, tokens(F.col(text)).alias("_standard"))
        words = F.col("_standard")
        out = []
        for field in fields:
            terms = list(_weights(clauses, field == "english"))
            if field == "english":
                # Only words that can become a query word are stemmed; the length needs no stems.
                forms = [form for t in terms for form in surface_forms(t)]
                length = F.size(without_stop_words(words))
                counts = _tf(stem_words(F.filter(words, lambda w: w.isin(forms))), terms)
            else:
                length, counts = F.size(words), _tf(words, terms)
            out += [length.alias(f"_len_{field}"), counts.alias(f"_tf_{field}")]
        if phrase:
            out.append(phrase_frequency(F.col("_standard"), phrase).alias("_tf_phrase"))
            out += [F.array_contains("_standard", t).alias(f"_has_phrase_{i}") for i, t in enumerate(phrase_terms)]
        return wide.select(*columns, *out)

    totals = [F.count(F.lit(1)).cast("double").alias("_n")]
    for field in fields:
        terms = list(_weights(clauses, field == "english"))
        totals.append(F.avg(f"_len_{field}").alias(f"_mean_{field}"))
        totals += [
            F.sum((F.col(f"_tf_{field}")[i] > 0).cast("long")).alias(f"_df_{field}_{i}")
            for i in range(len(terms))
        ]
    totals += [
        F.sum(F.col(f"_has_phrase_{i}").cast("long")).alias(f"_df_phrase_{i}")
        for i in range(len(phrase_terms))
    ]
    stats = measured(corpus, []).agg(*totals)
    # An ungrouped aggregate has exactly one row, whatever the data size.
    scored = measured(docs, [doc_id, *keep]).crossJoin(F.broadcast(stats))

    n = F.col("_n")
    parts: list[Column] = []
    for field in fields:
        for i, (_, weight) in enumerate(_weights(clauses, field == "english").items()):
            tf = F.col(f"_tf_{field}")[i]
            part = idf(n, F.col(f"_df_{field}_{i}")) * saturation(
                tf, F.col(f"_len_{field}"), F.col(f"_mean_{field}")
            )
            parts.append(F.when(tf > 0, F.lit(float(weight)) * part).otherwise(F.lit(0.0)))
    if phrase_terms:
        tf = F.col("_tf_phrase")
        weight_sum = sum((idf(n, F.col(f"_df_phrase_{i}")) for i in range(len(phrase_terms))), F.lit(0.0))
        part = weight_sum * saturation(tf, F.col("_len_standard"), F.col("_mean_standard"))
        parts.append(F.when(tf > 0, part).otherwise(F.lit(0.0)))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    # Every matching clause adds a positive score. The test is on the score and not on the counts,
    # as the optimizer would push a test of the counts below the tokenizer and repeat it per word.
    return scored.filter(total > 0).select(doc_id, *keep, F.round(total, 6).alias("score"))


def top_k(
    scores: DataFrame, k: int, worst: bool = False, score: str = "score", doc_id: str = "id_submission"
) -> DataFrame:
    """Best (or worst) ``k`` rows, ties by id. Planned as a per-task heap, no full sort."""
    order = F.col(score).asc() if worst else F.col(score).desc()
    return scores.orderBy(order, F.col(doc_id)).limit(k)


def relevance_tag(scores: DataFrame, k: int, doc_id: str = "id_submission") -> DataFrame:
    """Patch rows that set the significant-terms tag on the top ``k`` documents."""
    return top_k(scores, k, doc_id=doc_id).select(
        doc_id, F.lit(True).alias("sentiment_sig_terms_ordered")
    )


def ranking_precision(
    scores: DataFrame,
    k: int,
    stance: str,
    every: int = 500,
    worst: bool = False,
    doc_id: str = "id_submission",
) -> DataFrame:
    """Positives seen among the first rows of a ranking, at every ``every``-th rank and at the end.

    The window runs over at most ``k`` rows: the report is about a top-k list.
    """
    ranked = top_k(scores, k, worst, doc_id=doc_id)
    order = F.col("score").asc() if worst else F.col("score").desc()
    window = Window.orderBy(order, F.col(doc_id))
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    table = ranked.select(
        F.row_number().over(window).cast("long").alias("rank"),
        F.sum(F.when(F.col(stance), 1).otherwise(0)).over(running).alias("positives"),
        F.count(F.lit(1)).over(whole).alias("_rows"),
    )
    return table.filter((F.col("rank") % every == 0) | (F.col("rank") == F.col("_rows"))).select(
        "rank", "positives", F.round(F.col("positives") / F.col("rank"), 6).alias("precision")
    )


def ranking_misses(scores: DataFrame, k: int, stance: str, worst: bool = False, doc_id: str = "id_submission") -> DataFrame:
    """Rows of the top-k list whose stance is not positive."""
    return top_k(scores, k, worst, doc_id=doc_id).filter(~F.coalesce(F.col(stance), F.lit(False)))


def review_sample(scores: DataFrame, k: int, step: int, doc_id: str = "id_submission") -> DataFrame:
    """Every ``step``-th row of the top-k list, with its rank."""
    window = Window.orderBy(F.col("score").desc(), F.col(doc_id))
    ranked = top_k(scores, k, doc_id=doc_id).withColumn("rank", F.row_number().over(window).cast("long"))
    return ranked.filter(F.col("rank") % step == 0)
