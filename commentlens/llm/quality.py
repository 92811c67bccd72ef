"""Quality rules with thresholds from mergeable sketches per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from ..operators.skew import lookup
from ..spark_env import materialize
from .common import WHITE_SPACE, inputs, table

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
# Measures per thousand, and what they are a share of.
MEASURES = {"symbols": "n_words", "repeats": "n_words", "lines": "n_lines", "capitals": "word_chars"}
SKETCHED = (*MEASURES, *dict.fromkeys(MEASURES.values()))
# A fence's distance from the upper quantile, in distances between that and the median.
STEPS = 12
# Sketch bins: exact below 32, then 16 bins for each doubling.
EXACT_BITS = 5
MIN_GROUP = 100
LEVELS = ["source", "lang", "all"]


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""

    def count(hashes: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(z: Column) -> Column:
            def twin(s: Column, j: Column) -> Column:
                same = (F.get(z, j - 1)["h"] == s["h"]) | (F.get(z, j + 1)["h"] == s["h"])
                return F.when(same, s["i"])

            return F.sort_array(F.array_compact(F.transform(z, twin)))

        def covered(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(let(by_hash, places), covered)).otherwise(0)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= 3, let(windows, count)).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the base counts, ``base_failed`` and each measure per thousand."""
    content = F.coalesce(F.col("text"), F.lit(""))
    bare = F.translate(content, WHITE_SPACE, "")
    counts = docs.select(
        "doc_id",
        "lang",
        "source",
        let(
            F.filter(F.split(content, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""),
            lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).cast("long").alias("rep")),
        ).alias("w"),
        let(
            F.filter(F.split(content, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE_SPACE))) > 0),
            lambda x: F.struct(
                F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")
            ),
        ).alias("l"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(content) - F.length(F.translate(content, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(content, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
    )
    named = counts.select(
        "doc_id", "lang", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.dup").alias("n_dup_lines"), F.col("w.rep").alias("n_repeat_words"), "n_upper", F.col("l.n").alias("n_lines"),
    )
    share = lambda part, whole: F.expr(f"1000 * {part} div greatest({whole}, 1)")
    return named.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "n_words").alias("symbols"),
        share("n_repeat_words", "n_words").alias("repeats"),
        share("n_dup_lines", "n_lines").alias("lines"),
        share("n_upper", "word_chars").alias("capitals"),
    )


def sketches(measures: DataFrame) -> DataFrame:
    """``lang, source, measure, low, n``: a count per bin. Sketches of parts add up to the whole's."""
    named = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in SKETCHED))
    each = measures.filter(~F.col("base_failed")).select("lang", "source", F.inline(named))
    return each.select("lang", "source", "measure", bin_low("value").alias("low")).groupBy(
        "lang", "source", "measure", "low"
    ).agg(F.count(F.lit(1)).alias("n"))


def bin_low(value: str) -> Column:
    """The least value of the bin that holds ``value``: its five leading binary digits."""
    shift = f"greatest(length(bin({value})) - {EXACT_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def fences(sketch: DataFrame) -> DataFrame:
    """``level, lang, source`` and the upper fence of each measure.

    Everything in it comes from the group's sketch: a fence is the 7/8 quantile plus ``STEPS`` times
    its distance from the median. Where most documents have the same value, one event in a document
    of median size is the distance instead. Up to an eighth of a group may be junk without moving
    the fence. Groups of fewer than ``MIN_GROUP`` documents have none of their own; merged sketches
    of the language, then of everything, stand in.
    """
    none = F.lit(None).cast("string")
    levels = (
        sketch.withColumn("level", F.lit("source"))
        .unionByName(sketch.withColumns({"level": F.lit("lang"), "source": none}))
        .unionByName(sketch.withColumns({"level": F.lit("all"), "source": none, "lang": none}))
    )
    keys = ["level", "lang", "source", "measure"]
    merged = levels.groupBy(*keys, "low").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    ranked = merged.select(
        *keys, "low", F.sum("n").over(group).alias("total"), F.sum("n").over(group.orderBy("low")).alias("upto")
    ).filter((F.col("total") >= MIN_GROUP) | (F.col("level") == "all"))
    quantiles = ranked.groupBy(*keys).agg(
        F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("low"))).alias("middle"),
        F.min(F.when(8 * F.col("upto") >= 7 * F.col("total"), F.col("low"))).alias("upper"),
        F.max("total").alias("n"),
    )
    of = lambda name, column: F.max(F.when(F.col("measure") == name, F.col(column)))

    def fence(measure: str, whole: str) -> Column:
        event = F.ceil(F.lit(1000) / F.greatest(of(whole, "middle"), F.lit(1)))
        return (of(measure, "upper") + STEPS * F.greatest(of(measure, "upper") - of(measure, "middle"), event)).alias(f"max_{measure}")

    return quantiles.groupBy("level", "lang", "source").agg(*(fence(m, w) for m, w in MEASURES.items()), F.max("n").alias("n"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: base counts, ``base_failed``, the measures and ``kept``.

    A document is kept when it passes the base rules and every measure is at most its group's
    fence. A missing text has no words and fails; a missing language or source is a group like any
    other; repeated rows are judged alike. All measures come from whole texts.
    """
    rows = inputs(docs, doc_id, text, F.col(lang).alias("lang"), F.col(source).alias("source"))
    return with_fences(materialize(measured(rows), "measures"))


def with_fences(rows: DataFrame) -> DataFrame:
    limits = materialize(fences(sketches(rows)), "fences")
    group = lambda *parts: F.to_json(F.struct(*parts))
    own = limits.filter("level = 'source'").select(
        group("lang", "source").alias("group"), "n", *(F.col(f"max_{m}").alias(f"s_{m}") for m in MEASURES)
    )
    by_lang = limits.filter("level = 'lang'").select(
        F.to_json(F.struct("lang")).alias("tongue"), "n", *(F.col(f"max_{m}").alias(f"l_{m}") for m in MEASURES)
    )
    every = limits.filter("level = 'all'").select(*(F.col(f"max_{m}").alias(f"a_{m}") for m in MEASURES))
    spread = F.xxhash64("doc_id", "word_chars")
    keyed = rows.withColumns({"group": group("lang", "source"), "tongue": F.to_json(F.struct("lang"))})
    joined = lookup(keyed, own, "group", "n", spread, "left")
    joined = lookup(joined, by_lang, "tongue", "n", spread, "left")
    joined = joined.join(F.broadcast(every), how="left")  # one row
    fine = ~F.col("base_failed")
    for m in MEASURES:
        fine = fine & (F.col(m) <= F.coalesce(f"s_{m}", f"l_{m}", f"a_{m}"))
    return joined.withColumn("kept", fine)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    shift = f"greatest(length(bin(v)) - {EXACT_BITS}, 0)"
    unpivot = " union all ".join(f"select lang, source, '{m}' as measure, {m} as v from m where not base_failed" for m in SKETCHED)
    levels = " union all ".join(
        f"select '{level}' as level, {lang}, {source}, measure, v from u"
        for level, lang, source in (("source", "lang", "source"), ("lang", "lang", "null as source"), ("all", "null as lang", "null as source"))
    )
    highs = " union all ".join(
        f"select a.level, a.lang, a.source, '{m}' as measure, a.q3 + {STEPS} * greatest(a.q3 - a.q2, cast(ceil(1000 / greatest(b.q2, 1)) as bigint)) as high "
        f"from q a join q b on a.level = b.level and a.lang is not distinct from b.lang and a.source is not distinct from b.source "
        f"where a.measure = '{m}' and b.measure = '{w}' and (a.n >= {MIN_GROUP} or a.level = 'all')" for m, w in MEASURES.items()
    )
    tests = " and ".join(
        f"{m} <= coalesce((select f.high from fence f where f.level = 'source' and f.measure = '{m}' and f.lang is not distinct from m.lang and f.source is not distinct from m.source),"
        f" (select f.high from fence f where f.level = 'lang' and f.measure = '{m}' and f.lang is not distinct from m.lang),"
        f" (select f.high from fence f where f.level = 'all' and f.measure = '{m}'))"
        for m in MEASURES
    )
    return f"""
with w as (select *, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from documents),
win as (select doc_id, unnest(range(1, len(ws) - 1)) as i, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i+2])) as g from w where len(ws) >= 3),
twice as (select doc_id, i from win qualify count(*) over (partition by doc_id, g) > 1),
hit as (select distinct doc_id, i + k as p from twice, range(3) t(k)),
rep as (select doc_id, count(*) as rep from hit group by doc_id),
c as (select w.doc_id, lang, source, cast(len(ws) as bigint) as n_words, cast(length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
  cast(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', '')) as bigint) as n_symbols,
  cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(len(ls) as bigint) as n_lines, cast(coalesce(rep, 0) as bigint) as n_repeat_words,
  cast(length(regexp_replace(coalesce(text, ''), '[^\\p{{Lu}}]+', '', 'g')) as bigint) as n_upper from w left join rep using (doc_id)),
m as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed, 1000 * n_symbols // greatest(n_words, 1) as symbols,
  1000 * n_repeat_words // greatest(n_words, 1) as repeats, 1000 * n_dup_lines // greatest(n_lines, 1) as lines, 1000 * n_upper // greatest(word_chars, 1) as capitals from c),
raw as ({unpivot}),
u as (select lang, source, measure, (v >> {shift}) << {shift} as v from raw),
lv as ({levels}),
q as (select level, lang, source, measure, count(*) as n, quantile_disc(v, 0.5) as q2, quantile_disc(v, 0.875) as q3 from lv group by all),
fence as ({highs})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {tests} as kept from m
"""


QUERIES = {"op6_quality": (op6_quality, _sql())}
