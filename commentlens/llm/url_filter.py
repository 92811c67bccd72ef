"""Judges URLs by rules, and by a logistic regression on hashed character n-grams elsewhere."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from .common import UPPER, table

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
FEATURES = 2**15
GRAMS = (3, 4, 5)
THRESHOLD = 0.5

# Words of hosts by what a site offers, and what hosts and paths are put together with.
BAD_WORDS = (
    "casino", "bet", "bets", "poker", "slots", "jackpot", "roulette", "lottery", "pills", "viagra", "pharmacy", "meds", "adult", "porn", "xxx", "sexcam",
    "escort", "dating", "loans", "payday", "replica", "fake", "warez", "torrent", "crack", "keygen", "malware", "phish", "spam", "backlinks", "ads",
    "adserver", "popup", "track", "clicks", "scam",
)
GOOD_WORDS = (
    "library", "garden", "history", "science", "weather", "cooking", "museum", "travel", "school", "city", "music", "health", "sports", "forum", "code",
    "maths", "reader", "docs", "data", "static", "news", "college", "radio", "photo", "books", "maps", "trains", "theatre", "church", "council", "hiking",
    "birds", "chess", "bakery", "physics", "hospital", "law", "farm", "win", "free",
)
AFFIXES = ("best", "online", "top", "24", "zone", "hub")
SYLLABLES = ("ba", "ko", "mi", "ren", "sol", "tar", "vin", "lu", "de", "pa", "ster", "wick", "ham", "ton")
PREFIXES = ("", "www.", "m.", "blog.")
DOMAINS = ("example.com", "example.org", "example.net")
PATHS = ("/en/1204", "/de/artikel/77.html", "/fr/page/3", "/es/8423/", "/about", "/2017/05/report.html", "/index.php")
BAD_PATHS = ("/jackpot", "/bet/now.html", "/pills/order", "/xxx/video", "/click", "/bonus")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each marked with where it is from."""

    def of(text: Column, mark: str) -> list[Column]:
        return [
            F.when(
                F.length(text) >= n,
                F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n)))),
            ).otherwise(F.array().cast("array<string>"))
            for n in GRAMS
        ]

    framed = let(F.concat(F.lit("^"), host, F.lit("$")), lambda h: F.concat(*of(h, "h")))
    return F.concat(framed, let(path, lambda p: F.concat(*of(p, "p"))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``split, url, label``: the small table that the model is trained on; 1 is to be blocked.

    Words of both kinds meet the same affixes, domains and paths, so only the word tells them
    apart; names of open syllables stand for the many harmless hosts of no known kind. Each fourth
    host is in the split ``test`` and never trained on.
    """
    rows = []

    def add(label: float, i: int, k: int, host: str, paths: tuple) -> None:
        url = f"http://{PREFIXES[(i + k) % 4]}{host}.{DOMAINS[(i + 2 * k) % 3]}{paths[(5 * i + k) % len(paths)]}"
        rows.append(("train" if (3 * i + k) % 4 else "test", url, label))

    for label, words, paths in ((1.0, BAD_WORDS, PATHS + BAD_PATHS), (0.0, GOOD_WORDS, PATHS)):
        for i, word in enumerate(words):
            for k, affix in enumerate(AFFIXES):
                forms = (f"{word}-{affix}", f"{affix}-{word}", f"{word}{affix}", f"{affix}{word}")
                add(label, i, k, forms[(i + k // 2) % 4], paths)
    for i, first in enumerate(SYLLABLES):
        for k, second in enumerate(SYLLABLES):
            add(0.0, i, k, first + second, PATHS)
    return spark.createDataFrame(rows, "split string, url string, label double").coalesce(1)


def featured(urls: DataFrame) -> DataFrame:
    with_grams = urls.withColumn("grams", grams(host_of(F.col("url")), path_of(F.col("url"))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(with_grams)


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """``labelled`` has ``split, url, label`` and is small; Spark's own optimizer fits the weights
    on the split ``train``, where both labels count alike."""
    rows = labelled.filter("split = 'train'")
    share = rows.agg(F.avg("label")).first()[0]
    weighted = featured(rows).select("features", "label", F.when(F.col("label") > 0, (1 - share) / share).otherwise(1.0).alias("weight"))
    return LogisticRegression(maxIter=40, regParam=0.001, standardization=False, weightCol="weight").fit(weighted)


def judge_urls(pages: DataFrame, model: LogisticRegressionModel, rules: tuple = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row.

    The longest rule that fits decides; without one the model blocks scores of ``THRESHOLD`` and
    more. A missing url, or one without ``://``, has an empty host and path, fits no rule and is
    scored like any other; repeated rows get equal verdicts. An empty table gives an empty one, very
    long urls are read whole, and columns other than the two named ones are not looked at.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    split = rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    scored = model.transform(featured(split))
    score = vector_to_array("probability")[1]
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(score >= THRESHOLD, "block").otherwise("allow")).alias("verdict"), score.alias("score"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), train(labelled_urls(spark)))
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op3_url_filter": (op3_url_filter, None)}
