import itertools

from pyspark.sql import functions as F

from commentlens.functions import predicates as P


def test_all_states(spark):
    states = list(itertools.product([True, False, None], repeat=3))
    rows = [
        (m, t, s, source, cluster)
        for (m, t, s) in states
        for source in ("good", "bad", "unknown", None)
        for cluster in ("c+", "c-", "c0", None)
    ]
    df = spark.createDataFrame(rows, "manual boolean, stance boolean, sig boolean, source string, cluster string")
    tags = P.Tags(F.col("source"), F.col("stance"), F.col("manual"), F.col("sig"), F.lit(None).cast("boolean"), F.col("cluster"))
    reviewed = P.Reviewed(["good"], ["bad"], ["c+"], ["c-"])
    out = df.select("*", P.positive(tags, reviewed), P.negative(tags, reviewed), P.untagged(tags, reviewed), P.needs_review(tags, reviewed)).collect()
    assert len(out) == len(rows)
    for m, t, s, source, cluster, pos, neg, open_, review in out:
        assert pos == (True in (m, t, s) or source == "good" or cluster == "c+")
        assert neg == (False in (m, t, s) or source == "bad" or cluster == "c-")
        assert open_ == (source == "unknown" and (m, t, s) == (None, None, None) and cluster not in ("c+", "c-"))
        assert review == ((m, t, s) == (None, None, None) and source not in ("good", "bad"))
        assert not (open_ and (pos or neg))


def test_empty_lists_match_nothing(spark):
    df = spark.createDataFrame([("a",), (None,)], "source string")
    assert df.filter(P.in_list(F.col("source"), [])).count() == 0
