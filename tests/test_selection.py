"""Quantiles by counting passes and top-k by counters, against plain forms."""

import contextlib
import io
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators import selection as S

N = 30_000
PROBS = [0.0, 0.01, 0.5, 0.999, 1.0]
NAMES = [f"p{i}" for i in range(len(PROBS))]


def _hot(spark):
    """A third of the rows in one group, another group of NULL; ties, many distinct
    values, values over the whole range of a double."""
    g = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 5))
    x = (F.when(F.col("id") % 7 == 0, F.lit(5.0)).when(F.col("id") % 11 == 0, F.pow(F.lit(10.0), F.col("id") % 600 - 300))
         .when(F.col("id") % 13 == 0, F.lit(None).cast("double")).otherwise((F.col("id") * 7919) % 10007 / 7.0 - 300))
    return spark.range(0, N, 1, 12).select(g.alias("g"), x.alias("x"))


@pytest.mark.parametrize("few", [2, 10_000])
def test_quantiles_equal_plain(spark, few):
    df = _hot(spark)
    got = {r.g: list(r)[1:] for r in S.quantiles(df, ["g"], "x", PROBS, NAMES, few).collect()}
    values = {}
    for r in df.filter("x is not null").collect():
        values.setdefault(r.g, []).append(r.x)
    assert got.keys() == values.keys() and None in got and "hot" in got
    for g, xs in values.items():
        assert np.allclose(got[g], np.quantile(xs, PROBS), rtol=1e-12, atol=0), g


def test_two_values_meet_at_the_rank(spark):
    # no cut lies between the two values, so a range of both would never shrink
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 2 + 5).alias("x"))
    assert S.quantiles(df, [], "x", [0.25, 0.5, 0.75], ["a", "b", "c"], 1).first() == (5.0, 5.5, 6.0)


def test_quantile_edges(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert S.quantiles(none, ["g"], "x", [0.5], ["m"]).count() == 0
    assert S.quantiles(none, [], "x", [0.5], ["m"]).count() == 0
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", None), ("c", 2.0), ("d", float("inf")), ("d", float("inf"))],
                               "g string, x double")
    got = {r.g: r for r in S.quantiles(df, ["g"], "x", [0.0, 1.0], ["lo", "hi"]).collect()}
    assert set(got) == {"a", "c", "d"} and got["a"].lo == 1.0 and np.isnan(got["a"].hi)
    assert got["c"][1:] == (2.0, 2.0) and got["d"][1:] == (float("inf"), float("inf"))
    same = A.group_quantiles(_hot(spark), ["g"], "x", (0.5,), names=["m"], method="select")
    other = A.group_quantiles(_hot(spark), ["g"], "x", (0.5,), names=["m"], method="map")
    assert sorted(same.collect(), key=str) == sorted(other.collect(), key=str)


def test_no_sort_of_the_values(spark):
    seen = []
    real = S._kept

    def kept(df, name):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        seen.append(buf.getvalue())
        return real(df, name)

    S._kept = kept
    try:
        S.quantiles(_hot(spark), ["g"], "x", PROBS, NAMES, 40).collect()
    finally:
        S._kept = real
    assert len(seen) > 3 and not any("rangepartitioning" in p or "Window" in p for p in seen)


def _brute(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda e: (-e[1], e[0]))[:k]


@pytest.mark.parametrize("buckets", [1, 8, 1 << 16])
def test_top_values_exact_whatever_collides(spark, buckets):
    # a hot value, 400 rare ones, ties at the last place
    values = [("hot" if i % 3 == 0 else f"v{(i * i) % 401:03}" if i % 3 == 1 else None if i % 9 == 2 else f"t{i % 50:02}",)
              for i in range(6000)]
    df = spark.createDataFrame(values, "v string").repartition(7)
    for k in (1, 5, 30, 1000):
        got = [tuple(r) for r in S.top_values(df, "v", k, buckets=buckets).collect()]
        assert got == _brute([v for v, in values], k), (k, buckets)


def test_top_values_edges(spark):
    assert S.top_values(spark.createDataFrame([], "v string"), "v", 3).count() == 0
    assert S.top_values(spark.createDataFrame([(None,)], "v string"), "v", 3).count() == 0
    with pytest.raises(ValueError):
        S.top_values(spark.createDataFrame([(1,)], "v int"), "v", 0)


def test_top_values_counts_candidates_only(spark):
    df = spark.range(0, 200_000, 1, 4).select(F.when(F.col("id") % 4 == 0, F.col("id") % 12).otherwise(F.col("id")).alias("v"))
    top = S.top_values(df, "v", 3)
    assert sorted(r.v for r in top.collect()) == [0, 4, 8]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        top.explain()
    # both rows of counters drop values before the partial count and its shuffle
    assert buf.getvalue().count("BroadcastHashJoin") >= 2 and "LeftSemi" in buf.getvalue()
