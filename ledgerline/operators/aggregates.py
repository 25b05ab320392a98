"""Aggregations (survey E1-E23). Every aggregate here is a two-phase
(partial, then final) aggregation, so a hot group is combined map-side
before it is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators import selection


def avg_by(df: DataFrame, key: str | Sequence[str], col: str | Column, out: str = "avg") -> DataFrame:
    """E1/E2."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(col).alias(out))


def sum_by(df: DataFrame, key: str | Sequence[str], col: str | Column, out: str = "total") -> DataFrame:
    """E3/E23."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sum(col).alias(out))


def value_counts(df: DataFrame, col: str, k: int | None = None, min_count: int | None = None,
                 out: str = "n") -> DataFrame:
    """Counts per value, NULL dropped, largest first (ties by value).
    ``k`` keeps the k first (a top-k report); ``min_count`` drops rare values."""
    counts = (df.filter(F.col(col).isNotNull())
              .groupBy(col).agg(F.count(F.lit(1)).alias(out)))
    if min_count is not None:
        counts = counts.filter(F.col(out) >= min_count)
    ordered = counts.orderBy(F.col(out).desc(), F.col(col).asc())
    return ordered.limit(k) if k is not None else ordered


def top_k_share(df: DataFrame, col: str, k: int, out: str = "n",
                share: str = "share") -> DataFrame:
    """Top-k value counts and each one's share of the k rows' total.
    The window total runs over the k rows only."""
    top = value_counts(df, col, k=k, out=out)
    total = F.sum(out).over(Window.partitionBy())
    return top.withColumn(share, F.col(out) / total)


def crosstab(df: DataFrame, row: str, col: str, row_values: Sequence[str],
             col_values: Sequence[str], fill: int = 0) -> DataFrame:
    """E12 + D3: counts per (row category, column class) for a fixed domain,
    zero-filled, in the given row order (``position`` 1..n). One pass over the
    data: a pivot over the given classes; the domain is a literal table the
    caller gives (its size is the caller's list)."""
    if len(set(row_values)) != len(row_values):
        raise ValueError("duplicate categories in the domain list")
    counts = (df.filter(F.col(row).isin(*row_values) & F.col(col).isin(*col_values))
              .groupBy(row).pivot(col, list(col_values)).agg(F.count(F.lit(1))))
    spark = df.sparkSession
    domain = spark.createDataFrame([(i + 1, v) for i, v in enumerate(row_values)],
                                   f"position int, {row} string")
    out = domain.join(counts, row, "left")
    return out.select("position", row,
                      *[F.coalesce(F.col(f"`{c}`"), F.lit(fill)).cast("bigint").alias(c)
                        for c in col_values])


def group_quantiles(df: DataFrame, by: Sequence[str], col: str,
                    probs: Sequence[float] = (0.25, 0.5, 0.75), approx: bool = False,
                    names: Sequence[str] | None = None, accuracy: int = 10000,
                    method: str = "sorted") -> DataFrame:
    """Quantiles per group with linear interpolation.

    * ``method="map"``: exact ``percentile``; the aggregation buffer
      is a value->count map per group, combined map-side. Memory follows the
      number of *distinct* values in a group: only for columns whose values are
      known to be few (whole years, minutes, ratings).
    * ``method="sorted"`` (default): exact and fully distributed, for any
      number of distinct values: global dense ids in (group, value) order from a
      range-partitioned sort (a hot group spans many tasks), then the two
      neighbours of each quantile position are fetched by an equi-join on
      the unique id. No group is ever gathered in one task.
    * ``method="select"``: exact, for very many values: ranges of values are
      counted and narrowed down until they are small (``selection.quantiles``);
      nothing is sorted or written but the ranges.
    * ``approx=True`` / ``method="approx"``: ``percentile_approx``.
    """
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    src = df.filter(F.col(col).isNotNull())
    if approx or method == "approx":
        q = F.percentile_approx(F.col(col), list(probs), accuracy)
    elif method == "sorted":
        return _quantiles_sorted(src, list(by), col, list(probs), names)
    elif method == "select":
        return selection.quantiles(src, list(by), col, list(probs), names)
    else:
        q = F.percentile(F.col(col), F.array(*[F.lit(p) for p in probs]))
    agg = src.groupBy(*by).agg(q.alias("__q"))
    return agg.select(*by, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])


def _quantiles_sorted(src: DataFrame, by: list[str], col: str, probs: list[float],
                      names: list[str]) -> DataFrame:
    from ledgerline.operators.relational import with_row_id

    ranked = with_row_id(src.select(*by, F.col(col).cast("double").alias("__x")), [*by, "__x"],
                         out="__id")
    stats = ranked.groupBy(*by).agg(F.min("__id").alias("__start"),
                                    F.count(F.lit(1)).alias("__n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p"))
                                 for i, p in enumerate(probs)]))
    t = stats.select(*by, "__start", "__n", wanted.alias("__t"))
    pos = F.col("__t.p") * (F.col("__n") - 1)
    t = t.select(*by, F.col("__t.qi").alias("__qi"), (pos - F.floor(pos)).alias("__frac"),
                 (F.col("__start") + F.floor(pos)).cast("long").alias("__lo_id"),
                 (F.col("__start") + F.ceil(pos)).cast("long").alias("__hi_id"))
    vals = ranked.select("__id", "__x")
    lo = vals.select(F.col("__id").alias("__lo_id"), F.col("__x").alias("__lo"))
    hi = vals.select(F.col("__id").alias("__hi_id"), F.col("__x").alias("__hi"))
    j = t.join(lo, "__lo_id").join(hi, "__hi_id")
    q = j.select(*by, "__qi",
                 (F.col("__lo") + F.col("__frac") * (F.col("__hi") - F.col("__lo"))).alias("__q"))
    wide = q.groupBy(*by).pivot("__qi", list(range(len(probs)))).agg(F.first("__q"))
    return wide.select(*by, *[F.col(f"`{i}`").alias(n) for i, n in enumerate(names)])


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5,
              method: str = "sorted") -> DataFrame:
    """Quartiles, IQR, whiskers (most extreme values within
    ``whisker`` x IQR of the box) and the number of outliers per group.
    Second pass: the per-group quartiles (one row per group) are joined back
    on the group key, NULL being a group of its own."""
    by = list(by)
    src = df.filter(F.col(col).isNotNull())
    q = group_quantiles(src, by, col, names=["q1", "median", "q3"], method=method)
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("lo_fence", F.col("q1") - whisker * F.col("iqr"))
         .withColumn("hi_fence", F.col("q3") + whisker * F.col("iqr")))
    if by:
        keyed = q.select(*[F.col(b).alias(f"__{b}") for b in by], *[c for c in q.columns if c not in by])
        same = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]
        j = src.select(*by, col).join(keyed, same, "inner")
    else:
        # one group: the quartiles are a scalar sub-query (one struct, run once)
        one = q.select(F.struct(*q.columns).alias("s")).scalar()
        j = src.select(col, *[one[c].alias(c) for c in q.columns])
    x = F.col(col).cast("double")
    inside = (x >= F.col("lo_fence")) & (x <= F.col("hi_fence"))
    stats = j.groupBy(*by, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.sum(F.when(~inside, 1).otherwise(0)).cast("bigint").alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )
    return stats


def _is_number(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def histogram(df: DataFrame, col: str, edges: Sequence[float], by: str | None = None,
              total: bool = True, out: str = "n", overall_label: str = "all") -> DataFrame:
    """Counts per bin for fixed ascending edges (bins ``[e_i, e_i+1)``,
    the last one closed). Every bin is there, empty ones with 0; values outside,
    NULL and NaN are not counted. With ``by`` the counts are per class **and**
    overall, in one pass (grouping sets); the overall rows carry
    ``overall_label`` in the class column (chosen by ``grouping_id``, so a real
    NULL class stays separate). One conditional count per bin, all map-side
    combined."""
    edges = [float(e) for e in edges]
    if len(edges) < 2 or any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be strictly ascending")
    bins = list(zip(edges[:-1], edges[1:]))
    x = F.col("__x")
    src = df.select(*([by] if by else []), F.col(col).cast("double").alias("__x"))
    counts = []
    for i, (lo, hi) in enumerate(bins):
        below = x <= hi if i == len(bins) - 1 else x < hi
        counts.append(F.count(F.when(_is_number(x) & (x >= lo) & below, 1)).alias(f"__b{i}"))
    if by is None:
        res = src.agg(*counts)
    elif not total:
        res = src.groupBy(by).agg(*counts)
    else:
        res = src.groupingSets([[by], []], by).agg(*counts, F.grouping_id().alias("__g"))
        res = res.withColumn(by, F.when(F.col("__g") == 0, F.col(by)).otherwise(F.lit(overall_label)))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("bin"), F.lit(lo).alias("bin_lo"), F.lit(hi).alias("bin_hi"),
                              F.col(f"__b{i}").alias(out)) for i, (lo, hi) in enumerate(bins)])
    return res.select(*([by] if by else []), F.inline(rows))


def histogram_n(df: DataFrame, col: str, n: int | dict[str, int], by: str | None = None,
                out: str = "n") -> DataFrame:
    """Equal-width bins over [min, max] of the column (NULL and NaN
    dropped), empty bins with 0. With ``by``, ``n`` gives the number of bins
    per class (other classes are dropped): one pass finds all bounds, a second
    counts. When min = max every value falls in bin 1."""
    x = F.col(col).cast("double")
    if by is None:
        return histogram_n(df.select(F.lit("").alias("__all"), x.alias("__x")), "__x", {"": n}, "__all", out) \
            .drop("__all")
    src = df.select(F.col(by), x.alias("__x")).filter(_is_number(F.col("__x")) & F.col(by).isin(*n))
    spark = df.sparkSession
    classes = spark.createDataFrame(list(n.items()), f"`{by}` string, __n int")
    # one row per class that the caller names
    bounds = classes.join(src.groupBy(by).agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi")), by, "left")
    width = (F.col("__hi") - F.col("__lo")) / F.col("__n")
    b = (F.when(F.col("__hi") == F.col("__lo"), F.lit(1))
         .when(F.col("__x") >= F.col("__hi"), F.col("__n"))
         .otherwise(F.floor((F.col("__x") - F.col("__lo")) / width).cast("int") + 1))
    counts = (src.join(F.broadcast(bounds), by).select(by, b.cast("int").alias("bin"))
              .groupBy(by, "bin").agg(F.count(F.lit(1)).alias("__count")))
    bins = bounds.withColumn("bin", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return (bins.join(counts, [by, "bin"], "left")
            .select(by, "bin", (F.col("__lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                    (F.col("__lo") + F.col("bin") * width).alias("bin_hi"),
                    F.coalesce("__count", F.lit(0)).cast("bigint").alias(out)))


def null_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of NULLs per column (one row)."""
    return df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                    for c in cols])


def count_by_year(df: DataFrame, ts: str | Column, out: str = "n") -> DataFrame:
    """Rows per year (NULL dates dropped), year order."""
    y = F.year(F.col(ts) if isinstance(ts, str) else ts).alias("year")
    return (df.select(y).filter(F.col("year").isNotNull())
            .groupBy("year").agg(F.count(F.lit(1)).alias(out)).orderBy("year"))


def monthly_mean_count(df: DataFrame, ts: str | Column, out: str = "avg_count") -> DataFrame:
    """Rows per (year, month), then the mean over the years that have
    rows, per month (a month without rows in a year is not a 0)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    per = (df.select(F.year(c).alias("year"), F.month(c).alias("month"))
           .filter(F.col("year").isNotNull())
           .groupBy("year", "month").agg(F.count(F.lit(1)).alias("__n")))
    return per.groupBy("month").agg(F.avg("__n").alias(out)).orderBy("month")
