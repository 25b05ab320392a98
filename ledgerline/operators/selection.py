"""Order statistics and top-k over very many distinct values without sorting or
shuffling the data: passes that count, each combined map-side, narrow down what can
still be the answer until it is small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

CUTS = 512                       # equal-height ranges that a pass cuts a range into
ACCURACY = 10_000                # of the cuts (they are estimates; the counts are exact)
FEW = 10_000                     # values of a range that are gathered in one array
BROADCAST_RANGES = 100_000       # rows of some 100 bytes; more are joined by a shuffle
BUCKETS = 1 << 16                # counters of a row of counters


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _within(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows in each range (``__lo`` to ``__hi`` of a group); ranges may overlap."""
    few = ranges.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES
    return (rows.join(F.broadcast(ranges) if few else ranges, "__key")
            .filter((F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi"))))


def select_ranks(rows: DataFrame, wanted: Column, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """``(sizes, values)``: (__key, __n) per group, and (__key, __rank, __value) for the
    ranks (from 0, ascending) that ``wanted``, an array over ``__n``, names. ``rows`` is
    (__key, __x) without NULL.

    A wanted rank lies in a range of values, at first the whole group. While that range
    has more than ``few`` values, one pass cuts it into ranges of about equal height and a
    second counts the values below, at, between and above the two cuts around the rank.
    The zone with the rank is the next range: some 3 in ``CUTS`` of the values where the
    estimate is good, never all of them. Both passes are aggregates combined map-side, so a
    hot group is spread over all tasks and no value is moved. A range of one
    value is that value; one of a few values is gathered and sorted."""
    cuts = F.percentile_approx("__x", [i / CUTS for i in range(CUTS + 1)], ACCURACY).alias("__cuts")
    first = _kept(rows.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__lo"),
                                            F.max("__x").alias("__hi"), cuts), "quantile-cuts")
    state = first.withColumn("__rank", F.explode(F.array_distinct(wanted))).select(
        "__key", "__rank", "__lo", "__hi", F.col("__n").alias("__m"), F.col("__rank").alias("__at"))
    found = first.select("__key", "__lo", "__hi", "__cuts")
    is_open = (F.col("__lo") < F.col("__hi")) & (F.col("__m") > few)
    span = ["__key", "__lo", "__hi"]
    is_first = True
    while not state.filter(is_open).isEmpty():
        if not is_first:
            found = _kept(_within(rows, state.filter(is_open).select(*span).distinct()).groupBy(*span).agg(cuts),
                          "quantile-cuts")
        is_first = False
        at = F.floor(F.col("__at") / F.col("__m") * CUTS).cast("int")
        aimed = state.filter(is_open).join(found, span).withColumns({
            "__a": F.element_at("__cuts", F.greatest(at, F.lit(1))),
            "__b": F.element_at("__cuts", F.least(at + 3, F.lit(CUTS + 1)))}).drop("__cuts")
        zoned = [*span, "__a", "__b"]
        x = F.col("__x")
        zone = (F.when(x < F.col("__a"), 0).when(x == F.col("__a"), 1).when(x < F.col("__b"), 2)
                .when(x == F.col("__b"), 3).otherwise(4))
        counts = _kept(_within(rows, aimed.select(*zoned).distinct()).groupBy(*zoned, zone.alias("__zone"))
                       .agg(F.count(F.lit(1)).alias("__z"), F.min("__x").alias("__zlo"), F.max("__x").alias("__zhi")),
                       "quantile-zones")
        # five zones at most, in order of value
        lists = counts.groupBy(*zoned).agg(F.sort_array(F.collect_list(F.struct("__zone", "__z", "__zlo", "__zhi")))
                                           .alias("__zones"))
        before = F.expr("aggregate(slice(__zones, 1, __i), 0L, (s, z) -> s + z.__z)")
        hit = (aimed.join(lists, zoned).select("__key", "__rank", "__at", "__zones", F.posexplode("__zones").alias("__i", "__s"))
               .withColumn("__before", before)
               .filter((F.col("__at") >= F.col("__before")) & (F.col("__at") < F.col("__before") + F.col("__s.__z"))))
        state = _kept(state.filter(~is_open).unionByName(
            hit.select("__key", "__rank", F.col("__s.__zlo").alias("__lo"), F.col("__s.__zhi").alias("__hi"),
                       F.col("__s.__z").alias("__m"), (F.col("__at") - F.col("__before")).alias("__at"))), "quantile-ranges")
    single = state.filter(F.col("__lo") == F.col("__hi")).select("__key", "__rank", F.col("__lo").alias("__value"))
    some = state.filter(F.col("__lo") < F.col("__hi"))
    sorted_values = (_within(rows, some.select(*span).distinct()).groupBy(*span)
                     .agg(F.sort_array(F.collect_list("__x")).alias("__values")))
    gathered = some.join(sorted_values, span).select(
        "__key", "__rank", F.element_at("__values", (F.col("__at") + 1).cast("int")).alias("__value"))
    return first.select("__key", "__n"), single.unionByName(gathered)


def quantiles(src: DataFrame, by: Sequence[str], col: str, probs: Sequence[float], names: Sequence[str],
              few: int = FEW) -> DataFrame:
    """Exact quantiles per group with linear interpolation by :func:`select_ranks`.
    NULL values are left out and NaN is the largest; a NULL group is a group; without
    values there is no row."""
    x = F.col(col).cast("double")
    rows = src.filter(x.isNotNull()).select(F.struct(*(by or [F.lit(0).alias("all")])).alias("__key"), x.alias("__x"))
    where = [F.lit(float(p)) * (F.col("__n") - 1) for p in probs]
    sizes, values = select_ranks(rows, F.array(*[end(w).cast("long") for w in where for end in (F.floor, F.ceil)]), few)
    of = F.map_from_entries(F.collect_list(F.struct("__rank", "__value")))
    one = sizes.join(values.groupBy("__key").agg(of.alias("__of")), "__key")
    out = []
    for w, name in zip(where, names):
        lo, hi = F.col("__of")[F.floor(w).cast("long")], F.col("__of")[F.ceil(w).cast("long")]
        out.append(F.when(lo == hi, lo).otherwise(lo + (w - F.floor(w)) * (hi - lo)).alias(name))
    return one.select(*[F.col("__key")[b].alias(b) for b in by], *out)


def top_values(df: DataFrame, col: str, k: int, out: str = "n", buckets: int = BUCKETS) -> DataFrame:
    """E11 for very many distinct values: the ``k`` most frequent values of ``col``
    (NULL dropped) and their exact counts, largest first, ties by value.

    Two rows of ``buckets`` counters, each value hashed to one counter a row, are filled
    first. A counter is never less than the count of a value in it, whatever else
    it holds. The values in the fullest counters are then counted exactly, and the
    ``k``-th of these counts is one that the ``k``-th of all values reaches. So only
    values with both counters at that count or over it can be in the result (ties
    included), and the last pass counts these alone. Only counters and such candidates are
    shuffled. Where the counts are too even to tell values apart, all are candidates and
    the last pass is the plain count."""
    if k < 1:
        raise ValueError("k must be at least 1")
    values = df.filter(F.col(col).isNotNull()).select(F.col(col).alias("__v"))
    slots = [F.pmod(F.xxhash64(F.lit(i), "__v"), F.lit(buckets)) for i in range(2)]
    counters = _kept(values.select(F.posexplode(F.array(*slots)).alias("__row", "__slot"))
                     .groupBy("__row", "__slot").agg(F.count(F.lit(1)).alias("__c")), "top-counters")

    def within(rows: DataFrame, i: int, chosen: DataFrame) -> DataFrame:
        # at most ``buckets`` numbers
        return rows.join(F.broadcast(chosen.select(F.col("__slot").alias("__s"))), slots[i] == F.col("__s"), "left_semi")

    full = counters.filter("__row = 0").orderBy(F.desc("__c"), "__slot").limit(min(4 * k, buckets))
    sure = (within(values, 0, full).groupBy("__v").agg(F.count(F.lit(1)).alias("__c"))
            .orderBy(F.desc("__c")).limit(k).agg(F.min("__c").alias("least"), F.count(F.lit(1)).alias("found")).first())
    least = sure.least if sure.found == k else 0
    for i in range(2):
        values = within(values, i, counters.filter((F.col("__row") == i) & (F.col("__c") >= least)))
    return (values.groupBy(F.col("__v").alias(col)).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.desc(out), F.asc(col)).limit(k))
