"""Filters, joins, de-duplication, ranking, row ids and reshaping
(survey C, D, G, F, H, I)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import SCRATCH_CODEC, scratch_path


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# ---- C: filters ------------------------------------------------------------

def where_eq(df: DataFrame, **kv) -> DataFrame:
    """Equality filter; pushed into the Parquet scan."""
    cond = F.lit(True)
    for k, v in kv.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)


def between_dates(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Closed date range on a date or timestamp column. Written as
    ``lo <= c < hi + 1 day`` so a timestamp late on the last day is kept and
    the bounds still push down to the scan."""
    c = F.col(col)
    lo_d = F.lit(lo).cast("date")
    hi_next = F.date_add(F.lit(hi).cast("date"), 1)
    return df.filter((c >= lo_d) & (c < hi_next))


def where_null(df: DataFrame, col: str) -> DataFrame:
    """C3."""
    return df.filter(F.col(col).isNull())


def where_present(df: DataFrame, col: str) -> DataFrame:
    """C3."""
    return df.filter(F.col(col).isNotNull())


def project(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Column selection (pruned down to the scan)."""
    return df.select(*cols)


# ---- D: joins --------------------------------------------------------------

def insert_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: rows of ``incoming`` whose
    key is not yet in ``existing`` are appended. ``incoming`` must already be
    one row per key (see :func:`first_by_key`). NULL keys are not inserted."""
    present = incoming
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    new_rows = present.join(existing.select(*keys), on=list(keys), how="left_anti")
    return existing.unionByName(new_rows.select(*existing.columns))


def check_fk(child: DataFrame, parent: DataFrame, child_key: str,
             parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (a NULL key passes,
    as in SQL)."""
    pk = parent_key or child_key
    parents = parent.select(F.col(pk).alias("__pk"))
    return (child.filter(F.col(child_key).isNotNull())
            .join(parents, F.col(child_key) == F.col("__pk"), "left_anti"))


def has_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``keys`` that exist in ``df`` (semi join)."""
    return keys.join(df.select(key), on=key, how="left_semi")


# ---- G: de-duplication -----------------------------------------------------

def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """G1."""
    return df.select(col).distinct()


def n_distinct(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Exact distinct count as a one-row DataFrame."""
    return df.agg(F.count_distinct(F.col(col)).alias(out))


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                 cols: Sequence[str] | None = None) -> DataFrame:
    """First row per key in a total order; rows with a NULL key are
    skipped. ``row_number() = 1`` is planned with a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row
    per map task before it moves."""
    src = df
    for k in keys:
        src = src.filter(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by))
    out_cols = list(cols) if cols else [c for c in df.columns]
    return (src.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1)
            .select(*out_cols))


def check_unique(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
            .filter(F.col(out) > 1))


def placed_rows(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back with each row's
    place (``__file``, ``__row``), which a task that is run again finds unchanged."""
    spark = df.sparkSession
    path = scratch_path(spark, "placed")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))


# ---- D2: many-to-many join -------------------------------------------------

HEAVY_SHARE = 1000               # a key with more than 1/1000 of a side's rows is heavy


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = HEAVY_SHARE) -> DataFrame:
    """Keys with more than 1/``share`` of the rows that have a key, so fewer than ``share``
    of them, and in how many pieces to split each (``pieces``, up to ``share``)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    return (counts.join(F.broadcast(total), F.col("__n") * share > F.col("__total"))
            .select(*keys, F.expr(f"cast(ceil({share} * __n / __total) as int)").alias("pieces")))


def join_many(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], share: int = HEAVY_SHARE) -> DataFrame:
    """Inner join in which a key may be held by many rows of both sides.

    The heavy keys of each side are counted first (fewer than ``share`` a side, so they
    are broadcast). A heavy key of the left side is dealt over ``a`` pieces, one
    of the right side over ``b``; a left row goes to its piece in each of
    the ``b`` columns and a right row to its piece in each of the ``a`` rows of that
    grid, so each pair of rows meets in exactly one cell. Cells are shuffled
    apart, so no task gets a whole heavy key. A row's piece follows from its place in
    a written file (only rows with a heavy key are written), so it stays the same when
    a task is run again, and equal rows are split too. The work added is one count of each
    side and the copies of rows with a heavy key, fewer than the pairs they form.
    Rows with a NULL key match nothing and are left out first."""
    names = [f"__k{i}" for i in range(len(on))]

    def keyed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        df = df.withColumns({n: F.col(c) for n, c in zip(names, columns)})
        for n in names:
            df = df.filter(F.col(n).isNotNull())
        return df

    a, b = keyed(left, [x for x, _ in on]), keyed(right, [y for _, y in on])
    grid = heavy_keys(a, names, share).withColumnRenamed("pieces", "__a").join(
        heavy_keys(b, names, share).withColumnRenamed("pieces", "__b"), names, "full")

    path = scratch_path(left.sparkSession, "heavy-keys")
    grid.write.parquet(path)
    grid = left.sparkSession.read.schema(grid.schema).parquet(path)
    if grid.isEmpty():
        return a.join(b, names).drop(*names)

    def dealt(df: DataFrame, own: str, own_cell: str, other: str, other_cell: str) -> DataFrame:
        light = df.join(F.broadcast(grid), names, "left_anti").withColumns({own_cell: F.lit(0), other_cell: F.lit(0)})
        heavy = placed_rows(df.join(F.broadcast(grid), names))
        piece = F.pmod(F.xxhash64("__file", "__row"), F.coalesce(F.col(own), F.lit(1))).cast("int")
        heavy = (heavy.withColumn(own_cell, piece)
                 .withColumn(other_cell, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)))
                 .drop("__a", "__b", "__file", "__row"))
        return light.unionByName(heavy)

    cells = dealt(a, "__a", "__i", "__b", "__j").join(dealt(b, "__b", "__j", "__a", "__i"), [*names, "__i", "__j"])
    return cells.drop(*names, "__i", "__j")


# ---- F/H: ranking, ordering, top-k ---------------------------------------

def top_ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1,
               ties: bool = True, rank_col: str | None = None) -> DataFrame:
    """best rows per group; with ``ties`` every row ranked <= n is kept
    (``rank``), else exactly n (``row_number`` with the given order)."""
    w = Window.partitionBy(*by).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rank"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """H2: k first rows of a total order (planned as TakeOrderedAndProject:
    k rows per partition, then k overall)."""
    return df.orderBy(*order).limit(k)


def row_place() -> list[Column]:
    """Where a row lies in the written files it is read from (``__file``, ``__row``): unlike
    an id given on the way, the same when a task is run again."""
    return [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]


def with_row_id(df: DataFrame, order_by: Sequence[str | Column], out: str = "id", placed: bool = False,
                drop: Sequence[str] = ()) -> DataFrame:
    """dense row ids 1..n in a total order, without moving all rows to one
    task.

    The rows are written once as they come; the place in the written files is
    the last sort key, so the order is the same when a task is run again, and a run
    of equal keys (a hot key) is split over several partitions. Rows read from
    written files need no second copy: with ``placed`` their :func:`row_place` is in
    ``df`` (and left out of the result). The sorted rows are written to the shared folder
    as compressed files, which fixes their partitions and cuts the lineage; a row's id is its
    place in its file after the rows of the files before (:func:`with_place_id`).
    ``drop``: columns that are needed for the order only.
    """
    spark = df.sparkSession
    if not placed:
        staged = scratch_path(spark, "row-ids")
        df.write.parquet(staged, compression=SCRATCH_CODEC)
        df = spark.read.schema(df.schema).parquet(staged).select("*", *row_place())
    ordered = df.orderBy(*_cols(order_by), "__file", "__row").drop("__file", "__row", *drop)
    path = scratch_path(spark, "ordered")
    ordered.write.parquet(path, compression=SCRATCH_CODEC)
    return with_place_id(spark.read.schema(ordered.schema).parquet(path), out)


def with_place_id(df: DataFrame, out: str = "id") -> DataFrame:
    """Dense row ids 1..n of rows read whole from Parquet files that Spark wrote in order.
    The files' row counts (one row per file, so bounded by the partitions of the write,
    not by the data) give offsets that are broadcast back."""
    place = {"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")}
    counts = df.select(place["__file"].alias("__file")).groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    number = F.regexp_extract("__file", r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy(number, "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    res = df.select("*", *(c.alias(name) for name, c in place.items())).join(F.broadcast(offsets), "__file")
    return res.select((F.col("__off") + F.col("__row") + 1).alias(out), *[F.col(c) for c in df.columns])


# ---- I: set operations and reshaping ------------------------------------

def append_records(existing: DataFrame, new: DataFrame, order_by: Sequence[str],
                   id_col: str = "id") -> DataFrame:
    """Bag union. Stored rows keep their ids and are not touched; the new
    rows get ``count(existing) + 1 ...`` in their own order. Of the stored rows
    only the count is read."""
    stored = existing.agg(F.count(F.lit(1)).alias("n")).scalar()
    fresh = with_row_id(new, order_by, out=id_col).withColumn(id_col, F.col(id_col) + stored)
    return existing.unionByName(fresh.select(*existing.columns))


_WORD, _BLOCK = 6, 12            # 2^6 ids a word of a mask, 2^12 ids a block


def deleted_ranks(ids: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """Rank structure over deleted ids of 1..n: a row per block of 2^12 ids
    with the number of ids deleted in lower blocks (``before``), and where the block
    has any, 64-bit masks of its 64 words with the number deleted before each
    word of the block. ``ids`` may repeat."""
    at = ids.select((F.col(id_col).cast("long") - 1).alias("__at")).select(
        F.shiftright("__at", _BLOCK).alias("block"),
        (F.shiftright("__at", _WORD) % (1 << _BLOCK - _WORD)).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, cast(__at % {1 << _WORD} as int))").alias("mask"))
    words = at.groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
    held = words.groupBy("block").agg(
        F.sum(F.bit_count("mask")).alias("here"),
        F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("by_word"))      # at most 64
    spark = ids.sparkSession
    blocks = spark.range(0, (n + (1 << _BLOCK) - 1) >> _BLOCK).withColumnRenamed("id", "block").join(held, "block", "left")
    # running sums in two levels: within 2^12 blocks, and over those groups
    group = F.shiftright("block", _BLOCK)
    own = F.coalesce("here", F.lit(0))
    inner = Window.partitionBy("group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    grouped = blocks.withColumn("group", group)
    groups = (grouped.groupBy("group").agg(F.sum(own).alias("__all"))
              .select("group", F.coalesce(F.sum("__all").over(outer), F.lit(0)).alias("__lower")))
    placed = grouped.withColumn("__inner", F.coalesce(F.sum(own).over(inner), F.lit(0))).join(groups, "group")
    places = F.sequence(F.lit(0), F.lit((1 << _BLOCK - _WORD) - 1))
    masks = F.when(F.col("here").isNotNull(), F.transform(places, lambda w: F.coalesce(F.element_at("by_word", w), F.lit(0).cast("long"))))
    return (placed.select("block", (F.col("__lower") + F.col("__inner")).alias("before"), masks.alias("masks"))
            .withColumn("lower", F.transform("masks", lambda _, i: F.aggregate(
                F.slice("masks", 1, i), F.lit(0), lambda acc, m: acc + F.bit_count(m)))))


def delete_records(df: DataFrame, ids: DataFrame, id_col: str = "id", check: bool = True) -> DataFrame:
    """Remove rows by id, then renumber 1..n in the stored order (that of
    the ids). An unknown id is an error (with ``check``).

    The stored ids are dense (:func:`with_row_id`), so a row's new id is its id less the number
    of deleted ids below it. That is read from :func:`deleted_ranks`: the stored rows meet
    one row a block of 4,096 ids, broadcast by Spark's own size check up to some
    10^9 rows with few deletions, and are neither sorted nor written. Ids that are not
    dense (count, bounds and a 64-bit mark of the ids tell) are numbered anew by
    :func:`with_row_id`."""
    def summary(column: str) -> list[Column]:
        return [F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"),
                F.bit_xor(F.xxhash64(F.col(column).cast("long"))).alias("mark")]

    stored = df.agg(F.count(F.lit(1)).alias("rows"), *summary(id_col)).first()
    n = stored.rows
    dense = stored.n == n and stored[1:] == df.sparkSession.range(1, n + 1).agg(*summary("id")).first()
    gone = ids.select(id_col)
    if check:
        unknown = (gone.filter(~F.col(id_col).between(1, n) | F.col(id_col).isNull()) if dense else
                   gone.join(df.select(id_col), id_col, "left_anti"))
        probe = unknown.limit(1).collect()
        if probe:
            raise KeyError(f"record id {probe[0][0]} not found")
    if not dense:
        kept = df.join(gone, id_col, "left_anti")
        return with_row_id(kept, [id_col], out="__new").drop(id_col).withColumnRenamed("__new", id_col) \
            .select(*df.columns)
    ranks = deleted_ranks(gone.filter(F.col(id_col).between(1, n)), n, id_col)
    place = F.col(id_col).cast("long") - 1
    rows = df.withColumns({
        "__block": F.shiftright(place, _BLOCK),
        "__word": (F.shiftright(place, _WORD) % (1 << _BLOCK - _WORD)).cast("int") + 1,
        "__bit": (place % (1 << _WORD)).cast("int")}).join(ranks, F.col("__block") == F.col("block"))
    mask = F.coalesce(F.element_at("masks", F.col("__word")), F.lit(0).cast("long"))
    lower = F.coalesce(F.element_at("lower", F.col("__word")), F.lit(0))
    rows = rows.withColumn("__mask", mask).filter(
        F.expr("shiftright(__mask, __bit) & 1L") == 0)
    below = F.expr("bit_count(__mask & ~shiftleft(-1L, __bit))")
    new_id = (F.col(id_col) - F.col("before") - lower - below).cast(df.schema[id_col].dataType)
    return rows.withColumn(id_col, new_id).select(*df.columns)


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            var: str = "variable", val: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(values), var, val)
