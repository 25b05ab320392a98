"""Exact de-duplication with a heavy-hitter split (native DataFrame code but
for the Misra-Gries counters).

Texts are equal when identical after lower-casing A-Z (null counts as empty);
of equal texts the row with the largest doc_id stays (null ids last). The
SHA-256 digest of the normalised text stands for the text.

1. One pass over the texts writes (row, doc_id, digest); later steps read only
   that table.
2. Misra-Gries: each partition keeps at most ``counters`` digests with lower
   bounds of their counts. Bounds are summed over partitions. All bounds
   together are at most the row count n, so at most ``counters`` + 1 digests
   have a bound of n / (counters + 1) or more: the table of heavy digests has
   a proven size whatever the data is, and every digest of more than
   2 n / (counters + 1) rows is in it.
3. The heavy digests are verified: exact counts and winners, summed map-side.
   They are broadcast, and rows of heavy digests get their result (or are
   dropped) where they are read: a group with a third of all rows never moves.
4. The other rows go through an ordinary shuffle on the digest, in groups of at
   most 2 n / (counters + 1) rows.

Defined cases: null and empty texts are one group; repeated rows (same id and
text) count as rows of their group and exactly one of them stays, by place in
the written table; an empty table gives an empty result; other columns are
ignored by :func:`exact_groups` and returned unchanged by
:func:`drop_exact_copies`, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.storage import materialise

COUNTERS = 1000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the UTF-8 text with A-Z lower-cased."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), 256)


def misra_gries(batches: Iterator[list], counters: int) -> dict:
    """At most ``counters`` values with lower bounds of their counts; a bound
    is too low by at most rows / (counters + 1). Batches are added as counts;
    then the (counters + 1)-th largest count is taken off every value."""
    kept: Counter = Counter()
    for values in batches:
        kept.update(values)
        if len(kept) > counters:
            cut = sorted(kept.values(), reverse=True)[counters]
            kept = Counter({v: c - cut for v, c in kept.items() if c > cut})
    return kept


def _partition_counters(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = misra_gries((b.column(0).to_pylist() for b in batches), counters)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(kept), pa.string()), "bound": pa.array(list(kept.values()), pa.int64())})
    return run


def heavy_groups(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified heavy digests: (digest, n, winner_id, winner_row), at most
    ``counters`` + 1 rows. ``digests`` has (row_id, doc_id, digest)."""
    rows = digests.agg(F.count(F.lit(1)).alias("n")).scalar()
    bounds = (digests.select("digest")
              .mapInArrow(_partition_counters(counters), "digest string, bound long")
              .groupBy("digest").agg(F.sum("bound").alias("bound")))
    heavy = materialise(
        bounds.filter((F.col("bound") > 1) & (F.col("bound") * (counters + 1) >= rows)).select("digest"),
        "heavy-digests")
    exact = (digests.join(F.broadcast(heavy), "digest", "left_semi")
             .groupBy("digest")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.max(F.struct(F.col("doc_id"), (-F.col("row_id")).alias("later"))).alias("top")))
    return materialise(
        exact.select("digest", "n", F.col("top.doc_id").alias("winner_id"),
                     (-F.col("top.later")).alias("winner_row")), "heavy-groups")


def digest_rows(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, digest) written once; row_id only names the row."""
    return materialise(
        docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                    text_digest(F.col("text")).alias("digest")), "digests")


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256."""
    digests = digest_rows(docs)
    heavy = heavy_groups(digests, counters)
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    marked = (digests.join(F.broadcast(heavy), "digest", "inner")
              .select("doc_id", F.col("winner_id").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("row_id") == F.col("winner_row")).alias("kept"),
                      F.col("digest").alias("text_sha256")))
    group = Window.partitionBy("digest")
    best = group.orderBy(F.col("doc_id").desc_nulls_last(), F.col("row_id"))
    light = (digests.join(F.broadcast(heavy), "digest", "left_anti")
             .select("doc_id", F.max("doc_id").over(group).alias("keep_id"),
                     F.count(F.lit(1)).over(group).alias("group_size"),
                     (F.row_number().over(best) == 1).alias("kept"),
                     F.col("digest").alias("text_sha256")))
    return marked.select(*out).unionByName(light.select(*out))


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns. Rows of heavy groups
    are thinned to their winner's id where they are read; what remains is cut
    to one row per digest, partially before the shuffle."""
    heavy = heavy_groups(digest_rows(docs), counters).select("digest", "winner_id")
    # the row travels as one struct, so none of its columns can clash
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         text_digest(F.col("text")).alias("digest"))
    thinned = (tagged.join(F.broadcast(heavy), "digest", "left")
               .filter(F.col("winner_id").isNull() | F.col("row.doc_id").eqNullSafe(F.col("winner_id"))))
    best = Window.partitionBy("digest").orderBy(F.col("row.doc_id").desc_nulls_last(), F.col("row.text"))
    return (thinned.withColumn("place", F.row_number().over(best))
            .filter(F.col("place") == 1)
            .select("row.*"))
