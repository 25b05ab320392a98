"""Near-duplicates by MinHash: many universal hash minima, banding, signature
verification, exact verification on full shingle sets, and connected
components by alternating large-star and small-star.

A document's set has its distinct runs of five words (see
:mod:`ledgerline.llm.textscan`); with fewer words it is the whole sequence as one
run, without words it is empty and linked with nothing. Two documents are
linked when 100 * intersection >= percent * union.

1. One pass over the texts writes set size, a digest of the set and
   ``HASHES`` minima. Equal sets are one class, represented by its smallest
   doc_id; only representatives go on, so copies are never paired.
2. The minima are cut into bands. The number of minima per band is the largest
   for which a pair just at the threshold shares no band with a chance of at
   most ``MISS``. Representatives that agree on a band share a bucket.
3. *Stars.* Each member of a bucket is paired with the bucket's smallest member:
   at most one pair per band and member, whatever the bucket's size. Of these
   the pair with most shared buckets is verified first, then components are
   formed.
4. *The rest.* Only pairs that could still join two components are left. The
   other star pairs are verified as they are. Of the buckets with members of two
   components and three or more members, those with the same members count once
   (the lowest band stays). A bucket's *rest* are its members outside its largest component:
   any open pair has one of them. The rest is dealt into blocks of about ``BLOCK``
   members, all members into chunks of about ``CHUNK``, and a task compares one block
   with one chunk, carrying signatures and sets. So a bucket whose
   rest fits one block and whose members fit one chunk, however often it is cut
   through by components, has each member in the work once; rows grow with
   members times blocks only for a larger rest. There a member
   meets only blocks of its own size class and the two next to it, classes being powers of
   the threshold, since sets of sizes further apart can't reach it. No
   bucket is in one task, no list of its pairs is made, and no pair is left out: a pair
   is compared in the first band that it shares, unless it is already connected.
5. A pair is verified first by its signatures (agreement of at least
   the threshold less five standard deviations), then exactly, on full sets.

Defined cases: null texts are empty; a null doc_id is never smallest, and rows
of a class without any id are linked with nothing; rows that share a doc_id are
one document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.components import connected_components
from ledgerline.llm.storage import materialise
from ledgerline.llm.textscan import mix, shingle_hashes, text_chunks, word_hashes, word_spans

HASHES = 256
MISS = 1e-6
BLOCK = 512
CHUNK = 2048
BROADCAST_IDS = 500_000

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


@dataclass(frozen=True)
class Bands:
    percent: int
    rows: int
    bands: int
    least_agreement: int

    @classmethod
    def of(cls, percent: int) -> Bands:
        s = percent / 100
        rows = max((r for r in range(1, HASHES + 1) if (1 - s ** r) ** (HASHES // r) <= MISS), default=1)
        least = math.floor(HASHES * (s - 5 * math.sqrt(s * (1 - s) / HASHES)))
        return cls(percent, rows, HASHES // rows, max(1, least))


def minima(shingles: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """One row of ``HASHES`` 32-bit minima per set; ``firsts`` has the index of
    each set's first element, all sets non-empty. Hash j of x is the upper half
    of factor_j * x + term_j mod 2^64 (multiply-shift, factors odd)."""
    out = np.empty((len(firsts), HASHES), dtype=np.uint32)
    if len(firsts) == 0:
        return out
    buffer = np.empty_like(shingles)
    for j in range(HASHES):
        np.multiply(shingles, _FACTORS[j], out=buffer)
        buffer += _TERMS[j]
        out[:, j] = np.minimum.reduceat(buffer, firsts) >> np.uint64(32)
    return out


def _sets(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, shingles, offsets by row) by chunk."""
    for lo, hi, data, offsets in text_chunks(texts):
        starts, ends, doc_words = word_spans(data, offsets)
        shingles, bounds = shingle_hashes(word_hashes(data, starts, ends), doc_words)
        yield lo, hi, shingles, bounds


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for _, _, shingles, bounds in _sets(batch.column(1)):
            full = bounds[:-1] < bounds[1:]
            rows = iter(minima(shingles, bounds[:-1][full]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if a == b:
                    sizes.append(0)
                    digests.append(None)
                    signatures.append(None)
                    continue
                distinct = np.unique(shingles[a:b])
                sizes.append(len(distinct))
                digests.append(hashlib.blake2b(distinct.tobytes(), digest_size=16).digest())
                signatures.append(next(rows).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "set_digest", "signature"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(shingles[a:b]).tobytes() for _, _, shingles, bounds in _sets(batch.column(1))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])


def _signature_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def _band_rows(plan: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = _signature_matrix(batch.column(1)).astype(np.uint64)
            keys = np.empty((len(signatures), plan.bands), dtype=np.uint64)
            for band in range(plan.bands):
                key = np.full(len(signatures), band + 1, dtype=np.uint64)
                for j in range(band * plan.rows, (band + 1) * plan.rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, j])
                keys[:, band] = key
            reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), plan.bands)
            bands = np.tile(np.arange(plan.bands, dtype=np.int32), len(signatures))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(bands), pa.array(reps, pa.int64())],
                ["bucket", "band", "rep"])
    return run


def _linked(x: bytes, y: bytes, percent: int) -> bool:
    """The exact rule, on two full sets."""
    a, b = (np.frombuffer(z, dtype=np.uint64) for z in (x, y))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _block_links(plan: Bands):
    """Links between the rest members of a block (``own``) and the members of a
    chunk (``other``) of a bucket. A pair is compared in the first band that it shares,
    unless it is known to be connected; a pair of two rest members where the
    one with the larger id is ``own``."""
    def run(table: pa.Table) -> pa.Table:
        band = table["band"][0].as_py()
        reps, labels, sizes = (table[c].to_numpy() for c in ("rep", "component", "n_shingles"))
        rest, own, other = (table[c].to_numpy().astype(bool) for c in ("rest", "own", "other"))
        signatures = _signature_matrix(table["signature"])
        sets = table["shingles"]
        root = {label: label for label in labels.tolist()}

        def top(label: int) -> int:
            while root[label] != label:
                root[label] = root[root[label]]
                label = root[label]
            return label

        others = np.flatnonzero(other)
        a, b = [], []
        for i in np.flatnonzero(own).tolist():
            small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
            against = others[(labels[others] != labels[i]) & (~rest[others] | (reps[others] < reps[i]))
                             & (100 * small >= plan.percent * large)]
            same = signatures[against] == signatures[i]
            against, same = (x[same.sum(axis=1) >= plan.least_agreement] for x in (against, same))
            shared = same[:, :plan.bands * plan.rows].reshape(len(against), plan.bands, plan.rows).all(axis=2)
            for j in against[shared.argmax(axis=1) == band].tolist() if len(against) else ():
                if top(labels[i]) != top(labels[j]) and _linked(sets[i].as_py(), sets[j].as_py(), plan.percent):
                    root[top(labels[i])] = top(labels[j])
                    a.append(reps[i])
                    b.append(reps[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _dealt(placed: DataFrame, plan: Bands) -> DataFrame:
    """The members of mixed buckets by block and chunk: (bucket, band, rep,
    component, n_shingles, rest, cell, own, other), a row for each cell that a member is in.
    ``placed``: written (bucket, band, rep, component, n_shingles)."""
    parts = placed.groupBy("bucket", "band", "component").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
    whole = parts.groupBy("bucket", "band").agg(
        F.sum("m").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.count(F.lit(1)).alias("parts"),
        F.max(F.struct("m", (-F.col("component")).alias("minus"))).alias("main"))
    mixed = (whole.filter(F.col("parts") > 1).groupBy("n", "x", "y")
             .agg(F.min(F.struct("band", "bucket", "main")).alias("b"))
             .select("b.bucket", "n", (-F.col("b.main.minus")).alias("main"),
                     (F.col("n") - F.col("b.main.m") > BLOCK).alias("wide")))
    step = math.log(100 / plan.percent) if plan.percent < 100 else 1.0
    size_class = F.when(F.col("wide"), F.floor(F.log("n_shingles") / step)).otherwise(0).cast("int")
    members = materialise(
        placed.join(mixed, "bucket")
        .withColumns({"rest": F.col("component") != F.col("main"), "class": size_class,
                      "chunks": F.ceil(F.col("n") / CHUNK).cast("int")})
        .withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(2)), "chunks").cast("int"))
        .drop("n", "main"), "mixed-members")
    blocks = (members.filter("rest").groupBy("bucket", F.col("class").alias("of")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    # classes that a member's sets can reach; one more for rounding at their edges
    near = F.when(F.col("wide"), F.sequence(F.col("class") - 2, F.col("class") + 2)).otherwise(F.array(F.lit(0)))
    met = (members.withColumn("of", F.explode(near)).join(blocks, ["bucket", "of"])
           .withColumn("home", F.pmod(F.xxhash64("rep", F.lit(3)), "blocks"))
           .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("own", F.col("rest") & (F.col("of") == F.col("class")) & (F.col("block") == F.col("home")))
           .withColumn("in", F.when(F.col("own"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk")))
           .withColumn("into", F.explode("in")))
    return met.select("bucket", "band", "rep", "component", "n_shingles", "rest", F.struct("of", "block", "into").alias("cell"),
                      "own", (F.col("into") == F.col("chunk")).alias("other"))


def _agreeing(plan: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = (_signature_matrix(batch.column(2)) == _signature_matrix(batch.column(3))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(same >= plan.least_agreement))
    return run


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                linked.append(_linked(x.as_py(), y.as_py(), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(linked, pa.bool_()))
    return run


def with_ids(docs: DataFrame, ids: DataFrame, how: str, column: str = "id") -> DataFrame:
    """Rows of ``docs`` whose doc_id is (left_semi) or isn't (left_anti) among
    ``ids``. Up to ``BROADCAST_IDS`` ids are broadcast, so no text moves; more
    are joined by a shuffle."""
    ids = materialise(ids.select(F.col(column).alias("id")).distinct(), "ids")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rows = docs.select(F.col("doc_id").alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(F.broadcast(ids) if few else ids, F.col("key") == F.col("id"), how).select("row.*")


def _pairs_with(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """(a, b, value of a, value of b)."""
    of_a = values.select(F.col("id").alias("a"), F.col(column).alias("value_a"))
    of_b = values.select(F.col("id").alias("b"), F.col(column).alias("value_b"))
    return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "value_a", "value_b")


def _few_files(pairs: DataFrame, name: str) -> DataFrame:
    """Written pairs. They are few beside the sets that they were found with, so they get files by
    their own size and not one from each task that carried sets (on a local file system
    Hadoop starts processes for each file)."""
    return materialise(pairs.hint("rebalance"), name)


def near_classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: fingerprints of all rows (doc_id, n_shingles, set_digest),
    classes (set_digest, rep, component) and exact links between
    representatives (a, b) that the components were formed by."""
    plan = Bands.of(percent)
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "n_shingles long, set_digest binary, signature binary").fields])
    prints = materialise(docs.select("doc_id", "text").mapInArrow(_fingerprints, schema), "fingerprints")
    first = Window.partitionBy("set_digest").orderBy(F.col("doc_id").asc_nulls_last())
    reps = materialise(
        prints.filter(F.col("n_shingles") > 0)
        .withColumn("place", F.row_number().over(first)).filter(F.col("place") == 1)
        .select("set_digest", F.col("doc_id").cast("long").alias("rep"), "n_shingles", "signature"), "representatives")
    named = reps.filter(F.col("rep").isNotNull())
    signatures = named.select(F.col("rep").alias("id"), "signature")

    bands = named.select("rep", "signature").mapInArrow(_band_rows(plan), "bucket long, band int, rep long")
    buckets = materialise(bands.groupBy("bucket").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("n"))
                          .filter(F.col("n") > 1), "buckets")
    members = materialise(bands.join(buckets, "bucket"), "bucket-members")
    stars = materialise(members.filter(F.col("rep") != F.col("center"))
                        .groupBy(F.col("rep").alias("a"), F.col("center").alias("b"))
                        .agg(F.count(F.lit(1)).alias("shared")), "star-pairs")

    candidates = members.select(F.col("rep").alias("id"))
    sets = materialise(with_ids(docs.select("doc_id", "text"), candidates, "left_semi")
                       .mapInArrow(_full_sets, "id long, shingles binary").dropDuplicates(["id"]), "shingle-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        alike = _pairs_with(pairs, signatures, "signature").mapInArrow(_agreeing(plan), "a long, b long")
        alike = _few_files(alike, "alike-pairs")
        return _few_files(_pairs_with(alike, sets, "shingles").mapInArrow(_exact(percent), "a long, b long"), "links")

    best = Window.partitionBy("a").orderBy(F.col("shared").desc(), F.col("b"))
    ranked = stars.withColumn("place", F.row_number().over(best))
    links = verified(ranked.filter(F.col("place") == 1).select("a", "b"))
    labels = materialise(connected_components(links, "a", "b"), "labels")

    def labelled(rows: DataFrame, column: str, out: str) -> DataFrame:
        return (rows.join(labels.select(F.col("node").alias(column), F.col("component").alias(out)), column, "left")
                .withColumn(out, F.coalesce(out, column)))

    other_stars = (labelled(labelled(ranked.filter(F.col("place") > 1).select("a", "b"), "a", "of_a"), "b", "of_b")
                   .filter(F.col("of_a") != F.col("of_b")).select("a", "b"))
    placed = materialise(labelled(members.filter(F.col("n") > 2), "rep", "component")
                         .join(named.select("rep", "n_shingles"), "rep")
                         .select("bucket", "band", "rep", "component", "n_shingles"), "placed-members")
    dealt = materialise(_dealt(placed, plan), "dealt-members")
    carried = signatures.join(sets, "id").withColumnRenamed("id", "rep")
    in_blocks = (dealt.join(carried, "rep").groupBy("bucket", "cell")
                 .applyInArrow(_block_links(plan), "a long, b long"))
    late = verified(other_stars).unionByName(_few_files(in_blocks, "block-links"))
    components = connected_components(
        labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late), "a", "b")
    classes = materialise(
        reps.select("set_digest", "rep")
        .join(components.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("set_digest", "rep", F.coalesce("component", "rep").alias("component")), "classes")
    return prints.select("doc_id", "n_shingles", "set_digest"), classes, links.unionByName(late)


def near_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    prints, classes, _ = near_classes(docs, percent)
    found = (prints.filter(F.col("n_shingles") > 0).join(classes, "set_digest")
             .select("doc_id", "n_shingles", F.col("component").alias("component_id")))
    empty = prints.filter(F.col("n_shingles") == 0).select(
        "doc_id", "n_shingles", F.col("doc_id").cast("long").alias("component_id"))
    return found.unionByName(empty).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that another one of their group stands
    for. Rows without an id stay."""
    gone = near_groups(docs, percent).filter(~F.col("kept") & F.col("doc_id").isNotNull())
    return with_ids(docs, gone, "left_anti", "doc_id")
