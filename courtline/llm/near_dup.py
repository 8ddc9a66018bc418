"""MinHash near-duplicates with odd sketches.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
``HASHES`` MinHash values are cut into bands, and documents that agree on a band
share a bucket.  The same values fold into an odd sketch: each (index, value)
flips one bit of a small bitmap, so the XOR of two bitmaps counts the values in
which two documents differ, most precisely when they differ in few.  A second bitmap holds
the parities of the whole set: its XOR count is at most the symmetric difference,
so it drops pairs without ever dropping a link, most of them where sets are not
much larger than the bitmap.  The candidates left are confirmed on the full sets.

The work stays linear in the size of a group of copies:

* documents with equal sets form a class, aggregated before anything else, and
  only its smallest id goes on;
* first, each member of a bucket is compared with the bucket's pivot; buckets of
  different bands take different pivots (``PIVOTS`` orders of the ids), so that a
  large group of near copies is joined through several of them;
* pairs of members are compared only in buckets that still hold several
  components after that, in tiles of bounded size, by sketch, and only across
  components.  No pair is skipped otherwise: a bucket of any size is covered.

Links become components by label propagation with pointer jumping.

Missed links: at Jaccard 0.85, a pair shares no band of 5 in 24 with probability
(1 - 0.85^5)^24 < 1e-6; it differs in 18 of 120 values on average, and the sketch
drops pairs from 6.5 standard deviations above that on.

Defined results: a null, empty or wordless text has an empty set, links with
nothing and is its own component; shorter texts than five words are one shingle;
rows without an id link with nothing, their component is null and they are kept;
repeated rows are one class and each gets its row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import (WordHashes, batches_of, in_python, lower_words, map_rows, mix, only_listed,
                                  rows_of, seeds, signed)
from courtline.session import materialize

WIDTH = 5
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
SKETCH_BITS = 512
PARITY_BITS = 2048
PERCENT = 85
#: Sketches drop a pair this many standard deviations beyond the threshold.
MARGIN = 6.5
PIVOTS = 8
TILE = 1024

_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[bytes], hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of the word shingles, sorted."""
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    n = min(width, len(h))
    code = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        code = code * _BASE + h[k:len(h) - n + 1 + k]
    return np.unique(mix(code))


class Signer:
    """MinHash values, band keys and odd sketch of a set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS):
        n = bands * rows
        self.bands, self.rows, self.bits = bands, rows, bits
        self.factor = (seeds(n, 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.shift = (seeds(n, 2) >> np.uint64(32)).astype(np.uint32)
        self.index = seeds(n, 3)

    def minima(self, items: np.ndarray, step: int = 4096) -> np.ndarray:
        low = np.full(len(self.factor), 0xFFFFFFFF, np.uint32)
        x = (items >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(x), step):
            part = np.multiply.outer(self.factor, x[a:a + step])
            part += self.shift[:, None]
            np.minimum(low, part.min(axis=1), out=low)
        return low

    def keys(self, minima: np.ndarray) -> np.ndarray:
        code = np.arange(self.bands, dtype=np.uint64)
        parts = minima.astype(np.uint64).reshape(self.bands, self.rows)
        for k in range(self.rows):
            code = mix(code * _BASE + parts[:, k])
        return code

    def sketch(self, minima: np.ndarray) -> bytes:
        at = mix(self.index + minima) % np.uint64(self.bits)
        odd = np.bincount(at.astype(np.int64), minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()


def parities(items: np.ndarray, bits: int = PARITY_BITS) -> bytes:
    """The parity of the number of set members in each of ``bits`` cells."""
    odd = np.bincount((items % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches (rows of words) allow a link; ``sizes`` adds up the
    sizes of each pair's sets."""
    flipped = np.bitwise_count(one ^ two)
    cut = SKETCH_BITS // 64
    values = flipped[:, :cut].sum(axis=1, dtype=np.int64)
    members = flipped[:, cut:].sum(axis=1, dtype=np.int64)
    return ((values < most_differing_bits(percent))
            & (members * (100 + percent) <= sizes * (100 - percent)))


def most_differing_bits(percent: int, hashes: int = HASHES, bits: int = SKETCH_BITS) -> int:
    """XOR count expected of a pair that differs in as many values as a pair at the
    threshold ever does; a value that differs flips two bits."""
    share = 1 - percent / 100
    values = hashes * share + MARGIN * math.sqrt(hashes * share * (1 - share))
    return math.ceil(bits / 2 * (1 - math.exp(-4 * values / bits))) + 1


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                     ("sketch", pa.binary()), ("keys", pa.list_(pa.int64()))])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, set size, digest of the set, odd sketch and band keys."""

    def sign(rows: Iterator[tuple]) -> Iterator[tuple]:
        hashes, signer = WordHashes(), Signer()
        for doc, text in rows:
            items = shingles(lower_words(text), hashes)
            if not len(items):
                yield doc, 0, None, None, None
                continue
            low = signer.minima(items)
            yield (doc, len(items), xxhash.xxh3_128_digest(items.tobytes()),
                   signer.sketch(low) + parities(items),
                   signed(signer.keys(low)).tolist())

    return map_rows(docs, sign, "doc_id long, n_shingles long, digest binary, sketch binary, "
                                "keys array<long>", _SIGNED)


_SETS = pa.schema([("doc_id", pa.int64()), ("items", pa.list_(pa.int64()))])


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and set of the documents that may be among the ``ids``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        return batches_of(((doc, signed(shingles(lower_words(text), hashes)))
                           for doc, text in rows_of(batches)), _SETS)

    return only_listed(docs, "doc_id", ids, sets, "doc_id long, items array<long>")


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach ``percent`` Jaccard similarity."""
    small = reps.select("doc_id", "n_shingles", "sketch")
    one, two = (small.select(*(F.col(c).alias(f"{c}_{x}") for c in small.columns)) for x in "ab")
    near = (pairs.join(one, F.col("a") == F.col("doc_id_a")).join(two, F.col("b") == F.col("doc_id_b"))
            .filter(100 * F.least("n_shingles_a", "n_shingles_b")
                    >= percent * F.greatest("n_shingles_a", "n_shingles_b")))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                one, two = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint64)
                            .reshape(b.num_rows, -1) for i in (2, 3))
                ok = pa.array(may_link(one, two, b.column(4).to_numpy(), percent))
                yield pa.RecordBatch.from_arrays([b.column(i).filter(ok) for i in range(2)],
                                                 names=["a", "b"])

    sizes = F.col("n_shingles_a") + F.col("n_shingles_b")
    near = in_python(near.select("a", "b", "sketch_a", "sketch_b", sizes), similar, "a long, b long")
    near = materialize(near, "candidates")
    ids = materialize(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    # the texts stay where they are: their sets are made there, and few are moved
    sets = shingle_sets(docs, ids).dropDuplicates(["doc_id"])
    sets = materialize(sets.join(ids, F.col("doc_id") == F.col("id"), "left_semi"), "sets")
    one = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b"))
    both = F.size(F.array_intersect("items_a", "items_b"))
    linked = near.join(two, "b").join(one, "a").filter(
        100 * both >= percent * (F.size("items_a") + F.size("items_b") - both))
    return materialize(linked.select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for
    every node that has a link."""
    edges = materialize(links.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(
        links.select("b", "a")).distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("src").alias("node")).agg(
        F.min("dst").alias("x")).select("node", F.least("node", "x").alias("label")), "labels")
    while True:
        told = (edges.join(labels, F.col("src") == F.col("node"))
                .groupBy(F.col("dst").alias("to")).agg(F.min("label").alias("heard")))
        further = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        step = (labels.join(told, F.col("node") == F.col("to"))
                .join(further, F.col("label") == F.col("via"))
                .select("node", F.least("label", "heard", "beyond").alias("label"),
                        (F.least("heard", "beyond") < F.col("label")).alias("changed")))
        step = materialize(step, "labels")
        labels = step.select("node", "label")
        if step.filter("changed").isEmpty():
            return labels


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def across_components(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of bucket members in different components whose sizes and sketches
    allow a link.  ``members``: key, rep, pivot, label, n_shingles, sketch.

    A bucket is dealt into parts of about TILE rows and a task sees two parts at
    a time, so its memory does not depend on the bucket.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    parts = F.ceil(F.col("size") / TILE).cast("int")
    dealt = members.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
    tiles = dealt.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")).select(
        "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "rep", "pivot", "label", "n_shingles", "sketch")
    tiles = tiles.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (_, low, high), group in groupby(rows_of(batches), key=lambda r: r[:3]):
                group = list(group)
                if len(group) > 1:
                    yield from tile_pairs(group, low != high, percent)
        yield from batches_of(rows(), _PAIRS, 1 << 14)

    return in_python(tiles, run, "a long, b long").distinct()


def tile_pairs(rows: list[tuple], between: bool, percent: int) -> Iterator[tuple[int, int]]:
    part, rep, label, size = (np.array([r[i] for r in rows]) for i in (3, 4, 6, 7))
    tested = rep == np.array([r[5] for r in rows])  # the pivot met all members before
    sketch = np.frombuffer(b"".join(r[8] for r in rows), np.uint64).reshape(len(rows), -1)
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        ok = (label[rest] != label[i]) & ~tested[rest] & (not tested[i])
        if between:
            ok &= part[rest] != part[i]
        ok &= 100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])
        at = np.flatnonzero(ok) + i + 1
        if len(at):
            near = may_link(sketch[at], sketch[i:i + 1], size[at] + size[i], percent)
            for j in at[near].tolist():
                yield int(min(rep[i], rep[j])), int(max(rep[i], rep[j]))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signs = materialize(signatures(docs), "signatures")
    usable = signs.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = materialize(usable.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = materialize(usable.join(classes, F.col("doc_id") == F.col("rep"), "left_semi")
                       .dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "sketch", "keys"), "reps")

    # XOR with a constant reorders the ids; the least of each order is the pivot
    orders = F.array(*(F.lit(int(x)) for x in signed(seeds(PIVOTS, 4) >> np.uint64(1))))
    banded = reps.select(F.col("doc_id").alias("rep"), F.posexplode("keys").alias("band", "key"))
    banded = banded.select("rep", "key", F.get(orders, F.col("band") % PIVOTS).alias("order"))
    buckets = banded.groupBy("key").agg(F.min(F.col("rep").bitwiseXOR(F.col("order"))).alias("least"),
                                        F.count(F.lit(1)).alias("n"))
    members = materialize(banded.join(buckets.filter("n > 1").drop("n"), "key").select(
        "key", "rep", F.col("least").bitwiseXOR(F.col("order")).alias("pivot")), "members")

    first = members.filter("rep <> pivot").select(F.least("pivot", "rep").alias("a"),
                                                  F.greatest("pivot", "rep").alias("b"))
    links = confirmed(first.distinct(), reps, docs, percent)
    labels = components(links)

    labelled = members.join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "pivot", F.coalesce("label", "rep").alias("label"))
    labelled = materialize(labelled, "labelled")
    # the pivot has met every other member, so only buckets with two more matter
    mixed = labelled.filter("rep <> pivot").groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    open_members = labelled.join(mixed, "key").join(
        reps.select(F.col("doc_id").alias("rep"), "n_shingles", "sketch"), "rep")
    more = confirmed(across_components(open_members, percent), reps, docs, percent)
    if not more.isEmpty():
        labels = components(links.union(more))

    found = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("digest").alias("of"), F.coalesce("label", "rep").alias("component"))
    # copies share a digest: the join may be skewed there, and AQE splits it
    out = signs.select("doc_id", "n_shingles", "digest").join(found, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id."""
    dropped = near_duplicates(docs, doc_id, text, percent).filter("not kept").select(
        F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, F.col(doc_id) == F.col("_dropped"), "left_anti")
