"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit verification.

Texts are compared as sequences of words in lower case (punctuation, symbols, spaces
and controls part words).  The CGK walk copies the symbol under a pointer to its output at every step and then
moves the pointer on or not, as a random function of (step, symbol) tells.  Two
texts at a small edit distance give outputs at a small Hamming distance, as both
pointers fall into step again after an edit.  Sampling ``SAMPLES`` output steps
gives an LSH key; ``WALKS`` independent walks with ``TABLES`` samples each repeat
that until the target recall is reached (``repetitions``).

Windows are short, so that edits leave some of an item's windows alone, and they
start all over the item: an item of ``LONG`` words or more at each minimizer of its word
pairs, so that an item and its copy within a document start at the same words, a
shorter one at every position.  An item is found if one key of one window is the same,
and its begin is told from the window by the words before it.  A key that took its
symbols from fewer places than its class asks for says little and is left out on both
sides; an item without any other key uses a smaller size class.

Keys of documents are tested in the task against a bitmap of the items' keys of
at most ``MAX_BITS`` bits, whatever the number of items; survivors are joined with
the items by key.  Then every candidate place is aligned with its item; the
exact edit distance in words decides.

Defined results: null, empty or wordless texts and items match nothing; null ids
are carried as null; repeated rows are found once; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import (WordHashes, batches_of, bitmap, in_bitmap, in_python, map_rows, mix,
                                  only_listed, rows_of, seeds, signed)
from courtline.session import materialize

_PARTING = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_ASCII = bytes(range(128))
MAX_EDIT_SHARE = 0.15
TARGET_RECALL = 0.95
#: Steps on which the walks of an item and a copy at the threshold agree.
AGREEMENT = 0.7
SAMPLES = 4
WALKS = 2
MINIMIZER = 3
#: Items of so many words have minimizers enough that some outlive the edits.
LONG = 13
#: Window sizes, with the item lengths from which they are used and the places that a
#: key's symbols must come from.
CLASSES = {1: (1, 1), 2: (2, 1), 3: (3, 1), 4: (4, 2), 6: (10, 4)}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def repetitions(recall: float = TARGET_RECALL, agreement: float = AGREEMENT,
                samples: int = SAMPLES) -> int:
    """Keys needed to meet in one of them with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement ** samples))


TABLES = -(-repetitions() // WALKS)


@functools.lru_cache(1 << 16)
def parts(char: str) -> bool:
    return unicodedata.category(char)[0] in "PSZC"


def words_of(text: str | None) -> list[bytes]:
    if not text:
        return []
    text = text.lower()
    data = text.encode("utf-8", "surrogatepass")
    if not text.isascii():
        # its characters beyond ASCII, each looked at once
        for char in set(data.translate(None, _ASCII).decode("utf-8", "surrogatepass")):
            if parts(char):
                data = data.replace(char.encode("utf-8", "surrogatepass"), b" ")
    return data.translate(_PARTING).split()


def steps_of(size: int) -> int:
    """Steps that a walk makes within ``size`` words: two for a word, less a margin."""
    return max(1, round(1.6 * size))


def sampled_steps(size: int, walk: int, table: int) -> list[int]:
    """The sampled steps of a key, ascending (all, if there are no more)."""
    n = steps_of(size)
    if n <= SAMPLES:
        return list(range(n))
    order = np.argsort(mix(np.arange(n, dtype=np.uint64) + seeds(1, size * 1009 + walk * 101 + table)))
    return sorted(order[:SAMPLES].tolist())


def telling(size: int, walk: int, table: int) -> np.ndarray:
    """Whether a key's symbols come from places enough, by the moves of the walk
    before its last sample (a bit for each step)."""
    steps = sampled_steps(size, walk, table)
    path = np.arange(1 << steps[-1])
    places = np.ones(len(path), np.int64)
    for a, b in itertools.pairwise(steps):
        places += (path & ((1 << b) - (1 << a))) > 0
    return places >= CLASSES[size][1]


class Embedder:
    """Keys of windows for the size classes in use."""

    def __init__(self, sizes: list[int]):
        self.sizes = sorted(sizes)
        self.steps = steps_of(self.sizes[-1]) if sizes else 0
        self.salts = [seeds(1, 7000 + w) for w in range(WALKS)]
        self.plan: list[dict[int, list[int]]] = []  # walk -> step -> keys that sample it
        self.key_size = [(c, w, t) for w in range(WALKS) for c in self.sizes for t in range(TABLES)]
        self.telling = [telling(*key) for key in self.key_size]
        for walk in range(WALKS):
            at: dict[int, list[int]] = {}
            for i, (c, w, t) in enumerate(self.key_size):
                if w == walk:
                    for s in sampled_steps(c, w, t):
                        at.setdefault(s, []).append(i)
            self.plan.append(at)

    def keys(self, symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size class, which of the starts have the key, their keys); ``symbols`` ends
        with enough padding for a walk of ``self.steps`` steps from any start."""
        for walk in range(WALKS):
            salts, at = self.salts[walk], self.plan[walk]
            if not at:
                continue
            held = {i: np.full(len(starts), seeds(1, c * 1009 + w * 101 + t)[0])
                    for i, (c, w, t) in enumerate(self.key_size) if w == walk}
            left = {i: len(sampled_steps(*self.key_size[i])) for i in held}
            bits = mix(symbols ^ salts[0])
            pointer, path = starts.copy(), np.zeros(len(starts), np.int64)
            for step in range(max(at) + 1):
                under = bits[pointer]
                for i in at.get(step, ()):
                    held[i] *= _BASE
                    held[i] += under
                    left[i] -= 1
                    if not left[i]:
                        has = np.flatnonzero(self.telling[i][path])
                        yield self.key_size[i][0], has, mix(held.pop(i)[has])
                under >>= np.uint64(step)
                under &= np.uint64(1)
                moves = under.view(np.int64)
                pointer += moves
                path += moves << step


def minimizers(symbols: np.ndarray, w: int = MINIMIZER) -> np.ndarray:
    """Positions whose word pair has the least hash among ``w`` neighbours;
    windows must lie within ``symbols``."""
    if len(symbols) < w + 1:
        return np.zeros(0, np.int64)
    pair = mix(symbols[:-1] * _BASE + symbols[1:])
    n = len(pair) - w + 1
    least = pair[:n].copy()
    for k in range(1, w):
        np.minimum(least, pair[k:k + n], out=least)
    chosen = np.zeros(len(pair), bool)
    for k in range(w):
        chosen[k:k + n] |= pair[k:k + n] == least
    return np.flatnonzero(chosen)


def padded(symbols: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each followed by ``pad`` zeros; and their starts."""
    lengths = np.array([len(s) + pad for s in symbols])
    out = np.zeros(int(lengths.sum()), np.uint64)
    firsts = np.r_[0, np.cumsum(lengths)[:-1]]
    for a, s in zip(firsts.tolist(), symbols, strict=True):
        out[a:a + len(s)] = s
    return out, firsts


# -- items ------------------------------------------------------------------

_ITEM_KEYS = pa.schema([("ref", pa.int64()), ("size", pa.int32()), ("skip", pa.int32()),
                        ("everywhere", pa.bool_()), ("key", pa.int64())])


def item_starts(symbols: np.ndarray) -> tuple[np.ndarray, bool]:
    """The words skipped by an item's windows, and whether they start everywhere."""
    if len(symbols) < LONG:
        return np.arange(len(symbols)), True
    return minimizers(symbols), False


def windows_of(symbols: np.ndarray, embedders: dict[int, Embedder]) -> tuple[int, bool, list[tuple[int, int]]]:
    """(size class, whether matched at every position, (words skipped, key) of each window)."""
    for size in sorted((c for c, (least, _) in CLASSES.items() if least <= len(symbols)), reverse=True):
        e = embedders.setdefault(size, Embedder([size]))
        data, _ = padded([symbols], e.steps + 1)
        starts, every = item_starts(symbols)
        starts = starts[starts <= len(symbols) - size]
        found = [(skip, key) for _, has, keys in e.keys(data, starts)
                 for skip, key in zip(starts[has].tolist(), signed(keys).tolist(), strict=True)]
        if found:
            return size, every, found
    raise AssertionError("windows of one word have all their keys")


def item_keys(items: DataFrame) -> DataFrame:
    """One row per item (ref, text), window start and key."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        hashes, embedders = WordHashes(), {}
        for ref, text in rows:
            symbols = hashes.of(words_of(text))
            if not len(symbols):
                continue
            size, every, found = windows_of(symbols, embedders)
            for skip, key in found:
                yield ref, size, skip, every, key

    return map_rows(items, run, "ref long, size int, skip int, everywhere boolean, key long", _ITEM_KEYS)


# -- documents --------------------------------------------------------------

_FOUND = pa.schema([("uid", pa.int64()), ("start", pa.int64()), ("key", pa.int64())])


def survivors(docs: DataFrame, sizes: dict[int, bool], table, pad: int) -> DataFrame:
    """(uid, start, key) of document windows whose key is in the bitmap.
    ``sizes`` tells which classes start everywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        at_marks = Embedder([c for c, every in sizes.items() if not every])
        everywhere = Embedder([c for c, every in sizes.items() if every])

        def search(uids: list[int], texts: list[np.ndarray]) -> Iterator[tuple]:
            data, firsts = padded(texts, pad)
            inside = data != 0  # no word hashes to zero but by a chance of 2^-64
            for embedder, starts in ((at_marks, lambda: minimizers(data)),
                                     (everywhere, lambda: np.arange(len(data)))):
                if not embedder.sizes:
                    continue
                places = starts()
                places = places[inside[places]]
                for a in range(0, len(places), 1 << 16):
                    part = places[a:a + (1 << 16)]
                    for _, has, keys in embedder.keys(data, part):
                        hit = in_bitmap(keys, table.value)
                        for p, k in zip(part[has[hit]].tolist(), signed(keys[hit]).tolist(), strict=True):
                            doc = int(np.searchsorted(firsts, p, "right")) - 1
                            yield uids[doc], p - int(firsts[doc]), k

        def rows():
            uids, texts, size = [], [], 0
            for uid, text in rows_of(batches):
                symbols = hashes.of(words_of(text))
                if len(symbols):
                    uids.append(uid)
                    texts.append(symbols)
                    size += len(symbols)
                if size > 1 << 19:
                    yield from search(uids, texts)
                    uids, texts, size = [], [], 0
            if texts:
                yield from search(uids, texts)

        yield from batches_of(rows(), _FOUND, 1 << 14)

    return in_python(docs, run, "uid long, start long, key long")


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edit distance, begin, end) of the best fit of the whole item to a part of
    the region: insertions, deletions and substitutions of words cost 1."""
    ramp = np.arange(len(region) + 1)
    cost, begin = np.zeros(len(region) + 1, np.int64), ramp.copy()
    for i, w in enumerate(item):
        down, cross = cost + 1, np.r_[i + 1, cost[:-1] + (region != w)]
        took = cross <= down
        here = np.where(took, cross, down)
        origin = np.where(took, np.r_[0, begin[:-1]], begin)
        # running minimum along the row: each word of the region skipped costs 1
        low = np.minimum.accumulate(here - ramp)
        first = np.maximum.accumulate(np.where(here - ramp == low, ramp, 0))
        cost, begin = low + ramp, origin[first]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


_MATCH = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("item_id", pa.int64()),
                    ("n_words", pa.int64()), ("edits", pa.int64()), ("begin", pa.int64()),
                    ("end", pa.int64())])


def stretches(begins: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """First and last of the begins that lie within ``reach`` of each other."""
    begins, at = sorted(begins), 0
    for i in range(1, len(begins) + 1):
        if i == len(begins) or begins[i] > begins[at] + reach:
            yield begins[at], begins[i - 1]
            at = i


def verified(places: DataFrame, share: float) -> DataFrame:
    """``places`` (doc_id, uid, text, list of (item_id, item, begins)) to matches."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()
        for doc, uid, text, spots in rows:
            symbols = hashes.of(words_of(text))
            best: dict[int, tuple[int, int, int, int]] = {}
            for s in spots:
                item = hashes.of(words_of(s["item"]))
                n, found = len(item), s["item_id"]
                most = int(share * n)
                # windows of one copy tell begins that differ by its edits
                for low, high in stretches(s["begins"], 2 * most):
                    a = max(0, low - 2 * most)
                    region = symbols[a:max(0, high) + n + 2 * most]
                    # a word that the region lacks is an edit
                    if np.isin(item, region).sum() < n - most or best.get(found, (1,))[0] == 0:
                        continue
                    edits, b, e = align(item, region)
                    if edits <= most:
                        best[found] = min(best.get(found, (n, 0, 0, n)), (edits, a + b, a + e, n))
            for item_id, (edits, b, e, n) in best.items():
                yield doc, uid, item_id, n, edits, b, e

    return map_rows(places, run, "doc_id long, uid long, item_id long, n_words long, edits long, "
                                 "begin long, end long", _MATCH)


def identity(doc_id: str, text: str) -> Column:
    """Tells rows apart, those without an id as well."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text",
               max_edit_share: float = MAX_EDIT_SHARE) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, the
    item's ``n_words``, ``edits`` (edit distance in words, at most
    ``max_edit_share`` of them) and the words ``begin`` to ``end`` of the best
    place; ``uid`` identifies the row of ``docs`` (see ``identity``)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       identity(doc_id, text).alias("uid"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("item"))
    items = items.withColumn("ref", identity("item_id", "item")).dropDuplicates(["ref"])
    keys = materialize(item_keys(items.select("ref", "item")), "item_keys")
    used = keys.groupBy("size").agg(F.max("everywhere").alias("every"), F.count(F.lit(1)).alias("n"))
    used = used.collect()  # at most one row per class
    if not used:
        return spark.createDataFrame([], verified(docs.select("doc_id", "uid", "text", F.array()), 0).schema)
    sizes = {r["size"]: r["every"] for r in used}
    table = spark.sparkContext.broadcast(bitmap(keys, sum(r["n"] for r in used)))
    pad = steps_of(max(sizes)) + 1
    found = materialize(survivors(docs.select("uid", "text"), sizes, table, pad), "survivors")
    places = found.join(keys, "key").groupBy("uid", "ref").agg(
        F.collect_set(F.col("start") - F.col("skip")).alias("begins"))
    spots = places.join(items, "ref").groupBy(F.col("uid").alias("of")).agg(F.collect_list(
        F.struct("item_id", "item", "begins")).alias("spots"))
    spots = materialize(spots, "spots")
    held = only_listed(docs, "uid", spots.select("of")).dropDuplicates(["uid"])
    return verified(held.join(spots, F.col("uid") == F.col("of")).select(
        "doc_id", "uid", "text", "spots"), max_edit_share)


def drop_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
               **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    leaked = find_leaks(docs, items, doc_id, text, **options).select(F.col("uid").alias("_leaked")).distinct()
    return docs.join(leaked, identity(doc_id, text) == F.col("_leaked"), "left_anti")
