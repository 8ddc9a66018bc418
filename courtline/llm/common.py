"""Shared pieces of the training-data operators.

Words are runs of ``[^\\x20\\x09-\\x0D]`` unless an operator says otherwise, and
only A-Z is lower-cased, so that Spark, Python and SQL agree byte for byte.
"""

from __future__ import annotations

import base64
import functools
import itertools
import math
import string
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the largest bitmap that is broadcast (16 MB).
MAX_BITS = 1 << 27

SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"

_TO_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def lower_words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text, A-Z in lower case (``bytes.split`` cuts at exactly GAP)."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_LOWER).split() if text else []


def word_array(text: Column) -> Column:
    """Words of a column as an array, without empty ends."""
    return F.array_remove(F.split(text, GAP), "")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n, the split every learning query uses."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


class WordHashes(dict):
    """64-bit hashes of words, remembered while they fit ``size`` entries (some 20 MB)."""

    def __init__(self, size: int = 1 << 17):
        self.size = size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def seeds(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(seed))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: So many rows of a batch are Python values at once.
ROWS_AT_ONCE = 256


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for b in batches:
        for a in range(0, b.num_rows, ROWS_AT_ONCE):
            yield from zip(*(c.to_pylist() for c in b.slice(a, ROWS_AT_ONCE).columns), strict=True)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches of at most ``size`` rows."""
    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)],
            schema=schema)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the application, once, as
    ``--py-files`` would: they import the operators' functions by name."""
    app, package = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app in _SHIPPED or not package.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="courtline-code-")) / "courtline-code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


def release_memory() -> None:
    """Gives free memory back: Arrow's, and (by its malloc pool) the process's."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def in_python(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with the workers supplied with this package.  Workers
    outlive their tasks, so a task gives back what it no longer needs when it ends."""
    ship_code(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, fn, schema: str, arrow: pa.Schema) -> DataFrame:
    """``fn`` maps an iterator of row tuples to an iterator of row tuples, in
    Arrow batches; a task holds one batch at a time."""
    return in_python(df, lambda batches: batches_of(fn(rows_of(batches)), arrow), schema)


_PAGE = 1 << 13  # bytes of a bitmap that travel as one row
_PAGES = pa.schema([("page", pa.int64()), ("data", pa.binary())])


def bitmap(keys: DataFrame, n_keys: int) -> np.ndarray:
    """Bytes with two bits set for each ``key``; at most MAX_BITS bits, put together
    by Spark, so the driver receives its pages only."""
    bits = min(MAX_BITS, max(1 << 20, 1 << math.ceil(math.log2(64 * n_keys + 1))))
    spots = keys.select(F.explode(F.array(*(
        F.shiftrightunsigned("key", s).bitwiseAND(bits - 1) for s in (0, 32)))).alias("p"))
    cells = spots.groupBy(F.shiftright("p", 3).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(p & 7 as int))")).alias("bits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, value = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for page in np.unique(at // _PAGE).tolist():
                data, here = np.zeros(_PAGE, np.uint8), at // _PAGE == page
                data[at[here] % _PAGE] = value[here]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([page], pa.int64()), pa.array([data.tobytes()], pa.binary())],
                    schema=_PAGES)

    pages = in_python(cells.repartition(F.floor(F.col("at") / _PAGE)).sortWithinPartitions("at"), run,
                      "page long, data binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in pages.collect():
        out[r["page"] * _PAGE:(r["page"] + 1) * _PAGE] |= np.frombuffer(r["data"], np.uint8)
    return out


def in_bitmap(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions of the keys that may be in the table."""
    mask = np.uint64(len(table) * 8 - 1)
    hit = np.arange(len(keys))
    for s in (0, 32):
        p = (keys[hit] >> np.uint64(s)) & mask
        hit = hit[(table[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return hit


@functools.cache
def load_encoding(path: str, pattern: str):
    """A byte-level BPE by its tiktoken rank file, once in a worker for all operators;
    strings of special tokens in a text are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def only_listed(df: DataFrame, column: str, keys: DataFrame, then=None, schema=None) -> DataFrame:
    """The rows of ``df`` whose long ``column`` may be among the ``keys`` (a frame of
    one long column), before they are shuffled to meet them: no listed row is lost,
    and few others stay while there are fewer than MAX_BITS / 10 keys.  ``then`` maps
    the batches left to batches of ``schema`` in the same pass: a second one would
    take a second Python worker for each task."""
    spread = keys.select(F.xxhash64(keys.columns[0]).alias("key"))
    table = df.sparkSession.sparkContext.broadcast(bitmap(spread, keys.count()))
    schema = schema or df.schema

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            hit = in_bitmap(key.view(np.uint64), table.value)
            part = b.select(range(b.num_columns - 1))
            if len(hit):
                yield part.take(pa.array(hit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(listed(batches)) if then else listed(batches)

    return in_python(df.withColumn("_spread", F.xxhash64(column)), run, schema)
