"""Best-fit packing by a length histogram.

Documents become pieces of at most ``capacity`` tokens.  Best fit is planned on
the histogram of piece lengths, so the plan's size depends on the capacity and
not on the number of documents; then each piece takes a planned slot by joining
on its rank within its length.

Planning: lengths are taken from long to short.  Best fit puts a piece where
the least room remains, and that place, having become tighter, takes further
pieces of the same length as long as they fit.  So all sequences with one
remaining room are filled alike and stay together as a run of sequence numbers;
only a length's last sequences split a run.  A length splits at most two runs
and opens at most two, so there are at most 4 * capacity runs, and a plan row
for each (length, run) filled; the planner works on these alone.

Defined results: a null or empty text is one piece holding only the end id;
null ids, equal texts and repeated rows are packed as separate documents; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import load_encoding, map_rows
from courtline.llm.ranks import number_within
from courtline.session import materialize

_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` tokens: the first takes the remainder."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int, end_id: int,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the CRC-32 of its ids
    as little-endian unsigned 32-bit numbers.  The ids equal those of the ``tokenizers``
    file of the same vocabulary (tested over all code points), at some five times its
    speed."""

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        enc = load_encoding(vocabulary, pattern)
        for doc, t in rows:
            ids = enc.encode_ordinary(t) if t else []
            ids.append(end_id)
            data = np.array(ids, "<u4")
            starts = cut(len(ids), capacity)
            for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                yield doc, i, a, b - a, zlib.crc32(data[a:b])

    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return map_rows(ids, pieces, _SCHEMA, _ARROW)


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Best fit over counts: rows (length, first_rank, n_ranks, per_sequence,
    sequence, offset) and the number of sequences.

    Rank r of a length lies in the row with first_rank <= r < first_rank +
    n_ranks; with j = r - first_rank it goes to sequence + j // per_sequence at
    offset + (j % per_sequence) * length.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, count)
    rooms: list[int] = []  # rooms with runs, ascending
    rows, opened = [], 0

    def add(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens in sequences of {capacity}")
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room, first = capacity, opened
                count = -(-left // (capacity // length))
                opened += count
            each = room // length
            full = min(count, left // each)
            if full:
                rows.append((length, rank, full * each, each, first, capacity - room))
                add(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count and left:
                # fewer pieces are left than this one sequence could take
                rows.append((length, rank, left, left, first + full, capacity - room))
                add(room - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            add(room, first + full, count - full)
    return rows, opened


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset.  ``pieces`` should be a written
    table: it is read for the histogram, the ranks and the result."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # <= capacity rows
    histogram = {r["length"]: r["n"] for r in counts}
    rows, _ = plan(histogram, capacity)
    # from Arrow the JVM makes the frame itself; a list of rows would start Python workers
    # of another kind, which stay
    names = ["slot_length", "first_rank", "n_ranks", "per_sequence", "sequence", "at"]
    slots = spark.createDataFrame(pa.table(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names))
    ranked = number_within(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], "rank",
                           sum(histogram.values()))
    j = F.col("rank") - F.col("first_rank")
    # the plan is bounded by the capacity, see above
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length"))
                         & (j >= 0) & (j < F.col("n_ranks")))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.expr("(rank - first_rank) div per_sequence")).alias("sequence_id"),
        (F.col("at") + j % F.col("per_sequence") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024,
                   end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents to packed pieces: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.  Texts are read once; their pieces are written to the
    shared folder, a few dozen bytes each."""
    pieces = token_pieces(docs, vocabulary, pattern, capacity, end_id, doc_id, text)
    return pack(materialize(pieces, "pieces"), capacity)
