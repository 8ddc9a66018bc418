"""Fill-in-the-middle transformation on a piece table.

A document is a list of descriptors ``(buffer, start, length)`` over two buffers
that never change: its own UTF-8 bytes and the sentinels.  Cutting a document
splits descriptors, an arrangement permutes them, and only the final write copies
bytes.  Hashes read the descriptors one by one, so a hash needs no copy either.

``transform_documents`` cuts at line ends that a SHA-256 of the seed and the id
chooses, and writes the parts as plain text, psm (``<P>`` prefix ``<S>`` suffix
``<M>`` middle) or spm (``<S>`` suffix ``<P>`` prefix ``<M>`` middle).
``restore_documents`` needs the output and its form only: it cuts at the sentinels,
drops them and applies the inverse permutation.

Defined results: a null text is an empty one, and an empty text, or one that holds
a sentinel, stays plain.  A null id hashes as the empty string.  Repeated ids and
rows are transformed each on its own.  A task holds one Arrow batch and writes
output in batches of some 8 MB, so only a single text need fit in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import in_python, rows_of

PREFIX, SUFFIX, MIDDLE = SENTINELS = (b"<P>", b"<S>", b"<M>")

#: Parts of a text by number: prefix 0, middle 1, suffix 2.  The order in which each
#: form writes them, and the sentinel in front of each.
ORDERS = {"psm": ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), "spm": ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}

#: Bytes of output texts in one Arrow batch.
BATCH_BYTES = 8 << 20

_SENTINEL = re.compile(b"|".join(SENTINELS))
_MARKS = b"".join(SENTINELS)
_TEXT, _ADD = 0, 1


class PieceTable:
    """Descriptors over a text buffer and the sentinel buffer."""

    def __init__(self, text: bytes, pieces: list[tuple[int, int, int]] | None = None):
        self.buffers = (memoryview(text), memoryview(_MARKS))
        self.pieces = [(_TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, spots: Iterable[int]) -> PieceTable:
        """The table with a piece boundary at each of the ascending byte ``spots``, so
        that n spots make n + 1 pieces of a table of one piece (empty ones stay)."""
        spots, out, at = list(spots), [], 0
        for buffer, start, length in self.pieces:
            end = at + length
            while spots and spots[0] <= end:
                size = spots.pop(0) - at
                out.append((buffer, start, size))
                at, start, length = at + size, start + size, length - size
            out.append((buffer, start, length))
            at = end
        return PieceTable(self.buffers[_TEXT], out)

    def arrange(self, order: Iterable[tuple[int, bytes]]) -> PieceTable:
        """The pieces in another order, each behind a sentinel (``b""`` for none)."""
        out = []
        for piece, mark in order:
            if mark:
                out.append((_ADD, _MARKS.index(mark), len(mark)))
            out.append(self.pieces[piece])
        return PieceTable(self.buffers[_TEXT], out)

    def chunks(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start:start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk)
        return digest.hexdigest()

    def write(self) -> bytes:
        return b"".join(self.chunks())


def count_chars(chunk) -> int:
    """Code points of UTF-8 bytes: all bytes but continuation bytes."""
    return len(bytes(chunk).translate(None, bytes(range(0x80, 0xC0))))


def count_lines(text: bytes) -> int:
    """Units ``[^\\n]*\\n|[^\\n]+``."""
    return text.count(b"\n") + (bool(text) and not text.endswith(b"\n"))


def line_end(text: bytes, k: int) -> int:
    """The byte after the first ``k`` units."""
    at = 0
    for _ in range(k):
        at = text.find(b"\n", at) + 1
        if at == 0:
            return len(text)
    return at


def choose(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = hashlib.sha256(key).hexdigest()
    return tuple(int(h[i:i + 8], 16) for i in (0, 8, 16, 24))


def arrange_text(text: bytes, doc_id: int | None, seed: int, fim_percent: int, spm_percent: int
                 ) -> tuple[int, str, int | None, int | None, PieceTable]:
    """n, form, prefix_chars, middle_chars and the arranged table of one text."""
    n = count_lines(text)
    h1, h2, h3, h4 = choose(doc_id, seed)
    table = PieceTable(text)
    if not text or h3 % 100 >= fim_percent or _SENTINEL.search(text):
        return n, "plain", None, None, table
    form = "spm" if h4 % 100 < spm_percent else "psm"
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first = line_end(text, low)
    parts = table.cut((first, first + line_end(text[first:], high - low)))
    prefix, middle, _ = map(count_chars, parts.chunks())
    return n, form, prefix, middle, parts.arrange(ORDERS[form])


def restore_text(output: bytes, form: str) -> PieceTable:
    """The text's table, over the buffer of its output."""
    table = PieceTable(output)
    if form == "plain":
        return table
    if form not in ORDERS:
        raise ValueError(f"unknown form {form!r}")
    order, spots, at = ORDERS[form], [], 0
    for _, mark in order:  # no part holds a sentinel, so the first hit is the sentinel itself
        start = output.find(mark, at)
        if start < 0 or (not spots and start):
            raise ValueError(f"no {mark.decode()} where {form} has it")
        at = start + len(mark)
        spots += [start, at]
    # pieces 0, 2, 4 end before a sentinel and 1, 3, 5 are sentinels: part i is piece 2 i + 2
    inverse = {part: 2 * i + 2 for i, (part, _) in enumerate(order)}
    return table.cut(spots).arrange((inverse[part], b"") for part in range(3))


def _batches(rows: Iterable[tuple], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += size_of(row) + 200
        if held >= BATCH_BYTES:
            yield _batch(part, schema)
            part, held = [], 0
    if part:
        yield _batch(part, schema)


def _batch(part: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)


_DONE = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                   ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                   ("output", pa.binary()), ("output_sha256", pa.string())])


def transform_documents(docs: DataFrame, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50,
                        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars (null if plain), output (the
    text, null for none as empty) and output_sha256 of each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for i, body in rows_of(batches):
                *facts, table = arrange_text(body or b"", i, seed, fim_percent, spm_percent)
                yield i, *facts, table.write(), table.sha256()

        return _batches(rows(), _DONE, lambda row: len(row[5]))

    raw = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    out = in_python(raw, run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                              "output binary, output_sha256 string")
    return out.withColumn("output", F.col("output").cast("string"))


_BACK = pa.schema([("text", pa.binary()), ("restored_sha256", pa.string())])


def restore_documents(outputs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``outputs`` without ``output``, with the exact text it was made from as ``text``
    and its ``restored_sha256``.  A row whose output lacks a sentinel of its form
    fails the job; a null output is an empty plain one."""
    rest = [c for c in outputs.columns if c not in (output, "text", "restored_sha256")]
    work = outputs.select(F.struct(*rest).alias("rest"), F.col(output).cast("binary").alias("o"),
                          F.coalesce(F.col(form), F.lit("plain")).alias("f"))
    schema = work.select("rest", F.col("o").alias("text"), F.col("f").alias("restored_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tables = (restore_text(o or b"", f) for o, f in rows_of([b.select([1, 2])]))
            at = 0
            for part in _batches(((t.write(), t.sha256()) for t in tables), _BACK, lambda row: len(row[0])):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, part.num_rows), *part.columns], names=["rest", *_BACK.names])
                at += part.num_rows

    return in_python(work, run, schema).select(
        "rest.*", F.col("text").cast("string").alias("text"), "restored_sha256")
