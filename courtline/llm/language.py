"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in segments of ``SEGMENT`` bytes.  In each, one recurrent layer runs
from the left and one from the right; at every byte both states meet in a softmax
over the languages, so that every position has a label.  A document's probabilities
are the mean over all its positions, whatever its length.

The network is trained in numpy by backpropagation through time (Adam on the cross
entropy of every position) on a bounded sample: at most ``MAX_ROWS`` documents, as
many of each language, and of each ``SEGMENTS_PER_DOC`` stretches of
``TRAIN_SEGMENT`` bytes spread over the whole text.  Training sees text and language
only.  The sample is drawn by a hash of the text, and the first weights by a fixed
seed, so that the same table trains the same network.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and
for every text if there is nothing to learn from.  Null and repeated ids, repeated
rows and further columns change nothing.  The languages are all non-null values of
the usable rows; their list goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.common import in_python

#: Units of each direction.
HIDDEN = 12
#: Bytes that the network reads from zero states when it predicts and when it learns.
SEGMENT, TRAIN_SEGMENT = 128, 64
#: Documents that are learned from, and stretches of each.
MAX_ROWS, SEGMENTS_PER_DOC = 6_000, 4
#: Segments that are read side by side: with them the arrays of a step stay in cache.
WIDTH = 1024
BATCH, EPOCHS, RATE = 256, 6, 0.02

UNDETERMINED = "und"
PAD = 256
#: Input of the update gate that a pad gives: the gate is 1 and the state stays as it is.
_HOLD = 60.0


@dataclass(frozen=True)
class Network:
    """``table`` (2, 3 H, 257): what each byte adds to the gates r, z and the candidate,
    of either direction; ``recur`` (2, 3 H, H); ``out`` (2, L, H); ``bias`` (L, 1)."""

    table: np.ndarray
    recur: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.table, self.recur, self.out, self.bias


def start(languages: int, hidden: int, seed: int = 1, dtype=np.float32) -> Network:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.3, (2, 3 * hidden, PAD + 1))
    recur = rng.normal(0, hidden ** -0.5, (2, 3 * hidden, hidden))
    out = rng.normal(0, (2 * hidden) ** -0.5, (2, languages, hidden))
    table[:, :, PAD] = 0
    table[:, hidden:2 * hidden, PAD] = _HOLD
    return Network(*(a.astype(dtype) for a in (table, recur, out, np.zeros((languages, 1)))))


def _gate(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def read(net: Network, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, 2, H, segments) of the segments ``x`` (steps, segments) of bytes and
    pads at their ends.  Step t has read byte t from the left, and byte -1 - t from
    the right.  ``keep`` receives what backpropagation needs."""
    steps, width = x.shape
    hidden = net.recur.shape[2]
    states = np.empty((steps, 2, hidden, width), net.table.dtype)
    h = np.zeros((2, hidden, width), net.table.dtype)
    gates, back = np.empty((2, 3 * hidden, width), net.table.dtype), np.empty((2, 3 * hidden, width), net.table.dtype)
    for t in range(steps):
        np.take(net.table[0], x[t], axis=1, out=gates[0], mode="clip")
        np.take(net.table[1], x[steps - 1 - t], axis=1, out=gates[1], mode="clip")
        np.matmul(net.recur, h, out=back)
        rz = gates[:, :2 * hidden]
        rz += back[:, :2 * hidden]
        _gate(rz)
        r, z, n = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        pulled = back[:, 2 * hidden:]
        if keep is not None:
            keep.append((h, pulled.copy()))
        pulled *= r
        n += pulled
        np.tanh(n, out=n)
        if keep is not None:
            keep[-1] += (gates.copy(),)
        # h' = n + z (h - n)
        new = states[t]
        np.subtract(h, n, out=new)
        new *= z
        new += n
        h = new
    return states


def position_probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """(steps, languages, segments): the softmax at every position."""
    z = np.matmul(net.out[0], states[:, 0])
    z += np.matmul(net.out[1], states[::-1, 1])
    z += net.bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def gradients(net: Network, x: np.ndarray, labels: np.ndarray) -> tuple[float, tuple[np.ndarray, ...]]:
    """The mean cross entropy of all positions that hold a byte, and its gradients."""
    keep: list = []
    states = read(net, x, keep)
    p = position_probabilities(net, states)
    steps, width = x.shape
    hidden = net.recur.shape[2]
    real = (x != PAD).astype(p.dtype)
    total = real.sum()
    here = p[:, labels, np.arange(width)]
    loss = float(-(np.log(np.maximum(here, 1e-30)) * real).sum() / total)

    p[:, labels, np.arange(width)] -= 1
    p *= (real / total)[:, None, :]
    d_out = np.stack([np.einsum("tlb,thb->lh", p, states[:, 0], optimize=True),
                      np.einsum("tlb,thb->lh", p, states[::-1, 1], optimize=True)])
    d_bias = p.sum(axis=(0, 2))[:, None]
    into = np.stack([np.matmul(net.out[0].T, p), np.matmul(net.out[1].T, p)[::-1]], axis=1)

    d_table, d_recur = np.zeros_like(net.table), np.zeros_like(net.recur)
    d_gates = np.empty((steps, 2, 3 * hidden, width), p.dtype)
    d_h = np.zeros((2, hidden, width), p.dtype)
    up = net.recur.transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        h, pulled, gates = keep[t]
        r, z, n = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        d_h += into[t]
        d = d_gates[t]
        d_n = d_h * (1 - z) * (1 - n * n)
        d[:, :hidden] = d_n * pulled * r * (1 - r)
        d[:, hidden:2 * hidden] = d_h * (h - n) * z * (1 - z)
        d[:, 2 * hidden:] = d_n
        through = d.copy()
        through[:, 2 * hidden:] *= r
        d_recur += np.matmul(through, h.transpose(0, 2, 1))
        d_h = d_h * z + np.matmul(up, through)
    for side, bytes_read in ((0, x), (1, x[::-1])):
        spot = bytes_read.ravel()
        for unit in range(3 * hidden):
            d_table[side, unit] = np.bincount(spot, d_gates[:, side, unit].ravel(), PAD + 1)
    d_table[:, :, PAD] = 0
    return loss, (d_table, d_recur, d_out, d_bias)


def segments_of(bodies: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes joined, and each segment's begin in them and length."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    pieces = -(-lengths // size)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return data, np.repeat(first, pieces) + inside * size, np.minimum(size, np.repeat(lengths, pieces) - inside * size)


def matrix_of(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(steps, segments) of bytes, padded to the longest."""
    steps = np.arange(int(lengths.max()))[:, None]
    spots = np.minimum(begins + steps, len(data) - 1)
    return np.where(steps < lengths, data[spots].astype(np.intp), PAD)


def train_network(samples: list[tuple[bytes, int]], languages: int, hidden: int = HIDDEN, epochs: int = EPOCHS,
                  seed: int = 1) -> Network:
    """Adam over shuffled batches of (bytes, language number), its rate falling to zero."""
    net = start(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    data, begins, lengths = segments_of([s for s, _ in samples], TRAIN_SEGMENT)
    labels = np.array([k for _, k in samples])
    if len(begins) != len(labels):
        raise ValueError("samples are one segment each")
    mean = [np.zeros_like(a) for a in net.arrays()]
    square = [np.zeros_like(a) for a in net.arrays()]
    rounds, step = epochs * -(-len(labels) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            _, grads = gradients(net, matrix_of(data, begins[pick], lengths[pick]), labels[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            rate = RATE * 0.5 * (1 + np.cos(np.pi * step / rounds)) * min(1.0, 1.0 / max(norm, 1e-12))
            step += 1
            for a, g, m, v in zip(net.arrays(), grads, mean, square):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def pooled(net: Network, bodies: list[bytes], labels: list[np.ndarray] | None = None) -> np.ndarray:
    """(texts, languages): mean probabilities of all positions of non-empty texts.
    ``labels`` receives the number of the likeliest language of every byte, joined."""
    data, begins, lengths = segments_of(bodies, SEGMENT)
    owner = np.repeat(np.arange(len(bodies)), [-(-len(b) // SEGMENT) for b in bodies])
    sums = np.zeros((len(bodies), len(net.bias)))
    # segments of like length side by side: only a text's last one is short
    order = np.argsort(-lengths, kind="stable")
    marks = np.empty(len(data), np.uint8 if len(net.bias) < 256 else np.int32) if labels is not None else None
    for at in range(0, len(order), WIDTH):
        pick = order[at:at + WIDTH]
        x = matrix_of(data, begins[pick], lengths[pick])
        p = position_probabilities(net, read(net, x))
        real = x != PAD
        if marks is not None:
            marks[(begins[pick] + np.arange(len(x))[:, None])[real]] = p.argmax(axis=1)[real]
        p *= real[:, None, :]
        np.add.at(sums, owner[pick], p.sum(axis=0).T)
    if marks is not None:
        labels.append(marks)
    return sums / np.fromiter(map(len, bodies), np.float64, len(bodies))[:, None]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    network: Network | None


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def training_segments(docs: DataFrame, usable: Column, max_rows: int, text: str, lang: str) -> tuple[list[str], DataFrame]:
    """The languages, and (lang, segment) of at most ``max_rows`` documents: of each
    language those with the least hashes of their texts."""
    known = docs.filter(usable & F.col(lang).isNotNull() & has_letter(text)).select(
        F.col(lang).alias("lang"), F.col(text).alias("t"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    each = max(1, max_rows // max(1, len(counts)))
    # few more than ``each`` rows of a language reach the window below
    most = 2.0 ** 63
    line = {k: min(1.0, 4 * each / n) * 2 * most - most for k, n in counts.items()}
    below = F.create_map(*[F.lit(v) for kv in line.items() for v in kv]) if line else None
    hashed = known.withColumn("h", F.xxhash64("t"))
    if below is not None:
        hashed = hashed.filter(F.col("h").cast("double") <= below[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    picked = hashed.withColumn("rank", rank).filter(F.col("rank") <= each)
    body = F.col("t").cast("binary")
    room = F.greatest(F.lit(0), F.length(body) - TRAIN_SEGMENT)
    begins = F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.lit(SEGMENTS_PER_DOC - 1)),
        lambda i: F.floor(room * i / max(1, SEGMENTS_PER_DOC - 1)).cast("int")))
    cut = picked.select("lang", body.alias("body"), F.explode(begins).alias("begin")).select(
        "lang", F.substring("body", F.col("begin") + 1, F.lit(TRAIN_SEGMENT)).alias("segment"))
    return sorted(counts), cut


def train(docs: DataFrame, usable: Column, max_rows: int = MAX_ROWS, hidden: int = HIDDEN,
          text: str = "text", lang: str = "lang") -> Model:
    """A network of the languages of the ``usable`` rows.  The driver gets at most
    ``max_rows * SEGMENTS_PER_DOC`` segments of ``TRAIN_SEGMENT`` bytes."""
    languages, segments = training_segments(docs, usable, max_rows, text, lang)
    if not languages:
        return Model((), None)
    number = {name: k for k, name in enumerate(languages)}
    samples = sorted((bytes(r["segment"]), number[r["lang"]]) for r in segments.collect())
    return Model(tuple(languages), train_network(samples, len(languages), hidden))


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64())])


def predict_documents(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score (its pooled probability) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            letters = np.flatnonzero(b.column(2).to_numpy(zero_copy_only=False))
            names, scores = np.full(b.num_rows, UNDETERMINED, object), np.zeros(b.num_rows)
            if len(letters) and model.network is not None:
                p = pooled(model.network, b.column(3).take(pa.array(letters)).to_pylist())
                best = p.argmax(axis=1)
                names[letters] = np.array(model.languages, object)[best]
                scores[letters] = np.minimum(1.0, p[np.arange(len(p)), best])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names.tolist(), pa.string()), pa.array(scores)],
                schema=_PREDICTED)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), has_letter(text).alias("letter"),
                       F.col(text).cast("binary").alias("body"))
    return in_python(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


_LABELLED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                       ("runs", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                                    ("lang", pa.string())])))])


def label_positions(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes and the labels of all positions of each text, as runs of bytes
    with one label (end exclusive).  A text of ``und`` (see above) has no runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, letter, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                runs = []
                if letter and model.network is not None:
                    marks: list[np.ndarray] = []
                    pooled(model.network, [body], marks)
                    edges = np.flatnonzero(np.diff(marks[0])) + 1
                    spots = [0, *edges.tolist(), len(body)]
                    runs = [{"start": s, "end": e, "lang": model.languages[marks[0][s]]}
                            for s, e in zip(spots, spots[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([len(body or b"")], pa.int64()),
                     pa.array([runs], _LABELLED.types[2])], schema=_LABELLED)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), has_letter(text).alias("letter"),
                       F.col(text).cast("binary").alias("body"))
    return in_python(rows, run, "doc_id long, n_bytes long, "
                                "runs array<struct<start: long, end: long, lang: string>>")
