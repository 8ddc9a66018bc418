"""Embedding whitening from a bit-sliced scatter matrix.

Every entry c of a vector is the whole number x = floor(1024 c) + 100000.  A task
takes its vectors in blocks.  Of each dimension it subtracts the block's least value
and packs every bit of the rest, across the rows, into 64-bit words (*planes*).  The
sum of products of two dimensions is then the sum, over pairs of their planes, of 2
to the power of the two bit numbers times the popcount of the AND: exact, with no
floating point.  Shifts are undone by integers as well.  Spark adds up the blocks'
sums as decimals; the driver receives one number per pair of dimensions, whatever
the rows, centres them as whole numbers (n * Sxy - Sx * Sy) and only then turns to
doubles for ``eigh``.

Defined results: vectors that are null, or hold a null, a NaN, an infinity or an
entry whose x does not fit a long (1024 |c| >= 2**62) are dropped.  The dimension of
the table is the commonest length of the rest, 0 aside (the larger of two as common);
vectors of other lengths have no coordinates in it and are dropped too.  Null and repeated ids stay, as do repeated vectors.  Directions without
variance (an eigenvalue of at most 1e-12 of the largest) cannot be whitened and have
no rows; a table with no such vectors, or with equal ones only, gives none at all.
A deviation beyond the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import in_python
from courtline.session import materialize

#: Rows of a block: 64-bit words per plane times 64.
BLOCK = 16_384

SCALE, SHIFT = 1024, 100_000
_LIMIT = 2.0 ** 62
FLAT = 1e-12


def usable(vector: str):
    """The rows whose vector has whole numbers for all its entries (see above)."""
    v = F.col(vector)
    return v.isNotNull() & F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                               & (F.abs(c.cast("double")) * SCALE < F.lit(_LIMIT))), F.lit(False))


def whole(batch_column: pa.Array, dimension: int) -> np.ndarray:
    """(rows, dimension) of x for a column of lists of equal length."""
    values = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).astype(np.int64).reshape(-1, dimension) + SHIFT


def planes(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(dimensions * bits, words) bit planes of a block of (rows, dimensions), the
    least value of each dimension, and the number of bits."""
    least = block.min(axis=0)
    rest = (block - least).astype(np.uint64)
    bits = max(1, int(rest.max()).bit_length())
    rows = -(-len(block) // 64) * 64
    out = np.zeros((block.shape[1], bits, rows // 8), np.uint8)
    for k in range(bits):
        bit = ((rest >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(bit, axis=0)
        out[:, k, :len(packed)] = packed.T
    return out.reshape(-1, rows // 8).view(np.uint64), least, bits


def scatter(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of the dimensions of a block, as Python integers."""
    words, least, bits = planes(block)
    rows, d = block.shape
    weight = np.array([1 << k for k in range(bits)], dtype=object)
    if 2 * bits + rows.bit_length() < 62:  # all weighted counts of a pair fit 64 bits
        weight = weight.astype(np.int64)
    products = np.zeros((d, d), dtype=weight.dtype)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).reshape(d, bits)
    for i in range(d):
        after = words[i * bits:]
        for k in range(bits):
            both = np.bitwise_count(after & words[i * bits + k]).sum(axis=1, dtype=np.int64)
            products[i, i:] += weight[k] * (both.reshape(d - i, bits) @ weight)
    products = products.astype(object)
    products = products + np.triu(products, 1).T
    shifted = (ones.astype(weight.dtype) @ weight).astype(object)
    m = least.astype(object)
    sums = shifted + rows * m
    return sums, products + np.outer(m, shifted) + np.outer(shifted, m) + rows * np.outer(m, m)


_SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])


def scatter_sums(vectors: DataFrame, dimension: int, vector: str) -> DataFrame:
    """(i, j, s): s the sum of products of dimensions i <= j, j = -1 for the sum of
    dimension i alone, (-1, -1) for the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, 0, 0
        held: list[np.ndarray] = []

        def flush() -> None:
            nonlocal n, sums, products
            block = np.concatenate(held)
            held.clear()
            s, p = scatter(block)
            n, sums, products = n + len(block), sums + s, products + p

        for b in batches:
            x = whole(b.column(0), dimension)
            while len(x):
                room = BLOCK - sum(map(len, held))
                held.append(x[:room])
                x = x[room:]
                if sum(map(len, held)) == BLOCK:
                    flush()
        if held:
            flush()
        if n:
            rows = [(-1, -1, n), *((i, -1, sums[i]) for i in range(dimension)),
                    *((i, j, products[i, j]) for i in range(dimension) for j in range(i, dimension))]
            i, j, s = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))], schema=_SUMS)

    parts = in_python(vectors.select(vector), run, "i int, j int, s decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("s").alias("s"))


class Whitening:
    """n, the sums S, the eigenvalues (falling) and their unit vectors (columns)."""

    def __init__(self, n: int, sums: list[int], products: dict[tuple[int, int], int], most: int):
        d = len(sums)
        covariance = np.zeros((d, d))
        for (i, j), s in products.items():
            # centred as whole numbers; the division of whole numbers rounds once
            covariance[i, j] = covariance[j, i] = (n * s - sums[i] * sums[j]) / (n * n)
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        keep = [k for k in range(min(most, d)) if values[k] > max(0.0, FLAT * values[0])]
        self.n, self.sums, self.dimension = n, sums, d
        self.values, self.vectors = values[keep], np.ascontiguousarray(vectors[:, keep])
        trace = float(np.trace(covariance))
        self.explained = [float(v / trace) for v in self.values]


def fit(vectors: DataFrame, dimension: int, vector: str, components: int) -> Whitening:
    """One pass over the vectors; the driver gets (dimension + 1) squared numbers at most."""
    found = {(r["i"], r["j"]): int(r["s"]) for r in scatter_sums(vectors, dimension, vector).collect()}
    return Whitening(found[-1, -1], [found[i, -1] for i in range(dimension)],
                     {k: s for k, s in found.items() if k[1] >= 0}, components)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, pa.Array]:
    """n x - S, and the exact sum of its squares in each row (null beyond a long)."""
    top = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    exact = x if top < 1 << 62 else x.astype(object)
    off = n * exact - np.array(sums, dtype=exact.dtype)
    rough = (off.astype(np.float64) ** 2).sum(axis=1)
    if exact is x:
        square = (off * off).sum(axis=1)  # modulo 2**64: right wherever the sum fits
    else:
        square = np.zeros(len(x), np.int64)
    lost = rough > 1.1 * 2.0 ** 63
    for row in np.flatnonzero((~lost) if exact is not x else (~lost & (rough > 0.9 * 2.0 ** 63))).tolist():
        total = sum(int(v) ** 2 for v in off[row])
        if total < 1 << 63:
            square[row] = total
        else:
            lost[row] = True
    return off, pa.array(square, mask=lost)


def whiten(vectors: DataFrame, model: Whitening, vec_id: str, vector: str) -> DataFrame:
    """vec_id, deviation (see ``whiten_embeddings``) and the whitened coordinates of
    each vector, as an array."""
    n, sums, d = model.n, model.sums, model.dimension
    axes = model.vectors / np.sqrt(model.values) / n
    k = axes.shape[1]
    id_type = vectors.schema[vec_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(at, BLOCK) for at in range(0, b.num_rows, BLOCK)):
                x = whole(part.column(1), d)
                off, square = deviations(x, n, sums)
                coordinates = off.astype(np.float64) @ axes
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), square,
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(0, k * len(x) + 1, k, dtype=np.int32)),
                         pa.array(coordinates.reshape(-1)))],
                    names=["vec_id", "deviation", "w"])

    return in_python(vectors.select(vec_id, vector), run, f"vec_id {id_type}, deviation long, w array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """The largest entry, without sign, of the coordinates' covariance minus the
    identity, from the whitened rows themselves."""
    means = white.agg(*[F.avg(F.col("w")[i]) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = white.agg(*[F.avg((F.col("w")[i] - means[i]) * (F.col("w")[j] - means[j])) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, got))


def whiten_embeddings(embeddings: DataFrame, components: int = 8, vec_id: str = "vec_id",
                      vector: str = "embedding") -> DataFrame:
    """One row per vector and component (1 = largest variance): vec_id, component, n
    (vectors of the fit, which are all that remain), deviation (the sum over the
    dimensions of (n x - S) squared, exact), whitened (x - S / n along the component,
    over the root of its variance), explained (its share of the total variance) and
    identity_error (see there).  The whitened coordinates are written once."""
    clean = embeddings.select(vec_id, vector).filter(usable(vector))
    sizes = clean.filter(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    schema = (f"vec_id {embeddings.schema[vec_id].dataType.simpleString()}, component int, n long, "
              "deviation long, whitened double, explained double, identity_error double")
    empty = embeddings.sparkSession.createDataFrame([], schema)
    if common is None:
        return empty
    rows = clean.filter(F.size(vector) == common["d"])
    model = fit(rows, common["d"], vector, components)
    if not len(model.values):
        return empty
    white = materialize(whiten(rows, model, vec_id, vector), "whitened")
    error = identity_error(white, len(model.values))
    explained = F.array(*[F.lit(v) for v in model.explained])
    return white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"))
