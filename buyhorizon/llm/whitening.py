"""Embedding whitening by contour integration (FEAST).

Vectors become integers, equal ones once; their covariance is gathered from integers
that were centred first, so it is right to the last digits. The spectrum is cut at
shifts whose inertia (the signs of a symmetric factorisation of V - shift) tells how
many eigenvalues lie above, until every interval that holds wanted ones holds few.
Each interval is a row of a Spark table: its task draws a random block of vectors,
applies the projector on the interval's eigenspace - a quadrature along a circle
around it, each point a complex shifted solve - and extracts eigenpairs by
Rayleigh-Ritz, again until the residuals vanish and the pairs are as many as the
inertia counts say. A last Rayleigh-Ritz over all intervals makes the components
orthogonal to double precision.

What passes through the driver is of the size of the dimension: sums, a covariance
matrix, intervals, components.

Defined results: rows whose vector is null, empty, or holds a null, NaN or infinite
entry are dropped, and so are rows of another length than the most frequent one (the
longer one of equally frequent ones); a null id is kept; repeated rows are whitened
each, but fitted once; there are as many components as V has eigenvalues above
rounding (none for a single distinct vector), ``most`` at most; an empty table gives no
rows; extra columns do not matter. Entries must lie within +-10^12 and n x the spread
within a long, else the job ends with an error rather than a wrong sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

#: Wanted eigenvalues of an interval at most, unless they lie closer than rounding.
PER_INTERVAL = 4
#: Quadrature points on the upper half of a circle.
POINTS = 8
#: An eigenvalue counts as zero below this share of the largest, times the dimension.
ZERO = 1e-13


def integers(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * c) + offset of every entry, or null if the vector is null, empty or has an entry that is not finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    made = F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + offset)
    return F.when((F.size(vector) > 0) & ~bad, made)


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows (id, x) whose x has the most frequent length, and that length (0: none)."""
    rows = rows.where("x IS NOT NULL")
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (most.d if most else 0)), most.d if most else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list<long> column."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _batches(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    """The rows in blocks of about a million entries."""
    step = max(1, 1_000_000 // d)
    for at in range(0, len(column), step):
        yield _matrix(column.slice(at, step), d)


@dataclass
class Moments:
    """Of the distinct vectors: their number, the sums of their entries, and the covariance (divisor n)."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def middle(self) -> np.ndarray:
        """Whole numbers next to the means."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """The means less those."""
        return np.array([s % self.n / self.n for s in self.sums])


def _combined(parts: DataFrame, width: int) -> tuple[int, list[int]]:
    """n and the entrywise sums of (n, sums) rows of tasks, exactly."""
    rows = parts.select("n", F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("n").alias("n")).collect()
    out, n = [0] * width, 0
    for r in rows:
        out[r.i], n = int(r.v), int(r.n)
    return n, out


def _summed(distinct: DataFrame, of, d: int) -> DataFrame:
    """(n, sums): per task, the row count and the sums of ``of(block)`` over blocks of vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for block in _batches(batch.column(0), d):
                own = of(block)
                if total is not None and np.abs(total.astype(float) + own.astype(float)).max() > 9e18:
                    yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "sums": pa.array([total], pa.list_(pa.int64()))})
                    n, total = 0, None
                n, total = n + len(block), own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "sums": pa.array([total], pa.list_(pa.int64()))})

    return distinct.mapInArrow(run, "n long, sums array<long>")


def moments(distinct: DataFrame, d: int) -> Moments:
    """Moments of the stored distinct vectors (x), in two passes: sums, then products of what is centred."""
    n, sums = _combined(_summed(distinct, lambda x: x.sum(axis=0), d), d)
    if not n:
        return Moments(0, [0] * d, np.zeros((d, d)))
    found = Moments(n, sums, np.zeros((d, d)))
    middle, upper = found.middle, np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        y = x - middle
        top = float(np.abs(y).max()) if len(y) else 0.0
        if top * top * max(1, len(y)) < 2 ** 53:  # exact in doubles, which multiply faster
            y = y.astype(float)
            return (y.T @ y)[upper].astype(np.int64)
        if top * top * len(y) >= 2 ** 63:
            raise OverflowError("entries spread too wide for exact products")
        return (y.T @ y)[upper]

    _, gram = _combined(_summed(distinct, products, d), len(upper[0]))
    left = [s % n for s in sums]  # n x (mean - middle)
    for k, (i, j) in enumerate(zip(*upper, strict=True)):
        found.covariance[i, j] = found.covariance[j, i] = (n * gram[k] - left[i] * left[j]) / (n * n)
    return found


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric v exceed the shift: the inertia of v - shift, by a factorisation
    with pivots of one or two rows, each chosen among all that are left."""
    a, count = v - shift * np.eye(len(v)), 0
    while len(a):
        size = np.abs(a)
        p = int(size.diagonal().argmax())
        r, s = divmod(int(np.triu(size, 1).argmax()), len(a))
        if size[p, p] >= 0.64 * size[r, s]:  # the bound under which the entries grow least
            if not size[p, p]:
                break
            count += a[p, p] > 0
            rows = [p]
        else:
            count += 1  # two rows with a negative determinant: one eigenvalue of either sign
            rows = [r, s]
        rest = np.delete(np.arange(len(a)), rows)
        a = a[np.ix_(rest, rest)] - a[np.ix_(rest, rows)] @ np.linalg.solve(a[np.ix_(rows, rows)], a[np.ix_(rows, rest)])
    return int(count)


def intervals(v: np.ndarray, most: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues within) from the top, disjoint, until ``most`` eigenvalues (or all above zero) are covered."""
    top = float(np.abs(v).sum(axis=1).max())
    if not top:
        return []
    top *= 1 + 1e-9
    zero = ZERO * len(v) * top
    out, open_ = [], [(zero, top, above(v, zero))]
    have = 0
    while open_ and have < most:
        low, high, count = open_.pop()
        mid = (low + high) / 2
        if not count:
            continue
        if count <= PER_INTERVAL or high - low <= 1e-12 * top:
            out.append((low, high, count))
            have += count
        else:
            upper = above(v, mid) - above(v, high)
            open_ += [(low, mid, count - upper), (mid, high, upper)]  # the higher one is next
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0, loops: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of the symmetric v in (low, high]: values and unit vectors (columns)."""
    d, norm = len(v), float(np.abs(v).sum(axis=1).max())
    centre, radius = (low + high) / 2, max((high - low) / 2, 1e-10 * norm)
    angles = np.pi * (np.arange(POINTS) + 0.5) / POINTS
    width = min(d, 2 * count + 4)
    block = np.random.default_rng(seed).standard_normal((d, width))
    for _ in range(loops):
        if width < d:
            projected = np.zeros((d, width))
            for angle in angles:  # the lower half of the circle gives the complex conjugates
                turn = np.exp(1j * angle)
                projected += (radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(d) - v, block.astype(complex))).real / POINTS
        else:
            projected = np.eye(d)
        basis, _, _ = np.linalg.svd(projected, full_matrices=False)
        values, turned = np.linalg.eigh(basis.T @ v @ basis)
        vectors = basis @ turned
        inside = (values > low) & (values <= high)
        left = np.abs(v @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(initial=0.0)
        if inside.sum() == count and left <= 1e-13 * norm * np.sqrt(d):
            return values[inside], vectors[:, inside]
        if width == d:  # the whole space: at the interval's ends rounding decides, the nearest ones are meant
            nearest = np.argsort(np.maximum(low - values, values - high))[:count]
            return values[nearest], vectors[:, nearest]
        block = vectors
    width = d
    values, vectors = np.linalg.eigh(v)
    nearest = np.argsort(np.maximum(low - values, values - high))[:count]
    return values[nearest], vectors[:, nearest]


def components(spark: SparkSession, v: np.ndarray, most: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``most`` eigenvalues above zero, falling, and their unit eigenvectors (columns)."""
    wanted = intervals(v, most)
    if not wanted:
        return np.zeros(0), np.zeros((len(v), 0))
    shared = spark.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                _, vectors = feast(shared.value, low, high, count)
                yield pa.RecordBatch.from_pydict({"high": pa.array([high] * count), "vector": pa.array(list(vectors.T), pa.list_(pa.float64()))})

    todo = spark.createDataFrame(wanted, "low double, high double, count int").repartition(len(wanted))
    found = todo.mapInArrow(run, "high double, vector array<double>").collect()  # a few vectors more than wanted
    basis, _ = np.linalg.qr(np.array([r.vector for r in sorted(found, key=lambda r: (-r.high, r.vector))]).T)
    values, turned = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values)[:most]
    vectors = basis @ turned[:, order]
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return values[order], vectors


def identity_error(distinct: DataFrame, found: Moments, values: np.ndarray, vectors: np.ndarray) -> float:
    """The largest entry of the whitened distinct vectors' covariance less the identity, from the vectors themselves."""
    d, k = vectors.shape
    middle, rest, scaled = found.middle, found.rest, vectors / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for x in _batches(batch.column(0), d):
                z = ((x - middle) - rest) @ scaled
                gram, sums = gram + z.T @ z, sums + z.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate([gram.ravel(), sums])], pa.list_(pa.float64()))})

    rows = distinct.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k * k + k)
    for r in rows:
        flat[r.i] = r.v / found.n
    mean = flat[k * k:]
    return float(np.abs(flat[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, most: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row of ``rows`` (id, x) and component."""
    spark = rows.sparkSession
    ddl = f"id {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, d = usable(rows)
    if not d:
        return spark.createDataFrame([], ddl)
    distinct = stored(rows.select("x").distinct(), "distinct-vectors")
    found = moments(distinct, d)
    values, vectors = components(spark, found.covariance, most)
    k = len(values)
    if not k:
        return spark.createDataFrame([], ddl)
    error = identity_error(distinct, found, values, vectors)
    explained = values / np.trace(found.covariance)
    middle, rest, scaled, n = found.middle, found.rest, vectors / np.sqrt(values), found.n
    left = np.array([s % n for s in found.sums], np.int64)
    arrow = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 1_000_000 // max(d, k))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                y = _matrix(part.column(1), d) - middle
                far = float(np.abs(y).max(initial=0)) * n + n
                if far * far * d >= 2 ** 63:
                    if far >= 2 ** 62:
                        raise OverflowError("a deviation does not fit a long")
                    deviation = [sum(int(e) ** 2 for e in r) for r in n * y - left]
                else:
                    deviation = ((n * y - left) ** 2).sum(axis=1)
                z = (y - rest) @ scaled
                m = len(y)
                again = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array(deviation, pa.int64()).take(again), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema=arrow)

    return rows.select("id", "x").mapInArrow(run, ddl)
