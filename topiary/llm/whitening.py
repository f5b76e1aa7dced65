"""Embedding whitening by spectrum slicing.

Spark gathers the covariance; the spectrum of that dims x dims matrix is then
sliced:

1. The fit list (each distinct quantised vector once) is frozen in chunks. One
   pass adds up the exact sums per dimension, a second the centred products,
   each task one upper triangle, merged by an aggregate.
2. ``positive_count(V - shift I)`` is the number of eigenvalues above the shift:
   Sylvester's law on an LDL^T factorisation with 1x1 and 2x2 pivots. Bisecting
   shifts by these counts isolates each leading eigenvalue in an interval of its
   own; what no shift separates is a multiple eigenvalue.
3. Inverse iteration from the interval's middle and Rayleigh quotient iteration
   (cubic) give the pair; a result that leaves its interval is thrown away and
   the interval halved. Counts just above and below each found value certify its
   number.
4. A third pass over the fit list measures the whitened covariance, and every
   kept row is projected in its own task.

The driver holds dims x dims numbers (``MAX_DIMS`` bounds them) and no row.
Vectors are centred on integers: x minus the floor of the mean is exact, the
rest of the mean is a fraction below one.

Defined cases: vectors that are NULL or hold NULL or non-finite entries are left
out, and so are those whose length is not the most frequent one (the longer at a
tie), as they lie in another space; repeated rows are each returned and enter the
fit list once; a NULL ``vec_id`` is kept; |x| of 2**31 or more is refused by
name; fewer than ``count`` dimensions give as many components; a component
without variance (fewer distinct vectors than dimensions) has NULL ``whitened``
and no part in ``identity_error``; ``deviation`` is NULL where it does not fit a
long; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiary.llm.common import frozen
from topiary.llm.lloyd import whole_vector

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
CHUNK_ROWS = 2048
LIMIT = 1 << 31
MAX_DIMS = 4096

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- the spectrum of one symmetric matrix


def positive_count(a: np.ndarray) -> int:
    """Positive eigenvalues of a symmetric matrix, from the pivots of its LDL^T
    factorisation with complete diagonal pivoting (a 2x2 pivot has one of each sign)."""
    a, positive = a.copy(), 0
    ratio = (1 + 17 ** 0.5) / 8  # bounds the growth of what is left
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal().copy()
        i = int(diagonal.argmax())
        np.fill_diagonal(size, 0)
        r, s = divmod(int(size.argmax()), len(a))
        if diagonal[i] >= ratio * size[r, s]:
            if diagonal[i] == 0:
                return positive
            positive += a[i, i] > 0
            column = np.delete(a[:, i], i)
            a = np.delete(np.delete(a, i, 0), i, 1) - np.outer(column, column / a[i, i])
        else:
            positive += 1
            pivot = a[np.ix_([r, s], [r, s])]
            columns = np.delete(a[:, [r, s]], [r, s], 0)
            a = np.delete(np.delete(a, [r, s], 0), [r, s], 1) - columns @ np.linalg.solve(pivot, columns.T)
    return positive


def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    return positive_count(v - shift * np.eye(len(v)))


def slices(v: np.ndarray, count: int, tolerance: float) -> list[tuple]:
    """[(low, high, first, last)]: intervals that hold the eigenvalues number first
    to last of the leading ``count``, one each unless closer than ``tolerance``."""
    bound = float(np.abs(v).sum(1).max()) * (1 + 1e-9) + tolerance
    todo, found = [(-bound, bound, 1, len(v))], []
    while todo:
        low, high, first, last = todo.pop()
        if first > last or first > count:
            continue
        if first == last or high - low <= tolerance:
            found.append((low, high, first, last))
            continue
        middle = (low + high) / 2
        above = eigenvalues_above(v, middle)
        todo += [(low, middle, max(first, above + 1), last), (middle, high, first, min(last, above))]
    return sorted(found, key=lambda x: x[2])


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue: a nudge keeps its direction
        scale = np.abs(a).max() or 1.0
        return np.linalg.solve(a + 2 * np.finfo(float).eps * scale * np.eye(len(a)), b)


def rayleigh_pair(v: np.ndarray, low: float, high: float, number: int) -> tuple[float, np.ndarray]:
    """The eigenpair whose value alone lies in (low, high]."""
    eye, norm = np.eye(len(v)), np.abs(v).sum(1).max() or 1.0
    start = np.random.default_rng(number).standard_normal(len(v))
    for _ in range(200):
        middle = (low + high) / 2
        x = start / np.linalg.norm(start)
        for _ in range(2):
            x = _solve(v - middle * eye, x)
            x /= np.linalg.norm(x)
        best = (np.inf, 0.0, x)
        for _ in range(30):
            value = float(x @ v @ x)
            rest = float(np.linalg.norm(v @ x - value * x))
            if rest >= best[0]:
                break  # cubic until rounding: no step helps any more
            best = (rest, value, x)
            x = _solve(v - value * eye, x)
            x /= np.linalg.norm(x)
        rest, value, x = best
        slack = 1e-13 * norm
        if rest <= 1e-11 * norm and low - slack <= value <= high + slack:
            return value, x
        if eigenvalues_above(v, middle) >= number:
            low = middle
        else:
            high = middle
    raise ArithmeticError(f"no convergence to eigenvalue {number}")


def multiple_pairs(v: np.ndarray, low: float, high: float, many: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An orthonormal basis for ``many`` eigenvalues that no shift separates."""
    eye = np.eye(len(v))
    x = np.random.default_rng(many).standard_normal((len(v), many))
    for _ in range(6):
        x = x - known @ (known.T @ x)
        x = np.linalg.qr(_solve(v - (low + high) / 2 * eye, np.linalg.qr(x)[0]))[0]
    return np.einsum("ij,ij->j", x, v @ x), x


def leading_pairs(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as columns."""
    d = len(v)
    count, norm = min(count, d), float(np.abs(v).sum(1).max())
    if norm == 0:
        return np.zeros(count), np.eye(d)[:, :count]
    tolerance = 1e-13 * norm
    values, vectors = np.zeros(0), np.zeros((d, 0))
    for low, high, first, last in slices(v, count, tolerance):
        if first == last:
            e, x = rayleigh_pair(v, low, high, first)
            e, x = np.array([e]), x[:, None]
        else:
            e, x = multiple_pairs(v, low, high, last - first + 1, vectors)
        x = x - vectors @ (vectors.T @ x)  # only rounding, unless two values all but meet
        values, vectors = np.concatenate([values, e]), np.concatenate([vectors, x / np.linalg.norm(x, axis=0)], axis=1)
    for number, e in enumerate(values[:count], 1):
        if not eigenvalues_above(v, e + 50 * tolerance) < number <= eigenvalues_above(v, e - 50 * tolerance):
            raise ArithmeticError(f"the counts do not certify eigenvalue {number}")
    values, vectors = values[:count], vectors[:, :count]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(count)])
    return values, vectors * sign


# ---- the passes over the vectors


def quantised(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """(vec_id, x) of the vectors that hold finite numbers only."""
    v = F.col("embedding").cast("array<double>")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(whole_vector(F.col("v")))
    # a float beyond the long range stops at its end, inside what the next pass refuses
    return kept.select("vec_id", F.transform("v", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(2.0 ** 52)), F.lit(-2.0 ** 52)))
                                             + shift).alias("x"))


def _values(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _pack(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _values(batch, dims)
            if x.size and np.abs(x).max() >= LIMIT:
                raise ValueError(f"a quantised entry of {LIMIT} or more")
            chunks = [x[i:i + CHUNK_ROWS].astype(np.int32).tobytes() for i in range(0, len(x), CHUNK_ROWS)]
            yield pa.RecordBatch.from_pydict({"x": pa.array(chunks, pa.binary())})
    return run


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("x").to_pylist():
            yield np.frombuffer(x, np.int32).reshape(-1, dims).astype(np.int64)


def _sums(dims: int):
    """(i, s, n): a task's sum of each dimension and its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, n = np.zeros(dims, np.int64), 0
        for x in _chunks(batches, dims):
            s, n = s + x.sum(0), n + len(x)
        yield pa.RecordBatch.from_pydict({"i": np.arange(dims, dtype=np.int32), "s": s, "n": np.full(dims, n, np.int64)})
    return run


def _products(dims: int, of):
    """(i, j, v): a task's upper triangle of the products of ``of(chunk)``'s columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for x in _chunks(batches, dims):
            y = of(x)
            total = total + y.T @ y
        if np.ndim(total):
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})
    return run


class Centre:
    """The exact mean S / n, split into whole numbers and a rest below one."""

    def __init__(self, sums: list[int], n: int):
        self.sums, self.n = sums, n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], float) / n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviations(self, x: np.ndarray) -> list:
        """Per row the sum of (n x - S)^2, exact; None beyond a long."""
        worst = max(1, int(np.abs(x - self.whole).max(initial=0)) + 1) * self.n
        if worst ** 2 * x.shape[1] < 1 << 63:
            d = self.n * (x - self.whole) - np.array([s % self.n for s in self.sums], np.int64)
            return (d * d).sum(1).tolist()
        whole = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [w if w < 1 << 63 else None for w in whole]


def _matrix(triangle: DataFrame, size: int, n: int) -> np.ndarray:
    v = np.zeros((size, size))
    for r in triangle.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # size^2 / 2 numbers
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    return v


def _project(dims: int, centre: Centre, axes: np.ndarray, live: int, explained: list):
    """(vec_id, component, deviation, whitened, explained): a row per kept row and component."""
    parts = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _values(batch, dims)
            rows = len(x)
            if not rows:
                continue
            if np.abs(x).max() >= LIMIT:
                raise ValueError(f"a quantised entry of {LIMIT} or more")
            w = centre(x) @ axes
            again = np.repeat(np.arange(rows), parts)
            dead = np.tile(np.arange(parts) >= live, rows)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(again)), "component": np.tile(np.arange(1, parts + 1, dtype=np.int32), rows),
                "deviation": pa.array(centre.deviations(x), pa.int64()).take(pa.array(again)),
                "whitened": pa.array(w.ravel(), pa.float64(), mask=dead), "explained": np.tile(np.array(explained, float), rows)})
    return run


def whiten(vectors: DataFrame, count: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)."""
    spark = vectors.sparkSession
    rows = quantised(vectors, scale, shift)
    lengths = rows.groupBy(F.size("x").alias("d")).count().filter("d > 0").agg(F.max(F.struct("count", "d"))["d"].alias("d"))
    dims = lengths.first()["d"]
    if dims is None:
        return spark.createDataFrame([], RESULT)
    if dims > MAX_DIMS:
        raise ValueError(f"{dims} dimensions: their covariance is beyond {MAX_DIMS} x {MAX_DIMS}")
    rows = rows.filter(F.size("x") == dims)
    fit = frozen(rows.select("x").distinct().mapInArrow(_pack(dims), "x binary"))

    added = fit.mapInArrow(_sums(dims), "i int, s long, n long")
    per = added.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    centre = Centre([int(r["s"]) for r in per], per[0]["n"])
    v = _matrix(fit.mapInArrow(_products(dims, centre), "i int, j int, v double"), dims, centre.n)

    values, axes = leading_pairs(v, count)
    trace = float(np.trace(v))
    live = int((values > 1e-12 * max(trace, 1e-300)).sum())  # falling, so the first ones
    axes = axes / np.sqrt(np.where(np.arange(len(values)) < live, values, 1.0))
    explained = [float(e) / trace if trace else 0.0 for e in values]
    identity_error = 0.0
    if live:
        alive = axes[:, :live]
        w = _matrix(fit.mapInArrow(_products(dims, lambda x: centre(x) @ alive), "i int, j int, v double"), live, centre.n)
        identity_error = float(np.abs(w - np.eye(live)).max())
    out = rows.mapInArrow(_project(dims, centre, axes, live, explained),
                          "vec_id long, component int, deviation long, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(centre.n).cast("long").alias("n"), "deviation", "whitened", "explained",
                      F.lit(identity_error).alias("identity_error"))
