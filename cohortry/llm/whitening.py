"""Whitening of embeddings on their leading principal components.

Entries become whole numbers, floor(64 c) + 1,000,000, and the fit counts each distinct vector once. Three passes over
the distinct vectors give their number and sums, their centred scatter, and the covariance of what comes out. Each task adds up
its own vectors in numpy and Spark adds up the tasks; only vectors' lengths, sums and d x d matrices reach the driver.
There Householder reflections bring the covariance to tridiagonal form, bisection on Sturm counts finds its leading eigenvalues, inverse
iteration their vectors, made orthogonal again within clusters of close eigenvalues. The components go to all tasks, which project every row.

Defined results: rows whose vector is null or empty or holds null or non-finite numbers are dropped; vectors of another length are a fit of their own;
repeated rows and ids are each given; a null id stays null. A component whose eigenvalue is zero up to rounding (d x 2**-52 of the largest) can't be
scaled and isn't given, so a table of one distinct vector gives no rows. x saturates at the range of a long; a deviation beyond it is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, new_names, saved

SCALE, SHIFT = 64, 1_000_000
EPS = float(np.finfo(float).eps)


def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and reflections of a symmetric matrix brought to tridiagonal form."""
    a, d, reflections = np.array(a, float), len(a), []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        scale = np.abs(x[1:]).max()
        if scale == 0:
            reflections.append(None)
            continue
        size = np.abs(x).max()
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        p = a[k + 1 :, k + 1 :] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = x - 2 * v * (v @ x)
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller than each value: negative terms of the Sturm sequence."""
    tiny = max(np.finfo(float).tiny, EPS * EPS * max(1e-300, np.abs(off).max(initial=0.0) ** 2))
    n, q = np.zeros(len(values), int), np.ones(len(values))
    for i, x in enumerate(diagonal):
        q = x - values - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        n += q < 0
    return n


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, descending, each between two neighbouring numbers at last."""
    around = np.concatenate([[0.0], np.abs(off), [0.0]])
    radius = around[:-1] + around[1:]
    low, high = np.full(k, (diagonal - radius).min()), np.full(k, (diagonal + radius).max())
    span = max(np.abs(low).max(), np.abs(high).max())
    low, high = low - span * EPS - 1e-300, high + span * EPS + 1e-300
    wanted = len(diagonal) - np.arange(k)  # the j-th largest has at most so many below anything over it
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        over = below(diagonal, off, middle) >= wanted
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    return (low + high) / 2


def solve(diagonal: np.ndarray, off: np.ndarray, value: float, b: np.ndarray) -> np.ndarray:
    """(T - value) x = b by elimination with row exchanges; a zero pivot counts as a very small one."""
    d = len(diagonal)
    one, two, three, b = diagonal - value, np.append(off, 0.0), np.zeros(d), b.copy()
    least = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), 1e-300)
    for i in range(d - 1):
        lower = off[i]
        if abs(one[i]) < abs(lower):
            one[i], lower = lower, one[i]
            two[i], one[i + 1] = one[i + 1], two[i]
            if i + 2 < d:
                three[i], two[i + 1] = two[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(one[i]) < least:
            one[i] = least
        f = lower / one[i]
        one[i + 1] -= f * two[i]
        two[i + 1] -= f * three[i]
        b[i + 1] -= f * b[i]
    if abs(one[-1]) < least:
        one[-1] = least
    x = np.zeros(d + 2)
    for i in range(d - 1, -1, -1):
        x[i] = (b[i] - two[i] * x[i + 1] - three[i] * x[i + 2]) / one[i]
    return x[:d]


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit vector for each of the descending eigenvalues; those of a cluster are kept orthogonal."""
    d, rng = len(diagonal), np.random.default_rng(0)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0), 1e-300)
    out = np.zeros((d, len(values)))
    start = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            start = j
        near = out[:, start:j]
        shift = value - (j - start) * 4 * EPS * norm  # equal eigenvalues need different shifts
        v = rng.standard_normal(d)
        for _ in range(6):
            v = solve(diagonal, off, shift, v / np.linalg.norm(v))
            for _ in range(2):
                v -= near @ (near.T @ v)
        out[:, j] = v / np.linalg.norm(v)
    return out


def principal(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues, descending, and their unit vectors as columns; those that are zero up to rounding are left out."""
    d = len(v)
    diagonal, off, reflections = householder(v)
    values = leading(diagonal, off, min(most, d))
    values = values[values > d * EPS * max(values[0], 0)]
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(reflections) - 1, -1, -1):
        if reflections[k] is not None:
            part = vectors[k + 1 :]
            part -= 2 * np.outer(reflections[k], reflections[k] @ part)
    if vectors.size:
        vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors


def scaled(vectors: DataFrame, column: str, to: str) -> DataFrame:
    """Rows with finite vectors, with their whole-number entries as ``to``."""
    entries = F.col(column).cast("array<double>")
    odd = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * SCALE) + F.when(F.abs(c) < 1e17, F.lit(SHIFT)).otherwise(0))
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & ~odd).withColumn(to, x)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: whole numbers of 64 bits, or Python's where these don't suffice."""
    if n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(whole: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact."""
    if whole.dtype == np.int64 and int(np.abs(whole).max(initial=0)) ** 2 * whole.shape[1] < 1 << 63:
        return (whole * whole).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in (sum(int(v) ** 2 for v in row) for row in whole)]


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], d: int, kind: str) -> np.ndarray:
    """``part`` of each batch's matrix, one array a task, added up over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(matrix(batch.column(0), d))
                total = own if total is None else total + own
        if total is not None:
            flat = total.reshape(len(total), -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat.tolist(), pa.list_(pa.int64() if kind == "long" else pa.float64()))], names=["i", "v"])

    each = rows.mapInArrow(run, f"i int, v array<{kind}>").select("i", F.posexplode("v").alias("j", "v"))
    if kind == "long":
        each = each.withColumn("v", F.col("v").cast("decimal(38,0)"))
    cells = each.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # as many as a matrix of the vectors' length has
    out = np.zeros((max(c.i for c in cells) + 1, max(c.j for c in cells) + 1), object if kind == "long" else float)
    for c in cells:
        out[c.i, c.j] = int(c.v) if kind == "long" else c.v
    return out


def fit(distinct: DataFrame, d: int, most: int) -> dict:
    """n, sums, components (d x k, each over the root of its eigenvalue), explained shares and the error against the identity of distinct vectors of length d."""
    parts = lambda x: np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), [len(x)]])[:, None]  # noqa: E731  halves, so that no sum leaves a long
    counted = [int(v) for v in summed(distinct, parts, d, "long")[:, 0]]
    n, sums = counted[-1], [(high << 32) + low for high, low in zip(counted[:d], counted[d : 2 * d], strict=True)]

    def scatter(x: np.ndarray) -> np.ndarray:
        y = (centred(x, n, sums) / n).astype(float)
        return y.T @ y

    v = summed(distinct, scatter, d, "double") / n
    v = (v + v.T) / 2
    values, vectors = principal(v, most)
    components = vectors / np.sqrt(values)
    error = 0.0
    if len(values):

        def white(x: np.ndarray) -> np.ndarray:
            y = (centred(x, n, sums) / n).astype(float) @ components
            return y.T @ y

        error = float(np.abs(summed(distinct, white, d, "double") / n - np.eye(len(values))).max())
    return {"n": n, "sums": sums, "components": components, "explained": values / max(np.trace(v), 1e-300), "error": error}


def project(rows: DataFrame, model: dict, d: int, id_column: str, id_type: str, x: str) -> DataFrame:
    """A row for each vector and component."""
    n, sums, components, error = model["n"], model["sums"], model["components"], model["error"]
    explained, k = model["explained"].tolist(), components.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = centred(matrix(batch.column(1), d), n, sums)
            m = len(whole)
            each = pa.array(np.repeat(np.arange(m), k))
            white = ((whole / n).astype(float) @ components).ravel()
            columns = [
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)), pa.array(deviations(whole), pa.int64()).take(each),
                pa.array(white), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(id_column, x).mapInArrow(run, f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, most: int = 16, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    (x,) = new_names(vectors.columns, "x")
    rows = scaled(vectors, column, x)
    id_type = dict(vectors.dtypes)[id_column]
    distinct = saved(rows.select(F.col(x).alias("x")).distinct(), "distinct")
    lengths = [r.d for r in distinct.select(F.size("x").alias("d")).distinct().orderBy("d").collect()]  # one for most tables
    out = []
    for d in lengths:
        model = fit(distinct.filter(F.size("x") == d), d, most)
        if model["components"].shape[1]:
            out.append(project(rows.filter(F.size(x) == d), model, d, id_column, id_type, x))
    discard(distinct)
    if not out:
        return spark.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
