"""Whitening of embeddings: rows are reduced by blockwise QR, R is made bidiagonal, and qd gives its singular values.

Entries become integers, so that sums and deviations are exact. Centred rows are stacked and reduced to a triangle in
each task, triangles of tasks in rounds; only the last one, as large as a vector is long, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bidiagonal import EPS, bidiagonal, right_vectors, squared_singular_values
from tidemark.llm.common import map_batches

SCALE, OFFSET = 1024.0, 100_000
#: Entries from here on don't fit in 2**53 when scaled, and count as not finite.
LARGEST = 2.0**40
#: Groups of tasks' results in each round.
ROUNDS = (1024, 32, 1)


@dataclass
class Whitening:
    """What is fitted: the length of vectors, their number, sums of their integers, eigenvalues of the covariance and its trace, and unit eigenvectors as columns."""

    size: int
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows whose vector is whole and finite, of the length that most of these have (of two such lengths the larger)."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    rows = rows.where(F.col("v").isNotNull() & ~bad)
    lengths = rows.groupBy(F.size("v").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("k")).first()
    return rows.where(F.size("v") == (lengths.k if lengths else 0))


def integers(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """A row of integers for each vector of a batch."""
    flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, size) + OFFSET


def _folded(rows: DataFrame, schema: str, first: Callable, merge: Callable) -> bytes | None:
    """One value out of all rows: ``first`` makes a task's bytes of its batches, ``merge`` one of several, in rounds."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if (state := first(batches)) is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state], pa.binary())], ["k", "state"])

    def together(key, table):
        # The order of arrival differs between attempts; this one doesn't.
        states = table.sort_by("k")["state"].to_pylist()
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([merge(states)], pa.binary())], ["k", "state"])

    out = rows.mapInArrow(start, schema)
    for groups in ROUNDS:
        out = out.select((F.col("k") % groups).alias("g"), "k", "state").groupBy("g").applyInArrow(together, schema)
    last = out.first()
    return bytes(last.state) if last else None


_STATE = "k long, state binary"


def _triangle(x: np.ndarray) -> np.ndarray:
    return np.linalg.qr(x, mode="r")


def centred_triangle(rows: DataFrame, size: int, n: int, sums: np.ndarray, block: int = 2_048) -> np.ndarray:
    """R of the QR of all centred rows."""

    def first(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        r = np.zeros((0, size))
        for batch in batches:
            x = (integers(batch, size) * n - sums) / n
            for k in range(0, len(x), block):
                r = _triangle(np.vstack([r, x[k : k + block]]))
        return r.tobytes() if len(r) else None

    def merge(states: list[bytes]) -> bytes:
        return _triangle(np.vstack([np.frombuffer(s).reshape(-1, size) for s in states])).tobytes()

    state = _folded(rows, _STATE, first, merge)
    r = np.frombuffer(state or b"").reshape(-1, size)
    return np.vstack([r, np.zeros((size - len(r), size))])


def fit(rows: DataFrame, components: int = 8) -> Whitening:
    """Fitted on all ``rows`` (vec_id, v). Components are those of the largest eigenvalues, at most ``components`` and as many as the rank of the covariance; none without rows."""
    size = len((rows.select("v").first() or [[]])[0])

    def first(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            total[:-1] += integers(batch, size).sum(axis=0)
            total[-1] += batch.num_rows
        return total.tobytes() if total[-1] else None

    state = _folded(rows, _STATE, first, lambda states: np.sum([np.frombuffer(s, np.int64) for s in states], axis=0).tobytes()) if size else None
    if state is None:
        return Whitening(size, 0, np.zeros(size, np.int64), np.zeros(0), np.zeros((size, 0)), 0.0)
    sums, n = np.frombuffer(state, np.int64)[:-1], int(np.frombuffer(state, np.int64)[-1])
    diagonal, upper, p = bidiagonal(centred_triangle(rows, size, n, sums))
    squares = squared_singular_values(diagonal, upper)
    kept = squares[:components]
    kept = kept[kept > (size * EPS) ** 2 * squares[0]]
    return Whitening(size, n, sums, kept / n, p @ right_vectors(diagonal, upper, kept), float(squares.sum()) / n)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The exact sum of (n x - S) squared of each row; null where it is beyond a long."""
    apart = x * n - sums
    if not len(apart) or float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2**62:
        return pa.array((apart**2).sum(axis=1), pa.int64())
    exact = [sum(int(v) ** 2 for v in row) for row in apart.tolist()]
    return pa.array([v if v < 2**63 else None for v in exact], pa.int64())


def _white(x: np.ndarray, w: Whitening) -> np.ndarray:
    return ((x * w.n - w.sums) / w.n) @ w.vectors / np.sqrt(w.values)


def whitened(rows: DataFrame, w: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): each row's exact deviation and its coordinates of unit variance, one for each component."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = integers(batch, w.size)
        white = _white(x, w)
        lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], white.ravel())
        return pa.record_batch([batch["vec_id"], deviations(x, w.n, w.sums), lists], ["vec_id", "deviation", "whitened"])

    return map_batches(rows, run, "vec_id long, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the covariance of all whitened rows minus the identity; 0 without components."""
    k = len(w.values)
    if not k:
        return 0.0

    def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number, means and centred products of two sets together."""
        n, gap = a[0] + b[0], b[1 : k + 1] - a[1 : k + 1]
        mean = a[1 : k + 1] + gap * (b[0] / n)
        return np.concatenate([[n], mean, a[k + 1 :] + b[k + 1 :] + (np.outer(gap, gap) * (a[0] * b[0] / n)).ravel()])

    def first(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        state = None
        for batch in batches:
            y = _white(integers(batch, w.size), w)
            mean = y.mean(axis=0)
            own = np.concatenate([[len(y)], mean, ((y - mean).T @ (y - mean)).ravel()])
            state = own if state is None else merged(state, own)
        return None if state is None else state.tobytes()

    def merge(states: list[bytes]) -> bytes:
        out = np.frombuffer(states[0])
        for s in states[1:]:
            out = merged(out, np.frombuffer(s))
        return out.tobytes()

    out = np.frombuffer(_folded(rows, _STATE, first, merge))
    return float(np.abs(out[k + 1 :].reshape(k, k) / out[0] - np.eye(k)).max())


def components(df: DataFrame, count: int = 8, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Null vectors, and those with null or non-finite entries, are left out; so are vectors of another length than most
    have. Fewer components come out than asked for where the covariance has a lower rank, and no rows where it is 0 (one
    row, or equal rows). Null ids stay null and repeated rows count each; other columns don't matter.
    """
    rows = usable(df, id_col, vector_col)
    w = fit(rows, count)
    error = identity_error(rows, w)
    names = F.array(*(F.struct(F.lit(k + 1).alias("component"), F.lit(float(e / w.trace)).alias("explained")) for k, e in enumerate(w.values))) if len(w.values) else F.array().cast("array<struct<component:int,explained:double>>")
    out = whitened(rows, w).select("vec_id", "deviation", F.explode(F.arrays_zip(names.alias("c"), F.col("whitened").alias("w"))).alias("z"))
    return out.select("vec_id", F.col("z.c.component").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", F.col("z.w").alias("whitened"), F.col("z.c.explained").alias("explained"), F.lit(error).alias("identity_error"))
