"""Whitening of vectors by a bidiagonal qd solver.

Rows are centred exactly, as integers, and reduced to triangles by QR decompositions of blocks, task by task and then in
a tree. The last triangle R has the singular values of all centred rows. Householder reflections make it bidiagonal, the
dqds algorithm (quotient differences with shifts, in differential form) gives the singular values to high relative
accuracy, and twisted factorisations of ``B'B - lambda`` give its eigenvectors, which the reflections turn into directions of
the vectors. The covariance itself is never formed.

Only sums, triangles and directions travel: a task sends one triangle, 64 of them are merged by one task, and the driver
gets ``width * (components + 1)`` numbers of each width of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Integers beyond this are cut to it, so that sums of a batch fit 64 bits.
LARGEST = 1 << 45
FAN_IN, BLOCK = 64, 4096
#: What directions and means of all widths may take in the closure of a task.
MODEL_BYTES = 64 << 20
EPS = np.finfo(float).eps


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, float]]]:
    """(diagonal, superdiagonal, right reflections) of a square matrix by Householder reflections from both sides."""
    a, n, right = r.astype(float).copy(), len(r), []

    def reflection(x):
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            return None, 0.0
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        return v, 2.0 / float(v @ v)

    for k in range(n):
        v, t = reflection(a[k:, k])
        if t:
            a[k:, k:] -= np.outer(t * v, v @ a[k:, k:])
        if k < n - 2:
            v, t = reflection(a[k, k + 1 :])
            if t:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, t * v)
                right.append((k + 1, v, t))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _step(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float, int]:
    """One differential qd transform with shift: (q, e, the least d, its place); it stops at the first negative d."""
    n = len(q)
    out_q, out_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - tau
    least, at = d, 0
    for i in range(n - 1):
        if d < 0:
            return out_q, out_e, d, i
        out_q[i] = top = d + e[i]
        if top == 0:
            out_e[i], d = 0.0, q[i + 1] - tau
        else:
            ratio = q[i + 1] / top
            out_e[i] = e[i] * ratio
            d = d * ratio - tau
        if d < least:
            least, at = d, i + 1
    out_q[n - 1] = d
    return out_q, out_e, least, at


def _trailing(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last 2 x 2 block, which the least eigenvalue does not exceed."""
    a, b, c = q[-2], q[-2] * e[-1], q[-1] + e[-1]
    half = (a + c) / 2
    return max(0.0, (a * c - b) / (half + np.sqrt(max(0.0, half * half - (a * c - b)))) if half > 0 else 0.0)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling.

    A shift above the least eigenvalue shows by a negative d. At the last place what it missed by is then known, and
    the corrected shift is excellent; elsewhere the shift is cut, at last to 0, which cannot fail.
    """
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    values: list[float] = []
    work = [(((diagonal / scale) ** 2).tolist(), ((above / scale) ** 2).tolist(), 0.0, 0.0)]
    while work:
        q, e, shift, low = work.pop()  # shift + low: the sum of shifts in twice the precision
        idle = 0
        while q:
            if len(q) == 1:
                values.append(q[0] + low + shift)
                break
            if e[-1] <= EPS * EPS * (q[-1] + shift):
                values.append(q.pop() + low + shift)
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= EPS * EPS * max(shift, min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], shift, low))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                # The same values from the other end, where the small ones deflate sooner.
                q, e = q[::-1], e[::-1]
            tau, tries = (_trailing(q, e) if idle else 0.0), 0
            while True:
                new_q, new_e, least, at = _step(q, e, tau)
                if least >= 0 or tau == 0:
                    break
                tries += 1
                better = (tau + least) * (1 - 2 * EPS) if at == len(q) - 1 and tries == 1 else tau / 4
                tau = better if better > 0 and tries < 5 else 0.0
            q, e, idle = [max(x, 0.0) for x in new_q], new_e, idle + 1
            total = shift + tau
            low += tau - (total - shift)
            shift = total
    return np.sort(np.array(values) * scale * scale)[::-1]


def _twisted(a: np.ndarray, b: np.ndarray, value: float, start: np.ndarray | None) -> np.ndarray:
    """An eigenvector of the tridiagonal (a, b) by the factorisation twisted where its pivot is least.

    Without ``start`` the vector has 1 at the twist and solves ``(T - value) z = gamma e``; with it one step of inverse iteration is made.
    """
    n = len(a)
    tiny = EPS * EPS * max(abs(value), float(np.abs(a).max()), 1e-300)
    down, up = a - value, a - value
    for i in range(n - 1):
        if abs(down[i]) < tiny:
            down[i] = tiny
        down[i + 1] -= b[i] * b[i] / down[i]
    for i in range(n - 1, 0, -1):
        if abs(up[i]) < tiny:
            up[i] = tiny
        up[i - 1] -= b[i - 1] * b[i - 1] / up[i]
    gamma = down + up - (a - value)
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n) if start is None else start.copy()
    if start is None:
        z[r] = 1.0
    else:
        for i in range(r):
            z[i + 1] -= b[i] / down[i] * z[i]
        for i in range(n - 1, r, -1):
            z[i - 1] -= b[i - 1] / up[i] * z[i]
        z[r] /= gamma[r] if abs(gamma[r]) > tiny else tiny
        z[:r] /= down[:r]
        z[r + 1 :] /= up[r + 1 :]
    for i in range(r - 1, -1, -1):
        z[i] -= b[i] / down[i] * z[i + 1]
    for i in range(r + 1, n):
        z[i] -= b[i - 1] / up[i] * z[i - 1]
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of B'B and their unit eigenvectors as rows.

    B is parted where its superdiagonal is negligible; values that lie close in one part have their vectors made by inverse
    iteration with the same factorisations, each held orthogonal to the ones before it.
    """
    top = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(above).max(initial=0)))
    cuts = [0, *(np.flatnonzero(np.abs(above) <= EPS * top) + 1).tolist(), len(diagonal)]
    found = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        d, s = diagonal[lo:hi], above[lo : hi - 1]
        found += [(v, lo, hi) for v in dqds(d, s).tolist()]
    found.sort(key=lambda f: (-f[0], f[1]))
    rng, out = np.random.default_rng(11), []
    for value, lo, hi in found[:k]:
        d, s = diagonal[lo:hi], above[lo : hi - 1]
        a = d * d
        a[1:] += s * s
        close = [z[lo:hi] for v, other, z in out if other == lo and abs(v - value) <= 1e-3 * max(v, value)]
        z = _twisted(a, d[:-1] * s, value, None)
        if close:
            z = rng.standard_normal(hi - lo)
            for _ in range(4):
                for c in close:
                    z -= (c @ z) * c
                z = _twisted(a, d[:-1] * s, value, z / np.linalg.norm(z))
        for c in [*close, *close]:
            z -= (c @ z) * c
        whole = np.zeros(len(diagonal))
        whole[lo:hi] = z / np.linalg.norm(z)
        out.append((value, lo, whole))
    return np.array([f[0] for f in out]), np.array([f[2] for f in out]).reshape(len(out), len(diagonal))


def directions(r: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit directions as rows, trace) of the covariance ``r'r / n``; values of rounding errors only are left out."""
    diagonal, above, right = bidiagonal(r)
    values, z = right_vectors(diagonal, above, min(k, len(r)))
    good = values > values.max(initial=0) * (len(r) * EPS) ** 2
    values, z = values[good], z[good]
    for at, v, t in reversed(right):
        z[:, at:] -= np.outer(z[:, at:] @ v, t * v)
    return values / n, z, float((r * r).sum()) / n


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as longs, without the fixed shift; null for a vector that takes no part."""
    x = vector.cast("array<double>")
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(ok & (F.size(x) > 0), F.transform(x, lambda c: F.floor(F.greatest(F.least(scale * c, F.lit(float(LARGEST))), F.lit(float(-LARGEST))))))


def _by_width(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(width, rows, places in the batch) of blocks of at most ``BLOCK`` rows."""
    for whole in batches:
        for lo in range(0, whole.num_rows, BLOCK):
            b = whole.slice(lo, BLOCK)
            v = b.column(column)
            ends = np.asarray(v.offsets)
            flat, size = v.values.to_numpy(zero_copy_only=False), np.diff(ends)
            for width in np.unique(size).tolist():
                at = np.flatnonzero(size == width)
                yield width, flat[(ends[:-1][at][:, None] + np.arange(width))], (b, at)


def _centred(y: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(n * y - S exactly: long, or Python's integers where these do not fit; the rows less their mean)."""
    total = np.array(sums, object)
    if max(int(np.abs(y).max(initial=0)) * n, *(abs(s) for s in sums)) < 1 << 61:
        exact = y * n - total.astype(np.int64)
        return exact, exact / n
    exact = y.astype(object) * n - total
    return exact, (exact / n).astype(float)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, tuple[int, np.ndarray]] = {}
    for width, y, _ in _by_width(batches, 1):
        n, s = known.get(width, (0, np.zeros(width, object)))
        known[width] = (n + len(y), s + y.sum(0))
    for width, (n, s) in known.items():
        yield pa.RecordBatch.from_arrays([pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array([str(int(x)) for x in s], pa.string())], ["width", "dim", "n", "total"])


def _parts(rows: DataFrame, known: dict[int, tuple[int, list[int]]], begin, add) -> DataFrame:
    """(width, part, data): what ``add`` makes of all blocks of a task, by width, as bytes of doubles."""

    def run(batches):
        made: dict[int, np.ndarray] = {}
        for width, y, _ in _by_width(batches, 1):
            made[width] = add(made.get(width, begin(width)), _centred(y, *known[width])[1], width)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), pa.array([part] * len(made), pa.int64()), pa.array([m.tobytes() for m in made.values()], pa.binary())], ["width", "part", "data"])

    return rows.mapInArrow(run, "width int, part long, data binary")


def _merged(parts: DataFrame, merge) -> DataFrame:
    """One row for each width: ``merge`` of arrays in groups of at most ``FAN_IN``, level by level."""

    def together(t: pd.DataFrame) -> pd.DataFrame:
        width = int(t["width"].iloc[0])
        made = None
        for data in t.sort_values("part")["data"]:
            x = np.frombuffer(data)
            made = x.copy() if made is None else merge(made, x, width)
        return pd.DataFrame({"width": [width], "part": [int(t["part"].iloc[0]) // FAN_IN], "data": [made.tobytes()]})

    parts = staged(parts, "whitening-parts")
    last = parts.agg(F.max("part")).first()[0] or 0
    while True:
        parts = parts.groupBy("width", F.floor(F.col("part") / FAN_IN).alias("above")).applyInPandas(together, "width int, part long, data binary")
        if last < FAN_IN:
            return parts
        parts, last = staged(parts, "whitening-parts"), last // FAN_IN


def _triangle(x: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(x, mode="r")
    out = np.zeros((x.shape[1], x.shape[1]))
    out[: len(r)] = r
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, dict]:
    """By width: n, sums, values (falling), directions (rows), trace, identity_error of ``rows`` (id, y: array of long)."""
    found = rows.mapInArrow(_sums, "width int, dim int, n long, total string").groupBy("width", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    known: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(found.collect()):
        known.setdefault(r["width"], (r["n"], []))[1].append(int(r["total"]))
    if sum(w * (components + 1) * 8 for w in known) > MODEL_BYTES:
        raise ValueError(f"directions of widths {sorted(known)[-3:]} and others take more than {MODEL_BYTES} bytes")
    if not known:
        return {}
    square = lambda width: np.zeros((width, width))
    triangles = _parts(rows, known, square, lambda r, x, width: _triangle(np.vstack([r, x])))
    triangles = _merged(triangles, lambda a, b, width: _triangle(np.vstack([a.reshape(width, width), b.reshape(width, width)])).ravel())

    def solve(batches):
        for b in batches:
            for width, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                values, z, trace = directions(np.frombuffer(data).reshape(width, width), known[width][0], components)
                yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([values.tolist()], pa.list_(pa.float64())), pa.array([z.ravel().tolist()], pa.list_(pa.float64())), pa.array([trace])], ["width", "values", "z", "trace"])

    model = {}
    for r in triangles.mapInArrow(solve, "width int, values array<double>, z array<double>, trace double").collect():
        width, k = r["width"], len(r["values"])
        z = np.array(r["z"]).reshape(k, width)
        model[width] = {"n": known[width][0], "sums": known[width][1], "values": np.array(r["values"]), "directions": z, "trace": r["trace"], "identity_error": 0.0}
    # Centred rows sum to nothing, so means of whitened rows are those of rounding; they are taken off all the same.
    turned = {w: (m["directions"] / np.sqrt(m["values"])[:, None]).T for w, m in model.items()}

    def add(made, x, width):
        w = x @ turned[width]
        return made + np.vstack([w.sum(0), w.T @ w])

    moments = _parts(rows, known, lambda width: np.zeros((turned[width].shape[1] + 1, turned[width].shape[1])), add)
    for r in _merged(moments, lambda a, b, width: a + b).collect():
        width, k = r["width"], turned[r["width"]].shape[1]
        m = np.frombuffer(r["data"]).reshape(k + 1, k) / model[width]["n"]
        model[width]["identity_error"] = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max(initial=0))
    return model


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error, eigenvalue.

    A component x of a vector is the long ``floor(scale * x)``; adding a constant to all, as the query's contract does, changes no
    result, so it isn't added. Vectors that are null or empty or hold null, NaN or an infinity take no part. Vectors meet those of
    their own length only: each length is a fit list of its own. Integers beyond 2^45 are cut to it. Directions without any
    variance (constant vectors, fewer vectors than components, repeated dimensions) are no components, so ranks below
    ``components`` give fewer rows, and a single vector none. ``deviation`` is exact, null where it doesn't fit 64 bits. Rows without an
    id or with a repeated one are rows like others. An empty table gives no rows. Other columns are not looked at.

    The table is read four times: for sums, triangles, the error and the result.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), integers(F.col(f"`{vector}`"), scale).alias("y")).where("y IS NOT NULL")
    model = fit(rows, components)
    for m in model.values():
        m["turned"] = (m["directions"] / np.sqrt(m["values"])[:, None]).T

    def run(batches):
        for width, y, (b, at) in _by_width(batches, 1):
            m = model[width]
            exact, x = _centred(y, m["n"], m["sums"])
            n, k = len(y), len(m["values"])
            w = x @ m["turned"]
            if exact.dtype != object and int(np.abs(exact).max(initial=0)) ** 2 * width < 1 << 63:
                deviation = pa.array((exact * exact).sum(1))
            else:
                sums = [sum(int(c) ** 2 for c in row) for row in exact.tolist()]
                deviation = pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
            each = pa.array(np.repeat(np.arange(n), k))
            every = lambda value: pa.array(np.full(n * k, value))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), every(m["n"]), deviation.take(each), pa.array(w.ravel()), pa.array(np.tile(m["values"] / m["trace"] if m["trace"] else m["values"], n)), every(m["identity_error"]), pa.array(np.tile(m["values"], n))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"],
            )

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double")
