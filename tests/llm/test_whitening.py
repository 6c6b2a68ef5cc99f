"""Whitening against numpy's eigenvectors and exact sums, and odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from capturelake.llm import whitening  # noqa: E402
from capturelake.llm.entry import QUERIES  # noqa: E402


@pytest.mark.parametrize("kind", ["plain", "graded", "copies", "equal", "few", "split", "constant", "one"])
def test_solver_against_lapack(kind):
    rng = np.random.default_rng(5)
    x = {
        "plain": lambda: rng.standard_normal((400, 40)), "graded": lambda: rng.standard_normal((400, 40)) * np.logspace(0, -7, 40), "copies": lambda: np.tile(rng.standard_normal((300, 8)), 3),
        "equal": lambda: np.vstack([np.eye(36), -np.eye(36)]), "few": lambda: rng.standard_normal((5, 20)), "split": lambda: np.kron(np.eye(4), rng.standard_normal((30, 6))), "constant": lambda: np.ones((9, 5)), "one": lambda: rng.standard_normal((30, 1)),
    }[kind]()
    x = x - x.mean(0)
    r, width = whitening._triangle(x), x.shape[1]
    diagonal, above, _ = whitening.bidiagonal(r)
    want = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.sqrt(whitening.dqds(diagonal, above)), want, rtol=1e-11, atol=1e-14 * max(want[0], 1))
    values, z, trace = whitening.directions(r, len(x), 32)
    cov = x.T @ x / len(x)
    rank = int((want > want[0] * width * np.finfo(float).eps).sum()) if want[0] else 0
    assert len(values) == min(32, rank) and math.isclose(trace, np.trace(cov), abs_tol=1e-15, rel_tol=1e-12)
    assert np.allclose(values, want[: len(values)] ** 2 / len(x), rtol=1e-10)
    assert np.abs(cov @ z.T - z.T * values).max(initial=0) <= 1e-13 * max(np.abs(cov).max(), 1e-9)
    assert np.abs(z @ z.T - np.eye(len(z))).max(initial=0) < 1e-10


def test_bidiagonals_of_all_sizes():
    rng = np.random.default_rng(7)
    for _ in range(150):
        n = int(rng.integers(1, 30))
        a, b = (rng.standard_normal(m) * 10.0 ** rng.integers(-8, 3, m) for m in (n, max(n - 1, 0)))
        if rng.random() < 0.3:
            a[rng.integers(0, n)] = 0
        want = np.linalg.svd(np.diag(a) + (np.diag(b, 1) if n > 1 else 0), compute_uv=False)
        assert np.allclose(np.sqrt(whitening.dqds(a, b)), want, rtol=1e-8, atol=1e-13 * want[0])


def test_query_against_plain_code(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/embeddings.parquet").collect()
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in r.embedding] for r in rows]
    n, width = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(width)]
    centred = np.array([[(n * v[j] - s[j]) / n for j in range(width)] for v in x])
    values, z = np.linalg.eigh(centred.T @ centred / n)
    values, z = values[::-1][:32], z[:, ::-1][:, :32]
    white = centred @ z / np.sqrt(values)
    deviation = {r.vec_id: sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)) for r, v in zip(rows, x, strict=True)}
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_whitening"](spark, data_dir).collect()}
    assert len(got) == n * 32
    for k in range(32):
        mine = np.array([got[r.vec_id, k + 1].whitened for r in rows])
        sign = np.sign(mine @ white[:, k])
        assert np.abs(mine - sign * white[:, k]).max() < 1e-7
    trace = np.trace(centred.T @ centred / n)
    assert all(r.n == n and r.deviation == deviation[i] and abs(r.explained / (values[k - 1] / trace) - 1) < 1e-9 and 0 <= r.identity_error < 1e-9 for (i, k), r in got.items())
    assert len({r.identity_error for r in got.values()}) == 1


def test_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(400)]
    odd = [(1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [float("nan")] * 6), (1004, [float("inf")] + [0.0] * 5), (None, rows[0][1]), (5, rows[5][1]), (2000, [1.0, 2.0]), (2001, [1.5, -2.0])]
    d = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    for c in ("y", "n", "id", "width", "part", "component"):
        d = d.withColumn(c, F.lit("clash"))
    out = whitening.whiten(d.repartition(7)).collect()
    six = [r for r in out if r.vec_id is None or r.vec_id < 1000]
    assert len(six) == 402 * 6 and {r.n for r in six} == {402}
    two = [r for r in out if r.vec_id is not None and r.vec_id >= 2000]
    # Two vectors differ along one direction only.
    assert [(r.component, r.n, round(abs(r.whitened), 9)) for r in two] == [(1, 2, 1.0)] * 2
    assert not [r for r in out if r.vec_id is not None and 1000 <= r.vec_id < 2000]
    assert whitening.whiten(d.limit(0)).count() == 0 and whitening.whiten(d.where("vec_id = 1003")).count() == 0
    assert whitening.whiten(d.where("vec_id = 7")).count() == 0  # one vector has no variance
    # Triangles and moments that meet in several levels give the same rows.
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    again = {(r.vec_id, r.component, round(abs(r.whitened), 8)) for r in whitening.whiten(d.repartition(9)).collect() if r.vec_id is not None}
    assert again == {(r.vec_id, r.component, round(abs(r.whitened), 8)) for r in out if r.vec_id is not None}


def test_huge_values(spark):
    """Sums beyond 64 bits are exact; a deviation that doesn't fit is null."""
    rows = [(i, [(-1.0) ** i * 1e11, float(i)]) for i in range(64)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 128 and all(r.deviation is None for r in out) and max(r.identity_error for r in out) < 1e-9
