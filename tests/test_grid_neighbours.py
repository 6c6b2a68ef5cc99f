"""Neighbours by tiles against all pairs in plain code, with tiles halved, odd coordinates and repeated points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from capturelake.operators import clouds, grid


def plain(source, target, size, most):
    out = {}
    cell = lambda p: np.trunc(np.array(p) * (1.0 / size))
    for k, i, *p in source:
        best = most
        if all(v is not None and np.isfinite(v) for v in p):
            for k2, _, *q in target:
                if k == k2 and all(v is not None and np.isfinite(v) for v in q) and np.abs(cell(p) - cell(q)).max() <= 1:
                    best = min(best, float(np.sqrt(sum((a - b) ** 2 for a, b in zip(p, q, strict=True)))))
        out[k, i] = min(best, out.get((k, i), best))
    return out


@pytest.mark.parametrize("most, gather", [(20_000, 100_000), (20_000, 40), (7, 50)])
def test_neighbours_against_all_pairs(spark, monkeypatch, most, gather):
    monkeypatch.setattr(grid, "MOST", most)
    monkeypatch.setattr(grid, "GATHER", gather)
    if gather < 100:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    rng = np.random.default_rng(6)

    def cloud(n, start):
        p = np.concatenate([rng.uniform(-2, 2, (n, 3)), rng.normal(0, 0.05, (n, 3))])
        rows = [("ab"[i % 2], start + i, *map(float, v)) for i, v in enumerate(p)]
        return [*rows, (None, start - 1, 0.0, 0.0, 0.0), ("a", start - 2, None, 0.0, 0.0), ("a", start - 3, float("nan"), 0.0, 0.0), ("b", start - 4, float("inf"), 1.0, 0.0), rows[0], ("only" + str(start), start, 0.0, 0.0, 0.0)]

    s, t = cloud(150, 1000), cloud(170, 5000)
    make = lambda rows: spark.createDataFrame(rows, "scene_id string, vertex_id long, x double, y double, z double").withColumn("source", F.lit("clash")).repartition(3)
    got = {(r.scene_id, r.vertex_id): r.distance for r in clouds.voxel_neighbor_distance(make(s), make(t), 0.1, 0.5).collect()}
    want = plain(s, t, 0.1, 0.5)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert sum(v < 0.5 for v in want.values()) > 150
    assert clouds.voxel_neighbor_distance(make(s).limit(0), make(t), 0.1, 0.5).count() == 0
    assert {r.distance for r in clouds.voxel_neighbor_distance(make(s), make(t).limit(0), 0.1, 0.5).collect()} == {0.5}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
