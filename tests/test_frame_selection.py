"""As-of joins and greedy selection against plain code, on a long video, with ties, gaps and refusals."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from capturelake.functions import staging
from capturelake.operators import frames

FRAMES = "video_id long, frame_id long, timestamp_sec double, frame_index int, quality_score double, eligible boolean"


@pytest.mark.parametrize("bucket, rows", [(256, 100_000), (3, 100_000), (3, 2)])
def test_nearest_anchor_against_plain_code(spark, monkeypatch, bucket, rows):
    monkeypatch.setattr(frames, "BUCKET", bucket)
    monkeypatch.setattr(staging, "BROADCAST_ROWS", rows)
    rng = np.random.default_rng(2)
    f = [(v, i, float(t), i, float(rng.integers(0, 4)), bool(rng.random() > 0.2)) for v in range(4) for i, t in enumerate(np.concatenate([rng.integers(0, 30, 40) / 2, [1e6] if v == 1 else []]))]
    f += [(4, 0, 5.0, 0, 1.0, True), (5, 0, 5.0, 0, 1.0, False), (6, 0, None, 0, 1.0, True)]
    a = [(v, float(t)) for v in range(8) for t in [*rng.integers(-4, 70, 30) / 4, 2e6, 5e5]] + [(1, None), (1, 3.0), (1, 3.0)]
    d, anchors = spark.createDataFrame(f, FRAMES).repartition(3), spark.createDataFrame(a, "video_id long, anchor double")
    got = frames.nearest_anchor(d, anchors).collect()
    want = {}
    for v, t in set(a):
        own = [r for r in f if r[0] == v and r[5] and r[2] is not None]
        if own and t is not None:
            want[v, t] = min(own, key=lambda r: (abs(r[2] - t), -r[4], r[2], r[3], r[1]))
    assert len(got) == len(want) and all((r.frame_id, r.timestamp_sec) == (want[r.video_id, r.anchor][1], want[r.video_id, r.anchor][2]) for r in got)


def test_greedy_against_plain_code():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        times, rank = rng.integers(0, 12, n) / 4, rng.permutation(n)
        anchors = np.sort(rng.uniform(-1, 4, int(rng.integers(1, 50)))).round(2)
        free, want = set(range(n)), []
        for x in anchors:
            if not free:
                break
            best = min(free, key=lambda i: (abs(times[i] - x), rank[i]))
            free.remove(best)
            want.append(best)
        assert frames._greedy(times, rank, anchors) == want


def test_a_long_video_and_refusals(spark):
    began = time.time()
    rng = np.random.default_rng(4)
    chosen = frames._greedy(np.sort(rng.uniform(0, 1000, 1_000_000)), rng.permutation(1_000_000), np.linspace(0, 1000, 200_000))
    assert len(set(chosen)) == 200_000 and time.time() - began < 60
    rows = [(1, i, float(i), i, 0.5, False) for i in range(5)] + [(2, i, float(i), i, i / 10, i in (1, 2)) for i in range(6)] + [(3, 0, None, 0, 0.5, True), (4, 0, 1.0, 0, 0.5, True)]
    durations = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 1.0), (4, None)], "video_id long, duration_sec double")
    got = sorted(((r.video_id, r.frame_id, r.selection_reason) for r in frames.select_frames(spark.createDataFrame(rows, FRAMES), durations, 1.0, 4, 9).collect()), key=str)
    assert got == sorted([(1, None, "all_frames_rejected"), (2, 1, "temporal_coverage"), (2, 2, "temporal_coverage"), (2, 5, "budget_fallback"), (2, 4, "budget_fallback")], key=str)
    paths = spark.createDataFrame(rows, FRAMES).withColumn("path", F.when(F.col("frame_id") != 5, "p"))
    assert {r.frame_id for r in frames.select_frames(paths, durations, 1.0, 4, 9).where("video_id = 2").collect()} == {1, 2, 3, 4}
