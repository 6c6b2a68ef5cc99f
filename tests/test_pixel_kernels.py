"""Grid kernels: odd rows, several sizes in a batch, surfaces with known normals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from capturelake.operators import depth, images


def test_masks_of_odd_rows(spark):
    flat = [1.0] * 12
    rows = [(1, 3, 4, flat, flat), (2, 4, 3, flat, flat), (3, 3, 4, None, flat), (4, 3, 4, flat[:-1], flat), (5, None, 4, flat, flat), (6, 0, 0, [], []), (7, 3, 4, [0.0] * 12, flat), (8, 3, 4, [1.0] * 5 + [float("nan")] + [1.0] * 6, flat), (None, 3, 4, flat, flat), (1, 3, 4, flat, [9.0] + flat[1:])]
    d = spark.createDataFrame(rows, "frame_id int, height int, width int, depth array<float>, gray array<double>").withColumn("mask", F.lit("clash"))
    got = depth.depth_quality_masks(d.coalesce(1), erosion=0).collect()
    by = {(r.frame_id, tuple(r["mask"])) for r in got}
    assert sorted((r.frame_id for r in got), key=str) == sorted([1, 1, 2, 7, 8, None], key=str)
    assert (2, (True,) * 12) in by and (7, (False,) * 12) in by
    # The unusable pixel goes, and the ones whose right or lower neighbour it is.
    assert (8, tuple(k not in (1, 4, 5) for k in range(12))) in by
    eroded = {r.frame_id: r["mask"] for r in depth.depth_quality_masks(d.where("frame_id = 8"), erosion=1).collect()}
    assert [k for k, v in enumerate(eroded[8]) if v] == [3, 7, 10, 11]
    texture = {r.frame_id: r["mask"] for r in depth.texture_masks(d.where("get(gray, 0) = 9")).collect()}
    assert [k for k, v in enumerate(texture[1]) if v] == [0, 1, 4]
    assert depth.depth_quality_masks(d.limit(0)).count() == 0
    assert depth.depth_quality_masks(d.where("frame_id = 2"), gray=None).first()["mask"] == [True] * 12


def test_normals_of_planes():
    """A plane that faces the camera has normal z, a tilted one the tilt, whatever its distance."""
    h, w = 20, 30
    one = np.ones(2)
    flat = np.stack([np.full((h, w), 2.0), np.full((h, w), 5.0)])
    n = depth.normals(flat, 50 * one, 50 * one, 15 * one, 10 * one)
    assert np.allclose(n[:, 2], 1) and np.allclose(n[:, :2], 0) and n.shape == (2, 3, h - 2, w - 2)
    # z = 4 + 0.5 x with x = (u - cx) / fx * z
    u = (np.arange(w) - 15) / 50
    tilted = np.repeat((4 / (1 - 0.5 * u))[None, :], h, 0)[None]
    n = depth.normals(tilted, *(k[:1] for k in (50 * one, 50 * one, 15 * one, 10 * one)))
    want = np.array([-0.5, 0, 1]) / np.sqrt(1.25)
    assert np.allclose(np.abs(n[0]), np.abs(want)[:, None, None], atol=1e-3)


def test_normal_consistency_of_few_pixels(spark):
    grid = [1.0 + 0.01 * k for k in range(36)]
    rows = [(1, 6, 6, grid, grid, grid, 10.0), (2, 6, 6, grid, grid, grid, None), (3, 2, 18, grid, grid, grid, 10.0), (4, 6, 6, None, grid, grid, 10.0), (5, 1, 36, grid, grid, grid, 10.0)]
    d = spark.createDataFrame(rows, "frame_id long, height int, width int, predicted array<double>, reference array<double>, gray array<double>, fx double").withColumns({"fy": F.lit(10), "cx": F.lit(3), "cy": F.lit(3)})
    got = {r.frame_id: (r.pixels, r.normal_inconsistency) for r in depth.normal_consistency(d, least=5, erosion=0).collect()}
    assert set(got) == {1, 2, 3, 5} and got[1][0] >= 5 and got[1][1] == pytest.approx(0, abs=1e-12) and got[2][1] is None and got[3] == (0, None) and got[5] == (0, None)
    assert {r.normal_inconsistency for r in depth.normal_consistency(d, erosion=0).collect()} == {None}


def test_motion(spark):
    rows = [(1, 0, 1, 4, bytes([0, 0, 0, 0])), (1, 5, 1, 4, bytes([255, 0, 0, 0])), (1, 7, 2, 2, bytes([0, 0, 0, 0])), (1, 8, 2, 2, None), (1, 9, 2, 2, bytes([1, 1, 1, 1])), (2, 1, 1, 1, bytes([9])), (None, 3, 1, 1, bytes([9]))]
    d = spark.createDataFrame(rows, "video_id long, frame_index long, height int, width int, data binary")
    got = {(r.video_id, r.frame_index): r.motion_score for r in images.frame_motion(d).collect()}
    assert got == {(1, 0): None, (1, 5): 0.25, (1, 7): None, (1, 8): None, (1, 9): None, (2, 1): None}
