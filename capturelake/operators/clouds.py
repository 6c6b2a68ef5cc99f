"""Splat and point clouds: vertex quality, voxel distances, plane metrics, registration. The key is ``scene_id``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.staging import scene_join, staged
from .grid import nearest_by_cell
from .quantiles import exact_percentiles, joined

XYZ = ("x", "y", "z")


def crop_roi(points: DataFrame, roi: DataFrame) -> DataFrame:
    """Points inside of their scene's box, ends included; roi: scene_id, x_min .. z_max, one row per scene."""
    inside = F.lit(True)
    for c in XYZ:
        inside = inside & F.col(c).between(F.col(f"{c}_min"), F.col(f"{c}_max"))
    return scene_join(points, roi, "scene_id").where(inside).select(*points.columns)


def voxel(c: str, size: float):
    """Cell of a coordinate, cut towards zero as an integer cast does."""
    return (F.col(c) * F.lit(1.0 / max(size, 1e-12))).cast("long")


def voxel_dedup(points: DataFrame, size: float, key: Sequence[str] = ("scene_id",), order: str = "vertex_id") -> DataFrame:
    """The first point of each cell."""
    d = points.withColumns({f"v{c}": voxel(c, size) for c in XYZ})
    first = F.min_by(F.struct(order, *XYZ), order).alias("p")
    return d.groupBy(*key, *[f"v{c}" for c in XYZ]).agg(first).select(*key, "p.*")


def voxel_neighbor_distance(source: DataFrame, target: DataFrame, size: float, max_distance: float, key: str = "scene_id", order: str = "vertex_id") -> DataFrame:
    """Distance of each source point to the nearest target in its 27 neighbouring cells, max_distance if there is none.

    Points meet by tiles of cells (``grid``), so each cloud is shuffled about once and dense tiles are halved. The result is one row per source
    point; a coordinate that is null or not finite is near nothing.
    """
    cell = lambda c: F.when(X.is_finite(F.col(c)), voxel(c, size))
    near = nearest_by_cell(source, target, cell, key, order)
    return near.select(key, order, F.least(F.sqrt(F.coalesce("d2", F.lit(max_distance**2))), F.lit(max_distance)).alias("distance"))


def f_score(accuracy: DataFrame, completeness: DataFrame, threshold: float, key: str = "scene_id") -> DataFrame:
    share = lambda d, n: d.groupBy(key).agg(F.avg((F.col("distance") <= threshold).cast("double")).alias(n))
    d = share(accuracy, "precision").join(share(completeness, "recall").hint("merge"), key)
    p, r = F.col("precision"), F.col("recall")
    return d.withColumn("f_score", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def gaussian_quality(vertices: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Counts, opacity, anisotropy and quaternion shares of each scene; percentiles are exact and hold no large scene's values."""
    core = X.core_finite()
    opacity, stretch = X.activated_opacity(F.col("opacity")), X.anisotropy()
    on_core = lambda c: F.when(core, c)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    q = [F.col(f"rot_{i}") for i in range(4)]
    middle = exact_percentiles(vertices, ["scene_id"], {"opacity_q50": (on_core(opacity), 0.5), "anisotropy_q50": (on_core(stretch), 0.5), "anisotropy_q99": (on_core(stretch), 0.99)})
    shares = vertices.groupBy("scene_id").agg(
        F.count("*").alias("vertex_count"), F.avg(core.cast("double")).alias("finite_core_fraction"), F.avg(X.effective(threshold).cast("double")).alias("effective_fraction"),
        zero(F.avg(on_core((opacity > 0.1).cast("double")))).alias("opacity_gt_01_fraction"), zero(F.avg(on_core((opacity > 0.5).cast("double")))).alias("opacity_gt_05_fraction"),
        F.avg(X.unit_quaternion(q).cast("double")).alias("quaternion_within_1pct_fraction"),
    )
    return joined(shares, middle, ["scene_id"]).withColumns({n: zero(F.col(n)) for n in ("opacity_q50", "anisotropy_q50", "anisotropy_q99")})


def anisotropy_penalty(vertices: DataFrame, log_limit: float) -> DataFrame:
    """Mean squared excess of the log ratio of a vertex's longest and shortest axis."""
    s = [F.col(f"scale_{i}") for i in range(3)]
    return vertices.groupBy("scene_id").agg(F.avg(F.pow(F.greatest(F.greatest(*s) - F.least(*s) - log_limit, F.lit(0.0)), F.lit(2.0))).alias("penalty"))


def drop_nonfinite(vertices: DataFrame, most: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Vertices with finite fields, and (scene_id, removed_ratio, refused); a scene above ``most`` is refused whole."""
    fields = [c for c in vertices.columns if c in X.CORE or c.startswith("f_rest_")]
    good = X.core_finite(fields)
    report = vertices.groupBy("scene_id").agg(F.avg((~good).cast("double")).alias("removed_ratio")).withColumn("refused", F.col("removed_ratio") > most)
    return vertices.where(good).join(report.where("NOT refused").select("scene_id"), "scene_id", "left_semi"), report


def vertex_field_violations(vertices: DataFrame) -> DataFrame:
    """Number of non-finite values of each field, and of zero-length quaternions, by scene; fields without any are left out."""
    fields = [c for c in vertices.columns if c not in ("scene_id", "vertex_id")]
    norm = X.quaternion_norm([F.col(f"rot_{i}") for i in range(4)])
    counts = vertices.groupBy("scene_id").agg(*[F.count_if(~X.is_finite(F.col(c))).alias(c) for c in fields], F.count_if(norm == 0).alias("zero_quaternion"))
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("bad")) for c in (*fields, "zero_quaternion")])
    return counts.select("scene_id", F.explode(F.filter(each, lambda e: e["bad"] > 0)).alias("e")).select("scene_id", "e.*")


def _principal_axes(moments: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for r in moments.itertuples(index=False):
        m = np.array([[r.xx, r.xy, r.xz], [r.xy, r.yy, r.yz], [r.xz, r.yz, r.zz]])
        _, v = np.linalg.eigh(np.nan_to_num(m))
        axes = v.T[::-1]  # longest first
        axes = axes * np.where(axes[np.arange(3), np.abs(axes).argmax(1)] < 0, -1, 1)[:, None]  # one sign for each axis
        rows.append([r.scene_id, *axes.ravel()])
    return pd.DataFrame(rows, columns=["scene_id", *[f"a{i}{c}" for i in range(3) for c in XYZ]])


def _largest_share(cells: pd.DataFrame) -> pd.DataFrame:
    """Share of a scene's occupied cells in its largest 4-connected component; at most grid * grid cells."""
    left, sizes = set(zip(cells["gu"], cells["gv"], strict=True)), []
    total = len(left)
    while left:
        stack, n = [left.pop()], 0
        while stack:
            a, b = stack.pop()
            n += 1
            for c in ((a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)):
                if c in left:
                    left.remove(c)
                    stack.append(c)
        sizes.append(n)
    return pd.DataFrame({"scene_id": [cells["scene_id"].iloc[0]], "cells": [total], "largest": [max(sizes) / total]})


def plane_metrics(points: DataFrame, grid: int = 128) -> DataFrame:
    """Median distance to the main plane by the box diagonal, share of occupied grid cells and of the largest patch.

    Null for scenes of fewer than four points, 0 for degenerate ones. Moments, residuals and cells are
    aggregates; only the 3x3 axes and the labelling of at most ``grid ** 2`` cells run in Python, per scene.
    """
    cov = lambda a, b: F.covar_pop(a, b).alias(a + b)
    m = points.groupBy("scene_id").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{c}") for c in XYZ], *[cov(a, b) for i, a in enumerate(XYZ) for b in XYZ[i:]], F.sqrt(sum(((F.max(c) - F.min(c)) ** 2 for c in XYZ[1:]), (F.max("x") - F.min("x")) ** 2)).alias("diagonal"))
    axes = m.select("scene_id", "xx", "xy", "xz", "yy", "yz", "zz").mapInPandas(lambda it: (_principal_axes(t) for t in it), "scene_id long, " + ", ".join(f"a{i}{c} double" for i in range(3) for c in XYZ))
    d = scene_join(points, staged(m.join(axes.hint("merge"), "scene_id"), "cloud-axes"), "scene_id")
    on = lambda i: sum(((F.col(c) - F.col(f"m{c}")) * F.col(f"a{i}{c}") for c in XYZ[1:]), (F.col("x") - F.col("mx")) * F.col(f"a{i}x"))
    d = d.select("scene_id", "n", "diagonal", on(0).alias("u"), on(1).alias("v"), F.abs(on(2)).alias("residual"))
    s = d.groupBy("scene_id").agg(F.first("n").alias("n"), F.first("diagonal").alias("diagonal"), F.median("residual").alias("residual"), F.min("u").alias("u0"), F.max("u").alias("u1"), F.min("v").alias("v0"), F.max("v").alias("v1"))
    wide = (F.col("n") >= 4) & (F.col("diagonal") >= 1e-12) & (F.col("u1") - F.col("u0") >= 1e-12) & (F.col("v1") - F.col("v0") >= 1e-12)
    at = lambda c: F.least(F.lit(grid - 1), ((F.col(c) - F.col(f"{c}0")) / (F.col(f"{c}1") - F.col(f"{c}0")) * (grid - 1)).cast("int"))
    s = staged(s, "cloud-planes")
    cells = scene_join(d.select("scene_id", "u", "v"), s.where(wide), "scene_id").select("scene_id", at("u").alias("gu"), at("v").alias("gv")).distinct()
    patches = cells.groupBy("scene_id").applyInPandas(_largest_share, "scene_id long, cells long, largest double")
    out = s.join(patches.hint("merge"), "scene_id", "left")
    few = F.col("n") < 4
    zero = lambda c: F.when(few, None).otherwise(F.coalesce(c, F.lit(0.0)))
    return out.select("scene_id", zero(F.when(F.col("diagonal") >= 1e-12, F.col("residual") / F.col("diagonal"))).alias("median_residual_diag_fraction"), zero(F.col("cells") / float(grid * grid)).alias("grid_occupancy"), zero(F.col("largest")).alias("largest_component_fraction"))


SIM3 = "scene_id long, scale double, rotation array<double>, translation array<double>, violation string"


def _least_axis(moments: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for r in moments.itertuples(index=False):
        m = np.array([[getattr(r, f"s{min(a, b)}s{max(a, b)}") for b in XYZ] for a in XYZ])
        value, v = np.linalg.eigh(np.nan_to_num(m))
        rows.append([r.scene_id, *v[:, 0], float(value[-1])])
    return pd.DataFrame(rows, columns=["scene_id", "ax", "ay", "az", "widest"])


def _umeyama(moments: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for r in moments.itertuples(index=False):
        out = {"scene_id": r.scene_id, "scale": None, "rotation": None, "translation": None, "violation": None}
        if r.n < 4:
            rows.append(out | {"violation": "too_few_pairs"})
            continue
        if np.sqrt(r.thinnest) < 1e-10 * np.sqrt(r.widest):
            rows.append(out | {"violation": "coplanar"})
            continue
        ms, mt = np.array([r.msx, r.msy, r.msz]), np.array([r.mtx, r.mty, r.mtz])
        u, d, vh = np.linalg.svd(np.array([[getattr(r, f"t{a}s{b}") for b in XYZ] for a in XYZ]))
        flip = np.array([1, 1, np.sign(np.linalg.det(u @ vh))])
        rotation = (u * flip) @ vh
        scale = float((d * flip).sum() / (r.sxsx + r.sysy + r.szsz))
        rows.append(out | {"scale": scale, "rotation": rotation.ravel().tolist(), "translation": (mt - scale * rotation @ ms).tolist()})
    return pd.DataFrame(rows, columns=["scene_id", "scale", "rotation", "translation", "violation"])


def estimate_sim3(pairs: DataFrame) -> DataFrame:
    """Scale, rotation and translation (least squares) of each scene's point pairs s -> t; violation if they don't do.

    Moments are aggregates; the spread along the thinnest axis is a second one, as moments alone are too coarse for
    it. Only 3x3 matrices reach Python, one row per scene.
    """
    cov = lambda a, b: F.covar_pop(a, b).alias(a + b)
    s, t = [f"s{c}" for c in XYZ], [f"t{c}" for c in XYZ]
    m = pairs.groupBy("scene_id").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{c}") for c in (*s, *t)], *[cov(a, b) for i, a in enumerate(s) for b in s[i:]], *[cov(a, b) for a in t for b in s])
    axes = m.select("scene_id", *[a + b for i, a in enumerate(s) for b in s[i:]]).mapInPandas(lambda it: (_least_axis(x) for x in it), "scene_id long, ax double, ay double, az double, widest double")
    m = staged(m.join(axes.hint("merge"), "scene_id"), "pair-moments")
    on = sum(((F.col(f"s{c}") - F.col(f"ms{c}")) * F.col(f"a{c}") for c in XYZ[1:]), (F.col("sx") - F.col("msx")) * F.col("ax"))
    thin = scene_join(pairs, m.select("scene_id", "msx", "msy", "msz", "ax", "ay", "az"), "scene_id").groupBy("scene_id").agg(F.var_pop(on).alias("thinnest"))
    return m.join(thin.hint("merge"), "scene_id").mapInPandas(lambda it: (_umeyama(x) for x in it), SIM3)


def apply_sim3(points: DataFrame, sim3: DataFrame) -> DataFrame:
    r, t = F.col("rotation"), F.col("translation")
    p = [F.col(c) for c in XYZ]
    new = {c: F.col("scale") * (p[0] * r[3 * i] + p[1] * r[3 * i + 1] + p[2] * r[3 * i + 2]) + t[i] for i, c in enumerate(XYZ)}
    return scene_join(points, staged(sim3.where("violation IS NULL"), "sim3"), "scene_id").withColumns(new).select(*points.columns)


def compare_clouds(model: DataFrame, laser: DataFrame, pairs: DataFrame, roi: DataFrame, size: float = 0.02, max_distance: float = 1.0, thresholds: Sequence[float] = (0.02, 0.05)) -> DataFrame:
    """Register the model to the laser cloud, crop, thin by voxel, and compare both ways: one row per scene."""
    single = lambda d: d.withColumns({c: F.col(c).cast("float").cast("double") for c in XYZ})
    m = staged(voxel_dedup(single(crop_roi(apply_sim3(model, estimate_sim3(pairs)), roi)), size), "model-cloud")
    s = staged(voxel_dedup(single(crop_roi(laser, roi)), size), "laser-cloud")
    acc, comp = (staged(d, "distances") for d in (voxel_neighbor_distance(m, s, size, max_distance), voxel_neighbor_distance(s, m, size, max_distance)))
    def stat(d, n):
        middle = exact_percentiles(d, ["scene_id"], {f"{n}_median": (F.col("distance"), 0.5), f"{n}_p95": (F.col("distance"), 0.95)})
        return joined(d.groupBy("scene_id").agg(F.count("*").alias(f"{n}_points")), middle, ["scene_id"])

    out = stat(acc, "accuracy").join(stat(comp, "completeness").hint("merge"), "scene_id")
    for t in thresholds:
        out = out.join(f_score(acc, comp, t).select("scene_id", F.col("f_score").alias(f"f_score_{round(t * 100)}cm")).hint("merge"), "scene_id")
    return out.join(plane_metrics(m).hint("merge"), "scene_id", "left")
