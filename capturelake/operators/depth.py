"""Depth maps: coverage of frames, alignment fits, match quality and per-frame masks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import scene_join, staged
from .frames import key_set_status


def depth_coverage(frames: DataFrame, mapping: DataFrame, key: Sequence[str] = ("run_id", "path")) -> DataFrame:
    """Status of each path: matched, missing (no depth), unexpected (unused depth) or duplicate in the mapping."""
    twice = mapping.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    d = key_set_status(frames, mapping, list(key)).join(twice, list(key), "left")
    return d.withColumn("status", F.when(F.col("_n").isNotNull(), "duplicate").otherwise(F.col("status"))).drop("_n")


def fit_depth_alignment(pixels: DataFrame, least: int = 100, sigmas: float = 1.0, key: Sequence[str] = ("frame_id",)) -> DataFrame:
    """Line ``1 / d_ref = slope * v + offset`` of each frame; pixels off by more than one deviation go, then it is fitted anew.

    Returns slope, offset, correlation, rmse, rmse by the lower median, pixel counts and a reason (null if aligned). The
    deviation is the sample's; fewer than ``least`` pixels before or after give a reason. All but the median follows from moments, which are summed
    up in parts: pixels are read twice, and never sorted or shuffled by frame.
    """
    k, c = list(key), F.col
    d = pixels.where("d_ref > 0").withColumn("w", 1 / c("d_ref")).select(F.struct(*k).alias("frame"), "v", "w")
    n, vv, ww, vw = F.count("*").alias("n"), F.var_pop("v").alias("vv"), F.var_pop("w").alias("ww"), F.covar_pop("v", "w").alias("vw")
    line = {"a": F.when(c("vv") > 0, c("vw") / c("vv"))}
    first = d.groupBy("frame").agg(n, F.avg("v").alias("mv"), F.avg("w").alias("mw"), vv, ww, vw).withColumns(line).withColumn("b", c("mw") - c("a") * c("mv"))
    # Residuals of a least squares line have mean 0, and their spread follows from the moments.
    spread = F.sqrt(F.greatest(c("ww") - c("a") * c("vw"), F.lit(0.0)) * c("n") / F.when(c("n") > 1, c("n") - 1))
    first = staged(first.select("frame", c("n").alias("pixels"), "a", "b", (sigmas * spread).alias("most")), "first-fit")
    kept = scene_join(d, first.select("frame", "a", "b", "most"), "frame").where(F.abs(c("w") - (c("a") * c("v") + c("b"))) <= c("most"))
    second = kept.groupBy("frame").agg(n, F.avg("v").alias("mv"), F.avg("w").alias("mw"), vv, ww, vw, F.corr("v", "w").alias("correlation"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY w)").alias("middle")).withColumns(line)
    second = second.select(c("frame").alias("_frame"), c("n").alias("kept"), c("a").alias("slope"), (c("mw") - c("a") * c("mv")).alias("offset"), "correlation", F.sqrt(F.greatest(c("ww") - c("a") * c("vw"), F.lit(0.0))).alias("rmse"), "middle")
    out = first.join(second.hint("merge"), c("frame").eqNullSafe(c("_frame")), "left")
    reason = F.when(c("pixels") < least, "too_few_pixels").when(F.coalesce("kept", F.lit(0)) < least, "too_few_inliers").when(c("slope") <= 0, "nonpositive_slope")
    return out.select("frame.*", "pixels", "kept", "slope", "offset", "correlation", "rmse", (c("rmse") / c("middle")).alias("normalized_rmse"), reason.alias("reason"))


def match_quality(matches: DataFrame, most_residual: float = 4.0, grid: int = 4, key: Sequence[str] = ("frame_id",)) -> DataFrame:
    """Matches, inliers, reprojection RMSE, share of grid cells with an inlier and of positive depths; u, v in 0..1."""
    inlier = F.abs("residual") <= most_residual
    at = lambda c: F.least(F.greatest(F.floor(F.col(c) * grid), F.lit(0)), F.lit(grid - 1))
    d = matches.groupBy(*key).agg(
        F.count("*").alias("match_count"), F.count_if(inlier).alias("inlier_count"), F.sqrt(F.avg(F.when(inlier, F.col("residual") ** 2))).alias("reprojection_rmse_px"),
        (F.count_distinct(F.when(inlier, at("v") * grid + at("u"))) / float(grid * grid)).alias("grid_coverage"), F.avg((F.col("depth") > 0).cast("double")).alias("positive_depth_ratio"),
    )
    return d.withColumn("inlier_ratio", F.col("inlier_count") / F.col("match_count").cast("double"))


def depth_masks(depths: DataFrame, quantile: float = 0.9, erosion: int = 1) -> DataFrame:
    """Shares of reliable and textured pixels of each depth map (frame_id, height, width, depth floats): not at the steepest edges, eroded."""

    def run(batches):
        for t in batches:
            rows = []
            for r in t.itertuples(index=False):
                d = np.asarray(r.depth, float).reshape(r.height, r.width)
                ok = np.isfinite(d) & (d > 0)
                gy, gx = np.gradient(np.where(ok, d, 0))
                edge = np.hypot(gx, gy)
                good = ok & (edge <= np.quantile(edge[ok], quantile)) if ok.any() else ok
                for _ in range(erosion):
                    p = np.pad(good, 1)
                    good = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
                rows.append((r.frame_id, float(ok.mean()), float(good.mean()), float((edge > 1e-3)[ok].mean()) if ok.any() else 0.0))
            yield pd.DataFrame(rows, columns=["frame_id", "valid_ratio", "reliable_ratio", "texture_ratio"])

    return depths.select("frame_id", "height", "width", "depth").mapInPandas(run, "frame_id long, valid_ratio double, reliable_ratio double, texture_ratio double")


def _stacked(b: pa.RecordBatch, grids: Sequence[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray | None]]]:
    """(places in the batch, one array (n, height, width) of each column) of the rows of a batch that have one size.

    Rows whose grids are null or of another length than height times width are left out.
    """
    height, width = (b.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("height", "width"))
    good = (height > 0) & (width > 0)
    columns = [b.column(g) for g in grids]
    for c in columns:
        good &= pc.fill_null(pc.list_value_length(c), -1).to_numpy(zero_copy_only=False) == height * width
    for h, w in sorted(set(zip(height[good].tolist(), width[good].tolist(), strict=True))):
        at = np.flatnonzero(good & (height == h) & (width == w))
        yield at, [pc.list_flatten(c.take(pa.array(at))).to_numpy(zero_copy_only=False).astype(float).reshape(len(at), h, w) for c in columns]


def _edges(x: np.ndarray) -> np.ndarray:
    """Sum of the absolute differences to the right and lower neighbour."""
    out = np.zeros_like(x)
    out[:, :, :-1] += np.abs(np.diff(x, axis=2))
    out[:, :-1, :] += np.abs(np.diff(x, axis=1))
    return out


def _eroded(mask: np.ndarray) -> np.ndarray:
    """Pixels all of whose four neighbours are in the mask; what lies outside of the image does not count."""
    out = mask.copy()
    out[:, :-1] &= mask[:, 1:]
    out[:, 1:] &= mask[:, :-1]
    out[:, :, :-1] &= mask[:, :, 1:]
    out[:, :, 1:] &= mask[:, :, :-1]
    return out


def quality_mask(depth: np.ndarray, gray: np.ndarray | None, depth_quantile: float, gray_quantile: float, erosion: int) -> np.ndarray:
    """Masks of a stack of maps (n, height, width): usable depths that lie on no steep edge of depth or image."""
    valid = np.isfinite(depth) & (depth > 0)
    mask = valid.copy()
    for grid, q in ((depth, depth_quantile), *(((gray, gray_quantile),) if gray is not None else ())):
        with np.errstate(invalid="ignore"):
            edge = _edges(grid)
        # Next to a value that isn't finite there is an edge, but none that moves the limit.
        known = np.where(valid & np.isfinite(edge), edge, np.nan)
        some = ~np.isnan(known).all((1, 2))
        limit = np.full(len(grid), -1.0)
        limit[some] = np.nanquantile(known[some], q, axis=(1, 2))
        mask &= np.nan_to_num(edge, nan=np.inf) <= limit[:, None, None]
    for _ in range(erosion):
        mask = _eroded(mask)
    return mask


def normals(depth: np.ndarray, fx: np.ndarray, fy: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
    """Unit normals (n, 3, height - 2, width - 2) of the surfaces that depth maps show, from central differences of back-projected points."""
    _, h, w = depth.shape
    per = lambda k: k[:, None, None]
    x = (np.arange(w)[None, None, :] - per(cx)) / per(fx) * depth
    y = (np.arange(h)[None, :, None] - per(cy)) / per(fy) * depth
    points = np.stack([x, y, depth], 1)
    along = (points[:, :, 1:-1, 2:] - points[:, :, 1:-1, :-2]) / 2
    down = (points[:, :, 2:, 1:-1] - points[:, :, :-2, 1:-1]) / 2
    out = np.cross(along, down, axis=1)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-8)


def _masks(rows: DataFrame, key: str, grids: list[str], kernel) -> DataFrame:
    def run(batches):
        for b in batches:
            for at, stack in _stacked(b, grids):
                mask = kernel(*stack)
                bounds = np.arange(0, mask.size + 1, mask[0].size, dtype=np.int32)
                take = [b.column(c).take(pa.array(at)) for c in (key, "height", "width")]
                yield pa.RecordBatch.from_arrays([*take, pa.ListArray.from_arrays(pa.array(bounds), pa.array(mask.ravel()))], [key, "height", "width", "mask"])

    d = rows.select(key, F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), *[F.col(g).cast("array<double>").alias(g) for g in grids])
    return d.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, height int, width int, mask array<boolean>")


def depth_quality_masks(depths: DataFrame, depth_quantile: float = 0.9, gray_quantile: float = 0.95, erosion: int = 2, key: str = "frame_id", gray: str | None = "gray") -> DataFrame:
    """The mask of each depth map (key, height, width, depth and gray by rows): key, height, width, mask.

    A pixel stays if its depth is positive and finite and neither the depth's nor the image's step to its right and lower neighbours is above the
    quantile over usable pixels; then ``erosion`` times the pixels next to others go. Rows whose grids are null or of another size are left
    out. ``gray`` None: depth only. Maps of one size are worked off together.
    """
    return _masks(depths, key, ["depth", *([gray] if gray else [])], lambda d, g=None: quality_mask(d, g, depth_quantile, gray_quantile, erosion))


def texture_masks(images: DataFrame, threshold: float = 0.05, key: str = "frame_id", gray: str = "gray") -> DataFrame:
    """Pixels whose absolute differences to their four neighbours sum to more than ``threshold``: key, height, width, mask."""

    def kernel(g):
        step = np.zeros_like(g)
        across, down = np.abs(np.diff(g, axis=2)), np.abs(np.diff(g, axis=1))
        step[:, :, :-1] += across
        step[:, :, 1:] += across
        step[:, :-1] += down
        step[:, 1:] += down
        return step > threshold

    return _masks(images, key, [gray], kernel)


def normal_consistency(maps: DataFrame, least: int = 1000, depth_quantile: float = 0.9, gray_quantile: float = 0.95, erosion: int = 2, key: str = "frame_id", gray: str | None = "gray") -> DataFrame:
    """Mean of 1 - cosine between the normals of predicted and reference depth over the reference's quality mask, without the border.

    maps: key, height, width, predicted, reference, gray, fx, fy, cx, cy. Returns key, pixels, normal_inconsistency: null below ``least`` pixels,
    so that a frame with hardly any pixels does not count as perfect. Rows with null or odd grids are left out; maps of less than three
    rows or columns have no pixels.
    """
    grids, cameras = ["predicted", "reference", *([gray] if gray else [])], ["fx", "fy", "cx", "cy"]

    def run(batches):
        for b in batches:
            for at, (predicted, reference, *g) in _stacked(b, grids):
                intrinsics = [b.column(c).take(pa.array(at)).fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in cameras]
                mask = quality_mask(reference, g[0] if g else None, depth_quantile, gray_quantile, erosion)[:, 1:-1, 1:-1]
                n = mask.sum((1, 2))
                if mask.size:
                    with np.errstate(invalid="ignore", divide="ignore"):
                        cosine = np.clip((normals(predicted, *intrinsics) * normals(reference, *intrinsics)).sum(1), -1, 1)
                        mean = np.where(mask, 1 - cosine, 0).sum((1, 2)) / n
                else:
                    mean = np.full(len(at), np.nan)
                known = (n >= least) & np.isfinite(mean)
                yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(at)), pa.array(n.astype(np.int64)), pa.array(np.where(known, mean, 0.0), mask=~known)], [key, "pixels", "normal_inconsistency"])

    d = maps.select(key, F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), *[F.col(x).cast("array<double>").alias(x) for x in grids], *[F.col(c).cast("double").alias(c) for c in cameras])
    return d.mapInArrow(run, f"{key} {maps.schema[key].dataType.simpleString()}, pixels long, normal_inconsistency double")
