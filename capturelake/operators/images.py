"""Rendered views: pairing, image metrics and verdicts. Pixels come as rows or as packed arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import violations
from ..functions.staging import dealt, staged
from .quantiles import exact_percentiles, joined


def pair_views(left: DataFrame, right: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Views of both sides at each ordinal, with status paired, left_only or right_only."""
    l_, r = left.select(*key, "ordinal", F.col("view").alias("left_view")), right.select(*key, "ordinal", F.col("view").alias("right_view"))
    d = l_.join(r, [*key, "ordinal"], "full_outer")
    return d.withColumn("status", F.when(F.col("right_view").isNull(), "left_only").when(F.col("left_view").isNull(), "right_only").otherwise("paired"))


def image_pair_metrics(pixels: DataFrame, key: Sequence[str] = ("run_id", "ordinal"), left: str = "left_v", right: str = "right_v") -> DataFrame:
    """mse, psnr (null for equal images), SSIM over all pixels at once, and mean absolute difference; values in 0..1."""
    a, b = F.col(left), F.col(right)
    d = pixels.groupBy(*key).agg(F.avg((a - b) * (a - b)).alias("mse"), F.avg(F.abs(a - b)).alias("mean_abs_diff"), F.avg(a).alias("_ma"), F.avg(b).alias("_mb"), F.var_pop(a).alias("_va"), F.var_pop(b).alias("_vb"), F.covar_pop(a, b).alias("_ab"))
    c1, c2, c = 0.01**2, 0.03**2, F.col
    ssim = ((2 * c("_ma") * c("_mb") + c1) * (2 * c("_ab") + c2)) / ((c("_ma") ** 2 + c("_mb") ** 2 + c1) * (c("_va") + c("_vb") + c2))
    return d.select(*key, "mse", F.when(c("mse") > 0, 10 * F.log10(1 / c("mse"))).alias("psnr"), ssim.alias("ssim"), "mean_abs_diff")


def view_metric_summary(metrics: DataFrame, key: Sequence[str] = ("run_id",), names: Sequence[str] = ("mse", "psnr", "ssim", "mean_abs_diff")) -> DataFrame:
    """Mean, least, 10th percentile and greatest of each metric; nulls are skipped."""
    out = metrics.groupBy(*key).agg(F.count("*").alias("views"), *[f.alias(f"{n}_{s}") for n in names for s, f in (("mean", F.avg(n)), ("min", F.min(n)), ("max", F.max(n)))])
    return joined(out, exact_percentiles(metrics, key, {f"{n}_p10": (F.col(n), 0.1) for n in names}), key)


def postcheck_metrics(metrics: DataFrame, brightness: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Mean and least PSNR and SSIM, and health: fail if all images are black. brightness: key, image_mean."""
    m = metrics.groupBy(*key).agg(F.avg("psnr").alias("mean_psnr"), F.min("psnr").alias("min_psnr"), F.avg("ssim").alias("mean_ssim"), F.min("ssim").alias("min_ssim"))
    b = brightness.groupBy(*key).agg(F.max("image_mean").alias("max_image_mean"))
    return m.join(b, list(key), "left").withColumn("health", F.when(F.coalesce("max_image_mean", F.lit(0.0)) < 1e-4, "fail").otherwise("needs_review"))


def render_health(images: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Whether all of a run's images are black, alike or flat. images: key, mean, std, sha (means and deviations on 0..255)."""
    d = images.groupBy(*key).agg(F.count("*").alias("images"), F.max("mean").alias("max_mean"), F.min("mean").alias("min_mean"), F.max("std").alias("max_std"), F.min("std").alias("min_std"), F.count_distinct("sha").alias("distinct"))
    d = d.withColumn("all_black", F.col("max_mean") < 1e-4).withColumn("all_identical", (F.col("images") > 1) & (F.col("distinct") == 1)).withColumn("all_flat", F.col("max_std") < 1e-5).withColumn("low_contrast", F.col("max_std") < 1)
    return d.withColumn("status", F.when(F.col("all_black") | F.col("all_identical") | F.col("all_flat"), "fail").when(F.col("low_contrast"), "warn").otherwise("pass"))


def converted_eval_verdict(metrics: DataFrame, key: Sequence[str] = ("run_id",), most_mse: float = 0.25, visual: tuple[float, float] = (20.0, 0.75)) -> DataFrame:
    """Structural and visual verdict of each run's converted views."""
    d = metrics.groupBy(*key).agg(F.count("*").alias("views"), F.count_if(F.col("mse").isNull()).alias("empty_views"), F.count_if(F.col("mse") > most_mse).alias("bad_views"), F.avg("psnr").alias("psnr"), F.avg("ssim").alias("ssim"))
    d = d.withColumn("structural_pass", (F.col("views") > 0) & (F.col("empty_views") == 0) & (F.col("bad_views") < F.col("views")))
    d = d.withColumn("visual_pass", F.coalesce((F.col("psnr") >= visual[0]) & (F.col("ssim") >= visual[1]), F.lit(False)))
    advisories = violations(view_mse_above_limit=F.col("bad_views") > 0, low_psnr=F.col("psnr") < visual[0], low_ssim=F.col("ssim") < visual[1])
    return d.withColumn("advisories", advisories).withColumn("status", F.when(~F.col("structural_pass"), "failed").when(F.col("visual_pass"), "passed").otherwise("needs_review"))


def endpoint_match(views: DataFrame, poses: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Input cameras that don't have exactly one pose with left = right = camera and alpha = 0 whose pixels are equal.

    views: key, camera, sha; poses: key, left, right, alpha, sha.
    """
    k = [*key, "camera"]
    ends = poses.where("left = right AND alpha = 0").select(*key, F.col("left").alias("camera"), F.col("sha").alias("_sha"), F.lit(0).alias("_view"), F.when(F.col("sha").isNotNull(), 1).otherwise(0).alias("_pose")).dropna(subset=k)
    rows = views.select(*k, F.col("sha").alias("_sha"), F.lit(1).alias("_view"), F.lit(0).alias("_pose")).unionByName(ends)
    rows = staged(rows, "endpoints")
    # Counts of equal rows first, so that texts are keys only and a task's memory is one table of hashes of its own part.
    each = dealt(rows, k, rows.count()).groupBy(*k, "_sha").agg(F.sum("_view").alias("_views"), F.sum("_pose").alias("_poses"))
    d = each.groupBy(*k).agg(F.sum("_views").alias("_views"), F.sum("_poses").alias("poses"), F.count("_sha").alias("_shas"), F.sum(F.when(F.col("_sha").isNotNull(), F.col("_views"))).alias("_known")).where("_views > 0")
    d = d.select(*k, (F.col("_views") * F.col("poses")).alias("poses"), ((F.col("_shas") == 1) & (F.col("_known") > 0) & (F.col("poses") > 0)).alias("equal"))
    return d.withColumn("violation", F.when(F.col("poses") == 0, "missing").when(F.col("poses") > 1, "several").when(~F.col("equal"), "pixels")).where("violation IS NOT NULL")


def cross_gap_midpoints(segments: DataFrame, poses: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Number of midpoint poses (alpha 0.5) between the last camera of a segment and the first of the next, and the time gap.

    segments: key, segment, first_camera, last_camera, start_sec, end_sec; exactly one midpoint is wanted.
    """
    w = Window.partitionBy(*key).orderBy("segment")
    gaps = segments.withColumn("next_camera", F.lead("first_camera").over(w)).withColumn("gap_sec", F.lead("start_sec").over(w) - F.col("end_sec")).where("next_camera IS NOT NULL")
    mid = poses.where("alpha = 0.5").groupBy(*key, F.col("left").alias("last_camera"), F.col("right").alias("next_camera")).agg(F.count("*").alias("midpoints"))
    d = gaps.join(mid, [*key, "last_camera", "next_camera"], "left")
    return d.select(*key, "segment", "last_camera", "next_camera", "gap_sec", F.coalesce("midpoints", F.lit(0)).alias("midpoints"))


def compare_runs(metrics: DataFrame, current, baseline, key: str = "run_id") -> DataFrame:
    """psnr and mean_abs_diff of two runs at the same ordinals."""
    side = lambda run, s: metrics.where(F.col(key) == run).select("ordinal", F.col("psnr").alias(f"psnr_{s}"), F.col("mean_abs_diff").alias(f"mad_{s}"))
    return side(current, "a").join(side(baseline, "b"), "ordinal").withColumn("psnr_delta", F.col("psnr_a") - F.col("psnr_b"))


def spread_indices(count, n: int, extra: Sequence[int] = ()):
    """n indices spread over 0..count-1, rounded half to even, and extras; as a column."""
    c = F.lit(count) if isinstance(count, int) else count
    even = F.transform(F.sequence(F.lit(0), F.least(F.lit(n), c) - 1), lambda i: F.bround(i * (c - 1) / F.greatest(F.least(F.lit(n), c) - 1, F.lit(1)).cast("double")).cast("int"))
    return F.array_sort(F.array_distinct(F.filter(F.concat(even, F.array(*[F.lit(e) for e in extra]).cast("array<int>")), lambda i: (i >= 0) & (i < c))))


def _gaussian_1d(size: int = 11, sigma: float = 1.5) -> np.ndarray:
    x = np.arange(size) - size // 2
    g = np.exp(-(x**2) / (2 * sigma**2))
    return g / g.sum()


def _blur(a: np.ndarray, g: np.ndarray) -> np.ndarray:
    pad = len(g) // 2
    a = np.pad(a, pad, mode="reflect" if min(a.shape) > pad else "edge")
    a = np.apply_along_axis(np.convolve, 0, a, g, "valid")
    return np.apply_along_axis(np.convolve, 1, a, g, "valid")


def windowed_ssim(a: np.ndarray, b: np.ndarray) -> float:
    """SSIM of two gray images (0..255) over 11x11 Gaussian windows."""
    g, c1, c2 = _gaussian_1d(), (0.01 * 255) ** 2, (0.03 * 255) ** 2
    a, b = a.astype(float), b.astype(float)
    ma, mb = _blur(a, g), _blur(b, g)
    va, vb, ab = _blur(a * a, g) - ma * ma, _blur(b * b, g) - mb * mb, _blur(a * b, g) - ma * mb
    return float((((2 * ma * mb + c1) * (2 * ab + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))).mean())


def pixel_pair_metrics(pairs: DataFrame, key: Sequence[str] = ("run_id", "ordinal")) -> DataFrame:
    """psnr (255 scale, null for equal images) and windowed gray SSIM of packed image pairs: key, height, width, left, right (bytes)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*key).schema) + ", psnr double, ssim double"

    def run(batches):
        for t in batches:
            out = []
            for r in t.itertuples(index=False):
                a, b = (np.frombuffer(x, np.uint8).reshape(r.height, r.width, -1).astype(float) for x in (r.left, r.right))
                mse = ((a - b) ** 2).mean()
                gray = lambda x: x @ np.array([0.299, 0.587, 0.114]) if x.shape[2] == 3 else x[:, :, 0]
                out.append((None if mse == 0 else float(10 * np.log10(255**2 / mse)), windowed_ssim(gray(a), gray(b))))
            yield t[list(key)].assign(psnr=[x[0] for x in out], ssim=[x[1] for x in out])

    return pairs.select(*key, "height", "width", "left", "right").mapInPandas(run, schema)


def frame_pixel_metrics(frames: DataFrame) -> DataFrame:
    """Laplacian variance, shares of bright and dark pixels and an 8x8 mean hash of each gray frame (video_id, frame_index, height, width, data)."""
    schema = "video_id long, frame_index long, sharpness double, overexposed_ratio double, underexposed_ratio double, mean_hash long"

    def run(batches):
        for t in batches:
            rows = []
            for r in t.itertuples(index=False):
                g = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width).astype(float)
                p = np.pad(g, 1, mode="edge")
                lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
                cell = np.array([[b.mean() for b in np.array_split(a, 8, axis=1)] for a in np.array_split(g, 8, axis=0)])
                bits = int("".join("1" if x else "0" for x in (cell > cell.mean()).ravel()), 2)
                rows.append((r.video_id, r.frame_index, lap.var(), (g >= 250).mean(), (g <= 5).mean(), bits - (1 << 64) if bits >> 63 else bits))
            yield pd.DataFrame(rows, columns=["video_id", "frame_index", "sharpness", "overexposed_ratio", "underexposed_ratio", "mean_hash"])

    d = frames.select("video_id", "frame_index", "height", "width", "data").mapInPandas(run, schema)
    w = Window.partitionBy("video_id").orderBy("frame_index")
    return d.withColumn("duplicate_score", F.bit_count(F.col("mean_hash").bitwiseXOR(F.lag("mean_hash").over(w))))


def frame_motion(frames: DataFrame, key: Sequence[str] = ("video_id",), order: str = "frame_index") -> DataFrame:
    """Mean absolute difference of each gray frame (key, order, height, width, data) to the one before it, over 255: key, order, motion_score.

    The frame before is found on slim rows; the pixels of the two meet by a join on (key, order), so that a long video's pixels are
    spread over all tasks. Null for a video's first frame, and where the sizes differ or data is missing. Frames of one key and order are one frame; those without a
    key or order are left out.
    """
    k = [*key, order]
    w = Window.partitionBy(*key).orderBy(order)
    before = frames.select(*k).distinct().select(*k, F.lag(order).over(w).alias("_before"))
    pixels = frames.select(*k, "height", "width", "data")
    last = pixels.select(*key, F.col(order).alias("_before"), F.col("height").alias("_h"), F.col("width").alias("_w"), F.col("data").alias("_data"))
    d = pixels.join(before.hint("merge"), k).join(last.hint("merge"), [*key, "_before"], "left")
    same = (F.col("height") == F.col("_h")) & (F.col("width") == F.col("_w")) & (F.length("data") == F.length("_data"))

    none = F.lit(None).cast("binary")
    apart = pixel_difference(F.when(same, F.col("data")).otherwise(none), F.when(same, F.col("_data")).otherwise(none))
    return d.select(*k, (apart["mean_abs"] / 255.0).alias("motion_score"))


@F.pandas_udf(T.StructType([T.StructField("mean_abs", T.DoubleType()), T.StructField("mse", T.DoubleType())]))
def pixel_difference(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Mean absolute and squared difference of two strings of bytes of one length; null where one is missing or they are empty or differ in length. Rows of one length are worked off together."""
    size = np.array([len(x) if x is not None and y is not None and len(x) == len(y) else 0 for x, y in zip(a, b, strict=True)], np.int64)
    out = np.zeros((2, len(a)))
    for n in np.unique(size[size > 0]).tolist():
        every = np.flatnonzero(size == n)
        for lo in range(0, len(every), max(1, (1 << 24) // n)):
            at = every[lo : lo + max(1, (1 << 24) // n)]
            left, right = (np.frombuffer(b"".join(c.iloc[at]), np.uint8).reshape(len(at), n).astype(np.int32) for c in (a, b))
            out[0, at], out[1, at] = np.abs(left - right).mean(1), ((left - right) ** 2).mean(1)
    return pd.DataFrame({name: pd.array(np.where(size > 0, x, np.nan), "Float64") for name, x in zip(("mean_abs", "mse"), out, strict=True)}).where(pd.Series(size > 0), None)


def compare_renders(renders: DataFrame, current, baseline, comparison=None, key: str = "run_id") -> DataFrame:
    """The renders (key, ordinal, sha256, height, width, data) of two or three runs at each ordinal that any of them has.

    ordinal, the runs' hashes, PSNR (255 scale, null for equal images) and mean absolute difference of the current run's image to the baseline's and to the
    comparison's, and violations: images that a run lacks or that differ in size. An image without data counts as lacking.
    """
    runs = {"current": current, "baseline": baseline, **({"comparison": comparison} if comparison is not None else {})}
    d = None
    for name, run in runs.items():
        side = renders.where((F.col(key) == run) & F.col("data").isNotNull()).select("ordinal", *[F.col(x).alias(f"{name}_{x}") for x in ("sha256", "height", "width", "data")])
        d = side if d is None else d.join(side.hint("merge"), "ordinal", "full_outer")
    others, checks = [n for n in runs if n != "current"], {f"{n}_missing": F.col(f"{n}_data").isNull() for n in runs}
    for n in others:
        same = (F.col(f"{n}_height") == F.col("current_height")) & (F.col(f"{n}_width") == F.col("current_width"))
        checks[f"{n}_size"] = F.coalesce(~same, F.lit(False))
        d = d.withColumn(f"_{n}", pixel_difference(F.when(same, F.col("current_data")), F.when(same, F.col(f"{n}_data"))))
    out = []
    for n in others:
        mse = F.col(f"_{n}.mse")
        out += [F.when(mse > 0, 10 * F.log10(255.0**2 / mse)).alias(f"{n}_psnr_db"), F.col(f"_{n}.mean_abs").alias(f"{n}_mean_abs_pixel_delta")]
    return d.select("ordinal", *[f"{n}_sha256" for n in runs], *out, violations(**checks).alias("violations"))
