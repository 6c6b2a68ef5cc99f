"""Camera trajectories: steps, SO(3) errors, quality and pose gates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X

Q, T_ = ("qw", "qx", "qy", "qz"), ("tx", "ty", "tz")


def quaternion_trajectory(poses: DataFrame, key: Sequence[str] = ("scene_id",), order: str = "ord") -> DataFrame:
    """Camera centre, distance and angle (radians) to the pose before, of poses given as quaternions."""
    q, t = [F.col(c) for c in Q], [F.col(c) for c in T_]
    d = poses.withColumns(dict(zip(("cx", "cy", "cz"), X.camera_center(q, t), strict=True)))
    w = Window.partitionBy(*key).orderBy(order)
    before = lambda c: F.lag(c).over(w)
    step = F.sqrt(sum(((F.col(c) - before(c)) ** 2 for c in ("cy", "cz")), (F.col("cx") - before("cx")) ** 2))
    return d.withColumn("center_step", step).withColumn("rotation_step_rad", X.quaternion_step([before(c) for c in Q], q))


def matrix_steps(cameras: DataFrame, key: Sequence[str] = ("scene_id",), order: str = "ord") -> DataFrame:
    """Angle (degrees) and distance to the camera before, of cameras with ``R`` (9 numbers) and ``T`` (3).

    A camera whose R isn't finite has no step, and neither has the one after it.
    """
    w = Window.partitionBy(*key).orderBy(order)
    d = cameras.withColumn("r_finite", X.all_finite(F.col("R"))).withColumn("t_finite", X.all_finite(F.col("T")))
    d = d.withColumns({"_r": F.lag("R").over(w), "_t": F.lag("T").over(w), "_ok": F.col("r_finite") & F.lag("r_finite").over(w)})
    r = lambda c: [F.col(c)[i] for i in range(9)]
    move = F.sqrt(sum(((F.col("T")[i] - F.col("_t")[i]) ** 2 for i in (1, 2)), (F.col("T")[0] - F.col("_t")[0]) ** 2))
    return d.withColumn("rotation_step_deg", F.when(F.col("_ok"), X.matrix_step_degrees(r("_r"), r("R")))).withColumn("translation_step", F.when(F.col("_ok"), move)).drop("_r", "_t", "_ok")


def trajectory_quality(cameras: DataFrame, key: Sequence[str] = ("scene_id",), order: str = "ord") -> DataFrame:
    """Count, greatest SO(3) errors and steps, and finiteness of each trajectory."""
    d = matrix_steps(cameras, key, order)
    ortho, det = X.so3_errors([F.col("R")[i] for i in range(9)])
    zero = lambda c: F.coalesce(F.max(c), F.lit(0.0))
    return d.groupBy(*key).agg(F.count("*").alias("camera_count"), zero(F.when(F.col("r_finite"), ortho)).alias("max_orthogonality_error"), zero(F.when(F.col("r_finite"), det)).alias("max_determinant_error"), zero("rotation_step_deg").alias("max_rotation_step_deg"), zero("translation_step").alias("max_translation_step"), F.bool_and("r_finite").alias("all_rotations_finite"), F.bool_and("t_finite").alias("all_positions_finite"), F.median("translation_step").alias("median_translation_step"))


def translation_step_ratios(steps: DataFrame, key: Sequence[str] = ("scene_id",), order: str = "ord", step: str = "center_step", least: int = 3) -> DataFrame:
    """Step over the median of up to seven steps before it, where at least ``least`` are known."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-7, -1)
    known = F.array_sort(F.collect_list(step).over(w))
    n = F.size("_known")
    middle = (F.get("_known", F.floor((n - 1) / 2).cast("int")) + F.get("_known", F.floor(n / 2).cast("int"))) / 2.0
    return steps.withColumn("_known", known).withColumn("translation_step_ratio", F.when((n >= least) & (middle > 1e-12), F.col(step) / middle)).drop("_known")


def accepted_step_ratios(poses: DataFrame, key: Sequence[str] = ("scene_id",), order: str = "ord", accepted: str = "accepted", position: Sequence[str] = ("cx", "cy", "cz"), step: str | None = None, least: int = 4, recent: int = 7) -> DataFrame:
    """Step of each pose over the median of the last ``recent`` steps between accepted poses before it; null below ``least`` accepted ones.

    Rejected poses have a ratio, but no part in the history. ``step`` names a column with the pose's own step; by default it is the
    distance to the last accepted pose. A null or false ``accepted`` is a rejection. An accepted pose without a finite position
    has no steps, and neither has the next accepted one. Adds accepted_before and translation_step_ratio.
    """
    at = [F.col(c) for c in position]
    apart = lambda a, b: F.sqrt(sum(((x - y) * (x - y) for x, y in list(zip(a, b, strict=True))[1:]), (a[0] - b[0]) * (a[0] - b[0])))
    # Accepted poses of a trajectory are a partition of their own, so lags and frames pass over the others.
    own = Window.partitionBy(*key, "_ok").orderBy(order)
    d = poses.withColumn("_ok", F.coalesce(F.col(accepted), F.lit(False)))
    d = d.withColumn("_step", apart(at, [F.lag(c).over(own) for c in at])).withColumn("_step", F.when(X.is_finite(F.col("_step")), F.col("_step")))
    state = F.struct(F.row_number().over(own).alias("n"), F.collect_list("_step").over(own.rowsBetween(1 - recent, 0)).alias("steps"), *[c.alias(f"p{i}") for i, c in enumerate(at)])
    d = d.withColumn("_state", F.when(F.col("_ok"), state))
    before = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_last", F.last("_state", ignorenulls=True).over(before)).withColumn("_known", F.array_sort("_last.steps"))
    n = F.size("_known")
    middle = (F.get("_known", F.floor((n - 1) / 2).cast("int")) + F.get("_known", F.floor(n / 2).cast("int"))) / 2.0
    current = F.col(step) if step else apart(at, [F.col(f"_last.p{i}") for i in range(len(at))])
    ratio = F.when((F.col("_last.n") >= least) & (n > 0) & (middle > 1e-12), current / middle)
    return d.withColumn("accepted_before", F.coalesce("_last.n", F.lit(0))).withColumn("translation_step_ratio", ratio).drop("_ok", "_step", "_state", "_last", "_known")


def pose_audit(quality: DataFrame, accepted: DataFrame, key: Sequence[str] = ("scene_id",), orthogonality: float = 1e-4, determinant: float = 1e-4, rotation_deg: float = 25.0, step_ratio: float = 6.0) -> DataFrame:
    """Reasons against each trajectory and whether it passes. accepted: key, accepted_camera_count."""
    d = quality.join(accepted, list(key), "left")
    c = F.col
    ratio = F.when(c("median_translation_step") > 1e-12, c("max_translation_step") / c("median_translation_step"))
    reasons = X.violations(nonfinite_rotation=~c("all_rotations_finite"), nonfinite_position=~c("all_positions_finite"), orthogonality_error=c("max_orthogonality_error") > orthogonality, determinant_error=c("max_determinant_error") > determinant, rotation_step=c("max_rotation_step_deg") > rotation_deg, translation_step_ratio=ratio > step_ratio, accepted_camera_count=F.coalesce(c("accepted_camera_count"), F.lit(0)) != c("camera_count"))
    return d.withColumn("step_ratio", ratio).withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)


def native_checkpoints(inventory: DataFrame, key: Sequence[str] = ("scene_id",)) -> DataFrame:
    """(key, checkpoint_iteration) of each model folder's files (key, path): of its native checkpoints, else of its point clouds, the last."""
    number = lambda pattern: F.regexp_extract("path", pattern, 1).try_cast("long")
    # Names of checkpoint files and of point cloud folders.
    native, cloud = number(r"(?:^|/)chkpnt(\d+)\.pth$"), number(r"(?:^|/)point_cloud/iteration_(\d+)(?:/|$)")
    return inventory.groupBy(*key).agg(F.coalesce(F.max(native), F.max(cloud)).alias("checkpoint_iteration"))


def checkpoint_audit(audited: DataFrame, inventory: DataFrame, expected: DataFrame, key: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``pose_audit`` rows with the reasons ``checkpoint_missing`` and ``checkpoint_iteration`` added, where an iteration is expected.

    expected: key, expected_iteration, one row a key; a key without one, or with null, keeps its result.
    """
    found = native_checkpoints(inventory, key).hint("merge")
    d = audited.join(found, list(key), "left").join(expected.select(*key, "expected_iteration").hint("merge"), list(key), "left")
    c = F.col
    more = X.violations(checkpoint_missing=c("expected_iteration").isNotNull() & c("checkpoint_iteration").isNull(), checkpoint_iteration=F.coalesce(c("checkpoint_iteration") != c("expected_iteration"), F.lit(False)))
    return d.withColumn("reasons", F.concat("reasons", more)).withColumn("passed", F.size("reasons") == 0)


def pose_attempt_reasons(attempts: DataFrame, least_matches: int = 100, least_inliers: int = 50, least_inlier_ratio: float = 0.5, most_rmse: float = 4.0, least_coverage: float = 0.25, least_positive: float = 0.9, most_rotation_deg: float = 25.0, most_step_ratio: float = 6.0) -> DataFrame:
    """Reasons against each pose attempt, in fixed order; what is missing or not finite counts against it where it is needed."""
    c = F.col
    below = lambda n, v: ~F.coalesce(c(n) >= v, F.lit(False)) | ~X.is_finite(c(n).cast("double"))
    reasons = X.violations(match_count=below("match_count", least_matches), inlier_count=below("inlier_count", least_inliers), inlier_ratio=below("inlier_ratio", least_inlier_ratio), reprojection_rmse=~F.coalesce(c("reprojection_rmse_px") <= most_rmse, F.lit(False)), grid_coverage=below("grid_coverage", least_coverage), positive_depth=below("positive_depth_ratio", least_positive), rotation_step=F.coalesce(c("rotation_step_deg") > most_rotation_deg, F.lit(False)), translation_step=F.coalesce(c("translation_step_ratio") > most_step_ratio, F.lit(False)))
    return attempts.withColumn("rejection_reasons", reasons).withColumn("accepted", F.size("rejection_reasons") == 0)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def project_to_so3(r: pd.Series) -> pd.Series:
    """The nearest rotation to each 3x3 matrix (9 numbers, row by row); null for null, non-finite or other arrays."""
    rows = [None if x is None else np.asarray(x, float) for x in r]
    good = [i for i, x in enumerate(rows) if x is not None and len(x) == 9 and np.isfinite(x).all()]
    out = [None] * len(rows)
    if good:
        u, _, vh = np.linalg.svd(np.stack([rows[i] for i in good]).reshape(-1, 3, 3))
        flip = np.ones((len(good), 3))
        flip[:, 2] = np.sign(np.linalg.det(u @ vh))
        for i, x in zip(good, ((u * flip[:, None, :]) @ vh).reshape(-1, 9), strict=True):
            out[i] = x
    return pd.Series(out, dtype=object)
