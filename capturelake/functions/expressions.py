"""Column expressions: validation, frame scores, splat vertices, cameras and rotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def is_finite(c: Column) -> Column:
    """False for null, NaN and infinities."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) < INF), F.lit(False))


def finite_or_null(c: Column) -> Column:
    return F.when(is_finite(c.cast("double")), c.cast("double"))


def all_finite(values: Column) -> Column:
    """Every number of an array is finite; an empty array is, a null one isn't."""
    return F.coalesce(F.forall(values, is_finite), F.lit(False))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    # greatest and least skip nulls, which must stay null here.
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def violations(**checks: Column) -> Column:
    """Names of the checks that are true, in order."""
    return F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()]))


# Frames


def frame_quality_score(sharpness: Column, over: Column, under: Column, motion: Column, coverage: Column) -> Column:
    """Weighted mean of sharpness, exposure, motion and coverage; what is missing counts one half, no exposure problem none."""
    sharp = F.when(sharpness.isNull(), 0.5).otherwise(1.0 - F.exp(-F.greatest(sharpness, F.lit(0.0)) / 100.0))
    zero = F.lit(0.0)
    exposure = clamp(1.0 - F.greatest(clamp(F.coalesce(over, zero)), clamp(F.coalesce(under, zero))))
    half = lambda c: F.when(c.isNull(), 0.5).otherwise(clamp(c))
    return F.bround(0.45 * sharp + 0.25 * exposure + 0.15 * half(motion) + 0.15 * half(coverage), 9)


def hard_reject_reasons(upstream: Column, over: Column, under: Column, duplicate: Column, max_over: float = 0.35, max_under: float = 0.35, duplicate_threshold: int = 2) -> Column:
    """Upstream reasons, then exposure and duplicate reasons, each once. A missing measure never rejects."""
    own = F.array(F.when(over > max_over, F.lit("overexposed")), F.when(under > max_under, F.lit("underexposed")), F.when(duplicate <= duplicate_threshold, F.lit("duplicate")))
    return F.array_distinct(F.array_compact(F.concat(F.coalesce(upstream, F.array().cast("array<string>")), own)))


# Paths and names


def safe_relative_path(path: Column) -> Column:
    return F.coalesce((path != "") & ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..") & ~F.contains(path, F.lit("\\")), F.lit(False))


def safe_image_name(name: Column) -> Column:
    return F.coalesce(safe_relative_path(name) & ~F.contains(name, F.lit("/")) & F.lower(name).rlike(r"\.(jpg|jpeg|png)$"), F.lit(False))


def stage_frame_name(number: Column) -> Column:
    return F.format_string("frame_%06d.png", number)


def converted_view_name(number: Column, name: Column) -> Column:
    return F.concat(F.format_string("%04d_", number), F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"\.[^.]*$", ""), F.lit(".png"))


# Splat vertices

CORE = ("x", "y", "z", "f_dc_0", "f_dc_1", "f_dc_2", "opacity", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3")


def core_finite(names: Sequence[str] = CORE) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & is_finite(F.col(n))
    return out


def activated_opacity(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-clamp(logit, -50.0, 50.0)))


def effective(threshold: float = 0.1) -> Column:
    # NaN is above every number in Spark, so the core test has to come first.
    return core_finite() & (activated_opacity(F.col("opacity")) > threshold)


def anisotropy() -> Column:
    s = [F.col(f"scale_{i}") for i in range(3)]
    return F.exp(clamp(F.greatest(*s) - F.least(*s), 0.0, 80.0))


def quaternion_norm(q: Sequence[Column]) -> Column:
    return F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))


def unit_quaternion(q: Sequence[Column], tolerance: float = 0.01) -> Column:
    return F.coalesce(F.abs(quaternion_norm(q) - 1.0) <= tolerance, F.lit(False))


def normalized_quaternion(q: Sequence[Column], least: float = 1e-8) -> list[Column]:
    """Length 1; the identity for a quaternion that is too short."""
    n = quaternion_norm(q)
    return [F.when(n > least, c / n).otherwise(1.0 if i == 0 else 0.0) for i, c in enumerate(q)]


# Poses


def rotation_matrix(q: Sequence[Column]) -> list[Column]:
    """Nine entries, row by row, of a unit quaternion (w, x, y, z)."""
    w, x, y, z = q
    return [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]


def camera_center(q: Sequence[Column], t: Sequence[Column]) -> list[Column]:
    """``-R^T t``; NaN when the quaternion has no length."""
    n = quaternion_norm(q)
    r = rotation_matrix([c / F.when(n > 0, n) for c in q])
    return [F.coalesce(-(r[j] * t[0] + r[3 + j] * t[1] + r[6 + j] * t[2]), F.lit(float("nan"))) for j in range(3)]


def quaternion_step(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Angle in radians between two rotations given as quaternions of any length."""
    dot = sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0]) / (quaternion_norm(a) * quaternion_norm(b))
    return 2 * F.acos(clamp(F.abs(dot), 0.0, 1.0))


def matrix_step_degrees(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Angle in degrees of ``B A^T``."""
    trace = sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    return F.degrees(F.acos(clamp((trace - 1.0) / 2.0, -1.0, 1.0)))


def so3_errors(r: Sequence[Column]) -> tuple[Column, Column]:
    """Greatest entry of ``|R R^T - I|`` and ``|det R - 1|``."""
    row = lambda i: r[3 * i : 3 * i + 3]
    dot = lambda i, j: sum((x * y for x, y in zip(row(i)[1:], row(j)[1:], strict=True)), row(i)[0] * row(j)[0])
    ortho = F.greatest(*[F.abs(dot(i, j) - (1.0 if i == j else 0.0)) for i in range(3) for j in range(i, 3)])
    det = r[0] * (r[4] * r[8] - r[5] * r[7]) - r[1] * (r[3] * r[8] - r[5] * r[6]) + r[2] * (r[3] * r[7] - r[4] * r[6])
    return ortho, F.abs(det - 1.0)


# Cameras


def normalize_camera(model: Column, p: Sequence[Column]) -> dict[str, Column]:
    """fx, fy, cx, cy, distortion of PINHOLE, SIMPLE_PINHOLE and SIMPLE_RADIAL parameters; nulls and a violation otherwise."""
    pin, simple, radial = model == "PINHOLE", model == "SIMPLE_PINHOLE", model == "SIMPLE_RADIAL"
    one = simple | radial
    return {
        "fx": F.when(pin | one, p[0]),
        "fy": F.when(pin, p[1]).when(one, p[0]),
        "cx": F.when(pin, p[2]).when(one, p[1]),
        "cy": F.when(pin, p[3]).when(one, p[2]),
        "distortion": F.when(radial, F.array(p[3])).when(pin | simple, F.array().cast("array<double>")),
        "invalid_model": ~F.coalesce(pin | one, F.lit(False)),
    }


def transform_intrinsics(rotation: Column, k: dict[str, Column], width: Column, height: Column, scale_x: Column, scale_y: Column, dx: Column, dy: Column) -> dict[str, Column]:
    """Intrinsics after a turn by 0, 90, 180 or 270 degrees clockwise, a scale and an offset."""
    quarter = rotation.isin(90, 270)
    fx, fy = F.when(quarter, k["fy"]).otherwise(k["fx"]), F.when(quarter, k["fx"]).otherwise(k["fy"])
    cx = F.when(rotation == 90, height - k["cy"]).when(rotation == 180, width - k["cx"]).when(rotation == 270, k["cy"]).otherwise(k["cx"])
    cy = F.when(rotation == 90, k["cx"]).when(rotation == 180, height - k["cy"]).when(rotation == 270, width - k["cx"]).otherwise(k["cy"])
    w, h = F.when(quarter, height).otherwise(width), F.when(quarter, width).otherwise(height)
    return {"fx": fx * scale_x, "fy": fy * scale_y, "cx": cx * scale_x + dx, "cy": cy * scale_y + dy, "width": F.bround(w * scale_x).cast("long"), "height": F.bround(h * scale_y).cast("long")}


def centered_pinhole_violations(model: Column, k: dict[str, Column], width: Column, height: Column, tolerance: float = 0.5) -> Column:
    off = lambda c, size: ~F.coalesce(F.abs(c - size / 2.0) <= tolerance, F.lit(False))
    return violations(model=~F.coalesce(model.isin("PINHOLE", "SIMPLE_PINHOLE"), F.lit(False)), focal=~F.coalesce((k["fx"] > 0) & (k["fy"] > 0), F.lit(False)), size=~F.coalesce((width > 0) & (height > 0), F.lit(False)), center_x=off(k["cx"], width), center_y=off(k["cy"], height))


def centered_crop(length: Column, center: Column, least_share: float = 0.75, tolerance: float = 0.5) -> Column:
    """The longest crop (length, origin) of an axis that keeps its principal point in the middle; null if there is none.

    A crop that fits is at most twice as long as the middle's way to the nearer end and the tolerance. Below that only the fraction of half the length decides, so
    of any two neighbouring lengths one fits if any does; two more on either side allow for rounding.
    """
    size, least = length.cast("int"), F.ceil(length * least_share).cast("int")
    most = F.greatest(F.least(size.cast("double"), 2 * (center + tolerance), 2 * (length - center + tolerance)), F.lit(-1.0))
    most = F.when(is_finite(center), F.floor(most).cast("int"))

    def origin(n: Column) -> Column:
        return F.greatest(F.ceil(F.least(center - n / 2.0 - tolerance, size + 1.0)), F.lit(0)).cast("int")

    tries = F.transform(F.sequence(most + 2, most - 3, F.lit(-1)), lambda n: F.struct(n.alias("length"), origin(n).alias("origin")))
    fits = F.filter(tries, lambda t: (t["length"] <= size) & (t["length"] >= least) & (F.abs(center - t["origin"] - t["length"] / 2.0) <= tolerance) & (t["origin"] + t["length"] <= length))
    return F.get(fits, 0)


def cropped_camera(k: dict[str, Column], width: Column, height: Column, x0: Column, y0: Column, w: Column, h: Column) -> dict[str, Column]:
    """Intrinsics and size of a camera after a crop, nulls where the crop doesn't lie within the image; and its violations."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    bad = violations(origin=no((x0 >= 0) & (y0 >= 0)), size=no((w > 0) & (h > 0)), outside=no((x0 + w <= width) & (y0 + h <= height)), focal=no(is_finite(k["fx"]) & is_finite(k["fy"]) & (k["fx"] > 0) & (k["fy"] > 0)))
    good = F.size(bad) == 0
    moved = {"fx": k["fx"], "fy": k["fy"], "cx": k["cx"] - x0, "cy": k["cy"] - y0, "width": w, "height": h}
    return {n: F.when(good, c) for n, c in moved.items()} | {"violations": bad}


# Probes


def rational(text: Column) -> Column:
    """``a/b``, ``a:b`` or a plain number as double; null for no value, a zero divisor, or what isn't positive."""
    parts = F.split(F.trim(text), "[/:]")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    value = F.when(F.size(parts) == 2, F.try_divide(number(0), number(1))).when(F.size(parts) == 1, number(0))
    return F.when(is_finite(value) & (value > 0), value)


def is_variable_rate(average: Column, nominal: Column) -> Column:
    return F.abs(average - nominal) > F.greatest(F.lit(0.1), 0.01 * nominal)


def frame_budget(duration: Column, rate: float, least: int, most: int) -> Column:
    return F.greatest(F.lit(least), F.least(F.lit(most), F.ceil(duration * rate))).cast("long")


def candidate_plan(duration: Column, variable: Column, rate: Column, least: Column, most: Column) -> dict[str, Column]:
    """Candidates to take from a video of constant rate before any frame is read: candidate_budget, candidate_fps and violations.

    The budget is the one of ``frame_budget``, the rate spreads it over the whole duration. Videos of variable rate and limits that
    cannot hold (duration, rate or least not positive, most below least, null or not finite) have violations and no plan.
    """
    bad = violations(
        variable_frame_rate=F.coalesce(variable, F.lit(False)), duration=~F.coalesce(is_finite(duration) & (duration > 0), F.lit(False)), target_fps=~F.coalesce(is_finite(rate) & (rate > 0), F.lit(False)), frame_limits=~F.coalesce((least > 0) & (most >= least), F.lit(False)),
    )
    good = F.size(bad) == 0
    budget = F.greatest(least.cast("double"), F.least(most.cast("double"), F.ceil(duration * rate).cast("double")))
    return {"candidate_budget": F.when(good, budget.cast("long")), "candidate_fps": F.when(good, budget / duration), "violations": bad}
