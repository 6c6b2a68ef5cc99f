"""Gates: metrics against thresholds give checks, reasons and a verdict."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import violations

# Thresholds of the rule sets (metric, comparison, limit).
PLY_GATE = {"effective_fraction": (">=", 0.35), "anisotropy_q99": ("<=", 50.0), "quaternion_within_1pct_fraction": (">=", 0.9999)}
EARLY_VISUAL = {"mean_psnr": (">=", 15.0), "min_psnr": (">=", 10.0), "mean_ssim": (">=", 0.60), "min_ssim": (">=", 0.45)}
FORMAL_VISUAL = {"mean_psnr": (">=", 20.0), "min_psnr": (">=", 15.0), "mean_ssim": (">=", 0.75), "min_ssim": (">=", 0.60)}
MODES = ("off", "observe", "enforce")
#: Settings of the gates with their defaults; ``mode`` is "off" where it isn't given.
DEFAULTS = {
    "pose": {
        "min_match_count": 128, "min_inlier_count": 64, "min_inlier_ratio": 0.80, "max_reprojection_rmse_px": 2.0, "min_grid_coverage": 0.375, "min_positive_depth_ratio": 0.95, "max_rotation_step_deg": 25.0, "max_translation_step_ratio": 6.0, "reference_lookback": 3,
        "max_orthogonality_error": 1e-4, "max_determinant_error": 1e-4,
    },
    "vda": {"min_correlation": 0.90, "min_inlier_ratio": 0.95, "max_normalized_rmse": 0.10, "min_aligned_fraction": 0.98},
    "ply": {"min_effective_fraction": 0.35, "max_anisotropy_q99": 50.0, "min_unit_quaternion_fraction": 0.9999},
}
#: Settings that are shares, from 0 to 1; all others are 0 or more.
SHARES = ("min_inlier_ratio", "min_grid_coverage", "min_positive_depth_ratio", "min_correlation", "min_aligned_fraction", "min_effective_fraction", "min_unit_quaternion_fraction")


def validate_thresholds(thresholds: Mapping[str, tuple[str, float]], known: set[str]) -> None:
    """Refuse unknown names, comparisons and limits that aren't numbers."""
    for name, (how, limit) in thresholds.items():
        if name not in known or how not in (">=", "<=") or isinstance(limit, bool) or not isinstance(limit, (int, float)) or limit != limit:
            raise ValueError(f"threshold {name}: {how} {limit}")


def evaluate_gate(metrics: DataFrame, thresholds: Mapping[str, tuple[str, float]], mode: str = "enforce") -> DataFrame:
    """checks (a map), reasons and passed of each row. A missing metric fails; ``observe`` records reasons but passes, ``off`` does neither."""
    if mode not in MODES:
        raise ValueError(mode)
    validate_thresholds(thresholds, set(metrics.columns))
    check = {n: F.coalesce(F.when(F.isnan(F.col(n).cast("double")), False).otherwise(F.col(n) >= limit if how == ">=" else F.col(n) <= limit), F.lit(False)) for n, (how, limit) in thresholds.items()}
    d = metrics.withColumn("checks", F.create_map(*[x for n, c in check.items() for x in (F.lit(n), c)]))
    reasons = violations(**{n: ~c for n, c in check.items()}) if mode != "off" else F.array().cast("array<string>")
    d = d.withColumn("reasons", reasons)
    return d.withColumn("passed", F.size("reasons") == 0 if mode == "enforce" else F.lit(True))


def gate_settings(configs: DataFrame, key: str, text: str = "quality_gates") -> DataFrame:
    """(key, gate, name, value, mode, given, violation): all settings of each configuration (JSON), given or by default.

    A gate that is absent or no object has its defaults. A setting that is no number (true and text included) or out of its range keeps
    its violation ``value`` and has no value; a mode of another name, ``mode``. Unknown gates and settings are rows of their own with ``unknown``. What
    is no JSON object has one row with ``not_an_object``; null text is an empty configuration. Rows are made of each configuration alone, without a join; as
    one becomes about twenty, configurations are dealt to all tasks before, whatever files they come in.
    """
    c = F.col
    document = F.try_parse_json(F.coalesce(c(text), F.lit("{}")))
    whole = F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False))
    fields = lambda v: F.coalesce(F.from_json(F.when(F.schema_of_variant(v).startswith("OBJECT"), F.to_json(v)), "map<string, variant>"), F.from_json(F.lit("{}"), "map<string, variant>"))
    parts = int(configs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = configs.select(key, text).repartition(parts).select(key, whole.alias("_whole"), fields(document).alias("_gates"))
    known = [F.struct(F.lit(g).alias("gate"), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(v)).alias("preset"), F.lit(1.0 if n in SHARES else float("inf")).alias("most")) for n, v in settings.items()]).alias("settings")) for g, settings in DEFAULTS.items()]
    others = F.transform(F.filter(F.map_keys("_gates"), lambda g: ~g.isin(*DEFAULTS)), lambda g: F.struct(g.alias("gate"), F.array().cast("array<struct<name: string, preset: double, most: double>>").alias("settings")))
    d = d.select(key, "_whole", "_gates", F.explode(F.when(c("_whole"), F.concat(F.array(*known), others)).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("gate"), F.array().cast("array<struct<name: string, preset: double, most: double>>").alias("settings"))))).alias("_g"))
    # Each given setting is read once, to its number and text; what follows compares plain values only.
    number = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
    plain = lambda _, v: F.struct(F.when(F.schema_of_variant(v).rlike(number), F.try_variant_get(v, "$", "double")).alias("value"), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).alias("text"))
    d = d.select(key, "_whole", c("_g.gate").alias("gate"), c("_g.settings").alias("_known"), F.transform_values(fields(F.element_at("_gates", c("_g.gate"))), plain).alias("_given"))
    row = lambda name, value, mode, given, violation: F.struct(name.cast("string").alias("name"), value.cast("double").alias("value"), mode.cast("string").alias("mode"), given.alias("given"), violation.cast("string").alias("violation"))
    none = F.lit(None)

    def setting(x):
        own = F.element_at("_given", x["name"])
        value = own["value"]
        given = F.array_contains(F.map_keys("_given"), x["name"])
        good = F.coalesce((value >= 0) & (value <= x["most"]) & (value < float("inf")), F.lit(False))
        return row(x["name"], F.when(~given, x["preset"]).when(good, value), none, given, F.when(given & ~good, "value"))

    own = F.element_at("_given", F.lit("mode"))
    mode, given = own["text"], F.array_contains(F.map_keys("_given"), "mode")
    fine = F.coalesce(mode.isin(*MODES), F.lit(False))
    known_gate = c("gate").isin(*DEFAULTS)
    mode_row = row(F.lit("mode"), none, F.when(~given, "off").when(fine, mode), given, F.when(given & ~fine, "mode"))
    strange = F.transform(F.filter(F.map_keys("_given"), lambda n: (n != "mode") & ~F.array_contains(F.transform("_known", lambda x: x["name"]), n)), lambda n: row(n, none, none, F.lit(True), F.lit("unknown")))
    rows = F.when(~c("_whole"), F.array(row(none, none, none, F.lit(True), F.lit("not_an_object")))).when(known_gate, F.concat(F.array(mode_row), F.transform("_known", setting), strange)).otherwise(F.array(row(none, none, none, F.lit(True), F.lit("unknown"))))
    return d.select(key, "gate", F.explode(rows).alias("r")).select(key, "gate", "r.*")


def configured_gate(metrics: DataFrame, settings: DataFrame, key: str, gate: str) -> DataFrame:
    """``metrics`` with mode, reasons and passed by each row's own configuration: its ``gate_settings`` under the same key.

    A setting ``min_x`` or ``max_x`` judges the column ``x``; a metric that is missing, null or NaN fails. A configuration with a
    violation in this gate, or none at all, is the reason ``settings`` and fails in any mode. Otherwise ``observe`` has reasons but passes, ``off`` has none.
    """
    c = F.col
    own = settings.where((c("gate") == gate) | c("gate").isNull()).groupBy(key).agg(F.max("mode").alias("mode"), F.map_from_entries(F.collect_list(F.when(c("value").isNotNull(), F.struct("name", "value")))).alias("_limits"), F.count("violation").alias("_faults"))
    d = metrics.join(own.hint("merge"), key, "left")
    sound = F.coalesce(c("_faults") == 0, F.lit(False))
    checks = {}
    for name in DEFAULTS[gate]:
        how, _, metric = name.partition("_")
        if how in ("min", "max"):
            value = F.nanvl(c(metric).cast("double"), F.lit(None).cast("double")) if metric in metrics.columns else F.lit(None).cast("double")
            limit = F.element_at("_limits", F.lit(name))
            checks[name] = sound & (c("mode") != "off") & ~F.coalesce(value >= limit if how == "min" else value <= limit, F.lit(False))
    d = d.withColumn("reasons", violations(settings=~sound, **checks))
    return d.withColumn("passed", sound & ((F.size("reasons") == 0) | (c("mode") != "enforce"))).drop("_limits", "_faults")


def depth_gate(runs: DataFrame, least_aligned: float = 0.98) -> DataFrame:
    """Runs (run_id, aligned, missing, rejected, camera_count) against missing depth, record counts and the aligned share."""
    c = F.col
    total = c("aligned") + c("missing") + c("rejected")
    reasons = violations(missing_depth=c("missing") > 0, record_count=total != c("camera_count"), aligned_ratio=~F.coalesce(c("aligned") / c("camera_count").cast("double") >= least_aligned, F.lit(False)))
    return runs.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)


def loss_gate(summary: DataFrame) -> DataFrame:
    reasons = violations(nonfinite_loss=F.coalesce("has_nonfinite", F.lit(False)))
    return summary.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)


def release_gate(runs: DataFrame, visual: Mapping[str, tuple[str, float]] = EARLY_VISUAL) -> DataFrame:
    """Structural blocks decide; visual thresholds only warn. runs: structural_pass, exposure_ok and the visual metrics."""
    blocks = violations(structural=~F.coalesce("structural_pass", F.lit(False)), exposure=~F.coalesce("exposure_ok", F.lit(False)))
    warn = violations(**{n: ~F.coalesce(F.col(n) >= limit, F.lit(False)) for n, (_, limit) in visual.items()})
    return runs.withColumn("reasons", blocks).withColumn("warnings", warn).withColumn("computed_pass", F.size("reasons") == 0)


def technical_gate(runs: DataFrame, exposures: DataFrame, visual: Mapping[str, tuple[str, float]] = EARLY_VISUAL) -> DataFrame:
    """The early (or, with FORMAL_VISUAL, the formal) technical gate of each run: reasons block, warnings do not.

    ``runs``: run_id, active_camera_count, iterations, structural_pass, anchor_observed, checkpoint_finite, cross_gap and the
    visual metrics; ``exposures``: run_id, camera, exposures. Every active camera must have the floor or the ceiling of
    iterations by cameras, in the numbers that follow from it. Metrics that are missing block, low ones warn.
    """
    n, low, extra = F.col("active_camera_count"), F.expr("iterations div active_camera_count"), F.col("iterations") % F.col("active_camera_count")
    seen = exposures.join(runs.select("run_id", low.alias("low")), "run_id").groupBy("run_id").agg(F.count("*").alias("_cameras"), F.sum("exposures").alias("_sum"), F.count_if(F.col("exposures") == F.col("low")).alias("_at_low"), F.count_if(F.col("exposures") == F.col("low") + 1).alias("_at_high"), F.count_if(F.col("exposures") == 0).alias("_zero"))
    d = runs.join(seen, "run_id", "left")
    ok = lambda c: F.coalesce(c, F.lit(False))
    spread = (F.col("_at_low") == n - extra) & (F.col("_at_high") == extra)
    known = [F.col(m).isNotNull() & ~F.isnan(F.col(m).cast("double")) for m in visual]
    reasons = violations(exposure_identity=~ok(F.col("_cameras") == n), exposure_distribution=~ok(spread), exposure_sum=~ok(F.col("_sum") == F.col("iterations")), anchor_schedule=~ok(F.col("anchor_observed")), checkpoint=~ok(F.col("checkpoint_finite")), structural=~ok(F.col("structural_pass")), metrics_missing=~ok(F.array_min(F.array(*known))))
    low_metrics = {m: ~F.coalesce(F.col(m) >= limit, F.lit(False)) for m, (_, limit) in visual.items()}
    warnings = violations(**low_metrics, cross_gap=ok(F.col("cross_gap")), zero_exposure=ok(F.col("_zero") > 0))
    d = d.withColumn("reasons", reasons).withColumn("warnings", warnings).withColumn("computed_pass", F.size("reasons") == 0)
    return d.drop("_cameras", "_sum", "_at_low", "_at_high", "_zero")


def coverage_plan(runs: DataFrame, rounds: int = 2) -> DataFrame:
    """Least and greatest iterations for full rounds over all cameras, and reasons against the request."""
    least, most = rounds * F.col("camera_count"), rounds * F.col("max_frames")
    asked = F.coalesce("requested_iterations", least)
    reasons = violations(active_camera_count_exceeds_frame_selector_max_frames=F.col("camera_count") > F.col("max_frames"), requested_iterations_below_two_complete_camera_rounds=asked < least, requested_iterations_exceeds_selector_derived_upper_bound=asked > most)
    return runs.withColumn("minimum_iterations", least).withColumn("upper_bound", most).withColumn("iterations", asked).withColumn("reasons", reasons).withColumn("computed_pass", F.size("reasons") == 0)


def release_decision(runs: DataFrame) -> DataFrame:
    """All three of a structural pass, a visual pass and an explicit review."""
    reasons = violations(smoke100_structural_pass_required=~F.coalesce("structural_pass", F.lit(False)), explicit_coverage_smoke_visual_pass_required=~F.coalesce(F.col("visual_decision") == "pass", F.lit(False)), explicit_visual_review_token_required=~F.coalesce("visual_review", F.lit(False)))
    return runs.withColumn("reasons", reasons).withColumn("formal_release_eligible", F.size("reasons") == 0)


def camera_identity(cameras: DataFrame, key: str = "run_id") -> DataFrame:
    """Whether a run's camera names are unique and all of one size."""
    d = cameras.groupBy(key).agg(F.count("*").alias("cameras"), F.count_distinct("name").alias("names"), F.count_distinct("width", "height").alias("sizes"))
    return d.withColumn("reasons", violations(duplicate_names=F.col("names") != F.col("cameras"), mixed_sizes=F.col("sizes") != 1)).withColumn("passed", F.size("reasons") == 0)


def normalize_gate(records: DataFrame, text: str = "gate") -> DataFrame:
    """Gate records (JSON) of version 2, or version 1 in a wrapper that is unpacked; violations where they contradict themselves."""
    v = F.try_parse_json(text)
    inner = F.coalesce(F.try_variant_get(v, "$.decision", "variant"), v)
    wrapped = F.schema_of_variant(F.try_variant_get(v, "$.decision", "variant")).startswith("OBJECT")
    d = records.withColumn("_v", v).withColumn("version", F.when(F.coalesce(wrapped, F.lit(False)), 1).otherwise(2)).withColumn("_g", F.when(F.col("version") == 1, inner).otherwise(v))
    flags = ("computed_pass", "formal_release_eligible", "formal_auto_release", "held_out", "training_views_only")
    boolean = {f"not_boolean_{n}": ~F.coalesce(F.schema_of_variant(F.try_variant_get("_g", f"$.{n}", "variant")) == "BOOLEAN", F.lit(False)) for n in flags}
    get = {n: F.try_variant_get("_g", f"$.{n}", "boolean") for n in flags}
    bad = violations(not_an_object=~F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)), **boolean, auto_release_claimed=F.coalesce(get["formal_auto_release"], F.lit(False)), eligible_without_pass=F.coalesce(get["formal_release_eligible"] & ~get["computed_pass"], F.lit(False)))
    return d.withColumns(get).withColumn("violations", bad).drop("_v", "_g")
