"""Probes of source videos, camera priors, and flat reports and audits of training runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.staging import scene_join
from .frames import key_set_status
from .runs import artifact_hash_check, content_digest, latest_attempt
from .telemetry import anchor_event_check

STREAM = "codec_type: string, codec_name: string, width: int, height: int, duration: string, avg_frame_rate: string, r_frame_rate: string, nb_frames: string, sample_aspect_ratio: string, display_aspect_ratio: string, tags: map<string, string>, side_data_list: array<struct<rotation: double>>"
PROBE = f"streams array<struct<{STREAM}>>, format struct<duration: string, display_aspect_ratio: string>"


def normalize_probe(probes: DataFrame, payload: str = "payload") -> DataFrame:
    """Size, rates, frame count, aspect, rotation and square-pixel size of each probed video's first video stream, with violations.

    Rotation is clockwise, from the display matrix if there is one, else from the tag; only quarter turns are valid. The frame
    count is the stream's or the rounded product of duration and rate.
    """
    d = probes.withColumn("_p", F.from_json(payload, PROBE)).withColumn("_s", F.get(F.filter("_p.streams", lambda s: s["codec_type"] == "video"), F.lit(0)))
    s = lambda n: F.col(f"_s.{n}")
    width, height = s("width"), s("height")
    average, nominal = X.rational(s("avg_frame_rate")), X.rational(s("r_frame_rate"))
    rate, duration = F.coalesce(average, nominal), X.rational(F.coalesce(s("duration"), F.col("_p.format.duration")))
    counted = s("nb_frames").try_cast("long")
    sar = F.coalesce(X.rational(s("sample_aspect_ratio")), F.lit(1.0))
    matrix = F.get("_s.side_data_list", F.lit(0))["rotation"]
    turn = F.pmod(F.coalesce(-matrix, s("tags")["rotate"].try_cast("double"), F.lit(0.0)), F.lit(360.0))
    quarter, square = turn.isin(90.0, 270.0), F.greatest(F.lit(1), F.bround(width * sar).cast("int"))
    d = d.withColumns({
        "width": width, "height": height, "duration_sec": duration, "average_fps": average, "nominal_fps": nominal, "fps": rate, "rotation": F.when(turn.isin(0.0, 90.0, 180.0, 270.0), turn.cast("int")),
        "frame_count": F.when(counted > 0, counted).otherwise(F.greatest(F.lit(1), F.bround(duration * rate).cast("long"))), "sample_aspect": sar, "display_aspect": F.coalesce(X.rational(F.coalesce(s("display_aspect_ratio"), F.col("_p.format.display_aspect_ratio"))), width * sar / height),
        "vfr": F.coalesce(X.is_variable_rate(average, nominal), F.lit(False)), "canonical_width": F.when(quarter, height).otherwise(square), "canonical_height": F.when(quarter, square).otherwise(height),
    })
    v = X.violations(no_video_stream=F.col("_s").isNull(), size=F.col("_s").isNotNull() & ~F.coalesce((width > 0) & (height > 0), F.lit(False)), timing=F.col("_s").isNotNull() & (duration.isNull() | rate.isNull()), rotation=F.col("_s").isNotNull() & F.col("rotation").isNull())
    return d.withColumn("violations", v).drop("_p", "_s")


def camera_prior_check(priors: DataFrame, media: DataFrame) -> DataFrame:
    """Violations of each prior (source_sha256, model, params, width, height) against its canonical media (sha256, width, height)."""
    m = media.select(F.col("sha256").alias("source_sha256"), F.col("width").alias("_w"), F.col("height").alias("_h"))
    d = priors.join(m, "source_sha256", "left")
    v = X.violations(source=F.col("_w").isNull(), dimensions=F.coalesce((F.col("width") != F.col("_w")) | (F.col("height") != F.col("_h")), F.lit(False)), params=~X.all_finite(F.col("params")) | (F.size("params") < 3))
    return d.withColumn("violations", v).drop("_w", "_h")


def training_run_report(runs: DataFrame, cameras: DataFrame, losses: DataFrame) -> DataFrame:
    """One row per run: its own columns, camera count, names in order, single size and pixels, and loss summary."""
    c = cameras.groupBy("run_id").agg(F.count("*").alias("camera_count"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("camera_names"), F.max("width").alias("width"), F.max("height").alias("height"), F.count_distinct("width", "height").alias("_sizes"))
    c = c.withColumn("pixel_count", F.col("camera_count") * F.col("width") * F.col("height")).withColumn("single_size", F.col("_sizes") == 1).drop("_sizes")
    return runs.join(c, "run_id", "left").join(losses, "run_id", "left")


def training_evidence_audit(runs: DataFrame, residuals: Sequence[str], tolerance: float = 1e-5) -> DataFrame:
    """Runs whose pose residuals are within tolerance, whose exposures keep floor and ceiling, and whose telemetry digests agree.

    runs: residual columns, camera_count, iterations, min_exposure, max_exposure, digest, declared_digest.
    """
    low = F.expr("iterations div camera_count")
    high = low + F.when(F.col("iterations") % F.col("camera_count") > 0, 1).otherwise(0)
    off: dict[str, Column] = {f"residual_{n}": ~F.coalesce(X.is_finite(F.col(n)) & (F.col(n) <= tolerance), F.lit(False)) for n in residuals}
    v = X.violations(**off, exposure=~F.coalesce((F.col("min_exposure") == low) & (F.col("max_exposure") == high), F.lit(False)), digest=~F.coalesce(F.col("digest") == F.col("declared_digest"), F.lit(False)))
    return runs.withColumn("violations", v).withColumn("passed", F.size("violations") == 0)


def training_anchor_audit(audited: DataFrame, runs: DataFrame, events: DataFrame) -> DataFrame:
    """``training_evidence_audit`` rows with the violation ``anchor_plan`` where a run's anchor events are not those planned.

    runs: run_id, iterations; events: run_id, iteration, before, added, deleted, after. A run without planned or seen events keeps its result.
    """
    wrong = anchor_event_check(runs, events).groupBy("run_id").agg(F.count("*").alias("anchor_faults"))
    d = audited.join(wrong.hint("merge"), "run_id", "left").withColumn("anchor_faults", F.coalesce("anchor_faults", F.lit(0)))
    d = d.withColumn("violations", F.concat("violations", X.violations(anchor_plan=F.col("anchor_faults") > 0)))
    return d.withColumn("passed", F.size("violations") == 0)


def existing_run_stages(attempts: DataFrame, inventory: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Each run's stages in order with the latest attempt, its status and whether all its artifacts are still as declared."""
    checked = artifact_hash_check(attempts, inventory).select("run_id", "stage", "attempt", "invalid_artifacts", "reusable")
    latest = latest_attempt(attempts).select("run_id", "stage", "attempt", "status").join(checked.hint("merge"), ["run_id", "stage", "attempt"], "left")
    order = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage")) for i, s in enumerate(stages)]))
    grid = attempts.select("run_id").distinct().select("run_id", order.alias("o")).select("run_id", "o.position", "o.stage")
    d = grid.join(latest.hint("merge"), ["run_id", "stage"], "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    return d.withColumn("reusable", F.coalesce("reusable", F.lit(False)))


def audit_training_input(images: DataFrame, contract: DataFrame, model_names: DataFrame, key: Sequence[str] = ("model_id",)) -> DataFrame:
    """Names of a model's images that the contract or the sparse model lacks or has besides, and hashes that differ, as violations.

    images and contract: key, name, sha256; model_names: key, name.
    """
    k = [*key, "name"]
    against = lambda other, label: key_set_status(other, images, k).where("status <> 'matched'").select(*k, F.concat(F.lit(f"{label}_"), "status").alias("violation"))
    hashes = images.join(contract.select(*k, F.col("sha256").alias("_sha")), k).where("NOT (sha256 <=> _sha)").select(*k, F.lit("hash").alias("violation"))
    return against(contract, "contract").unionByName(against(model_names, "model")).unionByName(hashes)


def audit_image_records(records: DataFrame, found: DataFrame, contract_names: DataFrame, model_names: DataFrame, contracts: DataFrame, key: str = "model_id") -> DataFrame:
    """(key, name, violations) of a training input's image names that break a rule: its records, files, camera contract and sparse model.

    records: key, name, file_sha256, decoded_pixel_sha256. found: key, name, sha256, pixel_sha256, width, height, one row for each readable file.
    contract_names and model_names: key, name. contracts: key, width, height, one row a model.

    A record's name is a base name, unique, with a stem of its own, and known to all sides; its file has the declared hashes and the contract's
    size. Names that only the contract or the model has are listed too; files without a record are not. Each of a name's records is held
    against its file. All sides meet in one shuffle by name, of partial aggregates.
    """
    c = F.col
    # Strings are keys of the groups, never their sums: sums of strings would sort all rows. What is sorted is sorted by name first, in which few rows are equal.
    held = records.groupBy("name", key, "file_sha256", "decoded_pixel_sha256").agg(F.count("*").alias("_records"))
    held = held.join(found.select(c(key).alias("_key"), c("name").alias("_name"), "sha256", "pixel_sha256", "width", "height", F.lit(True).alias("_file")).hint("merge"), c("name").eqNullSafe(c("_name")) & c(key).eqNullSafe(c("_key")), "left")
    differ = lambda a, b: c("_file") & ~c(a).eqNullSafe(c(b))
    on_disk = {"_files": F.coalesce("_file", F.lit(False)), "_sha": F.coalesce(differ("file_sha256", "sha256"), F.lit(False)), "_pixels": F.coalesce(differ("decoded_pixel_sha256", "pixel_sha256"), F.lit(False)), "_w": c("width").cast("int"), "_h": c("height").cast("int")}
    none = {"_files": F.lit(False), "_sha": F.lit(False), "_pixels": F.lit(False), "_w": F.lit(None).cast("int"), "_h": F.lit(None).cast("int")}
    rows = held.select(key, "name", "_records", F.lit(False).alias("_contract"), F.lit(False).alias("_model"), *[v.alias(n) for n, v in on_disk.items()])
    for d, label in ((contract_names, "contract"), (model_names, "model")):
        rows = rows.unionByName(d.select(key, "name", F.lit(0).cast("long").alias("_records"), *[F.lit(s == label).alias(f"_{s}") for s in ("contract", "model")], *[v.alias(n) for n, v in none.items()]))
    d = rows.groupBy(key, "name").agg(F.sum("_records").alias("_records"), *[F.max(n).alias(n) for n in ("_contract", "_model", *none)])
    # What follows the last point, if anything is before it, is no part of the stem.
    ending = F.length(F.substring_index("name", ".", -1))
    stem = F.when(ending < F.length("name") - 1, F.substring(c("name"), F.lit(1), F.length("name") - ending - 1)).otherwise(c("name"))
    limits = contracts.select(c(key).alias("_key"), c("width").alias("_width"), c("height").alias("_height"))
    d = d.withColumn("_stem", stem)
    d = d.withColumn("_twins", F.count_if(c("_records") > 0).over(Window.partitionBy("_stem", key)))
    d = scene_join(d.withColumn("_key", c(key)), limits, "_key", "left").drop("_key")
    has, both = c("_records") > 0, (c("_records") > 0) & c("_files")
    size = ~c("_w").eqNullSafe(c("_width")) | ~c("_h").eqNullSafe(c("_height"))
    v = X.violations(
        not_a_basename=has & (F.coalesce(c("name"), F.lit("")).isin("", ".", "..") | c("name").contains("/")), repeated=c("_records") > 1, stem=has & (c("_twins") > 1), not_in_contract=has & ~c("_contract"), only_in_contract=~has & c("_contract"), not_in_model=has & ~c("_model"), only_in_model=~has & c("_model"),
        file_missing=has & ~c("_files"), file_hash=c("_sha"), pixel_hash=c("_pixels"), dimensions=both & size,
    )
    return d.select(key, "name", v.alias("violations")).where("size(violations) > 0")


def audit_training_models(contracts: DataFrame, records: DataFrame, found: DataFrame, cameras: DataFrame, model_names: DataFrame, key: str = "model_id", tolerance: float = 1e-8) -> DataFrame:
    """(key, violations) of each contract's model as a whole: its camera, numbers of images and the digest of all its pixels.

    contracts: key, model, width, height, fx, fy, cx, cy, pixel_digest (a ``content_digest`` of names and pixel hashes), one row a model. cameras: key, model,
    width, height, params, of the sparse model. The model has one pinhole camera of the contract's size and parameters and as many images as there are records.
    """
    c = F.col
    own = cameras.groupBy(key).agg(F.count("*").alias("_cameras"), F.max("model").alias("_model"), F.max("width").alias("_w"), F.max("height").alias("_h"), F.max("params").alias("_params"))
    count = lambda d, n: d.groupBy(key).agg(F.count("*").alias(n))
    kept = found.join(records.select(key, "name").distinct().hint("merge"), [key, "name"], "left_semi")
    d = contracts
    for other in (own, count(records, "_records"), count(model_names, "_images"), content_digest(kept, [key], "name", "pixel_sha256").select(key, "digest")):
        d = d.join(other.hint("merge"), key, "left")
    near = [F.coalesce(F.abs(F.get("_params", F.lit(i)) - c(n)) <= tolerance, F.lit(False)) for i, n in enumerate(("fx", "fy", "cx", "cy"))]
    one = F.coalesce(c("_cameras") == 1, F.lit(False))
    records_ = F.coalesce(c("_records"), F.lit(0))
    v = X.violations(
        no_records=records_ == 0, camera_count=~one, contract_camera=~F.coalesce((c("model") == "PINHOLE") & (c("width") > 0) & (c("height") > 0), F.lit(False)), camera_model=one & ~c("_model").eqNullSafe(c("model")), camera_size=one & ~(c("_w").eqNullSafe(c("width")) & c("_h").eqNullSafe(c("height"))),
        intrinsics=one & ~(near[0] & near[1] & near[2] & near[3]), image_count=F.coalesce(c("_images"), F.lit(0)) != records_, pixel_digest=~c("pixel_digest").eqNullSafe(c("digest")),
    )
    return d.select(key, v.alias("violations"))


def normalize_converted_eval(records: DataFrame, text: str = "evidence") -> DataFrame:
    """structural_pass, visual_pass (pass, fail or null) and status of converted-eval records (JSON) of either version.

    Version 1 has one ``passed``, which only speaks for the structure; version 2 has ``structural_pass`` and ``visual_pass``. A
    record in which both kinds of names contradict each other has a violation.
    """
    v = F.try_parse_json(text)
    get = lambda n, kind: F.try_variant_get(v, f"$.{n}", kind)
    old, new = get("passed", "boolean"), get("structural_pass", "boolean")
    visual = get("visual_pass", "boolean")
    d = records.withColumn("structural_pass", F.coalesce(new, old)).withColumn("visual_pass", F.when(visual, "pass").when(~visual, "fail"))
    bad = X.violations(not_an_object=~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), no_verdict=F.col("structural_pass").isNull(), alias_conflict=F.coalesce(old != new, F.lit(False)))
    status = F.when(~F.col("structural_pass"), "failed").when(F.col("visual_pass") == "pass", "passed").otherwise("needs_review")
    return d.withColumn("violations", bad).withColumn("status", status)


#: Fixed values of the evaluation records: names of flags and the ending of the old schema's name.
STRUCTURAL_FLAGS = ("all_pngs_decoded", "all_pngs_finite", "all_dimensions_exact", "all_names_and_order_exact")
OLD_EVALUATION = "converted-eval-cpu-postprocess-v1"


def converted_evaluation(records: DataFrame, identities: DataFrame | None = None, key: str = "run_id", text: str = "evidence") -> DataFrame:
    """One strict reading of converted-evaluation records (JSON): structural_pass, visual_pass (null: no claim), warnings and violations.

    Both names of the structural verdict must be booleans and agree, with each other and with what ``full_stream_validation`` says of it. A record of the old
    schema is read from its verified flags and counts instead, whatever else it states; that its nested ``pass`` was once the visual
    verdict is a warning. ``visual_quality_pass`` and SAME_CAMERA_VISUAL_PASS (pass, fail, needs_review) must agree; a review is no claim. Cameras (count, order,
    dimensions) must be whole where one of them is given, always in the old schema, and equal ``identities`` (key, camera_count, camera_order,
    width, height) where that has the key. All violations are listed; a record with any has no verdicts.
    """
    c, lit = F.col, F.lit
    v = F.try_parse_json(text)
    get = lambda path: F.try_variant_get(v, f"$.{path}", "variant")
    kind = lambda path: F.schema_of_variant(get(path))
    there = lambda path: get(path).isNotNull()
    flag = lambda path: F.when(kind(path) == "BOOLEAN", F.try_variant_get(v, f"$.{path}", "boolean"))
    whole = lambda path: F.when(kind(path) == "BIGINT", F.try_variant_get(v, f"$.{path}", "long"))
    given = lambda path: F.coalesce(kind(path) != "VOID", lit(False))  # noqa: E731  there and not null
    yes = lambda x: F.coalesce(x, lit(False))
    names = ("STRUCTURAL_EVALUATION_PASS", "FULL_STREAM_VALIDATION_PASS")
    full, cameras = "full_stream_validation", ("camera_count", "camera_order", "camera_dimensions")
    is_object = lambda path: yes(kind(path).startswith("OBJECT"))
    d = records.withColumns({
        "_object": yes(F.schema_of_variant(v).startswith("OBJECT")), "_old": yes(F.try_variant_get(v, "$.schema_version", "string").endswith(OLD_EVALUATION)), "_a": flag(names[0]), "_b": flag(names[1]), "_odd": (there(names[0]) & flag(names[0]).isNull()) | (there(names[1]) & flag(names[1]).isNull()),
        "_full": is_object(full), "_count": whole("camera_count"), "_unusable": flag(f"{full}.no_usable_converted_views"), "_nested": flag(f"{full}.pass"), "_nested_structural": flag(f"{full}.structural_pass"),
        "_same": F.try_variant_get(v, "$.SAME_CAMERA_VISUAL_PASS", "string"), "_visual": flag("visual_quality_pass"), "_order": F.when(kind("camera_order") == "ARRAY<STRING>", F.try_variant_get(v, "$.camera_order", "array<string>")),
        "_width": whole("camera_dimensions.width"), "_height": whole("camera_dimensions.height"), "_named": there(cameras[0]) | there(cameras[1]) | there(cameras[2]),
    })
    missing = F.array_compact(F.array(*[F.when(~yes(flag(f"{full}.{f}")), lit(f)) for f in STRUCTURAL_FLAGS]))
    processed, expected = whole(f"{full}.triples_processed"), whole(f"{full}.expected_triples")
    counted = yes(processed > 0) & yes(expected > 0)
    d = d.withColumn("_structural", F.when(c("_old"), ~c("_unusable")).otherwise(F.coalesce("_a", "_b")))
    d = d.withColumn("_derived", F.when(c("_same") == "pass", True).when(c("_same") == "fail", False))
    old, new = c("_old"), ~c("_old")
    sound = yes(c("_count") > 0)
    order = yes((F.size("_order") == c("_count")) & (F.size(F.array_distinct("_order")) == F.size("_order")) & ~F.exists("_order", lambda n: n.isNull() | (n == "")))
    held = c("_named") | old
    if identities is not None:
        i = identities.select(F.col(key).alias("_key"), *[F.col(n).alias(f"_i_{n}") for n in ("camera_count", "camera_order", "width", "height")], lit(True).alias("_known"))
        d = d.join(i.hint("merge"), c(key) == c("_key"), "left")
        differs = {f"identity_differs_{f}": yes(c("_known")) & given(f) & ~yes(same) for f, same in ((cameras[0], c("_count") == c("_i_camera_count")), (cameras[1], c("_order") == c("_i_camera_order")), (cameras[2], (c("_width") == c("_i_width")) & (c("_height") == c("_i_height"))))}
    else:
        differs = {}
    violations = X.violations(
        not_an_object=~c("_object"), structural_not_boolean=c("_odd"), structural_missing=c("_object") & new & c("_a").isNull() & c("_b").isNull() & ~c("_odd"), structural_aliases_disagree=yes(c("_a") != c("_b")),
        old_without_full_stream_validation=old & ~c("_full"), old_camera_count=old & ~sound, old_flags=old & c("_full") & (F.size(missing) > 0), old_counts=old & c("_full") & ~counted, old_counts_differ=old & counted & yes((expected != c("_count")) | (processed != expected)),
        old_no_usable_views=old & c("_full") & c("_unusable").isNull(), old_aliases_disagree_with_evidence=old & yes((c("_a") != c("_structural")) | (c("_b") != c("_structural"))),
        full_stream_validation_not_an_object=given(full) & ~c("_full"), nested_not_boolean=c("_full") & ((there(f"{full}.pass") & c("_nested").isNull()) | (there(f"{full}.structural_pass") & c("_nested_structural").isNull())),
        nested_structural_pass_disagrees=yes(c("_nested_structural") != c("_structural")), nested_pass_disagrees=yes(c("_nested") != c("_structural")) & ~(old & yes(c("_structural")) & yes(~c("_nested"))),
        same_camera_visual_pass=given("SAME_CAMERA_VISUAL_PASS") & ~yes(c("_same").isin("pass", "fail", "needs_review") & (kind("SAME_CAMERA_VISUAL_PASS") == "STRING")), visual_not_boolean=given("visual_quality_pass") & c("_visual").isNull(), visual_verdicts_disagree=yes(c("_visual") != c("_derived")),
        identity_camera_count=held & ~sound, identity_camera_order=held & ~order, identity_camera_dimensions=held & ~(yes(c("_width") > 0) & yes(c("_height") > 0)), **differs,
    )
    warnings = X.violations(
        legacy_structural_pass_derived_from_verified_full_stream_flags=old & c("_a").isNull() & c("_b").isNull(), legacy_nested_full_stream_pass_was_visual_mixed=old & yes(c("_structural")) & yes(~c("_nested")),
    )
    d = d.withColumn("violations", violations)
    good = F.size("violations") == 0
    out = {"structural_pass": F.when(good, c("_structural")), "visual_pass": F.when(good, F.coalesce("_visual", "_derived")), "warnings": F.when(good, warnings).otherwise(F.array().cast("array<string>"))}
    return d.withColumns(out).select(*records.columns, "structural_pass", "visual_pass", "warnings", "violations")


def normalize_postcheck(records: DataFrame, text: str = "evidence") -> DataFrame:
    """The nested ``postcheck_result`` of a record, else the record itself, which must have a structural object."""
    v = F.try_parse_json(text)
    nested = F.try_variant_get(v, "$.postcheck_result", "variant")
    is_object = lambda c: F.coalesce(F.schema_of_variant(c).startswith("OBJECT"), F.lit(False))
    d = records.withColumn("_c", F.when(is_object(nested), nested).otherwise(v))
    structural = F.try_variant_get("_c", "$.structural", "variant")
    d = d.withColumn("nested", is_object(nested)).withColumn("structural", F.when(is_object(structural), F.to_json(structural)))
    return d.withColumn("violations", X.violations(no_structural=F.col("structural").isNull())).drop("_c")
