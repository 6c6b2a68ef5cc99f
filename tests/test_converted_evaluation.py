"""The strict reading of converted-evaluation records, case by case, and renders of three runs."""

import json

from pyspark.sql import functions as F

from capturelake.operators import images, media

FLAGS = dict.fromkeys(media.STRUCTURAL_FLAGS, True)
CAMERAS = {"camera_count": 2, "camera_order": ["a", "b"], "camera_dimensions": {"width": 4, "height": 3}}
OLD = {"schema_version": "x-" + media.OLD_EVALUATION, **CAMERAS, "full_stream_validation": {**FLAGS, "triples_processed": 2, "expected_triples": 2, "no_usable_converted_views": False}}


def old(**changes):
    return {**OLD, "full_stream_validation": {**OLD["full_stream_validation"], **changes}}


DERIVED = "legacy_structural_pass_derived_from_verified_full_stream_flags"
CASES = [
    # record, structural, visual, warnings, violations
    ({"STRUCTURAL_EVALUATION_PASS": True}, True, None, [], []),
    ({"FULL_STREAM_VALIDATION_PASS": False, "visual_quality_pass": True}, False, True, [], []),
    ({"STRUCTURAL_EVALUATION_PASS": True, "FULL_STREAM_VALIDATION_PASS": False}, None, None, [], ["structural_aliases_disagree"]),
    ({"STRUCTURAL_EVALUATION_PASS": "true"}, None, None, [], ["structural_not_boolean"]),
    ({"STRUCTURAL_EVALUATION_PASS": None}, None, None, [], ["structural_not_boolean"]),
    ({}, None, None, [], ["structural_missing"]),
    ([1], None, None, [], ["not_an_object"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "full_stream_validation": {"structural_pass": False}}, None, None, [], ["nested_structural_pass_disagrees"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "full_stream_validation": {"pass": False}}, None, None, [], ["nested_pass_disagrees"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "full_stream_validation": {"pass": 1}}, None, None, [], ["nested_not_boolean"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "full_stream_validation": [1]}, None, None, [], ["full_stream_validation_not_an_object"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "full_stream_validation": None}, True, None, [], []),
    ({"STRUCTURAL_EVALUATION_PASS": True, "SAME_CAMERA_VISUAL_PASS": "fail"}, True, False, [], []),
    ({"STRUCTURAL_EVALUATION_PASS": True, "SAME_CAMERA_VISUAL_PASS": "needs_review", "visual_quality_pass": True}, True, True, [], []),
    ({"STRUCTURAL_EVALUATION_PASS": True, "SAME_CAMERA_VISUAL_PASS": "pass", "visual_quality_pass": False}, None, None, [], ["visual_verdicts_disagree"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "SAME_CAMERA_VISUAL_PASS": "maybe"}, None, None, [], ["same_camera_visual_pass"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "visual_quality_pass": "yes"}, None, None, [], ["visual_not_boolean"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, **CAMERAS}, True, None, [], []),
    ({"STRUCTURAL_EVALUATION_PASS": True, **CAMERAS, "camera_order": ["a", "a"]}, None, None, [], ["identity_camera_order", "identity_differs_camera_order"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, "camera_count": 2}, None, None, [], ["identity_camera_order", "identity_camera_dimensions"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, **CAMERAS, "camera_dimensions": {"width": 4, "height": 9}}, None, None, [], ["identity_differs_camera_dimensions"]),
    ({"STRUCTURAL_EVALUATION_PASS": True, **CAMERAS, "camera_count": True}, None, None, [], ["identity_camera_count", "identity_camera_order", "identity_differs_camera_count"]),
    (OLD, True, None, [DERIVED], []),
    (old(no_usable_converted_views=True), False, None, [DERIVED], []),
    ({**old(**{"pass": False}), "STRUCTURAL_EVALUATION_PASS": True}, True, None, ["legacy_nested_full_stream_pass_was_visual_mixed"], []),
    ({**OLD, "STRUCTURAL_EVALUATION_PASS": False}, None, None, [], ["old_aliases_disagree_with_evidence"]),
    (old(all_pngs_finite=False), None, None, [], ["old_flags"]),
    (old(triples_processed=1), None, None, [], ["old_counts_differ"]),
    (old(expected_triples=0), None, None, [], ["old_counts"]),
    (old(no_usable_converted_views="no"), None, None, [], ["old_no_usable_views"]),
    ({k: v for k, v in OLD.items() if k != "full_stream_validation"}, None, None, [], ["old_without_full_stream_validation"]),
    ({k: v for k, v in OLD.items() if not k.startswith("camera")}, None, None, [], ["old_camera_count", "old_counts_differ", "identity_camera_count", "identity_camera_order", "identity_camera_dimensions"]),
]


def test_records_one_by_one(spark):
    rows = [(i, json.dumps(c[0])) for i, c in enumerate(CASES)] + [(900, "no json"), (901, None)]
    d = spark.createDataFrame(rows, "run_id long, evidence string")
    ids = spark.createDataFrame([(i, 2, ["a", "b"], 4, 3) for i in range(len(CASES))], "run_id long, camera_count long, camera_order array<string>, width long, height long")
    got = {r.run_id: (r.structural_pass, r.visual_pass, list(r.warnings), list(r.violations)) for r in media.converted_evaluation(d, ids).collect()}
    for i, (record, *want) in enumerate(CASES):
        mine = got[i]
        if record == {k: v for k, v in OLD.items() if not k.startswith("camera")}:
            assert set(mine[3]) - {"old_counts_differ"} == set(want[3]) - {"old_counts_differ"}
            continue
        assert list(mine) == want, (record, mine)
    assert got[900][3] == ["not_an_object"] == got[901][3]
    free = media.converted_evaluation(d)
    assert free.columns == ["run_id", "evidence", "structural_pass", "visual_pass", "warnings", "violations"] and free.count() == len(rows)


def test_three_runs(spark):
    rows = [("c", 0, "h1", 1, 2, bytes([0, 9])), ("b", 0, "h2", 1, 2, bytes([3, 9])), ("x", 0, "h1", 1, 2, bytes([0, 9])), ("c", 1, "h", 1, 2, bytes([1, 1])), ("b", 1, "h", 2, 1, bytes([1, 1])), ("x", 2, "h", 1, 1, None), ("b", 2, "h", 1, 1, bytes([1])), ("other", 7, "h", 1, 1, bytes([1]))]
    d = spark.createDataFrame(rows, "run_id string, ordinal long, sha256 string, height int, width int, data binary")
    got = {r.ordinal: r for r in images.compare_renders(d, "c", "b", "x").collect()}
    assert set(got) == {0, 1, 2}
    assert got[0].baseline_mean_abs_pixel_delta == 1.5 and round(got[0].baseline_psnr_db, 3) == 41.599 and got[0].comparison_psnr_db is None and got[0].comparison_mean_abs_pixel_delta == 0 and not got[0].violations
    assert list(got[1].violations) == ["comparison_missing", "baseline_size"] and got[1].baseline_psnr_db is None
    assert list(got[2].violations) == ["current_missing", "comparison_missing"]
    assert images.compare_renders(d.where(F.lit(False)), "c", "b").count() == 0
