"""Digests of file sets and documents, checkpoints, evidence of sparse models, and audits of training inputs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from capturelake.functions import staging
from capturelake.operators import media, runs, sparse, trajectory


def digest(spark, rows):
    d = runs.content_digest(spark.createDataFrame([("k", *r) for r in rows], "k string, name string, sha256 string"), ["k"]).first()
    return d["digest"] if d else None


def test_digest_of_a_set(spark):
    rows = [(f"f{i}", f"s{i % 7}") for i in range(500)]
    one = digest(spark, rows)
    assert one == digest(spark, rows[::-1]) and len(one) == 64
    others = [rows + rows[:1], rows[1:], [("f0", "s1"), *rows[1:]], [("f0:", "s0"), *rows[1:]], [(None, "s0"), *rows[1:]], [("", "s0"), *rows[1:]], [("f0", None), *rows[1:]], [("f0", ""), *rows[1:]]]
    assert len({one, *[digest(spark, r) for r in others]}) == len(others) + 1
    assert digest(spark, []) is None


def test_digest_in_plain_code(spark):
    rows = [(f"f{i}", "s") for i in range(9000)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    parts = {}
    for n, s in rows:
        parts.setdefault(sha(n)[:3], []).append(f"{sha(n)}:{sha(s)}")
    assert digest(spark, rows) == sha("\n".join(sorted(f"{p}:" + sha("\n".join(sorted(lines))) for p, lines in parts.items())))


@pytest.mark.parametrize("document", [{"b": [1.0, 1e-7, 10**30], "a": {"z": None, "y": "é 😀", "": True}}, [], "text", 0, {"a": "x" * 100_000}])
def test_digest_of_a_document(spark, document):
    want = hashlib.sha256(json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    d = spark.createDataFrame([(json.dumps(document, indent=2),)], "document string")
    assert runs.document_digest(d).select("digest", "violation").first() == (want, None)


@pytest.mark.parametrize(("text", "want"), [(None, "not_json"), ("", "not_json"), ("{", "not_json"), ('{"a": NaN}', "not_json"), ('{"a": 1e999}', "not_json"), ('"\\ud800"', "not_json"), ("[" * 100_000, "not_json"), ("[1]", "not_an_object"), ("null", "not_an_object"), ('{"sha": "x"}', "digest"), ("{}", "digest"), ('{"sha": 5, "a": 1}', "digest")])
def test_documents_without_a_right_digest(spark, text, want):
    d = spark.createDataFrame([(text,)], "document string")
    assert runs.document_digest(d, declared="sha").first()["violation"] == want


def test_document_with_its_own_digest(spark):
    body = {"b": 1, "a": "é"}
    own = hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    d = spark.createDataFrame([(json.dumps({"sha": own, **body}),)], "document string")
    assert runs.document_digest(d, declared="sha").select("digest", "violation").first() == (own, None)


def test_checkpoints_of_model_folders(spark):
    paths = {"a": ["m/chkpnt700.pth", "m/chkpnt1000.pth", "m/point_cloud/iteration_3000/p.ply"], "b": ["point_cloud/iteration_30/p.ply", "x/point_cloud/iteration_200"], "c": ["m/chkpnt.pth", "m/chkpnt12.pth.bak", "m/mychkpnt5.pth"], "d": [None]}
    inventory = spark.createDataFrame([(k, p) for k, ps in paths.items() for p in ps], "scene_id string, path string")
    assert {r["scene_id"]: r["checkpoint_iteration"] for r in trajectory.native_checkpoints(inventory).collect()} == {"a": 1000, "b": 200, "c": None, "d": None}
    audited = spark.createDataFrame([(k, ["x"] if k == "b" else []) for k in "abcde"], "scene_id string, reasons array<string>")
    expected = spark.createDataFrame([("a", 1000), ("b", 30), ("c", 5), ("d", None)], "scene_id string, expected_iteration long")
    got = {r["scene_id"]: (r["reasons"], r["passed"]) for r in trajectory.checkpoint_audit(audited, inventory, expected).collect()}
    assert got == {"a": ([], True), "b": (["x", "checkpoint_iteration"], False), "c": (["checkpoint_missing"], False), "d": ([], True), "e": ([], True)}


def evidence(spark, images, expected, params=(500.0, 500.0, 320.0, 240.0)):
    t = lambda rows, schema: spark.createDataFrame(rows, f"model_id int, {schema}")
    cameras = t([(1, 640, 480, list(params))], "width int, height int, params array<double>")
    names = None if expected is None else t([(1, n) for n in expected], "name string")
    d = sparse.geometry_evidence(cameras, t([(1, n) for n in images], "name string"), t([(1, 0.5, 3), (1, 1.5, 0)], "error double, track_length int"), t([(1, True, True)], "centers_finite boolean, continuous boolean"), t([(1, 1)], "component_count int"), names)
    return sparse.named_geometry_gate(d).first()


@pytest.mark.parametrize(("images", "expected", "match"), [(["a", "b"], ["b", "a"], True), (["a", "b"], ["a"], False), (["a", "b"], ["a", "b", "c"], False), (["a", "a", "b"], ["a", "b"], False), (["a", "b"], None, None), ([], [], True)])
def test_registered_names_against_the_staged_set(spark, images, expected, match):
    r = evidence(spark, images, expected)
    assert r["names_match"] is match and r["registered_image_count"] == len(images) and (r["point_count"], r["track_count"], r["reprojection_error_px"]) == (2, 1, 1.0)
    assert ("registered_names_do_not_match_staged_set" in r["hard_failures"]) == (match is False) and r["computed_pass"] == (r["hard_failures"] == [])


def test_cameras_with_missing_parameters(spark):
    assert evidence(spark, ["a", "b"], None, (500.0, 500.0))["hard_failures"] == ["non_finite_camera_cx", "non_finite_camera_cy"]
    assert evidence(spark, ["a", "b"], None, (500.0, -1.0, float("nan"), 1.0))["hard_failures"] == ["non_positive_focal_length", "non_finite_camera_cx"]


def training(spark, **change):
    given = {"records": [(1, "a.png", "x", "p"), (1, "b.png", "y", "q")], "found": [(1, "a.png", "x", "p", 4, 3), (1, "b.png", "y", "q", 4, 3)], "contract": ["a.png", "b.png"], "model": ["a.png", "b.png"], **change}
    t = lambda rows, schema: spark.createDataFrame(rows, f"model_id int, {schema}")
    names = lambda n: t([(1, x) for x in given[n]], "name string")
    return t(given["records"], "name string, file_sha256 string, decoded_pixel_sha256 string"), t(given["found"], "name string, sha256 string, pixel_sha256 string, width int, height int"), names("contract"), names("model")


RECORD = {
    "right": ({}, {}), "contract": ({"contract": ["a.png", "c.png"]}, {"b.png": ["not_in_contract"], "c.png": ["only_in_contract"]}), "model": ({"model": ["b.png"]}, {"a.png": ["not_in_model"]}), "file": ({"found": [(1, "a.png", "z", None, 3, 4)]}, {"a.png": ["file_hash", "pixel_hash", "dimensions"], "b.png": ["file_missing"]}),
    "stem": ({"records": [(1, "a.png", "x", "p"), (1, "a.jpg", "y", "q")], "found": [(1, "a.png", "x", "p", 4, 3), (1, "a.jpg", "y", "q", 4, 3)], "contract": ["a.png", "a.jpg"], "model": ["a.png", "a.jpg"]}, {"a.png": ["stem"], "a.jpg": ["stem"]}),
    "folder": ({"records": [(1, "d/a", "x", "p"), (1, None, "x", "p")], "found": [(1, "d/a", "x", "p", 4, 3), (1, None, "x", "p", 4, 3)], "contract": ["d/a", None], "model": ["d/a", None]}, {"d/a": ["not_a_basename"], None: ["not_a_basename"]}),
    "twice": ({"records": [(1, "a.png", "x", "p"), (1, "a.png", "x", "p"), (1, "b.png", "y", "q")]}, {"a.png": ["repeated"]}), "nothing": ({"records": [], "contract": [], "model": []}, {}),
}


@pytest.mark.parametrize("salted", [False, True])
@pytest.mark.parametrize("case", RECORD)
def test_records_of_a_training_input(spark, case, salted, monkeypatch):
    if salted:
        monkeypatch.setattr(staging, "BROADCAST_ROWS", 0)
    change, want = RECORD[case]
    contracts = spark.createDataFrame([(1, 4, 3)], "model_id int, width int, height int")
    assert {r["name"]: r["violations"] for r in media.audit_image_records(*training(spark, **change), contracts).collect()} == want


def test_models_of_a_training_input(spark):
    records, found, _, model = training(spark)
    right = runs.content_digest(found, ["model_id"], "name", "pixel_sha256").first()["digest"]
    fields = "model_id int, model string, width int, height int, fx double, fy double, cx double, cy double, pixel_digest string"
    contracts = spark.createDataFrame([(1, "PINHOLE", 4, 3, 5.0, 5.0, 2.0, 1.5, right), (2, None, None, None, None, None, None, None, None)], fields)
    cameras = spark.createDataFrame([(1, "PINHOLE", 4, 3, [5.0, 5.0, 2.0, 1.5 + 1e-9])], "model_id int, model string, width int, height int, params array<double>")
    found = found.unionByName(found.withColumn("name", F.lit("besides")))
    got = {r["model_id"]: r["violations"] for r in media.audit_training_models(contracts, records, found, cameras, model).collect()}
    assert got == {1: [], 2: ["no_records", "camera_count", "contract_camera"]}
    off = cameras.withColumn("params", F.array(*map(F.lit, (5.0, 5.0, 2.0)))).withColumn("width", F.lit(5))
    bad = media.audit_training_models(contracts.where("model_id = 1").withColumn("pixel_digest", F.lit("x")), records, found, off, model.limit(1)).first()["violations"]
    assert bad == ["camera_size", "intrinsics", "image_count", "pixel_digest"]


def test_image_records_are_not_sorted_for_their_hashes(spark):
    """Groups are hashed, not sorted; two records of one name are both held against its file."""
    records, found, contract, model = training(spark)
    name = found.first()["name"]
    records = records.unionByName(records.where(F.col("name") == name).withColumn("file_sha256", F.lit("")))
    d = media.audit_image_records(records, found, contract, model, spark.createDataFrame([(1, 4, 3)], "model_id int, width int, height int"))
    assert "SortAggregate" not in d._jdf.queryExecution().executedPlan().toString()
    assert {r["name"]: r["violations"] for r in d.collect()} == {name: ["repeated", "file_hash"]}
