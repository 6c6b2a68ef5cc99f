"""Tasks whose memory does not grow with the input: endpoints, registered names and exposure events."""

from pyspark.sql import functions as F

from capturelake.functions import staging
from capturelake.operators import images, sparse
from capturelake.streaming import progress


def test_endpoints_with_repeated_views_nulls_and_parts(spark, monkeypatch):
    """The same as from the join of views and poses; parts are dealt by number of rows."""
    views = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "a"), (1, 4, "a"), (1, 4, "b"), (1, 5, None), (1, None, "a"), (1, 6, "a"), (1, 6, None), (2, 1, "a"), (1, 7, "a"), (1, 7, "a")], "run_id int, camera int, sha string")
    poses = spark.createDataFrame([(1, 1, 1, 0.0, "a"), (1, 2, 2, 0.0, "b"), (1, 3, 3, 0.0, "a"), (1, 3, 3, 0.0, "a"), (1, 4, 4, 0.0, "a"), (1, 5, 5, 0.0, "a"), (1, None, None, 0.0, "a"), (1, 6, 6, 0.0, "a"), (2, 1, 1, 0.0, None), (1, 1, 2, 0.0, "x"), (1, 1, 1, 0.5, "x"), (1, 7, 7, 0.0, "a"), (9, 9, 9, 0.0, "a")], "run_id int, left int, right int, alpha double, sha string")
    ends = poses.where("left = right AND alpha = 0").select("run_id", F.col("left").alias("camera"), F.col("sha").alias("pose_sha"))
    want = views.join(ends, ["run_id", "camera"], "left").groupBy("run_id", "camera").agg(F.count("pose_sha").alias("poses"), F.coalesce(F.bool_and(F.col("sha") == F.col("pose_sha")), F.lit(False)).alias("equal"))
    want = {(r.run_id, r.camera): (r.poses, r.equal) for r in want.collect() if r.poses != 1 or not r.equal}
    monkeypatch.setattr(staging, "PART_ROWS", 2)
    d = images.endpoint_match(views, poses)
    assert {(r.run_id, r.camera): (r.poses, r.equal) for r in d.collect()} == want
    assert "REPARTITION_BY_NUM" in d._jdf.queryExecution().executedPlan().toString()


def test_registered_names_with_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(staging, "PART_ROWS", 2)
    selected = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 1, "w"), ("b", None, "v")], "component string, name int, more string")
    registered = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", None)], "component string, name int")
    d = sparse.registered_vs_selected(registered, selected, ["component"])
    assert sorted((r.more, r.registered) for r in d.collect()) == [("v", False), ("w", False), ("x", True), ("y", True), ("z", False)]
    assert d.columns == ["component", "name", "more", "registered"]
    assert d._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 2


def test_exposure_in_slices_and_micro_batches(spark, tmp_path, monkeypatch):
    """Two micro-batches, null and new cameras, a gap and slices of three rows."""
    monkeypatch.setattr(progress, "SLICE", 3)
    out, last = str(tmp_path / "out"), {}
    rows = [[(7, i, c) for i, c in enumerate(["a", None, "a", "b", "a", None, "c", "b"], 1)], [(7, 12, "d"), (7, 11, "a"), (8, 1, None)]]
    for k, r in enumerate(rows):
        spark.createDataFrame(r, "run_id long, iteration long, camera string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        d = progress.stream_exposure(spark.readStream.schema("run_id long, iteration long, camera string").parquet(str(tmp_path / "in")))
        d.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    want, seen = [], {}
    for run, i, c in [*rows[0], (7, 11, "a"), (7, 12, "d"), (8, 1, None)]:
        own = seen.setdefault(run, {})
        own[c] = own.get(c, 0) + 1
        want.append((run, i, c, own[c], len(own), i == last.get(run, 0) + 1))
        last[run] = i
    got = spark.read.parquet(out).select("run_id", "iteration", "camera", "exposure_count", "cumulative_unique_count", "in_sequence").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
