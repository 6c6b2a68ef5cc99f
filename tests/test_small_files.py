"""Many small JSON files: listed and read by tasks, with the rows of Spark's reader."""

from capturelake.sources import files


def test_attempts_are_listed_by_tasks(spark, tmp_path):
    bodies = {"run1/stages/train/attempt-0001/request.json": '{"started_at": "a b"}', "run1/stages/train/attempt-0001/result.json": '[{"status": "passed"}, {"status": "failed"}]', "run1/stages/train/attempt-0002/request.json": "﻿{}", "x/run2/stages/eval/attempt-0003/result.json": "{", "run1/stages/train/attempt-0004/request.json": "", "_temporary/run3/stages/train/attempt-0001/request.json": "{}", "run1/stages/train/attempt-0005/other.json": "{}"}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body, encoding="utf-8")
    d = files.read_attempts(spark, str(tmp_path))
    assert "FileScan" not in d._jdf.queryExecution().executedPlan().toString()
    rows = lambda d: sorted((tuple(r) for r in d.select("run_id", "stage", "attempt", "status", "started_at", "orphan").collect()), key=str)
    want = [("run1", "train", 1, "failed", "a b", False), ("run1", "train", 1, "passed", "a b", False), ("run1", "train", 2, None, None, True), ("run2", "eval", 3, None, None, True)]
    assert rows(d) == want
    # A pattern goes through Spark's reader.
    assert rows(files.read_attempts(spark, str(tmp_path / "[rx]*"))) == want
