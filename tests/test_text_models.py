"""Text models read by lines: records that splits part, ends of files, comments; and written by many tasks."""

import glob
from collections import Counter

import pytest

from capturelake.sources import files


def plain(text):
    """(head, points line or None) of each record, by plain code over the whole text."""
    lines, at, out = text.split("\n"), 0, []
    while at < len(lines):
        head = lines[at].strip()
        at += 1
        if head.startswith("no"):
            out.append((head, None))
        elif head and not head.startswith("#"):
            out.append((head, lines[at] if at < len(lines) else None))
            at += 1
    return out


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
@pytest.mark.parametrize("end", ["", "\n", "\n1.5 2 3"])
def test_image_records_across_splits(spark, tmp_path, split, end):
    lines = ["# first", ""]
    for k in range(60):
        lines += [f"{k} 1 0 0 0 0.5 0 0 {k % 4} f{k}.jpg", "" if k % 5 == 0 else "# odd" if k % 7 == 0 else " ".join(f"{k}.5 {j} {j - 1}" for j in range(k % 9 + 1))]
        if k % 11 == 0:
            lines += ["no header"] * (k % 3 + 1)
        if k % 6 == 0:
            lines += ["", "# between", " "][: k % 4]
    text = "\n".join([*lines, "99 1 0 0 0 0.5 0 0 1 last.jpg"]) + end
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "images.txt").write_text(text)
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "images.txt").write_text("7 1 0 0 0 0.5 0 0 1 n.jpg" + end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        d = files.read_sparse_images(spark, f"{tmp_path}/*")
        got = Counter((r.model_id, r.name, r.violation, None if r.points is None else str([tuple(p) for p in r.points])) for r in d.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = Counter()
    for model, whole in (("m", text), ("n", "7 1 0 0 0 0.5 0 0 1 n.jpg" + end)):
        for head, seen in plain(whole):
            name, bad, points = (None, "malformed", None) if head.startswith("no") else (head.split()[9], None, None)
            if name:
                p = (seen or "").split()
                try:
                    bad, points = ("missing_points_line", None) if seen is None else (None, str([(float(p[i]), float(p[i + 1]), int(p[i + 2])) for i in range(0, len(p), 3)]))
                except ValueError:
                    bad = "malformed"
            want[model, name, bad, points] += 1
    assert got == want


def test_a_model_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 4).selectExpr("0 as model_id", "id as image_id", "array(1d, 0d, 0d, 0d) as q", "array(0d, 0d, 0d) as t", "1 as camera_id", "concat('f', id, '.png') as name", "array(named_struct('x', 1d, 'y', 2d, 'point_id', id)) as points")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_sparse_images(rows, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{tmp_path}/out/model_id=0/part-*")) > 1
    d = files.read_sparse_images(spark, f"{tmp_path}/out/*")
    assert d.where("violation IS NULL AND points[0].point_id = image_id").count() == 4000
