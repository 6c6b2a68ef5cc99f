"""Queries against their SQL where keys are larger than those of the small tables, and where scores tie."""

import duckdb
from pyspark.sql import Window
from pyspark.sql import functions as F

from capturelake.operators import sparse
from capturelake.plans.queries import ORACLES, QUERIES


def compared(spark, tmp_path, name, table, rows):
    rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    d = QUERIES[name](spark, str(tmp_path))
    want = con.sql(f"select {', '.join(d.columns)} from ({ORACLES[name]})").fetchall()
    return sorted(map(str, map(tuple, d.collect()))), sorted(map(str, want))


def test_converted_view_name_of_many_cameras(spark, tmp_path):
    rows = spark.createDataFrame([(1, 7), (2, 9_999), (3, 10_000), (4, 1_234_567)], "o_orderkey long, o_custkey long")
    got, want = compared(spark, tmp_path, "converted_view_name", "orders", rows)
    assert got == want and "(4, '1234567_f.4.png')" in got


def test_ranks_of_equal_scores_go_by_name(spark, tmp_path):
    """15 images with error 0 score as 16 without an error; whatever the number of points, the smaller name comes first."""
    rows = [("c", k, 15 if k % 2 else 16, k // 2, 0.0 if k % 2 else None) for k in range(2000)]
    d = sparse.rank_model_candidates(spark.createDataFrame(rows, "capture_id string, model_name long, registered_image_count long, triangulated_point_count long, reprojection_error_px double"))
    assert d.groupBy("triangulated_point_count").agg(F.count_distinct("score").alias("n")).where("n > 1").count() == 0
    pairs = d.withColumn("following", F.lead("model_name").over(Window.orderBy("rank"))).where("model_name % 2 = 0")
    assert pairs.where("following = model_name + 1").count() == 1000


def test_stage_frame_name_of_many_frames(spark, tmp_path):
    rows = spark.createDataFrame([(1, "1-HIGH"), (999_999, "2"), (1_000_000, "2"), (123_456_789, "2")], "o_orderkey long, o_orderpriority string")
    got, want = compared(spark, tmp_path, "stage_frame_name", "orders", rows)
    assert got == want and "(123456789, 'frame_123456789.png', True)" in got
