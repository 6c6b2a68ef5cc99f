"""Views that give the driver's tables the shapes of capture data.

Each view is SQL over tables and other views. The same text serves Spark and DuckDB; four macros differ and are
put in as text: ``J(k)`` (an integer of the JSON column props), ``E(n)`` (the nth component of embedding),
``SEC(ts)`` (seconds since the epoch) and ``EXPL`` (embeddings, one row per component).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

VIEWS = {
    "b_frames": """
SELECT user_id AS video_id, event_id AS frame_id, SEC(ts) - MIN(SEC(ts)) OVER (PARTITION BY user_id) AS timestamp_sec,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index, value AS sharpness, J(k) / CAST(200 AS DOUBLE) AS overexposed_ratio,
  ((J(k) * 7) % 100) / CAST(200 AS DOUBLE) AS underexposed_ratio, ((J(k) * 13) % 100) / CAST(100 AS DOUBLE) AS motion_score, J(k) % 17 AS duplicate_score, event_type AS upstream_reason FROM {events}""",
    "b_gaussians": """
SELECT label AS scene_id, vec_id AS vertex_id, E(1) AS x, E(2) AS y, E(3) AS z, E(4) AS f_dc_0, E(5) AS f_dc_1, E(6) AS f_dc_2, E(7) * 20 AS opacity, E(8) * 10 AS scale_0, E(9) * 10 AS scale_1, E(10) * 10 AS scale_2,
  CASE WHEN vec_id % 2 = 0 THEN E(11) / n ELSE E(11) END AS rot_0, CASE WHEN vec_id % 2 = 0 THEN E(12) / n ELSE E(12) END AS rot_1, CASE WHEN vec_id % 2 = 0 THEN E(13) / n ELSE E(13) END AS rot_2, CASE WHEN vec_id % 2 = 0 THEN E(14) / n ELSE E(14) END AS rot_3
FROM (SELECT *, SQRT(E(11) * E(11) + E(12) * E(12) + E(13) * E(13) + E(14) * E(14)) AS n FROM {embeddings}) s""",
    "b_clouds": "SELECT scene_id, vertex_id, x, y, z, CASE WHEN vertex_id % 2 = 0 THEN 'laser' ELSE 'model' END AS cloud FROM {b_gaussians}",
    "b_observations": """
SELECT l_orderkey AS image_id, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS idx, l_linenumber, CAST(l_quantity AS DOUBLE) AS x, CAST(l_discount AS DOUBLE) * 500 AS y,
  CASE WHEN l_returnflag = 'N' THEN -1 ELSE l_partkey END AS point_id FROM {lineitem}""",
    "b_tracks": "SELECT point_id, image_id, idx FROM {b_observations} WHERE point_id <> -1 AND l_linenumber <> 3",
    "b_images": "SELECT o_orderkey AS image_id, o_custkey AS camera_id FROM {orders}",
    "b_cameras": "SELECT c_custkey AS camera_id, CASE c_custkey % 4 WHEN 0 THEN 'PINHOLE' WHEN 1 THEN 'SIMPLE_PINHOLE' WHEN 2 THEN 'SIMPLE_RADIAL' ELSE 'OPENCV' END AS model, 640 + c_nationkey AS width, 480 + c_nationkey AS height, CAST(c_acctbal AS DOUBLE) AS p0, CAST(320 AS DOUBLE) + c_nationkey % 3 AS p1, CAST(240 AS DOUBLE) + c_nationkey % 2 AS p2, c_nationkey / CAST(100 AS DOUBLE) AS p3 FROM {customer}",
    "b_points": "SELECT p_partkey AS point_id, CAST(p_retailprice AS DOUBLE) AS error FROM {part}",
    "b_components": "SELECT DISTINCT l_suppkey AS component, l_partkey AS name FROM {lineitem}",
    "b_exposure": "SELECT user_id % 20 AS run_id, ROW_NUMBER() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS iteration, event_type AS camera FROM {events}",
    "b_progress": "SELECT user_id AS run_id, event_id AS seq, (J(k) * 7 + event_id) % 500 AS iteration, 400 AS total, ts FROM {events}",
    "b_attempts": """
SELECT user_id AS run_id, event_type AS stage, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS attempt,
  CASE WHEN value < 20 THEN 'failed' WHEN value < 40 THEN 'blocked' ELSE 'passed' END AS status, ts FROM {events}""",
    "b_keys": "SELECT o_orderkey AS k, 'expected' AS side FROM {orders} UNION ALL SELECT DISTINCT l_orderkey, 'actual' FROM {lineitem} WHERE l_linestatus = 'O'",
    "b_elements": "SELECT * FROM EXPL q",
    "b_pairs": """
SELECT /*+ MERGE(b) */ a.label AS run_id, a.vec_id AS ordinal, a.i AS px, least(greatest(a.e + 0.5, 0), 1) AS left_v, least(greatest(b.e + 0.5, 0), 1) AS right_v
FROM {b_elements} a JOIN {b_elements} b ON b.vec_id = a.vec_id + 1 AND b.i = a.i""",
    "b_depth_pixels": """
SELECT /*+ MERGE(b) */ a.label AS frame_id, a.vec_id * 64 + a.i AS pixel_id, 1 + a.e AS v, 1 / (2 * (1 + a.e) + 0.1 * b.e + 0.5) AS d_ref
FROM {b_elements} a JOIN {b_elements} b ON b.vec_id = a.vec_id AND b.i = a.i % 64 + 1""",
    "b_markers": """
SELECT user_id AS run_id, event_id AS seq, CASE event_id % 6 WHEN 0 THEN CONCAT('POSE_TELEMETRY ', body) WHEN 1 THEN CONCAT('POSE_TELEMETRY ', body, ' [05/03 10:11:12]') WHEN 2 THEN CONCAT('POSE_TELEMETRY ', body, ' trailing')
  WHEN 3 THEN 'POSE_TELEMETRY {{"inlier_ratio": NaN}}' WHEN 4 THEN 'POSE_TELEMETRY [1]' ELSE CONCAT('VDA_TELEMETRY {{"result":"', CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'aligned' END, '","correlation":', CAST(J(k) AS STRING), 'e-2}}') END AS line
FROM (SELECT *, CONCAT('{{"frame":"f', CAST(event_id % 50 AS STRING), '","accepted":', CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END, ',"inlier_ratio":', CAST(J(k) AS STRING), 'e-2}}') AS body FROM {events}) z""",
    "b_poses": "SELECT label AS scene_id, vec_id AS ord, E(11) AS qw, E(12) AS qx, E(13) AS qy, E(14) AS qz, E(15) AS tx, E(16) AS ty, E(17) AS tz FROM {embeddings}",
    "b_losses": "SELECT user_id % 20 AS run_id, event_id AS seq, CASE WHEN user_id % 20 < 10 AND event_id % 3 = 0 THEN 'telemetry' ELSE 'text' END AS kind, CAST(value AS DOUBLE) / 4 AS total FROM {events}",
    "b_segments": "SELECT user_id AS video_id, event_type AS segment_id, event_id AS frame_id, SEC(ts) - MIN(SEC(ts)) OVER (PARTITION BY user_id) AS timestamp_sec, J(k) < 70 AS selected, J(k) < 10 AS bridge FROM {events}",
    "b_matches": "SELECT label AS frame_id, vec_id AS match_id, E(18) + 0.5 AS u, E(19) + 0.5 AS v, E(20) * 10 AS residual, E(21) + 0.3 AS depth FROM {embeddings}",
}


def render(sql: str, duckdb: bool) -> str:
    """Put the engine's text of the macros in."""
    sql = re.sub(r"\bJ\((\w+)\)", r"CAST(json_extract_string(props, '$.\1') AS INT)" if duckdb else r"CAST(get_json_object(props, '$.\1') AS INT)", sql)
    sql = re.sub(r"\bE\((\d+)\)", lambda m: f"CAST(embedding[{int(m[1]) - (not duckdb)}] AS DOUBLE)", sql)
    sql = re.sub(r"\bSEC\((\w+)\)", r"(epoch_us(\1) / 1e6)" if duckdb else r"(unix_micros(CAST(\1 AS TIMESTAMP)) / 1e6D)", sql)
    each = "(SELECT vec_id, label, unnest(generate_series(1, 64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS e FROM {embeddings})" if duckdb else "(SELECT vec_id, label, i + 1 AS i, CAST(e AS DOUBLE) AS e FROM {embeddings} LATERAL VIEW posexplode(embedding) p AS i, e)"
    return sql.replace("EXPL", each)


def _needs(sql: str, duckdb: bool = False) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", render(sql, duckdb))))


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table by its own name."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = render(VIEWS[name], False)
    return spark.sql(sql, **{n: bind(spark, sf_dir, n) for n in _needs(VIEWS[name])})


def duckdb_with(sql: str) -> str:
    """The SQL with all views that it reads as common table expressions."""
    order: list[str] = []

    def visit(text: str) -> None:
        for n in VIEWS:
            if re.search(rf"\b{n}\b", text) and n not in order:
                visit(VIEWS[n])
                order.append(n)

    visit(sql)
    if not order:
        return sql
    parts = []
    for n in order:
        text = re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", render(VIEWS[n], True)).replace("{{", "{").replace("}}", "}")
        parts.append(f"{n} AS ({text})")
    sql, word = sql.strip(), "WITH "
    if sql.upper().startswith("WITH RECURSIVE "):
        word = "WITH RECURSIVE "
    return f"{word}{', '.join(parts)}{', ' + sql[len(word):] if sql[:5].upper() == 'WITH ' else ' ' + sql}"
