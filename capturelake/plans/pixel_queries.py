"""Queries of kernels on grids: masks, normals and motion on the 8 x 8 maps of the driver's vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import depth, images
from .queries import query

#: One row a pixel: depth, image and predicted depth of map vec_id at row r and column c.
PIXELS = "p AS (SELECT a.vec_id, (a.i - 1) // 8 AS r, (a.i - 1) % 8 AS c, 1 + a.e AS d, 0.5 + g.e AS g, 1 + a.e + 0.1 * n.e AS q FROM b_elements a JOIN b_elements g ON g.vec_id = a.vec_id AND g.i = 65 - a.i JOIN b_elements n ON n.vec_id = a.vec_id AND n.i = a.i % 64 + 1)"
_EDGE = "coalesce(abs(lead({0}) OVER row_ - {0}), 0) + coalesce(abs(lead({0}) OVER col_ - {0}), 0)"
_AROUND = "coalesce(lag({0}) OVER row_, true) AND coalesce(lead({0}) OVER row_, true) AND coalesce(lag({0}) OVER col_, true) AND coalesce(lead({0}) OVER col_, true)"
_WINDOWS = "WINDOW row_ AS (PARTITION BY vec_id, r ORDER BY c), col_ AS (PARTITION BY vec_id, c ORDER BY r)"
MASKED = f"{PIXELS}, x AS (SELECT *, {_EDGE.format('d')} AS de, {_EDGE.format('g')} AS ge FROM p {_WINDOWS}), t AS (SELECT vec_id, quantile_cont(de, 0.9) AS dt, quantile_cont(ge, 0.95) AS gt FROM x WHERE d > 0 GROUP BY 1), m0 AS (SELECT x.*, d > 0 AND de <= dt AND ge <= gt AS k0 FROM x JOIN t USING (vec_id)), m1 AS (SELECT *, k0 AND {_AROUND.format('k0')} AS keep FROM m0 {_WINDOWS})"


def _maps(embeddings):
    v = F.transform("embedding", lambda x: x.cast("double"))
    d = embeddings.select(F.col("vec_id").alias("frame_id"), v.alias("v"), F.lit(8).alias("height"), F.lit(8).alias("width"))
    places = F.sequence(F.lit(0), F.lit(63))
    d = d.withColumn("reference", F.transform("v", lambda x: 1 + x)).withColumn("gray", F.transform(F.reverse("v"), lambda x: 0.5 + x))
    return d.withColumn("predicted", F.transform(places, lambda i: 1 + F.get("v", i) + 0.1 * F.get("v", (i + 1) % 64))).drop("v")


@query(f"WITH {MASKED} SELECT vec_id AS frame_id, r * 8 + c AS pixel, keep FROM m1")
def depth_quality_masks(embeddings):
    d = depth.depth_quality_masks(_maps(embeddings).withColumnRenamed("reference", "depth"), erosion=1)
    return d.select("frame_id", F.posexplode("mask").alias("pixel", "keep")).withColumn("pixel", F.col("pixel").cast("long"))


@query(f"WITH {PIXELS} SELECT vec_id AS frame_id, r * 8 + c AS pixel, coalesce(abs(lag(g) OVER row_ - g), 0) + coalesce(abs(lead(g) OVER row_ - g), 0) + coalesce(abs(lag(g) OVER col_ - g), 0) + coalesce(abs(lead(g) OVER col_ - g), 0) > 0.3 AS textured FROM p {_WINDOWS}")
def texture_masks(embeddings):
    d = depth.texture_masks(_maps(embeddings), 0.3)
    return d.select("frame_id", F.posexplode("mask").alias("pixel", "textured")).withColumn("pixel", F.col("pixel").cast("long"))


def _normal(z: str) -> str:
    """SQL of the unit normal of depth column ``z`` as n{z}x, n{z}y, n{z}z, by steps of named columns."""
    at = {"e": (f"lead({z}) OVER row_", "(c + 1)", "r"), "w": (f"lag({z}) OVER row_", "(c - 1)", "r"), "s": (f"lead({z}) OVER col_", "c", "(r + 1)"), "n": (f"lag({z}) OVER col_", "c", "(r - 1)")}
    return ", ".join(f"({col} - 3.5) / 10 * {v} AS {z}{k}x, ({row} - 3.25) / 12 * {v} AS {z}{k}y, {v} AS {z}{k}z" for k, (v, col, row) in at.items())


def _cross(z: str) -> str:
    a = lambda k: f"({z}e{k} - {z}w{k}) / 2"
    b = lambda k: f"({z}s{k} - {z}n{k}) / 2"
    return ", ".join(f"{a(i)} * ({b(j)}) - {a(j)} * ({b(i)}) AS {z}{k}" for k, i, j in (("u", "y", "z"), ("v", "z", "x"), ("w", "x", "y")))


@query(f"""WITH {MASKED}, o AS (SELECT *, {_normal('d')}, {_normal('q')} FROM m1 {_WINDOWS}), k AS (SELECT *, {_cross('d')}, {_cross('q')} FROM o WHERE r BETWEEN 1 AND 6 AND c BETWEEN 1 AND 6),
l AS (SELECT vec_id, keep, greatest(least((du * qu + dv * qv + dw * qw) / (greatest(sqrt(du * du + dv * dv + dw * dw), 1e-8) * greatest(sqrt(qu * qu + qv * qv + qw * qw), 1e-8)), 1), -1) AS cosine FROM k)
SELECT vec_id AS frame_id, count_if(keep) AS pixels, CASE WHEN count_if(keep) >= 15 THEN round(avg(CASE WHEN keep THEN 1 - cosine END), 6) END AS normal_inconsistency FROM l GROUP BY 1""")
def normal_consistency(embeddings):
    camera = {"fx": F.lit(10.0), "fy": F.lit(12.0), "cx": F.lit(3.5), "cy": F.lit(3.25)}
    d = depth.normal_consistency(_maps(embeddings).withColumns(camera), least=15, erosion=1)
    return d.withColumn("normal_inconsistency", F.round("normal_inconsistency", 6))


@query("WITH v AS (SELECT label, vec_id, i, CAST(least(greatest(round(255 * (e + 0.5)), 0), 255) AS INT) AS g FROM b_elements), n AS (SELECT DISTINCT label, vec_id FROM v), b AS (SELECT *, lag(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS before FROM n) SELECT b.label AS video_id, b.vec_id AS frame_index, round(avg(abs(x.g - y.g)) / 255, 9) AS motion_score FROM b LEFT JOIN v x ON x.vec_id = b.vec_id AND b.before IS NOT NULL LEFT JOIN v y ON y.vec_id = b.before AND y.i = x.i GROUP BY 1, 2")
def frame_motion(embeddings):
    byte = lambda x: F.lpad(F.hex(F.least(F.greatest(F.round(255 * (x.cast("double") + 0.5)), F.lit(0.0)), F.lit(255.0)).cast("int")), 2, "0")
    data = F.unhex(F.array_join(F.transform("embedding", byte), ""))
    d = embeddings.select(F.col("label").alias("video_id"), F.col("vec_id").alias("frame_index"), F.lit(8).alias("height"), F.lit(8).alias("width"), data.alias("data"))
    return images.frame_motion(d).withColumn("motion_score", F.round("motion_score", 9))


_BYTES = "v AS (SELECT vec_id % 3 AS run, vec_id // 3 AS ordinal, i, CAST(least(greatest(round(255 * (e + 0.5)), 0), 255) AS INT) AS g FROM b_elements WHERE vec_id % 60 <> 4)"


@query(f"WITH {_BYTES}, o AS (SELECT DISTINCT ordinal FROM v), d AS (SELECT x.ordinal, y.run, avg(abs(x.g - y.g)) AS mad, avg((x.g - y.g) * (x.g - y.g)) AS mse FROM v x JOIN v y ON x.ordinal = y.ordinal AND x.i = y.i AND x.run = 0 AND y.run > 0 GROUP BY 1, 2), r AS (SELECT DISTINCT run, ordinal FROM v) SELECT o.ordinal, round(CASE WHEN b.mse > 0 THEN 10 * log10(65025 / b.mse) END, 6) AS baseline_psnr, round(b.mad, 9) AS baseline_delta, round(CASE WHEN c.mse > 0 THEN 10 * log10(65025 / c.mse) END, 6) AS comparison_psnr, round(c.mad, 9) AS comparison_delta, concat_ws(',', CASE WHEN r0.run IS NULL THEN 'current_missing' END, CASE WHEN r1.run IS NULL THEN 'baseline_missing' END, CASE WHEN r2.run IS NULL THEN 'comparison_missing' END) AS violations FROM o LEFT JOIN d b ON b.ordinal = o.ordinal AND b.run = 1 LEFT JOIN d c ON c.ordinal = o.ordinal AND c.run = 2 LEFT JOIN r r0 ON r0.ordinal = o.ordinal AND r0.run = 0 LEFT JOIN r r1 ON r1.ordinal = o.ordinal AND r1.run = 1 LEFT JOIN r r2 ON r2.ordinal = o.ordinal AND r2.run = 2")
def compare_renders(embeddings):
    byte = lambda x: F.lpad(F.hex(F.least(F.greatest(F.round(255 * (x.cast("double") + 0.5)), F.lit(0.0)), F.lit(255.0)).cast("int")), 2, "0")
    data = F.unhex(F.array_join(F.transform("embedding", byte), ""))
    d = embeddings.where("vec_id % 60 <> 4").select((F.col("vec_id") % 3).alias("run_id"), F.floor(F.col("vec_id") / 3).alias("ordinal"), F.lit("s").alias("sha256"), F.lit(8).alias("height"), F.lit(8).alias("width"), data.alias("data"))
    out = images.compare_renders(d, 0, 1, 2)
    return out.select("ordinal", F.round("baseline_psnr_db", 6).alias("baseline_psnr"), F.round("baseline_mean_abs_pixel_delta", 9).alias("baseline_delta"), F.round("comparison_psnr_db", 6).alias("comparison_psnr"), F.round("comparison_mean_abs_pixel_delta", 9).alias("comparison_delta"), F.array_join("violations", ",").alias("violations"))
