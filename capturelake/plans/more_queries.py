"""Queries of single operators over the driver's tables: telemetry summaries, gates, names, crops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.staging import staged
from ..functions import markers
from ..operators import frames, gates, images, sparse, telemetry, trajectory
from ..streaming import monitor
from .queries import ROT, query


@query("SELECT user_id AS run_id, count(*) AS record_count, bool_and(event_id % 10 <> 0) AS all_scales_finite FROM events GROUP BY 1")
def conversion_telemetry_summary(events):
    n = F.col("event_id").cast("string")
    finite = F.when(F.col("event_id") % 10 == 0, (F.col("event_id") + 1).cast("string")).otherwise(n)
    line = F.concat(F.lit('CONVERSION_TELEMETRY {"point_count":'), n, F.lit(',"finite_scale_count":'), finite, F.lit("}"))
    return telemetry.conversion_summary(events.select(F.col("user_id").alias("run_id"), line.alias("line")))


def _loss_lines(events):
    total = F.col("event_id") % 1000 / 8.0
    line = F.concat(F.lit('LOSS_TELEMETRY {"total":'), F.when(F.col("event_type") == "error", "null").otherwise(total.cast("string")), F.lit(',"finite":'), F.when(F.col("event_type") == "error", "false").otherwise("true"), F.lit("}"))
    return events.select(F.col("user_id").alias("run_id"), line.alias("line"))


LOSSES = "SELECT user_id AS run_id, bool_or(event_type = 'error') AS has_nonfinite, count(*) AS record_count, max(CASE WHEN event_type <> 'error' THEN (event_id % 1000) / 8.0 END) AS max_total, min(CASE WHEN event_type <> 'error' THEN (event_id % 1000) / 8.0 END) AS min_total FROM events GROUP BY 1"


@query(LOSSES)
def loss_telemetry_summary(events):
    return telemetry.loss_summary(_loss_lines(events))


@query(f"SELECT run_id, CASE WHEN has_nonfinite THEN 'nonfinite_loss' ELSE '' END AS reasons, NOT has_nonfinite AS passed FROM ({LOSSES})")
def loss_gate(events):
    return gates.loss_gate(telemetry.loss_summary(_loss_lines(events))).select("run_id", F.array_join("reasons", ",").alias("reasons"), "passed")


@query("WITH r AS (SELECT o_custkey AS pair_id, o_orderkey % 2 = 0 AS left_side, count(*) AS vertices, max(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS anchors, count_if(o_orderstatus = 'F') AS losses FROM orders GROUP BY 1, 2), a AS (SELECT * FROM r WHERE left_side), b AS (SELECT * FROM r WHERE NOT left_side) SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, a.vertices AS vertices_a, b.vertices AS vertices_b, a.vertices IS NOT DISTINCT FROM b.vertices AS vertices_equal, a.anchors IS NOT NULL AND b.anchors IS NOT NULL AS anchors_available, coalesce(a.losses, 0) > 0 AND coalesce(b.losses, 0) > 0 AS loss_points_found FROM a FULL JOIN b ON a.pair_id = b.pair_id")
def compare_training_evidence(orders):
    r = orders.groupBy(F.col("o_custkey").alias("pair_id"), F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("b").alias("side")).agg(F.count("*").alias("vertices"), F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))).alias("anchors"), F.count_if(F.col("o_orderstatus") == "F").alias("loss_points"))
    return telemetry.compare_training_evidence(r)


@query("WITH c AS (SELECT c_custkey AS run_id, c_custkey % 40 + 1 AS n FROM customer), k AS (SELECT run_id, n, least(6, n) AS m FROM c), i AS (SELECT run_id, n, m, unnest(generate_series(0, m - 1)) AS i FROM k), x AS (SELECT DISTINCT run_id, CAST(round_even(i * (n - 1) / greatest(m - 1, 1), 0) AS INT) AS view FROM i UNION SELECT run_id, 3 FROM c WHERE n > 3) SELECT run_id, string_agg(CAST(view AS VARCHAR), ',' ORDER BY view) AS views FROM x GROUP BY 1")
def spread_indices(customer):
    d = customer.select(F.col("c_custkey").alias("run_id"), images.spread_indices((F.col("c_custkey") % 40 + 1).cast("int"), 6, (3,)).alias("v"))
    return d.select("run_id", F.array_join(F.transform("v", lambda x: x.cast("string")), ",").alias("views"))


@query("SELECT event_id AS seq, event_id % 50 AS iteration, event_type AS kind FROM events WHERE event_id % 50 > 0 AND event_id % 3 <> 0")
def parse_shape_marker(events):
    number = F.when(F.col("event_id") % 3 == 0, "x1").otherwise((F.col("event_id") % 50).cast("string"))
    lines = events.select(F.col("event_id").alias("seq"), F.concat(F.lit("SHAPE iteration="), number, F.lit(" kind="), F.col("event_type"), F.lit(" plain loss=0.5")).alias("line"))
    return markers.parse_shape_marker(lines, "SHAPE").select("seq", "iteration", F.col("fields")["kind"].alias("kind"))


@query("WITH c AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey % 5 - 1 AS x0, l_suppkey % 4 AS y0, l_quantity * 20 AS w, 480 - l_linenumber * 40 AS h FROM lineitem) SELECT id, n, concat_ws(',', CASE WHEN x0 < 0 THEN 'origin' END, CASE WHEN x0 + w > 640 OR y0 + h > 480 THEN 'outside' END) AS violations, CASE WHEN x0 >= 0 AND x0 + w <= 640 AND y0 + h <= 480 THEN 320.5 - x0 END AS cx, CASE WHEN x0 >= 0 AND x0 + w <= 640 AND y0 + h <= 480 THEN 240.25 - y0 END AS cy FROM c")
def crop_camera(lineitem):
    x0, y0, w, h = F.col("l_partkey") % 5 - 1, F.col("l_suppkey") % 4, F.col("l_quantity") * 20, 480 - F.col("l_linenumber") * 40
    c = X.cropped_camera({"fx": F.lit(500.0), "fy": F.lit(500.0), "cx": F.lit(320.5), "cy": F.lit(240.25)}, F.lit(640), F.lit(480), x0, y0, w, h)
    return lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.array_join(c["violations"], ",").alias("violations"), c["cx"].alias("cx"), c["cy"].alias("cy"))


@query("WITH e AS (SELECT run_id, camera, count(*) AS n FROM b_exposure GROUP BY 1, 2), r AS (SELECT run_id, count(*) AS cc, CAST(sum(n) AS BIGINT) AS it FROM e GROUP BY 1), x AS (SELECT r.*, it // cc AS lo, it % cc AS extra, count_if(e.n = it // cc) AS at_low, count_if(e.n = it // cc + 1) AS at_high FROM r JOIN e USING (run_id) GROUP BY ALL) SELECT run_id, concat_ws(',', CASE WHEN at_low <> cc - extra OR at_high <> extra THEN 'exposure_distribution' END, CASE WHEN run_id % 3 = 0 THEN 'anchor_schedule' END, CASE WHEN run_id % 4 = 0 THEN 'checkpoint' END, CASE WHEN run_id % 5 = 0 THEN 'structural' END) AS reasons, concat_ws(',', 'mean_psnr', CASE WHEN run_id % 2 = 0 THEN 'cross_gap' END) AS warnings FROM x")
def technical_gate(b_exposure):
    n = b_exposure.groupBy("run_id", "camera").agg(F.count("*").alias("exposures"))
    k = F.col("run_id")
    runs = n.groupBy("run_id").agg(F.count("*").alias("active_camera_count"), F.sum("exposures").alias("iterations")).withColumns({"anchor_observed": k % 3 != 0, "checkpoint_finite": k % 4 != 0, "structural_pass": k % 5 != 0, "cross_gap": k % 2 == 0, "mean_psnr": F.lit(18.0), "min_psnr": F.lit(16.0), "mean_ssim": F.lit(0.8), "min_ssim": F.lit(0.7)})
    d = gates.technical_gate(runs, n, gates.FORMAL_VISUAL)
    return d.select("run_id", F.array_join("reasons", ",").alias("reasons"), F.array_join("warnings", ",").alias("warnings"))


@query(f"""WITH {ROT}, a AS (SELECT *, ord % 7 NOT IN (2, 3) AND ord % 11 <> 5 AS ok FROM c),
k AS (SELECT *, sqrt(pow(cx - lag(cx) OVER w, 2) + pow(cy - lag(cy) OVER w, 2) + pow(cz - lag(cz) OVER w, 2)) AS step, row_number() OVER w AS n FROM a WHERE ok WINDOW w AS (PARTITION BY scene_id ORDER BY ord)),
h AS (SELECT *, list(step) OVER (PARTITION BY scene_id ORDER BY ord ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS l FROM k),
j AS (SELECT a.scene_id, a.ord, a.cx, a.cy, a.cz, last_value(h.n IGNORE NULLS) OVER w AS n, last_value(h.l IGNORE NULLS) OVER w AS l, last_value(h.cx IGNORE NULLS) OVER w AS px, last_value(h.cy IGNORE NULLS) OVER w AS py, last_value(h.cz IGNORE NULLS) OVER w AS pz FROM a LEFT JOIN h ON h.scene_id = a.scene_id AND h.ord = a.ord WINDOW w AS (PARTITION BY a.scene_id ORDER BY a.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT *, list_aggregate([v FOR v IN l IF v IS NOT NULL], 'median') AS mid FROM j)
SELECT scene_id, ord, coalesce(n, 0) AS accepted_before, round(CASE WHEN n >= 4 AND mid > 1e-12 THEN sqrt(pow(cx - px, 2) + pow(cy - py, 2) + pow(cz - pz, 2)) / mid END, 5) AS ratio FROM m""")
def accepted_step_ratio(b_poses):
    d = trajectory.quaternion_trajectory(b_poses).withColumn("accepted", ~(F.col("ord") % 7).isin(2, 3) & (F.col("ord") % 11 != 5))
    d = trajectory.accepted_step_ratios(d)
    return d.select("scene_id", "ord", F.col("accepted_before").cast("long").alias("accepted_before"), F.round("translation_step_ratio", 5).alias("ratio"))


@query("""WITH e AS (SELECT user_id AS run_id, event_id AS seq, SEC(ts) AS sec, event_type AS stage, CASE WHEN event_id % 9 <> 0 THEN J(k) END AS iteration, 80 AS total FROM events),
n AS (SELECT *, CASE WHEN lag(stage) OVER w IS NOT DISTINCT FROM stage AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY run_id ORDER BY sec, seq)),
p AS (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY sec, seq) AS part, coalesce(iteration BETWEEN 1 AND total, false) AS valid FROM n),
a AS (SELECT *, valid AND iteration > coalesce(max(CASE WHEN valid THEN iteration END) OVER (PARTITION BY run_id, part ORDER BY sec, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS accepted FROM p),
l AS (SELECT run_id, max(part) AS part, min(sec) AS run_started, max(sec) AS last_event, count_if(accepted) AS accepted, count_if(iteration IS NOT NULL AND NOT accepted) AS refused FROM a GROUP BY 1),
s AS (SELECT run_id, part, min(stage) AS stage, min(sec) AS stage_started, max(CASE WHEN accepted THEN iteration END) AS iteration FROM a GROUP BY ALL)
SELECT CAST(run_id AS VARCHAR) AS run_id, stage, iteration, CASE WHEN iteration IS NOT NULL THEN 80 END AS total, round(last_event - run_started, 3) AS elapsed_sec, round(last_event - stage_started, 3) AS stage_elapsed_sec, l.accepted, l.refused FROM l JOIN s USING (run_id, part)""".replace("SEC(ts)", "epoch_us(ts) / 1e6").replace("J(k)", "CAST(json_extract_string(props, '$.k') AS INT)"))
def current_runs(events):
    d = events.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("stage"), F.when(F.col("event_id") % 9 != 0, F.get_json_object("props", "$.k").cast("int")).alias("iteration"), F.lit(80).alias("total"))
    return monitor.current_runs(d).select("run_id", "stage", "iteration", "total", F.round("elapsed_sec", 3).alias("elapsed_sec"), F.round("stage_elapsed_sec", 3).alias("stage_elapsed_sec"), "accepted", "refused")


#: Components in groups of four: the parts of a supplier, those of even number, those of every fourth, and of every eighth; some are registered twice.
NESTED = """n AS (SELECT c.component + j.j AS component, c.name FROM b_components c, (SELECT unnest([0, 1, 2, 3]) AS j) j WHERE c.component % 4 = 0 AND c.name % (1 << j.j) = 0),
comp AS (SELECT DISTINCT c.component + j.j AS component, (c.component // 4) % 5 AS capture_id, CASE WHEN (c.component + j.j) % 13 = 0 THEN 'cannot be read' END AS parse_error FROM b_components c, (SELECT unnest([0, 1, 2, 3]) AS j) j WHERE c.component % 4 = 0),
m AS (SELECT comp.capture_id, n.component, n.name FROM n JOIN comp USING (component) UNION ALL SELECT comp.capture_id, n.component, n.name FROM n JOIN comp USING (component) WHERE n.component % 7 = 0 AND n.name % 40 = 0)"""
SETS = "u AS (SELECT DISTINCT capture_id, component, name FROM m), z AS (SELECT capture_id, component, count(*) AS size FROM u GROUP BY ALL), ov AS (SELECT a.capture_id, a.component AS l, b.component AS r, count(*) AS common FROM u a JOIN u b ON a.capture_id = b.capture_id AND a.name = b.name AND a.component <> b.component GROUP BY ALL), ovs AS (SELECT ov.*, a.size AS ls, b.size AS rs FROM ov JOIN z a ON a.component = l JOIN z b ON b.component = r)"


def _nested(b_components):
    c = F.col
    base = staged(b_components.where("component % 4 = 0"), "nested-components")
    fourfold = lambda d: d.withColumn("j", F.explode(F.array(*map(F.lit, range(4)))))
    capture = (F.floor(c("component") / 4) % 5).alias("capture_id")
    own = (c("component") + c("j")).alias("component")
    error = F.when(c("component") % 13 == 0, "cannot be read")
    components = fourfold(base.select("component").distinct()).select(capture, own).withColumns({"path": F.concat(F.lit("p"), c("component").cast("string")), "parse_error": error})
    rows = fourfold(base).where("name % shiftleft(1, j) = 0").select(capture, own, "name")
    return components, rows.unionByName(rows.where("component % 7 = 0 AND name % 40 = 0"))


@query(f"WITH {NESTED}, {SETS} SELECT DISTINCT capture_id, l AS component, r AS of FROM ovs WHERE common = ls AND rs > ls")
def contained_components(b_components):
    """Pairs of components, one within the other: pairs of different sets, and the components of each set."""
    _, members = _nested(b_components)
    sets = sparse.name_sets(members, ["capture_id"])
    pairs = sparse.contained_sets(members, sets, ["capture_id"]).select("capture_id", "left", "right")
    own = lambda side, name: sets.select("capture_id", F.col("same").alias(side), F.col("component").alias(name)).hint("merge")
    return pairs.join(own("left", "component"), ["capture_id", "left"]).join(own("right", "of"), ["capture_id", "right"]).select("capture_id", "component", "of")


CHOICE = f"""{NESTED}, {SETS}, pos AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS position FROM (SELECT p_partkey AS name FROM part WHERE p_partkey % 10 <> 3)), tot AS (SELECT count(*) AS selected FROM pos),
at_ AS (SELECT u.capture_id, u.component, p.position FROM u JOIN pos p USING (name)), isl AS (SELECT *, position - row_number() OVER (PARTITION BY component ORDER BY position) AS g FROM at_), runs AS (SELECT component, count(*) AS n FROM isl GROUP BY component, g), top AS (SELECT component, max(n) AS longest FROM runs GROUP BY 1), tops AS (SELECT component, any_value(longest) AS longest, count(*) > 1 AS tie FROM runs JOIN top USING (component) WHERE n = longest GROUP BY 1),
cnt AS (SELECT component, count(*) AS registered, count(DISTINCT name) AS names FROM m GROUP BY 1), fnd AS (SELECT component, count(*) AS found FROM at_ GROUP BY 1),
i AS (SELECT c.*, coalesce(cnt.registered, 0) AS registered, coalesce(names, 0) AS names, coalesce(longest, 0) AS longest_run, coalesce(tie, false) AS tie, coalesce(found, 0) / CAST(selected AS DOUBLE) AS coverage FROM comp c LEFT JOIN cnt USING (component) LEFT JOIN tops USING (component) LEFT JOIN fnd USING (component), tot),
v AS (SELECT *, registered > 0 AND names = registered AND longest_run > 0 AS valid FROM i), dom AS (SELECT DISTINCT l AS component FROM ovs JOIN v ON v.component = r AND v.valid WHERE common = ls AND rs > ls),
w AS (SELECT v.*, dom.component IS NOT NULL AS dominated, valid AND dom.component IS NULL AS active FROM v LEFT JOIN dom USING (component)),
k AS (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY active DESC, longest_run DESC, registered DESC, coverage DESC, component) AS rk FROM w), b AS (SELECT capture_id, component AS best, longest_run AS bl, registered AS br, coverage AS bc, tie AS bt FROM k WHERE rk = 1 AND active)"""


@query(f"WITH {CHOICE} SELECT capture_id, component, registered, longest_run, round(coverage, 9) AS coverage, CASE WHEN dominated THEN 'dominated' WHEN NOT valid THEN 'invalid' WHEN component = best THEN 'selected' ELSE 'not_selected' END AS status, CASE WHEN dominated THEN 'registered_name_set_strict_subset_of_other_component' WHEN NOT valid THEN concat_ws(',', CASE WHEN parse_error IS NOT NULL THEN 'registered_name_parse_error' END, CASE WHEN registered = 0 THEN 'no_registered_image_names' END, CASE WHEN names < registered THEN 'duplicate_registered_image_names' END, CASE WHEN registered > 0 AND names = registered AND longest_run = 0 THEN 'no_registered_name_in_selected_frame_contract' END) WHEN component = best THEN '' WHEN longest_run < bl THEN 'shorter_longest_contiguous_registered_segment' ELSE 'lower_quality_ranked_component' END AS reasons FROM w LEFT JOIN b USING (capture_id)")
def component_inventory_status(b_components, part):
    d, _ = _choice(b_components, part)
    return d.select("capture_id", "component", "registered", "longest_run", F.round("coverage", 9).alias("coverage"), "status", F.array_join("exclusion_reasons", ",").alias("reasons"))


@query(f"WITH {CHOICE}, ti AS (SELECT capture_id, count(*) AS n FROM w JOIN b USING (capture_id) WHERE active AND longest_run = bl AND registered = br AND coverage = bc GROUP BY 1), cr AS (SELECT b.capture_id, string_agg('non_subset_overlap_with:' || r, ',' ORDER BY CAST(r AS VARCHAR)) AS o FROM b JOIN ovs ON l = best JOIN w ON w.component = r AND (w.valid OR w.dominated) WHERE common < rs AND common < ls GROUP BY 1) SELECT b.capture_id, best AS selected, CASE WHEN n > 1 THEN n ELSE 0 END AS ties, concat_ws(',', CASE WHEN n > 1 THEN 'equal_quality_active_candidate_tie_resolved_by_stable_component_name_path' END, CASE WHEN bt THEN 'selected_component_has_equal_longest_registered_segments' END, o) AS advisories, CASE WHEN n > 1 OR bt OR o IS NOT NULL THEN 'low' ELSE 'high' END AS confidence, CAST(NULL AS VARCHAR) AS blocked FROM b JOIN ti USING (capture_id) LEFT JOIN cr USING (capture_id)")
def component_choice(b_components, part):
    _, s = _choice(b_components, part)
    return s.select("capture_id", "selected", "ties", F.array_join("advisories", ",").alias("advisories"), "confidence", "blocked")


def _choice(b_components, part):
    components, members = _nested(b_components)
    positions = frames.dense_positions(part.where("p_partkey % 10 <> 3").select(F.col("p_partkey").alias("name")), "name")
    every = positions.withColumn("capture_id", F.explode(F.array(*[F.lit(k).cast("long") for k in range(5)])))
    return sparse.choose_component(components, members, every)
