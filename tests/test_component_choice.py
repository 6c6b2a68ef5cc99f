"""Containment of name sets against plain sets, and the choice of a component with all kinds of invalid ones."""

import random

from pyspark.sql import functions as F

from capturelake.operators import sparse

MEMBERS = "capture_id string, component string, name string"


def test_contained_sets_against_plain_sets(spark):
    rng = random.Random(4)
    sets = {("k" if i % 3 else None, f"c{i}"): frozenset(rng.sample("abcdefgh", rng.randint(1, 6))) for i in range(120)}
    rows = [(k, c, n) for (k, c), names in sets.items() for n in names for _ in range(rng.randint(1, 2))]
    members = spark.createDataFrame([r for r in rows if r[0]], MEMBERS).repartition(5)
    s = sparse.name_sets(members, ["capture_id"])
    same = {r.component: r.same for r in s.collect()}
    known = {c: names for (k, c), names in sets.items() if k}
    assert same == {c: min(o for o in known if known[o] == known[c]) for c in known}
    got = {(r.left, r.right) for r in sparse.contained_sets(members, s, ["capture_id"]).collect()}
    reps = sorted(set(same.values()))
    assert got == {(a, b) for a in reps for b in reps if known[a] < known[b]}


def test_a_name_that_all_components_have(spark):
    """20,000 components share a name; only sets without any other one meet them, and nothing grows with their square."""
    members = spark.range(20_000).select(F.lit("k").alias("capture_id"), F.concat(F.lit("c"), "id").alias("component"), F.explode(F.array(F.lit("hot"), F.concat(F.lit("own"), "id"))).alias("name"))
    members = members.unionByName(spark.createDataFrame([("k", "z", "hot"), ("k", "y", "hot"), ("k", "x", "own7")], MEMBERS))
    pairs = sparse.contained_sets(members, sparse.name_sets(members, ["capture_id"]), ["capture_id"])
    by = {r.left: r["count"] for r in pairs.groupBy("left").count().collect()}
    assert by == {"y": 20_000, "x": 1}


def test_all_kinds_of_components(spark):
    names = [f"f{i}" for i in range(20)]
    positions = spark.createDataFrame([(k, n, i) for k in "abcdef" for i, n in enumerate(names)], "capture_id string, name string, position long")
    want, rows, comps = {}, [], []

    def put(capture, component, members, status, reasons=(), error=None):
        rows.extend((capture, component, n) for n in members)
        comps.append((capture, component, f"/{component}", error))
        want[capture, component] = (status, list(reasons))

    short, rank, part = "shorter_longest_contiguous_registered_segment", "lower_quality_ranked_component", "registered_name_set_strict_subset_of_other_component"
    put("a", "big", names[:10], "selected")
    put("a", "part", names[2:5], "dominated", [part])
    put("a", "far", names[12:16], "not_selected", [short])
    put("a", "twice", [*names[16:18], names[16]], "invalid", ["duplicate_registered_image_names"])
    put("a", "inner twice", [names[3], names[3]], "dominated", [part])
    put("a", "other", ["x", "y"], "invalid", ["no_registered_name_in_selected_frame_contract"])
    put("a", "none", [], "invalid", ["no_registered_image_names"])
    put("a", "bad", [], "invalid", ["registered_name_parse_error", "no_registered_image_names", "duplicate_registered_image_names"], "a Duplicate name")
    put("b", "n1", names[:5], "selected")
    put("b", "n2", names[10:15], "not_selected", [rank])
    put("c", "split", [*names[:3], *names[5:8]], "selected")
    put("d", "one", names[:6], "selected")
    put("d", "cross", names[4:9], "not_selected", [short])
    put("e", "double", [names[0], names[0]], "invalid", ["duplicate_registered_image_names"])
    put("f", "lost", ["q"], "invalid", ["no_registered_name_in_selected_frame_contract"])
    components = spark.createDataFrame(comps, "capture_id string, component string, path string, parse_error string")
    inventory, choice = sparse.choose_component(components, spark.createDataFrame([*rows, ("a", "big", None)], MEMBERS), positions)
    assert {(r.capture_id, r.component): (r.status, list(r.exclusion_reasons)) for r in inventory.collect()} == want
    got = {r.capture_id: (r.selected, r.confidence, r.ties, list(r.advisories), r.blocked) for r in choice.collect()}
    assert got == {
        "a": ("big", "high", 0, [], None), "b": ("n1", "low", 2, ["equal_quality_active_candidate_tie_resolved_by_stable_component_name_path"], None), "c": ("split", "low", 0, ["selected_component_has_equal_longest_registered_segments"], None),
        "d": ("one", "low", 0, ["non_subset_overlap_with:cross"], None), "e": (None, None, 0, [], "duplicate image name in /double"), "f": (None, None, 0, [], "no usable registered component"),
    }


def test_strict_subsets_are_those_of_all_relations(spark):
    """Sets of more names than are probed, with copies, parts and sets that lack one common name; no pair of other sets is counted."""
    rng = random.Random(9)
    big = [frozenset(rng.sample(range(60), rng.randint(20, 40))) for _ in range(12)]
    sets = [*big, *big[:3], *(frozenset(rng.sample(sorted(b), rng.randint(1, len(b)))) for b in big for _ in range(3)), *(b - {min(b)} | {99} for b in big)]
    members = spark.createDataFrame([(f"c{i:03}", n) for i, b in enumerate(sets) for n in b], "component string, name long")
    want = {r.component for r in sparse.component_relations(members).where("relation = 'strict_subset'").selectExpr("left AS component").collect()}
    want |= {r.component for r in sparse.component_relations(members).where("relation = 'strict_superset'").selectExpr("right AS component").collect()}
    got = sparse.strict_subsets(members)
    assert {r.left for r in got.collect()} == want == {f"c{i:03}" for i, b in enumerate(sets) if any(b < o for o in sets)}
    inventory = members.groupBy("component").agg(F.count("*").alias("registered"), F.count("*").alias("longest_run"), F.lit(1.0).alias("coverage"))
    chosen = [sorted(map(tuple, sparse.select_component(inventory, r).collect())) for r in (got, sparse.component_relations(members))]
    assert chosen[0] == chosen[1]


def test_pairs_are_dealt_before_they_are_counted(spark):
    """Partial sums by name held and spilled nearly all pairs: between the join by name and the counts there is only an exchange by pair."""
    members = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 2)], "component string, name long")
    d = sparse.component_relations(members)
    assert sorted((r.left, r.right, r.overlap_count, r.relation) for r in d.collect()) == [("a", "b", 1, "strict_superset"), ("a", "c", 1, "strict_superset")]
    plan = d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    at = next(i for i, line in enumerate(plan) if "REPARTITION_BY_COL" in line)
    assert "partial_count" in plan[at - 1] and not any("partial_count" in line for line in plan[at + 1 : at + 4])


def test_members_are_read_once(spark, tmp_path):
    """The inventory and the choice start from names that are written out, not from the members' own plan."""
    from pyspark.sql import functions as F

    from capturelake.operators import sparse

    seen = spark.sparkContext.accumulator(0)
    members = spark.createDataFrame([(1, c, n) for c, n in [(1, 1), (1, 2), (2, 1), (3, 7)]], "capture_id long, component long, name long")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    members = members.mapInArrow(count, members.schema)
    components = spark.createDataFrame([(1, c, f"p{c}", None) for c in (1, 2, 3)], "capture_id long, component long, path string, parse_error string")
    positions = spark.range(8).select(F.lit(1).cast("long").alias("capture_id"), F.col("id").alias("name"), F.col("id").alias("position"))
    inventory, selection = sparse.choose_component(components, members, positions)
    assert {r["component"]: r["status"] for r in inventory.collect()} == {1: "selected", 2: "dominated", 3: "not_selected"}
    assert selection.first()["selected"] == 1
    assert seen.value == 4
