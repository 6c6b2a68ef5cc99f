"""Relations of all pairs of components by blocks, against plain sets."""

import random

import pytest

from capturelake.operators import sparse
from capturelake.plans.queries import QUERIES


def relation(a, b):
    return "equal_registered_name_set" if a == b else "strict_subset" if a < b else "strict_superset" if a > b else "non_subset_overlap" if a & b else "disjoint"


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_relations_against_plain_sets(spark, monkeypatch, limit):
    """Blocks of three components that end within captures, rows that repeat, a common name, null keys and names; blocks sent to all or joined."""
    monkeypatch.setattr(sparse, "BLOCK", 3)
    monkeypatch.setattr(sparse, "PAIR_ROWS", 50)
    monkeypatch.setattr(sparse, "BROADCAST_COMPONENTS", limit)
    rng = random.Random(7)
    sets = {(k, f"c{i:02}"): frozenset(rng.sample(range(12), rng.randint(1, 5)) + [99] * (k == "a")) for k, n in (("a", 20), ("b", 17), ("c", 1)) for i in range(n)}
    rows = [(k, c, n) for (k, c), names in sets.items() for n in names for _ in range(rng.randint(1, 2))]
    members = spark.createDataFrame([*rows, (None, "c01", 1), (None, "c02", 1), ("a", None, 1)], "capture string, component string, name long").repartition(5)
    got = [(r.capture, r.left, r.right, r.left_size, r.right_size, r.overlap_count, r.relation) for r in sparse.pair_relations(members, ["capture"]).collect() if r.overlap_count]
    want = [(k, a, b, len(x), len(y), len(x & y), relation(x, y)) for (k, a), x in sets.items() for (o, b), y in sets.items() if k == o and a < b and x & y]
    assert sorted(got) == sorted(want)


def test_pairs_are_made_after_the_shuffle(spark, data_dir):
    """What is shuffled are names with lists of components: pairs are made and counted above the last exchange by a pair of blocks."""
    plan = QUERIES["component_relations"](spark, data_dir)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    at = next(i for i, line in enumerate(plan) if "REPARTITION_BY_NUM" in line)
    above = [line for line in plan[:at] if "Exchange" in line and "BroadcastExchange" not in line]
    assert not above and sum("Generate explode" in line for line in plan[:at]) >= 2


@pytest.mark.parametrize(("key", "limit"), [(["capture"], 0), (["capture"], 1_000_000), ([], 0), ([], 1_000_000)])
def test_every_pair_and_its_names(spark, monkeypatch, key, limit):
    """Disjoint pairs are listed, within a capture only, and each pair has the names that both have; with one capture of many blocks and small ones in one."""
    monkeypatch.setattr(sparse, "BLOCK", 4)
    monkeypatch.setattr(sparse, "BROADCAST_COMPONENTS", limit)
    rng = random.Random(3)
    sets = {(k, f"{k}{i:02}"): frozenset(rng.sample(range(30), rng.randint(1, 4))) for k, n in (("a", 21), ("b", 2), ("c", 1), ("d", 3)) for i in range(n)}
    sets["a", "a90"], sets["a", "a91"] = frozenset([77]), frozenset(range(30))
    rows = [(k, c, n) for (k, c), names in sets.items() for n in names]
    members = spark.createDataFrame(rows, "capture string, component string, name long").repartition(3)
    d = sparse.pair_relations(members, key)
    got = [(*[r[f] for f in key], r.left, r.right, r.left_size, r.right_size, r.overlap_count, list(r.overlap_names), r.relation) for r in d.collect()]
    want = [(*([k] if key else []), a, b, len(x), len(y), len(x & y), sorted(x & y), relation(x, y)) for (k, a), x in sets.items() for (o, b), y in sets.items() if (k == o or not key) and a < b]
    assert sorted(got) == sorted(want) and {"disjoint", "strict_subset"} <= {w[-1] for w in want}


def test_query_lists_disjoint_pairs(spark, tmp_path):
    """The query against its SQL, on components of which most share no name."""
    import duckdb
    from pyspark.sql import functions as F

    from capturelake.plans.queries import ORACLES

    lines = spark.range(900).select((F.col("id") % 90).alias("l_suppkey"), (F.col("id") % 90 * 7 + F.xxhash64("id") % 9).alias("l_partkey"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    d = QUERIES["component_relations"](spark, str(tmp_path))
    got, want = sorted(map(tuple, d.collect())), sorted(con.sql(f"select {', '.join(d.columns)} from ({ORACLES['component_relations']})").fetchall())
    assert got == want and len(got) == 90 * 89 // 2 and sum(r[3] == "disjoint" for r in got) > 3000
