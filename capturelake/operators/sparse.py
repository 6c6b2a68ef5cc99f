"""Sparse models: reciprocity, cropping, comparison, evidence and component choice. Keys are ``model_id`` or the like."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.staging import dealt, staged
from .frames import contiguous_runs, longest_runs
from .quantiles import exact_percentiles, joined

#: A set that may hold another one is asked for so many of its rare names before all of them are counted.
PROBES = 8
#: Components are compared by blocks of at most so many, smaller ones where there would be fewer than so many blocks.
BLOCK, BLOCKS = 256, 16
#: Pairs of components that a task counts, each as often as it has a common name.
PAIR_ROWS = 1_000_000
#: Blocks of up to so many components are sent to all executors, some 40 bytes a component.
BROADCAST_COMPONENTS = 1_000_000


def track_violations(observations: DataFrame, tracks: DataFrame, points: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Tracks without their observation or with another point's, and observations without a point or a track.

    observations (image_id, idx, point_id; -1: none), tracks (point_id, image_id, idx), points (point_id).
    """
    at = [*key, "image_id", "idx"]
    seen = observations.select(*at, F.col("point_id").alias("seen_id"))
    t = tracks.join(seen, at, "left")
    bad_tracks = t.select(*at, "point_id", F.when(F.col("seen_id").isNull(), "track_without_observation").when(F.col("seen_id") != F.col("point_id"), "track_of_other_point").alias("violation")).where("violation IS NOT NULL")
    used = observations.where("point_id <> -1").select(*at, "point_id")
    no_point = used.join(points.select(*key, "point_id"), [*key, "point_id"], "left_anti").withColumn("violation", F.lit("observation_without_point"))
    no_track = used.join(tracks.select(*at, "point_id"), [*at, "point_id"], "left_anti").withColumn("violation", F.lit("observation_without_track"))
    return bad_tracks.unionByName(no_point.select(*bad_tracks.columns)).unionByName(no_track.select(*bad_tracks.columns))


def camera_violations(images: DataFrame, cameras: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Images whose camera isn't there."""
    return images.join(cameras.select(*key, "camera_id"), [*key, "camera_id"], "left_anti")


def crop_sparse_model(observations: DataFrame, tracks: DataFrame, points: DataFrame, x0: float, y0: float, width: float, height: float, key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Observations in the half-open box, shifted and numbered anew; tracks at the new numbers; points with a track left."""
    at = [*key, "image_id", "idx"]
    x, y = F.col("x"), F.col("y")
    kept = observations.where((x >= x0) & (x < x0 + width) & (y >= y0) & (y < y0 + height))
    kept = kept.withColumn("new_idx", F.row_number().over(Window.partitionBy(*key, "image_id").orderBy("idx")) - 1).withColumn("x", x - x0).withColumn("y", y - y0)
    moved = tracks.join(kept.select(*at, "new_idx"), at).select(*key, "point_id", "image_id", F.col("new_idx").alias("idx"))
    left = points.join(moved.select(*key, "point_id").distinct(), [*key, "point_id"], "left_semi")
    return kept.drop("idx").withColumnRenamed("new_idx", "idx"), moved, left


def compare_tables(left: DataFrame, right: DataFrame, key: Sequence[str], fields: Sequence[str], tolerance: float, by: Sequence[str] = ()) -> DataFrame:
    """Keys on one side only, and the greatest difference of each field; equal if none of the first and all within the tolerance."""
    side = lambda d, s: d.select(*key, *[F.col(f).cast("double").alias(f"{f}_{s}") for f in fields], F.lit(1).alias(f"_{s}"))
    d = side(left, "l").join(side(right, "r"), list(key), "full_outer")
    diffs = [F.coalesce(F.max(F.abs(F.col(f"{f}_l") - F.col(f"{f}_r"))), F.lit(0.0)).alias(f"max_{f}_diff") for f in fields]
    d = d.groupBy(*by).agg(F.count_if(F.col("_r").isNull()).alias("only_left"), F.count_if(F.col("_l").isNull()).alias("only_right"), *diffs)
    return d.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0) & (F.greatest(*[F.col(f"max_{f}_diff") for f in fields], F.lit(0.0)) <= tolerance))


def registered_vs_selected(registered: DataFrame, selected: DataFrame, key: Sequence[str], name: str = "name") -> DataFrame:
    """Each selected name with whether the model registered it."""
    k, selected = [*key, name], staged(selected, "selected-names")
    n = selected.count()
    r = dealt(registered.select(*k), k, n).distinct().withColumn("_r", F.lit(True))
    return dealt(selected, k, n).join(r.hint("merge"), k, "left").withColumn("registered", F.coalesce("_r", F.lit(False))).drop("_r")


def component_relations(members: DataFrame, key: Sequence[str] = (), component: str = "component", name: str = "name") -> DataFrame:
    """Relation of each pair of components (left < right) of a capture that share a name; pairs without one are disjoint and not listed.

    Pairs come from an equi join on the name, so work follows the number of shared names. They are dealt by pair before they are counted: a pair's
    names lie in many tasks, where partial sums would hold and spill nearly all pairs and save nothing. ``pair_relations`` is for large captures and lists every pair.
    """
    d = members.select(*key, component, name).distinct()
    size = d.groupBy(*key, component).agg(F.count("*").alias("size"))
    pick = lambda s: d.select(*key, F.col(component).alias(s), name)
    pairs = pick("left").join(pick("right").hint("merge"), [*key, name]).where("left < right").select(*key, "left", "right").repartition(*key, "left", "right")
    pairs = pairs.groupBy(*key, "left", "right").agg(F.count("*").alias("overlap_count"))
    for s in ("left", "right"):
        pairs = pairs.join(size.select(*key, F.col(component).alias(s), F.col("size").alias(f"{s}_size")).hint("merge"), [*key, s])
    return pairs.withColumn("relation", _relation())


def _relation() -> Column:
    n, a, b = F.col("overlap_count"), F.col("left_size"), F.col("right_size")
    return F.when((n == a) & (n == b), "equal_registered_name_set").when(n == a, "strict_subset").when(n == b, "strict_superset").otherwise("non_subset_overlap")


def pair_relations(members: DataFrame, key: Sequence[str] = (), component: str = "component", name: str = "name") -> DataFrame:
    """Relation of every pair of components (left < right) of a capture, disjoint ones too, and ``overlap_names``: the names that both have, in order.

    Columns are those of ``component_relations`` and ``overlap_names``. Components are numbered in their order and cut into blocks. A name goes to each pair of
    blocks that have it, once and with a list of its components in either; pairs are made and counted where they arrive, so what is shuffled follows the names
    of blocks, not the pairs. A name that all components have is one row for each pair of blocks. Disjoint pairs are what lies between a component's pairs with
    common names, so they are neither joined nor shuffled. Null names count in a set's size but are shared with none; components and keys that are null have no pairs.
    """
    k, c = list(key), F.col
    own, chunks, count = _blocks(members, k, component, name)
    met = _met(own, chunks, k, name, count)
    pairs = met.select("lb", "rb", name, F.explode("la").alias("l"), "ra").select("lb", "rb", name, "l", F.explode("ra").alias("r"))
    # Each component's list of pairs with a block begins with a row without a name: before the block, or at the component itself in its own.
    pairs = pairs.where(f"lb < rb OR l < r OR `{name}` IS NULL").withColumn("r", F.when((c("lb") == c("rb")) & c(name).isNull(), c("l")).otherwise(c("r")))
    # The pair as one number, in the order of blocks, left and right component: tasks sort by it, and pairs of a left component follow each other.
    n = own.count()
    pairs = pairs.select((((c("lb") * n + c("rb")) * BLOCK + c("l")) * (BLOCK + 1) + c("r") + 1).alias("pair"), c(name).alias("name")).sortWithinPartitions("pair")
    pairs = pairs.mapInArrow(_pair_lists(BLOCK + 1), f"pair long, next int, names array<{members.schema[name].dataType.simpleString()}>")
    pairs = pairs.withColumn("_left", F.expr(f"pair div {BLOCK + 1}")).withColumn("_blocks", F.expr(f"_left div {BLOCK}"))
    pairs = pairs.select(F.expr(f"_blocks div {n}").alias("lb"), (c("_blocks") % n).alias("rb"), (c("_left") % BLOCK).cast("int").alias("l"), (c("pair") % (BLOCK + 1) - 1).cast("int").alias("r"), "next", F.when(F.get("names", F.lit(0)).isNull(), 0).otherwise(F.size("names")).cast("long").alias("n"), F.sort_array("names").alias("names"))
    rows = _in_block(pairs, own, "lb", count).select(c("own")[c("l")].alias("left"), "rb", "r", "next", "n", "names")
    rows = _in_block(rows, own, "rb", count).select("left", "own", "r", "n", "names", F.explode(F.sequence("r", F.when(c("next") < 0, F.size("own")).otherwise(c("next")) - 1)).alias("q"))
    met = c("q") == c("r")
    rows = rows.where(~met | (c("n") > 0)).select("left", c("own")[c("q")].alias("right"), F.when(met, c("n")).otherwise(F.lit(0).cast("long")).alias("overlap_count"), F.when(met, c("names")).otherwise(F.array()).alias("overlap_names"))
    for f in k:
        rows = rows.where(c(f"left.{f}") == c(f"right.{f}"))
    rows = rows.select(*[c(f"left.{f}") for f in k], *[c(f"{s}.component").alias(s) for s in ("left", "right")], "overlap_count", *[c(f"{s}.size").alias(f"{s}_size") for s in ("left", "right")], "overlap_names")
    return rows.withColumn("relation", F.when(c("overlap_count") == 0, "disjoint").otherwise(_relation()))


def _pair_lists(step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows (pair, name) in order of pair: each pair with the list of its names and the place of the left component's next pair, -1 after its last one.

    A batch's last pair is held until its rows end, so no more than a batch and one pair's names are in memory.
    """

    def rows(t: pa.Table, at: np.ndarray, pair: np.ndarray, following: np.ndarray) -> pa.RecordBatch:
        after = np.where(following // step == pair // step, following % step - 1, -1).astype("int32")
        names = t["name"].slice(0, at[-1]).combine_chunks()
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(after), pa.ListArray.from_arrays(pa.array(at.astype("int32")), names)], ["pair", "next", "names"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            pair = t["pair"].to_numpy()
            at = np.flatnonzero(np.diff(pair, prepend=-1))
            if len(at) > 1:
                yield rows(t, at, pair[at[:-1]], pair[at[1:]])
            held = t.slice(at[-1]) if len(at) else held
        if held is not None and held.num_rows:
            yield rows(held, np.array([0, held.num_rows]), held["pair"].to_numpy()[:1], np.array([-1]))

    return lists


def _blocks(members: DataFrame, k: list[str], component: str, name: str) -> tuple[DataFrame, DataFrame, int]:
    """(own, chunks, number of components). own: block and its components in order, with key and size; chunks: key, name, block and the name's places in it."""
    d = members.select(*k, component, name).distinct()
    for c in (*k, component):
        d = d.where(F.col(c).isNotNull())
    d = staged(d, "component-names")
    sizes = d.groupBy(*k, component).agg(F.count("*").alias("size")).repartitionByRange(*k, component).sortWithinPartitions(*k, component)
    # A row's number within its range is in the lower 33 bits.
    sizes = staged(sizes.withColumn("_n", F.monotonically_increasing_id()), "component-sizes")
    count = sizes.count()
    place = F.pmod(F.col("_n").bitwiseAND((1 << 33) - 1), F.lit(max(1, min(BLOCK, -(-count // BLOCKS))))).cast("int")
    sizes = sizes.withColumn("place", place).withColumn("_first", F.col("_n") - F.col("place"))
    # One row for each block: small enough for one window.
    numbers = sizes.select("_first").distinct().select("_first", (F.row_number().over(Window.orderBy("_first")) - 1).cast("long").alias("block"))
    sizes = sizes.join(numbers.hint("merge"), "_first")
    own = sizes.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", *k, F.col(component).alias("component"), "size"))).alias("own"))
    at = d.where(F.col(name).isNotNull()).join(sizes.select(*k, component, "block", "place").hint("merge"), [*k, component])
    chunks = at.groupBy(*k, name, "block").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return staged(own, "component-blocks"), staged(chunks, "name-blocks"), count


def _met(own: DataFrame, chunks: DataFrame, k: list[str], name: str, count: int) -> DataFrame:
    """Each name of each pair of blocks that have it, with its places in the left (``la``) and the right one, dealt by pair of blocks.

    Each pair of blocks of a capture has a row without a name besides, with all places of the left one and a right one of -1.
    """
    of = chunks.groupBy(*k, name).agg(F.sum(F.size("places").cast("double")).alias("n"))
    pairs = of.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
    pairs += count * own.count() / 2
    parts = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs // PAIR_ROWS) + 1)
    side = lambda s: chunks.select(*k, name, F.col("block").alias(f"{s}b"), F.col("places").alias(f"{s}a"))
    met = side("l").join(side("r").hint("merge"), [*k, name]).where("lb < rb OR lb = rb AND size(la) > 1").select("lb", "rb", name, "la", "ra")
    held = own.select("block", F.size("own").alias("_size"), F.explode(F.array_distinct(F.transform("own", lambda o: F.struct(F.lit(0), *[o[f] for f in k])))).alias("_key"))
    held = held.select(F.col("block").alias("lb"), "_size", "_key").join(held.select(F.col("block").alias("rb"), "_key").hint(_hint(count)), "_key").where("lb <= rb").select("lb", "rb", "_size").distinct()
    each = held.select("lb", "rb", F.lit(None).cast(chunks.schema[name].dataType).alias(name), F.sequence(F.lit(0), F.col("_size") - 1).alias("la"), F.array(F.lit(-1)).alias("ra"))
    return met.unionByName(each).repartition(parts, "lb", "rb")


def _hint(count: int) -> str:
    return "broadcast" if count <= BROADCAST_COMPONENTS else "merge"


def _in_block(rows: DataFrame, own: DataFrame, block: str, count: int) -> DataFrame:
    """``rows`` with ``own`` of their block."""
    return rows.join(own.withColumnRenamed("block", block).hint(_hint(count)), block)


def name_sets(members: DataFrame, key: Sequence[str] = (), component: str = "component", name: str = "name", distinct: bool = False) -> DataFrame:
    """One row per component: its number of different names, digests of the set, a 256-bit mask of its names, and ``same``: the least component of an equal set.

    ``distinct``: no row of ``members`` is repeated. Digests and masks are sums, exclusive and inclusive ors of hashes, so a large component is summed up in partial aggregates.
    """
    d = members.select(*key, component, name)
    d = d if distinct else d.distinct()
    h = F.xxhash64(F.col(name).cast("string"))
    bit = lambda k: F.bit_or(F.when(F.pmod(F.shiftright(h, 8), F.lit(4)) == k, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))).otherwise(F.lit(0).cast("long"))).alias(f"mask{k}")
    sets = d.groupBy(*key, component).agg(F.count("*").alias("size"), F.sum(h.cast("decimal(38,0)")).alias("digest"), F.bit_xor(F.xxhash64(F.lit(1), F.col(name).cast("string"))).alias("digest2"), *map(bit, range(4)))
    same = sets.groupBy(*key, "size", "digest", "digest2").agg(F.min(component).alias("same"))
    on = [F.col(f"s.{c}").eqNullSafe(F.col(f"m.{c}")) for c in (*key, "size", "digest", "digest2")]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return sets.alias("s").join(same.hint("merge").alias("m"), condition).select("s.*", "m.same")


def contained_sets(members: DataFrame, sets: DataFrame, key: Sequence[str] = (), component: str = "component", name: str = "name", over: DataFrame | None = None, distinct: bool = False) -> DataFrame:
    """Pairs (left, right) of different name sets with left within right, by the least component of each set: key, left, right, left_size, right_size.

    A set that holds ``left`` holds the name of it that fewest sets have, so only these are looked at, and of them only larger ones
    whose mask has all of its bits and that hold its next ``PROBES`` rarest names too; then all common names are counted. A name that all components share gives pairs only for sets
    that have no other name. ``over``: the components (key, component) that may be ``right``, by default all.
    ``distinct``: no row of ``members`` is repeated.
    """
    k = list(key)
    reps = sets.where(F.col(component) == F.col("same")).drop("same", "digest", "digest2")
    mine = members.select(*k, component, name)
    mine = staged((mine if distinct else mine.distinct()).join(reps.select(*k, component).hint("merge"), [*k, component], "left_semi"), "set-names")
    often = mine.groupBy(*k, name).agg(F.count("*").alias("_n"))
    nth = F.row_number().over(Window.partitionBy(*k, component).orderBy("_n", name))
    probes = staged(mine.join(often.hint("merge"), [*k, name]).withColumn("_nth", nth).where(F.col("_nth") <= PROBES + 1).select(*k, F.col(component).alias("left"), name, "_nth"), "set-probes")
    masks = [f"mask{i}" for i in range(4)]
    left = reps.select(*k, F.col(component).alias("left"), F.col("size").alias("left_size"), *[F.col(m).alias(f"l{m}") for m in masks])
    if over is not None:
        # A set counts if any component with these names may be right.
        reps = reps.join(sets.join(over.select(*k, component).hint("merge"), [*k, component], "left_semi").select(*k, F.col("same").alias(component)).distinct().hint("merge"), [*k, component], "left_semi")
    right = reps.select(*k, F.col(component).alias("right"), F.col("size").alias("right_size"), *masks)
    fits = F.col("right_size") > F.col("left_size")
    for m in masks:
        fits = fits & (F.col(f"l{m}").bitwiseAND(F.bitwise_not(F.col(m))) == 0)
    own = mine.select(*k, F.col(component).alias("right"), name)
    pairs = probes.where("_nth = 1").drop("_nth").join(own.hint("merge"), [*k, name]).where("left <> right").drop(name)
    pairs = pairs.join(left.hint("merge"), [*k, "left"]).join(right.hint("merge"), [*k, "right"]).where(fits).select(*k, "left", "right", "left_size", "right_size")

    def holding(pairs: DataFrame, names: DataFrame, number: Column) -> DataFrame:
        """The pairs whose ``right`` has all of these names of ``left``, which are ``number``."""
        each = pairs.join(names.hint("merge"), [*k, "left"]).join(own.hint("merge"), [*k, "right", name], "left_semi")
        return each.groupBy(*k, "left", "right", "left_size", "right_size").agg(F.count("*").alias("_common")).where(F.col("_common") == number).drop("_common")

    some = staged(holding(pairs, probes.drop("_nth"), F.least("left_size", F.lit(PROBES + 1))), "set-pairs")
    small = some.where(F.col("left_size") <= PROBES + 1)
    return small.unionByName(holding(some.where(F.col("left_size") > PROBES + 1), mine.select(*k, F.col(component).alias("left"), name), F.col("left_size")))


def strict_subsets(members: DataFrame, key: Sequence[str] = (), component: str = "component", name: str = "name") -> DataFrame:
    """The ``strict_subset`` relations that ``select_component`` looks at, without those of all other pairs: key, left, right, relation.

    Each component whose names all are in a larger set is ``left``; ``right`` is the least component of the larger set.
    """
    k = list(key)
    named = members.where(F.col(name).isNotNull())
    sets = staged(name_sets(named, k, component, name), "component-sets")
    within = contained_sets(named, sets, k, component, name).select(*k, F.col("left").alias("same"), "right")
    return sets.select(*k, F.col(component).alias("left"), "same").join(within.hint("merge"), [*k, "same"]).select(*k, "left", "right", F.lit("strict_subset").alias("relation"))


def choose_component(components: DataFrame, members: DataFrame, positions: DataFrame, key: Sequence[str] = ("capture_id",), component: str = "component", name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(inventory, selection): the complete inventory of each capture's mapper components, and the one that is taken.

    components: key, component, path, parse_error; members: key, component, name as registered, repeats included; positions: key, name, position of
    selected frames, numbered from 0. inventory: status (selected, not_selected, dominated, invalid), reasons and counts of each component.
    A component is invalid if its names could not be read, are none, repeat, or hold no selected frame; dominated if a candidate has
    all its names and more. Of the others the first by longest run, registered images, coverage, name and path is taken.
    selection: key, selected, path, confidence (high, or low where an equal one exists, its longest run is one of several, or it shares names with
    a component that isn't part of it), ties, advisories; without a usable component ``blocked`` says why. Captures without any component
    have no row. Names and keys that are null are no names.
    """
    k = list(key)
    own = [*k, component]
    # Each name of a component once, written out: every later step starts from it instead of from the members' own plan.
    named = staged(members.where(F.col(name).isNotNull()).groupBy(*own, name).agg(F.count("*").alias("_copies")), "component-names")
    counts = named.groupBy(*own).agg(F.sum("_copies").alias("registered"), F.count("*").alias("_names"))
    positions = staged(positions.select(*k, name, "position"), "positions")
    at = staged(named.select(*own, name).join(positions.hint("merge"), [*k, name]), "component-positions")
    runs = longest_runs(contiguous_runs(at, own), own).select(*own, "longest_run", (F.col("ties") > 1).alias("longest_run_tie"))
    found = at.groupBy(*own).agg(F.count("*").alias("_found"))
    total = positions.groupBy(*k).agg(F.count("*").alias("_selected"))
    d = components.select(*own, "path", "parse_error")
    for side in (counts, runs, found):
        d = d.join(side.hint("merge"), own, "left")
    d = d.join(total.hint("merge"), k, "left").fillna(0, ["registered", "_names", "longest_run", "_found"])
    c = F.col
    twice = (c("_names") < c("registered")) | F.coalesce(F.lower("parse_error").contains("duplicate"), F.lit(False))
    reasons = X.violations(
        registered_name_parse_error=c("parse_error").isNotNull(), no_registered_image_names=c("registered") == 0, duplicate_registered_image_names=twice,
        no_registered_name_in_selected_frame_contract=(c("registered") > 0) & (c("_names") == c("registered")) & (c("longest_run") == 0),
    )
    valid = (c("registered") > 0) & (c("_names") == c("registered")) & (c("longest_run") > 0)
    d = d.withColumns({"reasons": reasons, "valid": valid, "coverage": F.coalesce(c("_found") / c("_selected").cast("double"), F.lit(0.0)), "longest_run_tie": F.coalesce("longest_run_tie", F.lit(False))})
    d = staged(d.drop("_selected", "_found"), "component-inventory")
    names = named.drop("_copies")
    sets = staged(name_sets(names, k, component, name, distinct=True), "component-sets")
    within = contained_sets(names, sets, k, component, name, over=d.where("valid"), distinct=True)
    dominated = sets.join(within.select(*k, F.col("left").alias("same")).distinct().hint("merge"), [*k, "same"], "left_semi").select(*own, F.lit(True).alias("dominated"))
    d = staged(d.join(dominated.hint("merge"), own, "left").withColumn("dominated", F.coalesce("dominated", F.lit(False))).withColumn("active", c("valid") & ~c("dominated")), "component-inventory")

    # The first of each capture by a mergeable minimum, so that one capture with most components is no single task.
    quality = F.struct((-c("longest_run")).alias("a"), (-c("registered")).alias("b"), (-c("coverage")).alias("c"))
    best = d.where("active").groupBy(*k).agg(F.min(F.struct(quality.alias("quality"), c(component).alias("name"), "path", "longest_run_tie")).alias("best"))
    best = staged(best.select(*k, "best.quality", c("best.name").alias("selected"), c("best.path").alias("selected_path"), c("best.longest_run_tie").alias("_run_tie")), "component-best")
    d = d.join(best.hint("merge"), k, "left")
    ties = d.where(c("active") & (quality == c("quality"))).groupBy(*k).agg(F.count("*").alias("ties"))
    taken = c("active") & (c(component) == c("selected")) & c("path").eqNullSafe(c("selected_path"))
    status = F.when(c("dominated"), "dominated").when(~c("valid"), "invalid").when(taken, "selected").otherwise("not_selected")
    why = F.when(c("dominated"), F.array(F.lit("registered_name_set_strict_subset_of_other_component"))).when(~c("valid"), c("reasons")).when(taken, F.array().cast("array<string>"))
    why = why.otherwise(F.array(F.when(-c("longest_run") > c("quality.a"), "shorter_longest_contiguous_registered_segment").otherwise("lower_quality_ranked_component")))
    inventory = d.select(*own, "path", "registered", "longest_run", "longest_run_tie", "coverage", status.alias("status"), why.alias("exclusion_reasons"))

    # Only the taken component meets the others, by its names.
    first = best.select(*k, c("selected").alias(component)).join(names.hint("merge"), own).withColumnRenamed(component, "_first")
    other = names.join(first.hint("merge"), [*k, name]).where(c(component) != c("_first")).groupBy(*own).agg(F.count("*").alias("_common"))
    known = d.where("valid OR dominated").select(*own, "_names")
    crossing = other.join(known.hint("merge"), own).where("_common < _names").groupBy(*k).agg(F.array_sort(F.collect_set(c(component).cast("string"))).alias("overlaps"))
    blocked = d.groupBy(*k).agg(F.bool_or("active").alias("_any"), F.min(F.when(F.array_contains("reasons", "duplicate_registered_image_names"), F.coalesce("path", c(component).cast("string")))).alias("_twice"))
    s = blocked.join(best.hint("merge"), k, "left").join(ties.hint("merge"), k, "left").join(crossing.hint("merge"), k, "left")
    s = s.withColumns({"ties": F.when(c("ties") > 1, c("ties")).otherwise(0), "overlaps": F.coalesce("overlaps", F.array().cast("array<string>"))})
    advisories = X.violations(equal_quality_active_candidate_tie_resolved_by_stable_component_name_path=c("ties") > 1, selected_component_has_equal_longest_registered_segments=F.coalesce(c("_run_tie"), F.lit(False)))
    advisories = F.concat(advisories, F.transform("overlaps", lambda o: F.concat(F.lit("non_subset_overlap_with:"), o)))
    s = s.withColumn("advisories", F.when(c("_any"), advisories).otherwise(F.array().cast("array<string>")))
    reason = F.when(~c("_any"), F.when(c("_twice").isNotNull(), F.concat(F.lit("duplicate image name in "), "_twice")).otherwise("no usable registered component"))
    return inventory, s.select(*k, "selected", c("selected_path").alias("path"), F.when(c("_any"), F.when(F.size("advisories") > 0, "low").otherwise("high")).alias("confidence"), "ties", "advisories", reason.alias("blocked"))


def component_inventory(members: DataFrame, positions: DataFrame, key: Sequence[str] = (), component: str = "component", name: str = "name") -> DataFrame:
    """Registered count, longest run of consecutive selected positions, ties and coverage of each component.

    positions: (name, position) of the selected frames, numbered from 0 without gaps.
    """
    own = [*key, component]
    d = members.select(*own, name).distinct().join(positions, [*key, name])
    runs = longest_runs(contiguous_runs(d, own), own)
    total = positions.groupBy(*key).agg(F.count("*").alias("selected")) if key else positions.agg(F.count("*").alias("selected"))
    counts = d.groupBy(*own).agg(F.count("*").alias("registered"))
    counts = counts.join(total, list(key)) if key else counts.join(F.broadcast(total))  # one row
    return counts.join(runs, own).withColumn("coverage", F.col("registered") / F.col("selected").cast("double")).drop("selected")


def select_component(inventory: DataFrame, relations: DataFrame, key: Sequence[str] = (), component: str = "component") -> DataFrame:
    """Status of each component: dominated (a strict subset of another), selected (first by run, count, coverage, name) or not_selected.

    relations: rows of ``strict_subsets``, which are enough, or of ``component_relations``.
    """
    own = [*key, component]
    sub = relations.where("relation = 'strict_subset'").select(*key, F.col("left").alias(component)).unionByName(relations.where("relation = 'strict_superset'").select(*key, F.col("right").alias(component))).distinct()
    d = inventory.join(sub.withColumn("_sub", F.lit(True)), own, "left").withColumn("active", F.col("_sub").isNull()).drop("_sub")
    quality = [F.desc("longest_run"), F.desc("registered"), F.desc("coverage")]
    # One window for each capture; captures run side by side, and inactive components come last.
    w = Window.partitionBy(*key).orderBy(F.desc("active"), *quality, component)
    tie = F.count("*").over(Window.partitionBy(*key, "active", "longest_run", "registered", "coverage"))
    d = d.withColumn("rank", F.row_number().over(w)).withColumn("equal_quality", tie)
    return d.withColumn("status", F.when(~F.col("active"), "dominated").when(F.col("rank") == 1, "selected").otherwise("not_selected")).drop("active")


def rank_model_candidates(models: DataFrame, key: Sequence[str] = ("capture_id",)) -> DataFrame:
    """Score and rank (from 1) of each candidate; ties by name.

    Counts and errors are added first: with the logarithm last, scores that are equal are equal to the last bit, in any engine.
    """
    error = F.col("reprojection_error_px")
    near = F.when(error.isNull(), 0.0).otherwise(1.0 / (1.0 + F.greatest(F.lit(0.0), error)))
    score = F.coalesce("registered_image_count", F.lit(0)) + near + 0.25 * F.log1p(F.greatest(F.lit(0), F.coalesce("triangulated_point_count", F.lit(0))))
    d = models.withColumn("score", score)
    return d.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "model_name")))


def model_counts(observations: DataFrame, tracks: DataFrame, key: Sequence[str]) -> DataFrame:
    """Images, observations, tracked observations, points and tracks of each model."""
    o = observations.groupBy(*key).agg(F.count_distinct("image_id").alias("images"), F.count("*").alias("observations"), F.count_if(F.col("point_id") != -1).alias("tracked"))
    t = tracks.groupBy(*key).agg(F.count_distinct("point_id").alias("points"), F.count("*").alias("tracks"))
    return o.join(t, list(key), "left").fillna(0, ["points", "tracks"])


def sparse_model_evidence(observations: DataFrame, tracks: DataFrame, points: DataFrame, key: Sequence[str]) -> DataFrame:
    """Reprojection error and track length summaries of each model. points: key, point_id, error."""
    lengths = tracks.groupBy(*key, "point_id").agg(F.count("*").alias("length"))
    stat = lambda c, n: [F.count(c).alias(f"{n}_count"), F.min(c).alias(f"{n}_min"), F.max(c).alias(f"{n}_max"), F.avg(c).alias(f"{n}_mean")]
    side = lambda d, c, n: joined(d.groupBy(*key).agg(*stat(c, n)), exact_percentiles(d, key, {f"{n}_median": (F.col(c), 0.5)}), key)
    e, t = side(points, "error", "error"), side(lengths, "length", "track")
    images = observations.groupBy(*key).agg(F.count_distinct("image_id").alias("registered_image_count"))
    return images.join(e, list(key), "left").join(t, list(key), "left")


def geometry_gate(evidence: DataFrame, least_images: int = 2) -> DataFrame:
    """Hard failures and warnings of each model's evidence row, and whether it passes."""
    c = F.col
    bad = lambda n: ~X.is_finite(c(n).cast("double"))
    failures = X.violations(
        component_count_must_equal_one=F.coalesce(c("component_count"), F.lit(0)) != 1, too_few_registered_images=F.coalesce(c("registered_image_count"), F.lit(0)) < least_images, exactly_one_camera_required=F.coalesce(c("camera_count"), F.lit(0)) != 1,
        non_finite_camera_fx=bad("fx"), non_finite_camera_fy=bad("fy"), non_positive_focal_length=~F.coalesce((c("fx") > 0) & (c("fy") > 0), F.lit(False)), sparse_points_required=F.coalesce(c("point_count"), F.lit(0)) <= 0,
        camera_trajectory_not_finite=~F.coalesce(c("centers_finite"), F.lit(False)), camera_trajectory_not_continuous=~F.coalesce(c("continuous"), F.lit(False)),
    )
    warnings = X.violations(reprojection_error_not_available=c("reprojection_error_px").isNull(), track_length_not_available=F.coalesce(c("track_count"), F.lit(0)) == 0)
    return evidence.withColumn("hard_failures", failures).withColumn("warnings", warnings).withColumn("computed_pass", F.size("hard_failures") == 0)


def geometry_evidence(cameras: DataFrame, images: DataFrame, points: DataFrame, trajectories: DataFrame, components: DataFrame, expected: DataFrame | None = None, key: Sequence[str] = ("model_id",)) -> DataFrame:
    """What ``geometry_gate`` judges, one row for each model of ``components``, from the model's own tables.

    components: key, component_count. cameras: key, width, height, params (fx, fy, cx, cy first). images: key, name. points: key, error, track_length.
    trajectories: key, centers_finite, continuous. expected: key, name; where it is given, ``names_match`` tells whether every name is
    registered once and no other is (also where there are none at all). Sums are partial, so a model with most rows is no single task; a model without rows in a table has null or 0.
    """
    k, c = list(key), F.col
    p = lambda i: F.get("params", F.lit(i))
    cam = cameras.groupBy(*k).agg(F.count("*").alias("camera_count"), *[F.max(c(n)).cast("double").alias(n) for n in ("width", "height")], *[F.max(p(i)).alias(n) for i, n in enumerate(("fx", "fy", "cx", "cy"))])
    pts = points.groupBy(*k).agg(F.count("*").alias("point_count"), F.avg("error").alias("reprojection_error_px"), F.count_if(c("track_length") > 0).alias("track_count"))
    names = images.select(*k, "name", F.lit(1).alias("_a"), F.lit(0).alias("_e"))
    if expected is not None:
        names = names.unionByName(expected.select(*k, "name", F.lit(0).alias("_a"), F.lit(1).alias("_e")))
    each = names.groupBy(*k, "name").agg(F.sum("_a").alias("_a"), F.sum("_e").alias("_e"))
    img = each.groupBy(*k).agg(F.sum("_a").alias("registered_image_count"), F.sum("_e").alias("_expected"), F.bool_and((c("_a") == 1) & (c("_e") == 1)).alias("_same"))
    d = components
    for other in (cam, img, pts, trajectories.select(*k, "centers_finite", "continuous")):
        d = d.join(other.hint("merge"), k, "left")
    d = d.fillna(0, ["camera_count", "registered_image_count", "point_count", "track_count"])
    same = F.coalesce(c("_same"), F.lit(True)) if expected is not None else F.lit(None).cast("boolean")
    return d.withColumn("names_match", same).drop("_expected", "_same")


def named_geometry_gate(evidence: DataFrame, least_images: int = 2) -> DataFrame:
    """``geometry_gate`` of ``geometry_evidence`` rows, with the rest of the camera and the staged names among the hard failures."""
    d = geometry_gate(evidence, least_images)
    bad = lambda n: (F.col("camera_count") == 1) & ~X.is_finite(F.col(n).cast("double"))
    more = X.violations(**{f"non_finite_camera_{n}": bad(n) for n in ("width", "height", "cx", "cy")}, registered_names_do_not_match_staged_set=F.coalesce(~F.col("names_match"), F.lit(False)))
    return d.withColumn("hard_failures", F.concat("hard_failures", more)).withColumn("computed_pass", F.size("hard_failures") == 0)


def select_pose_candidate(candidates: DataFrame, mode: str = "enforce", key: Sequence[str] = ("frame_id",)) -> DataFrame:
    """The best candidate of each frame: without hard reasons, strict quality first, then inlier ratio, coverage, error, reference."""
    d = candidates.where(F.size("hard_reasons") == 0).withColumn("strict", F.size("quality_reasons") == 0)
    if mode == "enforce":
        d = d.where("strict")
    w = Window.partitionBy(*key).orderBy(F.desc("strict"), F.desc("inlier_ratio"), F.desc("grid_coverage"), "reprojection_rmse_px", "reference_index")
    return d.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "strict")


def longest_segment(segments: DataFrame, key: Sequence[str]) -> DataFrame:
    """The segment of most frames, the earliest among equals, and how many are equal."""
    d = segments.withColumn("top", F.max("frame_count").over(Window.partitionBy(*key))).where("frame_count = top")
    return d.groupBy(*key).agg(F.max("frame_count").alias("frame_count"), F.min("start").alias("start"), F.count("*").alias("ties"))


def model_inventory(files: DataFrame, key: str = "capture") -> DataFrame:
    """Folders (capture, folder, kind) that hold all three sparse tables, and their number; exactly one is wanted."""
    whole = files.where(F.col("kind").isin("cameras", "images", "points3D")).groupBy(key, "folder").agg(F.count_distinct("kind").alias("kinds")).where("kinds = 3")
    return whole.groupBy(key).agg(F.count("*").alias("models"), F.sort_array(F.collect_list("folder")).alias("folders"))
