"""Nearest neighbours of points over a grid of cells, by tiles.

A tile is a cube of ``TILE`` cells a side. A source point belongs to one tile; a target point to its own and, at a border, to the
tiles that it touches, so both clouds are shuffled about once. A tile's rows are sorted together and worked off as arrays, many tiles
at a time. Tiles of more than ``MOST`` points of a cloud are halved into blocks by a running number, and each source block meets each
target block: no task holds more than two blocks, whatever a cell holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import staged

TILE, MOST = 8, 20_000
#: Up to so many tiles that are halved their numbers of blocks are sent to all executors; beyond it they are joined by a shuffle.
BROADCAST_TILES = 100_000
#: Rows that a task gathers before it works them off, and pairs that it holds at once.
GATHER, PAIRS = 100_000, 2_000_000
XYZ = ("x", "y", "z")
_GROUP = ("tx", "ty", "tz", "sb", "tb")


def _nearest(group: np.ndarray, cell: np.ndarray, xyz: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Least squared distance of each source row to a target in its 27 cells, infinite if there is none. ``cell``: places within the tile, -1 to TILE."""
    side = TILE + 2
    code = ((group * side + cell[0] + 1) * side + cell[1] + 1) * side + cell[2] + 1
    t = np.flatnonzero(~source)
    t = t[np.argsort(code[t], kind="stable")]
    at, target = code[t], xyz[:, t]
    s = np.flatnonzero(source)
    own, best = code[s], np.full(len(s), np.inf)
    for dx, dy in product((-1, 0, 1), repeat=2):
        # Cells along z have consecutive codes: three of them are one range.
        middle = own + (dx * side + dy) * side
        lo, hi = np.searchsorted(at, middle - 1, "left"), np.searchsorted(at, middle + 1, "right")
        n = hi - lo
        some = np.flatnonzero(n)
        done = 0
        while done < len(some):
            upto = max(done + 1, int(np.searchsorted(np.cumsum(n[some[done:]]), PAIRS, "right")) + done)
            rows = some[done:upto]
            ends = np.cumsum(n[rows])
            places = np.arange(ends[-1]) - np.repeat(ends - n[rows], n[rows]) + np.repeat(lo[rows], n[rows])
            d = sum((np.repeat(xyz[k, s[rows]], n[rows]) - target[k, places]) ** 2 for k in range(3))
            best[rows] = np.minimum(best[rows], np.minimum.reduceat(d, ends - n[rows]))
            done = upto
    return best


def _worked_off(batches: Iterator[pa.RecordBatch], gather: int) -> Iterator[pa.RecordBatch]:
    """(row, d2) of sorted rows (scene, tx .. tb, source, x, y, z, cx, cy, cz, row), by whole tiles."""

    def tiles(t: pa.Table, last: bool):
        scene = t.column("scene").combine_chunks().dictionary_encode()
        keys = np.stack([scene.indices.fill_null(-1).to_numpy(zero_copy_only=False), *(t.column(c).to_numpy() for c in _GROUP)])
        new = np.ones(t.num_rows, bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
        end = t.num_rows if last else int(np.flatnonzero(new)[-1])
        if end:
            number = (np.cumsum(new) - 1)[:end]
            cell = np.stack([t.column(f"c{c}").to_numpy() for c in XYZ])[:, :end]
            xyz = np.stack([t.column(c).to_numpy() for c in XYZ])[:, :end]
            source = t.column("source").to_numpy(zero_copy_only=False)[:end].astype(bool)
            yield pa.RecordBatch.from_arrays([t.column("row").slice(0, end).combine_chunks().take(pa.array(np.flatnonzero(source))), pa.array(_nearest(number, cell, xyz, source))], ["row", "d2"])
        return t.slice(end)

    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= gather:
            rest = yield from tiles(pa.Table.from_batches(held), False)
            held = rest.to_batches()
    if sum(x.num_rows for x in held):
        yield from tiles(pa.Table.from_batches(held), True)


def nearest_by_cell(source: DataFrame, target: DataFrame, cell, key: str, order: str) -> DataFrame:
    """(key, order, d2): squared distance of each source point to the nearest target point in its own and the 26 cells around it, null if there is none.

    ``cell`` makes a coordinate's cell, a long; points whose cells are not whole numbers are near nothing. Points of one key and order have one
    row with the least distance.
    """

    def placed(d, is_source):
        d = d.select(F.col(key).alias("scene"), *[F.col(c).cast("double").alias(c) for c in XYZ], *[cell(c).alias(f"v{c}") for c in XYZ], *([F.struct(F.col(key).alias("k"), F.col(order).alias("o")).alias("row")] if is_source else []))
        return d.withColumns({f"t{c}": F.floor(F.col(f"v{c}") / TILE) for c in XYZ}).withColumn("nth", F.monotonically_increasing_id())

    def inside(d):
        return d.where(" AND ".join(f"v{c} IS NOT NULL" for c in XYZ))

    s, t = placed(source, True), inside(placed(target, False))
    # A target point at a tile's border belongs to the tiles beside it too; most points do not.
    for c in XYZ:
        at = F.pmod(F.col(f"v{c}"), F.lit(TILE))
        beside = F.array_compact(F.array(F.col(f"t{c}"), F.when(at == 0, F.col(f"t{c}") - 1), F.when(at == TILE - 1, F.col(f"t{c}") + 1)))
        t = t.withColumn(f"t{c}", F.explode(beside))
    tile = ["scene", *[f"t{c}" for c in XYZ]]
    counts = inside(s).groupBy(*tile).agg(F.count("*").alias("ns"), F.lit(0).cast("long").alias("nt")).unionByName(t.groupBy(*tile).agg(F.lit(0).cast("long").alias("ns"), F.count("*").alias("nt")))
    large = counts.groupBy(*tile).agg(F.sum("ns").alias("ns"), F.sum("nt").alias("nt")).where(f"ns > {MOST} OR nt > {MOST}")
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / MOST), F.lit(1)).cast("int")
    large = staged(large.select(*[F.col(c).alias(f"l{c}") for c in tile], blocks("ns").alias("bs"), blocks("nt").alias("bt")), "large-tiles")
    some = large.limit(BROADCAST_TILES + 1).count()

    def dealt(d, is_source):
        if some:
            side = F.broadcast(large) if some <= BROADCAST_TILES else large.hint("merge")
            same = F.col("scene").eqNullSafe(F.col("lscene"))
            for c in tile[1:]:
                same = same & (F.col(c) == F.col(f"l{c}"))
            d = d.join(side, same, "left").withColumns({n: F.coalesce(n, F.lit(1)) for n in ("bs", "bt")})
        else:
            d = d.withColumns({n: F.lit(1) for n in ("bs", "bt")})
        mine, other = ("bs", "bt") if is_source else ("bt", "bs")
        own = F.pmod(F.xxhash64("nth"), F.col(mine)).cast("int")
        d = d.withColumn("own", own).withColumn("each", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        sb, tb = ("own", "each") if is_source else ("each", "own")
        row = F.col("row") if is_source else F.lit(None).cast(s.schema["row"].dataType)
        return d.select("scene", *[F.col(f"t{c}") for c in XYZ], F.col(sb).cast("int").alias("sb"), F.col(tb).cast("int").alias("tb"), F.lit(is_source).alias("source"), *XYZ, *[(F.col(f"v{c}") - TILE * F.col(f"t{c}")).cast("long").alias(f"c{c}") for c in XYZ], row.alias("row"))

    both = dealt(inside(s), True).unionByName(dealt(t, False))
    group = ["scene", *_GROUP]
    both = both.repartition(*group).sortWithinPartitions(*group)
    gather = GATHER
    found = both.mapInArrow(lambda batches: _worked_off(batches, gather), f"row {s.schema['row'].dataType.simpleString()}, d2 double").where("d2 < double('Infinity')")
    found = found.select("row.*", "d2").unionByName(s.select("row.*", F.lit(None).cast("double").alias("d2")))
    return found.groupBy(F.col("k").alias(key), F.col("o").alias(order)).agg(F.min("d2").alias("d2"))
