"""Distance joins over points(id, x, y, z): nearest neighbours, radius pairs, gaps between labelled
sets, single-linkage components and the Euclidean spanning tree.

A distance predicate alone would be planned as a nested loop. Here space is cut into grid cells,
cell pairs are compared by their bounding boxes from coarse to fine, and only the rows of cell pairs
that can still matter are joined. Exact copies are merged first, so piles of equal points cost
nothing. Results are exact; no candidate is dropped that its bound does not rule out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.operators.graph import connected_components
from frondlake.operators.ordered import quantiles
from frondlake.session import durable, shuffled

AXES = ("x", "y", "z")
_BITS = 20
LEAF = 48
BLOCK = 2048


class PairBudgetExceeded(RuntimeError):
    """The pairs within the radius would outgrow the budget; use the spanning tree instead."""


def distance2(a: str, b: str) -> Column:
    return sum(((F.col(f"{a}{c}") - F.col(f"{b}{c}")) * (F.col(f"{a}{c}") - F.col(f"{b}{c}"))
                for c in AXES[1:]), (F.col(f"{a}x") - F.col(f"{b}x")) * (F.col(f"{a}x") - F.col(f"{b}x")))


def bounds(*sets: DataFrame) -> tuple[list[float], float, int]:
    """(minimum corner, longest side, largest row count) over all sets. Rows without finite
    coordinates lie nowhere; they are refused rather than lost in a join."""
    lows, highs, rows = [], [], 0
    placed = " and ".join(f"coalesce(abs({c}) < double('infinity'), false)" for c in AXES)
    for s in sets:
        r = s.agg(*[F.min(c) for c in AXES], *[F.max(c) for c in AXES], F.count(F.lit(1)), F.count_if(F.expr(f"not ({placed})"))).first()
        if r[7]:
            raise ValueError(f"{r[7]} rows have a null or non-finite coordinate")
        if r[6]:
            lows.append(r[:3])
            highs.append(r[3:6])
            rows = max(rows, r[6])
    if not rows:
        return [0.0] * 3, 1.0, 0
    low = [min(v) for v in zip(*lows)]
    size = max(max(v) - l for v, l in zip(zip(*highs), low))
    return low, size if size > 0 else 1.0, rows


def pack(cx: Column, cy: Column, cz: Column) -> Column:
    """One bigint for three cell numbers in [0, 2**20)."""
    return F.shiftleft(cx.cast("long"), 2 * _BITS).bitwiseOR(
        F.shiftleft(cy.cast("long"), _BITS)).bitwiseOR(cz.cast("long"))


def cell_of(low: list[float], edge: float) -> list[Column]:
    return [F.floor((F.col(c) - F.lit(l)) / F.lit(edge)).cast("long") for c, l in zip(AXES, low)]


def fine_cell(low: list[float], size: float, depth: int) -> Column:
    top = (1 << depth) - 1
    parts = [F.least(F.greatest(F.floor((F.col(c) - F.lit(l)) / F.lit(size) * F.lit(1 << depth)), F.lit(0)),
                     F.lit(top)) for c, l in zip(AXES, low)]
    return pack(*parts)


def coarser(cell: Column) -> Column:
    """The cell one level up: every cell number halved."""
    mask = (1 << (_BITS - 1)) - 1
    keep = mask << 2 * _BITS | mask << _BITS | mask
    return F.shiftright(cell, 1).bitwiseAND(F.lit(keep))


def depth_for(rows: int, leaf: int) -> int:
    return max(1, min(_BITS - 1, math.ceil(math.log(max(rows, 1) / leaf, 8)) if rows > leaf else 1))


#: distinct rows in the fullest cell of a grid, in leaves
CROWD = 8


def settled_depth(rows: int, leaf: int, low: list[float], size: float, *sets: tuple[DataFrame, list[str]]) -> int:
    """Depth at which no cell (per the keys given with each set) holds more than CROWD leaves: that for
    evenly spread rows, and deeper where they cluster, down to the finest grid. Only counts come back."""
    depth = depth_for(rows, leaf)
    while depth < _BITS - 1:
        cell = fine_cell(low, size, depth)
        most = max(df.groupBy(*by, cell.alias("__cell")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0 for df, by in sets)
        if most <= CROWD * leaf:
            break
        depth = min(_BITS - 1, depth + max(1, math.ceil(math.log(most / leaf, 8))))
    return depth


def _boxes(nodes: DataFrame, by: list[str], weight: str = "n") -> DataFrame:
    return nodes.groupBy(*by).agg(F.sum(weight).alias("n"), *[F.min(f"lo_{c}").alias(f"lo_{c}") for c in AXES],
                                  *[F.max(f"hi_{c}").alias(f"hi_{c}") for c in AXES])


def node_levels(points: DataFrame, by: list[str], cell: Column, depth: int, weight: Column) -> list[DataFrame]:
    """Boxes per (by, cell) for every level, coarsest first. The finest level aggregates the rows;
    each coarser one aggregates the level below it."""
    finest = points.select(*by, cell.alias("cell"), weight.alias("n"),
                           *[F.col(c).alias(f"lo_{c}") for c in AXES], *[F.col(c).alias(f"hi_{c}") for c in AXES])
    levels = [durable(_boxes(finest, [*by, "cell"]))]
    for _ in range(depth):
        up = levels[0].withColumn("cell", coarser(F.col("cell")))
        levels.insert(0, _boxes(up, [*by, "cell"]))
    return levels


def _gap2() -> Column:
    out = F.lit(0.0)
    for c in AXES:
        d = F.greatest(F.col(f"a_lo_{c}") - F.col(f"b_hi_{c}"), F.col(f"b_lo_{c}") - F.col(f"a_hi_{c}"), F.lit(0.0))
        out = out + d * d
    return out


def _reach2() -> Column:
    out = F.lit(0.0)
    for c in AXES:
        d = F.greatest(F.col(f"a_hi_{c}") - F.col(f"b_lo_{c}"), F.col(f"b_hi_{c}") - F.col(f"a_lo_{c}"))
        out = out + d * d
    return out


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select([F.col(c).alias(f"{name}_{c}") for c in nodes.columns])


def distinct_points(points: DataFrame) -> DataFrame:
    """One row per coordinate: smallest id, copies."""
    return points.groupBy(*AXES).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))


#: rows that one task sorts
ROWS = 500_000
#: rows of a tile that one task holds, and candidates it measures them against
TILE, CANDIDATES = 20_000, 200_000


def _in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys in as many tasks as ``rows`` rows need. The number is given, since small tasks are
    merged by their bytes otherwise, and rows of few distinct values have next to none."""
    return df.repartition(max(1, math.ceil(rows / ROWS)), *keys)


def _nearest_in_tiles(spots: DataFrame, copies: DataFrame, pairs: DataFrame, cell: Column, need: int) -> DataFrame:
    """spot, distance, neighbour, rank: the ``need`` nearest copies of every spot among the cells paired with its own.

    4 x 4 x 4 cells form a tile. A copy comes once to every tile that has a cell paired with its own, with
    a bit for each of these cells, so candidates meet inside a task and are neither sorted nor shuffled.
    Fuller tiles go in shares, whose results are ranked once more."""
    tile = coarser(coarser(F.col("pa")))
    low2 = [F.shiftright("pa", shift * _BITS).bitwiseAND(F.lit(3)) for shift in (2, 1, 0)]
    child = (low2[0] * 16 + low2[1] * 4 + low2[2]).cast("int")
    a = spots.select("spot", cell.alias("pa"), *AXES).select("spot", tile.alias("tile"), child.alias("child"), *AXES)
    b = copies.select(F.col("id").alias("neighbour"), cell.alias("pb"), *[F.col(c).alias(f"b_{c}") for c in AXES])
    calls = durable(pairs.groupBy(tile.alias("tile"), "pb").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), child)).alias("cells")))
    rows = b.groupBy("pb").agg(F.count(F.lit(1)).alias("n"))
    shares = durable(a.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("sa"))
                     .join(calls.join(rows, "pb").groupBy("tile").agg(F.sum("n").alias("n")), "tile")
                     .select("tile", "sa", F.ceil(F.col("n") / F.lit(CANDIDATES)).cast("int").alias("sb"), "n"))
    total, most = shares.agg(F.sum(F.col("n") * F.col("sa")), F.max("sb")).first()
    every = {s: F.explode(F.sequence(F.lit(0), F.col(s) - 1)) for s in ("sa", "sb")}
    a = a.join(shares, "tile").withColumn("i", F.pmod(F.xxhash64("spot"), F.col("sa")).cast("int")).withColumn("j", every["sb"])
    b = calls.join(b, "pb").join(shares, "tile").withColumn("j", F.pmod(F.xxhash64("neighbour"), F.col("sb")).cast("int")).withColumn("i", every["sa"])
    schema = pa.schema([("spot", pa.int64()), ("distance", pa.float64()), ("neighbour", pa.int64()), ("rank", pa.int32())])

    def measure(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        spot, kids, at = mine.column("spot").to_numpy(), mine.column("child").to_numpy(), _xyz(mine)
        name, cells, there = theirs.column("neighbour").to_numpy(), theirs.column("cells").to_numpy(), _xyz(theirs, "b_")
        out = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int32))]
        for kid in np.unique(kids):
            own, called = np.nonzero(kids == kid)[0], np.nonzero(cells >> int(kid) & 1)[0]
            if not len(called):
                continue
            for i, j, d in _blocks([c[called] for c in there], [c[own] for c in at]):
                if len(called) > need:
                    r, c = np.nonzero(d <= np.partition(d, need - 1, axis=1)[:, need - 1:need])
                else:
                    r, c = (v.ravel() for v in np.indices(d.shape))
                order = np.lexsort((name[called[c]], d[r, c], r))
                r, c = r[order], c[order]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                r, c, rank = (v[rank < need] for v in (r, c, rank))
                out.append((spot[own[i:j]][r], d[r, c], name[called[c]], (rank + 1).astype(np.int32)))
        return pa.table([np.concatenate(v) for v in zip(*out)], schema=schema)

    tasks = max(total or 0, ROWS * spots.sparkSession.sparkContext.defaultParallelism)
    keys = ["tile", "i", "j"]
    a = _in_tasks(a.select(*keys, "spot", "child", *AXES), tasks, *keys)
    b = _in_tasks(b.select(*keys, "neighbour", "cells", *[f"b_{c}" for c in AXES]), tasks, *keys)
    best = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(measure, "spot long, distance double, neighbour long, rank int")
    if (most or 0) > 1:
        again = Window.partitionBy("spot").orderBy("distance", "neighbour")
        best = best.withColumn("rank", F.row_number().over(again)).filter(F.col("rank") <= need)
    return best


def nearest(left: DataFrame, right: DataFrame, k: int = 1, exclude_self: bool = False,
            leaf: int = LEAF) -> DataFrame:
    """left.id, neighbour, distance, rank for the k nearest right points (ties to the smaller id).

    Cell boxes are compared top down: a left cell keeps the right cells whose smallest distance
    does not exceed the distance within which it certainly finds k points."""
    need = k + 1 if exclude_self else k
    spots = durable(distinct_points(left).select(F.col("id").alias("spot"), *AXES))
    copies = right.select("id", *AXES).withColumn(
        "__c", F.row_number().over(Window.partitionBy(*AXES).orderBy("id"))).filter(F.col("__c") <= need).drop("__c")
    copies = durable(copies)
    low, size, rows = bounds(spots, copies)
    if not rows:
        return left.select("id").limit(0).select("id", F.lit(0).cast("long").alias("neighbour"), F.lit(0.0).alias("distance"), F.lit(1).alias("rank"))
    depth = settled_depth(rows, leaf, low, size, (spots, []), (copies, []))
    cell = fine_cell(low, size, depth)
    la = node_levels(spots, [], cell, depth, F.lit(1))
    lb = node_levels(copies, [], cell, depth, F.lit(1))
    pairs, met = None, 1
    for level in range(1, depth + 1):
        a, b = _side(la[level], "a"), _side(lb[level], "b")
        if pairs is None:
            # the first level's cells meet under their common parent: at most 8 x 8 pairs
            joined = a.join(b, coarser(F.col("a_cell")) == coarser(F.col("b_cell")))
        else:
            joined = pairs.join(a, F.col("pa") == coarser(F.col("a_cell"))).join(b, F.col("pb") == coarser(F.col("b_cell")))
        joined = joined.select("a_cell", "b_cell", "b_n", _gap2().alias("near"), _reach2().alias("far"))
        joined = _in_tasks(joined, 64 * met, "a_cell")
        by_far = Window.partitionBy("a_cell").orderBy("far", "b_cell").rowsBetween(Window.unboundedPreceding, 0)
        joined = joined.withColumn("__upto", F.sum("b_n").over(by_far))
        bound = F.min(F.when(F.col("__upto") >= need, F.col("far"))).over(Window.partitionBy("a_cell"))
        joined = joined.withColumn("__bound", bound).filter("__bound is null or near <= __bound")
        pairs = durable(joined.select(F.col("a_cell").alias("pa"), F.col("b_cell").alias("pb")))
        met = pairs.count()
    best = _nearest_in_tiles(spots, copies, pairs, cell, need)
    best = best.join(spots, "spot").drop("spot")
    rows_out = left.select("id", *AXES).join(best, list(AXES)).select("id", "neighbour", "distance", "rank")
    if exclude_self:
        again = Window.partitionBy("id").orderBy("distance", "neighbour")
        rows_out = rows_out.filter("neighbour <> id").withColumn("rank", F.row_number().over(again)).filter(F.col("rank") <= k)
    return rows_out


def median_spacing(points: DataFrame) -> DataFrame:
    """One row: the median distance from a point to its nearest other point."""
    near = nearest(points, points, 1, exclude_self=True)
    return quantiles(near, [], {"d": F.col("distance")}, {"p50": 0.5}).select(F.col("d_p50").alias("spacing"))


def pair_estimate(points: DataFrame, r: float) -> float:
    """An upper bound of the pairs within r, from cell counts alone (one aggregate)."""
    low, _, rows = bounds(points)
    cells = points.select(*[c.alias(n) for c, n in zip(cell_of(low, r), ("cx", "cy", "cz"))]).groupBy("cx", "cy", "cz").agg(F.count(F.lit(1)).alias("n"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k"))
                      for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    spread = cells.select(F.explode(steps).alias("s"), "*").select(
        (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"), (F.col("cz") + F.col("s.k")).alias("cz"), F.col("n").cast("double").alias("m"))
    total = spread.join(cells, ["cx", "cy", "cz"]).agg(F.sum(F.col("m") * F.col("n"))).first()[0] or 0.0
    return max(0.0, (total - rows) / 2)


#: probes of a sampled estimate; each meets the rows of 27 cells
PROBES = 1000


def sampled_pairs(points: DataFrame, r: float, probes: int = PROBES, seed: int = 0) -> tuple[float, float]:
    """(estimate, error) of the pairs within r: half the rows times the mean number of other rows within
    r of a probe, and its standard error times 1.96. Probes are the ``probes`` rows with the smallest
    seeded hash of their id, so a rerun asks the same ones; they are few and sent to every task, where
    the rows of their cells are counted in place. All rows as probes give the exact number."""
    low, size, rows = bounds(points)
    if rows < 2:
        return 0.0, 0.0
    edge = max(r, size / (1 << (_BITS - 2)))
    cells = [c.alias(n) for c, n in zip(cell_of([l - edge for l in low], edge), ("cx", "cy", "cz"))]
    base = points.select("id", *AXES, *cells)
    asked = durable(base.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(probes))
    around = asked.select(F.col("id").alias("probe"), *[F.col(c).alias(f"a_{c}") for c in AXES], *[
        F.sequence(F.col(c) - 1, F.col(c) + 1).alias(c) for c in ("cx", "cy", "cz")])
    for c in ("cx", "cy", "cz"):
        around = around.withColumn(c, F.explode(c))
    near = base.select(F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in AXES], "cx", "cy", "cz").join(F.broadcast(around), ["cx", "cy", "cz"])
    count = near.filter((F.col("b") != F.col("probe")) & (F.sqrt(distance2("a_", "b_")) <= r)).groupBy("probe").agg(F.count(F.lit(1)).alias("n"))
    every = asked.select(F.col("id").alias("probe")).join(count, "probe", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    m = every.agg(F.avg("n").alias("mean"), F.coalesce(F.stddev_samp("n"), F.lit(0.0)).alias("dev"), F.count(F.lit(1)).alias("k")).first()
    spread = m["dev"] * math.sqrt(max(0.0, (rows - m["k"]) / max(1, rows - 1)) / m["k"])
    return m["mean"] * rows / 2, 1.96 * spread * rows / 2


def radius_pairs(points: DataFrame, r: float, budget: float | None = None, hot_cell: int = 20_000) -> DataFrame:
    """(a, b, w) for every two points with distance <= r, a < b. The pairs are the result, so the
    budget guards against asking for more than is wanted; crowded cells are salted. It is compared with
    a sampled estimate where the bound from cell counts alone does not settle it."""
    if budget is not None and pair_estimate(points, r) > budget:
        likely, error = sampled_pairs(points, r)
        if likely > budget:
            raise PairBudgetExceeded(f"r={r:g}: about {likely:.3g} pairs (+- {error:.2g}) exceed the budget of {budget:.3g}")
    low, size, _ = bounds(points)
    edge = max(r, size / (1 << (_BITS - 2)))
    cells = cell_of([l - edge for l in low], edge)
    base = points.select("id", *AXES, *[c.alias(n) for c, n in zip(cells, ("cx", "cy", "cz"))])
    b = base.select(F.col("id").alias("b"), pack(F.col("cx"), F.col("cy"), F.col("cz")).alias("cell"), *[F.col(c).alias(f"b_{c}") for c in AXES])
    half = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) >= (0, 0, 0)]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i, j, k in half])
    a = base.select(F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in AXES], "cx", "cy", "cz", F.explode(steps).alias("s"))
    own = (F.col("s.i") == 0) & (F.col("s.j") == 0) & (F.col("s.k") == 0)
    a = a.select("a", *[f"a_{c}" for c in AXES], own.alias("own"),
                 pack(F.col("cx") + F.col("s.i"), F.col("cy") + F.col("s.j"), F.col("cz") + F.col("s.k")).alias("cell"))
    crowded = b.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_cell)
    crowded = durable(crowded.select("cell", F.ceil(F.col("n") / F.lit(hot_cell)).cast("int").alias("salts")))
    if crowded.isEmpty():
        joined = a.join(b, "cell")
    else:
        # at most rows / hot_cell crowded cells, hence the broadcast
        b = b.join(F.broadcast(crowded), "cell", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        a = a.join(F.broadcast(crowded), "cell", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
        joined = a.join(b, ["cell", "salt"])
    keep = (~F.col("own") | (F.col("a") < F.col("b"))) & (distance2("a_", "b_") <= F.lit(r) * F.lit(r) * (1 + 1e-12))
    near = joined.filter(keep).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.sqrt(distance2("a_", "b_")).alias("w"))
    return near.filter(F.col("w") <= r)


def closest_between(points: DataFrame, label: str, pairs: DataFrame | None = None, leaf: int = LEAF) -> DataFrame:
    """(la, lb, distance, a, b): smallest distance between every two labels (or the given la < lb
    pairs). Boxes of both labels are refined together and dropped once they cannot beat the best
    distance their pair is already sure of."""
    spots = durable(points.groupBy(F.col(label).alias("label"), *AXES).agg(F.min("id").alias("id")))
    low, size, _ = bounds(spots)
    if pairs is None:
        names = spots.agg(F.array_sort(F.collect_set("label")).alias("ls"))
        pairs = names.select(F.explode("ls").alias("la"), "ls").select("la", F.explode("ls").alias("lb")).filter("la < lb")
    pairs = durable(pairs.select("la", "lb"))
    biggest = spots.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    depth = settled_depth(biggest, leaf, low, size, (spots, ["label"]))
    cell = fine_cell(low, size, depth)
    levels = node_levels(spots, ["label"], cell, depth, F.lit(1))
    live = pairs.select("la", "lb", F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb"))
    for level in range(1, depth + 1):
        a, b = _side(levels[level], "a"), _side(levels[level], "b")
        joined = live.join(a, (F.col("la") == F.col("a_label")) & (F.col("pa") == coarser(F.col("a_cell")))) \
            .join(b, (F.col("lb") == F.col("b_label")) & (F.col("pb") == coarser(F.col("b_cell"))))
        joined = durable(joined.select("la", "lb", F.col("a_cell").alias("pa"), F.col("b_cell").alias("pb"), _gap2().alias("near"), _reach2().alias("far")))
        best = joined.groupBy("la", "lb").agg(F.min("far").alias("best"))
        live = durable(joined.join(best, ["la", "lb"]).filter(F.col("near") <= F.col("best") * (1 + 1e-12)).select("la", "lb", "pa", "pb"))
    a = spots.select(F.col("label").alias("la"), cell.alias("pa"), F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in AXES])
    b = spots.select(F.col("label").alias("lb"), cell.alias("pb"), F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in AXES])
    met = live.join(a, ["la", "pa"]).join(b, ["lb", "pb"])
    return met.groupBy("la", "lb").agg(F.min(F.struct(distance2("a_", "b_").alias("d"), "a", "b")).alias("m")) \
        .select("la", "lb", F.sqrt("m.d").alias("distance"), "m.a", "m.b")


def components_at(points: DataFrame, r: float, pair_work: int = 4_000_000, by: tuple[str, ...] = ()) -> DataFrame:
    """(id, component): single-linkage pieces at radius r (<=), named by their smallest id; with ``by`` only
    rows equal in these columns are linked.

    Cells are so small (side r / sqrt 3) that one cell is always one piece, so cells, not points,
    are the vertices. Neighbouring cells are joined outright when their boxes are near enough,
    dropped when too far, and otherwise decided by their own rows; pairs with too many rows are
    first split into sub-cells."""
    spots = durable(points.groupBy(*by, *AXES).agg(F.min("id").alias("id")))
    low, size, _ = bounds(spots)
    edge = r / math.sqrt(3.0) * (1 - 1e-9)
    # coordinates are bounded by 2**20 cells a side for packing; finer radii use a hash of the cell
    cells = [c.alias(n) for c, n in zip(cell_of(low, edge), ("cx", "cy", "cz"))]
    base = spots.select("*", *cells)
    boxes = base.groupBy(*by, "cx", "cy", "cz").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("v"),
        *[F.min(c).alias(f"lo_{c}") for c in AXES], *[F.max(c).alias(f"hi_{c}") for c in AXES])
    boxes = durable(boxes)
    half = [(i, j, k) for i in range(-2, 3) for j in range(-2, 3) for k in range(-2, 3) if (i, j, k) > (0, 0, 0)]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i, j, k in half])
    a = _side(boxes, "a").withColumn("s", F.explode(steps))
    a = a.withColumn("jx", F.col("a_cx") + F.col("s.i")).withColumn("jy", F.col("a_cy") + F.col("s.j")).withColumn("jz", F.col("a_cz") + F.col("s.k")).drop("s")
    b = _side(boxes, "b")
    same = (F.col("jx") == F.col("b_cx")) & (F.col("jy") == F.col("b_cy")) & (F.col("jz") == F.col("b_cz"))
    for c in by:
        same = same & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    met = a.join(b, same)
    met = met.filter(_gap2() <= F.lit(r * r) * (1 + 1e-9))
    met = durable(met.select("a_v", "b_v", (_reach2() <= F.lit(r * r)).alias("sure"), (F.col("a_n") * F.col("b_n")).alias("work")))
    sure = met.filter("sure").select(F.col("a_v").alias("a"), F.col("b_v").alias("b"))
    open_pairs = met.filter("not sure").select("a_v", "b_v")
    member = base.join(boxes.select(*by, "cx", "cy", "cz", "v"), [*by, "cx", "cy", "cz"]).select("id", "v", *by, *AXES)
    heavy = met.filter(~F.col("sure")).agg(F.max("work")).first()[0] or 0
    if heavy > pair_work:
        # crowded cells: what the sure edges already connect needs no closer look
        known = durable(connected_components(sure, boxes.select(F.col("v").alias("id"))))
        ka = known.select(F.col("id").alias("a_v"), F.col("component").alias("ca"))
        kb = known.select(F.col("id").alias("b_v"), F.col("component").alias("cb"))
        open_pairs = durable(open_pairs.join(ka, "a_v").join(kb, "b_v").filter("ca <> cb").select("a_v", "b_v"))
    found = _touching(member, open_pairs, r, pair_work, heavy > pair_work)
    pieces = connected_components(sure.union(found), boxes.select(F.col("v").alias("id")))
    labelled = member.join(pieces.withColumnRenamed("id", "v"), "v").select(*by, *AXES, F.col("id").alias("spot"), F.col("component").alias("c"))
    names = labelled.groupBy("c").agg(F.min("spot").alias("component"))
    labelled = labelled.join(names, "c").select(*by, *AXES, "component")
    return points.select("id", *by, *AXES).join(labelled, [*by, *AXES]).select("id", "component")


def _touching(member: DataFrame, pairs: DataFrame, r: float, pair_work: int, crowded: bool) -> DataFrame:
    """(a, b) of the vertex pairs that have two rows within r. Each round halves the cells of pairs
    whose row product is too large; a pair is settled by the first sub-pair that certainly touches."""
    settled = None
    nodes = member.withColumn("sub", F.lit(0).cast("long"))
    live = pairs.select("a_v", "b_v", F.lit(0).cast("long").alias("a_sub"), F.lit(0).cast("long").alias("b_sub"))
    low, edge, rounds = bounds(member)[0] if crowded else None, r, 0
    while crowded:
        box = nodes.groupBy("v", "sub").agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"lo_{c}") for c in AXES], *[F.max(c).alias(f"hi_{c}") for c in AXES])
        seen = live.join(_side(box, "a"), ["a_v", "a_sub"]).join(_side(box, "b"), ["b_v", "b_sub"])
        seen = durable(seen.filter(_gap2() <= F.lit(r * r) * (1 + 1e-9)).select(
            "a_v", "b_v", "a_sub", "b_sub", (_reach2() <= F.lit(r * r)).alias("sure"), (F.col("a_n") * F.col("b_n")).alias("work")))
        done = seen.filter("sure").select("a_v", "b_v").distinct()
        settled = done if settled is None else settled.union(done)
        live = seen.join(done, ["a_v", "b_v"], "left_anti")
        rounds += 1
        if rounds > 16 or (live.agg(F.max("work")).first()[0] or 0) <= pair_work:
            break
        edge /= 2.0
        sub = F.xxhash64(*cell_of(low, edge))
        fine = durable(nodes.select("id", "v", *AXES, F.col("sub").alias("up"), sub.alias("sub")))
        kids = fine.select("v", "up", "sub").distinct()
        ka = kids.select(F.col("v").alias("a_v"), F.col("up").alias("a_sub"), F.col("sub").alias("na"))
        kb = kids.select(F.col("v").alias("b_v"), F.col("up").alias("b_sub"), F.col("sub").alias("nb"))
        live = live.join(ka, ["a_v", "a_sub"]).join(kb, ["b_v", "b_sub"]).select("a_v", "b_v", F.col("na").alias("a_sub"), F.col("nb").alias("b_sub"))
        nodes = fine.drop("up")
    a = nodes.select(F.col("v").alias("a_v"), F.col("sub").alias("a_sub"), *[F.col(c).alias(f"a_{c}") for c in AXES])
    b = nodes.select(F.col("v").alias("b_v"), F.col("sub").alias("b_sub"), *[F.col(c).alias(f"b_{c}") for c in AXES])
    close = live.join(a, ["a_v", "a_sub"]).join(b, ["b_v", "b_sub"]).filter(distance2("a_", "b_") <= F.lit(r * r))
    out = close.select("a_v", "b_v").distinct()
    out = out.union(settled) if crowded else out
    return out.select(F.col("a_v").alias("a"), F.col("b_v").alias("b"))


#: rows of a cell that one task holds against the rows around it
SHARE = 20_000


def _cells_and_steps(points: DataFrame, r: float) -> tuple[list[Column], Column]:
    """Cell numbers of side r, and the 27 steps to a cell and its neighbours."""
    low, size, _ = bounds(points)
    edge = max(r, size / (1 << (_BITS - 2))) * (1 + 1e-9)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    return cell_of([l - edge for l in low], edge), steps


def _shares(points: DataFrame, cells: list[Column], share: int) -> tuple[DataFrame, DataFrame]:
    """(rows, tiles): points with their cell, in shares of a bounded number of rows, and (cell, shares)."""
    rows = points.withColumn("cell", pack(*cells))
    tiles = durable(rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(share)).cast("int").alias("shares")))
    return rows.join(tiles, "cell").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int")).drop("shares"), tiles


def _around(rows: DataFrame, cells: list[Column], steps: Column, tiles: DataFrame) -> DataFrame:
    """rows once in every share of their own and the neighbouring cells that hold points."""
    out = rows.select("*", *[c.alias(n) for c, n in zip(cells, ("cx", "cy", "cz"))], F.explode(steps).alias("s"))
    out = out.select(*rows.columns, pack(F.col("cx") + F.col("s.i"), F.col("cy") + F.col("s.j"), F.col("cz") + F.col("s.k")).alias("cell"))
    return out.join(tiles, "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")


def _xyz(t: pa.Table, side: str = "") -> list[np.ndarray]:
    return [t.column(side + c).to_numpy() for c in AXES]


def _blocks(mine: list[np.ndarray], other: list[np.ndarray], size: int = 1 << 21):
    """(from, to, distances) of bounded blocks of the other rows against all of mine."""
    step = max(1, size // max(1, len(mine[0])))
    for i in range(0, len(other[0]), step):
        d = [o[i:i + step, None] - m[None] for m, o in zip(mine, other)]
        yield i, i + step, np.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])


def geodesic_within(points: DataFrame, sources: DataFrame, r: float, share: int = SHARE) -> DataFrame:
    """(id, dist): shortest path length from any sources.id in the graph that links points(id, x, y, z) at
    distance <= r, for the points it reaches. As graph.geodesic on radius_pairs, but links are never
    written: the points improved in a round go to the cells around them and are measured there, so what
    is shuffled and written grows with the points."""
    points = durable(points.select("id", *AXES))
    cells, steps = _cells_and_steps(points, r)
    rows, tiles = _shares(points, cells, share)
    begin = sources.select("id").distinct().withColumn("moved", F.lit(True))
    state = durable(rows.join(begin, "id", "left").select("cell", "share", "id", *AXES, F.when(F.col("moved"), 0.0).otherwise(float("inf")).alias("dist"), F.coalesce("moved", F.lit(False)).alias("moved")))

    def relax(mine: pa.Table, front: pa.Table) -> pa.Table:
        dist, at, there, far = mine.column("dist").to_numpy(), _xyz(mine), _xyz(front, "b_"), front.column("far").to_numpy()
        best = dist
        for i, j, w in _blocks(at, there):
            best = np.minimum(best, np.where(w <= r, far[i:j, None] + w, np.inf).min(0))
        return mine.set_column(mine.schema.get_field_index("dist"), "dist", pa.array(best)).set_column(
            mine.schema.get_field_index("moved"), "moved", pa.array(best < dist))

    while True:
        front = state.filter("moved").select("id", *AXES, "dist")
        if front.isEmpty():
            return state.filter("dist < double('infinity')").select("id", "dist")
        near = _around(front, cells, steps, tiles).select("cell", "share", *[F.col(c).alias(f"b_{c}") for c in AXES], F.col("dist").alias("far"))
        state = durable(state.groupBy("cell", "share").cogroup(near.groupBy("cell", "share")).applyInArrow(relax, state.schema))


def linked_groups(points: DataFrame, group: str, r: float, share: int = SHARE) -> DataFrame:
    """(a, b), a < b: two values of a bigint column of points(id, x, y, z, group) with some members within r of each other."""
    points = durable(points.select("id", *AXES, F.col(group).cast("long").alias("g")))
    cells, steps = _cells_and_steps(points, r)
    rows, tiles = _shares(points, cells, share)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(mine: pa.Table, other: pa.Table) -> pa.Table:
        g, o, found = mine.column("g").to_numpy(), other.column("b_g").to_numpy(), set()
        # only other groups are measured, each value against the rest
        for v in np.unique(o):
            theirs, own = [c[o == v] for c in _xyz(other, "b_")], [c[g > v] for c in _xyz(mine)]
            names, hit = g[g > v], np.zeros(int((g > v).sum()), bool)
            for _, _, w in _blocks(own, theirs) if len(names) else ():
                hit |= (w <= r).any(0)
            found |= {(int(v), int(n)) for n in np.unique(names[hit])}
        return pa.table([pa.array([f[k] for f in sorted(found)], pa.int64()) for k in (0, 1)], schema=schema)

    near = _around(points, cells, steps, tiles).select("cell", "share", *[F.col(c).alias(f"b_{c}") for c in (*AXES, "g")])
    return rows.groupBy("cell", "share").cogroup(near.groupBy("cell", "share")).applyInArrow(pairs, "a long, b long").distinct()


def _block_tree(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spanning-tree edges one bounded block can be sure of. A block edge is certain when, for one
    of the two pieces it joins, it is the shortest way out and no longer than the distance from
    that piece to the block's open faces (cut property)."""
    ids, xyz = pdf["id"].to_numpy(), pdf[list(AXES)].to_numpy()
    room = pdf["room"].to_numpy().copy()
    n = len(ids)
    comp = np.arange(n)
    edges = []
    if n > 1:
        best, via, todo = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
        at = 0
        todo[0] = False
        for _ in range(n - 1):
            d = np.sqrt(((xyz - xyz[at]) ** 2).sum(1))
            closer = todo & (d < best)
            best[closer], via[closer] = d[closer], at
            at = int(np.argmin(np.where(todo, best, np.inf)))
            todo[at] = False
            edges.append((best[at], int(via[at]), at))
    parent = list(range(n))

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    kept = []
    for w, i, j in sorted(edges):
        a, b = find(i), find(j)
        if w < room[a] or w < room[b]:
            kept.append((min(ids[i], ids[j]), max(ids[i], ids[j]), w))
            parent[b] = a
            room[a] = min(room[a], room[b])
        else:
            room[a] = room[b] = -1.0
    for v in range(n):
        comp[v] = ids[find(v)]
    out = pd.DataFrame({"kind": "point", "a": ids, "b": comp, "w": 0.0})
    tree = pd.DataFrame(kept, columns=["a", "b", "w"]).astype({"a": "int64", "b": "int64", "w": "float64"})
    tree.insert(0, "kind", "edge")
    return pd.concat([out, tree], ignore_index=True)


def euclidean_tree(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, w): the Euclidean minimum spanning tree of the distinct coordinates, each named by
    its smallest id.

    Blocks of bounded size find the edges they can be sure of side by side; what is left is joined
    by Boruvka rounds at doubling distances: neighbouring cells of different pieces, closest pair
    per piece by bounded box refinement, contract."""
    spots = durable(distinct_points(points).select("id", *AXES))
    low, size, rows = bounds(spots)
    if rows < 2:
        return spots.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("w")).limit(0)
    depth = 0 if rows <= block else depth_for(rows, block)
    while True:
        cell = fine_cell(low, size, depth)
        fullest = spots.groupBy(cell).count().agg(F.max("count")).first()[0]
        if fullest <= block or depth == _BITS - 1:
            break
        depth += 1
    side = size / (1 << depth)
    room = F.lit(float("inf"))
    top = (1 << depth) - 1
    for c, l in zip(AXES, low):
        at = F.least(F.floor((F.col(c) - F.lit(l)) / F.lit(side)), F.lit(top))
        left = F.when(at <= 0, F.lit(float("inf"))).otherwise(F.col(c) - (F.lit(l) + at * side))
        right = F.when(at >= top, F.lit(float("inf"))).otherwise(F.lit(l) + (at + 1) * side - F.col(c))
        room = F.least(room, left, right)
    # a margin keeps rounding at the faces from certifying an edge
    local = spots.select("id", *AXES, cell.alias("cell"), (room - F.lit(size * 1e-9)).alias("room"))
    solved = durable(local.groupBy("cell").applyInPandas(_block_tree, "kind string, a long, b long, w double"))
    trees = [solved.filter("kind = 'edge'").select("a", "b", "w")]
    piece = durable(spots.join(shuffled(solved.filter("kind = 'point'").select(F.col("a").alias("id"), F.col("b").alias("piece"))), "id"))
    # a cell of this side holds no more rows than a block does
    reach = side / 4
    while not piece.agg(F.min("piece") == F.max("piece")).first()[0]:
        found = _closest_pieces(piece, low, size, reach)
        if found.isEmpty():
            reach *= 2
            continue
        # the shortest way out of each piece, ties by (w, a, b)
        ends = found.select(F.col("la").alias("p"), "e").union(found.select(F.col("lb").alias("p"), "e"))
        chosen = durable(ends.groupBy("p").agg(F.min("e").alias("e")).select("e").distinct())
        picks = found.join(shuffled(chosen), "e", "left_semi")
        merged = connected_components(picks.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        merged = merged.select(F.col("id").alias("piece"), F.col("component").alias("np"))
        trees.append(chosen.select("e.a", "e.b", "e.w"))
        piece = durable(piece.join(shuffled(merged), "piece", "left").select("id", *AXES, F.coalesce("np", "piece").alias("piece")))
    out = trees[0]
    for t in trees[1:]:
        out = out.union(t)
    return out


def _closest_pieces(piece: DataFrame, low: list[float], size: float, reach: float) -> DataFrame:
    """(la, lb, e = (w, a, b)): closest rows of every two pieces that come within reach. Pieces in
    neighbouring cells of side ``reach`` meet; boxes that cannot beat the pair's certain distance
    are dropped while the cells are halved."""
    edge = max(reach, size / (1 << (_BITS - 2)))
    cells = [F.floor((F.col(c) - F.lit(l)) / F.lit(edge)).cast("long") for c, l in zip(AXES, low)]
    rows = piece.select("id", "piece", *AXES, *[c.alias(n) for c, n in zip(cells, ("cx", "cy", "cz"))])
    box = rows.groupBy("piece", "cx", "cy", "cz").agg(*[F.min(c).alias(f"lo_{c}") for c in AXES], *[F.max(c).alias(f"hi_{c}") for c in AXES])
    box = durable(box)
    span = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i, j, k in span])
    # cells whose surroundings hold one piece only are the bulk: leave them out before pairing
    near = box.select(F.explode(steps).alias("s"), "*").select(
        (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"), (F.col("cz") + F.col("s.k")).alias("cz"), "piece")
    mixed = near.groupBy("cx", "cy", "cz").agg(F.min("piece").alias("p0"), F.max("piece").alias("p1")).filter("p0 <> p1").select("cx", "cy", "cz")
    border = box.join(shuffled(mixed), ["cx", "cy", "cz"], "left_semi")
    a = _side(border, "a").withColumn("s", F.explode(steps))
    a = a.withColumn("jx", F.col("a_cx") + F.col("s.i")).withColumn("jy", F.col("a_cy") + F.col("s.j")).withColumn("jz", F.col("a_cz") + F.col("s.k")).drop("s")
    b = _side(border, "b")
    limit = F.lit(reach * reach)
    met = a.join(shuffled(b), (F.col("jx") == F.col("b_cx")) & (F.col("jy") == F.col("b_cy")) & (F.col("jz") == F.col("b_cz")) & (F.col("a_piece") < F.col("b_piece")))
    met = met.withColumn("near", _gap2()).withColumn("far", _reach2()).filter(F.col("near") <= limit)
    met = durable(met.select(F.col("a_piece").alias("la"), F.col("b_piece").alias("lb"), "near", "far",
                             *[F.col(f"a_{c}") for c in ("cx", "cy", "cz")], *[F.col(f"b_{c}") for c in ("cx", "cy", "cz")]))
    best = met.groupBy("la", "lb").agg(F.min("far").alias("best"))
    met = met.join(shuffled(best), ["la", "lb"]).filter(F.col("near") <= F.col("best") * (1 + 1e-12))
    # finer cells inside each side, again bounded by the pair's certain distance
    sub = F.xxhash64(*[F.floor((F.col(c) - F.lit(l)) / F.lit(edge / 8)).cast("long") for c, l in zip(AXES, low)])
    rows = rows.withColumn("sub", sub)
    fine = rows.groupBy("piece", "cx", "cy", "cz", "sub").agg(*[F.min(c).alias(f"lo_{c}") for c in AXES], *[F.max(c).alias(f"hi_{c}") for c in AXES])
    fa = _side(fine, "a").withColumnRenamed("a_piece", "la")
    fb = _side(fine, "b").withColumnRenamed("b_piece", "lb")
    deep = met.drop("near", "far").join(shuffled(fa), ["la", "a_cx", "a_cy", "a_cz"]).join(shuffled(fb), ["lb", "b_cx", "b_cy", "b_cz"])
    deep = durable(deep.withColumn("near", _gap2()).withColumn("far", _reach2()).filter((F.col("near") <= F.col("best") * (1 + 1e-12)) & (F.col("near") <= limit))
                   .select("la", "lb", "near", "far", "a_cx", "a_cy", "a_cz", "b_cx", "b_cy", "b_cz", "a_sub", "b_sub"))
    best = deep.groupBy("la", "lb").agg(F.min("far").alias("best"))
    deep = deep.join(shuffled(best), ["la", "lb"]).filter(F.col("near") <= F.col("best") * (1 + 1e-12))
    ra = rows.select(F.col("piece").alias("la"), *[F.col(c).alias(f"a_{c}") for c in ("cx", "cy", "cz", "sub", *AXES)], F.col("id").alias("ia"))
    rb = rows.select(F.col("piece").alias("lb"), *[F.col(c).alias(f"b_{c}") for c in ("cx", "cy", "cz", "sub", *AXES)], F.col("id").alias("ib"))
    full = deep.select("la", "lb", "a_cx", "a_cy", "a_cz", "b_cx", "b_cy", "b_cz", "a_sub", "b_sub") \
        .join(shuffled(ra), ["la", "a_cx", "a_cy", "a_cz", "a_sub"]).join(shuffled(rb), ["lb", "b_cx", "b_cy", "b_cz", "b_sub"])
    edge_row = F.struct(F.sqrt(distance2("a_", "b_")).alias("w"), F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"))
    out = full.filter(distance2("a_", "b_") <= limit).groupBy("la", "lb").agg(F.min(edge_row).alias("e"))
    return durable(out)


def radius_sweep(tree: DataFrame, points: DataFrame, radii: dict[str, float], min_size: int, top: int = 8) -> DataFrame:
    """Per radius: components, components of at least min_size, singletons and the largest sizes,
    all from the edges of one spanning tree over distinct coordinates."""
    spots = durable(distinct_points(points))
    parts = []
    for name, r in radii.items():
        comp = connected_components(tree.filter(F.col("w") <= r).select("a", "b"), spots.select("id"))
        size = comp.join(shuffled(spots.select("id", "copies")), "id").groupBy("component").agg(F.sum("copies").alias("size"))
        parts.append(size.select(F.lit(name).alias("mult"), F.lit(float(r)).alias("radius"), "size"))
    sizes = parts[0]
    for p in parts[1:]:
        sizes = sizes.union(p)
    ranked = sizes.withColumn("__k", F.row_number().over(Window.partitionBy("mult").orderBy(F.desc("size"))))
    tops = ranked.filter(F.col("__k") <= top).groupBy("mult").agg(F.sort_array(F.collect_list("size"), asc=False).alias("tops"))
    stats = sizes.groupBy("mult", "radius").agg(
        F.count(F.lit(1)).alias("components"), F.count_if(F.col("size") >= min_size).alias("components_ge"),
        F.count_if(F.col("size") == 1).alias("singletons"))
    return stats.join(tops, "mult").select("mult", "radius", "components", "components_ge", "singletons",
                                           F.array_join("tops", ",").alias("top_sizes"))


def expand_unclustered(points: DataFrame, base: DataFrame, within: float) -> DataFrame:
    """points(id, x, y, z, label) outside ``base`` whose nearest base point is within the distance:
    unlabelled ones (-1) are added, labelled ones only counted per label by the caller."""
    inside = points.join(base.select("id"), "id", "left_semi")
    outside = points.join(base.select("id"), "id", "left_anti")
    near = nearest(outside, inside).filter(F.col("distance") <= within)
    return near.join(points.select("id", "label"), "id").select("id", "label", "distance", (F.col("label") == -1).alias("added"))


def attach_faint(faint: DataFrame, kept: DataFrame, selected: DataFrame, r: float) -> DataFrame:
    """Faint rows whose nearest kept point lies within r and is selected."""
    near = nearest(faint, kept).filter(F.col("distance") <= r)
    return near.join(selected.select(F.col("id").alias("neighbour")), "neighbour", "left_semi").select("id", "neighbour", "distance")


def isolation(rows: DataFrame, others: DataFrame, r: float) -> DataFrame:
    """Nearest unselected distance and unselected rows within 1, 2, 4 and 8 radii."""
    near = nearest(others, rows)
    return near.agg(F.min("distance").alias("nearest_unselected"),
                    *[F.count_if(F.col("distance") <= k * r).alias(f"within_{k}r") for k in (1, 2, 4, 8)])
