"""Distances between points and line segments, without comparing all of them.

``nearest_segment`` cuts segments into short pieces, boxes pieces and points in one grid and refines
cell pairs from coarse to fine, keeping those whose smallest possible distance does not exceed a
distance that is certain. ``nearest_group`` chooses for each segment the group of points with the
smallest median distance: boxes with their row counts bound every median from both sides, and only
groups whose bounds still reach the best two are measured row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators.ordered import HOT_ROWS, quantiles
from frondlake.operators.spatial import (AXES, LEAF, _boxes, _gap2, _reach2, _side, bounds, coarser, distinct_points, fine_cell, node_levels,
                                         settled_depth)
from frondlake.session import durable

#: pieces beside whole segments, in parts of the points and segments together
PIECES = 1


def to_segment(point: list[Column], start: list[Column], end: list[Column]) -> tuple[Column, Column]:
    """(distance, fraction along the segment) of a point; a segment without length is its start."""
    way, off = [e - s for s, e in zip(start, end)], [p - s for p, s in zip(point, start)]
    fraction = F.coalesce(C.clip(F.try_divide(C.dot(off, way), C.dot(way, way)), 0.0, 1.0), F.lit(0.0))
    return C.length([o - fraction * w for o, w in zip(off, way)]), fraction


def _corners(prefix: str = "") -> tuple[list[Column], list[Column]]:
    return [F.col(f"{prefix}{c}") for c in AXES], [F.col(f"{prefix}b{c}") for c in AXES]


def _finite(segments: DataFrame) -> DataFrame:
    ends = segments.select(*AXES).unionByName(segments.select(*[F.col(f"b{c}").alias(c) for c in AXES]))
    return ends


def pieces_of(segments: DataFrame, longest: float) -> DataFrame:
    """(segment, x, y, z, lo_*, hi_*): equal parts of at most ``longest`` of each segment, by their middle and their box."""
    start, end = _corners()
    parts = F.greatest(F.lit(1), F.ceil(C.length([e - s for s, e in zip(start, end)]) / F.lit(longest))).cast("int")
    cut = segments.withColumn("__m", parts).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__m") - 1)))
    at = [[s + (e - s) * ((F.col("__i") + k) / F.col("__m")) for s, e in zip(start, end)] for k in (0, 1)]
    return cut.select("segment", *[((a + b) / 2).alias(c) for a, b, c in zip(*at, AXES)],
                      *[F.least(a, b).alias(f"lo_{c}") for a, b, c in zip(*at, AXES)], *[F.greatest(a, b).alias(f"hi_{c}") for a, b, c in zip(*at, AXES)])


def nearest_segment(points: DataFrame, segments: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(id, segment, fraction, distance): for each of points(id, x, y, z) the closest of
    segments(segment, x, y, z, bx, by, bz) and where on it, ties to the smaller segment. Equal points
    are measured once. Points or segments without finite coordinates are refused; without points or
    segments there are no rows."""
    start, end = _corners()
    segments = durable(segments.select("segment", *[F.col(c).cast("double").alias(c) for c in (*AXES, *[f"b{c}" for c in AXES])]))
    spots = durable(distinct_points(points).select(F.col("id").alias("spot"), *AXES))
    low, size, rows = bounds(spots, _finite(segments))
    ways = segments.agg(F.sum(C.length([e - s for s, e in zip(start, end)])).alias("l"), F.count(F.lit(1)).alias("n")).first()
    if not ways["n"] or not rows:
        return points.select("id").limit(0).join(segments.select("segment").limit(0)).select(
            "id", "segment", F.lit(0.0).alias("fraction"), F.lit(0.0).alias("distance"))
    longest = max((ways["l"] or 0.0) / (PIECES * (rows + ways["n"])), size / (1 << 19))
    pieces = durable(pieces_of(segments, longest))
    depth = settled_depth(rows, leaf, low, size, (spots, []), (pieces, []))
    cell = fine_cell(low, size, depth)
    la = node_levels(spots, [], cell, depth, F.lit(1))
    lb = [durable(_boxes(pieces.withColumn("cell", cell).withColumn("n", F.lit(1)), ["cell"]))]
    for _ in range(depth):
        lb.insert(0, _boxes(lb[0].withColumn("cell", coarser(F.col("cell"))), ["cell"]))
    pairs = None
    for level in range(1, depth + 1):
        a, b = _side(la[level], "a"), _side(lb[level], "b")
        up = (coarser(F.col("a_cell")), coarser(F.col("b_cell")))
        if pairs is None:
            # one common parent: at most 8 x 8 pairs
            met = a.join(b, up[0] == up[1])
        else:
            met = pairs.join(a, F.col("pa") == up[0]).join(b, F.col("pb") == up[1])
        met = met.withColumn("near", _gap2()).withColumn("sure", F.min(_reach2()).over(Window.partitionBy("a_cell")))
        pairs = durable(met.filter(F.col("near") <= F.col("sure") * (1 + 1e-9)).select(F.col("a_cell").alias("pa"), F.col("b_cell").alias("pb")))
    a = spots.select("spot", cell.alias("pa"), *[F.col(c).alias(f"p{c}") for c in AXES])
    held = durable(pieces.select("segment", cell.alias("pb")).distinct())
    b = held.join(segments, "segment")
    distance, fraction = to_segment([F.col(f"p{c}") for c in AXES], start, end)
    found = a.join(pairs, "pa").join(b, "pb").select("spot", F.struct(distance.alias("distance"), "segment", fraction.alias("fraction")).alias("m"))
    best = found.groupBy("spot").agg(F.min("m").alias("m")).join(spots, "spot").select(*AXES, "m.*")
    return points.select("id", *AXES).join(best, list(AXES)).select("id", "segment", "fraction", "distance")


def _median_bounds(met: DataFrame) -> DataFrame:
    """(segment, group, least, most) from met(segment, group, n, near, far), boxes of n rows of a group:
    at least half of the rows lie no nearer than ``least``, and at least half no farther than ``most``."""
    by = ["segment", "group"]
    of = F.sum("n").over(Window.partitionBy(*by))

    def upto(c: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*by).orderBy(c).rangeBetween(Window.unboundedPreceding, 0))

    half = met.withColumn("__of", of).withColumn("__near", upto("near")).withColumn("__far", upto("far"))
    # the lower middle row bounds from below, the upper middle row from above
    return half.groupBy(*by).agg(F.min(F.when(F.col("__near") * 2 >= F.col("__of"), F.col("near"))).alias("least"),
                                 F.min(F.when(F.col("__far") * 2 > F.col("__of"), F.col("far"))).alias("most"))


def nearest_group(points: DataFrame, segments: DataFrame, keep: int = 2, levels: tuple[int, ...] = (0, 2, 4), hot_rows: int = HOT_ROWS) -> DataFrame:
    """(segment, group, rank, median_distance, points): for each of segments(segment, x, y, z, bx, by, bz)
    the ``keep`` groups of points(id, group, x, y, z) with the smallest median distance to it, ties to
    the smaller group. With a column ``scene`` on both sides only groups of the segment's scene count.

    A segment meets one box per group of its scene, then the boxes of finer grids of the groups that
    are left; a box at distance d from its centre lies within half its diagonal of d. A group leaves
    once its median cannot be below the ``keep``-th smallest upper bound. Points or segments without
    finite coordinates are refused; a null group is a group; empty sides give no rows."""
    scene = "scene" in points.columns and "scene" in segments.columns
    named = F.col("scene") if scene else F.lit(0)
    spots = durable(points.select(named.alias("scene"), "group", *AXES))
    start, end = _corners("s_")
    ways = durable(segments.select("segment", named.alias("scene"), *[F.col(c).cast("double").alias(f"s_{c}") for c in (*AXES, *[f"b{c}" for c in AXES])]))
    low, size, rows = bounds(spots, _finite(segments))
    live = None
    for depth in levels:
        cell = fine_cell(low, size, depth) if depth else F.lit(0).cast("long")
        boxes = spots.groupBy("scene", "group", cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"lo_{c}") for c in AXES], *[F.max(c).alias(f"hi_{c}") for c in AXES])
        met = ways.join(boxes, "scene") if live is None else live.join(ways, ["segment", "scene"]).join(
            boxes.withColumnRenamed("group", "g").withColumnRenamed("scene", "of"), (F.col("scene") == F.col("of")) & F.col("group").eqNullSafe(F.col("g")))
        middle = [(F.col(f"lo_{c}") + F.col(f"hi_{c}")) / 2 for c in AXES]
        half = C.length([F.col(f"hi_{c}") - F.col(f"lo_{c}") for c in AXES]) / 2
        d, _ = to_segment(middle, start, end)
        slack = (d + half) * 1e-9
        met = met.select("segment", "scene", "group", "n", F.greatest(d - half - slack, F.lit(0.0)).alias("near"), (d + half + slack).alias("far"))
        bound = _median_bounds(met.drop("scene")).join(ways.select("segment", "scene"), "segment")
        order = Window.partitionBy("segment").orderBy("most")
        ranked = bound.withColumn("__k", F.row_number().over(order)).withColumn(
            "__cut", F.max(F.when(F.col("__k") == keep, F.col("most"))).over(Window.partitionBy("segment")))
        live = durable(ranked.filter("__cut is null or least <= __cut").select("segment", "scene", "group"))
    rows_of = live.join(ways, ["segment", "scene"]).join(spots.withColumnRenamed("group", "g").withColumnRenamed("scene", "of"),
                                                         (F.col("scene") == F.col("of")) & F.col("group").eqNullSafe(F.col("g")))
    far, _ = to_segment([F.col(c) for c in AXES], start, end)
    each = durable(rows_of.select("segment", "group", far.alias("d")))
    mid = quantiles(each, ["segment", "group"], {"d": F.col("d")}, {"p50": 0.5}, hot_rows)
    count = each.groupBy("segment", "group").agg(F.count(F.lit(1)).alias("points"))
    both = count.alias("c").join(mid.alias("m"), (F.col("c.segment") == F.col("m.segment")) & F.col("c.group").eqNullSafe(F.col("m.group")))
    rank = F.row_number().over(Window.partitionBy("segment").orderBy("median_distance", "group"))
    return both.select("c.segment", "c.group", F.col("m.d_p50").alias("median_distance"), "c.points").withColumn("rank", rank) \
        .filter(F.col("rank") <= keep).select("segment", "group", "rank", "median_distance", "points")
