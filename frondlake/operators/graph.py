"""Graph iteration as joins and aggregates: components, spanning trees, distances, paths.

Every loop keeps its state in DataFrames and cuts the lineage with a reliable checkpoint; the
driver sees only counts. Vertices are bigint ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from frondlake.operators.ordered import Ordered, ordered
from frondlake.session import durable, shuffled


def edge_key(a: Column, b: Column) -> Column:
    """Undirected edge name, smaller id first (compared as numbers)."""
    return F.concat_ws("-", F.least(a, b).cast("string"), F.greatest(a, b).cast("string"))


def undirected(edges: DataFrame, *extra: str) -> DataFrame:
    """Each edge in both directions."""
    flipped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), *extra)
    return edges.select("a", "b", *extra).unionByName(flipped)


def _contracted(kind: pa.DataType):
    schema = pa.schema([("v", kind), ("p", kind)])

    def run(batches):
        """(v, p) for every end of the edges of all batches: p is the same one vertex in a whole component."""
        edges = pa.Table.from_batches(list(batches))
        ends = pa.chunked_array(edges.column("a").chunks + edges.column("b").chunks, kind).combine_chunks().dictionary_encode()
        ends = ends.combine_chunks() if isinstance(ends, pa.ChunkedArray) else ends
        x, y = np.split(ends.indices.to_numpy(), 2)
        first = np.arange(len(ends.dictionary))
        while True:
            x, y = first[x], first[y]
            x, y = x[x != y], y[x != y]
            if not len(x):
                break
            np.minimum.at(first, np.maximum(x, y), np.minimum(x, y))
            while (first[first] != first).any():
                first = first[first]
        yield from pa.table([ends.dictionary, ends.dictionary.take(pa.array(first))], schema=schema).to_batches(max_chunksize=100_000)

    return run


def connected_components(edges: DataFrame, vertices: DataFrame | None = None, whole: int = 0) -> DataFrame:
    """(id, component) for every end of edges(a, b) and every vertices.id; a component is named by
    its smallest id. Each round every vertex points at the neighbour with the smallest random
    priority, pointers are doubled, and the graph is contracted, so rounds are logarithmic in any
    numbering and the edge list shrinks geometrically. Once at most ``whole`` edges are left, one task
    contracts them at once."""
    live = durable(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    ids = live.select(F.col("a").alias("id")).union(live.select(F.col("b").alias("id")))
    if vertices is not None:
        ids = ids.union(vertices.select("id"))
    roots = ids.distinct().withColumn("root", F.col("id"))
    turn = 0
    while not live.isEmpty():
        turn += 1
        if whole and live.count() <= whole:
            kind = live.schema["a"].dataType
            up = durable(live.repartition(1).mapInArrow(_contracted(to_arrow_type(kind)), f"v {kind.simpleString()}, p {kind.simpleString()}"))
            roots = durable(roots.join(shuffled(up.withColumnRenamed("v", "root")), "root", "left").select("id", F.coalesce("p", "root").alias("root")))
            break

        def order(c, turn=turn):
            return F.struct(F.xxhash64(c, F.lit(turn)), c)

        best = undirected(live).groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        up = best.select(F.col("a").alias("v"), F.when(order(F.col("a")) <= F.col("m"), F.col("a"))
                         .otherwise(F.col("m.b")).alias("p"))
        up = durable(up)
        over = up.select(F.col("v").alias("p"), F.col("p").alias("q"))
        up = up.join(shuffled(over), "p").select("v", F.col("q").alias("p"))
        roots = roots.join(shuffled(up.select(F.col("v").alias("root"), "p")), "root", "left") \
            .select("id", F.coalesce("p", "root").alias("root"))
        if turn % 4 == 0:
            roots = durable(roots)
        left = up.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        right = up.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        live = durable(live.join(shuffled(left), "a").join(shuffled(right), "b").filter("pa <> pb")
                       .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    # written, so that the join of a very large component is between two shuffles and can be split
    names = durable(roots.groupBy("root").agg(F.min("id").alias("component")))
    return roots.join(shuffled(names), "root").select("id", "component")


def number_by_size(labels: DataFrame, component: str = "component", member: str = "id") -> DataFrame:
    """(component, size, label): labels count from 0 by decreasing size, then first member.
    Sizes are counted first, so only one row per component is ordered."""
    sizes = labels.groupBy(component).agg(F.count(F.lit(1)).alias("size"), F.min(member).alias("first"))
    ranked = ordered(sizes.withColumn("__neg", -F.col("size")), [], ["__neg", "first"], Ordered(rank="__rank"))
    return ranked.select(component, "size", (F.col("__rank") - 1).alias("label"))


def suppress_small(sizes: DataFrame, min_size: int) -> DataFrame:
    """Labels of components below min_size become -1."""
    return sizes.withColumn("label", F.when(F.col("size") < min_size, F.lit(-1)).otherwise(F.col("label")))


def spanning_tree(edges: DataFrame) -> DataFrame:
    """Minimum spanning forest of edges(a, b, w). Boruvka: each component takes its smallest
    outgoing edge (ties by (w, a, b), which makes the choice acyclic), then contracts."""
    base = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w") \
        .groupBy("a", "b").agg(F.min("w").alias("w"))
    live = durable(base.select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.struct("w", "a", "b").alias("e")))
    taken = []
    while not live.isEmpty():
        ends = live.select(F.col("ca").alias("c"), "e").union(live.select(F.col("cb").alias("c"), "e"))
        chosen = durable(ends.groupBy("c").agg(F.min("e").alias("e")))
        picks = live.join(chosen.select("e").distinct(), "e", "left_semi")
        merged = durable(connected_components(picks.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
        taken.append(chosen.select("e.a", "e.b", "e.w").distinct())
        left = merged.select(F.col("id").alias("ca"), F.col("component").alias("na"))
        right = merged.select(F.col("id").alias("cb"), F.col("component").alias("nb"))
        live = live.join(left, "ca").join(right, "cb").filter("na <> nb")
        live = durable(live.groupBy(F.least("na", "nb").alias("ca"), F.greatest("na", "nb").alias("cb")).agg(F.min("e").alias("e")))
    if not taken:
        return base.limit(0)
    tree = taken[0]
    for t in taken[1:]:
        tree = tree.union(t)
    return tree


def geodesic(edges: DataFrame, sources: DataFrame, fold: int = 8) -> DataFrame:
    """(id, dist): shortest path length over undirected edges(a, b, w) from any sources.id.
    Only vertices improved in a round relax their edges in the next, and a round writes only what it
    improved; every ``fold`` rounds the improvements are folded into one table."""
    both = durable(undirected(edges, "w"))
    front = durable(sources.select("id", F.lit(0.0).alias("dist")).distinct())
    known, pieces = front, 1
    while True:
        step = front.join(both, front["id"] == both["a"]).select(F.col("b").alias("id"), (F.col("dist") + F.col("w")).alias("via"), F.lit(None).cast("double").alias("dist"))
        held = known.select("id", F.lit(None).cast("double").alias("via"), "dist")
        front = durable(step.union(held).groupBy("id").agg(F.min("via").alias("via"), F.min("dist").alias("dist"))
                        .filter("via is not null and (dist is null or via < dist)").select("id", F.col("via").alias("dist")))
        if front.isEmpty():
            return known.groupBy("id").agg(F.min("dist").alias("dist"))
        known, pieces = known.union(front), pieces + 1
        if pieces == fold:
            known, pieces = durable(known.groupBy("id").agg(F.min("dist").alias("dist"))), 1


def level_nodes(edges: DataFrame, dist: DataFrame, width: float) -> DataFrame:
    """(id, bin, node): connected pieces of each distance bin; a node is named by its smallest id."""
    bins = dist.select("id", F.floor(F.col("dist") / F.lit(width)).cast("long").alias("bin"))
    left = bins.select(F.col("id").alias("a"), F.col("bin").alias("ba"))
    right = bins.select(F.col("id").alias("b"), F.col("bin").alias("bb"))
    inside = edges.join(left, "a").join(right, "b").filter("ba = bb").select("a", "b")
    pieces = connected_components(inside, bins)
    return bins.join(pieces, "id").select("id", "bin", F.col("component").alias("node"))


def rooted(tree: DataFrame, root: DataFrame) -> DataFrame:
    """(id, parent, depth, dist) of a tree(a, b, w) hung from root.id, for the vertices it reaches.

    The arcs of both directions form one tour, in which the arc u-v is followed by v's next
    neighbour after u. Pointer doubling ranks the tour from the root's first arc, and of the two arcs of an edge
    the earlier one leads down. Depth and distance then double along the parents. Rounds grow with the logarithm of the vertices, whatever
    the shape of the tree."""
    arcs = durable(undirected(tree.filter("a <> b"), "w"))
    start = root.select(F.col("id").alias("a")).limit(1)
    first = arcs.groupBy("a").agg(F.min("b").alias("first"))
    # the neighbour after each neighbour, in a window that survives a hub
    turn = ordered(arcs.select("a", "b"), ["a"], ["b"], Ordered(leads={"then": F.col("b")})).join(first, "a") \
        .select(F.col("b").alias("ta"), F.col("a").alias("tb"), F.coalesce("then", "first").alias("tn"))
    begin = first.join(start, "a").select(F.col("a").alias("sa"), F.col("first").alias("sb"))
    ends = durable(turn.join(begin, (F.col("tb") == F.col("sa")) & (F.col("tn") == F.col("sb")), "left_anti")
                   .select(F.col("ta").alias("a"), F.col("tb").alias("b"), F.col("tb").alias("na"), F.col("tn").alias("nb")))
    # steps to the end of the tour; arcs of other trees go round for ever and are left out
    jump = durable(arcs.select("a", "b").join(ends, ["a", "b"], "left")
                   .select("a", "b", "na", "nb", F.when(F.col("na").isNull(), 0).otherwise(1).cast("long").alias("rank")))
    reach, arcs_in_all = 1, jump.count()
    while reach < arcs_in_all and not jump.filter("na is not null").isEmpty():
        on = jump.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("na").alias("fa"), F.col("nb").alias("fb"), F.col("rank").alias("far"))
        jump = durable(jump.join(on, ["na", "nb"], "left").select("a", "b", F.col("fa").alias("na"), F.col("fb").alias("nb"),
                                                                  (F.col("rank") + F.coalesce("far", F.lit(0))).alias("rank")))
        reach *= 2
    ranked = jump.filter("na is null").select("a", "b", "rank")
    back = ranked.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("rank").alias("back"))
    down = ranked.join(back, ["a", "b"]).filter("rank > back").join(arcs, ["a", "b"]) \
        .select(F.col("b").alias("id"), F.col("a").alias("parent"), "w")
    hung = root.select("id", F.lit(None).cast("long").alias("parent"), F.lit(0.0).alias("w")).unionByName(down)
    up = durable(hung.select("id", "parent", F.col("parent").alias("to"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"), F.col("w").alias("dist")))
    while not up.filter("to is not null").isEmpty():
        on = up.select(F.col("id").alias("to"), F.col("to").alias("far"), F.col("depth").alias("d"), F.col("dist").alias("s"))
        up = durable(up.join(on, "to", "left").select(
            "id", "parent", F.col("far").alias("to"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"),
            (F.col("dist") + F.coalesce("s", F.lit(0.0))).alias("dist")))
    return up.select("id", "parent", "depth", "dist")


def on_the_way(hung: DataFrame, targets: DataFrame) -> DataFrame:
    """(id): every vertex on the way from any targets.id up to the root, both ends included, each
    once. Pointer doubling over the set, so long stems take logarithmically many rounds."""
    jump = durable(hung.filter("parent is not null").select("id", F.col("parent").alias("to")))
    found = durable(targets.select("id").distinct())
    while not jump.isEmpty():
        found = durable(found.union(found.join(jump, "id").select(F.col("to").alias("id"))).distinct())
        on = jump.select(F.col("id").alias("to"), F.col("to").alias("far"))
        jump = durable(jump.join(on, "to").select("id", F.col("far").alias("to")))
    return found


def insertions(hung: DataFrame, targets: DataFrame, stem: DataFrame) -> DataFrame:
    """Per target: the last stem vertex on its root path, that vertex's distance from the root and
    the path length from there to the target. Every vertex points at itself on the stem, else at its
    parent; doubled pointers arrive at the stem, one row per vertex at any time."""
    on_stem = stem.select("id").distinct().withColumn("stop", F.lit(True))
    base = hung.join(on_stem, "id", "left").withColumn("stop", F.coalesce("stop", F.lit(False)))
    jump = durable(base.select("id", F.when(F.col("stop"), F.col("id")).otherwise(F.col("parent")).alias("to"), "stop").filter("to is not null"))
    while not jump.filter("not stop").isEmpty():
        on = jump.select(F.col("id").alias("to"), F.col("to").alias("far"), F.col("stop").alias("there"))
        jump = durable(jump.join(on, "to").select("id", F.col("far").alias("to"), F.col("there").alias("stop")))
    place = hung.select(F.col("id").alias("insertion"), F.col("dist").alias("along_stem"))
    end = hung.select(F.col("id").alias("target"), F.col("dist").alias("end"))
    return targets.select(F.col("id").alias("target")).join(jump.select(F.col("id").alias("target"), F.col("to").alias("insertion")), "target") \
        .join(place, "insertion").join(end, "target").select("target", "insertion", "along_stem", (F.col("end") - F.col("along_stem")).alias("branch_length"))


def join_radii(tree: DataFrame, groups: DataFrame, ways: int = 8) -> DataFrame:
    """(ga, gb, radius): for every two groups(id, tag) the smallest r at which some member of each
    falls into one component of tree(a, b, w) with w <= r (0 when they share a member).

    The range of weights is cut into bands, in all open ranges at once. A band's edges are kept
    between the components that the lighter edges of its range form, and tags move to those
    components. A band of one weight is done: tags that its edges bring together have that radius at
    most, and each pair keeps the smallest it was given. Rounds grow with the logarithm of the number
    of different weights; nothing is solved in one task."""
    tags = groups.select("id", F.col("tag").cast("string").alias("tag")).distinct()
    held = durable(tags.select(F.lit(0).cast("long").alias("k"), "id", "tag"))
    edges = durable(tree.filter("a <> b").select(F.lit(0).cast("long").alias("k"), "a", "b", F.col("w").cast("double").alias("w")))
    pair = (F.col("l.tag") < F.col("r.tag"))

    def met(df: DataFrame, spot: list[str], radius: Column) -> DataFrame:
        same = pair
        for c in spot:
            same = same & (F.col(f"l.{c}") == F.col(f"r.{c}"))
        return df.alias("l").join(df.alias("r"), same).select(
            F.col("l.tag").alias("ga"), F.col("r.tag").alias("gb"), radius.alias("radius")).distinct()

    out = [met(held, ["id"], F.lit(0.0))]
    share = F.array(*[F.lit(i / ways) for i in range(1, ways)])
    while not edges.isEmpty():
        marks = edges.groupBy("k").agg(F.max("w").alias("hi"), F.percentile_approx("w", share, F.lit(1000)).alias("cut"))
        ends = F.array_sort(F.array_distinct(F.concat(F.filter("cut", lambda c: c < F.col("hi")), F.array("hi"))))
        bands = durable(marks.select("k", F.posexplode(ends).alias("j", "top"), F.size(ends).alias("of")))
        here = edges.join(bands, "k").filter(F.col("w") <= F.col("top"))

        def at(v: str) -> Column:
            return F.struct("k", "j", F.col(v).alias("v"))

        # pieces that the edges up to each band's top form, within their range
        comp = connected_components(here.select(at("a").alias("a"), at("b").alias("b")))
        comp = durable(comp.select(F.col("id.k").alias("k"), F.col("id.j").alias("j"), F.col("id.v").alias("id"), F.col("component.v").alias("piece")))
        flat = edges.groupBy("k").agg(F.min("w").alias("lo"), F.max("w").alias("hi")).filter("lo = hi").select("k", "hi")
        done = held.join(comp.filter("j = 0"), ["k", "id"]).join(flat, "k").select("k", "piece", "tag", "hi").distinct()
        out.append(durable(met(done, ["k", "piece"], F.col("l.hi"))))
        under = comp.withColumn("j", F.col("j") + 1)
        band = here.groupBy("k", "a", "b", "w").agg(F.min("j").alias("j")).join(flat.select("k"), "k", "left_anti")
        ua, ub = (under.select("k", "j", F.col("id").alias(v), F.col("piece").alias(f"p{v}")) for v in "ab")
        lifted = band.join(ua, ["k", "j", "a"], "left").join(ub, ["k", "j", "b"], "left").select(
            (F.col("k") * ways + F.col("j")).alias("k"), F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"), "w").filter("a <> b")
        open_ = bands.join(flat.select("k"), "k", "left_anti").select("k", "j")
        moved = held.join(open_, "k").join(under, ["k", "j", "id"], "left").select(
            (F.col("k") * ways + F.col("j")).alias("k"), F.coalesce("piece", "id").alias("id"), "tag").distinct()
        edges = durable(lifted)
        touched = edges.select("k", F.col("a").alias("id")).union(edges.select("k", F.col("b").alias("id"))).distinct()
        held = durable(moved.join(touched, ["k", "id"], "left_semi"))
    found = out[0]
    for o in out[1:]:
        found = found.union(o)
    return found.groupBy("ga", "gb").agg(F.min("radius").alias("radius"))


#: edges whose merges one task replays
REPLAY = 200_000


def _replay(tag_kind: pa.DataType):
    schema = pa.schema([("w", pa.float64()), ("ea", pa.int64()), ("eb", pa.int64()), ("size", pa.int64()), ("large", pa.list_(tag_kind)), ("small", pa.list_(tag_kind))])

    def run(edges: pa.Table, parts: pa.Table) -> pa.Table:
        """Merges of one range in weight order. Every part keeps its members, size, smallest id and tags;
        the side with fewer members is renamed, so a member is renamed log times at most."""
        edges = edges.sort_by([("w", "ascending"), ("ea", "ascending"), ("eb", "ascending")])
        part = {i: i for i in parts.column("id").to_pylist()}
        inside = {i: [i] for i in part}
        facts = {i: (-n, i, set(t)) for i, n, t in zip(parts.column("id").to_pylist(), parts.column("n").to_pylist(), parts.column("tags").to_pylist())}
        rows = []
        for w, ea, eb, a, b in zip(*(edges.column(c).to_pylist() for c in ("w", "ea", "eb", "a", "b"))):
            into, gone = sorted((part[a], part[b]), key=lambda p: len(inside[p]), reverse=True)
            large, small = sorted((facts[into], facts.pop(gone)), key=lambda f: f[:2])
            both = large[2] | small[2]
            if both != large[2] and both != small[2]:
                rows.append((w, ea, eb, -large[0] - small[0], sorted(large[2]), sorted(small[2])))
            for v in inside[gone]:
                part[v] = into
            inside[into] += inside.pop(gone)
            facts[into] = (large[0] + small[0], min(large[1], small[1]), both)
        return pa.table([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)], schema=schema)

    return run


def merge_tree(tree: DataFrame, groups: DataFrame, limit: int = REPLAY) -> DataFrame:
    """(w, ea, eb, size, large, small): the merges of the forest tree(a, b, w), by ascending (w, a, b), in
    which each side holds a tag of groups(id, tag) that the other one lacks: the edge, the number of
    vertices after it and the sorted tags of the larger and of the smaller side (of equal sides, the
    one with the smallest id counts as larger). Other merges bring no two tags together.

    Edges are cut into ranges of the order, all ranges in two at once: the lighter half keeps its
    vertices, the heavier half runs between the pieces that the lighter one forms, which carry sizes
    and tags. Ranges of at most ``limit`` edges are replayed side by side."""
    tags = groups.select("id", F.col("tag").cast("string").alias("tag")).distinct()
    edges = durable(tree.filter("a <> b").select(F.lit(0).cast("long").alias("k"), "a", "b", F.col("w").cast("double").alias("w"),
                                                     F.least("a", "b").alias("ea"), F.greatest("a", "b").alias("eb")))
    ends = edges.select("k", F.col("a").alias("id")).union(edges.select("k", F.col("b").alias("id"))).distinct()
    sizes = durable(ends.withColumn("n", F.lit(1).cast("long")))
    held = durable(ends.join(shuffled(tags), "id").select("k", "id", "tag"))
    out = None
    while True:
        count = durable(edges.groupBy("k").agg(F.count(F.lit(1)).alias("of")))
        ready = count.filter(F.col("of") <= limit).select("k")
        mine = held.join(ready, "k").groupBy("k", "id").agg(F.collect_set("tag").alias("tags"))
        parts = sizes.join(ready, "k").join(shuffled(mine), ["k", "id"], "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
        found = durable(edges.join(ready, "k").select("k", "w", "ea", "eb", "a", "b").groupBy("k").cogroup(parts.select("k", "id", "n", "tags").groupBy("k"))
                        .applyInArrow(_replay(pa.string()), "w double, ea long, eb long, size long, large array<string>, small array<string>"))
        out = found if out is None else out.unionByName(found)
        rest = edges.join(ready, "k", "left_anti")
        if rest.isEmpty():
            return out
        rank = durable(ordered(rest, ["k"], ["w", "ea", "eb"], Ordered(rank="rn", totals={"of": F.lit(1)})))
        light, heavy = rank.filter("rn <= of div 2"), rank.filter("rn > of div 2")
        at = [F.struct("k", F.col(v).alias("v")).alias(v) for v in ("a", "b")]
        comp = connected_components(light.select(*at))
        comp = durable(comp.select(F.col("id.k").alias("k"), F.col("id.v").alias("id"), F.col("component.v").alias("piece")))
        lifted = heavy
        for v in ("a", "b"):
            lifted = lifted.join(shuffled(comp.select("k", F.col("id").alias(v), F.col("piece").alias(f"p{v}"))), ["k", v], "left")
        edges = durable(light.select((F.col("k") * 2).alias("k"), "a", "b", "w", "ea", "eb").unionByName(
            lifted.select((F.col("k") * 2 + 1).alias("k"), F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"), "w", "ea", "eb")))
        met = edges.select("k", F.col("a").alias("id")).union(edges.select("k", F.col("b").alias("id"))).distinct()
        met = durable(met)

        def halves(df: DataFrame, extra: str, comp: DataFrame = comp, ready: DataFrame = ready) -> DataFrame:
            live = df.join(ready, "k", "left_anti")
            up = live.join(shuffled(comp), ["k", "id"], "left").select((F.col("k") * 2 + 1).alias("k"), F.coalesce("piece", "id").alias("id"), extra)
            return live.select((F.col("k") * 2).alias("k"), "id", extra).unionByName(up)

        sizes = durable(halves(sizes, "n").groupBy("k", "id").agg(F.sum("n").alias("n")).join(shuffled(met), ["k", "id"], "left_semi"))
        held = durable(halves(held, "tag").distinct().join(shuffled(met), ["k", "id"], "left_semi"))


def first_meetings(merges: DataFrame, groups: DataFrame) -> DataFrame:
    """(ga, gb, radius, ea, eb): for every two tags the weight and edge of the first merge of merge_tree
    that brings them together; 0 and no edge if they share a member."""
    tags = groups.select("id", F.col("tag").cast("string").alias("tag")).distinct()
    none = F.lit(None).cast("long")
    same = tags.join(tags.withColumnRenamed("tag", "other"), "id").filter("tag < other").select(
        F.col("tag").alias("ga"), F.col("other").alias("gb"), F.struct(F.lit(0.0).alias("w"), none.alias("ea"), none.alias("eb")).alias("m"))
    # tags on both sides have met before
    new = merges.select("w", "ea", "eb", F.explode(F.array_except("large", "small")).alias("x"), F.array_except("small", "large").alias("ys"))
    met = new.select(F.struct("w", "ea", "eb").alias("m"), "x", F.explode("ys").alias("y"))
    both = same.unionByName(met.select(F.least("x", "y").alias("ga"), F.greatest("x", "y").alias("gb"), "m"))
    return both.groupBy("ga", "gb").agg(F.min("m").alias("m")).select("ga", "gb", F.col("m.w").alias("radius"), "m.ea", "m.eb")


def merge_events(merges: DataFrame, meetings: DataFrame) -> DataFrame:
    """The merges of merge_tree that bring some two tags together for the first time, as first_meetings has them."""
    return merges.join(meetings.select("ea", "eb").distinct(), ["ea", "eb"], "left_semi")
