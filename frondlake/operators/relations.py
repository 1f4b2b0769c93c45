"""Inventory, pairing, overlap and integrity operators over keyed tables."""

from __future__ import annotations

import gc
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from frondlake.operators.graph import connected_components

from frondlake.operators.ordered import HOT_ROWS, Ordered, attach, ordered
from frondlake.session import durable, in_tasks, shuffled


def missing_and_unexpected(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Keys expected but absent and present but not expected, with ``side``. Both sides are reduced
    to distinct keys and counted together, one shuffle for both differences."""
    both = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("p")).unionByName(
        present.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("p")))
    seen = both.groupBy(*keys).agg(F.max("e").alias("e"), F.max("p").alias("p"))
    return seen.filter("e <> p").select(*keys, F.when(F.col("e") == 1, "missing").otherwise("unexpected").alias("side"))


def compare_trees(pred: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Full outer join of two trees with the status of every key."""
    a = pred.withColumn("__p", F.lit(True))
    b = ref.withColumn("__r", F.lit(True))
    j = a.join(b, key, "full_outer")
    status = F.when(F.col("__p").isNull(), "missing_in_pred").when(F.col("__r").isNull(), "missing_in_ref").otherwise("compared")
    return j.withColumn("status", status).drop("__p", "__r")


#: items of an instance that travel with each of them
CARRIED = 64


def overlapping_pairs(members: DataFrame, share: float, hot_rows: int = HOT_ROWS, carried: int = CARRIED) -> DataFrame:
    """(a, b, common, overlap) for instances from different photos whose common items reach
    ``share`` of the smaller one. members has instance, photo, item.

    Prefix filtering: to reach the share, the smaller instance must have one of its rarest
    n - ceil(share * n) + 1 items in common, so only those meet the other side's items. Items held
    by very many instances are in almost nobody's prefix. Both sides bring their items, rarest first,
    so a pair is counted where it meets and kept at its rarest common item only; no candidate is moved.
    Each side's items are also marks in 64 bits: a mark the larger side lacks is an item it lacks, so most candidates
    go before their items are compared. Instances of more than ``carried`` rows do not travel: their pairs as the
    larger side are counted by joins. members is read several times: give a written table."""
    m = members.select("instance", "photo", "item")
    # repeated rows count too: any order of the items serves
    freq = m.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
    sizes = m.groupBy("instance").agg(F.count(F.lit(1)).alias("n"), F.min("photo").alias("p0"), F.max("photo").alias("p1"))
    long = durable(sizes.filter((F.col("n") > carried) | (F.col("p0") != F.col("p1"))).select("instance"))
    ranked, any_long = m.join(freq, "item"), not long.isEmpty()
    if any_long:
        ranked = durable(ranked.distinct())
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64("item"), F.lit(64)).cast("int"))
    by = F.sort_array(F.collect_set(F.struct("freq", "item")))
    short = ranked.join(long, "instance", "left_anti").groupBy("instance").agg(F.min("photo").alias("photo"), by.alias("items"), F.bit_or(mark).alias("marks"))
    short = durable(short.select("instance", "photo", F.col("items.item").alias("items"), F.size("items").cast("long").alias("n"), "marks"))
    # a share of n that is whole must not be lifted by rounding
    need = F.greatest(F.ceil(F.col("n") * share - 1e-9), F.lit(1)).cast("int")
    a = short.select(F.posexplode(F.slice("items", F.lit(1), (F.col("n") - need + 1).cast("int"))).alias("at", "item"), F.col("instance").alias("small"),
                     F.col("photo").alias("pa"), F.col("items").alias("ia"), F.col("n").cast("int").alias("na"), need.alias("need"), F.col("marks").alias("ma"))
    b = short.select(F.posexplode("items").alias("bt", "item"), F.col("instance").alias("large"), F.col("photo").alias("pb"), F.col("items").alias("ib"),
                     F.col("n").cast("int").alias("nb"), F.col("marks").alias("mb"))
    na, nb = F.col("na"), F.col("nb")
    # what follows the rarest common item on either side must reach the share
    met = a.join(b, "item").filter((nb - F.col("bt") >= F.col("need")) & (F.bit_count(F.col("ma").bitwiseAND(F.bitwise_not("mb"))) <= na - F.col("need")))
    met = met.filter((F.col("small") != F.col("large")) & (F.col("pa") != F.col("pb")) & ((na < nb) | ((na == nb) & (F.col("small") < F.col("large")))))
    # as a generator the comparison stays out of the join's condition, where it would stand several times and be too long a method for the JVM to compile
    met = met.select("item", "small", "large", "na", F.explode(F.array(F.array_intersect("ia", "ib"))).alias("both")).filter(F.get("both", F.lit(0)) == F.col("item"))
    common = met.select("small", "large", F.col("na").cast("long").alias("na"), F.size("both").cast("long").alias("common"))
    if any_long:
        common = common.unionByName(_long_overlaps(ranked, long, share, hot_rows))
    kept = common.withColumn("overlap", F.col("common") / F.col("na")).filter(F.col("overlap") >= share)
    return kept.select(F.least("small", "large").alias("a"), F.greatest("small", "large").alias("b"), "common", "overlap")


def _long_overlaps(rows: DataFrame, long: DataFrame, share: float, hot_rows: int) -> DataFrame:
    """(small, large, na, common) of pairs with an instance of ``long`` at one side at least, by joins on
    rows(instance, photo, item, freq)."""
    ranked = durable(ordered(rows, ["instance"], ["freq", "item"], Ordered(rank="pos", totals={"n": F.lit(1)}), hot_rows)
                     .join(long.withColumn("long", F.lit(True)), "instance", "left").withColumn("long", F.coalesce("long", F.lit(False))))
    prefix = ranked.filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1)

    def met_by(small, large):
        a = small.select("item", F.col("instance").alias("small"), F.col("photo").alias("pa"), F.col("n").alias("na"))
        b = large.select("item", F.col("instance").alias("large"), F.col("photo").alias("pb"), F.col("n").alias("nb"))
        return a.join(b, "item").filter("small <> large and pa <> pb and (na < nb or (na = nb and small < large))").select("small", "large", "na")

    met = met_by(prefix, ranked.filter("long")).unionByName(met_by(prefix.filter("long"), ranked.filter("not long"))).distinct()
    items = rows.select("item", F.col("instance").alias("small"))
    other = rows.select("item", F.col("instance").alias("large"))
    return met.join(items, "small").join(other, ["large", "item"]).groupBy("small", "large", "na").agg(F.count(F.lit(1)).alias("common"))


#: pairs of small components that one task settles together
MERGE_PAIRS = 200_000
#: pairs of one component that a task settles at once
WHOLE_PAIRS = 2_000_000
#: pairs between two renumberings of a task's clusters
RUN_PAIRS = 100_000
#: a photo set becomes a byte a photo when it holds more than one in so many, and more than as many
SPARSE = 64


class _Held:
    """Photos by cluster number, from two columns of numbers ordered by cluster."""

    def __init__(self, photo: np.ndarray, start: np.ndarray):
        self.photo, self.start = photo, start

    def __getitem__(self, c: int) -> list[int]:
        return self.photo[self.start[c]:self.start[c + 1]].tolist()


def _clash(p, q) -> bool:
    """Whether two photos, photo sets or bytes by photo have one in common."""
    if type(p) is int:
        p, q = q, p
    if type(q) is int:
        return p == q if type(p) is int else q in p if type(p) is set else p[q]
    if type(p) is set:
        return not p.isdisjoint(q) if type(q) is set else any(map(q.__getitem__, p))
    if type(q) is set:
        return any(map(p.__getitem__, q))
    p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
    # large sets mostly clash early
    return bool((p[:4096] & q[:4096]).any() or (p & q).any())


def _joined(p, q, kinds: int):
    """Both of them in one, the smaller one moved into the larger."""
    if type(p) is int or type(p) is set and (type(q) is bytearray or type(q) is set and len(p) < len(q)):
        p, q = q, p
    if type(p) is int:
        return {p, q}
    if type(q) is int:
        q = (q,)
    if type(p) is set:
        p.update(q)
        if len(p) <= max(SPARSE, kinds // SPARSE):
            return p
        p, q = bytearray(kinds), p
    if type(q) is not bytearray:
        for i in q:
            p[i] = 1
    else:
        whole = np.frombuffer(p, np.uint8)
        np.bitwise_or(whole, np.frombuffer(q, np.uint8), out=whole)
    return p


def _reciprocal_merges(first, second, names, photos) -> dict:
    """{cluster: name after merging} for pairs given heaviest first by the numbers of their clusters.

    At its turn a pair is the heaviest one left at both of its clusters: it merges them, or their
    photos clash, and then for good. So of the pairs between two clusters only the heaviest counts, and pairs
    go in runs: before each, clusters get the numbers they have by now and all pairs that became inner
    or repeated go at once. A cluster's photos are gathered when it first comes up; one photo is no set. Photos are numbers from 0, in sets,
    or bitmaps of a few."""
    first, second, n = np.asarray(first, np.int64), np.asarray(second, np.int64), len(names)
    if isinstance(photos, _Held):
        kinds = int(photos.photo.max(initial=-1)) + 1
        lone = np.where(np.diff(photos.start) == 1, photos.photo[np.minimum(photos.start[:-1], len(photos.photo) - 1)], -1) if n else np.empty(0, int)
    else:
        photos = [{i for i in range(p.bit_length()) if p >> i & 1} if isinstance(p, int) else p for p in photos]
        kinds = max((max(p, default=-1) + 1 for p in photos), default=0)
        lone = np.array([min(p) if len(p) == 1 else -1 for p in photos], np.int64)
    now, title, grown = np.arange(n), np.arange(n), {}
    for start in range(0, len(first), RUN_PAIRS):
        x, y = now[first[start:start + RUN_PAIRS]], now[second[start:start + RUN_PAIRS]]
        x, y = x[x != y], y[x != y]
        _, kept = np.unique(np.minimum(x, y) * n + np.maximum(x, y), return_index=True)
        kept.sort()
        known, ends = np.unique(np.concatenate([x[kept], y[kept]]), return_inverse=True)
        if not len(known):
            continue
        numbers, slot, apart = known.tolist(), list(range(len(known))), set()
        named, held = title[known].tolist(), [None if p < 0 else p for p in lone[known].tolist()]
        for i, j in zip(ends[:len(kept)].tolist(), ends[len(kept):].tolist()):
            while slot[i] != i:
                slot[i] = i = slot[slot[i]]
            while slot[j] != j:
                slot[j] = j = slot[slot[j]]
            if i == j or (i, j) in apart or (j, i) in apart:
                continue
            p, q = held[i], held[j]
            if p is None:
                p = held[i] = grown.get(numbers[i]) or set(photos[numbers[i]])
            if q is None:
                q = held[j] = grown.get(numbers[j]) or set(photos[numbers[j]])
            if _clash(p, q):
                apart.add((i, j))
                continue
            # the larger cluster stays, so that what it clashed with is still known; the pair's first one gives the name
            both, name = _joined(p, q, kinds), named[i]
            keep, gone = (j, i) if both is q else (i, j)
            held[keep], held[gone], slot[gone], named[keep] = both, None, keep, name
        moved = np.array(slot)
        while (moved[moved] != moved).any():
            moved = moved[moved]
        lost = np.flatnonzero(moved != np.arange(len(moved)))
        for c in lost.tolist():
            grown.pop(numbers[c], None)
        larger = np.unique(moved[lost])
        lone[known[larger]] = -1
        for c in larger.tolist():
            grown[numbers[c]] = held[c]
        title[known] = np.array(named)[moved]
        step = np.arange(n)
        step[known] = known[moved]
        now = step[now]
    last = title[now]
    return {names[c]: names[last[c]] for c in np.flatnonzero(last != np.arange(n)).tolist()}


def _settle_block(kind: pa.DataType, turn: list[str], ends: tuple[str, str]):
    """The merges (cluster, into) of one block's pairs, by descending ``turn``; pairs of clusters without photos take no part."""
    schema = pa.schema([("cluster", kind), ("into", kind)])

    def run(pairs: pa.Table, views: pa.Table) -> pa.Table:
        names = views.column("cluster").combine_chunks().unique()
        x, y = (pc.index_in(pairs.column(end), value_set=names).fill_null(-1).to_numpy() for end in ends)
        if all(pa.types.is_integer(f.type) or pa.types.is_floating(f.type) for f in pairs.select(turn).schema):
            order = np.lexsort([pairs.column(c).to_numpy() for c in reversed(turn)])[::-1]
        else:
            order = pc.sort_indices(pairs, sort_keys=[(c, "descending") for c in turn]).to_numpy()
        order = order[(x[order] >= 0) & (y[order] >= 0)]
        cluster = pc.index_in(views.column("cluster"), value_set=names).to_numpy()
        photo = views.column("photo").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        at = np.argsort(cluster, kind="stable")
        held = _Held(photo[at], np.searchsorted(cluster[at], np.arange(len(names) + 1)))
        # millions of photo sets and no cycle among them: the collector would walk them over and over
        gc.disable()
        try:
            moved = _reciprocal_merges(x[order], y[order], range(len(names)), held)
        finally:
            gc.enable()
        old, new = (pa.array(v, pa.int64()) for v in (list(moved), list(moved.values())))
        return pa.table([names.take(old), names.take(new)], schema=schema)

    return run


def _settled(pairs: DataFrame, views: DataFrame, tasks: int, block: str, turn: list[str], ends: tuple[str, str]) -> DataFrame:
    """(cluster, into), written: pairs(block, turn, ends) settled with views(block, cluster, photo), a block in one of ``tasks``."""
    kind = views.schema["cluster"].dataType
    name = kind.simpleString()
    # dealt by blocks: merged by bytes, the large ones would stand in line
    left, right = pairs.select(block, *turn, *(e for e in ends if e not in turn)).repartition(tasks, block), views.select(block, "cluster", "photo").repartition(tasks, block)
    return durable(left.groupBy(block).cogroup(right.groupBy(block))
                   .applyInArrow(_settle_block(to_arrow_type(kind), turn, ends), f"cluster {name}, into {name}"))


def _settle_long(pairs: DataFrame, held: DataFrame, limit: int, rows: int, tasks: int) -> DataFrame:
    """(instance, cluster) of held(component, instance, photo) after the ``rows`` pairs(component, w, a, b) of ``tasks`` components
    above ``limit`` had their turn: about ``limit`` of each component at a time, the heaviest ones first."""
    # parts follow one another in the order of a component's turns
    parts = math.ceil(rows / max(1, limit // 4))
    dealt = pairs.select("component", "w", "a", "b").repartitionByRange(parts, "component", F.desc("w"), F.desc("a"), F.desc("b"))
    dealt = durable(dealt.withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("component", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("component").orderBy("part")) - F.col("n")
    turns = durable(sizes.select("component", "part", F.floor(before / F.lit(limit)).alias("turn")))
    bounds = sorted(turns.groupBy("turn").agg(F.min("part").alias("low"), F.max("part").alias("high")).collect())
    now = durable(held.select("instance", F.col("instance").alias("cluster")).distinct())
    views = durable(held.select("component", F.col("instance").alias("cluster"), "photo"))
    for turn, low, high in bounds:
        live = dealt.filter(F.col("part").between(low, high)).join(turns.filter(F.col("turn") == turn).drop("turn"), ["component", "part"], "left_semi")
        live = live.join(shuffled(now.toDF("a", "ca")), "a").join(shuffled(now.toDF("b", "cb")), "b")
        live = durable(live.filter("ca <> cb").select("component", "w", "a", "b", "ca", "cb"))
        touched = live.select(F.col("ca").alias("cluster")).union(live.select(F.col("cb").alias("cluster"))).distinct()
        into = _settled(live, views.join(shuffled(touched), "cluster", "left_semi"), tasks, "component", ["w", "a", "b"], ("ca", "cb"))
        now = durable(now.join(into, "cluster", "left").select("instance", F.coalesce("into", "cluster").alias("cluster")))
        if turn != bounds[-1][0]:
            views = durable(views.join(into, "cluster", "left").select("component", F.coalesce("into", "cluster").alias("cluster"), "photo"))
    return now


def agglomerate(instances: DataFrame, pairs: DataFrame, limit: int = WHOLE_PAIRS) -> DataFrame:
    """(instance, cluster): merge pairs(a, b, overlap) in descending (overlap, a, b), never joining
    clusters that share a photo; the cluster of the pair's first instance gives the name.

    Components of the pair graph do not see each other and are settled side by side, small ones together, one
    of up to ``limit`` pairs whole. A larger one goes by shares of about ``limit`` pairs, heaviest first: between two shares instances take
    the names of their clusters. So a task has about ``limit`` pairs with the photo sets of their clusters, and jobs grow with the
    quotient of the largest component and ``limit``. A component is found with four times as many edges in a task, which have no photos.
    Instances in no pair keep their own name; pairs of unknown instances, or without overlap, take no part."""
    held = durable(instances.select("instance", "photo").distinct())
    able = durable(pairs.filter("overlap is not null and a <> b").select(F.col("overlap").alias("w"), "a", "b"))
    n, pack = able.count(), min(limit, MERGE_PAIRS)
    views = held.withColumnRenamed("instance", "cluster")
    if n <= pack:
        into = _settled(able.withColumn("block", F.lit(0)), views.withColumn("block", F.lit(0)), 1, "block", ["w", "a", "b"], ("a", "b"))
        return _renamed(held, into)
    part = durable(connected_components(able.select("a", "b"), whole=4 * limit).toDF("cluster", "component"))
    live = durable(able.join(part.toDF("a", "component"), "a"))
    large = durable(live.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > pack))
    # a component above ``pack`` is a block of its own
    digest = F.xxhash64("component")
    block = F.when(F.col("n").isNotNull(), digest).otherwise(F.pmod(digest, F.lit(-(-n // pack)))).alias("block")
    small = F.col("n").isNull() | (F.col("n") <= limit)
    sight = views.join(part, "cluster").join(large, "component", "left")
    into = _settled(live.join(large, "component", "left").filter(small).select(block, "w", "a", "b"),
                    sight.filter(small).select(block, "cluster", "photo"), -(-n // pack), "block", ["w", "a", "b"], ("a", "b"))
    long = large.filter(F.col("n") > limit)
    rows, longs = long.agg(F.sum("n"), F.count("n")).first()
    if longs:
        long = long.select("component")
        mine = sight.filter(F.col("n") > limit).select("component", F.col("cluster").alias("instance"), "photo")
        into = into.unionByName(_settle_long(live.join(long, "component"), mine, limit, rows, longs).toDF("cluster", "into"))
    return _renamed(held, into)


def _renamed(held: DataFrame, into: DataFrame) -> DataFrame:
    """(instance, cluster): instances with the name that into(cluster, into) has for them, or their own."""
    own = held.select("instance").distinct()
    return own.join(into.withColumnRenamed("cluster", "instance"), "instance", "left").select("instance", F.coalesce("into", "instance").alias("cluster"))


def vote_argmax(votes: DataFrame, key: str, choice: str) -> DataFrame:
    """(key, choice, votes, total, conf): most voted choice per key, ties to the smallest."""
    counts = votes.groupBy(key, choice).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.struct(choice, "n"), F.struct(F.col("n"), (-F.col(choice)).alias("c")))
    return counts.groupBy(key).agg(best.alias("m"), F.sum("n").alias("total")).select(
        key, F.col(f"m.{choice}").alias(choice), F.col("m.n").alias("votes"), "total", (F.col("m.n") / F.col("total")).alias("conf"))


def changed_settings(recorded: DataFrame, current: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Keys whose recorded and current values differ, absent ones as null."""
    a = recorded.select(*keys, F.col(value).alias("recorded"))
    b = current.select(*keys, F.col(value).alias("current"))
    return a.join(b, keys, "full_outer").filter(~F.col("recorded").eqNullSafe(F.col("current")))


def violations(rules: dict[str, DataFrame], key: str) -> DataFrame:
    """(rule, subject): one row per broken rule instance; each rule frame holds the offenders."""
    parts = [df.select(F.lit(rule).alias("rule"), F.col(key if key in df.columns else df.columns[0]).cast("string").alias("subject"))
             for rule, df in rules.items()]
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str, rows: int | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent; ``rows`` of the larger table, counted if not given. A task
    holds its parents' keys only: child rows stream past them unsorted, so a hot key costs no memory."""
    rows = max(child.count(), parent.count()) if rows is None else rows
    there = in_tasks(parent.select(F.col(pk).alias(fk)), rows, fk).distinct()
    return in_tasks(child, rows, fk).join(there.hint("shuffle_hash"), fk, "left_anti")


def duplicates(df: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """(keys, n) of the keys that more than one row has; ``rows`` of df, counted if not given."""
    rows = df.count() if rows is None else rows
    return in_tasks(df.select(*keys), rows, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def same_columns(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: matched rows and, per column, whether every pair is identical (nulls equal)."""
    j = a.select(key, *[F.col(c).alias(f"a_{c}") for c in columns]).join(b.select(key, *[F.col(c).alias(f"b_{c}") for c in columns]), key)
    return j.agg(F.count(F.lit(1)).alias("rows"), *[F.bool_and(F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(c) for c in columns])


def fingerprint(df: DataFrame, keys: list[str], order: list[str], line: Column, block: int = 4096,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """sha256 over a key's ordered lines as a tree of digests: ``block`` lines make a digest, ``block``
    digests the digest above, until one is left. There are two levels at least, so a key of any
    length has the same definition and no task holds a whole key."""

    def level(rows: DataFrame) -> DataFrame:
        """rows(keys, __rn, __line) -> the digests of runs of ``block`` of them."""
        run = F.floor((F.col("__rn") - 1) / F.lit(block))
        parts = rows.groupBy(*keys, run.alias("__c")).agg(F.array_sort(F.collect_list(F.struct(F.col("__rn").alias("i"), F.col("__line").alias("t")))).alias("__rows"))
        text = F.concat_ws("", F.transform("__rows", lambda r: r["t"]))
        return parts.select(*keys, (F.col("__c") + 1).alias("__rn"), F.sha2(text, 256).alias("__line"))

    placed = ordered(df.select(*keys, *order, line.alias("__line")), keys, order, Ordered(rank="__rn"), hot_rows)
    done, rest = None, level(placed)
    while True:
        rest = durable(level(rest))
        many = rest.filter("__rn > 1").select(*keys).distinct()
        top = attach(rest, many.withColumn("__more", F.lit(True)), keys) if keys else rest.crossJoin(rest.agg((F.max("__rn") > 1).alias("__more")))
        ready = top.filter("not coalesce(__more, false)").select(*keys, F.col("__line").alias("sha256"))
        done = ready if done is None else done.unionByName(ready)
        rest = top.filter("__more").drop("__more")
        if rest.isEmpty():
            return done


def coverage_candidates(instances: DataFrame, visible: DataFrame, cluster: DataFrame, labels: DataFrame, merge: float,
                        min_visible: int = 10, min_size: int = 20, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b, cover, photos): clusters a whose instances cover the visible rows of cluster b in photos
    b has no instance in, with a median cover of at least ``merge`` over at least two instances."""
    from frondlake.operators.ordered import quantiles

    ids = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_size).select("cluster")
    held = instances.join(cluster, "instance").join(ids, "cluster", "left_semi")
    of = held.select("instance", "photo", F.col("cluster").alias("a")).distinct()
    own = held.select(F.col("cluster").alias("b"), "photo").distinct()
    seen = visible.join(labels.join(ids, "cluster", "left_semi").select("item", F.col("cluster").alias("b")), "item")
    seen = durable(seen.join(own, ["b", "photo"], "left_anti"))
    base = durable(seen.groupBy("photo", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_visible))
    hits = held.select("instance", "photo", "item", F.col("cluster").alias("a")).join(seen, ["photo", "item"]).filter("a <> b") \
        .groupBy("a", "b", "instance", "photo").agg(F.count(F.lit(1)).alias("k"))
    hits = durable(hits)
    # instances of a touched pair that miss b count as cover 0
    every = hits.select("a", "b").distinct().join(of, "a").join(base, ["photo", "b"])
    cover = every.join(hits, ["a", "b", "instance", "photo"], "left").select("a", "b", (F.coalesce("k", F.lit(0)) / F.col("n")).alias("cover"))
    cover = durable(cover)
    count = cover.groupBy("a", "b").agg(F.count(F.lit(1)).alias("photos")).filter("photos >= 2")
    mid = quantiles(cover, ["a", "b"], {"cover": F.col("cover")}, {"p50": 0.5}, hot_rows)
    return count.join(mid, ["a", "b"]).select("a", "b", F.col("cover_p50").alias("cover"), "photos").filter(F.col("cover") >= merge)


def touching_share(pairs: DataFrame, labels: DataFrame, points: DataFrame, touch: float) -> DataFrame:
    """(a, b, touching): the share of the items labelled b that have an item labelled a nearer than
    ``touch``. Items of a pair meet within grid cells as wide as ``touch`` and their neighbours only."""
    placed = labels.join(points.withColumnRenamed("id", "item"), "item")
    cell = [F.floor(F.col(c) / F.lit(touch)) for c in "xyz"]
    spots = durable(placed.select("cluster", "item", "x", "y", "z", *[c.alias(f"c{n}") for n, c in zip("xyz", cell)]))
    mine = pairs.join(spots.withColumnRenamed("cluster", "b"), "b")
    near = [F.explode(F.sequence(F.col(f"c{n}") - 1, F.col(f"c{n}") + 1)).alias(f"c{n}") for n in "xyz"]
    other = spots.select(F.col("cluster").alias("a"), *[F.col(n).alias(f"o{n}") for n in "xyz"], *[f"c{n}" for n in "xyz"])
    for n, spread in zip("xyz", near):
        other = other.select(*[c for c in other.columns if c != f"c{n}"], spread)
    gap = F.sqrt(sum(((F.col(n) - F.col(f"o{n}")) * (F.col(n) - F.col(f"o{n}")) for n in "yz"), (F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox"))))
    hit = mine.join(other, ["a", "cx", "cy", "cz"]).filter(gap < touch).select("a", "b", "item").distinct()
    of = mine.groupBy("a", "b").agg(F.count(F.lit(1)).alias("of"))
    hits = hit.groupBy("a", "b").agg(F.count(F.lit(1)).alias("hits"))
    return of.join(hits, ["a", "b"], "left").select("a", "b", (F.coalesce("hits", F.lit(0)) / F.col("of")).alias("touching"))


def fold_clusters(instances: DataFrame, visible: DataFrame, cluster: DataFrame, points: DataFrame, merge: float, touch: float,
                  touch_share: float, min_visible: int = 10, min_size: int = 20, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(instance, cluster) and the folds (turn, a, b, cover, photos): as long as some cluster a covers
    another one b and touches it in space (at least ``touch_share`` of b's items have one of a nearer
    than ``touch``), the best pair by (cover, photos, a, b) is folded, b into a.

    A fold changes votes, covers and sizes only among clusters that share items, directly or over
    others. Those are components, found once; each turn folds the best pair of every component at the
    same time, and only components that folded are voted and measured again. So turns number the folds
    of the busiest component, not of the table."""
    named = durable(instances.select("instance", "photo", "item").join(cluster, "instance"))
    # a star per item: its smallest cluster with every other one
    first = named.groupBy("item").agg(F.min("cluster").alias("a"))
    links = named.select("item", F.col("cluster").alias("b")).distinct().join(first, "item").filter("a <> b").select("a", "b").distinct()
    part = durable(connected_components(links, cluster.select(F.col("cluster").alias("id")).distinct()).select(F.col("id").alias("cluster"), "component"))
    kind = cluster.schema["cluster"].dataType.simpleString()
    folds, turn = None, 0
    now, live = durable(cluster.select("instance", "cluster")), part
    while True:
        mine = now.join(live.select("cluster"), "cluster", "left_semi")
        held = named.drop("cluster").join(mine, "instance")
        labels = durable(vote_argmax(held, "item", "cluster").select("item", "cluster"))
        todo = durable(coverage_candidates(held.select("instance", "photo", "item"), visible, mine, labels, merge, min_visible, min_size, hot_rows))
        if todo.isEmpty():
            break
        fit = todo.join(touching_share(todo.select("a", "b"), labels, points, touch), ["a", "b"]).filter(F.col("touching") >= touch_share)
        best = fit.join(live.withColumnRenamed("cluster", "a"), "a").groupBy("component").agg(F.max(F.struct("cover", "photos", "a", "b")).alias("m"))
        best = durable(best.select("component", F.lit(turn).alias("turn"), "m.a", "m.b", "m.cover", "m.photos"))
        if best.isEmpty():
            break
        done = best.drop("component")
        folds, turn = done if folds is None else folds.unionByName(done), turn + 1
        into = best.select(F.col("b").alias("cluster"), F.col("a").alias("into"))
        now = durable(now.join(into, "cluster", "left").select("instance", F.coalesce("into", "cluster").alias("cluster")))
        live = durable(live.join(best.select("component"), "component", "left_semi").join(into.select("cluster"), "cluster", "left_anti"))
    if folds is None:
        folds = cluster.sparkSession.createDataFrame([], f"turn int, a {kind}, b {kind}, cover double, photos bigint")
    return now, folds


def merge_by_coverage(instances: DataFrame, visible: DataFrame, cluster: DataFrame, points: DataFrame, merge: float, touch: float,
                      touch_share: float, min_visible: int = 10, min_size: int = 20) -> tuple[DataFrame, list[tuple[int, int]]]:
    """fold_clusters with the folds as a list of (a, b) by turn: at most one per cluster."""
    now, folds = fold_clusters(instances, visible, cluster, points, merge, touch, touch_share, min_visible, min_size)
    return now, [(r["a"], r["b"]) for r in folds.orderBy("turn", F.desc("cover"), F.desc("photos"), F.desc("a"), F.desc("b")).collect()]
