"""Agglomeration by the properties that single out its result: photos, connection, and no allowed pair left."""

import random

import pytest

from frondlake.operators.relations import _reciprocal_merges, agglomerate
from frondlake.plans.relations import agglomerate_instances


def reach(start, pairs):
    """Instances that pairs lead to from start."""
    seen, front = {start}, [start]
    while front:
        at = front.pop()
        for _, a, b in pairs:
            for x, y in ((a, b), (b, a)):
                if x == at and y not in seen:
                    seen.add(y)
                    front.append(y)
    return seen


def assert_settled(cluster, photo, pairs):
    """cluster: {instance: name}, photo: {instance: photo}, pairs: (w, a, b)."""
    members = {}
    for i, c in cluster.items():
        members.setdefault(c, set()).add(i)
    inner = [p for p in pairs if cluster[p[1]] == cluster[p[2]]]
    for name, group in members.items():
        assert name in group and len({photo[i] for i in group}) == len(group)
        assert reach(name, inner) == group
    for p in pairs:
        if cluster[p[1]] != cluster[p[2]]:
            before = [q for q in inner if q > p]
            left, right = reach(p[1], before), reach(p[2], before)
            assert {photo[i] for i in left} & {photo[i] for i in right}, p


def run(spark, photo, pairs, limit):
    got = agglomerate(spark.createDataFrame(list(photo.items()), "instance long, photo long"),
                      spark.createDataFrame(pairs, "overlap double, a long, b long"), limit)
    return {r["instance"]: r["cluster"] for r in got.collect()}


@pytest.mark.parametrize("seed,limit", [(1, 200_000), (2, 60)])
def test_no_allowed_pair_is_left(spark, seed, limit):
    rng = random.Random(seed)
    photo = {i: rng.randrange(9) for i in range(80)}
    pairs = sorted({(rng.choice([1.0, 0.9, 0.75, 0.6]), a, b) for a, b in (sorted(rng.sample(range(80), 2)) for _ in range(160)) if photo[a] != photo[b]})
    pairs = list({(a, b): (w, a, b) for w, a, b in pairs}.values())
    got = run(spark, photo, pairs, limit)
    assert_settled(got, photo, pairs)


def test_star_and_chain_of_ties(spark):
    # a hub whose leaves repeat ten photos keeps one leaf of each; a chain of different photos becomes one cluster
    photo = {0: -1} | {i: i % 10 for i in range(1, 1001)}
    got = run(spark, photo, [(1.0, 0, i) for i in range(1, 1001)], 200_000)
    assert sorted(i for i, c in got.items() if c == 0) == [0, *range(991, 1001)]
    chain = {i: i for i in range(1001)}
    assert set(run(spark, chain, [(1.0, i, i + 1) for i in range(1000)], 600).values()) == {0}


def test_blocks_of_a_path_merge_from_the_heavy_end():
    # photos 0 1 0: the heavier pair wins and the other one clashes
    assert _reciprocal_merges([1, 0], [2, 1], ["a", "b", "c"], [1, 2, 1]) == {"c": "b"}
    assert _reciprocal_merges([], [], [], []) == {}


def test_pairs_of_one_common_item_merge(spark, tmp_path):
    # 1 and 2 share their only item; 3 to 5 share two or more; 6 has the photo of 1; 7 is alone
    baskets = {1: (10, {100}), 2: (11, {100, 101, 102}), 3: (12, {200, 201, 202}), 4: (13, {200, 201}), 5: (14, {201, 202, 203}), 6: (10, {100}), 7: (15, {300})}
    spark.createDataFrame([(i, g) for i, (_, items) in baskets.items() for g in items], "l_orderkey long, l_partkey long").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, p) for i, (p, _) in baskets.items()], "o_orderkey long, o_custkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted((r["cluster"], r["instances"]) for r in agglomerate_instances(spark, str(tmp_path)).collect())
    # at equal weight the larger ids go first: 6 takes 2, then 1 clashes with 6; 4 joins 5 or 3 by weight
    assert got == [(2, 2), (3, 3)]
