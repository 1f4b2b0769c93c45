"""Agglomeration of large components: found once, settled by shares, the same for any size of share, run and photo set."""

import random

import pytest
from test_agglomerate import assert_settled, run

from frondlake.operators import graph as G
from frondlake.operators import relations as R


def drawn(seed, n=80, m=200, photos=9):
    rng = random.Random(seed)
    photo = {i: rng.randrange(photos) for i in range(n)}
    ends = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
    return photo, [(rng.choice([1.0, 0.9, 0.75, 0.6]), a, b) for a, b in sorted(ends) if photo[a] != photo[b]]


def test_components_are_found_once(spark, monkeypatch):
    """A component above the limit used to be halved again and again, with a search for components at every half."""
    photo, pairs = drawn(3)
    calls, plain = [], R.connected_components
    monkeypatch.setattr(R, "connected_components", lambda *a, **k: calls.append(1) or plain(*a, **k))
    got = run(spark, photo, pairs, 40)
    assert_settled(got, photo, pairs)
    assert got == run(spark, photo, pairs, 10_000)
    assert len(calls) == 1


@pytest.mark.parametrize("seed", range(6))
def test_runs_and_large_photo_sets(monkeypatch, seed):
    photo, pairs = drawn(seed, photos=9 + 4 * seed)
    pairs = sorted(pairs, reverse=True)
    ends = [[p[at] for p in pairs] for at in (1, 2)]
    want = R._reciprocal_merges(*ends, range(len(photo)), [{photo[i]} for i in photo])
    assert_settled({i: want.get(i, i) for i in photo}, photo, pairs)
    monkeypatch.setattr(R, "RUN_PAIRS", 7)
    monkeypatch.setattr(R, "SPARSE", 3)
    assert R._reciprocal_merges(*ends, range(len(photo)), [{photo[i]} for i in photo]) == want


def test_unknown_and_doubled_instances(spark):
    # 9 is not known and does not link 1 with 2; 3 is in photos 7 and 8 and clashes with both
    instances = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (3, 8), (4, 7), (5, 8), (6, 9)], "instance long, photo long")
    pairs = spark.createDataFrame([(1.0, 1, 9), (1.0, 2, 9), (0.9, 3, 4), (0.8, 3, 5), (0.7, 3, 6), (None, 1, 2), (0.9, 1, 1)], "overlap double, a long, b long")
    for limit in (2, 100):
        got = sorted(map(tuple, R.agglomerate(instances, pairs, limit).collect()))
        assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 3)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_by_one_task(spark, kind):
    rng = random.Random(4)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1400)], "a long, b long")
    edges = edges.selectExpr(f"cast(a as {kind}) a", f"cast(b as {kind}) b")
    extra = edges.selectExpr("a id").union(spark.createDataFrame([("5000",)], "id string").selectExpr(f"cast(id as {kind}) id"))
    want = sorted(map(tuple, G.connected_components(edges, extra).collect()))
    for whole in (100, 10_000):
        assert sorted(map(tuple, G.connected_components(edges, extra, whole).collect())) == want


def test_items_are_not_compared_in_the_join(spark):
    """The join tests numbers only. With the items in its condition they stood there several times, in a method too long to be compiled."""
    held = [(i, i % 7, g) for i in range(60) for g in random.Random(i).sample(range(30), 1 + i % 5)]
    plan = R.overlapping_pairs(spark.createDataFrame(held, "instance long, photo long, item long"), 0.6)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "array_intersect" not in join and "bit_count" in join
