"""Overlap pairs: instances that carry their items, and those too long for it, against brute force."""

import math
import random

import pytest

from frondlake.operators import relations as R


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    held = {i: (i % 7, set(rng.sample(range(30), rng.choice([1, 2, 3, 5, 8, 12])))) for i in range(60)}
    return [(i, p, g) for i, (p, items) in held.items() for g in items], held


def brute(held, share):
    out = set()
    for a, (pa, x) in held.items():
        for b, (pb, y) in held.items():
            common = len(x & y)
            if a < b and pa != pb and common and common / min(len(x), len(y)) >= share:
                out.add((a, b, common))
    return out


@pytest.mark.parametrize("carried", [64, 4, 0])
def test_same_pairs_for_any_length_that_travels(spark, rows, carried):
    members, held = rows
    got = R.overlapping_pairs(spark.createDataFrame(members, "instance long, photo long, item long"), 0.6, carried=carried).collect()
    assert len(got) == len({(r["a"], r["b"]) for r in got})
    assert {(r["a"], r["b"], r["common"]) for r in got} == brute(held, 0.6)
    assert all(math.isclose(r["overlap"], r["common"] / min(len(held[r["a"]][1]), len(held[r["b"]][1]))) for r in got)


def test_no_candidate_is_shuffled(spark, rows):
    """Pairs are counted where they meet: nothing is exchanged after the join on the item."""
    plan = R.overlapping_pairs(spark.createDataFrame(rows[0], "instance long, photo long, item long"), 0.6)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate" not in plan


def test_a_component_above_the_pack_size_stays_whole(spark, monkeypatch):
    """Components too big to share a task are blocks of their own: nothing is cut below the limit."""
    pairs = [(1.0 - i / 1000, base + i, base + i + 1) for base in (0, 1000, 2000) for i in range(40)]
    ids = {v for _, a, b in pairs for v in (a, b)}
    held = spark.createDataFrame([(v, v % 997) for v in ids], "instance long, photo long")
    monkeypatch.setattr(R, "MERGE_PAIRS", 10)
    monkeypatch.setattr(R, "ordered", lambda *a, **k: pytest.fail("a component was cut"))
    got = R.agglomerate(held, spark.createDataFrame(pairs, "overlap double, a long, b long"), R.WHOLE_PAIRS)
    sizes = [r["count"] for r in got.groupBy("cluster").count().collect()]
    assert sizes == [41, 41, 41]
