"""Segment index against every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frondlake.operators.segments import _median_bounds, nearest_group, nearest_segment


def every_pair(p, a, b):
    """(points, segments) distances and fractions."""
    way = b - a
    l2 = (way ** 2).sum(1)
    f = np.einsum("psk,sk->ps", p[:, None] - a, way) / np.where(l2 > 0, l2, 1)
    f = np.clip(np.where(l2 > 0, f, 0), 0, 1)
    return np.linalg.norm(p[:, None] - (a + f[..., None] * way), axis=2), f


def frame(spark, a, b, **extra):
    rows = [(i, *map(float, s), *map(float, e)) for i, (s, e) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "segment long, x double, y double, z double, bx double, by double, bz double")
    return df.select("*", *[F.expr(v).alias(k) for k, v in extra.items()])


def cloud(spark, p, columns="", values=()):
    rows = [(i, *map(float, q), *(v[i] for v in values)) for i, q in enumerate(p)]
    return spark.createDataFrame(rows, "id long, x double, y double, z double" + columns)


@pytest.mark.parametrize("kind", ["long", "far", "one"])
def test_nearest_segment(spark, kind):
    rng = np.random.default_rng(len(kind))
    p = rng.normal(size=(900, 3))
    a = rng.normal(size=(120, 3))
    b = a + rng.normal(size=a.shape) * {"short": 0.02, "long": 5, "far": 0.1, "one": 1}[kind]
    if kind == "far":
        p, a, b = np.concatenate([p * 0.01, p * 0.01 + 1000]), a + [50, 0, 0], b + [50, 0, 0]
    if kind == "one":
        a, b = a[:1], b[:1]
    a, b = np.concatenate([a, a[:1]]), np.concatenate([b, a[:1]])  # one without length
    p = np.concatenate([p, p[:3], a[:2]])
    d, f = every_pair(p, a, b)
    got = {r.id: r for r in nearest_segment(cloud(spark, p), frame(spark, a, b), leaf=6).collect()}
    assert len(got) == len(p)
    for i in range(len(p)):
        assert got[i].distance == pytest.approx(d[i].min(), abs=1e-9)
        assert d[i, got[i].segment] == pytest.approx(d[i].min(), abs=1e-9) and got[i].fraction == pytest.approx(f[i, got[i].segment], abs=1e-6)


def test_nearest_segment_plan_and_edges(spark):
    p, s = cloud(spark, np.zeros((2, 3))), frame(spark, np.zeros((2, 3)), np.ones((2, 3)))
    out = nearest_segment(p, s)
    assert "Cartesian" not in out._jdf.queryExecution().toString() and "NestedLoop" not in out._jdf.queryExecution().toString()
    assert [(r.segment, r.distance) for r in out.collect()] == [(0, 0.0)] * 2  # ties go to the smaller segment
    assert nearest_segment(p.limit(0), s).count() == 0 and nearest_segment(p, s.limit(0)).count() == 0
    with pytest.raises(ValueError):
        nearest_segment(p.withColumn("x", F.lit(float("nan"))), s)


@pytest.mark.parametrize("scenes", [2])
def test_nearest_group_over_many_groups(spark, scenes):
    rng = np.random.default_rng(scenes)
    centres = rng.uniform(-5, 5, (40, 3))
    group = np.concatenate([np.repeat(np.arange(40), 30), [40]])
    p = np.concatenate([centres[group[:-1]] + rng.normal(size=(1200, 3)) * rng.uniform(0.05, 2, (40, 1))[group[:-1]], [[9, 9, 9]]])
    a = rng.uniform(-5, 5, (12, 3))
    b = a + rng.normal(size=(12, 3)) * 2
    d, _ = every_pair(p, a, b)
    where = group % scenes
    df = cloud(spark, p, ", group long, scene long", ([int(g) for g in group], [int(w) for w in where]))
    got = nearest_group(df, frame(spark, a, b, scene=f"segment % {scenes}")).collect()
    assert len(got) == 24
    for s in range(12):
        want = sorted((float(np.median(d[group == g, s])), g) for g in range(41) if g % scenes == s % scenes)[:2]
        mine = sorted((r for r in got if r.segment == s), key=lambda r: r["rank"])
        assert [r.group for r in mine] == [g for _, g in want]
        assert [r.median_distance for r in mine] == pytest.approx([m for m, _ in want], abs=1e-9)


def test_median_bounds_hold(spark):
    rng = np.random.default_rng(3)
    rows, true = [], {}
    for g in range(30):
        boxes = [(sorted(rng.uniform(0, 9, 2)), int(rng.integers(1, 5))) for _ in range(int(rng.integers(1, 6)))]
        values = np.concatenate([rng.uniform(lo, hi, n) for (lo, hi), n in boxes])
        true[g] = np.median(values)
        rows += [(0, g, n, float(lo), float(hi)) for (lo, hi), n in boxes]
    got = _median_bounds(spark.createDataFrame(rows, "segment long, group long, n long, near double, far double")).collect()
    assert len(got) == 30 and all(r.least <= true[r.group] <= r.most for r in got)
