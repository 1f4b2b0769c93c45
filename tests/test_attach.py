"""Attachment at an angle: exact angles, nearest of several, none, several plants."""

import numpy as np
import pytest

from frondlake.operators import attach as A


def curve(n, seed):
    rng = np.random.default_rng(seed)
    return np.cumsum(rng.normal(size=(n, 3)) * 0.3 + [0, 0, 1], axis=0)


def tangents(c):
    w = np.vstack([c[1] - c[0], c[2:] - c[:-2], c[-1] - c[-2]])
    return w / np.linalg.norm(w, axis=1)[:, None]


def seen(c, t, j, s, p):
    q, g = c[j] + s * (c[j + 1] - c[j]), (1 - s) * t[j] + s * t[j + 1]
    return np.arccos(np.clip((p - q) @ g / np.linalg.norm(p - q) / np.linalg.norm(g), -1, 1))


def test_attachments_of_two_plants(spark):
    plants = {"a": curve(7, 1), "b": curve(4, 2)}
    rng = np.random.default_rng(3)
    nodes = spark.createDataFrame([(k, i, *map(float, p)) for k, c in plants.items() for i, p in enumerate(c)], "plant string, i long, x double, y double, z double")
    rows = [(k, i, *map(float, c[len(c) // 2] + rng.normal(size=3) * 1.5), float(rng.uniform(0, len(c))), float(rng.uniform(0.4, 1.4))) for k, c in plants.items() for i in range(8)]
    rows += [("a", 90, 0.0, 0.0, 9e6, 1.0, 3.1), ("a", 91, 1.0, 1.0, 1.0, 1.0, None), ("c", 92, 0.0, 0.0, 0.0, 0.0, 1.0)]
    anchors = spark.createDataFrame(rows, "plant string, id long, x double, y double, z double, arc double, angle double")
    got = {r.id if r.plant != "b" else r.id + 100: r for r in A.attach(anchors, A.stem_segments(nodes)).collect()}
    assert len(got) == len(rows) and all(got[i].segment is None for i in (90, 91, 92))
    settled = 0
    for k, i, x, y, z, want, angle in rows[:16]:
        c, r, p = plants[k], got[i + 100 * (k == "b")], np.array([x, y, z])
        t, size = tangents(c), np.linalg.norm(np.diff(c, axis=0), axis=1)
        arcs = np.concatenate([[0], np.cumsum(size)])
        grid = np.linspace(0, 1, 2001)
        off = np.array([[seen(c, t, j, s, p) - angle for s in grid] for j in range(len(size))])
        roots = [(abs(arcs[j] + grid[h] * size[j] - want), j) for j in range(len(size)) for h in range(2000) if off[j, h] * off[j, h + 1] < 0]
        if not roots:
            continue
        settled += 1
        assert r.residual < 1e-12 and abs(seen(c, t, r.segment, r.fraction, p) - angle) < 1e-9
        assert r.arc == pytest.approx(arcs[r.segment] + r.fraction * size[r.segment]) and r.shift == pytest.approx(min(roots)[0], abs=2e-3)
    assert settled > 8


def test_reference_angles_take_the_two_nearest(spark):
    known = spark.createDataFrame([("a", 3, 1.0, 0.2), ("a", 1, 3.0, 0.4), ("a", 2, 1.0, 0.8), ("b", 1, 0.0, 1.0)], "plant string, leaf long, arc double, angle double")
    anchors = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 0.0), ("b", 3, 0.0), ("z", 4, 0.0)], "plant string, id long, arc double")
    got = {r.id: r.angle for r in A.reference_angles(anchors, known).collect()}
    # all three are 1.0 off for the first: the smaller leaves win
    assert got == {1: pytest.approx(0.6), 2: pytest.approx(0.5), 3: None, 4: None}
