"""Click solver: brute-force local surfaces, bad starts, refusals."""

import numpy as np
import pytest

from frondlake.operators import clicks as K

R = np.eye(3)


def camera(view, turn=0.0, shift=(0.0, 0.0, 4.0), f=800.0):
    r = np.array([[np.cos(turn), 0, np.sin(turn)], [0, 1, 0], [-np.sin(turn), 0, np.cos(turn)]])
    return view, f, 0.0, 0.0, *map(float, r.ravel()), *map(float, shift)


def pixel(cam, p):
    _, f, cx, cy, *rest = cam
    q = np.array(rest[:9]).reshape(3, 3) @ p + np.array(rest[9:])
    return f * q[0] / q[2] + cx, f * q[1] / q[2] + cy


OBS = "label long, view long, u double, v double, " + ", ".join(f"{c} double" for c in K.CAMERA)


def observations(spark, rows):
    return spark.createDataFrame([(label, cam[0], float(u), float(v), *cam[1:]) for label, cam, u, v in rows], OBS)


def test_refinement_from_bad_starts_and_flags(spark):
    rng = np.random.default_rng(2)
    cams = [camera(v, turn, (0.1 * v, -0.05 * v, 4.0)) for v, turn in enumerate([0.0, 0.3, -0.4, 0.6])]
    points = {i: rng.normal(size=3) * 0.3 for i in range(6)}
    noisy = {i: [(c, *(np.array(pixel(c, p)) + (rng.normal(size=2) * 0.5 if i else 0))) for c in cams] for i, p in points.items()}
    noisy[6] = [(c, u, v + 60 * (k == 1)) for k, (c, u, v) in enumerate(noisy[0][:2])]  # rays that pass far from each other
    noisy[7] = [(camera(8), *pixel(camera(8), points[0])), (camera(9, 1e-4), *pixel(camera(9, 1e-4), points[0]))]  # nearly one view
    behind = np.array([0.0, 0.0, -9.0])
    noisy[8] = [(c, *pixel(c, behind)) for c in cams[:2]]
    noisy[9] = [(cams[0], 1.0, 1.0), (cams[0], 2.0, 2.0)]  # one view twice
    obs = observations(spark, [(i, *row) for i, rows in noisy.items() for row in rows])
    got = {r.label: r for r in K.solve_clicks(obs, spark.createDataFrame([], "view long, point long, u double, v double, x double, y double, z double")).collect()}
    assert set(got) == set(range(10)) and got[9].status == "refused" and got[9].flags == ["repeated_view"]
    assert got[0].status == "ok" and got[0].max_residual < 1e-9 and np.allclose([got[0].x, got[0].y, got[0].z], points[0])
    assert "residual" in got[6].flags and "angle" in got[7].flags and got[8].flags == ["behind_camera"] and got[8].status == "refused"
    for i in range(1, 6):
        x = np.array([got[i].x, got[i].y, got[i].z])
        cost = lambda p, i=i: sum(((np.array(pixel(c, p)) - (u, v)) ** 2).sum() for c, u, v in noisy[i])
        assert all(cost(x + d) >= cost(x) for d in np.vstack([np.eye(3), -np.eye(3)]) * 1e-4) and got[i].views == 4
        rays = [(x - h) / np.linalg.norm(x - h) for h in (-np.array(c[4:13]).reshape(3, 3).T @ np.array(c[13:]) for c in cams)]
        assert got[i].angle == pytest.approx(max(np.degrees(np.arccos(min(1.0, a @ b))) for a in rays for b in rays), abs=1e-6)
    # a start far away takes rejected steps and still arrives; no evaluation left means not converged
    start = spark.createDataFrame([(i, 1.0, -0.7, 2.0) for i in range(6)], "label long, x double, y double, z double")
    far = {r.label: r for r in K.refine(obs.filter("label < 6"), start).collect()}
    assert all(far[i].converged and np.allclose([far[i].x, far[i].y, far[i].z], [got[i].x, got[i].y, got[i].z], atol=1e-6) for i in range(6))
    assert not any(r.converged for r in K.refine(obs.filter("label < 6"), start, rounds=1).collect())


def test_local_surface_against_brute_force(spark):
    rng = np.random.default_rng(5)
    cam = camera(3)
    way = np.array([0.2, -0.1, 1.0]) / np.linalg.norm([0.2, -0.1, 1.0])
    p = np.c_[rng.uniform(-1, 1, (600, 2)), np.zeros(600)]
    p[:, 2] = -(p[:, 0] * way[0] + p[:, 1] * way[1]) / way[2]
    p[::9] -= way * rng.uniform(0.2, 0.4, (len(p[::9]), 1))
    uv = np.array([pixel(cam, q) for q in p])
    support = spark.createDataFrame([(3, i, *map(float, uv[i]), *map(float, p[i])) for i in range(600)], "view long, point long, u double, v double, x double, y double, z double")
    clicks = [(i, cam, *rng.uniform(-150, 150, 2)) for i in range(12)] + [(50, cam, 900.0, 900.0), (51, camera(4), 0.0, 0.0)]
    limits = K.ClickLimits(radius=25.0, max_radius=50.0, tolerance=0.001, trials=60)
    got = {r.label: r for r in K.solve_clicks(observations(spark, clicks), support, limits).collect()}
    assert got[50].status == got[51].status == "refused" and got[50].flags == ["support"] and got[51].support == 0
    tried = set()
    for label, _, u, v in clicks[:12]:
        d = np.hypot(uv[:, 0] - u, uv[:, 1] - v)
        r = next(r for r in (25.0, 50.0) if (d <= r).sum() >= 8 or r == 50.0)
        g = got[label]
        assert (g.radius, g.support) == (r, (d <= r).sum())
        tried.add(r)
        inl = (np.arange(600) % 9 != 0) & (d <= r)
        ray = np.array([u / 800, v / 800, 1.0])
        ray /= np.linalg.norm(ray)
        home = np.array([0, 0, -4.0])
        x = home + ray * -(way @ home) / (way @ ray)
        assert g.submethod == "plane" and g.inliers == inl.sum() and np.allclose([g.x, g.y, g.z], x, atol=1e-9) and g.sigma < 1e-6
    assert len(tried) > 1
    # the offset lifts the plane toward the camera; without a plane the median depth is used
    lifted = observations(spark, clicks[:1]).withColumn("offset", K.F.lit(0.5))
    one = K.local_surface(lifted, support, limits).first()
    assert way @ np.array([one.x, one.y, one.z]) == pytest.approx(-0.5, abs=1e-9)
    flat = K.local_surface(observations(spark, clicks[:3]), support, K.ClickLimits(radius=45.0, max_radius=45.0, min_plane=10_000)).collect()
    for g in flat:
        _, _, u, v = clicks[g.label]
        d = np.hypot(uv[:, 0] - u, uv[:, 1] - v)
        assert g.submethod == "median" and g.depth == pytest.approx(np.median(p[d <= 45, 2] + 4))


def test_tiles_and_joins_agree_and_pairs_are_not_written(spark, monkeypatch):
    rng = np.random.default_rng(9)
    cams = [camera(v, 0.1 * v) for v in range(2)]
    p = np.c_[rng.uniform(-1, 1, (900, 2)), np.where(np.arange(900) % 7 == 0, rng.uniform(0.1, 0.5, 900), 0.0)]
    support = spark.createDataFrame([(c[0], i, *map(float, pixel(c, q)), *map(float, q)) for c in cams for i, q in enumerate(p)],
                                    "view long, point long, u double, v double, x double, y double, z double")
    # tiles on both sides of zero, few and no points around some clicks, one without a pixel
    clicks = [(i, cams[i % 2], *rng.uniform(-230, 230, 2)) for i in range(60)] + [(90, cams[0], 5000.0, 0.0), (91, cams[1], float("nan"), 1.0)]
    obs, limits = observations(spark, clicks), K.ClickLimits(radius=6.0, max_radius=24.0, tolerance=0.002, trials=40)
    seen = []
    keep = K.durable
    monkeypatch.setattr(K, "durable", lambda df: seen.append(t := keep(df)) or t)
    tiles = {r.label: r for r in K.local_surface(obs, support, limits).collect()}
    # no table of the tiles has a row for each pair of a click and a point
    assert max(t.count() for t in seen) <= len(clicks) < sum(r.support for r in tiles.values())
    mixed = {r.label: r for r in K.local_surface(obs, support, limits, hot_rows=20).collect()}
    assert set(tiles) == set(mixed) == {c[0] for c in clicks} and len({r.radius for r in tiles.values()}) > 1
    assert {r.submethod for r in tiles.values()} == {"plane", "median", None}
    for label, t in tiles.items():
        for c, x in t.asDict().items():
            assert (mixed[label][c] == pytest.approx(x, abs=1e-9, rel=1e-9)) if isinstance(x, float) else mixed[label][c] == x, (label, c)


def test_widest_angle_needs_no_full_pairing(spark):
    rng = np.random.default_rng(1)
    rays = rng.normal(size=(400, 3)) * [0.2, 0.3, 0.1] + [0, 0, 1]
    rays /= np.linalg.norm(rays, axis=1)[:, None]
    df = spark.createDataFrame([(i % 3, *map(float, r)) for i, r in enumerate(rays)], "label long, x double, y double, z double")
    for r in K.widest_angle(df).collect():
        mine = rays[r.label::3]
        assert r.angle == pytest.approx(np.degrees(np.arccos(np.clip(mine @ mine.T, -1, 1).min())), abs=1e-6)
