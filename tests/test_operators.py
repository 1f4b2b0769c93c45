"""Relations, fits, splat rows, skeleton review, streaming and column functions."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators import fits as X
from frondlake.operators import relations as R
from frondlake.operators import skeleton as K
from frondlake.operators import splat as S
from frondlake.streaming import guard


def test_overlap_and_agglomerate(spark):
    rng = random.Random(4)
    sets = {i: (i % 7, {0} | set(rng.sample(range(1, 25), rng.randint(2, 6)))) for i in range(24)}
    rows = [(i, p, g) for i, (p, s) in sets.items() for g in s]
    m = spark.createDataFrame(rows, "instance long, photo long, item long")
    want = {}
    for a, b in itertools.combinations(sets, 2):
        k = len(sets[a][1] & sets[b][1]) / min(len(sets[a][1]), len(sets[b][1]))
        if sets[a][0] != sets[b][0] and k >= 0.5:
            want[a, b] = k
    for hot in (10**6, 10):
        pairs = R.overlapping_pairs(m, 0.5, hot)
        got = {(r["a"], r["b"]): r["overlap"] for r in pairs.collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
    got = {r["instance"]: r["cluster"] for r in R.agglomerate(m.select("instance", "photo").distinct(), pairs).collect()}
    members = {}
    for i, c in got.items():
        members.setdefault(c, []).append(i)
    assert got.keys() == sets.keys()
    for c, ids in members.items():
        photos = [sets[i][0] for i in ids]
        assert c in ids and len(photos) == len(set(photos))  # one instance of a photo at most
    for (a, b), w in want.items():
        if got[a] != got[b]:  # a pair stays apart only where the clusters of heavier or equal pairs clash in a photo
            assert {sets[i][0] for i in members[got[a]]} & {sets[i][0] for i in members[got[b]]}
    linked = {frozenset(p) for p in want}
    for ids in members.values():  # every cluster hangs together by pairs
        reach, todo = {ids[0]}, [ids[0]]
        while todo:
            v = todo.pop()
            new = [i for i in ids if i not in reach and frozenset((v, i)) in linked]
            reach.update(new)
            todo += new
        assert reach == set(ids)


def test_fingerprint_blocks(spark):
    import hashlib

    df = spark.createDataFrame([("a", i, f"l{i}") for i in range(10)] + [("b", 0, "x")], "k string, i long, t string")
    got = {r["k"]: r["sha256"] for r in R.fingerprint(df, ["k"], ["i"], F.col("t"), block=4).collect()}

    def h(t):
        return hashlib.sha256(t.encode()).hexdigest()

    def tree(lines, block):
        def up(row):
            return [h("".join(row[a:a + block])) for a in range(0, len(row), block)]

        row = up(up(lines))
        while len(row) > 1:
            row = up(row)
        return row[0]

    assert got == {"a": tree([f"l{i}" for i in range(10)], 4), "b": h(h("x"))}
    sizes = {"one": 1, "full": 4096, "over": 4097}
    rows = spark.createDataFrame([(k, n) for k, n in sizes.items()], "k string, n long").select("k", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    got = {r["k"]: r["sha256"] for r in R.fingerprint(rows, ["k"], ["i"], F.col("i").cast("string")).collect()}
    lines = [str(i) for i in range(1, 4098)]
    assert got == {"one": h(h("1")), "full": h(h("".join(lines[:4096]))), "over": h(h("".join(lines[:4096])) + h(lines[4096]))}


def test_numbers_keep_all_digits_and_letters(spark):
    row = spark.range(1).select(C.padded(F.lit(1000), 3).alias("a"), C.padded(F.lit(7), 3).alias("b"), *[C.base26(F.lit(n)).alias(f"n{n}") for n in (0, 25, 26, 701, 702, 18278)]).first()
    assert tuple(row) == ("1000", "007", "a", "z", "aa", "zz", "aaa", "aaaa")


def test_places_without_coordinates_are_refused(spark):
    from frondlake.operators import spatial as S

    pts = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, None, 0.0, 0.0), (3, float("nan"), 1.0, 1.0)], "id long, x double, y double, z double")
    with pytest.raises(ValueError, match="2 rows"):
        S.nearest(pts, pts).collect()


def test_planted_plane_is_found(spark):
    rng = np.random.default_rng(0)
    tilt = np.array([[0.8, 0, -0.6], [0, 1, 0], [0.6, 0, 0.8]])
    flat = np.c_[rng.uniform(-1, 1, (120, 2)), rng.normal(0, 0.005, 120)] @ tilt.T + [1, 2, 3]
    stray = rng.uniform(-1, 1, (40, 3)) @ tilt.T * [1, 1, 2] + [1, 2, 3]
    P = np.concatenate([flat, stray])
    df = spark.createDataFrame(pd.DataFrame(np.concatenate([P, P[:10]]), columns=list("xyz"))).repartition(3)
    for again in (False, True):
        normal, centre, inliers = X.ransac_plane(df, 0.03, 50, 5, reselect=again)
        assert abs(normal @ tilt[:, 2]) > 0.999 and abs((centre - [1, 2, 3]) @ tilt[:, 2]) < 0.02
        got = {(r["x"], r["y"], r["z"]) for r in inliers.collect()}
        assert {tuple(map(float, p)) for p in flat} <= got and len(got) <= 130  # every planted row, few strays
    none, _, left = X.ransac_plane(df.limit(2), 0.03, 5, 1)
    assert none is None and left.count() == 0


def test_line_through(spark):
    t = np.linspace(-1, 1, 21)[:, None] * [1.0, 2.0, 2.0] + [4, 5, 6]
    way, centre, n = X.line_through(spark.createDataFrame(pd.DataFrame(t, columns=list("xyz"))))
    assert n == 21 and np.allclose(centre, [4, 5, 6]) and np.isclose(abs(way @ [1, 2, 2]) / 3, 1)


def test_ground_near_base(spark):
    rng = np.random.default_rng(2)
    ground = np.c_[rng.uniform(-1, 1, (200, 2)), rng.normal(0, 0.002, 200)]
    rows = pd.DataFrame(ground, columns=list("xyz")).assign(hits=8, seen=10)
    far = pd.DataFrame(rng.uniform(5, 6, (50, 3)), columns=list("xyz")).assign(hits=9, seen=10)
    df = spark.createDataFrame(pd.concat([rows, far, rows.assign(z=3.0, hits=1)]))
    limits = X.GroundLimits(min_hits=2, hit_share=0.5, radius=3.0, tolerance=0.02, trials=20, seed=1, min_rows=30, min_inliers=20)
    fit = X.ground_plane(df, (0, 0, 0.5), (0, 0, 1), limits)
    assert fit.broken is None and fit.rows == 200 and fit.normal[2] > 0.999 and abs(fit.offset - 0.5) < 0.01
    assert X.ground_plane(df, (0, 0, 0.5), (0, 0, -1), limits).normal[2] < -0.999
    assert X.ground_plane(df, (50, 50, 50), (0, 0, 1), limits).broken == "rows"
    fits = list(X.settle_ground(df, lambda up: np.array([0, 0, 0.5]) - 0.1 * np.asarray(up), (0, 0, 9), (0, 0, 1), limits, 5))
    assert len(fits) == 2 and fits[-1].same_rows


def test_up_directions(spark):
    ground, camera = (0.0, 0.0, 1.0), (0.0, 1.0, 1.0)

    def chosen(*rows):
        got = X.up_direction(spark, rows, 10).collect()
        return [(r["source"], r["use"], r["apart"]) for r in got]

    assert chosen(("ground", ground), ("camera", camera)) == [("ground", True, False), ("camera", False, True)]
    assert chosen(("ground", None), ("camera", camera)) == [("ground", False, None), ("camera", True, False)]
    assert chosen(("ground", None), ("camera", None)) == [("ground", False, None), ("camera", False, None)]


def test_sh_basis_is_orthonormal():
    rng = np.random.default_rng(1)
    d = rng.normal(size=(60000, 3))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    B = np.stack(C.sh_basis(*d.T, 4), 1)
    assert np.abs(4 * math.pi * B.T @ B / len(d) - np.eye(25)).max() < 0.05
    one = C.sh_basis(np.array([0.0]), np.array([1.0]), np.array([0.0]), 1)
    assert np.allclose([v[0] for v in one], [0.2820947917738781, -0.48860251190292, 0, 0])


def test_transform_keeps_colour_and_covariance(spark):
    rng = np.random.default_rng(3)
    q = rng.normal(size=4)
    w, x, y, z = q / np.linalg.norm(q)
    R3 = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
                   [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])
    names = ["x", "y", "z", *[f"rot_{i}" for i in range(4)], *[f"scale_{i}" for i in range(3)], *[f"f_rest_{i}" for i in range(45)]]
    data = pd.DataFrame(rng.normal(size=(5, len(names))), columns=names)
    df = spark.createDataFrame(data)
    out = S.transform(df, R3, [0.5, 0, 1], 2.0).toPandas()
    assert np.allclose(out[["x", "y", "z"]], 2 * (data[["x", "y", "z"]].to_numpy() - [0.5, 0, 1]) @ R3.T)
    d = rng.normal(size=(20, 3))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    B, BR = (np.stack(C.sh_basis(*v.T, 3), 1)[:, 1:] for v in (d, d @ R3.T))
    for c in range(3):
        cols = [f"f_rest_{c * 15 + i}" for i in range(15)]
        assert np.allclose(B @ data[cols].to_numpy().T, BR @ out[cols].to_numpy().T, atol=1e-9)
    cov = [[c.alias(f"c{i}{j}") for j, c in enumerate(row)] for i, row in enumerate(C.covariance([F.col(f"scale_{i}") for i in range(3)], [F.col(f"rot_{i}") for i in range(4)]))]
    flat = [c for row in cov for c in row]
    a = df.select(*flat).toPandas().to_numpy().reshape(-1, 3, 3)
    b = spark.createDataFrame(out).select(*flat).toPandas().to_numpy().reshape(-1, 3, 3)
    assert np.allclose(b, 4 * R3 @ a @ R3.T)
    with pytest.raises(ValueError, match="orthonormal"):
        S.transform(df, np.eye(3) * 2, [0, 0, 0], 1.0)
    r, o, s = S.inverse(R3, [0.5, 0, 1], 2.0)
    assert np.allclose(S.compose(r, o, s) @ S.compose(R3, [0.5, 0, 1], 2.0), np.eye(4))


def test_branch_review(spark):
    # stem 0-1-2-3, leaf tip 5 on 1-4-5, free twig 2-6-7, guarded twig 3-8
    edges = [(0, 1), (1, 2), (2, 3), (1, 4), (4, 5), (2, 6), (6, 7), (3, 8)]
    tree = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "a long, b long, w double")
    ids = lambda *v: spark.createDataFrame([(i,) for i in v], "id long")
    c = K.branch_candidates(tree, ids(0), ids(3, 5), ids(8)).collect()
    got = {r["attachment"]: (r["candidate"], r["edges"], r["guarded_edges"]) for r in c}
    assert got == {2: (True, 2, 0), 3: (False, 1, 1)}
    groups = spark.createDataFrame([(5, 0), (7, 0), (8, 1)], "id long, grp long")
    assert {(r["id"], r["endpoint"]) for r in K.endpoint_ids(tree, ids(0), groups).collect()} == {(5, "0-a"), (7, "0-b"), (8, "1-a")}


def test_guard_stream(spark, tmp_path):
    rows = [(1, 0.0, 50.0), (1, 5.0, 50.0), (1, 12.0, 50.0), (1, 13.0, None), (1, 14.0, 1.0), (1, 30.0, 500.0), (2, 0.0, 50.0)]
    spark.createDataFrame(rows, "run long, ts double, value double").write.json(str(tmp_path / "in"))
    s = spark.readStream.schema("run long, ts double, value double").json(str(tmp_path / "in"))
    q = guard.decide(s, 5.0, 100.0, 10.0).writeStream.format("parquet").option("path", str(tmp_path / "out")) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r["run"], r["ts"]): r["action"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 0.0): "release", (1, 5.0): "none", (1, 12.0): "release", (1, 13.0): "probe_failed", (1, 14.0): "stop", (1, 30.0): "none", (2, 0.0): "release"}
    h = guard.headroom(spark.createDataFrame(rows, "run long, ts double, value double"), "run", "ts", "value", 100.0, 20.0)
    assert {r["run"]: r["ready_at"] for r in h.collect()} == {1: None, 2: None}


def test_column_functions(spark):
    one = spark.range(1)
    r = one.select(C.slug(F.lit("/A b/__C!/")).alias("a"), C.size_bytes(F.lit("3 G")).alias("b"), C.size_bytes(F.lit("x")).alias("c"),
                   F.array_join(C.cpu_list(F.lit("0-2,5")), ",").alias("d"), C.elapsed(F.lit(3725.4)).alias("e"), C.base26(F.lit(27)).alias("f"),
                   C.eval_token(F.lit("fraction"), F.lit(0.9), F.lit(8)).alias("g"), C.safe_filename(F.lit(".x")).alias("h"), C.psnr(F.lit(0.0)).alias("i"),
                   C.iou(F.lit(0), F.lit(0), F.lit(0)).alias("j"), C.within_path(F.lit("/a/bc"), F.lit("/a/b")).alias("k")).first()
    assert tuple(r) == ("a-b-c", 3 << 30, None, "0,1,2,5", "1h02m05s", "ab", "evalfrac90", False, math.inf, 1.0, False)
    C.register(spark)
    assert spark.sql("SELECT edge_key(7, 3) AS k, iou(1, 1, 0) AS i, slug('A/b') AS s").first() == ("3-7", 0.5, "a-b")


def test_quaternion_round_trip(spark):
    rng = np.random.default_rng(2)
    qs = np.concatenate([rng.normal(size=(50, 4)), [[0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [1, 0, 0, 0]]])
    qs /= np.linalg.norm(qs, axis=1, keepdims=True)
    df = spark.createDataFrame(pd.DataFrame(qs, columns=list("wxyz")))
    m = C.quat_to_matrix([F.col(c) for c in "wxyz"])
    flat = df.select("*", *[m[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3)])
    back = C.matrix_to_quat([[F.col(f"m{i}{j}") for j in range(3)] for i in range(3)])
    got = flat.select(*[c.alias(f"q{i}") for i, c in enumerate(back)]).toPandas().to_numpy()
    assert np.allclose(np.abs((got * qs).sum(1)), 1) and (got[:, 0] >= -1e-12).all()
