"""Distance joins, components and trees against all-pairs NumPy."""

import itertools

import numpy as np
import pytest

from frondlake.operators import graph as G
from frondlake.operators import skeleton as K
from frondlake.operators import spatial as S


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(3)
    parts = [rng.normal((0, 0, 0), 0.3, (60, 3)), rng.normal((3, 0, 0), 0.3, (50, 3)), rng.normal((0, 4, 1), 0.2, (30, 3)), rng.uniform(-2, 5, (20, 3))]
    X = np.concatenate(parts)
    return np.concatenate([X, X[:15], np.repeat(X[:1], 30, 0)])


@pytest.fixture(scope="module")
def points(spark, cloud):
    rows = [(i, *map(float, p), int(i % 4)) for i, p in enumerate(cloud)]
    return spark.createDataFrame(rows, "id long, x double, y double, z double, label int").cache()


@pytest.fixture(scope="module")
def dist(cloud):
    return np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(-1))


def brute_components(D, r):
    lab = np.arange(len(D))
    while True:
        new = np.array([lab[D[i] <= r].min() for i in range(len(D))])
        if (new == lab).all():
            return lab
        lab = new


@pytest.mark.parametrize("r,work", [(0.3, 4_000_000), (0.8, 4_000_000), (0.8, 4)])
def test_components(points, dist, r, work):
    got = {x["id"]: x["component"] for x in S.components_at(points, r, work).collect()}
    want = brute_components(dist, r)
    assert got == {i: c for i, c in enumerate(want)}


@pytest.mark.parametrize("k,self_out", [(1, False), (1, True), (5, True), (3, False)])
def test_nearest(points, dist, k, self_out):
    got = {}
    for x in S.nearest(points, points, k, self_out, leaf=6).collect():
        got.setdefault(x["id"], {})[x["rank"]] = (x["neighbour"], x["distance"])
    for i in range(len(dist)):
        order = sorted((d, j) for j, d in enumerate(dist[i]) if not (self_out and i == j))[:k]
        assert [got[i][m + 1][0] for m in range(k)] == [j for _, j in order]
        assert np.allclose([got[i][m + 1][1] for m in range(k)], [d for d, _ in order])


@pytest.mark.parametrize("shared", [False, True])
def test_nearest_candidates_are_neither_sorted_nor_held_by_one_task(points, dist, monkeypatch, shared):
    if shared:
        monkeypatch.setattr(S, "TILE", 7)
        monkeypatch.setattr(S, "CANDIDATES", 11)
        monkeypatch.setattr(S, "ROWS", 50)
    near = S.nearest(points, points, 3, leaf=6)
    # the only window ranks the results of a tile's shares, not the candidates
    assert ("Window" in near._jdf.queryExecution().executedPlan().toString()) == shared
    got = {(x["id"], x["rank"]): (x["neighbour"], x["distance"]) for x in near.collect()}
    want = {(i, m + 1): (j, d) for i in range(len(dist)) for m, (d, j) in enumerate(sorted((d, j) for j, d in enumerate(dist[i]))[:3])}
    assert {k: j for k, (j, _) in got.items()} == {k: j for k, (j, _) in want.items()}
    assert np.allclose([got[k][1] for k in sorted(got)], [want[k][1] for k in sorted(want)])


def test_rows_of_few_values_get_their_tasks(spark):
    rows = S._in_tasks(spark.range(40).selectExpr("id % 8 k"), 4 * S.ROWS, "k")
    assert rows.groupBy("k").count().rdd.getNumPartitions() == 4


def test_nearest_two_sets(points, dist):
    a, b = points.filter("label = 0"), points.filter("label <> 0")
    got = {x["id"]: x["distance"] for x in S.nearest(a, b, leaf=4).collect()}
    other = [i for i in range(len(dist)) if i % 4]
    assert all(np.isclose(got[i], dist[i, other].min()) for i in got) and len(got) == len(dist) - len(other)


@pytest.mark.parametrize("hot", [20_000, 5])
def test_radius_pairs(points, dist, hot):
    got = {(x["a"], x["b"]) for x in S.radius_pairs(points, 0.4, hot_cell=hot).collect()}
    assert got == {(i, j) for i, j in itertools.combinations(range(len(dist)), 2) if dist[i, j] <= 0.4}


def test_pair_budget(points):
    with pytest.raises(S.PairBudgetExceeded):
        S.radius_pairs(points, 0.4, budget=10)


@pytest.mark.parametrize("leaf", [48, 4])
def test_label_gaps(points, dist, leaf):
    got = {(x["la"], x["lb"]): x["distance"] for x in S.closest_between(points, "label", leaf=leaf).collect()}
    lab = np.arange(len(dist)) % 4
    for a, b in itertools.combinations(range(4), 2):
        assert np.isclose(got[a, b], dist[np.ix_(lab == a, lab == b)].min())
    assert len(got) == 6


def kruskal(D, ids):
    parent = {i: i for i in ids}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    out = []
    for w, i, j in sorted((D[i, j], i, j) for i, j in itertools.combinations(ids, 2)):
        a, b = find(i), find(j)
        if a != b:
            parent[b] = a
            out.append((i, j, w))
    return out


@pytest.mark.parametrize("block", [2048, 40])
def test_euclidean_tree(points, dist, block):
    got = S.euclidean_tree(points, block).collect()
    want = kruskal(dist, range(160))
    assert len(got) == 159
    assert np.isclose(sum(x["w"] for x in got), sum(w for _, _, w in want))
    assert {(x["a"], x["b"]) for x in got} == {(i, j) for i, j, _ in want}


@pytest.mark.parametrize("ways", [8, 2])
def test_join_radii(spark, points, dist, ways):
    tree = spark.createDataFrame([(i, j, float(w)) for i, j, w in kruskal(dist, range(160))], "a long, b long, w double")
    sets = {"a": range(0, 5), "b": range(60, 70), "c": range(110, 120), "d": range(140, 150), "e": [4, 150]}
    groups = spark.createDataFrame([(i, g) for g, ids in sets.items() for i in ids], "id long, tag string")
    got = {(x["ga"], x["gb"]): x["radius"] for x in G.join_radii(tree, groups, ways).collect()}
    M = dist[:160, :160].copy()
    for k in range(160):
        M = np.minimum(M, np.maximum(M[:, k:k + 1], M[k:k + 1, :]))
    for g, h in itertools.combinations(sorted(sets), 2):
        assert np.isclose(got[g, h], M[np.ix_(list(sets[g]), list(sets[h]))].min()), (g, h)


def test_clustered_points_with_a_far_one(spark):
    rng = np.random.default_rng(8)
    P = np.concatenate([rng.normal(0, 0.01, (700, 3)), [[500.0, 500.0, 500.0]]])
    df = spark.createDataFrame([(i, int(i % 2), *map(float, p)) for i, p in enumerate(P)], "id long, label int, x double, y double, z double")
    low, size, rows = S.bounds(df)
    depth = S.settled_depth(rows, 16, low, size, (df, []))
    cells = df.groupBy(S.fine_cell(low, size, depth).alias("c")).count().collect()
    assert max(r["count"] for r in cells) <= S.CROWD * 16 < rows  # no cell holds the cluster
    D = np.linalg.norm(P[:, None] - P[None], axis=2)
    np.fill_diagonal(D, np.inf)
    got = {r["id"]: r["distance"] for r in S.nearest(df, df, 1, exclude_self=True, leaf=16).collect()}
    assert len(got) == 701 and all(np.isclose(got[i], D[i].min()) for i in got)
    (gap,) = S.closest_between(df, "label", leaf=16).collect()
    assert np.isclose(gap["distance"], D[::2, 1::2].min())


def test_join_radii_of_weight_zero_and_ties(spark):
    tree = spark.createDataFrame([(0, 1, 0.0), (1, 2, 1.0), (2, 3, 1.0), (5, 6, 2.0)], "a long, b long, w double")
    groups = spark.createDataFrame([(0, "p"), (1, "q"), (2, "r"), (3, "s"), (3, "t"), (5, "u"), (6, "v"), (9, "p")], "id long, tag string")
    got = {(x["ga"], x["gb"]): x["radius"] for x in G.join_radii(tree, groups).collect()}
    want = {("p", "q"): 0.0, ("s", "t"): 0.0, ("u", "v"): 2.0} | {(a, b): 1.0 for a in "pq" for b in "rst"} | {("r", "s"): 1.0, ("r", "t"): 1.0}
    assert got == want


def test_tree_tables_are_not_broadcast(points, monkeypatch):
    written = []

    def watched(df, write=S.durable):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(S, "durable", watched)
    monkeypatch.setattr(G, "durable", watched)
    tree = S.euclidean_tree(points, 40)
    assert tree.count() == points.select("x", "y", "z").distinct().count() - 1
    pieces = G.connected_components(tree)
    assert len(written) > 10 and not any("BroadcastHashJoin" in p for p in [*written, pieces._jdf.queryExecution().executedPlan().toString()])


def test_sweep(spark, points, dist):
    tree = S.euclidean_tree(points)
    got = {x["mult"]: x for x in S.radius_sweep(tree, points, {"1": 0.3, "2": 0.8}, 10, 3).collect()}
    for m, r in (("1", 0.3), ("2", 0.8)):
        sizes = sorted(np.unique(brute_components(dist, r), return_counts=True)[1], reverse=True)
        assert got[m]["components"] == len(sizes) and got[m]["singletons"] == sizes.count(1)
        assert got[m]["components_ge"] == sum(s >= 10 for s in sizes)
        assert got[m]["top_sizes"] == ",".join(map(str, sizes[:3]))


def test_graph_spanning_tree_and_paths(spark, dist):
    edges = [(i, j, float(dist[i, j])) for i, j in itertools.combinations(range(60), 2) if dist[i, j] < 1.5]
    e = spark.createDataFrame(edges, "a long, b long, w double")
    D = np.full((60, 60), np.inf)
    for i, j, w in edges:
        D[i, j] = D[j, i] = w
    got = G.spanning_tree(e)
    want = [x for x in kruskal(D, range(60)) if np.isfinite(x[2])]
    assert {(x["a"], x["b"]) for x in got.collect()} == {(i, j) for i, j, _ in want}
    np.fill_diagonal(D, 0)
    short = D.copy()
    for k in range(60):
        short = np.minimum(short, short[:, k:k + 1] + short[k:k + 1, :])
    root = spark.createDataFrame([(0,)], "id long")
    far = {x["id"]: x["dist"] for x in G.geodesic(e, root).collect()}
    assert all(np.isclose(far[i], short[0, i]) for i in far) and len(far) == int(np.isfinite(short[0]).sum())
    hung = G.rooted(got, root)
    up = {x["id"]: (x["parent"], x["dist"]) for x in hung.collect()}
    paths = {}
    for t in (41, 17):
        path, v = [], t
        while v is not None:
            path.append(v)
            v = up[v][0]
        paths[t] = path
        assert {x["id"] for x in G.on_the_way(hung, spark.createDataFrame([(t,)], "id long")).collect()} == set(path)
    both = G.on_the_way(hung, spark.createDataFrame([(41,), (17,), (17,)], "id long"))
    assert sorted(x["id"] for x in both.collect()) == sorted({*paths[41], *paths[17]})
    stem = spark.createDataFrame([(v,) for v in paths[41]], "id long")
    for x in G.insertions(hung, spark.createDataFrame([(41,), (17,)], "id long"), stem).collect():
        last = next(v for v in paths[x["target"]] if v in paths[41])
        assert x["insertion"] == last and np.isclose(x["along_stem"], up[last][1]) and np.isclose(x["branch_length"], up[x["target"]][1] - up[last][1])


def _hang(edges, root):
    near = {}
    for a, b, w in edges:
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    out, todo = {root: (None, 0, 0.0)}, [root]
    while todo:
        v = todo.pop()
        for u, w in near.get(v, []):
            if u not in out:
                out[u] = (v, out[v][1] + 1, out[v][2] + w)
                todo.append(u)
    return out


@pytest.mark.parametrize("edges,root", [
    ([(i, i + 1, 1.0) for i in range(3000)], 1200), ([(0, i, i / 2) for i in range(1, 300)], 7),
    ([(i, (i - 1) // 2, 0.25 * i) for i in range(1, 64)] + [(100, 101, 1.0)], 5), ([], 3)])
def test_rooted_in_logarithmic_rounds(spark, monkeypatch, edges, root):
    writes = []
    monkeypatch.setattr(G, "durable", lambda df, keep=G.durable: writes.append(1) or keep(df))
    e = spark.createDataFrame(edges, "a long, b long, w double")
    got = {x["id"]: (x["parent"], x["depth"], x["dist"]) for x in G.rooted(e, spark.createDataFrame([(root,)], "id long")).collect()}
    want = _hang(edges, root)
    assert got.keys() == want.keys()
    assert all(got[v][:2] == want[v][:2] and np.isclose(got[v][2], want[v][2]) for v in want)
    assert len(writes) <= 4 + 2 * max(1, 2 * len(edges)).bit_length()


def test_long_path_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long")
    got = G.connected_components(e, spark.createDataFrame([(999,)], "id long")).collect()
    assert {x["component"] for x in got} == {0, 999} and len(got) == 402


def test_level_nodes(spark):
    e = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (1, 3, 1.0), (2, 4, 1.0), (3, 5, 1.0)], "a long, b long, w double")
    d = G.geodesic(e, spark.createDataFrame([(0,)], "id long"))
    got = {x["id"]: (x["bin"], x["node"]) for x in G.level_nodes(e, d, 2.0).collect()}
    assert got == {0: (0, 0), 1: (0, 0), 2: (1, 2), 4: (1, 2), 3: (1, 3), 5: (1, 3)}


def test_level_sets_measure_links_without_writing_them(spark, monkeypatch):
    rng = np.random.default_rng(12)
    xyz = np.vstack([rng.normal(size=(260, 3)) * [0.05, 0.05, 0.2], [[0.0, 0.0, 0.0]] * 120, rng.normal(size=(15, 3)) * 0.02 + 3])
    pts = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "id long, x double, y double, z double").localCheckpoint()
    edges = S.radius_pairs(pts, 0.07).localCheckpoint()
    sizes, keep = [], S.durable

    def noted(df):
        sizes.append((t := keep(df)).count())
        return t

    for m in (S, K):
        monkeypatch.setattr(m, "durable", noted)
    level, low = K.level_sets(pts, 0.07, 0.05)
    level = {r.id: (r.bin, r.node) for r in level.collect()}
    assert max(sizes) < edges.count() / 4
    # the same by paths and pieces over the written links of the largest component
    ids = {r.id for r in K.largest(G.connected_components(edges, pts.select("id"))).collect()}
    main = edges.filter(S.F.col("a").isin(list(ids))).localCheckpoint()
    root = pts.filter(S.F.col("id").isin(list(ids))).orderBy("z", "id").select("id").limit(1).localCheckpoint()
    dist = G.geodesic(main, root).localCheckpoint()
    assert low.first().id == root.first().id
    assert level == {r.id: (r.bin, r.node) for r in G.level_nodes(main, dist, 0.05).collect()} and len(level) == len(ids)
    got = {r.id: r.dist for r in S.geodesic_within(pts, root, 0.07, share=16).collect()}
    assert got == {r.id: r.dist for r in dist.collect()}
    df = spark.createDataFrame([(i, *map(float, xyz[i]), n) for i, (_, n) in level.items()], "id long, x double, y double, z double, node long")
    near = {tuple(sorted((level[r.a][1], level[r.b][1]))) for r in main.collect()}
    assert {(r.a, r.b) for r in S.linked_groups(df, "node", 0.07, share=16).collect()} == {p for p in near if p[0] != p[1]}
