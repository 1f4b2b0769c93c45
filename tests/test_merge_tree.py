"""Merge tree of a forest: sizes, tags and first meetings from the definition, with ranges of any size."""

import random

import pytest

from frondlake.operators import graph as G


@pytest.mark.parametrize("shape,limit", [("random", 6), ("path", 200_000)])
def test_merge_tree(spark, shape, limit):
    rng = random.Random(shape)
    n = 40
    up = {i: i - 1 if shape == "path" else rng.randrange(i) for i in range(1, n) if i % 17}  # three trees
    edges = sorted((rng.choice([0.5, 1.0, 2.0, 4.0]), min(i, p), max(i, p)) for i, p in up.items())
    tags = sorted({(rng.randrange(n), rng.choice("pqrs")) for _ in range(25)})

    def piece(v, light):
        """Vertices that lighter edges lead to."""
        seen, front = {v}, [v]
        while front:
            at = front.pop()
            for _, a, b in light:
                if at in (a, b) and (other := a + b - at) not in seen:
                    seen.add(other)
                    front.append(other)
        return seen

    want = []
    for k, (w, a, b) in enumerate(edges):
        sides = sorted((piece(v, edges[:k]) for v in (a, b)), key=lambda s: (-len(s), min(s)))
        held = [sorted({t for i, t in tags if i in s}) for s in sides]
        if set(held[0]) - set(held[1]) and set(held[1]) - set(held[0]):
            want.append((w, a, b, len(sides[0]) + len(sides[1]), *held))
    tree = spark.createDataFrame([(b, a, w) if a % 2 else (a, b, w) for w, a, b in edges], "a long, b long, w double")
    groups = spark.createDataFrame(tags, "id long, tag string")
    merges = G.durable(G.merge_tree(tree, groups, limit))
    assert sorted(tuple(r) for r in merges.collect()) == sorted(want)
    meetings = G.durable(G.first_meetings(merges, groups))
    radii = {(r.ga, r.gb): r.radius for r in G.join_radii(tree, groups).collect()}
    assert {(r.ga, r.gb): r.radius for r in meetings.collect()} == radii
    first = {}
    for w, a, b, _, x, y in want:
        for pair in {tuple(sorted((s, t))) for s in set(x) - set(y) for t in set(y) - set(x)}:
            if radii.get(pair, 0) > 0:
                first.setdefault(pair, (w, a, b))
    assert {(r.w, r.ea, r.eb) for r in G.merge_events(merges, meetings).collect()} == set(first.values())
