"""Operators 11 to 13."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from frondlake.llm import middle, nearest, trie


def brute_trie(rows):
    """Every node from the definition, members in ascending order."""
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    for own in turns.values():
        own.sort(key=lambda r: (r[0], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = [r[1:] for r in turns.get(c - c % 100, [])[:h] + own[h:]]
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in nodes)]
        ends = ",".join(str(c) for c in members if len(built[c]) == len(path))
        out.append((members[0], len(path), nodes[path[:-1]][0] if path else None, len(members), sum(len(p) == len(path) + 1 for p in below), len(leaves),
                    sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(c) for c in ("seq", "id", "parent", "i", "digest", "last", "n_convs", "depth")])


def odd_conversations():
    rng = np.random.default_rng(4)
    rows = [(int(c), t, "ua"[t % 2], f"t{rng.integers(2)}") for c in range(100, 140) for t in range(rng.integers(0, 9))]
    rows += [(200, t, "u", "same") for t in range(6)] + [(c, t, "u", "same") for c in range(201, 260) for t in range(3)]
    # no turns left, nulls, repeated rows and turns, an absent base, a long text
    return rows + [(305, 0, "u", "x"), (306, 0, "u", "x"), (1, None, None, None), (1, 0, "", "é"), (1, 0, "", "é"), (None, 1, "u", "lost"), (401, 5, "u", "y" * 300_000)]


@pytest.mark.parametrize("hot,block,piece,pieces", [(40, 3, 8, 2)])
def test_trie_against_brute_force(spark, hot, block, piece, pieces):
    rows = odd_conversations()
    got = trie.conversation_trie(conversations(spark, rows), hot_rows=hot, block=block, piece=piece, pieces=pieces).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(rows)


def test_trie_of_nothing_and_of_one(spark):
    assert trie.conversation_trie(conversations(spark, [])).count() == 0
    assert trie.conversation_trie(conversations(spark, [(None, 0, "u", "x")])).count() == 0
    # crc32("7") % 6 is 0 or more; 7's base is absent, so its first turns go
    assert sorted((tuple(r) for r in trie.conversation_trie(conversations(spark, [(7, 0, "u", "x")])).collect()), key=str) == brute_trie([(7, 0, "u", "x")])


@pytest.mark.parametrize("shape", ["path", "forest"])
def test_contraction_recovers_every_subtree(spark, shape):
    n = 150
    up = {"path": lambda i: i - 1, "star": lambda i: 0, "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2), "forest": lambda i: i // 2 if i % 25 else None}[shape]
    parent = {i: up(i) if i else None for i in range(n)}
    total = {i: i + 1 for i in range(n)}
    for i in reversed(range(1, n)):
        if parent[i] is not None:
            total[parent[i]] += total[i]
    tree = spark.createDataFrame([(i, p, i + 1) for i, p in parent.items()], "id long, parent long, w long")
    assert {r.id: r.w for r in trie.subtree_totals(tree, ["w"]).collect()} == total


LINE = re.compile(r"[^\n]*\n|[^\n]+")


def brute_middle(doc_id, text, rate=100):
    text = text or ""
    units = LINE.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * j:8 * j + 8], 16) for j in range(4)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    spm = h[3] % 100 < 50
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("rate", [100, 40])
def test_middle_against_brute_force(make_docs, word, rate):
    texts = [None, "", "\n", "one", "one\n", "\n\n\n", "é\nüß\n\nend", "has <M> in it\nand more", "<P", "a\r\nb\x0bc", "x" * 3_000_000, "w\n" * 40_000]
    rows = [(i, "\n".join(word(i * j) for j in range(i % 13)) + "é" * (i % 3)) for i in range(200)]
    rows += [(1000 + i, t) for i, t in enumerate(texts)] + [(None, "a\nb"), (5, "same id\nagain"), (5, "same id\nagain")]
    rule = middle.Middle(rate=rate)
    out = middle.fill_in_middle(make_docs(rows), rule).cache()
    got = sorted((tuple(r)[:7] for r in out.collect()), key=str)
    assert got == sorted((brute_middle(*r, rate) for r in rows), key=str)
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    back = middle.restored(out, rule).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert middle.fill_in_middle(make_docs([]).limit(0)).count() == 0


def test_piece_table_cuts_permutes_and_restores():
    table = middle.PieceTable(b"abcdef", b"").cut([0, 2, 2, 6])
    assert [p[1:] for p in table.parts] == [(0, 0), (0, 2), (2, 2), (2, 6), (6, 6)] and table.bytes() == b"abcdef"
    assert table.arranged((3, 0, 1, 2, 4)).bytes() == b"cdefab"
    rule = middle.Middle(marks=("[pre]", "[mid]", "[suf]"))
    for form in middle.FORMS:
        for cuts in [(0, 0), (0, 6), (6, 6), (2, 5)]:
            out = middle.arrange(b"abcdef", cuts, form, rule).bytes()
            assert middle.restore(out, form, rule).bytes() == b"abcdef"


def brute_nearest(rows, k, every=100):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i % every == 0:
            far = []
            for b, (j, x) in enumerate(good):
                if a != b and len(x) == len(q):
                    total = 0.0
                    for d in range(len(q)):
                        total += (x[d] - q[d]) * (x[d] - q[d])
                    far.append((float(np.sqrt(total)), j))
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(sorted(far)[:k])]
    return sorted(out)


@pytest.mark.parametrize("n,dims", [(1500, 64), (250, 1), (0, 3)])
def test_nearest_against_brute_force(spark, n, dims):
    rng = np.random.default_rng(n + dims)
    x = rng.normal(size=(n, dims)).round(3) + (rng.integers(0, 4, (n, 1)) if dims == 1 else 0)
    rows = [(i, x[i].tolist()) for i in range(n)]
    rows += rows[100:103] + [(100, [1.5] * dims), (10_001, [0.0] * dims), (10_002, None), (10_003, [None] * dims), (10_100, [float("nan")] * dims),
                             (10_200, [float("-inf")] * dims), (None, [1.0] * dims), (10_300, [1.0] * (dims + 2)), (10_004, [])]
    rows += [(20_000 + i, [0.25] * dims) for i in (7, 3, 5, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("dims", "copies", "q", "key", "block", "part", "score", "rank")])
    got = sorted(tuple(r) for r in nearest.nearest(df, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 100 == 0, 10).collect())
    want = brute_nearest(rows, 10)
    assert len(got) == len(want) and [g[:2] for g in got] == [w[:2] for w in want]
    assert len(set(got) & set(want)) >= 0.99 * len(set(want))
    if n < 500:  # few rows: every one of them is compared
        assert got == want


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    codes, length, a = nearest.encode(x, nearest.rotation(64, 1))
    assert codes.shape == (4000, 8) and np.allclose(length, np.linalg.norm(x, axis=1))
    q = rng.normal(size=64)
    q /= np.linalg.norm(q)
    got = nearest.estimate(codes, nearest.rotation(64, 1) @ q) / a
    true = (x @ q) / length
    assert abs((got - true).mean()) < 0.01 and (np.abs(got - true) <= 4 * np.sqrt((1 - a * a) / 63) / a).mean() > 0.9995
    turned = nearest.rotation(64, 1) @ q
    at, far = nearest._search(q, turned, 1.0, np.ascontiguousarray(x.T), codes, length, a, np.ones(4000, int), np.arange(4000), 10, 3.0)
    best = np.argsort(np.linalg.norm(x - q, axis=1))[:10]
    assert set(best) <= set(at)
