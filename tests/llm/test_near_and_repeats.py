"""Operators 4, 7, 10."""

import hashlib
import random

import numpy as np

from frondlake.llm import jaccard, queries, repeats, sketches
from frondlake.session import table


def brute_classes(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted(((i, len(sets[a]), least.get(find(a))) for a, (i, _) in enumerate(rows)), key=str)


def near_rows(word, seed, texts=6, copies=14):
    rng = random.Random(seed)
    rows, i = [], 0
    for t in range(texts):
        base = [word((t, j)) for j in range(rng.choice((3, 12, 60, 110)))]
        for _ in range(copies):
            w = base[:]
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                w[rng.randrange(len(w))] = word((seed, rng.random()))
            rows.append((i, " ".join(w if rng.random() < 0.8 else [x.upper() for x in w])))
            i += 1
    rng.shuffle(rows)
    return rows


ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "One"), (905, "one two"), (906, "é ü"), (907, "É ü"), (None, "one two"), (None, None),
       (908, "a b c d"), (908, "a b c d"), (909, "x y"), (910, "x y")]


def test_classes_against_brute_force(word, make_docs):
    for seed, (k, num, den) in enumerate(((3, 90, 100), (5, 80, 100))):
        rows = near_rows(word, seed) + ODD
        got = jaccard.jaccard_classes(make_docs(rows), k, num, den).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_classes(rows, k, num, den)


def test_classes_of_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op4_jaccard_join"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes(rows, 3, 90, 100)


def test_star_without_its_centre_links_nothing_else(word, make_docs):
    # copies with one changed word each link to the original only: one component through it
    base = [word(j) for j in range(100)]
    rows = [(50, " ".join(base))] + [(i, " ".join(base[:2 * i] + [word(("x", i))] + base[2 * i + 1:])) for i in range(1, 40)]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_classes(make_docs(rows)).collect()}
    assert set(got.values()) == {1}
    assert jaccard.jaccard_classes(make_docs([]).limit(0)).count() == 0


def test_keep_one(word, make_docs):
    rows = near_rows(word, 9, 3, 8) + ODD
    docs = make_docs(rows)
    kept = jaccard.keep_one(docs, 5, 80, 100)
    assert kept.dtypes == docs.dtypes
    want = brute_classes(rows, 5, 80, 100)
    ids = [r.doc_id for r in kept.collect()]
    groups = {c for _, n, c in want if n and c is not None}
    empty = [i for i, n, _ in want if not n]
    assert sorted(map(str, ids)) == sorted(map(str, list(groups) + empty))


def brute_removal(rows, k=13):
    first, out = {}, []
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for j in range(len(w) - k + 1 if i is not None else 0):
            g = tuple(w[j:j + k])
            first[g] = min(first.get(g, i), i)
    for i, w in words:
        keep = [True] * len(w)
        for j in range(len(w) - k + 1 if i is not None else 0):
            if first[tuple(w[j:j + k])] < i:
                keep[j:j + k] = [False] * k
        kept = b" ".join(x for x, y in zip(w, keep) if y)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def passage_rows(word, seed):
    rng = random.Random(seed)
    passages = [[word((seed, p, j)) for j in range(rng.choice((12, 13, 14, 60)))] for p in range(5)]
    rows = []
    for i in range(60):
        w = [word((seed, i, j)) for j in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(3)
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[cut:]
        rows.append((i * 3 - 20, rng.choice((" ", "\n", "  ")).join(w)))
    rows += [(500, rows[7][1]), (501, rows[7][1]), (502, "la " * 40), (503, "la " * 15), (500, rows[8][1]), (None, rows[7][1]), (504, None), (505, "")]
    rng.shuffle(rows)
    return rows


def test_removal_against_brute_force(word, make_docs):
    for seed in range(3):
        rows = passage_rows(word, seed)
        docs = make_docs(rows)
        want = brute_removal(rows)
        assert sorted(map(tuple, repeats.removal_digest(docs).collect()), key=str) == [r[:4] for r in want]
        kept = repeats.remove_repeats(docs)
        assert kept.dtypes == docs.dtypes
        plain = {(i, t): t for i, t in rows}
        expect = sorted(((i, text if gone else None) for i, _, gone, _, text in want), key=str)
        got = sorted(((r.doc_id, r.text if (r.doc_id, r.text) not in plain else None) for r in kept.collect()), key=str)
        assert got == expect
        assert all(r.n_chars == len(r.text or "") for r in kept.collect())


def test_paths_and_their_graph(word, make_docs):
    long = [word(j) for j in range(100)]
    rows = [(1, " ".join(long)), (2, "x y " + " ".join(long[:60])), (3, " ".join(long[30:]) + " z"), (4, "none of it")]
    paths = repeats.repeat_paths(make_docs(rows))
    assert sorted((r.doc, r.start, r.edges, r.source, r.source_start) for r in paths.collect()) == [(2, 2, 48, 1, 0), (3, 0, 58, 1, 30)]
    graph = repeats.compacted_graph(paths)
    assert sorted((r.source_start, r.edges, r.copies) for r in graph.collect()) == [(0, 30, 1), (30, 18, 2), (48, 40, 1)]
    assert repeats.removal_digest(make_docs([]).limit(0)).count() == 0


def test_given_documents_removal(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = queries.QUERIES["op10_substring_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == [r[:4] for r in brute_removal(rows)]


def brute_units(text):
    import re

    out = []
    for line in (text or "").split("\n"):
        run = []
        for w in re.split(r"[\x20\x09-\x0D]+", line):
            if not w:
                continue
            run.append(w)
            if w[-1] in ".!?" or len(run) == sketches.EIGHT:
                out.append(tuple(run))
                # a cut after eight words goes on in the same sentence
                run = []
        if run:
            out.append(tuple(run))
    return out


def test_sketch_likeness_against_multisets(spark, sf_dir, make_docs):
    from collections import Counter

    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    rows += [(1001, None), (1002, ""), (1003, None), (1004, "a. a. a.\na."), (1005, "a. a. b."), (1005, "a. a. b."), (None, "tail of it"), (1006, "\U0001f600 é")]
    got = sketches.version_fingerprints(make_docs(rows)).collect()
    assert len(got) == len(rows)
    texts = [t or "" for _, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))]
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    seen = {}
    for n, (i, _) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        r = by[i].pop()
        if i == 1005:
            continue
        t, follow = texts[n], texts[(n + 1) % len(texts)]
        e = sketches.edited(t, follow)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b, c = (Counter(brute_units(x)) for x in (t, e, follow))
        like = lambda x, y: sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0
        assert abs(r.near_edited - like(a, b)) < 1e-12 and abs(r.near_next - like(a, c)) < 1e-12
        assert len(r.only_before) == sum((a - b).values()) and len(r.only_after) == sum((b - a).values())
        assert seen.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(seen.values())) == len({tuple(sorted(brute_units(t))) for t in seen})
    assert sketches.version_fingerprints(make_docs([]).limit(0)).count() == 0
    (one,) = sketches.version_fingerprints(make_docs([(3, "ab")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"aa").hexdigest()


def brute_links(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    close = lambda x, y: x and y and den * len(x & y) >= num * len(x | y)
    counts = [sum(bool(close(x, y)) for b, y in enumerate(sets) if a != b) for a, x in enumerate(sets)]
    pairs = {frozenset((x, y)) for x in sets for y in sets if x != y and close(x, y)}
    return sorted(((i, len(x), n) for (i, _), x, n in zip(rows, sets, counts)), key=str), len(pairs)


def test_every_link_is_found(word, make_docs, monkeypatch):
    # a chain whose ends do not link, a clique of three, and mixed groups, in blocks of five sets
    base = [word(("c", j)) for j in range(200)]
    chain = [(2000 + i, " ".join(base[i * 6:i * 6 + 100])) for i in range(8)]
    clique = [(2100 + i, " ".join([*(word(("q", j)) for j in range(90)), word(("q", "end", i))])) for i in range(3)]
    rows = near_rows(word, 1, 3, 8) + chain + clique + ODD
    docs = make_docs(rows).coalesce(1)
    want, pairs = brute_links(rows, 3, 90, 100)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    got = jaccard.jaccard_links(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in got), key=str) == want
    found, members = jaccard.jaccard_pairs(docs)
    found = [(r.a, r.b) for r in found.collect()]
    assert len(set(found)) == len(found) == pairs
    assert {x for p in found for x in p} <= {r.key for r in members.collect()}


def test_shared_shingles_are_counted_exactly():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 400))) for _ in range(90)] + [np.arange(5000)] * 2
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    left, right = np.arange(0, 92, 2), np.arange(1, 92, 3)
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    assert (jaccard._common(np.concatenate(sets), owner, len(sets), left, right) == np.array(want)).all()


def test_a_false_pure_cell_ends_and_does_not_peel():
    key = np.array([0x1234567890ABCDEF], np.uint64)
    mapped = {int(c[0]) for c in sketches._cells(key, sketches.CELLS)}
    other = next(c for c in range(sketches.CELLS) if c not in mapped)
    count, xor, check = np.zeros((1, sketches.CELLS), np.int64), np.zeros((1, sketches.CELLS), np.uint64), np.zeros((1, sketches.CELLS), np.uint64)
    count[0, other], xor[0, other], check[0, other] = 1, key[0], sketches._check(key)[0]
    clear, rows, keys, _ = sketches.peel(count, xor, check)
    assert not clear[0] and not len(rows) and not len(keys)
