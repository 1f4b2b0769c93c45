"""Operators 1, 2, 8, 9."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from frondlake.llm import licences, queries, sharding, topk, warc
from frondlake.session import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_phrases(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        for j in range(len(w) - len(p) + 1):
            if w[j:j + len(p)] == p:
                starts.append(j)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licences_against_brute_force(spark, sf_dir, make_docs):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.QUERIES["op1_license_scan"](spark, sf_dir).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_phrases(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    odd = ["MIT License mit license", "the GNU General\nPublic-License, gnu general public license", "cc by", "CC-BY cc, by", "é mit lıcense", "mit",
           "gnu general public mit license", "apache license " * 500]
    for r in licences.licence_digest(make_docs(list(enumerate(odd)))).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_phrases(odd[r.doc_id])


def test_licence_spans_chain_over_edits(make_docs):
    mit = licences.TEMPLATES["mit-text"].split()
    edited = mit[:20] + ["really"] + mit[21:45] + mit[47:]
    rows = licences.licence_spans(make_docs([(1, "start here " + " ".join(edited) + " then more"), (2, " ".join(mit[:12])), (3, None), (4, ""),
                                             (None, "x"), (5, "the software of the work is the use of a copy"), (5, "same id")])).collect()
    by = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3, 4)}
    assert len(rows) == 7
    (span,) = by[1].spans
    assert span.label == "mit-text" and span.first_word == 2 and span.cover > 0.9
    assert by[2].spans == [] and 0 < by[2].score < 0.6
    for i in (3, 4):
        assert (by[i].n_words, by[i].first_word, by[i].labels, by[i].score) == (0, None, "", 0.0)
    assert licences.licence_spans(make_docs([]).limit(0)).count() == 0


@pytest.mark.parametrize("text,labels", [
    ("the album was released under the name of the band", ""), ("Released under the Apache License", "apache"),
    ("This work is licensed under the GNU General Public License, version 2", "gpl"), ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-3.0"),
    ("Licensed under the Apache License, Version 2.0. The license text follows", "apache,apache-2.0"),
    (licences.TEMPLATES["apache-2.0-notice"], "apache,apache-2.0,apache-2.0-notice"), (licences.TEMPLATES["apache-2.0-notice"].replace("2.0", "1.1"), "apache"),
    ("Released under the MIT License", "mit,mit-notice"), (licences.TEMPLATES["mit-whole"], "mit-text,mit-whole"), (licences.TEMPLATES["isc-whole"], "isc-text,isc-whole"),
    ("released under the mit and other terms; a mit license", "mit")])
def test_labels_of_texts(text, labels):
    scanner = licences.Scanner(licences.PHRASES, licences.TEMPLATES)
    for whole in (text, "zz " * 50_000 + text + " zz" * 50_000, ("w" * (1 << 20)) + " " + text):
        row = scanner.row(whole.encode())
        assert row[5] == labels and (labels != "" or row[6] < 0.5)


def test_template_matches_against_brute_force():
    rng = np.random.default_rng(9)
    seqs = {str(t): " ".join("abc"[i] for i in rng.integers(0, 3, 12)) for t in range(3)}
    scanner = licences.Scanner({}, seqs, shortest=2)
    for _ in range(200):
        words = ["abcx"[i] for i in rng.integers(0, 4, 20)]
        want = set()
        for t, s in enumerate(seqs.values()):
            s = s.split()
            same = lambda i, e: 0 <= i < len(words) and 0 <= e < len(s) and words[i] == s[e]
            for i in range(len(words)):
                for e in range(len(s)):
                    n = 0
                    while same(i - n, e - n):
                        n += 1
                    if n >= 2 and not same(i + 1, e + 1):
                        want.add((i, t, e, n))
        got = []
        scanner._chains = lambda m: got.extend(m) or []
        scanner.scan(" ".join(words).encode())
        assert len(got) == len(set(got)) and set(got) == want


def test_matching_statistics():
    a = licences.Automaton([b"a b c a b d".split(), b"c a d".split()])
    seqs = [b"a b c a b d".split(), b"c a d".split()]
    factors = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = [b"abcdx"[i:i + 1] for i in rng.integers(0, 5, 20)]
        got = {i: n for i, _, n in a.statistics(text)}
        for i in range(20):
            assert got.get(i, 0) == max([n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in factors], default=0)


def test_warc_records(spark):
    pages = spark.createDataFrame([
        (1, "http://a/", '<html lang="en"><head><meta charset="UTF-8"><title> A &amp; B </title></head><body><p>One<br>two</p><script>x="</p>"</script>'
         '<a class="k" href="/l">link</a></body></html>'), (2, None, None), (None, "http://b/", ""), (1, "http://a/", "plain < text")],
        "page_id long, url string, html string")
    rows = warc.serialized(warc.page_derivatives(pages.withColumn("block", F.lit(1)))).collect()
    assert len(rows) == 8
    for r in rows:
        assert r.content_length == len(r.block.encode()) and r.refers_to.startswith("<urn:uuid:")
        other = [o for o in rows if o.record_id == r.concurrent_to]
        assert other and other[0].refers_to == r.refers_to and other[0].concurrent_to == r.record_id
        head, _, rest = r.warc.decode().partition("\r\n\r\n")
        assert head.startswith("WARC/1.1\r\nWARC-Type: " + r.record_type) and f"WARC-Refers-To: {r.refers_to}" in head and rest == r.block + "\r\n\r\n"
    one = {r.record_type: r for r in rows if r.refers_to_target_uri == "http://a/" and "One" in r.block or "A & B" in r.block}
    assert one["conversion"].block == "One\ntwo\nlink"
    assert one["metadata"].block.split("\r\n")[:2] == ["title: A & B", "language: en"] and "outlink: /l" in one["metadata"].block
    assert "source-header: Content-Type: text/html; charset=utf-8" in one["metadata"].block
    assert warc.page_derivatives(pages.limit(0)).count() == 0


@pytest.mark.parametrize("html,title,lang,links,text", [
    ("<html lang='de'><a href='x'>one</a><a\nhref=\"/y?a=1&amp;b=2\">two</a><A HREF=/z>three</A><a name=q>four</a><a href=''>five</a>", "", "de",
     ["x", "/y?a=1&b=2", "/z", ""], "onetwothreefourfive"),
    ("<HTML class=k LANG=fr><title>caf&eacute; &#8217;\n&#x41;&#150;</title>&eacute;&#8217;&unknown;&amp;lt;&#0;&#xD800;&#1114112;&amp", "café ’ A–", "fr", [],
     "é’&unknown;&lt;\ufffd\ufffd\ufffd&amp"),
    ("a<!-- <a href='no'> --><script>var t='<a href=no>';</script><STYLE>p{}</STYLE ><scripty>b</scripty> 1 < 2 & c", "", "", [], "a b 1 < 2 & c"),
    ("<a title=\"href=no\" data-href='no' href = \"a\nb\">k</a><!-- never closed <a href='no'>", "", "", ["a b"], "k"),
    ("<p>" + "<a <!" * 60_000 + "<!-- x" * 60_000, "", "", [], "<a <!" * 60_000), ("&amp;" * 50_000 + "<title>" * 30_000, "", "", [], "&" * 50_000), (None, "", "", [], ""), (" ", "", "", [], "")])
def test_page_forms(spark, html, title, lang, links, text):
    pages = spark.createDataFrame([(1, "u", html, 1, 2)], "page_id long, url string, html string, plain int, fields int")
    rows = {r.record_type: r.block for r in warc.page_derivatives(pages).collect()}
    lines = rows["metadata"].split("\r\n")
    assert lines[:2] == ["title: " + title, "language: " + lang] and [v[9:] for v in lines if v.startswith("outlink: ")] == links
    assert rows["conversion"] == text.strip()


@pytest.mark.parametrize("n,dims", [(700, 24), (3, 5), (0, 4)])
def test_topk_against_brute_force(spark, n, dims):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, dims)), 1)
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(n)]
    bad = [(10_000, None), (10_001, [None] * dims), (10_050, [float("nan")] * dims), (10_100, [float("inf")] * dims), (None, [1.0] * dims), (10_150, [1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("dims", F.lit("x"))
    got = topk.exact_topk(df, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 50 == 0, 5).collect()
    q = np.floor(x * 256).astype(int)
    want = set()
    for i in range(0, n, 50):
        best = sorted((-int(q[i] @ q[j]), j) for j in range(n) if j != i)[:5]
        want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_topk_repeated_ids(spark):
    # two equal rows of one id, a third of the same id, and ties: each row is a query, its copies are candidates
    rows = [(50, [1.0])] * 2 + [(50, [2.0])] + [(i, [float(i)]) for i in range(6, 12)] + [(12, [11.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in ("key", "copies", "q", "v", "block")])
    got = sorted(tuple(r) for r in topk.exact_topk(df, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 50 == 0, 9).collect())
    want = []
    for a, (i, q) in enumerate(rows):
        if i % 50 == 0:
            best = sorted((-int(q[0] * 256) * int(v[0] * 256), j) for b, (j, v) in enumerate(rows) if b != a)[:9]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want) and len(got) == 27


def test_topk_large_components(spark):
    rows = [(i, [float(2 ** 20 + i), float(-(2 ** 15) * i)]) for i in range(60)]
    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id"), F.col("embedding"), F.col("vec_id") == 50, 2).collect()
    e = {i: [int(v * 256) for v in v2] for i, v2 in rows}
    want = sorted((-sum(a * b for a, b in zip(e[50], e[j])), j) for j in e if j != 50)[:2]
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(j, -s) for s, j in want]


def test_shards_match_the_mixture(make_docs):
    rows = [(i, f"text {i % 90}", None if i % 11 == 0 else f"s{min(i % 7, 3)}") for i in range(1003)] + [(None, None, "s0"), (5, "text 5", "s3"), (5, "text 5", "s3")]
    got = sharding.shard_documents(make_docs(rows)).collect()
    again = sharding.shard_documents(make_docs(rows).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    sizes = [len(v) for v in shards.values()]
    assert set(shards) == set(range(16)) and max(sizes) - min(sizes) <= 1
    share = {s: sum(r.source == s for r in got) / 16 for s in {r.source for r in got}}
    for v in shards.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
        for s, want in share.items():
            assert abs(sum(r.source == s for r in v) - want) <= 2
    # very many sources of one row spread evenly, and so do their ranks
    many = sharding.interleave(make_docs([(i, f"t{i}", f"s{i}") for i in range(4000)]), 16, F.col("source"), F.col("doc_id"), F.col("text"))
    counts = [r["n"] for r in many.groupBy(F.col("doc_id") % 8, "shard").agg(F.count("*").alias("n")).collect()]
    assert max(counts) < 3 * sum(counts) / len(counts)
    null = next(r for r in got if r.doc_id is None)
    assert (null.size, null.text_crc32, null.law, null.grown_shard) == (1, 0, "rows", None)
    assert sharding.shard_documents(make_docs([]).limit(0)).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shard_documents(make_docs([(1, "a")])).collect()] == [(0, 0)]
