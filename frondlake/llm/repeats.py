"""Repeated word spans by a compacted De Bruijn graph of the corpus.

Edges are windows of k words. A first pass finds the edges that may repeat: windows are told apart by
their anchor, the smallest m-word hash inside them (equal windows have equal anchors), and only
anchors met in two documents go on. A second pass gathers those edges with their source coordinate,
the smallest document that holds the edge and the place in it. Consecutive edges of a document that
are consecutive in one source form one compacted path, so a long passage is one row, and the words of
each path are compared with the words at its source coordinates before it counts.

What moves between tasks: texts once (every pass reads the same exchange), packed anchors, packed
repeated edges, and paths. Each batch of texts sends a hash to its hash range once, however often it
holds it, so a passage that every document repeats is as many entries as there are batches."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frondlake.llm.common import Words, batch_count, column, inside, mix, ngrams, pack, text_bytes, unpack

ANCHOR = 5


def _span_min(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest of the span values from each position on."""
    step, out = 1, values
    while step * 2 <= span:
        out, step = np.minimum(out[:-step], out[step:]), step * 2
    rest = span - step
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _windows(words: Words, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows of texts with an id, and the anchors (48 bits) of all windows."""
    m = min(ANCHOR, k)
    if len(words.hash) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # smallest values crowd at the low end: mixed again, they spread over the ranges
    anchors = mix(_span_min(ngrams(words.hash, m), k - m + 1)) >> np.uint64(16)
    doc = words.doc[:len(anchors)]
    return np.flatnonzero(inside(words.doc, k) & known[doc]), anchors


def _range_of(key48: np.ndarray, ranges: int) -> np.ndarray:
    return ((key48 >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)


def _ids(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document ids (0 for null) and which are known."""
    c = t.column("__id").combine_chunks()
    return pc.fill_null(c, 0).to_numpy(zero_copy_only=False), pc.is_valid(c).to_numpy(zero_copy_only=False)


def _keys(words: Words, some: np.ndarray) -> np.ndarray:
    """Hash of the bytes of the texts in ``some`` (0 for the others): tells rows of one id apart."""
    out = np.zeros(words.n, np.int64)
    for d in some:
        out[d] = xxhash.xxh3_64_intdigest(words.data[words.offsets[d]:words.offsets[d + 1]].tobytes()) >> 1
    return out


def _digest(words: Words, first: int, last: int) -> bytes:
    return hashlib.blake2b(b" ".join(words.data[words.starts[first]:words.ends[last]].tobytes().split()), digest_size=16).digest()


def _cut(sorted_range: np.ndarray) -> list[tuple[int, int, int]]:
    """(range, from, to) of the runs of equal values."""
    if not len(sorted_range):
        return []
    at = np.flatnonzero(np.diff(sorted_range, prepend=sorted_range[0] ^ np.uint64(1)))
    return [(int(sorted_range[a]), int(a), int(b)) for a, b in zip(at, [*at[1:], len(sorted_range)])]


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()


_ANCHORS = pa.schema([("range", pa.int32()), ("batch", pa.int32()), ("keys", pa.binary()), ("many", pa.binary())])
_BACK = pa.schema([("batch", pa.int32()), ("keys", pa.binary())])
_EDGES = pa.schema([("range", pa.int32()), ("batch", pa.int32()), *((n, pa.binary()) for n in ("keys", "ids", "texts", "places", "many"))])
_SOURCES = pa.schema([("batch", pa.int32()), *((n, pa.binary()) for n in ("keys", "ids", "texts", "places", "batches"))])
_PATHS = pa.schema([
    ("batch", pa.int32()), ("doc", pa.int64()), ("text_key", pa.int64()), ("start", pa.int64()), ("edges", pa.int64()),
    ("source_batch", pa.int32()), ("source", pa.int64()), ("source_key", pa.int64()), ("source_start", pa.int64()), ("digest", pa.binary())])
_ASKED = ("source_batch", "source", "source_key", "source_start", "edges", "digest")


def _ddl(schema: pa.Schema) -> str:
    names = {"int32": "int", "int64": "long", "binary": "binary"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def _send_anchors(k: int, ranges: int):
    def run(t: pa.Table) -> pa.Table:
        words = Words(t.column("__text"))
        at, anchors = _windows(words, k, _ids(t)[1])
        key, doc = anchors[at], words.doc[at]
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        key, doc = key[new], doc[new]
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        last = np.append(first[1:], len(key)) - 1
        many, key = doc[first] != doc[last], key[first]
        batch = t.column("batch")[0].as_py()
        return _table(_ANCHORS, [(r, batch, pack(key[a:b], True), np.packbits(many[a:b]).tobytes()) for r, a, b in _cut(_range_of(key, ranges))])

    return run


def _repeated_anchors(t: pa.Table) -> pa.Table:
    parts = [unpack(b, True) for b in t.column("keys").to_pylist()]
    many = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)) for b, p in zip(t.column("many").to_pylist(), parts)]).astype(bool)
    keys = np.concatenate(parts)
    found = np.sort(keys)
    found = np.union1d(found[1:][found[1:] == found[:-1]], keys[many])
    hit = found[np.minimum(np.searchsorted(found, keys), max(len(found) - 1, 0))] == keys if len(found) else np.zeros(len(keys), bool)
    ends = np.cumsum([len(p) for p in parts])
    back = [(b, p[h]) for b, p, h in zip(t.column("batch").to_pylist(), parts, np.split(hit, ends[:-1]))]
    return _table(_BACK, [(b, pack(p, True)) for b, p in back if len(p)])


def _send_edges(k: int, ranges: int):
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        if not docs.num_rows or not back.num_rows:
            return _EDGES.empty_table()
        words, (ids, known) = Words(docs.column("__text")), _ids(docs)
        at, anchors = _windows(words, k, known)
        wanted = np.sort(np.concatenate([unpack(b, True) for b in back.column("keys").to_pylist()]))
        key = anchors[at]
        at = at[wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key]
        edge, doc = ngrams(words.hash, k)[at], words.doc[at]
        texts = _keys(words, np.unique(doc))
        place = at - words.first[doc]
        order = np.lexsort((place, texts[doc], ids[doc], edge))
        edge, doc, place = edge[order], doc[order], place[order]
        first = np.flatnonzero(np.append(True, edge[1:] != edge[:-1])) if len(edge) else np.zeros(0, int)
        last = np.append(first[1:], len(edge)) - 1
        own, batch = ids[doc], docs.column("batch")[0].as_py()
        many = own[first] != own[last]
        edge, doc, place = edge[first], doc[first], place[first]
        cuts = _cut(_range_of(edge >> np.uint64(16), ranges))
        return _table(_EDGES, [(r, batch, pack(edge[a:b], True), pack(ids[doc[a:b]]), pack(texts[doc[a:b]]), pack(place[a:b]),
                                np.packbits(many[a:b]).tobytes()) for r, a, b in cuts])

    return run


def _sources(t: pa.Table) -> pa.Table:
    """The source coordinate of each edge that two documents hold, back to the batches that hold it
    in a later document."""
    parts = [unpack(b, True) for b in t.column("keys").to_pylist()]
    sizes = [len(p) for p in parts]
    keys = np.concatenate(parts)
    ids, texts, places = (np.concatenate([unpack(b).view(np.int64) for b in t.column(n).to_pylist()]) for n in ("ids", "texts", "places"))
    many = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(t.column("many").to_pylist(), sizes)]).astype(bool)
    batches = np.repeat(t.column("batch").to_numpy(), sizes).astype(np.int64)
    order = np.lexsort((places, texts, ids, keys))
    head = np.append(True, keys[order][1:] != keys[order][:-1])
    lead = np.empty(len(keys), np.int64)
    lead[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    later = many | (ids > ids[lead])
    out, at = [], 0
    for b, n in zip(t.column("batch").to_pylist(), sizes):
        sel = np.flatnonzero(later[at:at + n]) + at
        if len(sel):
            to = lead[sel]
            out.append((b, pack(keys[sel], True), pack(ids[to]), pack(texts[to]), pack(places[to]), pack(batches[to])))
        at += n
    return _table(_SOURCES, out)


def _compact(k: int):
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        if not docs.num_rows or not back.num_rows:
            return _PATHS.empty_table()
        words, (ids, known) = Words(docs.column("__text")), _ids(docs)
        at, _ = _windows(words, k, known)
        keys = np.concatenate([unpack(b, True) for b in back.column("keys").to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        src, skey, splace, sbatch = (np.concatenate([unpack(b).view(np.int64) for b in back.column(n).to_pylist()])[order]
                                     for n in ("ids", "texts", "places", "batches"))
        edge = ngrams(words.hash, k)[at]
        spot = np.minimum(np.searchsorted(keys, edge), len(keys) - 1)
        hit = (keys[spot] == edge) & (src[spot] < ids[words.doc[at]])
        at, spot = at[hit], spot[hit]
        doc = words.doc[at]
        if not len(at):
            return _PATHS.empty_table()
        new = np.ones(len(at), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1) | (src[spot[1:]] != src[spot[:-1]]) \
            | (skey[spot[1:]] != skey[spot[:-1]]) | (splace[spot[1:]] != splace[spot[:-1]] + 1)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        texts = _keys(words, np.unique(doc))
        p, d, s = at[first], doc[first], spot[first]
        return pa.table([
            pa.array(np.full(len(p), docs.column("batch")[0].as_py()), pa.int32()), ids[d], texts[d], p - words.first[d], size,
            pa.array(sbatch[s], pa.int32()), src[s], skey[s], splace[s],
            pa.array([_digest(words, a, a + n + k - 2) for a, n in zip(p, size)], pa.binary())], schema=_PATHS)

    return run


def _rows_by_key(words: Words, ids: np.ndarray, wanted: set) -> dict:
    some = np.flatnonzero(np.isin(ids, np.fromiter({i for i, _ in wanted}, np.int64, -1)))
    texts = _keys(words, some)
    return {(int(ids[d]), int(texts[d])): int(d) for d in some}


def _verify(k: int):
    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not docs.num_rows or not asked.num_rows:
            return asked.slice(0, 0)
        words, (ids, _) = Words(docs.column("__text"), hashes=False), _ids(docs)
        who = list(zip(asked.column("source").to_pylist(), asked.column("source_key").to_pylist()))
        row = _rows_by_key(words, ids, set(who))
        good = []
        for key, a, n, digest in zip(who, asked.column("source_start").to_pylist(), asked.column("edges").to_pylist(), asked.column("digest").to_pylist()):
            d = row.get(key)
            good.append(d is not None and a + n + k - 1 <= words.count[d]
                        and _digest(words, words.first[d] + a, words.first[d] + a + n + k - 2) == digest)
        return asked.filter(pa.array(good))

    return run


def _removal(k: int, roles: list[str], digest: bool):
    """Rows of a batch without their covered words: digests, or the caller's columns."""

    def run(docs: pa.Table, paths: pa.Table) -> pa.Table:
        texts = docs.column("__text")
        words, (ids, known) = Words(texts, hashes=False), _ids(docs)
        hidden = np.zeros(len(words.starts) + 1, np.int64)
        if paths.num_rows:
            where = list(zip(paths.column("doc").to_pylist(), paths.column("text_key").to_pylist()))
            wanted = set(where)
            some = np.flatnonzero(known & np.isin(ids, np.fromiter({i for i, _ in wanted}, np.int64, -1)))
            keys = _keys(words, some)
            rows: dict = {}
            for d in some:
                rows.setdefault((int(ids[d]), int(keys[d])), []).append(int(d))
            for key, a, n in zip(where, paths.column("start").to_pylist(), paths.column("edges").to_pylist()):
                for d in rows.get(key, ()):
                    hidden[words.first[d] + a] += 1
                    hidden[words.first[d] + a + n + k - 1] -= 1
        keep = np.cumsum(hidden[:-1]) == 0
        gone = words.count - np.add.reduceat(np.append(keep, False).astype(np.int64), np.append(words.first, len(keep)))[:words.n] * (words.count > 0)
        out = []
        for d in range(words.n):
            if digest or gone[d]:
                w = words.data[words.offsets[d]:words.offsets[d + 1]].tobytes().split()
                a = words.first[d]
                out.append(b" ".join(compress(w, keep[a:a + len(w)]) if gone[d] else w))
            else:
                out.append(None)
        if digest:
            return pa.table({"doc_id": docs.column("__id"), "n_words": words.count.astype(np.int64), "n_removed": gone.astype(np.int64),
                             "kept_sha256": [hashlib.sha256(b).hexdigest() for b in out]})
        cols = {}
        for i, role in enumerate(roles):
            c = docs.column(f"c{i}")
            if role == "text":
                c = pa.array([o.decode("utf-8", "replace") if o is not None else t for o, t in zip(out, texts.to_pylist())], c.type)
            elif role == "n_chars":
                c = pa.array([len(o.decode("utf-8", "replace")) if o is not None else v for o, v in zip(out, c.to_pylist())], c.type)
            cols[f"c{i}"] = c
        return pa.table(cols)

    return run


def _batches(docs: DataFrame, id_col: str, text: str, carry: list[str]) -> tuple[DataFrame, int]:
    n = batch_count(text_bytes(docs, text))
    i, t = column(docs, id_col).cast("long"), column(docs, text)
    return docs.select(i.alias("__id"), t.alias("__text"), F.pmod(F.xxhash64(i, t), F.lit(n)).cast("int").alias("batch"),
                       *[column(docs, c).alias(f"c{j}") for j, c in enumerate(carry)]), n


def _paths(base: DataFrame, ranges: int, k: int) -> DataFrame:
    by = base.groupBy("batch")
    anchors = by.applyInArrow(_send_anchors(k, ranges), _ddl(_ANCHORS))
    back = anchors.groupBy("range").applyInArrow(_repeated_anchors, _ddl(_BACK))
    edges = by.cogroup(back.groupBy("batch")).applyInArrow(_send_edges(k, ranges), _ddl(_EDGES))
    sources = edges.groupBy("range").applyInArrow(_sources, _ddl(_SOURCES))
    paths = by.cogroup(sources.groupBy("batch")).applyInArrow(_compact(k), _ddl(_PATHS))
    asked = paths.select(*_ASKED).distinct()
    fields = ", ".join(f"{f.name} {'binary' if f.name == 'digest' else 'int' if f.name == 'source_batch' else 'long'}"
                       for f in (_PATHS.field(n) for n in _ASKED))
    held = by.cogroup(asked.groupBy("source_batch")).applyInArrow(_verify(k), fields)
    return paths.join(held, list(_ASKED), "left_semi")


def repeat_paths(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text_key, start, edges, source, source_key, source_start): each maximal run of k-word
    windows of a document that also starts, edge by edge, in a row from source_start on in the
    document with the smallest id that holds it. A run of e edges covers e + k - 1 words."""
    base, n = _batches(docs, id_col, text, [])
    return _paths(base, n, k).select("doc", "text_key", "start", "edges", "source", "source_key", "source_start")


def compacted_graph(paths: DataFrame) -> DataFrame:
    """(source, source_key, source_start, edges, copies): the nonbranching paths. Between two places
    where some document enters or leaves the source's passage every copy follows the same edges, so
    the stretch is one path; copies are the later documents' occurrences that run through it."""
    same = ["source", "source_key"]
    ends = paths.select(*same, F.inline(F.array(
        F.struct(F.col("source_start").alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("source_start") + F.col("edges")).alias("at"), F.lit(-1).alias("step"))))) \
        .groupBy(*same, "at").agg(F.sum("step").alias("step"))
    along = Window.partitionBy(*same).orderBy("at")
    return ends.withColumn("copies", F.sum("step").over(along)).withColumn("edges", F.lead("at").over(along) - F.col("at")) \
        .filter("copies > 0 and edges > 0").select(*same, F.col("at").alias("source_start"), "edges", "copies")


def removal_digest(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row: words covered by a window of k words
    that also starts in a document with a smaller id are removed.

    A null or empty text has no words; a text of fewer than k words loses none; rows of one id and
    text are treated alike and never remove words from each other; a row without id keeps its words
    and removes none; an empty table gives no rows."""
    base, n = _batches(docs, id_col, text, [])
    return base.groupBy("batch").cogroup(_paths(base, n, k).groupBy("batch")).applyInArrow(
        _removal(k, [], True), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, every row and column, with the repeated words gone from the text: a text that loses words
    becomes its kept words joined by one space (n_chars, where there is one, follows), any other
    stays byte for byte. Rows are treated as in ``removal_digest``."""
    base, n = _batches(docs, id_col, text, docs.columns)
    roles = ["text" if c == text else c if c == "n_chars" else "" for c in docs.columns]
    schema = ", ".join(f"c{j} {t}" for j, (_, t) in enumerate(docs.dtypes))
    out = base.groupBy("batch").cogroup(_paths(base, n, k).groupBy("batch")).applyInArrow(_removal(k, roles, False), schema)
    return out.select(*[F.col(f"c{j}").alias(c) for j, c in enumerate(docs.columns)])
