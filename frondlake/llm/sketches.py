"""Document fingerprints: invertible Bloom lookup sketches of text units.

A text is cut into units, lines and sentences of at most EIGHT words. The sketch keeps, per cell, a
count, the XOR of the unit digests dealt to it and the XOR of their checks; every unit goes to one
cell of each of three parts. Two sketches of one width subtract cell by cell, and cells with a single
digest left peel off until the digests that differ are known. A width too small for the difference
leaves cells that do not peel; then both texts are sketched at twice the width."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frondlake.llm.common import Words, column, mix, pieces

EIGHT = 8
#: cells of a stored fingerprint
CELLS = 48
#: rows of an id range that streams through one sorted run, and ranges at most
RUN_ROWS, RUNS = 1024, 1 << 16
_SALT = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def units(texts) -> tuple[np.ndarray, np.ndarray]:
    """(text number, digest) of every unit; the n-th equal unit of a text has a digest of its own."""
    w = Words(texts)
    n = len(w.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base = int(w.starts[0])
    line = np.cumsum(w.data[base:int(w.ends[-1])] == 10)
    stop = np.isin(w.data[w.ends - 1], np.frombuffer(b".!?", np.uint8))
    fresh = np.ones(n, bool)
    fresh[1:] = (w.doc[1:] != w.doc[:-1]) | stop[:-1] | (line[w.starts[1:] - base] > line[w.ends[:-1] - 1 - base])
    at = np.arange(n)
    place = at - np.maximum.accumulate(np.where(fresh, at, 0))
    first = np.flatnonzero(place % EIGHT == 0)
    weight = np.array([pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(EIGHT)], np.uint64)
    digest = mix(np.add.reduceat(w.hash * weight[place % EIGHT], first))
    doc = w.doc[first]
    order = np.lexsort((digest, doc))
    doc, digest = doc[order], digest[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])
    run = np.arange(len(doc)) - np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    return doc, mix(digest + run.astype(np.uint64) * _SALT[0])


def _cells(key: np.ndarray, cells: int) -> list[np.ndarray]:
    part = cells // 3
    return [j * part + (mix(key ^ salt) % np.uint64(part)).astype(np.int64) for j, salt in enumerate(_SALT)]


def _check(key: np.ndarray) -> np.ndarray:
    return mix(key + _SALT[1]) & np.uint64(0xFFFFFFFF)


def sketch(doc: np.ndarray, key: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digest XORs and check XORs, each (n, cells)."""
    count, xor, check = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    own = _check(key)
    for c in _cells(key, cells):
        at = doc * cells + c
        count += np.bincount(at, minlength=n * cells)
        np.bitwise_xor.at(xor, at, key)
        np.bitwise_xor.at(check, at, own)
    return count.reshape(n, cells), xor.reshape(n, cells), check.reshape(n, cells)


def peel(count: np.ndarray, xor: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whether each row peeled empty, row, digest, sign) of subtracted sketches. A cell is pure when one
    digest is left, its check fits and the digest maps to that cell; a sketch that is not empty after
    as many rounds as it has cells counts as not peeled."""
    n, cells = count.shape
    count, xor, check = count.reshape(-1).copy(), xor.reshape(-1).copy(), check.reshape(-1).copy()
    rows, keys, signs = [], [], []
    for _ in range(cells):
        at = np.flatnonzero(np.abs(count) == 1)
        at = at[_check(xor[at]) == check[at]]
        at = at[(np.stack(_cells(xor[at], cells)) == at % cells).any(0)]
        if not len(at):
            break
        row, key, sign = at // cells, xor[at], count[at]
        order = np.lexsort((key, row))
        row, key, sign = row[order], key[order], sign[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        row, key, sign = row[new], key[new], sign[new]
        own = _check(key)
        for c in _cells(key, cells):
            to = row * cells + c
            np.subtract.at(count, to, sign)
            np.bitwise_xor.at(xor, to, key)
            np.bitwise_xor.at(check, to, own)
        rows.append(row)
        keys.append(key)
        signs.append(sign)
    clear = ((count == 0) & (xor == 0) & (check == 0)).reshape(n, cells).all(1)
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return clear, cat(rows, np.int64), cat(keys, np.uint64), cat(signs, np.int64)


def compare(doc: np.ndarray, key: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(likeness, digests only in a, digests only in b) of pairs of texts, by subtracting and peeling
    their sketches, at twice the width for the pairs that do not peel. Likeness is the Jaccard
    similarity of the unit multisets, 1 for two texts without units."""
    size = np.bincount(doc, minlength=n)
    order = np.argsort(doc, kind="stable")
    doc, key = doc[order], key[order]
    first = np.searchsorted(doc, np.arange(n + 1))
    like = np.zeros(len(a))
    only_a, only_b = [np.zeros(0, np.uint64)] * len(a), [np.zeros(0, np.uint64)] * len(a)
    todo, cells = np.arange(len(a)), CELLS
    while len(todo):
        now = todo[np.abs(size[a[todo]] - size[b[todo]]) <= cells]  # a wider difference cannot peel
        if len(now):
            some, at = np.unique(np.concatenate([a[now], b[now]]), return_inverse=True)
            mine = np.concatenate([np.arange(first[d], first[d + 1]) for d in some]) if len(some) else np.zeros(0, np.int64)
            local = np.repeat(np.arange(len(some)), size[some])
            c, x, k = sketch(local, key[mine], len(some), cells)
            l, r = at[:len(now)], at[len(now):]
            clear, row, digest, sign = peel(c[l] - c[r], x[l] ^ x[r], k[l] ^ k[r])
            for s, out in ((1, only_a), (-1, only_b)):
                pick = sign == s
                by = np.argsort(row[pick], kind="stable")
                cut = np.searchsorted(row[pick][by], np.arange(len(now) + 1))
                for i in np.flatnonzero(clear):
                    out[now[i]] = digest[pick][by][cut[i]:cut[i + 1]]
            for i in now[clear]:
                same = size[a[i]] - len(only_a[i])
                every = size[a[i]] + len(only_b[i])
                like[i] = same / every if every else 1.0
            todo = np.setdiff1d(todo, now[clear], assume_unique=True)
        cells *= 2
    return like, only_a, only_b


def fingerprints(doc: np.ndarray, key: np.ndarray, n: int) -> list[str]:
    """The sketches of CELLS cells as text: units, then counts, digests and checks."""
    count, xor, check = sketch(doc, key, n, CELLS)
    size = np.bincount(doc, minlength=n).astype("<u4").reshape(n, 1).view(np.uint8)
    raw = np.concatenate([size, count.astype("<u4").view(np.uint8), xor.astype("<u8").view(np.uint8), check.astype("<u4").view(np.uint8)], axis=1)
    return [base64.b64encode(r.tobytes()).decode() for r in raw]


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many first code points of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                  ("only_before", pa.list_(pa.int64())), ("only_after", pa.list_(pa.int64()))])


def _versions(rows: pa.Table) -> pa.RecordBatch:
    """All rows but the last, each with the row after it where that is of its run."""
    texts = [t or "" for t in rows.column("text").to_pylist()]
    run, ahead = rows.column("run").to_pylist(), rows.column("ahead").to_pylist()
    mine = [i for i in range(len(texts) - 1) if not ahead[i] and run[i] == run[i + 1]]
    n = len(texts)
    changed = [edited(texts[i], texts[i + 1]) for i in mine]
    doc, key = units(pa.array(texts + changed, pa.large_string()))
    total, at = n + len(mine), np.array(mine, np.int64)
    own, other = at, n + np.arange(len(mine))
    near, before, after = compare(doc, key, total, own, other)
    far, _, _ = compare(doc, key, total, own, at + 1)
    prints = fingerprints(doc, key, total)
    ids = rows.column("doc_id").to_pylist()
    lists = lambda parts: pa.array([p.view(np.int64) for p in parts], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([
        pa.array([ids[i] for i in mine], pa.int64()), pa.array([len(texts[i]) for i in mine], pa.int64()),
        pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()), pa.array([prints[i] for i in mine], pa.string()),
        pa.array(prints[n:], pa.string()), pa.array(near), pa.array(far), lists(before), lists(after)], schema=_OUT)


def _stream(batches):
    held = None
    for b in batches:
        for part in pieces(b, 1, 1 << 20):
            rows = pa.Table.from_batches([part])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if rows.num_rows > 1:
                yield _versions(rows.combine_chunks())
            held = rows.slice(rows.num_rows - 1)


def version_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    only_before, only_after): each text's sketch, that of its version edited with the next document's
    beginning, the likeness of both and of the next document, and the unit digests that an edit
    removes and adds, recovered from the sketches.

    Documents are dealt to ranges of ids, sorted there and streamed, so a row meets the next one
    without a global sort in one task; the first row of each range also travels to the range before.
    Order: ascending id, null ids last, ties by a hash of the text; the last document is followed by
    the first. Null texts are empty: no units, likeness 1 with another empty text. An empty table
    gives no rows; one row follows itself."""
    i, t = column(docs, id_col).cast("long"), column(docs, text)
    slim = docs.select(i.alias("doc_id"), t.alias("text"))
    rows = slim.count()
    runs = min(RUNS, max(1, rows // RUN_ROWS))
    probs = F.array(*[F.lit(j / runs) for j in range(1, runs)])
    splits = sorted(set(slim.agg(F.percentile_approx("doc_id", probs, F.lit(max(10_000, 10 * runs)))).first()[0] or [])) if runs > 1 else []
    steps = [1 << b for b in reversed(range(max(1, len(splits)).bit_length()))]
    cuts = F.array(*map(F.lit, splits)).cast("array<bigint>")
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(
        F.coalesce(F.get(cuts, at + s - 1) <= F.col("doc_id"), F.lit(False)), at + s).otherwise(at)) if splits else F.lit(0)
    dealt = slim.withColumn("run", F.when(F.col("doc_id").isNull(), F.lit(len(splits) + 1)).otherwise(below)).withColumn("tie", F.xxhash64("text"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    heads = sorted((r["run"], tuple(r["head"])) for r in dealt.groupBy("run").agg(F.min(key).alias("head")).collect())  # RUNS + 1 rows at most
    before = [(run, *head, heads[j - 1][0]) for j, (run, head) in enumerate(heads)]
    lead = docs.sparkSession.createDataFrame(before, "run int, none boolean, h_id long, h_tie long, prev int")
    with_head = dealt.join(F.broadcast(lead), "run", "left")
    first = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("tie") == F.col("h_tie"))
    here = F.struct(F.col("run").alias("run"), F.lit(False).alias("ahead"))
    there = F.struct(F.col("prev").alias("run"), F.lit(True).alias("ahead"))
    both = with_head.select("doc_id", "text", "tie", F.inline(F.when(first, F.array(here, there)).otherwise(F.array(here))))
    parts = max(1, min(len(heads), 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    lined = both.repartition(parts, "run").sortWithinPartitions("run", "ahead", F.col("doc_id").isNull(), "doc_id", "tie")
    return lined.select("doc_id", "text", "run", "ahead").mapInArrow(_stream, (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
        "only_before array<long>, only_after array<long>"))
