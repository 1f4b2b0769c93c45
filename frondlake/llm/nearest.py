"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector's direction x is rotated by a random orthogonal matrix and kept as the signs of its
coordinates, D bits, with two correction scalars: its length and a = <x, c>, c being the unit vector
of the signs. For a query direction q, <q, c> / a estimates <q, x> without bias; the error is within
spread * sqrt((1 - a^2) / a^2 / (D - 1)) but for a share of the rotations that falls with
exp(-spread^2 / 2). Only vectors whose bound still reaches the best k found are compared exactly."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.session import durable

#: queries that meet a block of candidates together, rows of a block, and vectors compared exactly at a time
QUERY_BLOCK, BLOCK, CHUNK = 4096, 4096, 128


@lru_cache(8)
def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same dimension and seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, length, a) of the rows of x: packed sign bits and the two correction scalars."""
    peak = np.abs(x).max(1)
    length = peak * np.sqrt(((x / peak[:, None]) ** 2).sum(1))
    y = (x / peak[:, None]) @ turn.T
    y /= np.sqrt((y * y).sum(1))[:, None]
    return np.packbits(y > 0, axis=1), length, np.abs(y).sum(1) / np.sqrt(x.shape[1])


def estimate(codes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """<q, c> for every code: one table of 256 partial sums per byte of the code."""
    dims = len(q)
    padded = np.zeros(codes.shape[1] * 8)
    padded[:dims] = q
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(float)  # (256, 8)
    table = padded.reshape(-1, 8) @ bits.T
    total = np.zeros(len(codes))
    for j in range(codes.shape[1]):
        total += table[j][codes[:, j]]
    return (2 * total - padded.sum()) / np.sqrt(dims)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of q to the columns of x (dimensions first), summed dimension by dimension:
    a sum over the outer axis adds row after row."""
    step = x - q[:, None]
    return np.sqrt(np.add.reduce(step * step, axis=0))


def _search(q: np.ndarray, turned: np.ndarray, size: float, x: np.ndarray, codes: np.ndarray, length: np.ndarray, a: np.ndarray,
            copies: np.ndarray, ids: np.ndarray, k: int, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that may be among the k nearest and their distances. Vectors go by ascending lower
    bound; once the k-th best distance lies below the next bound the rest cannot enter."""
    dims = len(q)
    dot = estimate(codes, turned)
    beside = np.sqrt(np.maximum(0, 1 - a * a))
    # the second bound is certain: what is left of x beside c times what is left of q beside c
    inner = np.minimum(dot / a + spread * beside / a / np.sqrt(max(dims - 1, 1)), a * dot + beside * np.sqrt(np.maximum(0, 1 - dot * dot)))
    inner = np.minimum(inner, 1)
    low = length * length + size * size - 2 * length * size * inner
    low = np.where(copies > 0, low - 1e-9 * (length * length + size * size), np.inf)
    order = np.argsort(low, kind="stable")
    order = order[:np.searchsorted(low[order], np.inf)]
    got, near, best = np.zeros(0, np.int64), np.zeros(0), np.inf
    for at in range(0, len(order), CHUNK):
        some = order[at:at + CHUNK]
        if low[some[0]] > best:
            break
        far = distances(x.take(some, axis=1), q)
        got, near = np.append(got, some), np.append(near, far)
        by = np.lexsort((ids[got], near))
        got, near = got[by], near[by]
        full = int(np.searchsorted(np.cumsum(copies[got]), k))
        if full < len(got):
            # rows that tie with the k-th stay, so that smaller ids can win over all blocks
            keep = near <= near[full]
            got, near = got[keep], near[keep]
            best = near[full] * near[full]
    return got, near


def _block(k: int, spread: float, seed: int):
    schema = pa.schema([("query_id", pa.int64()), ("q_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("copies", pa.int64())])

    def run(cand: pa.Table, quer: pa.Table) -> pa.Table:
        if not cand.num_rows or not quer.num_rows:
            return schema.empty_table()

        def rows(t):
            return t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

        x, q = rows(cand), rows(quer)
        codes, length, a = cand.column("code"), cand.column("length").to_numpy(), cand.column("a").to_numpy()
        codes = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(x), -1)
        ids, keys, n = (cand.column(c).to_numpy() for c in ("vec_id", "key", "copies"))
        qids, qkeys = (quer.column(c).to_numpy() for c in ("vec_id", "key"))
        turn = rotation(x.shape[1], seed)
        peak = np.abs(q).max(1)
        turned = (q / peak[:, None]) @ turn.T
        norm = np.sqrt((turned * turned).sum(1))
        turned, size = turned / norm[:, None], norm * peak
        columns = np.ascontiguousarray(x.T)
        out = [[], [], [], [], []]
        for i in range(len(q)):
            own = (keys == qkeys[i]) & (ids == qids[i])
            left = n - (own & (x == q[i]).all(1))
            at, far = _search(q[i], turned[i], size[i], columns, codes, length, a, left, ids, k, spread)
            # equal distances fall to smaller ids, and a row may stand for several copies
            by = np.lexsort((ids[at], far))[:k]
            at, far = at[by], far[by]
            for col, val in zip(out, (np.full(len(at), qids[i]), np.full(len(at), qkeys[i]), ids[at], far, np.minimum(left[at], k))):
                col.append(val)
        return pa.table([pa.array(np.concatenate(c), f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def _encoder(seed: int, codes_at: int):
    def run(batches):
        for b in batches:
            dims = b.column(codes_at + 1).to_numpy(zero_copy_only=False)
            out = [[None] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows)]
            vectors = b.column(codes_at)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                codes, length, a = encode(x, rotation(int(d), seed))
                for i, c in zip(at, codes):
                    out[0][i] = c.tobytes()
                out[1][at], out[2][at] = length, a
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out[0], pa.binary()), pa.array(out[1]), pa.array(out[2])],
                                             names=[*b.schema.names, "code", "length", "a"])

    return run


def index(vectors: DataFrame, vec_id: Column, embedding: Column, is_query: Column, seed: int = 1) -> DataFrame:
    """(vec_id, v, dims, copies, q, key, code, length, a): every different row with its number of copies
    and its code; ``key`` tells rows of one id apart. Nothing is fitted: the rotation depends on dimension and seed only."""
    usable = ("vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
              " and exists(v, x -> x <> 0)")
    rows = vectors.select(vec_id.cast("long").alias("vec_id"), embedding.cast("array<double>").alias("v"), is_query.alias("q")).filter(usable)
    each = rows.groupBy("vec_id", "v").agg(F.count("*").alias("copies"), F.bool_or(F.coalesce("q", F.lit(False))).alias("q"))
    each = each.select("vec_id", "v", F.size("v").alias("dims"), "copies", "q", F.xxhash64("vec_id", "v").alias("key"))
    return each.mapInArrow(_encoder(seed, 1), "vec_id long, v array<double>, dims int, copies long, q boolean, key long, code binary, length double, a double")


def nearest(vectors: DataFrame, vec_id: Column, embedding: Column, is_query: Column, k: int, spread: float = 4.0, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``is_query`` the k nearest other rows found, by
    Euclidean distance of the original vectors, nearest first, ties to smaller vec_id.

    Codes are scanned whole, in blocks that meet the queries in blocks of at most QUERY_BLOCK; only rows
    whose error bound reaches the k best are compared, in the same task, and at most k rows per query
    and block leave it. A larger ``spread`` misses less and compares more; at 4 a neighbour is missed
    about once in ten thousand. Vectors that are null, empty, zero or hold a null or non-finite component,
    and rows without id, take no part; vectors of different length are never compared; equal rows are
    counted once with their number of copies, and each is a query and a candidate of its own; fewer
    than k other rows are all returned; an empty table gives no rows."""
    rows = durable(index(vectors, vec_id, embedding, is_query, seed))
    n, nq = rows.agg(F.count("*"), F.count_if("q")).first()
    blocks = max(1, n // min(BLOCK, max(256, n // 64)))
    groups = max(1, -(-(nq or 0) // QUERY_BLOCK))
    spot = F.pmod("key", F.lit(blocks)).cast("int")
    cand = rows.drop("q").withColumn("block", spot).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    quer = rows.filter("q").select("vec_id", "v", "dims", "key", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("part"),
                                   F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    on = ["dims", "block", "part"]
    found = cand.groupBy(*on).cogroup(quer.groupBy(*on)).applyInArrow(
        _block(k, spread, seed), "query_id long, q_key long, vec_id long, score double, copies long")
    order = Window.partitionBy("query_id", "q_key").orderBy("score", "vec_id")
    upto = found.withColumn("upto", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    taken = upto.withColumn("from", F.col("upto") - F.col("copies")).filter(F.col("from") < k)
    ranked = taken.select("query_id", "q_key", "vec_id", "score", F.explode(F.expr(f"sequence(cast(from + 1 as int), cast(least(upto, {k}) as int))")).alias("rank"))
    # every copy of a query row is a query
    times = rows.filter("q and copies > 1").select(F.col("vec_id").alias("query_id"), F.col("key").alias("q_key"), F.col("copies").alias("times"))
    return ranked.join(times, ["query_id", "q_key"], "left").select(
        "query_id", "rank", "vec_id", "score", F.explode(F.array_repeat(F.lit(1), F.coalesce("times", F.lit(1)).cast("int"))).alias("one")).drop("one")
