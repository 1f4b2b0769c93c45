"""Exact top-k inner products by columnar branch and bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.session import durable

#: queries that meet a candidate block together; dimensions summed before each look at the bounds
QUERY_BLOCK, STEP = 4096, 8


def _matrix(t: pa.Table) -> np.ndarray:
    """(dimensions, rows): one contiguous row per dimension, the vertical layout."""
    flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(t.num_rows, -1).T)


def _search(q: np.ndarray, x: np.ndarray, tail: np.ndarray, ids: np.ndarray, live: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k of the columns ``live`` of x for one query: partial sums by blocks of dimensions; a candidate
    stays while its sum plus the largest product its remaining mass allows reaches the k-th best
    score known (equal scores stay). tail[i]: root of the mass from dimension i on."""
    if not len(live):
        return live, live
    mass = np.sqrt(np.append(np.cumsum((q * q)[::-1])[::-1], 0))
    total, floor = np.zeros(len(live), q.dtype), None
    for at in range(0, len(q), STEP):
        part = x[at:at + STEP]
        total = total + q[at:at + STEP] @ (part if len(live) == x.shape[1] else part[:, live])
        done = at + STEP
        if done >= len(q) or len(live) <= k:
            continue
        if floor is None:  # whole scores of the k best so far bound the k-th best from below
            lead = np.argpartition(total, len(total) - k)[-k:]
            floor = (total[lead] + q[done:] @ x[done:][:, live[lead]]).min()
        keep = total + (mass[done] * tail[done, live]) * (1 + 1e-9) + 1e-6 >= floor
        if not keep.all():
            live, total = live[keep], total[keep]
    order = np.lexsort((ids[live], -total))[:k]
    return live[order], total[order]


def _block(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("q_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(cand: pa.Table, quer: pa.Table) -> pa.Table:
        if not cand.num_rows or not quer.num_rows:
            return schema.empty_table()
        x, qs = _matrix(cand), _matrix(quer)
        ids, keys, qids, qkeys = (t.column(c).to_numpy() for t in (cand, quer) for c in ("vec_id", "key"))
        # a row stands for all its copies; k of them are enough, and one fewer of the query's own
        copies = np.minimum(cand.column("copies").to_numpy(), k + 1)
        at = np.repeat(np.arange(len(ids)), copies)
        lone = np.arange(len(at)) == np.cumsum(copies)[at] - 1
        ids, keys, x = ids[at], keys[at], x[:, at]
        d = x.shape[0]
        large = float(np.abs(x).max(initial=0)) * float(np.abs(qs).max(initial=0)) * max(d, 1)
        if large < 2 ** 53:  # every partial sum is exact in doubles
            x, qs = x.astype(float), qs.astype(float)
        order = np.argsort(-(x.astype(float) ** 2).sum(1), kind="stable")
        x, qs = np.ascontiguousarray(x[order]), np.ascontiguousarray(qs[order].T)
        tail = np.zeros((d + 1, x.shape[1]))
        np.cumsum((x.astype(float) ** 2)[::-1], axis=0, out=tail[:d][::-1])
        tail = np.sqrt(tail)
        got = []
        for i, key, q in zip(qids, qkeys, qs):
            own = lone & (ids == i) & (keys == key)
            own[own] = (x[:, own] == q[:, None]).all(0)
            best, score = _search(q, x, tail, ids, np.flatnonzero(~own), k)
            got.append((np.full(len(best), i), np.full(len(best), key), ids[best], score))
        return pa.table([np.concatenate([g[j] for g in got]).astype(np.int64) for j in range(4)], schema=schema)

    return run


def exact_topk(vectors: DataFrame, vec_id: Column, embedding: Column, is_query: Column, k: int, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``is_query`` the k other rows with the largest
    integer inner product of floor(scale * component), ties to smaller ids.

    Candidates form blocks in vertical layout; each block meets the queries in blocks of at most
    QUERY_BLOCK, and only its k best per query leave the task. A vector that is null or holds a null
    or non-finite component, and a row without id, takes no part; vectors of different length are
    never compared; rows may share an id: each is a query and a candidate of its own, equal ones
    travel once with their number; fewer than k other rows are all returned; an empty table gives no
    rows; columns other than the three are ignored. Sums are exact in 64 bits, beyond the range where doubles are; a score must fit there."""
    whole = vectors.select(vec_id.cast("long").alias("vec_id"), embedding.cast("array<double>").alias("e"), is_query.alias("q")) \
        .filter("vec_id is not null and e is not null and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = whole.select("vec_id", "q", F.transform("e", lambda x: F.floor(x * scale)).alias("v"), F.size("e").alias("dims"))
    rows = rows.groupBy("vec_id", "v").agg(F.first("dims").alias("dims"), F.count("*").alias("copies"), F.bool_or(F.coalesce("q", F.lit(False))).alias("q")) \
        .withColumn("key", F.xxhash64("vec_id", "v"))
    rows = durable(rows)
    n, nq = rows.agg(F.count("*"), F.count_if("q")).first()
    blocks = max(1, n // min(4096, max(256, n // 64)))
    groups = max(1, -(-(nq or 0) // QUERY_BLOCK))
    on = ["dims", "block", "part"]
    cand = rows.select("vec_id", "v", "dims", "key", "copies", F.pmod("key", F.lit(blocks)).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    quer = rows.filter("q").select("vec_id", "v", "dims", "key", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                                   F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("part"))
    best = cand.groupBy(*on).cogroup(quer.groupBy(*on)).applyInArrow(_block(k), "query_id long, q_key long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "q_key").orderBy(F.desc("score"), "vec_id"))
    top = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    # every copy of a query row is a query
    times = rows.filter("q and copies > 1").select(F.col("vec_id").alias("query_id"), F.col("key").alias("q_key"), F.col("copies").alias("times"))
    return top.join(times, ["query_id", "q_key"], "left").select(
        "query_id", "rank", "vec_id", "score", F.explode(F.array_repeat(F.lit(1), F.coalesce("times", F.lit(1)).cast("int"))).alias("one")).drop("one")
