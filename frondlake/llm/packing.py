"""Best-fit packing of documents into fixed-size sequences under conflict constraints."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frondlake.llm.common import column
from frondlake.session import durable

#: documents that are packed together
BLOCK = 4096
_OUT = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("piece", pa.int32()), ("size", pa.int64()), ("block", pa.int32()),
                  ("bin", pa.int32()), ("bin_offset", pa.int64()), ("bin_fill", pa.int64())])
_DDL = "doc_id long, source string, piece int, size long, block int, bin int, bin_offset long, bin_fill long"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item, largest first.

    Open bins are ordered by residual, equal ones by age. Each carries bitmaps of the sources and
    duplicate clusters it holds (layer j of the source bitmap: at least j + 1 items). The search
    starts at the successor of the item's size and goes on to wider residuals until a bin has no
    conflict, which is the tightest compatible one; else a bin is opened."""
    open_: list[tuple[int, int]] = []
    layers: list[list[int]] = []
    seen: list[int] = []
    where, offset = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size, src, dup = sizes[i], 1 << sources[i], 1 << clusters[i]
        at = bisect_left(open_, (size, -1))
        while at < len(open_) and (layers[open_[at][1]][-1] & src or seen[open_[at][1]] & dup):
            at += 1
        if at < len(open_):
            room, b = open_.pop(at)
        else:
            room, b = capacity, len(seen)
            layers.append([0] * per_source)
            seen.append(0)
        where[i], offset[i] = b, capacity - room
        seen[b] |= dup
        for j, layer in enumerate(layers[b]):
            if not layer & src:
                layers[b][j] |= src
                break
        if room > size:
            insort(open_, (room - size, b))
    return where, offset


def _numbers(values: list) -> list[int]:
    known: dict = {}
    return [known.setdefault(v, len(known)) for v in values]


def _pack(capacity: int, per_source: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("mix", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        ids, sizes, src, dup = (t.column(c).to_pylist() for c in ("doc_id", "size", "source", "cluster"))
        rest = [i for i, s in enumerate(sizes) if s % capacity]
        where, offset = best_fit([sizes[i] % capacity for i in rest], _numbers([src[i] for i in rest]), _numbers([dup[i] for i in rest]),
                                 capacity, per_source)
        fill = np.zeros(max(where, default=-1) + 1, np.int64)
        np.add.at(fill, where, [sizes[i] % capacity for i in rest])
        rows = [(ids[i], src[i], sizes[i] // capacity, sizes[i] % capacity, b, o, int(fill[b])) for i, b, o in zip(rest, where, offset)]
        free = len(fill)
        for i, s in enumerate(sizes):
            if s == 0:
                rows.append((ids[i], src[i], 0, 0, None, None, None))
            for piece in range(s // capacity):
                rows.append((ids[i], src[i], piece, capacity, free, 0, capacity))
                free += 1
        block = t.column("block")[0].as_py()
        cols = list(zip(*rows))
        cols.insert(4, [block] * len(rows))
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

    return run


def pack_documents(docs: DataFrame, capacity: int = 2048, per_source: int = 4, id_col: str = "doc_id", text: str = "text",
                   source: str = "source") -> DataFrame:
    """(doc_id, source, piece, size, block, bin, bin_offset, bin_fill): every word of every document at
    one place of one bin of ``capacity`` words. A document of more words is cut: its whole pieces fill
    bins of their own, the last piece is packed. No bin takes two pieces of equal texts (one duplicate
    cluster) or more than ``per_source`` pieces of one source.

    Documents are dealt to blocks of about BLOCK by a hash of id and text, so copies and a hot source
    spread evenly, and each block is packed by best fit in decreasing size; bins are named by
    (block, bin). A null source is a source. A null, empty or blank text has size 0, one row and no
    bin. Repeated rows are documents of one cluster. An empty table gives no rows."""
    t, i = column(docs, text), column(docs, id_col).cast("long")
    slim = durable(docs.select(
        i.alias("doc_id"), column(docs, source).cast("string").alias("source"), F.xxhash64(t).alias("cluster"), F.xxhash64(i, t).alias("mix"),
        F.regexp_count(F.coalesce(t, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size")))
    blocks = max(1, -(-slim.count() // BLOCK))
    dealt = slim.withColumn("block", F.pmod(F.xxhash64("mix"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(_pack(capacity, per_source), _DDL)
