"""Shared helpers: batches of whole texts, vectorised word hashes, packed integer columns."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = b" \t\n\x0b\x0c\r"
#: bytes of text in a batch: small inputs are cut finer for parallelism, very large ones coarser so
#: that the blocks exchanged between batches and hash ranges stay few
BATCH_BYTES = (256 << 10, 4 << 20, 32 << 20)
CHUNK, LONG_WORD = 1 << 18, 1 << 20
_SEED = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


mix = _mix


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
        done += take
    return out


class _Tables:
    """Powers of the hash base and their inverses, and a random value per byte; made once a worker."""

    base, size = 0xD6E8FEB86659FD93, 0

    @classmethod
    def upto(cls, n: int):
        if n > cls.size:
            cls.size = max(n, CHUNK + 4096)
            cls.pow, cls.inv = _powers(cls.base, cls.size), _powers(pow(cls.base, -1, 1 << 64), cls.size)
            plain = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_SEED))
            lower = plain.copy()
            lower[65:91] = plain[97:123]
            cls.byte = {False: plain, True: lower}
        return cls


class Words:
    """Words of a batch of texts: byte offsets into ``data``, 64-bit hashes, words per text."""

    def __init__(self, texts, lower: bool = False, separators: bytes = SPACES, hashes: bool = True, clean=None):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
            if isinstance(texts, pa.ChunkedArray):
                texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
        texts = texts.fill_null("").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        self.n = len(texts)
        self.offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        # a slice shares the buffer of its whole batch: only its own part is looked at
        base, hi = int(self.offsets[0]), int(self.offsets[-1])
        self.data = np.frombuffer(data, np.uint8)[base:hi] if data is not None and hi > base else np.zeros(0, np.uint8)
        self.offsets, lo, hi = self.offsets - base, 0, hi - base
        if clean is not None and len(self.data):
            self.data = clean(self.data.copy())
        sep = np.zeros(256, bool)
        sep[list(separators)] = True
        gap = sep[self.data[lo:hi]]
        solid = ~gap
        first, last = solid.copy(), solid.copy()
        first[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        cuts = self.offsets[:-1] - lo
        cuts = cuts[cuts < hi - lo]
        first[cuts] = solid[cuts]
        cuts = cuts[cuts > 0] - 1
        last[cuts] = solid[cuts]
        self.starts, self.ends = np.flatnonzero(first) + lo, np.flatnonzero(last) + lo + 1
        edge = np.searchsorted(self.starts, self.offsets)
        self.first = edge[:-1]
        self.count = np.diff(edge)
        self.doc = np.repeat(np.arange(self.n), self.count)
        self.hash = self._hash(lower) if hashes else None

    def _hash(self, lower: bool) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(self.starts):
            a = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, a + CHUNK, "right")))
            b = int(self.ends[j - 1])
            if b - a > LONG_WORD:
                word = self.data[a:b].tobytes()
                out[i] = xxhash.xxh3_64_intdigest(word.lower() if lower else word)
            else:
                t = _Tables.upto(b - a)
                run = np.zeros(b - a + 1, np.uint64)
                np.cumsum(t.byte[lower][self.data[a:b]] * t.pow[:b - a], out=run[1:])
                s = self.starts[i:j] - a
                out[i:j] = (run[self.ends[i:j] - a] - run[s]) * t.inv[s]
            i = j
        return _mix(out + (self.ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def ngrams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (positions of one array; texts are not told apart)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += words[j:j + n] * np.uint64(pow(_SEED, j + 1, 1 << 64))
    return _mix(out)


def inside(doc: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each position on belong to one text."""
    n = len(doc) - k + 1
    return doc[:n] == doc[k - 1:] if n > 0 else np.zeros(0, bool)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """64-bit integers as a base and the fewest bytes a value; ``rising`` stores differences."""
    v = np.ascontiguousarray(values).view(np.uint64) if values.dtype.itemsize == 8 else values.astype(np.uint64)
    if not len(v):
        return b""
    if rising:
        base, rest = v[0], np.diff(v, prepend=v[0])
    else:
        signed = v.view(np.int64)
        base = np.uint64(int(signed.min()) & (1 << 64) - 1)
        rest = v - base
    width = max(1, (int(rest.max()).bit_length() + 7) // 8)
    return base.tobytes() + bytes([width]) + rest.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(blob: bytes, rising: bool = False) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    width = blob[8]
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    rest, base = wide.view(np.uint64).reshape(-1), np.frombuffer(blob, np.uint64, 1)[0]
    return np.cumsum(rest, dtype=np.uint64) + base if rising else rest + base


def pieces(batch: pa.RecordBatch, text: int, limit: int = 2 << 20):
    """Slices of a batch of about so many bytes of text in its column number ``text``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right"))
        upto = max(at + 1, upto)
        yield batch.slice(at, upto - at)
        at = upto


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return df["`" + name.replace("`", "``") + "`"]


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column(docs, text))).alias("b")).first()["b"] or 0


def batch_count(total: int) -> int:
    """Batches for so many bytes of text."""
    least, usual, most = BATCH_BYTES
    size = min(max(total // 64, least), usual) if total < usual * 4096 else min(total // 4096, most)
    return max(1, math.ceil(total / size))


#: rows of a side that may be sent whole to every executor: about 40 MB of keys
BROADCAST_ROWS = 1_000_000


def bounded(side: DataFrame) -> DataFrame:
    """A written side of a join, marked for broadcast if it has few rows; else the join shuffles."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
