"""Fill-in-the-middle by piece tables.

A document is a list of descriptors (buffer, start, end) over two immutable buffers, its text and the
sentinels. Cutting splits a descriptor, an arrangement permutes descriptors, the inverse permutation
restores the document, and hashes and outputs stream over the descriptors: no text is ever rebuilt by
editing."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frondlake.llm.common import column, pieces

TEXT, MARKS = 0, 1
#: bytes looked at or hashed at a time
STRIDE = 1 << 20
#: order of the parts 0 prefix, 1 middle, 2 suffix in each form
FORMS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}


@dataclass(frozen=True)
class Middle:
    """Parameters of the transformation. ``marks`` stand before prefix, middle and suffix; rates are of a hundred documents."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    marks: tuple[str, str, str] = ("<P>", "<M>", "<S>")


class PieceTable:
    """Descriptors (buffer, start, end) over a text buffer and the buffer of sentinels."""

    def __init__(self, text, marks: bytes, parts: list[tuple[int, int, int]] | None = None):
        self.buffers = (memoryview(text), memoryview(marks))
        self.parts = [(TEXT, 0, len(text))] if parts is None else parts

    def cut(self, places: list[int]) -> PieceTable:
        """The same bytes with a descriptor boundary at each of the ascending text offsets; an offset met
        twice, or at an edge, leaves an empty descriptor, so n places always give n more descriptors."""
        out = []
        for buffer, start, end in self.parts:
            if buffer == TEXT:
                inner = [p for p in places if start <= p <= end]
                places = places[len(inner):]
                for p in inner:
                    out.append((buffer, start, p))
                    start = p
            out.append((buffer, start, end))
        return PieceTable(*self.buffers, out)

    def arranged(self, order: tuple[int, ...]) -> PieceTable:
        """Descriptor number order[j] at place j."""
        return PieceTable(*self.buffers, [self.parts[i] for i in order])

    def marked(self, spans: list[tuple[int, int]]) -> PieceTable:
        """A descriptor of the sentinel buffer, one of ``spans``, before each descriptor."""
        return PieceTable(*self.buffers, [p for (a, b), part in zip(spans, self.parts) for p in ((MARKS, a, b), part)])

    def unmarked(self) -> PieceTable:
        return PieceTable(*self.buffers, [p for p in self.parts if p[0] == TEXT])

    def stream(self):
        for buffer, start, end in self.parts:
            for at in range(start, end, STRIDE):
                yield self.buffers[buffer][at:min(end, at + STRIDE)]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for part in self.stream():
            h.update(part)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.stream())


def _inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(int(i) for i in np.argsort(order))


def _spans(marks: tuple[str, ...]) -> list[tuple[int, int]]:
    ends = np.cumsum([len(m.encode()) for m in marks]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def arrange(text: memoryview, cuts: tuple[int, int], form: str, rule: Middle) -> PieceTable:
    order = FORMS[form]
    spans = _spans(rule.marks)
    return PieceTable(text, "".join(rule.marks).encode()).cut(list(cuts)).arranged(order).marked([spans[i] for i in order])


def restore(output: bytes, form: str, rule: Middle) -> PieceTable:
    """The piece table of the text that became ``output``, from output and form alone: descriptors over
    the output, split at its sentinels, unmarked and put back by the inverse permutation."""
    if form not in FORMS:
        return PieceTable(output, b"")
    order, places, at = FORMS[form], [], 0
    for i in order:
        mark = rule.marks[i].encode()
        at = output.index(mark, at)
        places += [at, at + len(mark)]
        at += len(mark)
    # text bytes and sentinels lie in one buffer here: the odd descriptors are the parts between sentinels
    table = PieceTable(output, b"").cut(places)
    return PieceTable(output, b"", table.parts[2::2]).arranged(_inverse(order))


def _points(data: np.ndarray, start: int, end: int) -> int:
    """Code points of UTF-8 bytes."""
    return sum(int(np.count_nonzero((data[a:min(end, a + STRIDE)] & 0xC0) != 0x80)) for a in range(start, end, STRIDE))


def _draw(doc_id: int | None, seed: int) -> tuple[int, ...]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * j:4 * j + 4], "big") for j in range(4))


def _rows(ids: list, texts: pa.Array, rule: Middle):
    """(n, form, text view, byte cuts, prefix and middle code points) of each text of a batch."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, raw = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    view = memoryview(raw)[lo:hi] if raw is not None else memoryview(b"")
    data, offsets = np.frombuffer(view, np.uint8), (offsets - lo).tolist()
    lines = np.flatnonzero(data == 10)
    edge = np.searchsorted(lines, offsets).tolist()
    marks = [m.encode() for m in rule.marks]
    for k, doc_id in enumerate(ids):
        a, b = offsets[k], offsets[k + 1]
        text, ends = view[a:b], lines[edge[k]:edge[k + 1]]
        n = len(ends) + int(b > a and (not len(ends) or int(ends[-1]) + 1 < b))
        h1, h2, h3, h4 = _draw(doc_id, rule.seed)
        whole = bytes(text)
        if not whole or h3 % 100 >= rule.rate or any(m in whole for m in marks):
            yield n, "plain", whole, None, None, None
            continue
        units = sorted((h1 % (n + 1), h2 % (n + 1)))
        cuts = tuple(0 if u == 0 else b - a if u > len(ends) else int(ends[u - 1]) + 1 - a for u in units)
        form = "spm" if h4 % 100 < rule.spm else "psm"
        yield n, form, whole, cuts, _points(data, a, a + cuts[0]), _points(data, a + cuts[0], a + cuts[1])


_FIELDS = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output_sha256": pa.string(),
           "restored_sha256": pa.string()}
_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def fill_in_middle(docs: DataFrame, rule: Middle = Middle(), id_col: str = "doc_id", text: str = "text", output: bool = True) -> DataFrame:
    """One row per document: (doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)
    and with ``output`` the transformed text.

    A text is cut after whole lines, twice, where a hash of seed and doc_id says; its three parts go
    in the order of the form behind their sentinels. A text that is empty, holds a sentinel or is not
    drawn stays ``plain``. restored_sha256 is the hash of the text rebuilt from output and form.

    One pass without a shuffle; a task holds a batch of texts and one output. Null texts are empty; a
    null id draws like the empty string; repeated rows and ids give a row each; an empty table gives
    none; a very long line is one unit; columns other than id and text are ignored."""
    fields = [*_FIELDS, *(["output"] if output else [])]
    schema = pa.schema([("doc_id", pa.int64()), *[(f, _FIELDS.get(f, pa.string())) for f in fields]])

    def run(batches):
        for batch in batches:
            for b in pieces(batch, 1):
                rows = []
                for n, form, whole, cuts, prefix, middle in _rows(b.column(0).to_pylist(), b.column(1), rule):
                    table = PieceTable(whole, b"") if cuts is None else arrange(whole, cuts, form, rule)
                    out = table.bytes()
                    rows.append((n, form, prefix, middle, table.sha256(), restore(out, form, rule).sha256(), *([out.decode()] if output else [])))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array([r[j] for r in rows], schema.field(f).type) for j, f in enumerate(fields)]], schema=schema)

    slim = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text).cast("string").alias("text"))
    return slim.mapInArrow(run, _DDL + (", output string" if output else ""))


def restored(outputs: DataFrame, rule: Middle = Middle()) -> DataFrame:
    """outputs(doc_id, form, output) with ``text``, the original, rebuilt from output and form."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            for b in pieces(batch, 2):
                texts = [restore((o or "").encode(), f, rule).bytes().decode() for f, o in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], schema=schema)

    return outputs.select(F.col("doc_id").cast("long"), "form", "output").mapInArrow(run, "doc_id long, text string")
