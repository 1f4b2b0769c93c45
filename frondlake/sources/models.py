"""COLMAP points and images: records of varying length, read by many tasks and written.

Where a record ends is known only from its own counts, so an offset pass skips through a file from
head to head, decoding nothing, and cuts it where a range has enough bytes. Each range is a task that
seeks to its first record, finds its heads in blocks and decodes the wanted columns with array
operations into Arrow batches. A file of no more than one range skips the pass."""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from frondlake.sources.binary import _files, _open

#: bytes read at a time, and bytes of records in an Arrow batch
READ, BATCH = 4 << 20, 1 << 20


class Layout:
    """Where a record's parts lie: a fixed head, then for images a name ended by a zero byte, a count, and
    that many items of a fixed width. ``fields`` maps a column to (offset in the head, format)."""

    def __init__(self, suffix: str, head: int, named: bool, item: np.dtype, fields: dict, names: dict):
        self.suffix, self.head, self.named, self.item, self.fields, self.names = suffix, head, named, item, fields, names


# fixed values: byte layout of the two COLMAP binary files, little-endian
POINTS = Layout("points3D.bin", 43, False, np.dtype([("image_id", "<i4"), ("point2d_idx", "<i4")]),
                {"point_id": (0, "<i8"), "x": (8, "<f8"), "y": (16, "<f8"), "z": (24, "<f8"), "r": (32, "u1"), "g": (33, "u1"), "b": (34, "u1"), "error": (35, "<f8")},
                {"track": "items"})
IMAGES = Layout("images.bin", 64, True, np.dtype([("x", "<f8"), ("y", "<f8"), ("point_id", "<i8")]),
                {"image_id": (0, "<i4"), "qvec": (4, "<4f8"), "tvec": (36, "<3f8"), "camera_id": (60, "<i4")}, {"name": "name", "keypoints": "items"})


class Records:
    """Record boundaries of a byte stream, found block by block. ``take`` gives (blob, starts, counts,
    name_ends) of the whole records among the next bytes."""

    def __init__(self, path: str, layout: Layout, start: int, end: int):
        self.path, self.layout, self.at, self.end = path, layout, start, end
        system, inner = _open(path)
        self.file = system.open_input_file(inner)
        self.file.seek(start)
        self.held, self.spot = b"", 0

    def _record(self, data: bytes, at: int) -> tuple[int, int, int] | None:
        """(place of the count, count, end) of the record at a place, None if its end is not in data."""
        spot = at + self.layout.head
        if self.layout.named:
            spot = data.find(b"\0", spot) + 1
            if not spot:
                return None
        if spot + 8 > len(data):
            return None
        (n,) = struct.unpack_from("<Q", data, spot)
        return spot, n, spot + 8 + n * self.layout.item.itemsize

    def skip(self) -> int | None:
        """Length of the next record, over which the stream moves; its items are not read. Bytes read stay in
        place until they are used up, so a pass costs as much per record in a block of any size."""
        if self.at >= self.end:
            return None
        while (found := self._record(self.held, self.spot)) is None:
            more = self.file.read(min(READ, max(0, self.end - self.file.tell())))
            if not more:
                raise ValueError(f"{self.path}: truncated record")
            self.held, self.spot = self.held[self.spot:] + more, 0
        size = found[2] - self.spot
        self.at += size
        if self.at > self.end:
            raise ValueError(f"{self.path}: truncated record")
        if found[2] <= len(self.held):
            self.spot = found[2]
        else:
            self.file.seek(self.at)
            self.held, self.spot = b"", 0
        return size

    def batches(self, rows: int):
        """(data, starts, counts, places of the counts) for up to ``rows`` records at a time."""
        data, left = b"", rows
        while left:
            starts, spots, counts, at = [], [], [], 0
            while len(starts) < left and at < max(1, BATCH):
                found = self._record(data, at)
                if found is None or found[2] > len(data):
                    break
                starts.append(at)
                spots.append(found[0])
                counts.append(found[1])
                at = found[2]
            if starts:
                left -= len(starts)
                yield data, np.array(starts), np.array(counts, np.int64), np.array(spots)
                data = data[at:]
                continue
            # the whole of a long record is fetched at once
            want = READ if found is None else max(READ, found[2] - len(data))
            more = self.file.read(min(want, self.end - self.file.tell()))
            if not more:
                raise ValueError(f"{self.path}: truncated record")
            data += more


class RecordRange(InputPartition):
    def __init__(self, path: str, start: int, end: int, rows: int):
        super().__init__((path, start))
        self.path, self.start, self.end, self.rows = path, start, end, rows


def ranges(path: str, layout: Layout, step: int) -> list[RecordRange]:
    """Ranges of whole records of about ``step`` bytes that cover the file."""
    system, inner = _open(path)
    size = system.get_file_info(inner).size
    with system.open_input_file(inner) as f:
        lead = f.read(8)
    if len(lead) < 8:
        raise ValueError(f"{path}: truncated record")
    (count,) = struct.unpack("<Q", lead)
    if size - 8 <= step:
        return [RecordRange(inner, 8, size, count)] if count or size > 8 else []
    out, start, rows, records = [], 8, 0, Records(inner, layout, 8, size)
    for i in range(count):
        if records.skip() is None:
            raise ValueError(f"{path}: truncated record")
        rows += 1
        if records.at - start >= step or i + 1 == count:
            out.append(RecordRange(inner, start, records.at, rows))
            start, rows = records.at, 0
    if records.at != size:
        raise ValueError(f"{path}: unexpected trailing bytes")
    return out


def _gather(data: bytes, starts: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Values of one type at scattered places."""
    raw = np.frombuffer(data, np.uint8)
    return np.ascontiguousarray(raw[starts[:, None] + np.arange(kind.itemsize)]).view(kind).reshape(len(starts))


def _decode(layout: Layout, field: T.StructField, data: bytes, starts, counts, spots) -> pa.Array:
    if field.name in layout.fields:
        offset, form = layout.fields[field.name]
        values = _gather(data, starts + offset, np.dtype(form) if form[1:2] not in "34" else np.dtype([("v", form)]))
        if values.dtype.names:
            flat = np.ascontiguousarray(values).view("<f8")
            width = len(flat) // max(1, len(starts))
            return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), pa.array(flat)) if len(starts) else pa.array([], pa.list_(pa.float64()))
        return pa.array(values.astype("<i4") if values.dtype == np.uint8 else values)
    if layout.names[field.name] == "name":
        return pa.array([data[s + layout.head:e - 1].decode() for s, e in zip(starts.tolist(), spots.tolist())], pa.string())
    ends = np.cumsum(counts)
    first = np.repeat(spots + 8 - (ends - counts) * layout.item.itemsize, counts) + np.arange(ends[-1] if len(ends) else 0) * layout.item.itemsize
    items = _gather(data, first, layout.item)
    wanted = [f.name for f in field.dataType.elementType.fields]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(items[n])) for n in wanted], names=wanted))


class RecordReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType, layout: Layout):
        given = {k.lower(): v for k, v in options.items()}
        self.path, self.schema, self.layout = given["path"], schema, layout
        self.step = int(given.get("bytesperpartition", 64 << 20))

    def partitions(self):
        return [r for p in _files(self.path, self.layout.suffix) for r in ranges(p, self.layout, self.step)]

    def read(self, part: RecordRange):
        records, used = Records(part.path, self.layout, part.start, part.end), part.start
        for data, starts, counts, spots in records.batches(part.rows):
            columns = [_decode(self.layout, f, data, starts, counts, spots) for f in self.schema.fields]
            used += int(spots[-1] + 8 + counts[-1] * self.layout.item.itemsize)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in self.schema.fields])
        if used != part.end:
            raise ValueError(f"{part.path}: unexpected trailing bytes")


class RecordCommit(WriterCommitMessage):
    def __init__(self, temporary: str, final: str):
        self.temporary, self.final = temporary, final


class RecordWriter(DataSourceArrowWriter):
    """One complete file per partition. Records stream to a body file; the count goes in front of it at
    the end, and names appear on commit, so a lost task leaves only a hidden file."""

    def __init__(self, options, schema: T.StructType, overwrite: bool, layout: Layout):
        self.path, self.overwrite, self.layout = dict(options)["path"], overwrite, layout
        missing = {*layout.fields, *layout.names} - set(schema.names)
        if missing:
            raise ValueError(f"a {layout.suffix} needs the columns {sorted(missing)}")
        if not overwrite:
            system, inner = _open(self.path)
            if system.get_file_info(inner).type != fs.FileType.NotFound and _files(self.path, layout.suffix):
                raise ValueError(f"{self.path} already holds a {layout.suffix}")

    def _encoded(self, batch: pa.RecordBatch):
        heads = np.zeros((batch.num_rows, self.layout.head), np.uint8)
        for name, (offset, form) in self.layout.fields.items():
            column = batch.column(batch.schema.get_field_index(name))
            if column.null_count:
                raise ValueError(f"{name} has nulls; a {self.layout.suffix} cannot hold them")
            if form[1:2] in ("3", "4"):
                values = column.flatten().to_numpy(zero_copy_only=False)
                if len(values) != int(form[1]) * batch.num_rows:
                    raise ValueError(f"{name} needs {form[1]} components")
                values = values.astype("<f8").reshape(batch.num_rows, -1)
            else:
                values = column.to_numpy(zero_copy_only=False).astype(form)
            heads[:, offset:offset + np.dtype(form).itemsize] = np.ascontiguousarray(values).view(np.uint8).reshape(batch.num_rows, -1)
        label = batch.column(batch.schema.get_field_index("name")).to_pylist() if self.layout.named else None
        lists = batch.column(batch.schema.get_field_index(next(n for n, k in self.layout.names.items() if k == "items")))
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        items = np.empty(len(flat), self.layout.item)
        for n in self.layout.item.names:
            items[n] = flat.field(n).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        for i in range(batch.num_rows):
            yield heads[i].tobytes()
            if label:
                yield label[i].encode() + b"\0"
            yield struct.pack("<Q", int(sizes[i]))
            yield items[ends[i] - sizes[i]:ends[i]].tobytes()

    def write(self, batches):
        from pyspark import TaskContext

        index, rows = TaskContext.get().partitionId(), 0
        system, inner = _open(self.path)
        system.create_dir(inner, recursive=True)
        body, ready = (f"{inner}/.{k}-{uuid.uuid4().hex}" for k in ("body", "ready"))
        with system.open_output_stream(body) as out:
            for batch in batches:
                for piece in self._encoded(batch):
                    out.write(piece)
                rows += batch.num_rows
        if rows:
            with system.open_output_stream(ready) as out, system.open_input_stream(body) as source:
                out.write(struct.pack("<Q", rows))
                while piece := source.read(READ):
                    out.write(piece)
        system.delete_file(body)
        return RecordCommit(ready, f"{inner}/part-{index:06d}.{self.layout.suffix}") if rows else RecordCommit("", "")

    def commit(self, messages):
        system, inner = _open(self.path)
        old = set(_files(self.path, self.layout.suffix)) if self.overwrite and system.get_file_info(inner).type != fs.FileType.NotFound else set()
        for m in messages:
            if m and m.final:
                system.move(m.temporary, m.final)
                old.discard(m.final)
        for path in old:
            system.delete_file(path)

    def abort(self, messages):
        system, _ = _open(self.path)
        for m in messages:
            if m and m.temporary:
                system.delete_file(m.temporary)


class _Model(DataSource):
    """Options: path, bytesPerPartition. A schema of some of the columns decodes only those."""

    layout: Layout

    def reader(self, schema):
        return RecordReader(self.options, schema, self.layout)

    def writer(self, schema, overwrite):
        return RecordWriter(self.options, schema, overwrite, self.layout)


class ColmapPoints(_Model):
    layout = POINTS

    @classmethod
    def name(cls):
        return "colmap_points"

    def schema(self):
        return ("point_id bigint, x double, y double, z double, r int, g int, b int, error double, "
                "track array<struct<image_id:int,point2d_idx:int>>")


class ColmapImages(_Model):
    layout = IMAGES

    @classmethod
    def name(cls):
        return "colmap_images"

    def schema(self):
        return ("image_id int, qvec array<double>, tvec array<double>, camera_id int, name string, "
                "keypoints array<struct<x:double,y:double,point_id:bigint>>")
