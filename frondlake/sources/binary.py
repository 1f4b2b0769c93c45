"""Python data sources for the binary reconstruction formats.

``splat_ply``: little-endian PLY vertex tables. Records have a fixed width, so a file is read in row
ranges, each partition seeking to its own bytes and decoding only the columns asked for. Writing
produces one complete PLY per partition; coalesce first where a single file is wanted.
``colmap_cameras``: COLMAP camera tables, a record per lens and small. Points and images are in ``models``.
"""

from __future__ import annotations

import io
import os
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# fixed values: PLY scalar spellings, with the Spark type wide enough for each
PLY_TYPES = {
    "char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2",
    "ushort": "u2", "uint16": "u2", "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4",
    "float": "f4", "float32": "f4", "double": "f8", "float64": "f8",
}
SPARK_TYPES = {"i1": "tinyint", "u1": "smallint", "i2": "smallint", "u2": "int", "i4": "int",
               "u4": "bigint", "f4": "float", "f8": "double"}
WRITE_TYPES = {"tinyint": "char", "smallint": "short", "int": "int", "float": "float", "double": "double"}
REQUIRED = ("x", "y", "z", "opacity", "scale_0", "scale_1", "scale_2", "f_dc_0", "f_dc_1", "f_dc_2")
# fixed values: COLMAP camera model id -> (name, parameter count)
CAMERA_MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5),
                 4: ("OPENCV", 8), 5: ("OPENCV_FISHEYE", 8), 6: ("FULL_OPENCV", 12), 7: ("FOV", 5),
                 8: ("SIMPLE_RADIAL_FISHEYE", 4), 9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12)}


def _open(path: str):
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def _files(path: str, suffix: str) -> list[str]:
    """Files under path with the suffix, sorted; each keeps its scheme-less form plus filesystem."""
    system, inner = _open(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [inner]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(suffix) and not os.path.basename(f.path).startswith(("_", ".")))


class PlyHeader:
    """Names and types of the vertex element, where its bytes start and how many rows it declares."""

    def __init__(self, path: str, strict: bool):
        system, inner = _open(path)
        self.path, self.size = inner, system.get_file_info(inner).size
        with system.open_input_stream(inner) as stream:
            head, at = b"", -1
            while at < 0:
                piece = stream.read(65536)
                head += piece
                at = head.find(b"end_header")
                if not piece and at < 0:
                    raise ValueError(f"{path}: truncated PLY header")
        end = head.index(b"\n", at) + 1
        self.raw = head[:end]
        self.lines = self.raw.decode("ascii").splitlines()
        self.offset = end
        words = [l.split() for l in self.lines if l.strip()]
        if words[0] != ["ply"] or ["format", "binary_little_endian", "1.0"] not in words:
            raise ValueError(f"{path}: not a binary little-endian PLY")
        elements = [w for w in words if w[0] == "element"]
        if not elements or elements[0][1] != "vertex" or (strict and len(elements) != 1):
            raise ValueError(f"{path}: the vertex element must come first" + (" and be the only one" if strict else ""))
        self.declared = int(elements[0][2])
        start = words.index(elements[0]) + 1
        stop = words.index(elements[1]) if len(elements) > 1 else len(words)
        self.fields = [(w[2], PLY_TYPES[w[1]]) for w in words[start:stop] if w[0] == "property" and w[1] != "list"]
        if any(w[0] == "property" and w[1] == "list" for w in words[start:stop]):
            raise ValueError(f"{path}: list properties are not a vertex table")
        names = [n for n, _ in self.fields]
        if strict and (len(set(names)) != len(names) or set(REQUIRED) - set(names)):
            raise ValueError(f"{path}: duplicate or missing properties {sorted(set(REQUIRED) - set(names))}")
        self.dtype = np.dtype([(n, "<" + t) for n, t in self.fields])
        self.present = min(self.declared, (self.size - self.offset) // self.dtype.itemsize)
        self.only = len(elements) == 1
        if strict and self.size != self.offset + self.declared * self.dtype.itemsize:
            raise ValueError(f"{path}: extra or missing bytes after the vertex block")

    def counted(self, rows: int) -> bytes:
        """The header as it stands, for another number of rows."""
        line = b"element vertex %d" % rows
        ends = lambda l: l[len(l.rstrip(b"\r\n")):]
        return b"".join(line + ends(l) if l.split()[:2] == [b"element", b"vertex"] else l for l in self.raw.splitlines(keepends=True))


class PlyRange(InputPartition):
    def __init__(self, path: str, offset: int, first: int, base: int, rows: int):
        super().__init__((path, first))
        self.path, self.offset, self.first, self.base, self.rows = path, offset, first, base, rows


class PlyReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options, self.schema = {k.lower(): v for k, v in options.items()}, schema
        self.strict = self.options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.step = int(self.options.get("rowsperpartition", 2_000_000))
        self.batch = int(self.options.get("rowsperbatch", 65_536))

    def partitions(self):
        parts, base = [], 0
        for path in _files(self.options["path"], ".ply"):
            head = PlyHeader(path, self.strict)
            self.fields = head.fields
            for first in range(0, head.present, self.step):
                parts.append(PlyRange(path, head.offset, first, base + first, min(self.step, head.present - first)))
            base += head.present
        return parts

    def read(self, part: PlyRange):
        head = PlyHeader(part.path, self.strict)
        arrow = T.StructType(self.schema.fields)
        names = [f.name for f in arrow.fields]
        system, inner = _open(part.path)
        with system.open_input_file(inner) as f:
            f.seek(part.offset + part.first * head.dtype.itemsize)
            done = 0
            while done < part.rows:
                n = min(self.batch, part.rows - done)
                data = f.read(n * head.dtype.itemsize)
                rows = np.frombuffer(data, head.dtype, count=n)
                columns = []
                for field in arrow.fields:
                    if field.name == "record":
                        places = np.arange(n + 1, dtype=np.int32) * np.int32(head.dtype.itemsize)
                        columns.append(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(places), pa.py_buffer(data)]))
                        continue
                    if field.name == "short":
                        columns.append(pa.array(np.full(n, head.present < head.declared)))
                        continue
                    if field.name == "row_id":
                        columns.append(pa.array(np.arange(part.base + done, part.base + done + n), pa.int64()))
                        continue
                    values = np.ascontiguousarray(rows[field.name])
                    if self.strict and field.name in REQUIRED and not np.isfinite(values).all():
                        raise ValueError(f"{part.path}: non-finite {field.name}")
                    kind = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(),
                            "float": pa.float32(), "double": pa.float64()}[field.dataType.simpleString()]
                    columns.append(pa.array(values).cast(kind))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                done += n


class PlyCommit(WriterCommitMessage):
    def __init__(self, temporary: str, final: str):
        self.temporary, self.final = temporary, final


class PlyWriter(DataSourceArrowWriter):
    """Streams each partition's records to a body file, then puts the header in front of it. A task
    that is retried leaves an uncommitted temporary file only; names appear on commit."""

    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = dict(options)["path"], schema, overwrite
        system, inner = _open(self.path)
        there = system.get_file_info(inner)
        if there.type != fs.FileType.NotFound and not overwrite and _files(self.path, ".ply"):
            raise ValueError(f"{self.path} already holds PLY files")
        self.names = [f.name for f in schema.fields if f.name != "row_id"]
        self.like = None
        if self.names == ["record"]:
            self.like = PlyHeader(dict(options)["like"], False)
            if not self.like.only:
                raise ValueError(f"{self.like.path}: records of a file with further elements are not a file of their own")
            self.kinds = []
            return
        self.kinds = [WRITE_TYPES[schema[n].dataType.simpleString()] for n in self.names]

    def write(self, batches):
        from pyspark import TaskContext

        index = TaskContext.get().partitionId()
        system, inner = _open(self.path)
        system.create_dir(inner, recursive=True)
        dtype = self.like.dtype if self.like else np.dtype([(n, "<" + PLY_TYPES[k]) for n, k in zip(self.names, self.kinds)])
        temporary = f"{inner}/.body-{uuid.uuid4().hex}"
        rows = 0
        with system.open_output_stream(temporary) as out:
            for batch in batches:
                if self.like:
                    records = batch.column(batch.schema.get_field_index("record")).to_pylist()
                    if any(r is None or len(r) != dtype.itemsize for r in records):
                        raise ValueError(f"a record of {self.like.path} has {dtype.itemsize} bytes")
                    out.write(b"".join(records))
                    rows += batch.num_rows
                    continue
                block = np.empty(batch.num_rows, dtype)
                for n in self.names:
                    column = batch.column(batch.schema.get_field_index(n))
                    if column.null_count:
                        raise ValueError(f"{n} has nulls; a PLY cannot hold them")
                    block[n] = column.to_numpy(zero_copy_only=False)
                out.write(block.tobytes())
                rows += batch.num_rows
        if not rows:
            system.delete_file(temporary)
            return PlyCommit("", "")
        lines = ["ply", "format binary_little_endian 1.0", f"element vertex {rows}",
                 *[f"property {k} {n}" for n, k in zip(self.names, self.kinds)], "end_header"]
        ready = f"{inner}/.ready-{uuid.uuid4().hex}"
        with system.open_output_stream(ready) as out, system.open_input_stream(temporary) as body:
            out.write(self.like.counted(rows) if self.like else ("\n".join(lines) + "\n").encode("ascii"))
            while piece := body.read(4 << 20):
                out.write(piece)
        system.delete_file(temporary)
        return PlyCommit(ready, f"{inner}/part-{index:06d}.ply")

    def commit(self, messages):
        system, _ = _open(self.path)
        old = set(_files(self.path, ".ply")) if self.overwrite else set()
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


class SplatPly(DataSource):
    """Options: path, mode (PERMISSIVE keeps the readable rows of a short file, FAILFAST refuses),
    rowsPerPartition, rowsPerBatch. Pass a schema to decode only some of the columns; beside those of the
    file it may hold row_id, ``record`` (the row's bytes as they stand) and ``short`` (whether the row's
    file has fewer rows than it declares). A table of row_id and ``record`` is written byte for byte
    under the header of the file that the option ``like`` names, with the number of rows changed."""

    @classmethod
    def name(cls):
        return "splat_ply"

    def schema(self):
        files = _files(self.options["path"], ".ply")
        if not files:
            raise ValueError(f"no PLY under {self.options['path']}")
        head = PlyHeader(files[0], False)
        return "row_id bigint, " + ", ".join(f"`{n}` {SPARK_TYPES[t]}" for n, t in head.fields)

    def reader(self, schema):
        return PlyReader(self.options, schema)

    def writer(self, schema, overwrite):
        return PlyWriter(self.options, schema, overwrite)


class FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class ModelReader(DataSourceReader):
    """COLMAP records of one kind, streamed from a buffered file."""

    def __init__(self, options, kind: str):
        self.path, self.kind = dict(options)["path"], kind

    def partitions(self):
        return [FilePartition(p) for p in _files(self.path, f"{self.kind}.bin")]

    def read(self, part: FilePartition):
        system, inner = _open(part.path)
        with io.BufferedReader(system.open_input_file(inner), 4 << 20) as f:

            def take(form):
                size = struct.calcsize(form)
                data = f.read(size)
                if len(data) != size:
                    raise ValueError(f"{part.path}: truncated record")
                return struct.unpack(form, data)

            (count,) = take("<Q")
            for _ in range(count):
                yield getattr(self, "_" + self.kind)(f, take)
            if f.read(1):
                raise ValueError(f"{part.path}: unexpected trailing bytes")

    def _cameras(self, f, take):
        cid, model, width, height = take("<iiQQ")
        name, n = CAMERA_MODELS[model]
        return cid, name, width, height, list(take(f"<{n}d"))


class ColmapCameras(DataSource):
    @classmethod
    def name(cls):
        return "colmap_cameras"

    def schema(self):
        return "camera_id int, model string, width bigint, height bigint, params array<double>"

    def reader(self, schema):
        return ModelReader(self.options, "cameras")


def register(spark: SparkSession) -> None:
    from frondlake.sources.models import ColmapImages, ColmapPoints

    for source in (SplatPly, ColmapPoints, ColmapImages, ColmapCameras):
        spark.dataSource.register(source)
