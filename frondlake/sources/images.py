"""Sizes of images from their headers: a few bytes of each file are read, whatever its length."""

from __future__ import annotations

import os
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from frondlake.sources.binary import _files, _open

#: fixed values: JPEG markers that open a frame, and those without a length
FRAMES = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
BARE = {0x01, *range(0xD0, 0xD8)}


def header_size(f) -> tuple[int | None, int | None]:
    """(width, height) of a seekable PNG or JPEG; nulls for anything else and for files that end too soon."""
    head = f.read(24)
    if head[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", head[16:24]) if head[12:16] == b"IHDR" and len(head) == 24 else (None, None)
    at = 2
    while head[:2] == b"\xff\xd8":
        f.seek(at)
        segment = f.read(9)
        if len(segment) < 4 or segment[0] != 0xFF:
            break
        marker = segment[1]
        if marker == 0xFF or marker in BARE:
            at += 1 if marker == 0xFF else 2
        elif marker in FRAMES:
            return struct.unpack(">HH", segment[5:9])[::-1] if len(segment) == 9 else (None, None)
        else:
            at += 2 + struct.unpack(">H", segment[2:4])[0]
    return None, None


class Some(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(tuple(paths))
        self.paths = paths


class SizeReader(DataSourceReader):
    def __init__(self, options, names: list[str]):
        given = {k.lower(): v for k, v in options.items()}
        self.path, self.many, self.names = given["path"], int(given.get("filesperpartition", 512)), names

    def partitions(self):
        found = _files(self.path, "")
        return [Some(found[i:i + self.many]) for i in range(0, len(found), self.many)] or [Some([])]

    def read(self, part: Some):
        system, _ = _open(self.path)
        rows = []
        for path in part.paths:
            with system.open_input_file(path) as f:
                width, height = header_size(f)
                rows.append({"path": path, "name": os.path.basename(path), "length": f.size(), "width": width, "height": height})
        kinds = {"path": pa.string(), "name": pa.string(), "length": pa.int64(), "width": pa.int64(), "height": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in self.names], names=self.names)


class ImageSizes(DataSource):
    """Options: path of a file or folder (hidden files left out), filesPerPartition."""

    @classmethod
    def name(cls):
        return "image_sizes"

    def schema(self):
        return "path string, name string, length bigint, width bigint, height bigint"

    def reader(self, schema):
        return SizeReader(self.options, schema.names)


def image_sizes(spark: SparkSession, path: str, files_per_partition: int = 512) -> DataFrame:
    spark.dataSource.register(ImageSizes)
    return spark.read.format("image_sizes").option("path", path).option("filesPerPartition", files_per_partition).load()
