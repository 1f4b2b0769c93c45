"""Digests of files of any size."""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from frondlake.sources.binary import _files, _open


class Piece(InputPartition):
    """A file that one task hashes: SHA-256 has no parallel form."""

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class DigestReader(DataSourceReader):
    def __init__(self, options, names: list[str]):
        given = {k.lower(): v for k, v in options.items()}
        self.path, self.chunk, self.names = given["path"], int(given.get("chunk", 4 << 20)), names

    def partitions(self):
        system, inner = _open(self.path)
        if system.get_file_info(inner).type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        return [Piece(p) for p in _files(self.path, "")]

    def read(self, part: Piece):
        system, root = _open(self.path)
        state, length = hashlib.sha256(), 0
        with system.open_input_stream(part.path) as f:
            while block := f.read(self.chunk):
                state.update(block)
                length += len(block)
        row = {"path": part.path, "name": os.path.basename(part.path), "relative": os.path.relpath(part.path, root) if part.path != root else os.path.basename(root),
               "length": length, "sha256": state.hexdigest()}
        yield pa.RecordBatch.from_pylist([{n: row[n] for n in self.names}])


class FileDigests(DataSource):
    """Options: path of a file or folder (hidden files left out), chunk, the bytes held at a time."""

    @classmethod
    def name(cls):
        return "file_digests"

    def schema(self):
        return "path string, name string, relative string, length bigint, sha256 string"

    def reader(self, schema):
        return DigestReader(self.options, schema.names)
