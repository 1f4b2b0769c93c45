"""File listings, manifests, image headers, settings files, JSON records and CSV tables."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frondlake.operators.ordered import Ordered, ordered
from frondlake.session import durable

COMPARISON = "relpath STRING, identical STRING, tp STRING, fp STRING, fn STRING, tn STRING, iou STRING, dice STRING, note STRING"
JOB = ("kind STRING, id STRING, capture_id STRING, status STRING, started_at STRING, "
       "progress STRUCT<schema_version: INT, milestones: ARRAY<STRUCT<name: STRING, at: STRING>>>, ini MAP<STRING, MAP<STRING, STRING>>")


def listing(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (), content: bool = False) -> DataFrame:
    """Files below path (recursive), hidden ones left out, with name, suffix, length and time."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    df = df.withColumn("name", name).withColumn("suffix", F.lower(F.regexp_extract("name", r"(\.[^.]+)$", 1)))
    df = df.filter(~F.startswith("name", F.lit(".")))
    if suffixes:
        df = df.filter(F.col("suffix").isin(*suffixes))
    keep = ["path", "name", "suffix", "length", "modificationTime"]
    return df.select(*keep, *(["content"] if content else []))


def manifest(spark: SparkSession, path: str, chunk: int = 4 << 20) -> DataFrame:
    """(path, name, length, sha256) per file below path: a task hashes a file in chunks, so no content
    is ever a value and a file may have any size."""
    from frondlake.sources.digests import FileDigests

    spark.dataSource.register(FileDigests)
    return spark.read.format("file_digests").option("path", path).option("chunk", chunk).load()


def tree_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row: files, bytes and a digest of a folder, the sha256 over the sorted lines "digest  relative path"
    in blocks, so that two folders with the same files at the same places have the same digest."""
    from frondlake.operators.relations import fingerprint

    m = manifest(spark, path)
    lines = m.select(F.lit(0).alias("k"), "relative", F.concat("sha256", F.lit("  "), "relative", F.lit("\n")).alias("line"))
    total = m.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return total.join(fingerprint(lines, ["k"], ["relative"], F.col("line")).select("sha256"), F.lit(True), "left")


def folder_size(spark: SparkSession, path: str) -> DataFrame:
    return listing(spark, path).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def png_size(content: Column) -> Column:
    """struct(width, height) of a PNG, null for anything else; plain byte arithmetic."""
    ok = F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A"

    def number(at):
        return F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")

    return F.when(ok & (F.hex(F.substring(content, 13, 4)) == "49484452"), F.struct(number(17).alias("width"), number(21).alias("height")))


SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


@F.pandas_udf(SIZE)
def jpeg_size(content: pd.Series) -> pd.DataFrame:
    """Size from the first start-of-frame segment of each JPEG, null when there is none."""
    frames = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}

    def one(data):
        at = 2
        if data is None or data[:2] != b"\xff\xd8":
            return None, None
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                return None, None
            marker = data[at + 1]
            if marker == 0xFF or marker == 0x01 or 0xD0 <= marker <= 0xD7:
                at += 1 if marker == 0xFF else 2
                continue
            (size,) = struct.unpack(">H", data[at + 2:at + 4])
            if marker in frames:
                h, w = struct.unpack(">HH", data[at + 5:at + 9])
                return w, h
            at += 2 + size
        return None, None

    return pd.DataFrame([one(c) for c in content], columns=["width", "height"]).astype("Int32")


def comparison_csv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """A mask-comparison table with typed columns; unreadable numbers become null, notes blank."""
    df = spark.read.option("header", True).csv(path)
    missing = {"relpath", "identical", "tp", "fp", "fn", "tn", "iou", "dice", "note"} - set(df.columns)
    if missing:
        raise ValueError(f"{path} misses columns {sorted(missing)}")
    return df.select(F.lit(dataset).alias("dataset_id"), "relpath", (F.lower("identical") == "true").alias("identical"),
                     *[F.col(c).try_cast("double").alias(c) for c in ("tp", "fp", "fn", "tn", "iou", "dice")],
                     F.trim(F.coalesce("note", F.lit(""))).alias("note"))


def frame_csv(spark: SparkSession, path: str, capture: str, time_columns: tuple[str, ...] = ("source_seconds_approx", "output_grid_seconds")) -> DataFrame:
    """filename and seconds: the first time column present, else the position in name order."""
    df = spark.read.option("header", True).csv(path)
    have = [c for c in time_columns if c in df.columns]
    if have:
        return df.select(F.lit(capture).alias("capture"), "filename", F.coalesce(*[F.col(c).try_cast("double") for c in have]).alias("seconds"))
    placed = ordered(df.select(F.lit(capture).alias("capture"), "filename"), ["capture"], ["filename"], Ordered(rank="rn"))
    return placed.select("capture", "filename", (F.col("rn") - 1).cast("double").alias("seconds"))


def write_csv(df: DataFrame, path: str, digits: int | None = None) -> None:
    """Header, nulls as empty cells, numbers rounded half-even when digits is given."""
    if digits is not None:
        df = df.select(*[F.bround(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                         for f in df.schema.fields])
    df.write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def run_log(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Run logs of any header age as one table, NUL bytes removed, the last row per run kept."""
    out = None
    for turn, p in enumerate(paths):
        one = spark.read.option("header", True).csv(p)
        one = one.select(*[F.translate(c, "\0", "").alias(c) for c in one.columns],
                         F.struct(F.lit(turn).alias("t"), F.col("_metadata.file_block_start").alias("f"), F.monotonically_increasing_id().alias("n")).alias("__pos"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    row = F.struct(*[c for c in out.columns if c not in ("run_id", "__pos")])
    return out.groupBy("run_id").agg(F.max_by(row, "__pos").alias("r")).select("run_id", "r.*")


def evolving_log(spark: SparkSession, paths: list[str], key: str = "run_id", widest: int = 256) -> DataFrame:
    """A log whose header changes within a file: each row is read under the last header above it, the
    headers of all files are united (columns in order of first appearance) and the last row per key is
    kept; later paths count as later. A line whose first cell is ``key`` is a header. NUL bytes go, rows
    above any header and empty lines are left out, cells beyond the header are dropped, missing ones
    and columns a header lacks are null. At most ``widest`` cells a line are read."""
    cells = ", ".join(f"c{i} STRING" for i in range(widest))
    every = None
    for turn, p in enumerate(paths):
        lines = spark.read.text(p).select(F.lit(turn).alias("turn"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                          F.monotonically_increasing_id().alias("n"), F.translate("value", "\0", "").alias("line"))
        every = lines if every is None else every.unionByName(lines)
    every = durable(every.filter("trim(line) <> ''").withColumn("cells", F.from_csv("line", cells))
                    .withColumn("cells", F.array(*[F.col(f"cells.c{i}") for i in range(widest)])))
    header = F.when(F.trim(F.get("cells", F.lit(0))) == key, F.transform(F.filter("cells", lambda c: c.isNotNull()), F.trim))
    placed = ordered(every.withColumn("header", header), ["turn", "file"], ["at", "n"], Ordered(carries={"under": F.col("header")}))
    rows = durable(placed.filter("header is null and under is not null").select("turn", "file", "at", "n", "under", "cells"))
    seen = placed.filter("header is not null").select(F.struct("turn", "file", "at", "n").alias("o"), F.posexplode("header").alias("i", "name"))
    # the names are the columns of the result: as many as its schema has
    names = [r["name"] for r in seen.groupBy("name").agg(F.min(F.struct("o", "i")).alias("first")).orderBy("first").collect() if r["name"]]
    value = F.map_from_entries(F.transform(F.array_distinct("under"), lambda h: F.struct(h, F.get("cells", (F.array_position("under", h) - 1).cast("int")))))
    mapped = rows.withColumn("m", value)
    last = mapped.groupBy(F.try_element_at("m", F.lit(key)).alias(key)).agg(F.max_by("m", F.struct("turn", "file", "at", "n")).alias("m"))
    return last.select(key, *[F.try_element_at("m", F.lit(n)).alias(n) for n in names if n != key])


def jobs(spark: SparkSession, path: str) -> DataFrame:
    """Catalog jobs: unreadable records and other kinds dropped, absent progress read as version 0."""
    df = spark.read.schema(JOB).option("mode", "DROPMALFORMED").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return df.filter("kind = 'job'").withColumn("schema_version", F.coalesce("progress.schema_version", F.lit(0)))


def poses(spark: SparkSession, path: str) -> DataFrame:
    """One row per frame of a transforms JSON: path, numeric id in the name, matrix, image id."""
    df = spark.read.option("multiLine", True).schema(
        "frames ARRAY<STRUCT<file_path: STRING, transform_matrix: ARRAY<ARRAY<DOUBLE>>, colmap_im_id: BIGINT>>").json(path)
    f = df.select(F.explode("frames").alias("f")).select("f.*")
    return f.withColumn("frame_id", F.regexp_extract("file_path", r"(\d+)(?=\.[^.]+$)", 1).try_cast("bigint"))


def settings(spark: SparkSession, path: str) -> DataFrame:
    """(file, section, key, value) of INI files: each file's lines become runs that start at a
    section heading. A settings file is a page of text, read whole; files are spread over tasks."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    blocks = text.select("file", F.explode(F.split("value", r"(?m)^(?=\s*\[)")).alias("block"))
    blocks = blocks.select("file", F.regexp_extract("block", r"^\s*\[([^\]]+)\]", 1).alias("section"), F.explode(F.split("block", r"\r?\n")).alias("line"))
    rows = blocks.filter(F.col("line").rlike(r"^[^#;\[\s][^=:]*[=:]") & (F.col("section") != ""))
    return rows.select("file", "section", F.lower(F.trim(F.regexp_extract("line", r"^([^=:]+)[=:]", 1))).alias("key"),
                       F.trim(F.regexp_extract("line", r"^[^=:]+[=:](.*)$", 1)).alias("value"))


def probe_lines(df: DataFrame, run: str, pos: str, text: str, schema: str) -> DataFrame:
    """Last line of each run that parses as a JSON object, a byte-order mark ignored."""
    clean = F.regexp_replace(text, "^﻿", "")
    parsed = df.select(run, pos, F.from_json(clean, schema, {"mode": "PERMISSIVE"}).alias("j"), clean.alias("t"))
    ok = F.trim("t").rlike(r"^\{.*\}$")
    return parsed.groupBy(run).agg(F.max_by("j", F.when(ok, F.col(pos))).alias("j")).select(run, "j.*")
