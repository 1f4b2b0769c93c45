"""Proportional stratified interleaving of rows into shards."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frondlake.llm.common import column
from frondlake.session import durable


def interleave(docs: DataFrame, shards: int, stratum: Column, row_id: Column, text: Column, seed: int = 1) -> DataFrame:
    """(doc_id, size, text_crc32, stratum, shard, slot): rows are shuffled by a seeded hash within
    their stratum, sorted over all strata by fractional rank (rank + u) / rows of the stratum, u being
    a seeded fraction of the stratum's own, and cut into ``shards`` runs whose row counts differ by at
    most one; so every shard holds each stratum's share to within a row or two, and strata of few rows
    spread over all shards. ``slot`` counts from 0 in each shard.

    Two levels of about sqrt(rows) rows keep every group small: hash buckets of a stratum give the
    rank, slices of the fractional rank the position, and only their counts are summed up in order.
    A null stratum is a stratum of its own; a null text has size 1 (0 bytes and the separator) and
    the checksum of no bytes; rows equal in id and text are interchangeable; an empty table gives
    no rows. Other columns are ignored."""
    slim = durable(docs.select(
        row_id.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("")).alias("stratum"))
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")))
    rows = slim.count()
    cells = max(1, rows // max(256, isqrt(rows)))
    order = ("h", "doc_id", "text_crc32", "size")
    slim = slim.withColumn("bucket", F.pmod("h", F.lit(cells)).cast("int"))
    in_order = Window.partitionBy("stratum").orderBy("bucket")
    sums = slim.groupBy("stratum", "bucket").agg(F.count("*").alias("n")) \
        .withColumn("before", F.sum("n").over(in_order) - F.col("n")) \
        .withColumn("of", F.sum("n").over(Window.partitionBy("stratum"))).drop("n")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy(*order)) - 1
    offset = (F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), "stratum"), F.lit(1 << 20)) + F.lit(0.5)) / F.lit(float(1 << 20))
    ranked = slim.join(sums, ["stratum", "bucket"]).withColumn("share", (rank + offset) / F.col("of")) \
        .withColumn("slice", F.floor(F.col("share") * cells).cast("int")).drop("before", "of", "bucket")
    # about sqrt(rows) slices, so one task can sum their counts
    steps = ranked.groupBy("slice").agg(F.count("*").alias("n")) \
        .withColumn("ahead", F.sum("n").over(Window.orderBy("slice")) - F.col("n")).drop("n")
    place = F.col("ahead") + F.row_number().over(Window.partitionBy("slice").orderBy("share", "stratum", *order)) - 1
    at = ranked.join(steps, "slice").withColumn("place", place)
    return at.withColumn("shard", F.expr(f"cast(place * {shards} div {max(rows, 1)} as int)")) \
        .withColumn("slot", F.expr(f"place - (cast(shard as long) * {rows} + {shards - 1}) div {shards}")) \
        .select("doc_id", "size", "text_crc32", F.expr("nullif(stratum, '')").substr(2, 1 << 30).alias("stratum"), "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 1) -> DataFrame:
    """The documents table interleaved by source under the `rows` law. Copies of a text are rows like
    any other: the law that holds is equal row counts, so a group may cross a cut."""
    out = interleave(docs, shards, column(docs, "source"), column(docs, "doc_id"), column(docs, "text"), seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("stratum").alias("source"))
