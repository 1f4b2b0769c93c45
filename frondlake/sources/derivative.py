"""Row subsets of a PLY that keep every byte of the rows they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frondlake.operators.ordered import Ordered, ordered
from frondlake.session import durable
from frondlake.sources.binary import register
from frondlake.sources.digests import FileDigests


def records(spark: SparkSession, path: str, rows_per_partition: int = 2_000_000) -> DataFrame:
    """(row_id, record) of a PLY that is whole: one that declares more rows than it has is refused."""
    register(spark)
    read = spark.read.format("splat_ply").option("path", path).option("rowsPerPartition", rows_per_partition)
    df = read.schema("row_id bigint, record binary, short boolean").load()
    return df.select("row_id", F.when(F.col("short"), F.raise_error(F.lit(f"{path} has fewer rows than it declares"))).otherwise(F.col("record")).alias("record"))


def differing(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Places where two (row_id, record) tables differ when both are read in the order of row_id:
    (place, source_row); a row that one lacks differs."""
    numbered = [ordered(t.withColumn("all", F.lit(0)), ["all"], ["row_id"], Ordered(rank="place")).select("place", "row_id", "record") for t in (source, copy)]
    left, right = (t.select("place", *[F.col(c).alias(p + c) for c in ("row_id", "record")]) for t, p in zip(numbered, ("l_", "r_")))
    return left.join(right, "place", "full").filter(~F.col("l_record").eqNullSafe(F.col("r_record"))).select("place", F.col("l_row_id").alias("source_row"))


def write_derivative(spark: SparkSession, source: str, rows: DataFrame, dest: str) -> DataFrame:
    """Copy the rows of one source PLY whose row_id is in ``rows``, in order and byte for byte, to PLY parts
    under ``dest`` (which must hold none), read them again, compare all bytes, and return
    (relative, length, sha256) of the parts. Headers are the source's but for the number of rows.

    Rows named twice, null or beyond the file are refused before anything is written. No rows give no
    part. The source is only read."""
    wanted = durable(rows.select(F.col("row_id").cast("bigint").alias("row_id")))
    kept = records(spark, source).join(wanted.distinct(), "row_id", "left_semi")
    asked, found = wanted.count(), kept.select("row_id").count()
    if asked != found:
        raise ValueError(f"{asked} rows asked for, {found} different ones are in {source}")
    spark.dataSource.register(FileDigests)
    if not found:
        return spark.createDataFrame([], "relative string, length bigint, sha256 string")
    kept.repartitionByRange("row_id").sortWithinPartitions("row_id").write.format("splat_ply").option("path", dest).option("like", source).mode("append").save()
    wrong = differing(kept, records(spark, dest)).limit(1).collect()
    if wrong:
        raise ValueError(f"{dest} differs from {source} at place {wrong[0]['place']}")
    return spark.read.format("file_digests").option("path", dest).load().select("relative", "length", "sha256")
