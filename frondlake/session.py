"""Session defaults, table access and durable lineage cuts."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(master: str = "local[*]", **conf) -> SparkSession:
    """A session with the settings the operators are written for. On a cluster the submitter's
    own partition and memory settings win; only semantics (UTC, AQE) are pinned here."""
    builder = (
        SparkSession.builder.master(master).appName("frondlake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by spark.checkpoint.dir. A private temporary
    folder is used only on a local master, where driver and executors share one machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="frondlake-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of df with a table in the shared folder, so a lost executor costs a re-read.

    A written table is preferred to a checkpoint because later rounds see its true size (small sides
    are then broadcast by the planner) and do not inherit the constraints of every earlier round."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/frondlake-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that shuffles both. For tables that grow with the input: a broadcast takes
    its table through the driver, and a loop of joins takes one in every round."""
    return df.hint("merge")


#: rows that one task joins or groups
TASK_ROWS = 500_000


def in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys in as many tasks as ``rows`` rows need, of this table or of a larger one it meets. Left to
    the planner, tasks are as many as the session has partitions, or fewer: they are merged by compressed
    bytes, and sorted or repeated keys have few. Either way their memory grows with the table."""
    return df.repartition(max(1, math.ceil(rows / TASK_ROWS)), *keys)
