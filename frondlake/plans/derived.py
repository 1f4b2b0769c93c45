"""Reconstruction-shaped inputs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frondlake.session import table


def points(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings as labelled 3D points: the first three dimensions."""
    dims = [F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")]
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), *dims, "label")


def splats(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings as Gaussians: centre, DC colour, opacity logit, log scales, rotation."""
    def dim(i, scale=1.0):
        return (F.get("embedding", F.lit(i)).cast("double") * scale)

    cols = {"x": dim(0), "y": dim(1), "z": dim(2), "f_dc_0": dim(3, 4.0), "f_dc_1": dim(4, 4.0), "f_dc_2": dim(5, 4.0),
            "opacity": dim(6, 10.0), "scale_0": dim(7) - 4, "scale_1": dim(8) - 4, "scale_2": dim(9) - 4,
            "rot_0": dim(10) + 1, "rot_1": dim(11), "rot_2": dim(12), "rot_3": dim(13)}
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), "label", *[c.alias(n) for n, c in cols.items()])


SPLAT_SQL = """splat AS (SELECT vec_id AS row_id, label,
 CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z,
 CAST(embedding[4] AS DOUBLE) * 4.0 AS f_dc_0, CAST(embedding[5] AS DOUBLE) * 4.0 AS f_dc_1,
 CAST(embedding[6] AS DOUBLE) * 4.0 AS f_dc_2, CAST(embedding[7] AS DOUBLE) * 10.0 AS opacity,
 CAST(embedding[8] AS DOUBLE) - 4 AS scale_0, CAST(embedding[9] AS DOUBLE) - 4 AS scale_1,
 CAST(embedding[10] AS DOUBLE) - 4 AS scale_2, CAST(embedding[11] AS DOUBLE) + 1 AS rot_0,
 CAST(embedding[12] AS DOUBLE) AS rot_1, CAST(embedding[13] AS DOUBLE) AS rot_2,
 CAST(embedding[14] AS DOUBLE) AS rot_3 FROM embeddings)"""

POINT_SQL = """pts AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
 CAST(embedding[3] AS DOUBLE) AS z, label FROM embeddings)"""


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """events as camera frames: one clip per user, ordered by time, positioned by value and k."""
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("clip"), "event_id", "ts", "event_type", "value",
                    F.get_json_object("props", "$.k").cast("double").alias("k"))


FRAME_SQL = """frm AS (SELECT user_id AS clip, event_id, ts, event_type, value,
 CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"""
