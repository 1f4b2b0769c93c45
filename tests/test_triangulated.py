"""The registered triangulation query sees every camera."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from frondlake.session import table


def test_every_camera_sees_every_point(spark, sf_dir):
    cameras = table(spark, sf_dir, "nation").count()
    got = E.queries()["triangulated_points"](spark, sf_dir).agg(F.count(F.lit(1)), F.min("views"), F.max("views")).first()
    assert tuple(got) == (table(spark, sf_dir, "embeddings").count(), cameras, cameras)
