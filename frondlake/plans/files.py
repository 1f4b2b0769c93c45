"""Queries that write derived tables in a reconstruction format and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from frondlake.plans.derived import SPLAT_SQL, splats
from frondlake.plans.registry import query
from frondlake.session import shared_folder, table
from frondlake.sources import binary
from frondlake.sources import text as X


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/frondlake-{uuid.uuid4().hex}".removeprefix("file:")


COLUMNS = ["x", "y", "z", "opacity", "scale_0", "scale_1", "scale_2", "f_dc_0", "f_dc_1", "f_dc_2"]


@query("ply_roundtrip", f"WITH {SPLAT_SQL} SELECT row_number() OVER (ORDER BY row_id)-1 AS row_id, round(CAST(CAST(x AS FLOAT) AS DOUBLE),5) AS x, round(CAST(CAST(y AS FLOAT) AS DOUBLE),5) AS y, round(CAST(CAST(opacity AS FLOAT) AS DOUBLE),4) AS opacity FROM splat WHERE 1/(1+exp(-opacity))>0.5")
def ply_roundtrip(spark, sf):
    """Rows above the opacity cutoff as PLY parts ordered by source row, read strictly."""
    binary.register(spark)
    path = _folder(spark)
    kept = splats(spark, sf).filter(1 / (1 + F.exp(-F.col("opacity"))) > 0.5)
    kept = kept.select("row_id", *[F.col(c).cast("float").alias(c) for c in COLUMNS])
    kept.repartitionByRange("row_id").sortWithinPartitions("row_id").write.format("splat_ply").option("path", path).mode("append").save()
    back = spark.read.format("splat_ply").option("path", path).option("mode", "FAILFAST").option("rowsPerPartition", 4096) \
        .schema("row_id bigint, x float, y float, opacity float").load()
    return back.select("row_id", F.round(F.col("x").cast("double"), 5).alias("x"), F.round(F.col("y").cast("double"), 5).alias("y"),
                       F.round(F.col("opacity").cast("double"), 4).alias("opacity"))


def _pose(key):
    """Four and three exact numbers from a key."""
    return F.array(*[(key % m).cast("double") for m in (3, 5, 7, 11)]), F.array(*[(key % m).cast("double") for m in (13, 17, 19)])


@query("colmap_points_roundtrip", """SELECT p_partkey AS point_id, CAST(p_retailprice AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS error, p_size%256 AS r, count(l_orderkey) AS seen,
 coalesce(CAST(sum(l_orderkey*l_linenumber) AS BIGINT),0) AS check_sum FROM part LEFT JOIN lineitem ON l_partkey=p_partkey GROUP BY 1,2,3,4""")
def colmap_points_roundtrip(spark, sf):
    """Parts as points with the lines that hold them as tracks, written, and read back by several tasks a file."""
    binary.register(spark)
    path = _folder(spark)
    seen = F.struct(F.col("l_orderkey").cast("int").alias("image_id"), F.col("l_linenumber").cast("int").alias("point2d_idx"))
    tracks = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("point_id")).agg(F.array_sort(F.collect_list(seen)).alias("track"))
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("point_id"), F.col("p_retailprice").cast("double").alias("x"), F.lit(0.5).alias("y"), F.lit(-0.5).alias("z"),
        *[(F.col("p_size") % 256).cast("int").alias(c) for c in "rgb"], F.col("p_size").cast("double").alias("error"))
    none = F.array().cast("array<struct<image_id:int,point2d_idx:int>>")
    p.join(tracks, "point_id", "left").withColumn("track", F.coalesce("track", none)).write.format("colmap_points").option("path", path).mode("append").save()
    back = spark.read.format("colmap_points").option("path", path).option("bytesPerPartition", 1 << 20) \
        .schema("point_id bigint, x double, error double, r int, track array<struct<image_id:int,point2d_idx:int>>").load()
    total = F.aggregate("track", F.lit(0).cast("bigint"), lambda t, i: t + i["image_id"].cast("bigint") * i["point2d_idx"])
    return back.select("point_id", "x", "error", "r", F.size("track").cast("bigint").alias("seen"), total.alias("check_sum"))


@query("colmap_images_roundtrip", """SELECT CAST(o_orderkey AS INT) AS image_id, 'photo_'||o_orderkey||'.jpg' AS name, count(l_partkey) AS keypoints, coalesce(max(l_partkey),-1) AS last_point,
 round(coalesce(sum(l_extendedprice),0),2) AS total_y FROM orders LEFT JOIN lineitem ON l_orderkey=o_orderkey GROUP BY 1,2""")
def colmap_images_roundtrip(spark, sf):
    """Orders as images with their lines as keypoints; names and keypoints only are decoded again."""
    binary.register(spark)
    path = _folder(spark)
    key = F.struct(F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"), F.col("l_partkey").alias("point_id"))
    points = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(key).alias("keypoints"))
    q, t = _pose(F.col("o_orderkey"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), q.alias("qvec"), t.alias("tvec")).join(points, "k", "left")
    none = F.array().cast("array<struct<x:double,y:double,point_id:bigint>>")
    o.select(F.col("k").cast("int").alias("image_id"), "qvec", "tvec", F.lit(1).alias("camera_id"), F.concat(F.lit("photo_"), "k", F.lit(".jpg")).alias("name"),
             F.coalesce("keypoints", none).alias("keypoints")).write.format("colmap_images").option("path", path).mode("append").save()
    back = spark.read.format("colmap_images").option("path", path).option("bytesPerPartition", 1 << 20) \
        .schema("image_id int, name string, keypoints array<struct<x:double,y:double,point_id:bigint>>").load()
    return back.select("image_id", "name", F.size("keypoints").cast("bigint").alias("keypoints"),
                       F.coalesce(F.array_max(F.transform("keypoints", lambda k: k["point_id"])), F.lit(-1)).alias("last_point"),
                       F.round(F.aggregate("keypoints", F.lit(0.0), lambda t, k: t + k["y"]), 2).alias("total_y"))


@query("csv_roundtrip", "SELECT event_type AS dataset_id, count(*) AS n, count(*) FILTER (WHERE user_id%5=0) AS noted, round(sum(value),4) AS total FROM events GROUP BY 1")
def csv_roundtrip(spark, sf):
    path = _folder(spark)
    e = table(spark, sf, "events")
    X.write_csv(e.select(F.concat_ws("/", "event_type", "event_id").alias("relpath"), (F.col("value") > 50).cast("string").alias("identical"),
                         *[F.col("value").alias(c) for c in ("tp", "fp", "fn", "tn", "iou", "dice")],
                         F.when(F.col("user_id") % 5 == 0, " skipped ").alias("note")), path, 6)
    c = X.comparison_csv(spark, path, "all")
    return c.groupBy(F.split("relpath", "/")[0].alias("dataset_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("note") == "skipped").alias("noted"), F.round(F.sum("tp"), 4).alias("total"))


@query("job_records", "SELECT o_orderkey, 'c'||o_custkey AS capture_id, CASE WHEN o_orderkey%3=0 THEN 0 ELSE 2 END AS schema_version FROM orders WHERE o_orderstatus<>'P'")
def job_records(spark, sf):
    path = _folder(spark)
    o = table(spark, sf, "orders")
    progress = F.when(F.col("o_orderkey") % 3 != 0, F.struct(F.lit(2).alias("schema_version")))
    o.select(F.when(F.col("o_orderstatus") == "P", "capture").otherwise("job").alias("kind"), F.col("o_orderkey").cast("string").alias("id"),
             F.concat(F.lit("c"), "o_custkey").alias("capture_id"), progress.alias("progress")).write.json(path)
    df = spark.read.schema(X.JOB).option("mode", "DROPMALFORMED").json(path).filter("kind = 'job'")
    return df.select(F.col("id").cast("bigint").alias("o_orderkey"), "capture_id", F.coalesce("progress.schema_version", F.lit(0)).alias("schema_version"))


@query("file_manifest", "SELECT count(*) AS lines, round(sum(o_totalprice),2) AS total FROM orders")
def file_manifest(spark, sf):
    """Hashes and sizes of a written folder agree with what is read from it."""
    path = _folder(spark)
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice").write.option("header", True).csv(path)
    m = X.manifest(spark, path).filter(F.col("name").endswith(".csv"))
    again = X.manifest(spark, path).select("path", F.col("sha256").alias("after"))
    ok = m.join(again, "path").agg(F.bool_and(F.col("sha256") == F.col("after")).alias("ok"), F.sum("length").alias("bytes"))
    read = spark.read.schema("o_orderkey bigint, o_totalprice double").option("header", True).csv(path)
    total = read.agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return total.crossJoin(ok).filter("ok and bytes > 0").select("lines", "total")


@query("streamed_maxima", "SELECT user_id, max(value) FILTER (WHERE event_type<>'error') AS peak, count(*) FILTER (WHERE event_type='error') AS failed FROM events GROUP BY user_id")
def streamed_maxima(spark, sf):
    """Host samples as a JSON file stream, folded to maxima per run and written per batch."""
    from frondlake.streaming.guard import fold_to_table

    source, sink = _folder(spark), _folder(spark)
    table(spark, sf, "events").select("user_id", "event_type", "value").write.json(source)
    return fold_to_table(spark, source, sink)


@query("guarded_runs", """WITH RECURSIVE e AS (SELECT user_id AS run, CAST(epoch_us(ts) AS DOUBLE)/1e6 AS ts, event_id AS seq, CASE WHEN event_type<>'error' THEN value END AS value, value AS memory, event_type FROM events),
x AS (SELECT run, min(struct_pack(ts:=ts, seq:=seq)) FILTER (WHERE value<0.5) AS stop FROM e GROUP BY 1),
s AS (SELECT e.*, x.stop, x.stop IS NOT NULL AND struct_pack(ts:=e.ts, seq:=e.seq)>x.stop AS past FROM e JOIN x ON x.run=e.run),
c AS (SELECT run, ts FROM s WHERE NOT past AND value>=0.5 AND value<120),
k AS (SELECT run, min(ts) AS ts FROM c GROUP BY 1 UNION ALL SELECT k.run, (SELECT min(ts) FROM c WHERE c.run=k.run AND c.ts>=k.ts+86400) FROM k WHERE k.ts IS NOT NULL),
r AS (SELECT run, count(ts) AS releases, max(ts) AS last_release FROM k GROUP BY 1)
SELECT s.run, max(memory) FILTER (WHERE NOT past AND event_type NOT IN ('signup','click')) AS peak, count(*) FILTER (WHERE NOT past AND value IS NULL) AS failed,
 coalesce(max(r.releases),0) AS releases, max(r.last_release) AS last_release, max(s.stop.ts) AS stop_at, count(*) FILTER (WHERE past) AS ended,
 arg_max(event_type NOT IN ('signup','click'), struct_pack(ts:=s.ts, seq:=s.seq)) FILTER (WHERE NOT past) AS dedicated
FROM s LEFT JOIN r ON r.run=s.run GROUP BY 1""")
def guarded_runs(spark, sf):
    """Events as samples of the runs of their users, arriving in three slices of time; signups share the
    guard's scope and clicks have none, so neither raises a peak. States come from the stream's table."""
    from frondlake.streaming.runs import GuardTable, Limits

    source, sink = _folder(spark), _folder(spark)
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    scope = F.when(F.col("event_type") == "signup", "guard").when(F.col("event_type") != "click", F.concat(F.lit("run-"), "user_id"))
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("run"), t.alias("ts"), F.col("event_id").alias("seq"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        scope.alias("scope"), F.lit("guard").alias("own_scope"), F.col("value").alias("memory"), F.lit(0).cast("bigint").alias("oom"))
    span = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    a, b = span["a"] or 0.0, span["b"] or 0.0
    slice_ = F.least(F.lit(2), F.floor((F.col("ts") - a) * 3 / max(b - a, 1.0)))
    guard = GuardTable(spark, sink, Limits(0.5, 120.0, 86400.0))
    for i in range(3):
        e.filter(slice_ == i).repartition("run").write.mode("append").json(source)
        guard.follow(source, files=4096)
    ended = guard.actions().groupBy("run").agg(F.count_if(F.col("action") == "ended").alias("ended"))
    return guard.state().join(ended, "run").select("run", "peak", "failed", "releases", "last_release", "stop_at", "ended", "dedicated")


@query("ply_derivative", f"""WITH {SPLAT_SQL} SELECT row_number() OVER (ORDER BY row_id)-1 AS row_id, row_id AS source_row, round(CAST(CAST(x AS FLOAT) AS DOUBLE),5) AS x,
 round(CAST(CAST(f_dc_1 AS FLOAT) AS DOUBLE),4) AS f_dc_1, true AS digest_held FROM splat WHERE 1/(1+exp(-opacity))>0.5""")
def ply_derivative(spark, sf):
    """Rows above the opacity cutoff copied byte for byte from a PLY of all rows, and read from the copy."""
    from frondlake.sources.derivative import write_derivative

    binary.register(spark)
    whole, dest = _folder(spark), _folder(spark)
    s = splats(spark, sf).select("row_id", *[F.col(c).cast("float").alias(c) for c in COLUMNS], F.col("row_id").cast("int").alias("source_row"))
    s.coalesce(1).sortWithinPartitions("row_id").write.format("splat_ply").option("path", whole).mode("append").save()
    source = f"{whole}/part-000000.ply"
    read = spark.read.format("splat_ply").option("path", source).schema("row_id bigint, opacity float, source_row int").load()
    opacity = splats(spark, sf).filter(1 / (1 + F.exp(-F.col("opacity"))) > 0.5).select(F.col("row_id").cast("int").alias("source_row"))
    parts = write_derivative(spark, source, read.join(opacity, "source_row", "left_semi"), dest)
    again = spark.read.format("file_digests").option("path", dest).load().select("relative", F.col("sha256").alias("after"))
    held = parts.join(again, "relative", "full").agg(F.bool_and(F.col("sha256").eqNullSafe(F.col("after"))).alias("digest_held"))
    back = spark.read.format("splat_ply").option("path", dest).option("mode", "FAILFAST").schema("row_id bigint, source_row int, x float, f_dc_1 float").load()
    return back.crossJoin(held).select("row_id", F.col("source_row").cast("bigint").alias("source_row"), F.round(F.col("x").cast("double"), 5).alias("x"),
                                       F.round(F.col("f_dc_1").cast("double"), 4).alias("f_dc_1"), "digest_held")
