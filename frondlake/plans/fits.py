"""Plane, line and triangulation queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from frondlake.operators import clicks as K
from frondlake.operators import fits as X
from frondlake.plans.derived import POINT_SQL, points
from frondlake.plans.registry import query
from frondlake.session import durable, table


@query("plane_fit", "SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE abs(z)<0.05) AS on_plane FROM (SELECT l_returnflag, CASE WHEN l_quantity>40 THEN l_quantity/10 ELSE l_tax-0.04 END AS z FROM lineitem) GROUP BY 1")
def plane_fit(spark, sf):
    """A planted plane: lines above quantity 40 are lifted off it and must not bend the fit."""
    li = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 10000).alias("x"), F.col("l_quantity").alias("y"),
                                             F.when(F.col("l_quantity") > 40, F.col("l_quantity") / 10).otherwise(F.col("l_tax") - 0.04).alias("z"))
    normal, centre, _ = X.ransac_plane(li, 0.05, 64, 7)
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(X.off_plane(normal, centre)) < 0.05).alias("on_plane"))


def _cameras(spark, sf):
    """A turned camera per nation, on a circle of radius 3."""
    a = F.radians(F.col("n_nationkey") * 12.0 - 30)
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("view"),
        F.cos(a).alias("r00"), F.lit(0.0).alias("r01"), F.sin(a).alias("r02"), F.lit(0.0).alias("r10"), F.lit(1.0).alias("r11"), F.lit(0.0).alias("r12"),
        (-F.sin(a)).alias("r20"), F.lit(0.0).alias("r21"), F.cos(a).alias("r22"), F.lit(0.0).alias("t0"), (F.col("n_nationkey") * 0.05).alias("t1"), F.lit(3.0).alias("t2"),
        (500.0 + F.col("n_nationkey")).alias("f"), F.lit(320.0).alias("cx"), F.lit(240.0).alias("cy"))


def _pixels(j):
    """Points beside a camera each, with their pixel in it."""
    q = K.in_camera([F.col(c) for c in "xyz"])
    return j.withColumn("u", F.col("f") * q[0] / q[2] + F.col("cx")).withColumn("v", F.col("f") * q[1] / q[2] + F.col("cy"))


def _seen(spark, sf, p, views):
    """Points with the pixels of the views that see them, ``views`` of the 25 each, found by their number."""
    return _pixels(p.withColumn("view", F.explode(F.transform(F.sequence(F.lit(0), F.lit(views - 1)), lambda i: (F.col("id") * 7 + i * 3) % 25))).join(_cameras(spark, sf), "view"))


@query("triangulated_points", f"WITH {POINT_SQL} SELECT id AS label, round(x,5)+0.0 AS x, round(y,5)+0.0 AS y, round(z,5)+0.0 AS z, CAST((SELECT count(*) FROM nation) AS INT) AS views FROM pts")
def triangulated_points(spark, sf):
    """Points seen by every turned camera are recovered from their pixels."""
    seen = _pixels(points(spark, sf).crossJoin(_cameras(spark, sf)))
    obs = durable(seen.select(F.col("id").alias("label"), "u", "v", *K.CAMERA))
    return X.triangulate(obs, 2).select("label", *[(F.round(c, 5) + 0.0).alias(c) for c in "xyz"], F.col("views").cast("int").alias("views"))


# points of label 9 hover over the plane z = 0.3 x + 0.1 y on which all others lie; a click alone misses its point a little
CLICK_SQL = f"""{POINT_SQL}, s AS (SELECT id, x, y, 0.3*x+0.1*y+CASE WHEN label=9 THEN 0.04+abs(z)/2 ELSE 0 END AS z, label FROM pts),
cam AS (SELECT CAST(n_nationkey AS BIGINT) AS view, radians(n_nationkey*12.0-30) AS a, n_nationkey*0.05 AS t1, 500.0+n_nationkey AS f FROM nation),
cc AS (SELECT *, 3*sin(a) AS ox, -t1 AS oy, -3*cos(a) AS oz FROM cam),
k AS (SELECT s.*, view, cc.a, f, t1, ox, oy, oz, j, -sin(a)*x+cos(a)*z+3 AS zc, f*(cos(a)*x+sin(a)*z)/(-sin(a)*x+cos(a)*z+3) AS u, f*(y+t1)/(-sin(a)*x+cos(a)*z+3) AS v
 FROM (SELECT s.*, unnest(range(10)) AS j FROM s) s JOIN cc ON cc.view=(id*7+j*3)%25)"""


@query("click_surface", f"""WITH {CLICK_SQL}, c AS (SELECT * REPLACE (u+0.37 AS u, v-0.21 AS v) FROM k WHERE j=0 AND id%3<>0),
near AS (SELECT c.id, q.id AS point, sqrt(pow(q.u-c.u,2)+pow(q.v-c.v,2)) AS d, q.zc, q.label<>9 AS on_plane FROM c JOIN k q ON q.view=c.view),
r AS (SELECT id, CASE WHEN count(*) FILTER (WHERE d<=4)>=8 THEN 4.0 WHEN count(*) FILTER (WHERE d<=8)>=8 THEN 8.0 ELSE 16.0 END AS radius FROM near GROUP BY 1),
g AS (SELECT near.*, radius, median(zc) OVER (PARTITION BY id) AS zmed FROM near JOIN r USING (id) WHERE d<=radius),
n AS (SELECT id, radius, count(*) AS n, any_value(zmed) AS zmed, 1.4826*median(abs(zc-zmed)) AS spread, CASE WHEN count(*)>=8 THEN count(*) FILTER (WHERE on_plane) END AS inl,
 min(zc) FILTER (WHERE on_plane) AS lo, max(zc) FILTER (WHERE on_plane) AS hi FROM g GROUP BY 1,2),
e AS (SELECT c.id, n.*, c.*, u/f AS px, v/f AS py, sqrt(u*u/f/f+v*v/f/f+1) AS pl FROM c JOIN n USING (id)),
d AS (SELECT *, (cos(a)*px-sin(a))/pl AS dx, py/pl AS dy, (sin(a)*px+cos(a))/pl AS dz, 1/pl AS zray FROM e),
h AS (SELECT *, -(0.3*ox+0.1*oy-oz)/(0.3*dx+0.1*dy-dz) AS hit, degrees(acos(least(1,abs(0.3*dx+0.1*dy-dz)/sqrt(1.1)))) AS inc FROM d),
w AS (SELECT *, coalesce(inl>=5 AND inc<=80, false) AS plane FROM h), o AS (SELECT *, CASE WHEN plane THEN hit ELSE zmed/zray END AS far FROM w),
one AS (SELECT id AS label, 'single-view' AS method, n, CASE WHEN n<4 THEN 'support' WHEN plane AND hit*zray<=0 THEN 'behind_camera' END AS why,
 array_to_string(list_filter([CASE WHEN n>=8 AND inl<3 THEN 'no_plane' WHEN n>=8 AND inl<5 THEN 'few_inliers' END, CASE WHEN inl>=5 AND inl/n<0.6 THEN 'mixed_surfaces' END, CASE WHEN inl>=5 AND inc>80 THEN 'grazing' END,
  CASE WHEN plane AND NOT hit*zray BETWEEN lo AND hi THEN 'outside_depths' END, CASE WHEN NOT plane AND spread/zmed>0.02 THEN 'depth_spread' END], lambda x: x IS NOT NULL), ',') AS flags,
 plane, ox+far*dx AS x, oy+far*dy AS y, oz+far*dz AS z, radius, inl FROM o),
two AS (SELECT p.id, p.x, p.y, p.z, degrees(acos(((p.x-p.ox)*(p.x-q.ox)+(p.y-p.oy)*(p.y-q.oy)+(p.z-p.oz)*(p.z-q.oz))/sqrt(pow(p.x-p.ox,2)+pow(p.y-p.oy,2)+pow(p.z-p.oz,2))/sqrt(pow(p.x-q.ox,2)+pow(p.y-q.oy,2)+pow(p.z-q.oz,2)))) AS angle
 FROM k p JOIN k q ON q.id=p.id AND p.j=0 AND q.j=1 WHERE p.id%3=0)
SELECT label, method, CASE WHEN why IS NOT NULL THEN 'refused' WHEN flags<>'' THEN 'flagged' ELSE 'ok' END AS status, coalesce(why, flags) AS flags,
 CASE WHEN why IS NULL THEN CASE WHEN plane THEN 'plane' ELSE 'median' END END AS submethod, CASE WHEN why IS NULL THEN round(x,4)+0.0 END AS x, CASE WHEN why IS NULL THEN round(y,4)+0.0 END AS y,
 CASE WHEN why IS NULL THEN round(z,4)+0.0 END AS z, radius, n AS support, CASE WHEN inl>=3 THEN inl END AS inliers, NULL AS angle, NULL AS max_residual FROM one
UNION ALL SELECT id, 'multi-view', 'ok', '', NULL, round(x,4)+0.0, round(y,4)+0.0, round(z,4)+0.0, NULL, NULL, NULL, round(angle,3), 0.0 FROM two""")
def click_surface(spark, sf):
    """Every point clicked in one view, or in two: a local plane or median depth, or a refined triangulation."""
    p = points(spark, sf)
    lifted = 0.3 * F.col("x") + 0.1 * F.col("y") + F.when(F.col("label") == 9, 0.04 + F.abs("z") / 2).otherwise(0.0)
    keys = durable(_seen(spark, sf, p.withColumn("z", lifted), 10))
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.pmod((F.col("view") - F.col("id") * 7) * 17, F.lit(25))))
    obs = keys.withColumn("k", nth).filter(F.when(F.col("id") % 3 == 0, F.col("k") <= 2).otherwise(F.col("k") == 1))
    obs = obs.withColumn("u", F.when(F.col("id") % 3 == 0, F.col("u")).otherwise(F.col("u") + 0.37)).withColumn("v", F.when(F.col("id") % 3 == 0, F.col("v")).otherwise(F.col("v") - 0.21))
    got = K.solve_clicks(obs.select(F.col("id").alias("label"), "view", "u", "v", *K.CAMERA), keys.select("view", F.col("id").alias("point"), "u", "v", "x", "y", "z"),
                         K.ClickLimits(radius=4.0, max_radius=16.0, tolerance=0.0005, trials=64))
    return got.select("label", "method", "status", F.array_join("flags", ",").alias("flags"), "submethod", *[(F.round(c, 4) + 0.0).alias(c) for c in "xyz"],
                      "radius", "support", "inliers", F.round("angle", 3).alias("angle"), F.round("max_residual", 3).alias("max_residual"))


@query("leave_one_out", """WITH g AS (SELECT l_suppkey AS k, l_quantity AS x, l_extendedprice AS y FROM lineitem), s AS (SELECT k, count(*) n, sum(x) sx, sum(y) sy, sum(x*y) sxy, sum(x*x) sxx FROM g GROUP BY 1),
w AS (SELECT g.k, regr AS slope, ((sxy-x*y)-(sx-x)*(sy-y)/(n-1))/((sxx-x*x)-(sx-x)*(sx-x)/(n-1)) AS wo FROM g JOIN s USING (k) JOIN (SELECT k, regr_slope(y,x) AS regr FROM g GROUP BY 1) r USING (k))
SELECT k, round(any_value(slope),3) AS slope, round(min(wo),3) AS low, round(max(wo),3) AS high FROM w GROUP BY 1""")
def leave_one_out(spark, sf):
    g = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    w = X.leave_one_out(g, "k", "x", "y")
    return w.groupBy("k").agg(F.round(F.max("slope"), 3).alias("slope"), F.round(F.min("slope_without"), 3).alias("low"), F.round(F.max("slope_without"), 3).alias("high"))
