"""Identity, binding, topology and contract queries over keyed records."""

from __future__ import annotations

from pyspark.sql import functions as F

from frondlake.operators import graph as G
from frondlake.operators import ordered as O
from frondlake.operators import relations as R
from frondlake.operators.segments import nearest_group
from frondlake.plans.derived import POINT_SQL, points
from frondlake.plans.registry import query
from frondlake.session import durable, table


def n_rows(name="n"):
    return F.count(F.lit(1)).alias(name)


@query("support_table", "SELECT l_suppkey AS image, l_partkey AS point, arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS u, count(*) AS seen FROM lineitem GROUP BY 1,2")
def support_table(spark, sf):
    """First keypoint of every point in every image."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("image"), F.col("l_partkey").alias("point")).agg(
        F.min_by("l_extendedprice", F.struct("l_orderkey", "l_linenumber", "l_extendedprice")).alias("u"), n_rows("seen"))


@query("name_binding", """WITH f AS (SELECT lower(p_name) AS name, count(*) AS frames, count(DISTINCT p_brand) AS ids FROM part GROUP BY 1) SELECT name, frames, CASE WHEN ids>1 THEN 'clash' WHEN frames>1 THEN 'repeated' ELSE 'bound' END AS state FROM f""")
def name_binding(spark, sf):
    f = table(spark, sf, "part").groupBy(F.lower("p_name").alias("name")).agg(n_rows("frames"), F.countDistinct("p_brand").alias("ids"))
    return f.select("name", "frames", F.when(F.col("ids") > 1, "clash").when(F.col("frames") > 1, "repeated").otherwise("bound").alias("state"))


@query("frame_map_bijective", """SELECT count(*) AS pairs, count(DISTINCT o_orderkey)=count(*) AS sources_once, count(DISTINCT o_custkey)=count(*) AS targets_once, count(*) FILTER (WHERE o_custkey IS NULL)=0 AS complete FROM orders""")
def frame_map_bijective(spark, sf):
    n = F.count(F.lit(1))
    return table(spark, sf, "orders").agg(n.alias("pairs"), (F.countDistinct("o_orderkey") == n).alias("sources_once"),
                                          (F.countDistinct("o_custkey") == n).alias("targets_once"), (F.count_if(F.col("o_custkey").isNull()) == 0).alias("complete"))


@query("identity_registry", """WITH k AS (SELECT c_custkey, c_name, lower(c_mktsegment) AS kind FROM customer)
SELECT 'bad_form' AS rule, CAST(c_custkey AS VARCHAR) AS subject FROM k WHERE NOT regexp_full_match(c_name,'Customer#0000000\\d{2}') UNION ALL SELECT 'unknown_kind', CAST(c_custkey AS VARCHAR) FROM k WHERE kind NOT IN ('household','machinery','building') UNION ALL SELECT 'unused', CAST(c_custkey AS VARCHAR) FROM k WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def identity_registry(spark, sf):
    k = table(spark, sf, "customer").select("c_custkey", "c_name", F.lower("c_mktsegment").alias("kind"))
    used = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return R.violations({"bad_form": k.filter(~F.col("c_name").rlike(r"^Customer#0000000\d{2}$")).select("c_custkey"),
                         "unknown_kind": k.filter(~F.col("kind").isin("household", "machinery", "building")).select("c_custkey"),
                         "unused": k.join(used, "c_custkey", "left_anti").select("c_custkey")}, "subject")


@query("intrinsics_agreement", """WITH a AS (SELECT l_suppkey, avg(l_discount) AS f FROM lineitem WHERE l_returnflag='A' GROUP BY 1), b AS (SELECT l_suppkey, avg(l_discount) AS f FROM lineitem WHERE l_returnflag='R' GROUP BY 1)
SELECT l_suppkey, round(abs(a.f-b.f),6) AS gap, abs(a.f-b.f)<=0.003 AS agrees FROM a JOIN b USING (l_suppkey)""")
def intrinsics_agreement(spark, sf):
    flag = F.col("l_returnflag")
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg(F.when(flag == "A", F.col("l_discount"))).alias("a"), F.avg(F.when(flag == "R", F.col("l_discount"))).alias("b"))
    gap = F.abs(F.col("a") - F.col("b"))
    return g.filter("a is not null and b is not null").select("l_suppkey", F.round(gap, 6).alias("gap"), (gap <= 0.003).alias("agrees"))


@query("edge_keys", "SELECT least(l_partkey,l_suppkey)||'-'||greatest(l_partkey,l_suppkey) AS edge, count(*) AS n FROM lineitem GROUP BY 1")
def edge_keys(spark, sf):
    return table(spark, sf, "lineitem").groupBy(G.edge_key(F.col("l_partkey"), F.col("l_suppkey")).alias("edge")).agg(n_rows())


@query("topology_checks", """WITH s AS (SELECT user_id, event_id AS node, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt, ts FROM events), r AS (SELECT user_id, node, nxt FROM s WHERE nxt IS NOT NULL)
SELECT user_id, count(*) AS links, count(*)-count(DISTINCT nxt) AS shared_successors, count(*) FILTER (WHERE nxt<node) AS backward FROM r GROUP BY 1""")
def topology_checks(spark, sf):
    """Succession must be one to one, and rank must rise along it."""
    s = O.ordered(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], O.Ordered(leads={"nxt": F.col("event_id")})).filter("nxt is not null")
    return s.groupBy("user_id").agg(n_rows("links"), (F.count(F.lit(1)) - F.countDistinct("nxt")).alias("shared_successors"), F.count_if(F.col("nxt") < F.col("event_id")).alias("backward"))


@query("lineage_components", "WITH RECURSIVE e AS (SELECT DISTINCT c_nationkey AS a, 100+c_custkey%40 AS b FROM customer), u AS (SELECT a,b FROM e UNION ALL SELECT b,a FROM e), r AS (SELECT a AS id, a AS c FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a=r.id) SELECT id, min(c) AS component FROM r GROUP BY 1")
def lineage_components(spark, sf):
    e = table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("a"), (100 + F.col("c_custkey") % 40).alias("b"))
    return G.connected_components(e)


# one segment from each label's mean to the next label's
LEAF_SEGMENTS_SQL = """n AS (SELECT label AS i, avg(x) x, avg(y) y, avg(z) z FROM pts GROUP BY 1),
s AS (SELECT a.i AS segment, a.x ax, a.y ay, a.z az, b.x-a.x dx, b.y-a.y dy, b.z-a.z dz FROM n a JOIN n b ON b.i=a.i+1)"""


@query("nearest_leaf_by_median", f"""WITH {POINT_SQL}, {LEAF_SEGMENTS_SQL},
t AS (SELECT segment, label, greatest(0,least(1,((x-ax)*dx+(y-ay)*dy+(z-az)*dz)/(dx*dx+dy*dy+dz*dz))) AS f, x, y, z, ax, ay, az, dx, dy, dz FROM pts, s),
m AS (SELECT segment, label, median(sqrt(pow(x-ax-f*dx,2)+pow(y-ay-f*dy,2)+pow(z-az-f*dz,2))) AS d, count(*) AS points FROM t GROUP BY 1,2),
r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY d, label) AS k FROM m)
SELECT a.segment, a.label AS leaf, round(a.d,6) AS median_distance, a.points, b.label AS second, round(b.d-a.d,6) AS margin FROM r a LEFT JOIN r b ON b.segment=a.segment AND b.k=2 WHERE a.k=1""")
def nearest_leaf_by_median(spark, sf):
    """For every segment the label whose points have the smallest median distance to it, the second one and its margin."""
    p = points(spark, sf)
    n = p.groupBy(F.col("label").alias("segment")).agg(*[F.avg(c).alias(c) for c in "xyz"])
    s = O.ordered(n, [], ["segment"], O.Ordered(leads={f"b{c}": F.col(c) for c in "xyz"})).filter("bx is not null")
    best = durable(nearest_group(p.withColumnRenamed("label", "group"), s))
    second = best.filter("rank = 2").select("segment", F.col("group").alias("second"), F.col("median_distance").alias("next"))
    return best.filter("rank = 1").join(second, "segment", "left").select(
        "segment", F.col("group").alias("leaf"), F.round("median_distance", 6).alias("median_distance"), "points", "second",
        F.round(F.col("next") - F.col("median_distance"), 6).alias("margin"))


@query("bounded_listing", "WITH l AS (SELECT url FROM pages ORDER BY url LIMIT 51) SELECT url, (SELECT count(*) FROM l)>50 AS truncated FROM (SELECT url FROM l ORDER BY url LIMIT 50)")
def bounded_listing(spark, sf):
    """The first fifty names and whether there are more (the limit is the feature)."""
    top = durable(table(spark, sf, "pages").select("url").orderBy("url").limit(51))
    more = top.agg((F.count(F.lit(1)) > 50).alias("truncated"))
    return top.orderBy("url").limit(50).crossJoin(F.broadcast(more))


@query("dense_votes_by_view", "SELECT l_suppkey AS view, count(DISTINCT l_partkey) AS pixels, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag='A' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size>25)) AS soil_only FROM lineitem GROUP BY 1")
def dense_votes_by_view(spark, sf):
    """Soil pixels less the plant's pixels, per view."""
    plant = table(spark, sf, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("plant"))
    px = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.bool_or(F.col("l_returnflag") == "A").alias("soil"))
    j = px.join(plant, "l_partkey", "left")
    return j.groupBy(F.col("l_suppkey").alias("view")).agg(n_rows("pixels"), F.count_if(F.col("soil") & F.col("plant").isNull()).alias("soil_only"))
