"""Joins, inventories, votes, set operations and integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators import ordered as O
from frondlake.operators import contracts
from frondlake.operators import relations as R
from frondlake.operators.splat import recolor
from frondlake.plans.derived import FRAME_SQL, POINT_SQL, SPLAT_SQL, frames, points, splats
from frondlake.plans.registry import query
from frondlake.session import durable, in_tasks, shuffled, table


def r6(c):
    return F.round(c, 6)


def n_rows(name="n"):
    return F.count(F.lit(1)).alias(name)


@query("missing_and_unexpected", """WITH e AS (SELECT doc_id FROM documents WHERE lang='en'), p AS (SELECT doc_id FROM labels)
SELECT doc_id, 'missing' AS side FROM (SELECT * FROM e EXCEPT SELECT * FROM p) UNION ALL SELECT doc_id, 'unexpected' FROM (SELECT * FROM p EXCEPT SELECT * FROM e)""")
def missing_and_unexpected(spark, sf):
    return R.missing_and_unexpected(table(spark, sf, "documents").filter("lang = 'en'").select("doc_id"), table(spark, sf, "labels").select("doc_id"), ["doc_id"])


@query("key_diff", """WITH a AS (SELECT conv_id, turn//2 AS pair, text FROM conversations WHERE role='user'), b AS (SELECT conv_id, turn//2 AS pair, text FROM conversations WHERE role='assistant')
SELECT conv_id, pair, md5(a.text) AS recorded, md5(b.text) AS current FROM a FULL OUTER JOIN b USING (conv_id, pair) WHERE a.text IS DISTINCT FROM b.text""")
def key_diff(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", F.floor(F.col("turn") / 2).cast("bigint").alias("pair"), "role", F.md5("text").alias("value"))
    return R.changed_settings(c.filter("role = 'user'"), c.filter("role = 'assistant'"), ["conv_id", "pair"])


@query("mask_tree_compare", """WITH p AS (SELECT l_orderkey//100 AS name, l_orderkey AS px, max(l_quantity)>25 AS v FROM lineitem WHERE l_returnflag='A' GROUP BY 1,2), r AS (SELECT l_orderkey//100 AS name, l_orderkey AS px, max(l_quantity)>25 AS v FROM lineitem WHERE l_returnflag='R' GROUP BY 1,2),
j AS (SELECT coalesce(p.name,r.name) AS name, p.v AS p, r.v AS r FROM p FULL OUTER JOIN r ON p.name=r.name AND p.px=r.px), c AS (SELECT name, count(*) FILTER (WHERE p AND r) AS tp, count(*) FILTER (WHERE p AND NOT coalesce(r,false)) AS fp, count(*) FILTER (WHERE r AND NOT coalesce(p,false)) AS fn,
 count(*) FILTER (WHERE NOT coalesce(p,false) AND NOT coalesce(r,false)) AS tn, CASE WHEN count(p)=0 THEN 'missing_in_pred' WHEN count(r)=0 THEN 'missing_in_ref' ELSE 'compared' END AS status FROM j GROUP BY 1)
SELECT name, status, tp, fp, fn, tn, fp=0 AND fn=0 AS identical, round(coalesce(CAST(tp AS DOUBLE)/nullif(tp+fp+fn,0),1),6) AS iou, round(coalesce(2.0*tp/nullif(2*tp+fp+fn,0),1),6) AS dice FROM c""")
def mask_tree_compare(spark, sf):
    """Pixels of both trees meet in one aggregation on (name, pixel); no row-by-row join is needed."""
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R")).select(
        F.floor(F.col("l_orderkey") / 100).cast("bigint").alias("name"), F.col("l_orderkey").alias("px"), "l_returnflag", (F.col("l_quantity") > 25).alias("v"))
    j = li.groupBy("name", "px").agg(F.max(F.when(F.col("l_returnflag") == "A", F.col("v"))).alias("p"), F.max(F.when(F.col("l_returnflag") == "R", F.col("v"))).alias("r"))
    p, r = F.coalesce("p", F.lit(False)), F.coalesce("r", F.lit(False))
    c = j.groupBy("name").agg(F.count_if(p & r).alias("tp"), F.count_if(p & ~r).alias("fp"), F.count_if(~p & r).alias("fn"), F.count_if(~p & ~r).alias("tn"),
                              F.count("p").alias("np"), F.count("r").alias("nr"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    status = F.when(F.col("np") == 0, "missing_in_pred").when(F.col("nr") == 0, "missing_in_ref").otherwise("compared")
    return c.select("name", status.alias("status"), "tp", "fp", "fn", "tn", ((fp == 0) & (fn == 0)).alias("identical"),
                    r6(C.iou(tp, fp, fn)).alias("iou"), r6(C.dice(tp, fp, fn)).alias("dice"))


@query("tree_status_counts", """SELECT CASE WHEN l.doc_id IS NULL THEN 'missing_in_pred' WHEN d.doc_id IS NULL THEN 'missing_in_ref' ELSE 'compared' END AS status, count(*) AS n FROM (SELECT doc_id FROM labels) l FULL OUTER JOIN (SELECT doc_id FROM documents) d ON l.doc_id=d.doc_id GROUP BY 1""")
def tree_status_counts(spark, sf):
    t = R.compare_trees(table(spark, sf, "labels").select("doc_id"), table(spark, sf, "documents").select("doc_id"), "doc_id")
    return t.groupBy("status").agg(n_rows())


@query("photo_mask_pairing", """WITH m AS (SELECT p_size AS stem, p_type AS ext FROM part) SELECT s.s_suppkey AS photo, min(m.ext) AS mask, CASE WHEN min(m.ext) IS NULL THEN 'missing' WHEN min(m.ext)='ECONOMY' THEN 'unsupported' ELSE 'paired' END AS status FROM supplier s LEFT JOIN m ON m.stem=s.s_suppkey%60 GROUP BY 1""")
def photo_mask_pairing(spark, sf):
    # the first existing extension per stem is found before the join, so photos meet one row each
    m = table(spark, sf, "part").groupBy(F.col("p_size").cast("bigint").alias("stem")).agg(F.min("p_type").alias("mask"))
    j = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("photo"), (F.col("s_suppkey") % 60).alias("stem")).join(m, "stem", "left")
    return j.select("photo", "mask", F.when(F.col("mask").isNull(), "missing").when(F.col("mask") == "ECONOMY", "unsupported").otherwise("paired").alias("status"))


@query("composite_set_status", """WITH s AS (SELECT o_orderkey AS k, o_orderdate AS t FROM orders), c AS (SELECT l_orderkey AS k, max(l_shipdate) AS t FROM lineitem GROUP BY 1)
SELECT CASE WHEN c.k IS NULL THEN 'missing' WHEN s.k IS NULL THEN 'surplus' WHEN c.t<s.t THEN 'stale' ELSE 'current' END AS state, count(*) AS n FROM s FULL OUTER JOIN c ON s.k=c.k GROUP BY 1""")
def composite_set_status(spark, sf):
    s = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ts"))
    c = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_shipdate").alias("tc"))
    state = F.when(F.col("tc").isNull(), "missing").when(F.col("ts").isNull(), "surplus").when(F.col("tc") < F.col("ts"), "stale").otherwise("current")
    return s.join(c, "k", "full_outer").groupBy(state.alias("state")).agg(n_rows())


@query("pyramid_completeness", """WITH f AS (SELECT DISTINCT user_id, CAST(event_id%97 AS BIGINT) AS frame FROM events WHERE event_type='view'), l AS (SELECT unnest(['click','error','purchase']) AS lv),
have AS (SELECT DISTINCT user_id, CAST(event_id%97 AS BIGINT) AS frame, event_type AS lv FROM events) SELECT user_id, lv AS level, count(*) AS missing FROM f, l WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.user_id=f.user_id AND h.frame=f.frame AND h.lv=l.lv) GROUP BY 1,2""")
def pyramid_completeness(spark, sf):
    """Presence of every level is folded into one row per frame: levels are a fixed list."""
    e = table(spark, sf, "events").select("user_id", (F.col("event_id") % 97).alias("frame"), "event_type")
    levels = ["click", "error", "purchase"]
    f = e.groupBy("user_id", "frame").agg(F.max((F.col("event_type") == "view").cast("int")).alias("reg"),
                                          *[F.max((F.col("event_type") == l).cast("int")).alias(l) for l in levels]).filter("reg = 1")
    gone = f.select("user_id", F.explode(F.array(*[F.when(F.col(l) == 0, F.lit(l)) for l in levels])).alias("level")).filter("level is not null")
    return gone.groupBy("user_id", "level").agg(n_rows("missing"))


@query("clip_assignment", """WITH i AS (SELECT o_orderkey AS k FROM orders), l AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(i.k,l.k) AS k, CASE WHEN i.k IS NULL THEN 'unknown' WHEN n IS NULL THEN 'missing' ELSE 'duplicate' END AS problem FROM i FULL OUTER JOIN l ON i.k=l.k WHERE i.k IS NULL OR n IS NULL OR n>1""")
def clip_assignment(spark, sf):
    i = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.lit(True).alias("known"))
    l = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.countDistinct("l_linenumber").alias("n"))
    problem = F.when(F.col("known").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return i.join(l, "k", "full_outer").select("k", problem.alias("problem")).filter("problem is not null")


def _baskets(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("instance"), F.col("l_partkey").alias("item"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("instance"), F.col("o_custkey").alias("photo"))
    # one shuffle serves the distinct rows and the join
    rows = max(li.count(), o.count())
    return in_tasks(li, rows, "instance").distinct().join(in_tasks(o, rows, "instance"), "instance")


OVERLAP_SQL = """m AS (SELECT DISTINCT l_orderkey AS i, o_custkey AS ph, l_partkey AS g FROM lineitem JOIN orders ON l_orderkey=o_orderkey), c AS (SELECT i, count(*) AS n FROM m GROUP BY 1),
k AS (SELECT x.i AS a, y.i AS b, count(*) AS common FROM m x JOIN m y ON x.g=y.g AND x.i<y.i AND x.ph<>y.ph GROUP BY 1,2),
ov AS (SELECT a, b, common, common/least(ca.n,cb.n) AS overlap FROM k JOIN c ca ON ca.i=a JOIN c cb ON cb.i=b WHERE common/least(ca.n,cb.n)>=0.6)"""


@query("overlap_pairs", f"WITH {OVERLAP_SQL} SELECT a, b, common, round(overlap,6) AS overlap FROM ov")
def overlap_pairs(spark, sf):
    return R.overlapping_pairs(durable(_baskets(spark, sf)), 0.6).select("a", "b", "common", r6(F.col("overlap")).alias("overlap"))


# Rounds over typed rows: kind 0 is an instance with its cluster, kind 1 a pair of clusters that may still merge.
AGGLOMERATE_SQL = f"""WITH RECURSIVE {OVERLAP_SQL},
s AS (SELECT 0 AS turn, 0 AS kind, i AS x, ph AS p, i AS ca, CAST(NULL AS BIGINT) AS cb, CAST(NULL AS DOUBLE) AS w, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b FROM (SELECT DISTINCT i, ph FROM m)
 UNION ALL SELECT 0, 1, NULL, NULL, a, b, overlap, a, b FROM ov
 UNION ALL (WITH l AS (SELECT ca, cb, w, a, b FROM s WHERE kind=1 AND ca<>cb), v AS (SELECT DISTINCT ca AS c, p FROM s WHERE kind=0),
  clash AS (SELECT DISTINCT l.ca, l.cb FROM l JOIN v x ON x.c=l.ca JOIN v y ON y.c=l.cb AND y.p=x.p), live AS (SELECT * FROM l ANTI JOIN clash USING (ca, cb)),
  e AS (SELECT ca AS c, w, a, b FROM live UNION ALL SELECT cb, w, a, b FROM live),
  t AS (SELECT c, w, a, b FROM e QUALIFY row_number() OVER (PARTITION BY c ORDER BY w DESC, a DESC, b DESC)=1),
  two AS (SELECT a, b, min(c) AS c1, max(c) AS c2 FROM t GROUP BY a, b HAVING count(*)=2),
  go AS (SELECT two.*, n.ca AS name FROM two JOIN s n ON n.kind=0 AND n.x=two.a),
  f AS (SELECT CASE WHEN name=c1 THEN c2 ELSE c1 END AS c, name FROM go)
  SELECT s.turn+1, 0, s.x, s.p, coalesce(f.name, s.ca), NULL, NULL, NULL, NULL FROM s LEFT JOIN f ON f.c=s.ca WHERE s.kind=0 AND EXISTS (SELECT 1 FROM live)
  UNION ALL SELECT (SELECT max(turn) FROM s)+1, 1, NULL, NULL, coalesce(f.name, live.ca), coalesce(g.name, live.cb), w, a, b FROM live LEFT JOIN f ON f.c=live.ca LEFT JOIN f g ON g.c=live.cb))
SELECT ca AS cluster, count(*) AS instances FROM s WHERE kind=0 AND turn=(SELECT max(turn) FROM s) GROUP BY 1 HAVING count(*)>1"""


@query("agglomerate_instances", AGGLOMERATE_SQL)
def agglomerate_instances(spark, sf):
    m = durable(_baskets(spark, sf))
    c = R.agglomerate(m.select("instance", "photo").distinct(), R.overlapping_pairs(m, 0.6))
    return c.groupBy("cluster").agg(n_rows("instances")).filter("instances > 1")


# embeddings as items seen in eight photos: components 4 to 11 say in which, 13 to 20 which half of its label an instance holds
FOLDS_SQL = f"""WITH RECURSIVE {POINT_SQL}, e AS (SELECT vec_id AS g, label, unnest(range(8)) AS k, embedding FROM embeddings),
vis AS (SELECT k AS photo, g FROM e WHERE embedding[k+5]>-0.05), inst AS (SELECT k*100+label*2+CAST(embedding[k+14]>0 AS INT) AS i, k AS photo, g FROM e WHERE embedding[k+5]>-0.05),
ph AS (SELECT DISTINCT i, photo FROM inst),
s AS (SELECT 0 AS turn, i, (i%100)//2*10+photo//4*2+i%2 AS c, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b, CAST(NULL AS DOUBLE) AS cover, CAST(NULL AS BIGINT) AS photos FROM ph
 UNION ALL (WITH now AS (SELECT turn, s.i, s.c, ph.photo FROM s JOIN ph ON ph.i=s.i),
  v AS (SELECT g, c, count(*) AS n FROM inst JOIN now ON now.i=inst.i GROUP BY 1,2), l AS (SELECT g, c FROM v QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC, c)=1),
  big AS (SELECT c FROM l GROUP BY 1 HAVING count(*)>=5), own AS (SELECT DISTINCT c, photo FROM now),
  seen AS (SELECT vis.photo, vis.g, l.c AS b FROM vis JOIN l ON l.g=vis.g JOIN big ON big.c=l.c ANTI JOIN own ON own.c=l.c AND own.photo=vis.photo),
  base AS (SELECT photo, b, count(*) AS n FROM seen GROUP BY 1,2 HAVING count(*)>=3), hits AS (SELECT inst.i, seen.b, count(*) AS k FROM seen JOIN inst ON inst.photo=seen.photo AND inst.g=seen.g GROUP BY 1,2),
  cov AS (SELECT now.c AS a, base.b, coalesce(hits.k,0)/base.n AS cover FROM now JOIN big ON big.c=now.c JOIN base ON base.photo=now.photo AND base.b<>now.c LEFT JOIN hits ON hits.i=now.i AND hits.b=base.b),
  cand AS (SELECT a, b, median(cover) AS cover, count(*) AS photos FROM cov GROUP BY 1,2 HAVING count(*)>=2 AND median(cover)>=0.4),
  pt AS (SELECT l.g, l.c, x, y, z FROM l JOIN pts ON pts.id=l.g),
  far AS (SELECT a, b, p.g, min(sqrt(pow(p.x-q.x,2)+pow(p.y-q.y,2)+pow(p.z-q.z,2))) AS d FROM cand JOIN pt p ON p.c=b JOIN pt q ON q.c=a GROUP BY 1,2,3),
  best AS (SELECT cand.* FROM cand JOIN (SELECT a, b FROM far GROUP BY 1,2 HAVING avg(CAST(d<0.15 AS INT))>=0.5) t ON t.a=cand.a AND t.b=cand.b ORDER BY cover DESC, photos DESC, cand.a DESC, cand.b DESC LIMIT 1)
  SELECT now.turn+1, now.i, CASE WHEN now.c=best.b THEN best.a ELSE now.c END, best.a, best.b, best.cover, best.photos FROM now, best))
SELECT DISTINCT a, b, round(cover,6) AS cover, photos FROM s WHERE turn>0"""


@query("coverage_folds", FOLDS_SQL)
def coverage_folds(spark, sf):
    """Which clusters of instances are folded into which, by the photos that cover them and their distance."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("item"), F.col("label").cast("long").alias("label"), "embedding",
                                              F.explode(F.expr("sequence(0L, 7L)")).alias("photo"))
    e = e.filter(F.get("embedding", (F.col("photo") + 4).cast("int")) > -0.05)
    side = (F.get("embedding", (F.col("photo") + 13).cast("int")) > 0).cast("long")
    rows = durable(e.select((F.col("photo") * 100 + F.col("label") * 2 + side).alias("instance"), "photo", "item"))
    name = F.expr("instance % 100 div 2 * 10 + photo div 4 * 2 + instance % 2")
    start = rows.select("instance", name.alias("cluster")).distinct()
    _, folds = R.fold_clusters(rows, rows.select("photo", "item"), start, points(spark, sf).select("id", "x", "y", "z"), 0.4, 0.15, 0.5, 3, 5)
    return folds.select("a", "b", r6(F.col("cover")).alias("cover"), "photos")


@query("vote_argmax", """WITH v AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) AS k, sum(n) OVER (PARTITION BY l_partkey) AS t FROM v)
SELECT l_partkey, l_suppkey, n AS votes, CAST(t AS BIGINT) AS total, round(n/t,6) AS conf FROM r WHERE k=1""")
def vote_argmax(spark, sf):
    return R.vote_argmax(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey").withColumn("conf", r6(F.col("conf")))


@query("nonleaf_rule", """SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END) AS BIGINT) AS outside, CAST(sum(CASE WHEN l_returnflag='N' THEN 0 ELSE 1 END) AS BIGINT) AS inside FROM lineitem GROUP BY 1
HAVING sum(CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END) > sum(CASE WHEN l_returnflag='N' THEN 0 ELSE 1 END) AND sum(CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END)>=2""")
def nonleaf_rule(spark, sf):
    out = F.col("l_returnflag") == "N"
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count_if(out).alias("outside"), F.count_if(~out).alias("inside"))
    return g.filter("outside > inside and outside >= 2")


@query("leaf_summary", """WITH v AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) AS k, n/sum(n) OVER (PARTITION BY l_partkey) AS conf FROM v),
ph AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS photos FROM lineitem GROUP BY 1) SELECT r.l_suppkey AS leaf, any_value(photos) AS photos, count(*) AS gaussians, round(median(conf),6) AS median_share FROM r JOIN ph USING (l_suppkey) WHERE k=1 GROUP BY 1 HAVING count(*)>=20""")
def leaf_summary(spark, sf):
    li = table(spark, sf, "lineitem")
    best = durable(R.vote_argmax(li, "l_partkey", "l_suppkey"))
    n = best.groupBy("l_suppkey").agg(n_rows("gaussians")).filter("gaussians >= 20")
    mid = O.quantiles(best, ["l_suppkey"], {"conf": F.col("conf")}, {"p50": 0.5})
    ph = li.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("photos"))
    return n.join(mid, "l_suppkey").join(ph, "l_suppkey").select(F.col("l_suppkey").alias("leaf"), "photos", "gaussians", r6(F.col("conf_p50")).alias("median_share"))


@query("zbuffer_visible", """WITH s AS (SELECT event_id, user_id AS view, CAST(value/10 AS INT) AS _u, value, CAST(json_extract_string(props,'$.k') AS INT) AS k, CAST(epoch_us(ts)//60000000%1000 AS DOUBLE)/100 AS z FROM events),
p AS (SELECT event_id, view, CAST(floor(value/10) AS BIGINT) AS u, CAST(k//10 AS BIGINT) AS v, z FROM s), o AS (SELECT * FROM (VALUES (0,0),(1,0),(-1,0),(0,1),(0,-1)) t(dx,dy)),
d AS (SELECT view, u+dx AS u, v+dy AS v, min(z) AS depth FROM p, o WHERE u+dx>=0 AND u+dx<50 AND v+dy>=0 AND v+dy<10 GROUP BY 1,2,3)
SELECT p.event_id, depth, z<=depth+0.5 AS visible FROM p JOIN d ON d.view=p.view AND d.u=p.u AND d.v=p.v""")
def zbuffer_visible(spark, sf):
    """Nearest depth per screen cell after each point is splatted as a disc of radius 1."""
    e = table(spark, sf, "events")
    p = e.select("event_id", F.col("user_id").alias("view"), F.floor(F.col("value") / 10).cast("bigint").alias("u"),
                 F.floor(F.get_json_object("props", "$.k").cast("int") / 10).cast("bigint").alias("v"),
                 (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60000000) % 1000 / 100.0).alias("z"))
    return visible(p, 1, 50, 10, 0.5).select("event_id", "depth", "visible")


def visible(p, radius, width, height, tolerance):
    """p(view, u, v, z) plus ``depth`` of its own cell and whether z <= depth + tolerance. The depth
    map combines before its shuffle; a view's cells are bounded by its raster."""
    disc = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= max(radius, 0.5) ** 2]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in disc])
    d = p.select("view", "u", "v", "z", F.explode(steps).alias("s")).select("view", (F.col("u") + F.col("s.i")).alias("u"), (F.col("v") + F.col("s.j")).alias("v"), "z")
    d = d.filter((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height)).groupBy("view", "u", "v").agg(F.min("z").alias("depth"))
    return p.join(d, ["view", "u", "v"]).withColumn("visible", F.col("z") <= F.col("depth") + tolerance)


@query("soil_votes", """WITH t AS (SELECT l_partkey AS point, l_suppkey AS view, l_orderkey AS ord, l_linenumber AS k, l_quantity AS x, l_tax*100 AS y FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY point, view ORDER BY ord, k, x, y) AS n FROM t WHERE x>=0 AND x<48 AND y>=0 AND y<8 AND view%3<>0)
SELECT point, CAST(count(*) AS BIGINT) AS seen, CAST(sum(CASE WHEN (CAST(floor(x) AS BIGINT)+CAST(floor(y) AS BIGINT)+view)%2=0 THEN 1 ELSE 0 END) AS BIGINT) AS hits,
 sum(CASE WHEN (CAST(floor(x) AS BIGINT)+CAST(floor(y) AS BIGINT)+view)%2=0 THEN 1 ELSE 0 END)>=3 AND sum(CASE WHEN (CAST(floor(x) AS BIGINT)+CAST(floor(y) AS BIGINT)+view)%2=0 THEN 1 ELSE 0 END)/greatest(count(*),1)>=0.5 AS soil FROM r WHERE n=1 GROUP BY point""")
def soil_votes(spark, sf):
    """Each view votes once per point, with its first in-bounds observation in track order."""
    t = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("point"), F.col("l_suppkey").alias("view"), F.col("l_orderkey").alias("ord"),
                                            F.col("l_linenumber").alias("k"), F.col("l_quantity").alias("x"), (F.col("l_tax") * 100).alias("y"))
    ok = t.filter((F.col("x") >= 0) & (F.col("x") < 48) & (F.col("y") >= 0) & (F.col("y") < 8) & (F.col("view") % 3 != 0))
    first = ok.groupBy("point", "view").agg(F.min(F.struct("ord", "k", "x", "y")).alias("m"))
    hit = (F.floor("m.x") + F.floor("m.y") + F.col("view")) % 2 == 0
    v = first.groupBy("point").agg(n_rows("seen"), F.count_if(hit).alias("hits"))
    return v.withColumn("soil", (F.col("hits") >= 3) & (F.col("hits") / F.greatest("seen", F.lit(1)) >= 0.5))


@query("label_pairs", """SELECT l_suppkey, min(l_extendedprice) FILTER (WHERE l_returnflag='A') AS base, min(l_extendedprice) FILTER (WHERE l_returnflag='R') AS tip FROM lineitem GROUP BY 1""")
def label_pairs(spark, sf):
    p = table(spark, sf, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "R"]).agg(F.min("l_extendedprice"))
    return p.select("l_suppkey", F.col("A").alias("base"), F.col("R").alias("tip"))


@query("runlog_compare", """WITH l AS (SELECT o_orderkey AS run, o_orderstatus AS status, CASE WHEN o_orderkey%5=0 THEN '' ELSE o_orderpriority END AS prio, CAST(o_custkey AS VARCHAR) AS cust FROM orders),
c AS (SELECT l_orderkey AS run, max(l_linestatus) AS status, max('1-URGENT') AS prio, CAST(max(l_suppkey) AS VARCHAR) AS cust FROM lineitem GROUP BY 1),
s AS (SELECT run, unnest(['status','prio','cust']) AS field, unnest([l.status,l.prio,l.cust]) AS logged, unnest([c.status,c.prio,c.cust]) AS actual FROM l JOIN c USING (run))
SELECT field, CASE WHEN logged='' THEN 'not_checked' WHEN logged=actual THEN 'same' ELSE 'different' END AS outcome, count(*) AS n FROM s GROUP BY 1,2""")
def runlog_compare(spark, sf):
    l = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_orderstatus").alias("l_status"),
                                          F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority")).alias("l_prio"), F.col("o_custkey").cast("string").alias("l_cust"))
    c = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("run")).agg(F.max("l_linestatus").alias("c_status"), F.lit("1-URGENT").alias("c_prio"), F.max("l_suppkey").cast("string").alias("c_cust"))
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"l_{f}").alias("logged"), F.col(f"c_{f}").alias("actual")) for f in ("status", "prio", "cust")])
    s = l.join(c, "run").select(F.explode(fields).alias("f")).select("f.*")
    out = F.when(F.col("logged") == "", "not_checked").when(F.col("logged") == F.col("actual"), "same").otherwise("different")
    return s.groupBy("field", out.alias("outcome")).agg(n_rows())


@query("export_check", """SELECT o.o_orderkey AS job, CASE WHEN o.o_orderstatus<>'F' THEN 'not finished' WHEN l.n IS NULL THEN 'no artifact' WHEN l.q<20 THEN 'artifact too small' WHEN c.c_custkey IS NULL THEN 'capture gone' ELSE 'ok' END AS reason
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1) l ON l.l_orderkey=o.o_orderkey LEFT JOIN customer c ON c.c_custkey=o.o_custkey""")
def export_check(spark, sf):
    l = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(n_rows(), F.sum("l_quantity").alias("q"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("there"))
    j = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(l, "o_orderkey", "left").join(c, "o_custkey", "left")
    why = F.when(F.col("o_orderstatus") != "F", "not finished").when(F.col("n").isNull(), "no artifact").when(F.col("q") < 20, "artifact too small") \
        .when(F.col("there").isNull(), "capture gone").otherwise("ok")
    return j.select(F.col("o_orderkey").alias("job"), why.alias("reason"))


@query("token_runs", """WITH a AS (SELECT DISTINCT user_id, date_trunc('day',ts) d FROM events WHERE event_type='click'), b AS (SELECT DISTINCT user_id, date_trunc('day',ts) d FROM events WHERE event_type='view')
SELECT user_id, count(*) FILTER (WHERE a.d IS NOT NULL AND b.d IS NOT NULL) AS common, count(*) FILTER (WHERE b.d IS NULL) AS only_a, count(*) FILTER (WHERE a.d IS NULL) AS only_b FROM a FULL OUTER JOIN b USING (user_id, d) GROUP BY 1""")
def token_runs(spark, sf):
    e = table(spark, sf, "events").filter("event_type in ('click', 'view')").groupBy("user_id", F.date_trunc("day", "ts").alias("d")).agg(
        F.bool_or(F.col("event_type") == "click").alias("a"), F.bool_or(F.col("event_type") == "view").alias("b"))
    return e.groupBy("user_id").agg(F.count_if(F.col("a") & F.col("b")).alias("common"), F.count_if(F.col("a") & ~F.col("b")).alias("only_a"), F.count_if(~F.col("a") & F.col("b")).alias("only_b"))


@query("ambiguous_insertions", """SELECT l_orderkey AS node, count(*) AS pairs FROM (SELECT a.l_orderkey FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b ON a.l_orderkey=b.l_orderkey AND a.l_suppkey<b.l_suppkey) GROUP BY 1""")
def ambiguous_insertions(spark, sf):
    """Pairs sharing a node, counted from group sizes instead of being listed."""
    d = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(n_rows()).groupBy(F.col("l_orderkey").alias("node")).agg(n_rows("k"))
    return d.filter("k > 1").select("node", (F.col("k") * (F.col("k") - 1) / 2).cast("bigint").alias("pairs"))


@query("row_overlap", """WITH d AS (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) SELECT a.l_returnflag AS a, b.l_returnflag AS b, count(*) AS n FROM d a JOIN d b ON a.l_partkey=b.l_partkey AND a.l_returnflag<b.l_returnflag GROUP BY 1,2""")
def row_overlap(spark, sf):
    """Derivatives are few, so each row carries the set it is in and emits at most their pairs."""
    d = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sort_array(F.collect_set("l_returnflag")).alias("s"))
    p = d.select(F.explode("s").alias("a"), "s").select("a", F.explode("s").alias("b")).filter("a < b")
    return p.groupBy("a", "b").agg(n_rows())


@query("set_operations", """WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag='A'), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag='R')
SELECT 'union' AS op, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'complement', count(*) FROM (SELECT p_partkey FROM part EXCEPT SELECT * FROM a)""")
def set_operations(spark, sf):
    li = table(spark, sf, "lineitem")
    a, b = (li.filter(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k")) for f in "AR")
    every = table(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    parts = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.subtract(b), "complement": every.join(a, "k", "left_anti").distinct()}
    out = None
    for op, df in parts.items():
        one = df.agg(n_rows()).select(F.lit(op).alias("op"), "n")
        out = one if out is None else out.union(one)
    return out


@query("selection_matches", """WITH b AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)
SELECT user_id, bool_and(a.event_id IS NOT DISTINCT FROM b.event_id) AS same FROM a FULL OUTER JOIN b USING (user_id, i) GROUP BY 1""")
def selection_matches(spark, sf):
    e = table(spark, sf, "events")
    b = O.ordered(e, ["user_id"], ["ts", "event_id"], O.Ordered(rank="i")).select("user_id", "i", F.col("event_id").alias("eb"))
    a = O.ordered(e, ["user_id"], ["event_id"], O.Ordered(rank="i")).select("user_id", "i", F.col("event_id").alias("ea"))
    return a.join(b, ["user_id", "i"], "full_outer").groupBy("user_id").agg(F.bool_and(F.col("ea").eqNullSafe(F.col("eb"))).alias("same"))


@query("referential_violations", """SELECT 'order_customer' AS rule, CAST(o_orderkey AS VARCHAR) AS subject FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'line_order', CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'duplicate_line', CAST(l_orderkey AS VARCHAR) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*)>1
UNION ALL SELECT 'ship_before_order', CAST(l_orderkey AS VARCHAR) FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_shipdate<o_orderdate""")
def referential_violations(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    lines = li.count()
    rows = max(lines, o.count())
    shipped = in_tasks(li.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"), rows, "o_orderkey")
    dated = shipped.join(shuffled(in_tasks(o.select("o_orderkey", "o_orderdate"), rows, "o_orderkey")), "o_orderkey")
    return R.violations({
        "order_customer": R.orphans(o, table(spark, sf, "customer"), "o_custkey", "c_custkey").select("o_orderkey"),
        "line_order": R.orphans(li, o, "l_orderkey", "o_orderkey", rows).select("l_orderkey"),
        "duplicate_line": R.duplicates(li, ["l_orderkey", "l_linenumber"], lines).select("l_orderkey"),
        "ship_before_order": dated.filter("l_shipdate < o_orderdate").select("o_orderkey")}, "subject")


@query("recolor_check", f"""WITH {SPLAT_SQL}, a AS (SELECT * REPLACE (CASE WHEN label IN (1,2,9) THEN (([0.9,0.2,0.1])[label%3+1]-0.5)/0.28209479177387814 ELSE f_dc_0 END AS f_dc_0) FROM splat)
SELECT count(*) AS rows, bool_and(a.x IS NOT DISTINCT FROM b.x) AS x, bool_and(a.opacity IS NOT DISTINCT FROM b.opacity) AS opacity, bool_and(a.scale_2 IS NOT DISTINCT FROM b.scale_2) AS scale_2,
 bool_and(a.rot_3 IS NOT DISTINCT FROM b.rot_3) AS rot_3, bool_and(a.f_dc_0 IS NOT DISTINCT FROM b.f_dc_0) AS f_dc_0 FROM splat b JOIN a USING (row_id)""")
def recolor_check(spark, sf):
    """A recoloured table beside its source: everything but colour is untouched."""
    before = splats(spark, sf)
    after = recolor(before, before.select("row_id", "label"), [1, 2, 9], ((0.9, 0.2, 0.1), (0.2, 0.7, 0.3), (0.1, 0.4, 0.8)))
    return R.same_columns(before, after, "row_id", ["x", "opacity", "scale_2", "rot_3", "f_dc_0"])


@query("grouped_candidates", f"""WITH {FRAME_SQL} SELECT clip, CAST(k AS INT) AS arc, count(*) AS candidates, min(event_id) AS first_id, max(value) AS best FROM frm WHERE event_type='view' GROUP BY 1,2""")
def grouped_candidates(spark, sf):
    f = frames(spark, sf).filter("event_type = 'view'")
    return f.groupBy("clip", F.col("k").cast("int").alias("arc")).agg(n_rows("candidates"), F.min("event_id").alias("first_id"), F.max("value").alias("best"))


@query("assign_detached", """WITH pl AS (SELECT n_nationkey AS plant, avg(c_acctbal) AS m, 400.0+n_nationkey*20 AS r, min(c_custkey%500) AS lo, max(c_custkey%500) AS hi FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1),
d AS (SELECT s_suppkey AS cl, s_acctbal AS c, CAST(s_suppkey*7%500 AS DOUBLE) AS h FROM supplier), x AS (SELECT cl, plant, abs(c-m)/r AS ratio, h BETWEEN lo-5 AND hi+5 AS inr FROM d, pl),
g AS (SELECT cl, plant, ratio<=0.5 AND inr AS good, (SELECT count(*) FROM x y WHERE y.cl=x.cl AND y.plant<>x.plant AND y.ratio<0.55)=0 AS clear FROM x)
SELECT cl, min(plant) FILTER (WHERE good AND clear) AS assignment FROM g GROUP BY 1""")
def assign_detached(spark, sf):
    """Nations as plants on the axis of balances, suppliers as detached clusters."""
    pl = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_nationkey").alias("plant")).agg(
        F.avg("c_acctbal").alias("at"), F.min(F.col("c_custkey") % 500).alias("low"), F.max(F.col("c_custkey") % 500).alias("high"))
    d = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cluster"), F.col("s_acctbal").alias("at"), (F.col("s_suppkey") * 7 % 500).cast("double").alias("height"))
    out = contracts.assign_detached(d, pl.withColumn("radius", 400.0 + F.col("plant") * 20), 0.5, 0.55, 5.0)
    return out.select(F.col("cluster").alias("cl"), F.col("plant").alias("assignment"))


@query("content_fingerprint", """WITH l AS (SELECT source, doc_id, doc_id||chr(9)||n_chars||chr(9)||sha256(text)||chr(10) AS line FROM documents) SELECT source, sha256(string_agg(h, '' ORDER BY b)) AS sha256 FROM (SELECT source, (n - 1) // 4096 AS b, sha256(string_agg(line, '' ORDER BY doc_id)) AS h FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM l) GROUP BY 1, 2) GROUP BY 1""")
def content_fingerprint(spark, sf):
    d = table(spark, sf, "documents")
    line = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.col("n_chars").cast("string"), F.lit("\t"), F.sha2("text", 256), F.lit("\n"))
    return R.fingerprint(d, ["source"], ["doc_id"], line)


@query("sources_unchanged", "SELECT lang, count(*) AS files, count(*) AS unchanged, count(*) FILTER (WHERE text<>upper(text)) AS touched FROM documents GROUP BY 1")
def sources_unchanged(spark, sf):
    """Digests taken before a step that writes the documents, one copy as it is and one in capitals, and after it."""
    d = table(spark, sf, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("value"), "text")
    before = durable(d.drop("text"))
    copy = durable(d.select("doc_id", "text", F.upper("text").alias("capitals")))
    kept = R.changed_settings(before.select("doc_id", "value"), copy.select("doc_id", F.sha2("text", 256).alias("value")), ["doc_id"]).select("doc_id", F.lit(1).alias("lost"))
    other = R.changed_settings(before.select("doc_id", "value"), copy.select("doc_id", F.sha2("capitals", 256).alias("value")), ["doc_id"]).select("doc_id", F.lit(1).alias("moved"))
    j = before.join(kept, "doc_id", "left").join(other, "doc_id", "left")
    return j.groupBy("lang").agg(n_rows("files"), F.count_if(F.col("lost").isNull()).alias("unchanged"), F.count("moved").alias("touched"))


