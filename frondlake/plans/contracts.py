"""Cameras, clicks, captures and record contracts over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from frondlake.operators import cameras as K
from frondlake.operators import contracts as R
from frondlake.operators.ordered import Ordered, ordered
from frondlake.operators.spatial import nearest
from frondlake.plans.derived import POINT_SQL, points
from frondlake.plans.registry import query
from frondlake.session import in_tasks, shuffled, table

D = "sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2))"


def r6(c):
    return F.round(c, 6) + 0.0


@query("camera_table", """WITH m AS (SELECT r_regionkey AS set, CASE WHEN r_regionkey=2 THEN 'FISHEYE' ELSE 'OPENCV' END AS model, 400.0+10*r_regionkey AS fl, 0.01*r_regionkey AS k1, CASE WHEN r_regionkey=3 THEN 0.02 ELSE 0.0 END AS k2 FROM region),
n AS (SELECT o_custkey AS frame, 'photo_'||min(o_orderkey) AS name FROM orders GROUP BY 1)
SELECT c_custkey AS frame, name, CAST(fl AS DOUBLE) AS fl_x, round(CAST(k1 AS DOUBLE),6) AS k1, CASE WHEN m.set IS NULL THEN 'no_model' WHEN model<>'OPENCV' THEN 'model' WHEN k2<>0 THEN 'distortion' WHEN c_acctbal<0 AND fl<>410 THEN 'own_intrinsics' WHEN name IS NULL THEN 'unnamed' ELSE 'ok' END AS status
FROM customer LEFT JOIN nation ON n_nationkey=c_nationkey LEFT JOIN m ON m.set=n_regionkey LEFT JOIN n ON frame=c_custkey""")
def camera_table(spark, sf):
    """Regions as camera models, customers as frames (those in debt set a focal length of their own), their first orders as photos."""
    r = F.col("r_regionkey")
    models = table(spark, sf, "region").select(
        r.alias("set"), F.when(r == 2, "FISHEYE").otherwise("OPENCV").alias("model"), (400.0 + 10 * r).alias("fl_x"), (400.0 + 10 * r).alias("fl_y"),
        *[F.lit(v).alias(c) for c, v in (("cx", 320.0), ("cy", 240.0), ("w", 640), ("h", 480))], (0.01 * r).alias("k1"), F.when(r == 3, 0.02).otherwise(0.0).alias("k2"))
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    frames = c.select(F.col("c_custkey").alias("frame"), F.col("n_regionkey").alias("set"), F.when(F.col("c_acctbal") < 0, 410.0).alias("fl_x"))
    names = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("frame")).agg(F.concat(F.lit("photo_"), F.min("o_orderkey").cast("string")).alias("name"))
    return K.camera_table(models, frames, names).select("frame", "name", "fl_x", F.round("k1", 6).alias("k1"), "status")


#: one camera: intrinsics, distortion, and a turn about z
LENS = {"fl_x": 500.0, "fl_y": 510.0, "cx": 320.0, "cy": 240.0, "k1": 0.1, "k2": 0.01, "p1": 0.001, "p2": 0.002}


@query("pixel_rays", f"""WITH RECURSIVE {POINT_SQL}, p AS (SELECT id, 1000*x/500.0 AS u, 1000*y/510.0 AS v FROM pts), s AS (SELECT 0 AS i, id, u, v, CAST(u AS DOUBLE) AS x, CAST(v AS DOUBLE) AS y FROM p UNION ALL
SELECT i+1, id, u, v, (u-(0.002*x*y+0.002*(3*x*x+y*y)))/(1+0.1*(x*x+y*y)+0.01*pow(x*x+y*y,2)), (v-(0.001*(x*x+3*y*y)+0.004*x*y))/(1+0.1*(x*x+y*y)+0.01*pow(x*x+y*y,2)) FROM s WHERE i<200)
SELECT id, round((0.6*x+0.8*y)/sqrt(x*x+y*y+1),6)+0.0 AS x, round((-0.8*x+0.6*y)/sqrt(x*x+y*y+1),6)+0.0 AS y, round(1/sqrt(x*x+y*y+1),6)+0.0 AS z FROM s WHERE i=200""")
def pixel_rays(spark, sf):
    """Unit ray of every point's pixel through a distorted lens."""
    turn = [[0.6, -0.8, 0.0], [0.8, 0.6, 0.0], [0.0, 0.0, 1.0]]
    d = K.ray(F.col("x") * 1000 + 320, F.col("y") * 1000 + 240, LENS, turn)
    return points(spark, sf).select("id", d.alias("d")).select("id", *[r6(F.col(f"d.{c}")).alias(c) for c in "xyz"])


@query("saved_frame", f"WITH {POINT_SQL} SELECT id, round(2.0*(0.6*x-0.8*y+0.1),6)+0.0 AS x, round(2.0*(0.8*x+0.6*y-0.2),6)+0.0 AS y, round(2.0*(z+0.3),6)+0.0 AS z FROM pts")
def saved_frame(spark, sf):
    out = K.to_saved_frame([F.col(c) for c in "xyz"], [[0.6, -0.8, 0, 0.1], [0.8, 0.6, 0, -0.2], [0, 0, 1, 0.3]], 2.0)
    return points(spark, sf).select("id", *[r6(c).alias(n) for c, n in zip(out, "xyz")])


@query("camera_pose", f"""WITH {POINT_SQL}, n AS (SELECT *, sqrt(x*x+y*y+z*z) AS l, sqrt(x*x+y*y) AS h FROM pts)
SELECT id, round(-y/h,6)+0.0 AS m0, round(-z*x/(l*h),6)+0.0 AS m1, round(x/l,6)+0.0 AS m2, round(x,6)+0.0 AS m3, round(x/h,6)+0.0 AS m4, round(-z*y/(l*h),6)+0.0 AS m5, round(y/l,6)+0.0 AS m6, round(y,6)+0.0 AS m7,
0.0 AS m8, round(h/l,6)+0.0 AS m9, round(z/l,6)+0.0 AS m10, round(z,6)+0.0 AS m11, 0.0 AS m12, 0.0 AS m13, 0.0 AS m14, 1.0 AS m15 FROM n""".replace("0.0 AS m8", "CAST(0 AS DOUBLE) AS m8").replace("0.0 AS m12, 0.0 AS m13, 0.0 AS m14, 1.0 AS m15", "CAST(0 AS DOUBLE) AS m12, CAST(0 AS DOUBLE) AS m13, CAST(0 AS DOUBLE) AS m14, CAST(1 AS DOUBLE) AS m15"))
def camera_pose(spark, sf):
    """Every point as a camera that looks at the origin."""
    at = [F.col(c) for c in "xyz"]
    m = points(spark, sf).select("id", K.pose(at, [-c for c in at]).alias("m"))
    return m.select("id", *[r6(F.col("m")[i]).alias(f"m{i}") for i in range(16)])


@query("click_faults", """WITH im AS (SELECT p_partkey AS name, p_size*100.0 AS w, p_retailprice AS h, p_size FROM part), c AS (SELECT l_partkey, l_returnflag||' '||CASE WHEN l_linestatus='F' THEN l_linenumber||'' ELSE '' END AS label, l_quantity*100 AS x, l_extendedprice/10 AS y FROM lineitem),
k AS (SELECT l_partkey, label, count(*) AS n, bool_or(x>w OR y>h) AS off, any_value(name) AS name FROM c LEFT JOIN im ON name=l_partkey GROUP BY 1,2),
f AS (SELECT CASE WHEN trim(label)<>label THEN ['bad_label'] WHEN name IS NULL THEN ['unknown_image'] ELSE list_filter([CASE WHEN n>1 THEN 'repeated_label' END, CASE WHEN off THEN 'outside' END], lambda v: v IS NOT NULL) END AS fs FROM k)
SELECT fault, count(*) AS n FROM (SELECT unnest(fs) AS fault FROM f) GROUP BY 1""")
def click_faults(spark, sf):
    """Parts as images, order lines as clicks on them."""
    images = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("name"), (F.col("p_size") * 100.0).alias("width"), F.col("p_retailprice").alias("height"))
    label = F.concat("l_returnflag", F.lit(" "), F.when(F.col("l_linestatus") == "F", F.col("l_linenumber").cast("string")).otherwise(""))
    clicks = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("image"), label.alias("label"), (F.col("l_quantity") * 100).alias("x"), (F.col("l_extendedprice") / 10).alias("y"))
    return R.click_faults(images, clicks).groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


@query("capture_discovery", """WITH f AS (SELECT 'c/'||replace(p_name,' ','/')||CASE WHEN p_size%5=0 THEN '/day'||p_partkey ELSE '' END||CASE WHEN p_size=7 THEN '/.old' ELSE '' END||CASE WHEN p_size%3=0 THEN '/images' ELSE '/raw' END AS path, p_size=9 AS link FROM part),
s AS (SELECT DISTINCT regexp_replace(path,'/images$','') AS capture FROM f WHERE path LIKE '%/images' AND path NOT LIKE '%/.%' AND NOT link AND path NOT IN (SELECT path FROM f WHERE link))
SELECT a.capture, arg_max(b.capture, length(b.capture)) AS inside FROM s a LEFT JOIN s b ON starts_with(a.capture, b.capture||'/') GROUP BY 1""")
def capture_discovery(spark, sf):
    """Part names as folders; some parts lie in a folder of their own below, some are hidden or links."""
    size = F.col("p_size")
    path = F.concat(F.lit("c/"), F.replace("p_name", F.lit(" "), F.lit("/")), F.when(size % 5 == 0, F.concat(F.lit("/day"), F.col("p_partkey").cast("string"))).otherwise(""),
                    F.when(size == 7, "/.old").otherwise(""), F.when(size % 3 == 0, "/images").otherwise("/raw"))
    return R.captures(table(spark, sf, "part").select(path.alias("path"), (size == 9).alias("link")))


@query("auto_detached", """WITH s AS (SELECT user_id AS cluster, count(*) AS size FROM events GROUP BY 1), u AS (SELECT c_custkey FROM customer WHERE c_acctbal<0), t AS (SELECT user_id, count(*) AS overlap FROM events WHERE event_type='purchase' AND value>100 GROUP BY 1)
SELECT cluster, size, coalesce(overlap,0) AS overlap, CASE WHEN c_custkey IS NOT NULL THEN 'used' WHEN size>=0.9*(SELECT max(size) FROM s) THEN 'large' WHEN overlap>0 THEN 'overlaps' ELSE 'detached' END AS status FROM s LEFT JOIN u ON c_custkey=cluster LEFT JOIN t ON user_id=cluster""")
def auto_detached(spark, sf):
    """Users as clusters of events; customers in debt are used, large purchases are rows of plants."""
    e = table(spark, sf, "events").withColumnRenamed("user_id", "cluster")
    used = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("cluster"))
    return R.detached(e.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")), used, e.filter("event_type = 'purchase' and value > 100").select("cluster"), 0.9)


@query("leaf_ends", f"""WITH {POINT_SQL}, l AS (SELECT * FROM pts WHERE label<8), c AS (SELECT label, count(*) AS points FROM l GROUP BY 1 HAVING count(*)>=20),
d AS (SELECT a.label, a.id, b.id AS node, b.label AS role, {D} AS d FROM l a JOIN pts b ON b.label>=8), t AS (SELECT label, role, min(d) AS d, arg_min(id, (d,node,id)) AS base, arg_min(node, (d,node,id)) AS node FROM d GROUP BY 1,2)
SELECT c.label AS leaf, points, CASE WHEN t.d<0.02 THEN t.base ELSE q.base END AS base, CASE WHEN t.d<0.02 THEN t.node ELSE q.node END AS node, round(CASE WHEN t.d<0.02 THEN t.d ELSE q.d END,6)+0.0 AS distance, CASE WHEN t.d<0.02 THEN 'tip' ELSE 'nearest' END AS rule
FROM c LEFT JOIN t ON t.label=c.label AND t.role=8 LEFT JOIN t q ON q.label=c.label AND q.role=9""")
def leaf_ends(spark, sf):
    """Labels below 8 are leaves, 8 terminals, 9 the network."""
    p = points(spark, sf)
    ends = R.leaf_ends(p.filter("label < 8").withColumnRenamed("label", "leaf"), p.filter("label = 8"), p.filter("label = 9"), 0.02)
    return ends.withColumn("distance", r6(F.col("distance")))


@query("leaf_groups", """WITH m AS (SELECT l_orderkey AS g, CASE o_orderstatus WHEN 'F' THEN 'same_leaf' WHEN 'O' THEN 'side_branch_pair' ELSE 'draft' END AS kind, l_suppkey AS member FROM lineitem JOIN orders ON o_orderkey=l_orderkey),
w AS (SELECT member FROM m WHERE kind='same_leaf' GROUP BY 1 HAVING count(DISTINCT g)>1), k AS (SELECT DISTINCT s_suppkey FROM supplier WHERE s_acctbal>=0),
a AS (SELECT g, any_value(kind) AS kind, count(*) AS listed, count(DISTINCT m.member) AS d, count(*) FILTER (WHERE s_suppkey IS NULL) AS un, count(*) FILTER (WHERE kind='same_leaf' AND w.member IS NOT NULL) AS sh FROM m LEFT JOIN k ON s_suppkey=m.member LEFT JOIN w ON w.member=m.member GROUP BY 1)
SELECT fault, count(*) AS groups FROM (SELECT unnest(list_filter([CASE WHEN kind='draft' THEN 'kind' END, CASE WHEN listed>d THEN 'repeated_member' END, CASE WHEN d<2 THEN 'too_few' END, CASE WHEN kind='side_branch_pair' AND listed<>2 THEN 'not_a_pair' END, CASE WHEN un>0 THEN 'unknown_member' END, CASE WHEN sh>0 THEN 'shared_member' END], lambda v: v IS NOT NULL)) AS fault FROM a) GROUP BY 1""")
def leaf_groups(spark, sf):
    """Orders as display groups of suppliers."""
    s = F.col("o_orderstatus")
    kind = F.when(s == "F", "same_leaf").when(s == "O", "side_branch_pair").otherwise("draft")
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    rows = max(li.count(), o.count())
    lines = in_tasks(li.select(F.col("l_orderkey").alias("group"), F.col("l_suppkey").alias("member")), rows, "group")
    orders = in_tasks(o.select(F.col("o_orderkey").alias("group"), kind.alias("kind")), rows, "group")
    m = lines.join(shuffled(orders), "group").select("group", "kind", "member")
    known = table(spark, sf, "supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("member"))
    faults = R.group_faults(m, known, ("same_leaf", "side_branch_pair"), "side_branch_pair", "same_leaf")
    return faults.groupBy("fault").agg(F.count(F.lit(1)).alias("groups"))


@query("document_tamper", """WITH a AS (SELECT o_orderkey, o_orderstatus AS status FROM orders), b AS (SELECT l_orderkey, CASE WHEN min(l_linestatus)<>max(l_linestatus) THEN 'P' ELSE min(l_linestatus) END AS status FROM lineitem GROUP BY 1)
SELECT coalesce(o_orderkey,l_orderkey) AS o_orderkey, CASE WHEN o_orderkey IS NULL THEN 'missing' WHEN l_orderkey IS NULL THEN 'surplus' WHEN a.status=b.status THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b ON o_orderkey=l_orderkey""")
def document_tamper(spark, sf):
    """Stored order states against those rebuilt from the order lines."""
    stored = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    low, high = F.min("l_linestatus"), F.max("l_linestatus")
    rebuilt = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.when(low != high, "P").otherwise(low).alias("status"))
    return R.document_differences(stored, rebuilt, "o_orderkey")


@query("succession_cycles", f"""WITH RECURSIVE {POINT_SQL}, d AS (SELECT a.id, b.id AS nb, row_number() OVER (PARTITION BY a.id ORDER BY {D}, b.id) AS n FROM pts a JOIN pts b ON a.id<>b.id), l AS (SELECT id, nb FROM d WHERE n=1),
r AS (SELECT id AS s, nb AS v FROM l UNION SELECT r.s, l.nb FROM r JOIN l ON l.id=r.v) SELECT s AS id FROM r WHERE s=v""")
def succession_cycles(spark, sf):
    """Every point succeeds to its nearest other point: which of them come back to themselves?"""
    p = points(spark, sf)
    return R.cycle_members(nearest(p, p, 1, exclude_self=True).select("id", F.col("neighbour").alias("to")))


@query("tape_marks", r"""WITH l AS (SELECT DISTINCT 'tape_'||p_size||CASE WHEN p_brand='Brand#1' THEN '.0cm' WHEN p_brand<'Brand#2' THEN 'cm' ELSE 'mm' END AS label FROM part), m AS (SELECT label, CAST(regexp_extract(label,'^tape_([0-9]+(?:[.][0-9]+)?)cm$',1) AS DOUBLE) AS cm FROM l WHERE label LIKE '%cm')
SELECT label, cm, count(*) OVER (PARTITION BY cm)>1 AS repeated FROM m""")
def tape_marks(spark, sf):
    brand = F.col("p_brand")
    label = F.concat(F.lit("tape_"), F.col("p_size").cast("string"), F.when(brand == "Brand#1", ".0cm").when(brand < "Brand#2", "cm").otherwise("mm"))
    return R.graduations(table(spark, sf, "part").select(label.alias("label")))


@query("named_end_pairs", """WITH l AS (SELECT DISTINCT 'leaf'||l_orderkey AS leaf, CASE l_returnflag WHEN 'A' THEN 'base' WHEN 'R' THEN 'tip' ELSE 'mid' END AS e FROM lineitem)
SELECT leaf, max(CASE WHEN e='base' THEN leaf||'_base' END) AS base, max(CASE WHEN e='tip' THEN leaf||'_tip' END) AS tip FROM l WHERE e<>'mid' GROUP BY 1""")
def named_end_pairs(spark, sf):
    end = F.when(F.col("l_returnflag") == "A", "base").when(F.col("l_returnflag") == "R", "tip").otherwise("mid")
    return R.end_pairs(table(spark, sf, "lineitem").select(F.concat(F.lit("leaf"), F.col("l_orderkey").cast("string"), F.lit("_"), end).alias("label")))


@query("leaf_anchors", f"""WITH {POINT_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id)-1 AS i, count(*) OVER (PARTITION BY label) AS c FROM pts), s AS (SELECT DISTINCT label, CAST(floor(t*(c-1)/24.0) AS BIGINT) AS i FROM (SELECT DISTINCT label, c FROM n), range(0,25) r(t)),
k AS (SELECT n.* FROM n JOIN s USING (label, i)), m AS (SELECT label, avg(x) mx, avg(y) my, avg(z) mz, count(*) AS points FROM k GROUP BY 1)
SELECT label, arg_min(id, (pow(x-mx,2)+pow(y-my,2)+pow(z-mz,2), id)) AS anchor, any_value(points) AS points FROM k JOIN m USING (label) GROUP BY 1""")
def leaf_anchors(spark, sf, most: int = 25):
    """An even sample of every label's points, and the sampled point next to the sample's mean."""
    n = ordered(points(spark, sf), ["label"], ["id"], Ordered(rank="rn", totals={"c": F.lit(1)}))
    i, m = F.col("rn") - 1, F.lit(float(most - 1))
    t = F.ceil(i * m / F.greatest(F.col("c") - 1, F.lit(1)))
    hit = (F.col("c") == 1) | ((t <= most - 1) & (F.floor(t * (F.col("c") - 1) / m) == i))
    return R.anchors(n.filter(hit), "label")


@query("seeded_sample", "SELECT l_orderkey, l_linenumber, md5(concat_ws(':','7',concat_ws('-',CAST(l_orderkey AS VARCHAR),CAST(l_linenumber AS VARCHAR)))) AS draw FROM lineitem ORDER BY draw, l_orderkey, l_linenumber LIMIT 1000")
def seeded_sample(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("row", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return R.seeded_sample(rows, 1000, 7, "row").select("l_orderkey", "l_linenumber", F.md5(F.concat_ws(":", F.lit("7"), "row")).alias("draw"))


@query("completed_match", """WITH v AS (SELECT l_orderkey, bool_or(l_returnflag='R') AS verified FROM lineitem GROUP BY 1), n AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate,o_orderkey)) AS newest FROM orders GROUP BY 1),
r AS (SELECT DISTINCT l_orderkey, l_returnflag||l_linestatus AS input FROM lineitem), j AS (SELECT o_orderkey AS job, o_custkey AS capture, o_orderdate AS seq, o_orderstatus='F' AS done, coalesce(verified,false) AS verified, substr(o_orderpriority,1,1)<='4' AS fits, newest,
(SELECT count(*) FROM r WHERE l_orderkey=o_orderkey) AS had, (SELECT count(*) FROM r WHERE l_orderkey=newest) AS has, (SELECT count(*) FROM r a JOIN r b ON a.input=b.input WHERE a.l_orderkey=o_orderkey AND b.l_orderkey=newest) AS common FROM orders JOIN n USING (o_custkey) LEFT JOIN v ON l_orderkey=o_orderkey),
w AS (SELECT *, CASE WHEN NOT done THEN 'status' WHEN NOT verified THEN 'unverified' WHEN NOT fits THEN 'settings' WHEN has>common OR had>common THEN 'images +'||(has-common)||' -'||(had-common) END AS reason FROM j),
g AS (SELECT capture, arg_max(job, (seq,job)) FILTER (WHERE reason IS NULL) AS job, arg_max(coalesce(reason,'-'), (seq,job)) AS last FROM w GROUP BY 1)
SELECT c_custkey AS capture, job, CASE WHEN capture IS NULL THEN 'none' WHEN job IS NOT NULL THEN 'completed' ELSE last END AS reason FROM customer LEFT JOIN g ON capture=c_custkey""")
def completed_match(spark, sf):
    """Orders as jobs of their customers; today's inputs are those of a customer's newest order."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    seen = l.groupBy(F.col("l_orderkey").alias("job")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("verified"))
    jobs = o.select(F.col("o_orderkey").alias("job"), F.col("o_custkey").alias("capture"), F.col("o_orderdate").alias("seq"),
                    F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"),
                    F.when(F.substring("o_orderpriority", 1, 1) <= "4", "now").otherwise("then").alias("settings")).join(seen, "job", "left")
    files = l.select(F.col("l_orderkey").alias("job"), F.concat("l_returnflag", "l_linestatus").alias("input"))
    newest = jobs.groupBy("capture").agg(F.max(F.struct("seq", "job"))["job"].alias("job"))
    today = table(spark, sf, "customer").select(F.col("c_custkey").alias("capture"), F.lit("now").alias("settings"))
    return R.completed_match(jobs, today, files, newest.join(files, "job").select("capture", "input"))


@query("leaf_export_reload", """SELECT l.c_custkey||'' AS leaf, CASE WHEN n=0 THEN 'count' WHEN k.s_suppkey IS NULL THEN 'ok' WHEN k.s_suppkey<>l.c_custkey THEN 'other_petiole' WHEN v.vec_id IS NULL THEN 'attachment_missing' WHEN k.s_acctbal<0 THEN 'off_attachment' ELSE 'ok' END AS fault
FROM (SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey=c_custkey) AS n FROM customer) l LEFT JOIN supplier k ON s_suppkey=c_custkey LEFT JOIN embeddings v ON vec_id=s_suppkey""")
def leaf_export_reload(spark, sf):
    """Customers as leaves, suppliers of the same number as their stalks, which start at that vector."""
    joint = points(spark, sf).select(F.col("id").cast("string").alias("joint"), "x", "y", "z")
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("points"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("stalk"), "s_acctbal")
    key = F.col("c_custkey").cast("string")
    leaves = table(spark, sf, "customer").join(n, "c_custkey", "left").select(key.alias("leaf"), F.coalesce("points", F.lit(0)).alias("points")) \
        .join(s.select(F.col("stalk").alias("leaf"), "stalk"), "leaf", "left")
    stalks = s.join(joint, F.col("stalk") == F.col("joint"), "left").select(
        "stalk", F.col("stalk").alias("leaf"), F.col("stalk").alias("joint"), (F.col("x") + F.when(F.col("s_acctbal") < 0, 0.5).otherwise(0.0)).alias("x"), "y", "z")
    return R.reload_faults(R.leaf_exports(leaves, stalks, joint))


@query("evidence_references", """WITH r AS (SELECT doc_id AS owner, md5(coalesce(text,'')) AS digest FROM documents), k AS (SELECT digest, min(owner) AS target FROM r GROUP BY 1)
SELECT l.doc_id AS owner, CASE WHEN r.owner IS NULL THEN 'missing' WHEN l.quality=0 THEN 'changed' ELSE 'ok' END AS status FROM labels l LEFT JOIN r ON r.owner=l.doc_id""")
def evidence_references(spark, sf):
    """Labels cite documents by digest; those of low quality cite an outdated one."""
    known = table(spark, sf, "documents").select(F.col("doc_id").alias("target"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    cited = table(spark, sf, "labels").join(known, F.col("doc_id") == F.col("target"), "left").select(
        F.col("doc_id").alias("owner"), F.col("doc_id").alias("target"), F.when(F.col("quality") == 0, F.md5("digest")).otherwise(F.col("digest")).alias("digest"))
    return R.reference_status(cited, known).select("owner", "status")
