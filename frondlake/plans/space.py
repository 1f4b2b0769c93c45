"""Distance, clustering, graph and projection queries over points from the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators import attach as A
from frondlake.operators import graph as G
from frondlake.operators import ordered as O
from frondlake.operators import skeleton as K
from frondlake.operators import spatial as S
from frondlake.operators.segments import nearest_segment
from frondlake.operators.splat import recolor, transform
from frondlake.plans.derived import POINT_SQL, SPLAT_SQL, points, splats
from frondlake.plans.registry import query
from frondlake.session import durable, shuffled, table

D = "sqrt(pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2))"


def r6(c):
    return F.round(c, 6)


@query("nearest_neighbour", f"WITH {POINT_SQL}, d AS (SELECT a.id, b.id AS nb, {D} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {D}, b.id) AS n FROM pts a JOIN pts b ON a.label=0 AND b.label<>0) SELECT id, nb AS neighbour, round(d,6) AS distance FROM d WHERE n=1")
def nearest_neighbour(spark, sf):
    p = points(spark, sf)
    return S.nearest(p.filter("label = 0"), p.filter("label <> 0")).select("id", "neighbour", r6(F.col("distance")).alias("distance"))


@query("knn_spacing", f"WITH {POINT_SQL}, d AS (SELECT a.id, b.id AS nb, {D} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {D}, b.id) AS n FROM pts a JOIN pts b ON a.id<>b.id) SELECT id, nb AS neighbour, round(d,6) AS distance, CAST(n AS INT) AS rank FROM d WHERE n<=3")
def knn_spacing(spark, sf):
    p = points(spark, sf)
    return S.nearest(p, p, 3, exclude_self=True).select("id", "neighbour", r6(F.col("distance")).alias("distance"), "rank")


@query("median_spacing", f"WITH {POINT_SQL}, d AS (SELECT a.id, min({D}) AS d FROM pts a JOIN pts b ON a.id<>b.id GROUP BY 1) SELECT round(median(d),8) AS spacing FROM d")
def median_spacing(spark, sf):
    return S.median_spacing(points(spark, sf)).select(F.round("spacing", 8).alias("spacing"))


@query("radius_pairs", f"WITH {POINT_SQL} SELECT a.id AS a, b.id AS b, round({D},6) AS w FROM pts a JOIN pts b ON a.id<b.id AND {D}<=0.05")
def radius_pairs(spark, sf):
    return S.radius_pairs(points(spark, sf), 0.05).select("a", "b", r6(F.col("w")).alias("w"))


@query("cluster_gaps", f"WITH {POINT_SQL} SELECT a.label AS la, b.label AS lb, round(min({D}),8) AS distance FROM pts a JOIN pts b ON a.label<b.label GROUP BY 1,2")
def cluster_gaps(spark, sf):
    return S.closest_between(points(spark, sf), "label").select("la", "lb", F.round("distance", 8).alias("distance"))


def closure(r: float) -> str:
    return f"""e AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON {D}<={r}), r AS (SELECT id, id AS c FROM pts UNION SELECT e.b, r.c FROM r JOIN e ON e.a=r.id), k AS (SELECT id, min(c) AS component FROM r GROUP BY 1)"""


@query("components_at_radius", f"WITH RECURSIVE {POINT_SQL}, {closure(0.05)} SELECT id, component FROM k")
def components_at_radius(spark, sf):
    return S.components_at(points(spark, sf), 0.05)


@query("named_clusters", f"WITH RECURSIVE {POINT_SQL}, {closure(0.05)}, s AS (SELECT component, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, min(id))-1 AS l FROM k GROUP BY 1) SELECT component, size, CASE WHEN size<5 THEN -1 ELSE l END AS label FROM s")
def named_clusters(spark, sf):
    return G.suppress_small(G.number_by_size(S.components_at(points(spark, sf), 0.05)), 5).select("component", "size", "label")


@query("radius_sweep", "WITH RECURSIVE " + POINT_SQL + ", q AS (SELECT * FROM (VALUES ('1',0.03),('2',0.05)) t(mult,radius)), e AS (SELECT mult, a.id AS a, b.id AS b FROM q, pts a, pts b WHERE " + D + "<=radius), r AS (SELECT mult, id, id AS c FROM q, pts UNION SELECT e.mult, e.b, r.c FROM r JOIN e ON e.a=r.id AND e.mult=r.mult), k AS (SELECT mult, id, min(c) AS c FROM r GROUP BY 1,2), s AS (SELECT mult, c, count(*) AS n FROM k GROUP BY 1,2) SELECT s.mult, CAST(any_value(radius) AS DOUBLE) AS radius, count(*) AS components, count(*) FILTER (WHERE n>=10) AS components_ge, count(*) FILTER (WHERE n=1) AS singletons, array_to_string(list_sort(list(n),'DESC')[1:8],',') AS top_sizes FROM s JOIN q USING (mult) GROUP BY 1")
def radius_sweep(spark, sf):
    p = points(spark, sf)
    return S.radius_sweep(S.euclidean_tree(p), p, {"1": 0.03, "2": 0.05}, 10)


#: Prim's algorithm: rows are the points not in the tree yet, each with its closest tree point; a step takes the closest of all
PRIM = f"""{POINT_SQL}, s AS (SELECT min(id) AS id FROM pts), grow AS (SELECT 1 AS step, a.id, a.x, a.y, a.z, {D} AS w, b.id AS via, b.id AS last FROM pts a JOIN pts b ON b.id=(SELECT id FROM s) AND a.id<>b.id UNION ALL
SELECT step+1, id, x, y, z, CASE WHEN d<w THEN d ELSE w END, CASE WHEN d<w THEN m.id ELSE via END, m.id FROM (SELECT *, sqrt(pow(x-m.x,2)+pow(y-m.y,2)+pow(z-m.z,2)) AS d FROM (SELECT *, first_value({{'id': id, 'x': x, 'y': y, 'z': z}}) OVER (ORDER BY w, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS m FROM grow) q) p WHERE id<>m.id),
tree AS (SELECT step, arg_min(id, (w,id)) AS id, arg_min(via, (w,id)) AS via, min(w) AS w FROM grow GROUP BY 1)"""


@query("mst_edges", f"WITH RECURSIVE {PRIM} SELECT least(id,via) AS a, greatest(id,via) AS b, round(w,6) AS w FROM tree")
def mst_edges(spark, sf):
    return S.euclidean_tree(points(spark, sf)).select("a", "b", r6(F.col("w")).alias("w"))


@query("join_radius", f"""WITH RECURSIVE {PRIM}, v AS (SELECT 0 AS step, pts.id, CAST(label AS VARCHAR) AS tag FROM pts JOIN s USING (id) UNION ALL SELECT step, id, CAST(label AS VARCHAR) FROM tree JOIN pts USING (id)), l AS (SELECT list(w ORDER BY step) AS ws FROM tree)
SELECT least(a.tag,b.tag) AS ga, greatest(a.tag,b.tag) AS gb, round(min(list_max(ws[a.step+1:b.step])),6) AS radius FROM v a JOIN v b ON a.step<b.step AND a.tag<>b.tag, l GROUP BY 1,2""")
def join_radius(spark, sf):
    """Tags are the labels; ties and copies of a coordinate are carried by its smallest id."""
    tree, groups = _tagged_tree(spark, sf)
    return G.first_meetings(G.merge_tree(tree, groups), groups).select("ga", "gb", r6(F.col("radius")).alias("radius"))


def _tagged_tree(spark, sf):
    p = points(spark, sf)
    spot = S.distinct_points(p).select(*S.AXES, F.col("id").alias("spot"))
    groups = durable(p.join(shuffled(spot), list(S.AXES)).select(F.col("spot").alias("id"), F.col("label").cast("string").alias("tag")))
    return durable(S.euclidean_tree(p)), groups


# a step of Prim's algorithm joins the runs of lighter steps before and after it
@query("merge_events", f"""WITH RECURSIVE {PRIM}, v AS (SELECT 0 AS step, pts.id, CAST(label AS VARCHAR) AS tag FROM pts JOIN s USING (id) UNION ALL SELECT step, id, CAST(label AS VARCHAR) FROM tree JOIN pts USING (id)), l AS (SELECT list(w ORDER BY step) AS ws FROM tree),
r AS (SELECT least(a.tag,b.tag) AS ga, greatest(a.tag,b.tag) AS gb, min(list_max(ws[a.step+1:b.step])) AS w FROM v a JOIN v b ON a.step<b.step AND a.tag<>b.tag, l GROUP BY 1,2),
e AS (SELECT t.step, t.w, coalesce((SELECT max(q.step) FROM tree q WHERE q.step<t.step AND q.w>t.w),0) AS lo, coalesce((SELECT min(q.step) FROM tree q WHERE q.step>t.step AND q.w>t.w),(SELECT max(step)+1 FROM tree)) AS hi FROM tree t WHERE w IN (SELECT w FROM r)),
side AS (SELECT e.step, v.step<e.step AS l, count(*) AS n, min(v.id) AS least, string_agg(DISTINCT v.tag, ',' ORDER BY v.tag) AS tags FROM e JOIN v ON v.step>=lo AND v.step<hi GROUP BY 1,2)
SELECT round(e.w,6) AS w, a.n+b.n AS size, a.tags AS large, b.tags AS small FROM e JOIN side a ON a.step=e.step JOIN side b ON b.step=e.step AND a.l<>b.l AND (a.n>b.n OR (a.n=b.n AND a.least<b.least))""")
def merge_events(spark, sf):
    """The merges of the spanning tree that bring two labels together for the first time."""
    tree, groups = _tagged_tree(spark, sf)
    merges = durable(G.merge_tree(tree, groups))
    e = G.merge_events(merges, G.first_meetings(merges, groups))
    return e.select(r6(F.col("w")).alias("w"), "size", F.array_join("large", ",").alias("large"), F.array_join("small", ",").alias("small"))


@query("expand_unclustered", f"WITH {POINT_SQL}, l AS (SELECT id,x,y,z, CASE WHEN label<5 THEN label ELSE -1 END AS label FROM pts), d AS (SELECT a.id, a.label, min({D}) AS d FROM l a JOIN l b ON a.label<>1 AND b.label=1 GROUP BY 1,2) SELECT label, count(*) AS near, label=-1 AS added FROM d WHERE d<=0.03 GROUP BY 1")
def expand_unclustered(spark, sf):
    p = points(spark, sf).withColumn("label", F.when(F.col("label") < 5, F.col("label")).otherwise(-1))
    e = S.expand_unclustered(p, p.filter("label = 1"), 0.03)
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("near"), F.bool_and("added").alias("added"))


@query("attach_faint", f"WITH {POINT_SQL}, d AS (SELECT a.id, b.id AS nb, b.label, {D} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {D}, b.id) AS n FROM pts a JOIN pts b ON a.label>=7 AND b.label<7) SELECT id, nb AS neighbour, round(d,6) AS distance FROM d WHERE n=1 AND d<=0.04 AND label IN (1,2)")
def attach_faint(spark, sf):
    p = points(spark, sf)
    kept = p.filter("label < 7")
    return S.attach_faint(p.filter("label >= 7"), kept, kept.filter("label in (1, 2)"), 0.04).withColumn("distance", r6(F.col("distance")))


@query("isolation", f"WITH {POINT_SQL}, d AS (SELECT a.id, min({D}) AS d FROM pts a JOIN pts b ON a.label<>3 AND b.label=3 GROUP BY 1) SELECT round(min(d),8) AS nearest_unselected, count(*) FILTER (WHERE d<=0.02) AS within_1r, count(*) FILTER (WHERE d<=0.04) AS within_2r, count(*) FILTER (WHERE d<=0.08) AS within_4r, count(*) FILTER (WHERE d<=0.16) AS within_8r FROM d")
def isolation(spark, sf):
    p = points(spark, sf)
    return S.isolation(p.filter("label = 3"), p.filter("label <> 3"), 0.02).withColumn("nearest_unselected", F.round("nearest_unselected", 8))


@query("touch_share", f"WITH {POINT_SQL}, d AS (SELECT a.id, min({D}) AS d FROM pts a JOIN pts b ON a.label=4 AND b.label=5 GROUP BY 1) SELECT count(*) AS n, round(avg(CASE WHEN d<0.05 THEN 1.0 ELSE 0.0 END),6) AS share FROM d")
def touch_share(spark, sf):
    p = points(spark, sf)
    near = S.nearest(p.filter("label = 4"), p.filter("label = 5"))
    return near.agg(F.count(F.lit(1)).alias("n"), r6(F.avg((F.col("distance") < 0.05).cast("double"))).alias("share"))


@query("geodesic_levels", f"""WITH RECURSIVE {POINT_SQL}, {closure(0.07)}, big AS (SELECT id FROM k WHERE component=(SELECT component FROM k GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 1)),
el AS (SELECT a.id AS a, b.id AS b, {D} AS w FROM pts a JOIN pts b ON {D}<=0.07 WHERE a.id IN (SELECT id FROM big) AND a.id<>b.id), g AS (SELECT 0 AS step, id, CASE WHEN id=(SELECT arg_min(id,(z,id)) FROM pts JOIN big USING (id)) THEN 0.0::DOUBLE ELSE 'inf'::DOUBLE END AS dist, true AS moved FROM big UNION ALL
SELECT step+1, id, n, bool_or(n<dist) OVER () FROM (SELECT t.step, t.id, t.dist, least(t.dist, coalesce(min(o.dist+el.w),'inf'::DOUBLE)) AS n FROM g t LEFT JOIN el ON el.b=t.id LEFT JOIN g o ON o.id=el.a WHERE t.moved GROUP BY 1,2,3) q),
f AS (SELECT id, CAST(floor(dist/0.05) AS BIGINT) AS bin FROM g WHERE step=(SELECT max(step) FROM g)), pe AS (SELECT el.a, el.b FROM el JOIN f x ON x.id=el.a JOIN f y ON y.id=el.b WHERE x.bin=y.bin),
c2 AS (SELECT id, id AS c FROM f UNION SELECT pe.b, c2.c FROM c2 JOIN pe ON pe.a=c2.id), nn AS (SELECT id, min(c) AS node FROM c2 GROUP BY 1) SELECT bin, node, count(*) AS points FROM f JOIN nn USING (id) GROUP BY 1,2""")
def geodesic_levels(spark, sf):
    level, _ = K.level_sets(points(spark, sf), 0.07, 0.05)
    return level.groupBy("bin", "node").agg(F.count(F.lit(1)).alias("points"))


@query("skeleton_branches")
def skeleton_branches(spark, sf):
    """Skeleton tree, its longest root path as the stem, and the pieces left for review."""
    nodes, tree, root = K.skeleton(points(spark, sf), 0.07, 0.1)
    hung = durable(G.rooted(tree, root))
    apex = hung.agg(F.max_by("id", F.struct("dist", "id")).alias("id"))
    guard = nodes.filter("points >= 5").select(F.col("node").alias("id"))
    return K.branch_candidates(tree, root, apex, guard)


@query("affine_transform", f"WITH {POINT_SQL} SELECT id, round(2.5*(0.6*(x-0.1)-0.8*(y+0.2)),6) AS x, round(2.5*(0.8*(x-0.1)+0.6*(y+0.2)),6) AS y, round(2.5*(z-0.05),6) AS z FROM pts")
def affine_transform(spark, sf):
    out = C.affine([F.col(c) for c in "xyz"], [[0.6, -0.8, 0], [0.8, 0.6, 0], [0, 0, 1]], [0.1, -0.2, 0.05], 2.5)
    return points(spark, sf).select("id", *[r6(c).alias(n) for c, n in zip(out, "xyz")])


@query("pinhole_projection", f"WITH {POINT_SQL}, c AS (SELECT n_nationkey AS cam, 500.0+n_nationkey AS f, 0.1*n_regionkey AS k1 FROM nation), n AS (SELECT cam, id, f, k1, x/(z+2) AS u, y/(z+2) AS v, z+2 AS d FROM pts, c) SELECT cam, count(*) AS n, round(avg(f*u*(1+k1*(u*u+v*v))+320),5) AS mean_u, round(avg(f*v*(1+k1*(u*u+v*v))+240),5) AS mean_v, round(max(d),6) AS max_depth FROM n WHERE d>0 GROUP BY 1")
def pinhole_projection(spark, sf):
    """Every camera sees every point: no hint, so the planner broadcasts the cameras only under its size limit."""
    cams = table(spark, sf, "nation").select(F.col("n_nationkey").alias("cam"), (500.0 + F.col("n_nationkey")).alias("f"), (0.1 * F.col("n_regionkey")).alias("k1"))
    n = points(spark, sf).crossJoin(cams).withColumn("d", F.col("z") + 2).filter("d > 0")
    u, v = F.col("x") / F.col("d"), F.col("y") / F.col("d")
    bend = 1 + F.col("k1") * (u * u + v * v)
    return n.groupBy("cam").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("f") * u * bend + 320), 5).alias("mean_u"),
                                F.round(F.avg(F.col("f") * v * bend + 240), 5).alias("mean_v"), r6(F.max("d")).alias("max_depth"))


@query("quaternion_turn", f"WITH {SPLAT_SQL}, n AS (SELECT row_id, rot_0/l AS w, rot_1/l AS x, rot_2/l AS y, rot_3/l AS z FROM (SELECT *, sqrt(rot_0*rot_0+rot_1*rot_1+rot_2*rot_2+rot_3*rot_3) AS l FROM splat)) SELECT row_id, round(0.8*w-0.6*z,6) AS w, round(0.8*x-0.6*y,6) AS x, round(0.8*y+0.6*x,6) AS y, round(0.8*z+0.6*w,6) AS z FROM n")
def quaternion_turn(spark, sf):
    """Rotation to matrix and back, then a turn by (0.8, 0, 0, 0.6)."""
    q = [F.col(f"rot_{i}") for i in range(4)]
    back = C.matrix_to_quat(C.quat_to_matrix(q))
    s = splats(spark, sf).select("row_id", *[c.alias(f"q{i}") for i, c in enumerate(back)])
    out = C.quat_multiply([F.lit(0.8), F.lit(0.0), F.lit(0.0), F.lit(0.6)], [F.col(f"q{i}") for i in range(4)])
    return s.select("row_id", *[r6(c).alias(n) for c, n in zip(out, "wxyz")])


@query("splat_covariance", f"WITH {SPLAT_SQL} SELECT row_id, round((exp(2*scale_0)+exp(2*scale_1)+exp(2*scale_2))*4,9) AS trace FROM splat")
def splat_covariance(spark, sf):
    """Trace of s^2 R S R^T: the rotation must not change it."""
    cov = C.covariance([F.col(f"scale_{i}") for i in range(3)], [F.col(f"rot_{i}") for i in range(4)])
    return splats(spark, sf).select("row_id", F.round((cov[0][0] + cov[1][1] + cov[2][2]) * 4, 9).alias("trace"))


@query("sh_energy", f"WITH {POINT_SQL} SELECT id, round(1/(4*pi()),6) AS b0, round(3/(4*pi()),6) AS b1, round(5/(4*pi()),6) AS b2, round(7/(4*pi()),6) AS b3, round(9/(4*pi()),6) AS b4 FROM pts WHERE x*x+y*y+z*z>0")
def sh_energy(spark, sf):
    """Sum of squared basis functions of every band at each point's direction (addition theorem)."""
    l = C.length([F.col(c) for c in "xyz"])
    p = points(spark, sf).filter(l > 0).select("id", *[(F.col(c) / l).alias(c) for c in "xyz"])
    b = C.sh_basis(F.col("x"), F.col("y"), F.col("z"), 4)
    bands = [sum((v * v for v in b[k * k + 1:(k + 1) ** 2]), b[k * k] * b[k * k]) for k in range(5)]
    return p.select("id", *[r6(v).alias(f"b{k}") for k, v in enumerate(bands)])


#: colours of the recolour query
SHADES = ((0.9, 0.2, 0.1), (0.2, 0.7, 0.3), (0.1, 0.4, 0.8))


@query("palette_recolor", f"""WITH {SPLAT_SQL}, c AS (SELECT row_id, label, greatest(0,least(1,0.5+0.28209479177387814*f_dc_0)) r, greatest(0,least(1,0.5+0.28209479177387814*f_dc_1)) g, greatest(0,least(1,0.5+0.28209479177387814*f_dc_2)) b FROM splat),
t AS (SELECT row_id, label, label IN (1,2,9) AS chosen, 0.2126*r+0.7152*g+0.0722*b AS gray FROM c)
SELECT row_id, round(CASE WHEN chosen THEN ([0.9,0.2,0.1])[label%3+1] ELSE gray END,6) AS red, round(CASE WHEN chosen THEN ([0.2,0.7,0.4])[label%3+1] ELSE gray END,6) AS green, round(CASE WHEN chosen THEN ([0.1,0.3,0.8])[label%3+1] ELSE gray END,6) AS blue FROM t""")
def palette_recolor(spark, sf):
    s = splats(spark, sf)
    painted = recolor(s, s.select("row_id", "label"), [1, 2, 9], SHADES, gray_rest=True)
    return painted.select("row_id", *[r6(C.dc_to_rgb(F.col(f"f_dc_{i}"))).alias(n) for i, n in enumerate(("red", "green", "blue"))])


@query("stem_projection", f"""WITH {POINT_SQL}, n AS (SELECT label AS i, avg(x) x, avg(y) y, avg(z) z FROM pts GROUP BY 1), s AS (SELECT a.i, a.x ax, a.y ay, a.z az, b.x-a.x dx, b.y-a.y dy, b.z-a.z dz FROM n a JOIN n b ON b.i=a.i+1),
t AS (SELECT id, i, s.*, greatest(0,least(1,((x-ax)*dx+(y-ay)*dy+(z-az)*dz)/(dx*dx+dy*dy+dz*dz))) AS f, x, y, z FROM pts, s), d AS (SELECT id, i, f, sqrt(pow(x-ax-f*dx,2)+pow(y-ay-f*dy,2)+pow(z-az-f*dz,2)) AS d FROM t)
SELECT id, round(arg_min(i+f, d),6) AS along, round(min(d),6) AS distance FROM d GROUP BY 1""")
def stem_projection(spark, sf):
    p = points(spark, sf)
    n = p.groupBy(F.col("label").alias("i")).agg(*[F.avg(c).alias(c) for c in "xyz"])
    s = O.ordered(n, [], ["i"], O.Ordered(leads={f"b{c}": F.col(c) for c in "xyz"})).filter("bx is not null")
    return nearest_segment(p, s.withColumnRenamed("i", "segment")).select("id", r6(F.col("segment") + F.col("fraction")).alias("along"), r6(F.col("distance")).alias("distance"))


def _res(t):
    q = [f"(p{c}-{c}-({t})*d{c})" for c in "xyz"]
    g = [f"((1-({t}))*t{c}+({t})*u{c})" for c in "xyz"]
    dot = "+".join(f"{a}*{b}" for a, b in zip(q, g))
    size = "*".join("sqrt(" + "+".join(f"{a}*{a}" for a in v) + ")" for v in (q, g))
    return f"(acos(greatest(-1,least(1,({dot})/({size}))))-theta)"


# the curve through the labels' means; label i is a known leaf at node i with an angle of 50 + 3 i degrees
ATTACH_SQL = f"""WITH RECURSIVE {POINT_SQL}, n AS (SELECT label AS i, avg(x) x, avg(y) y, avg(z) z FROM pts GROUP BY 1),
w AS (SELECT *, coalesce(lead(x) OVER o,x)-coalesce(lag(x) OVER o,x) AS wx, coalesce(lead(y) OVER o,y)-coalesce(lag(y) OVER o,y) AS wy, coalesce(lead(z) OVER o,z)-coalesce(lag(z) OVER o,z) AS wz FROM n WINDOW o AS (ORDER BY i)),
t AS (SELECT i, x, y, z, wx/sqrt(wx*wx+wy*wy+wz*wz) AS tx, wy/sqrt(wx*wx+wy*wy+wz*wz) AS ty, wz/sqrt(wx*wx+wy*wy+wz*wz) AS tz FROM w),
g AS (SELECT a.i, a.x, a.y, a.z, b.x-a.x AS dx, b.y-a.y AS dy, b.z-a.z AS dz, a.tx, a.ty, a.tz, b.tx AS ux, b.ty AS uy, b.tz AS uz, sqrt(pow(b.x-a.x,2)+pow(b.y-a.y,2)+pow(b.z-a.z,2)) AS len FROM t a JOIN t b ON b.i=a.i+1),
s AS (SELECT *, sum(len) OVER (ORDER BY i)-len AS arc FROM g), known AS (SELECT i AS leaf, arc, radians(50+3*i) AS angle FROM s),
pr AS (SELECT id, p.x AS px, p.y AS py, p.z AS pz, s.*, greatest(0,least(1,((p.x-s.x)*dx+(p.y-s.y)*dy+(p.z-s.z)*dz)/(len*len))) AS f FROM pts p, s),
near AS (SELECT id, arg_min(arc+f*len, pow(px-x-f*dx,2)+pow(py-y-f*dy,2)+pow(pz-z-f*dz,2)) AS want FROM pr GROUP BY 1),
two AS (SELECT id, any_value(want) AS want, avg(angle) AS theta FROM (SELECT id, want, angle, row_number() OVER (PARTITION BY id ORDER BY abs(arc-want), leaf) AS k FROM near, known) WHERE k<=2 GROUP BY 1),
c AS (SELECT pr.*, want, theta, h, {_res("h/32")} AS r FROM pr JOIN two USING (id), (SELECT unnest(range(33)) AS h)),
b AS (SELECT *, lead(r) OVER (PARTITION BY id, i ORDER BY h) AS nxt FROM c),
q AS (SELECT 0 AS k, b.* EXCLUDE (h, nxt, r, f), h/32 AS lo, (h+1)/32 AS hi, r FROM b WHERE r*nxt<0 UNION ALL
 SELECT k+1, * EXCLUDE (k, lo, hi, m, r), CASE WHEN m*r>0 THEN (lo+hi)/2 ELSE lo END, CASE WHEN m*r>0 THEN hi ELSE (lo+hi)/2 END, r FROM (SELECT * EXCLUDE (r), {_res("(lo+hi)/2")} AS m, r FROM q) WHERE k<50),
e AS (SELECT id, i, arc+(lo+hi)/2*len AS at, (lo+hi)/2 AS t, want FROM q WHERE k=50 QUALIFY row_number() OVER (PARTITION BY id ORDER BY abs(arc+(lo+hi)/2*len-want), i)=1)
SELECT two.id, e.i AS segment, round(e.t,6) AS fraction, round(e.at,6) AS arc, round(abs(e.at-two.want),6) AS shift, CASE WHEN e.i IS NOT NULL THEN true END AS exact FROM two LEFT JOIN e ON e.id=two.id"""


@query("stem_attachment", ATTACH_SQL)
def stem_attachment(spark, sf):
    """Every point attached to the curve through the labels' means, at the mean angle of the two known leaves nearest along it."""
    p = points(spark, sf)
    nodes = p.groupBy(F.col("label").alias("i")).agg(*[F.avg(c).alias(c) for c in "xyz"]).withColumn("plant", F.lit(0))
    s = durable(A.stem_segments(nodes))
    known = s.select("plant", F.col("segment").alias("leaf"), "arc", F.radians(50.0 + 3 * F.col("segment")).alias("angle"))
    place = nearest_segment(p, s.select("segment", "x", "y", "z", "bx", "by", "bz")).join(s.select("plant", "segment", F.col("arc").alias("start"), "length"), "segment")
    anchors = p.join(place.select("id", "plant", (F.col("start") + F.col("fraction") * F.col("length")).alias("arc")), "id")
    at = A.attach(durable(A.reference_angles(anchors.select("plant", "id", "x", "y", "z", "arc"), known)), s)
    return at.select("id", "segment", *[r6(F.col(c)).alias(c) for c in ("fraction", "arc", "shift")], (F.col("residual") < 1e-12).alias("exact"))


@query("local_linearity", f"""WITH {POINT_SQL}, d AS (SELECT a.id, b.x, b.y, b.z, row_number() OVER (PARTITION BY a.id ORDER BY (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z), b.id) AS k FROM pts a, pts b),
c AS (SELECT id, covar_pop(x,x) xx, covar_pop(x,y) xy, covar_pop(x,z) xz, covar_pop(y,y) yy, covar_pop(y,z) yz, covar_pop(z,z) zz FROM d WHERE k<=16 GROUP BY 1),
m AS (SELECT *, (xx+yy+zz)/3 AS m FROM c), p AS (SELECT *, sqrt(((xx-m)*(xx-m)+(yy-m)*(yy-m)+(zz-m)*(zz-m)+2*(xy*xy+xz*xz+yz*yz))/6) AS p FROM m),
q AS (SELECT *, (xx-m)/p AS a, (yy-m)/p AS b, (zz-m)/p AS c, xy/p AS d, xz/p AS e, yz/p AS f FROM p),
r AS (SELECT *, acos(greatest(-1,least(1,(a*(b*c-f*f)-d*(d*c-f*e)+e*(d*f-b*e))/2)))/3 AS phi FROM q),
e AS (SELECT id, m, m+2*p*cos(phi) AS e1, m+2*p*cos(phi+2.0943951023931953) AS e3 FROM r)
SELECT id, round(1-sqrt(greatest(3*m-e1-e3,0))/sqrt(e1),6) AS linearity FROM e""")
def local_linearity(spark, sf):
    """(s1 - s2) / s1 of the 16 nearest points' covariance, eigenvalues in closed form."""
    p = points(spark, sf)
    near = S.nearest(p, p, 16)
    q = near.join(p.select(F.col("id").alias("neighbour"), "x", "y", "z"), "neighbour")
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    c = q.groupBy("id").agg(*[F.covar_pop(a, b).alias(a + b) for a, b in pairs])
    return c.select("id", r6(linearity(*[F.col(a + b) for a, b in pairs])).alias("linearity"))


def linearity(xx, xy, xz, yy, yz, zz):
    """From the two largest eigenvalues of a symmetric 3 x 3 matrix (trigonometric solution)."""
    m = (xx + yy + zz) / 3
    off = xy * xy + xz * xz + yz * yz
    p = F.sqrt(((xx - m) * (xx - m) + (yy - m) * (yy - m) + (zz - m) * (zz - m) + 2 * off) / 6)
    a, b, c = (xx - m) / p, (yy - m) / p, (zz - m) / p
    d, e, f = xy / p, xz / p, yz / p
    det = (a * (b * c - f * f) - d * (d * c - f * e) + e * (d * f - b * e)) / 2
    phi = F.acos(C.clip(det, -1.0, 1.0)) / 3
    e1 = m + 2 * p * F.cos(phi)
    e3 = m + 2 * p * F.cos(phi + 2.0943951023931953)
    s1, s2 = F.sqrt(F.greatest(e1, F.lit(0.0))), F.sqrt(F.greatest(3 * m - e1 - e3, F.lit(0.0)))
    return F.when(p > 0, F.try_divide(s1 - s2, s1))


@query("splat_transform", f"WITH {SPLAT_SQL} SELECT row_id, round(2*(0.6*(x-0.1)-0.8*y),6)+0.0 AS x, round(2*(0.8*(x-0.1)+0.6*y),6)+0.0 AS y, round(2*z,6)+0.0 AS z, round(scale_0+ln(2),6) AS scale_0, round(2*rot_0/sqrt(5)-rot_3/sqrt(5),6)+0.0 AS rot_0, round(2*rot_3/sqrt(5)+rot_0/sqrt(5),6)+0.0 AS rot_3 FROM splat")
def splat_transform(spark, sf):

    t = transform(splats(spark, sf), [[0.6, -0.8, 0], [0.8, 0.6, 0], [0, 0, 1]], [0.1, 0, 0], 2.0)
    return t.select("row_id", *[(r6(F.col(c)) + 0.0).alias(c) for c in ("x", "y", "z", "rot_0", "rot_3")], r6(F.col("scale_0")).alias("scale_0"))
