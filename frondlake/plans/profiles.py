"""Profiles and grouped summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators import ordered as O
from frondlake.plans.derived import FRAME_SQL, POINT_SQL, SPLAT_SQL, frames, points, splats
from frondlake.plans.registry import query
from frondlake.session import table


def r6(c):
    return F.round(c, 6)


def confusion(df: DataFrame, group: str) -> DataFrame:
    """Counts, rates, IoU and Dice per group plus an OVERALL row, from boolean columns p and r."""
    p, r = F.col("p"), F.col("r")
    # the finest groups are counted first, so the grand total adds a few partial rows only
    cells = df.groupBy(group).agg(F.count_if(p & r).alias("tp"), F.count_if(p & ~r).alias("fp"),
                                  F.count_if(~p & r).alias("fn"), F.count_if(~p & ~r).alias("tn"))
    both = cells.rollup(group).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")], F.grouping(group).alias("g"))
    name = F.when(F.col("g") == 1, "OVERALL").otherwise(F.col(group))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return both.select(name.alias("dataset_id"), "tp", "fp", "fn", "tn", r6(C.iou(tp, fp, fn)).alias("iou"),
                       r6(C.dice(tp, fp, fn)).alias("dice"),
                       r6(F.try_divide(fp.cast("double"), tp + fn)).alias("fp_rate_vs_ref_fg"),
                       r6(F.try_divide(fn.cast("double"), tp + fn)).alias("fn_rate_vs_ref_fg"))


@query("confusion_by_lang", """
WITH c AS (SELECT d.lang, count(*) FILTER (WHERE toxic=1 AND quality=1) AS tp, count(*) FILTER (WHERE toxic=1 AND quality=0) AS fp,
 count(*) FILTER (WHERE toxic=0 AND quality=1) AS fn, count(*) FILTER (WHERE toxic=0 AND quality=0) AS tn, grouping(d.lang) AS g
 FROM labels l JOIN documents d USING (doc_id) GROUP BY ROLLUP (d.lang))
SELECT CASE WHEN g=1 THEN 'OVERALL' ELSE lang END AS dataset_id, tp, fp, fn, tn,
 round(coalesce(CAST(tp AS DOUBLE)/nullif(tp+fp+fn,0),1.0),6) AS iou, round(coalesce(2.0*tp/nullif(2*tp+fp+fn,0),1.0),6) AS dice,
 round(CAST(fp AS DOUBLE)/nullif(tp+fn,0),6) AS fp_rate_vs_ref_fg, round(CAST(fn AS DOUBLE)/nullif(tp+fn,0),6) AS fn_rate_vs_ref_fg FROM c""")
def confusion_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return confusion(joined.select("lang", (F.col("toxic") == 1).alias("p"), (F.col("quality") == 1).alias("r")), "lang")


def summary(df: DataFrame, group: str, value: str, note: str, fp: str, fn: str, ref: str, exclude: list[str],
            hot_rows: int = O.HOT_ROWS) -> DataFrame:
    """Per-group quality summary plus OVERALL. Rows with an excluded or any note count, but only
    note-free rows are measured; a group without any keeps null metrics."""
    ok = ~F.col(note).isin(exclude) & (F.col(note) == "")
    base = df.select(F.explode(F.array(F.col(group), F.lit("OVERALL"))).alias("dataset_id"), ok.alias("ok"), F.col(note).alias("note"),
                     F.when(ok, F.col(value)).alias("v"), F.when(ok, F.col(fp)).alias("fp"), F.when(ok, F.col(fn)).alias("fn"),
                     F.when(ok & (F.col(ref) != 0), F.col(fp) / F.col(ref)).alias("fpr"))
    stats = base.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n_rows_total"), F.count_if("ok").alias("n_compared"), F.count_if(~F.col("ok")).alias("n_excluded"),
        r6(F.avg("v")).alias("mean_v"), r6(F.stddev_samp("v")).alias("sd_v"),
        r6(100.0 * F.avg((F.col("v") >= 0.09).cast("double"))).alias("pct_v_ge"),
        r6(F.avg("fp")).alias("mean_fp"), r6(F.avg("fn")).alias("mean_fn"), r6(F.avg("fpr")).alias("mean_fp_rate"),
        F.count_if(F.col("note") != "").alias("count_note_nonempty"))
    q = O.quantiles(base, ["dataset_id"], {"v": F.col("v"), "fp": F.col("fp")},
                    {"p05": 0.05, "q1": 0.25, "p50": 0.5, "q3": 0.75, "p95": 0.95}, hot_rows, 2 * df.count())
    q = q.select("dataset_id", *[r6(F.col(c)).alias(c) for c in ("v_p05", "v_q1", "v_p50", "v_q3", "v_p95", "fp_p50")])
    return stats.join(q, "dataset_id", "left")


@query("dataset_summary", """
WITH n AS (SELECT l_returnflag AS g, CASE WHEN l_linestatus='O' AND l_quantity < 5 THEN 'shape_mismatch' WHEN l_quantity > 48 THEN 'unreadable' ELSE '' END AS note,
  l_discount AS v, l_quantity AS fp, l_tax AS fn, l_linenumber - 1 AS ref FROM lineitem),
b AS (SELECT g AS dataset_id, * FROM n UNION ALL SELECT 'OVERALL' AS dataset_id, * FROM n)
SELECT dataset_id, count(*) AS n_rows_total, count(*) FILTER (WHERE note='') AS n_compared, count(*) FILTER (WHERE note<>'') AS n_excluded,
 round(avg(v) FILTER (WHERE note=''),6) AS mean_v, round(stddev_samp(v) FILTER (WHERE note=''),6) AS sd_v,
 round(100.0*avg(CASE WHEN v>=0.09 THEN 1.0 ELSE 0.0 END) FILTER (WHERE note=''),6) AS pct_v_ge,
 round(avg(fp) FILTER (WHERE note=''),6) AS mean_fp, round(avg(fn) FILTER (WHERE note=''),6) AS mean_fn,
 round(avg(fp/nullif(ref,0)) FILTER (WHERE note=''),6) AS mean_fp_rate, count(*) FILTER (WHERE note<>'') AS count_note_nonempty,
 round(quantile_cont(v,0.05) FILTER (WHERE note=''),6) AS v_p05, round(quantile_cont(v,0.25) FILTER (WHERE note=''),6) AS v_q1,
 round(quantile_cont(v,0.5) FILTER (WHERE note=''),6) AS v_p50, round(quantile_cont(v,0.75) FILTER (WHERE note=''),6) AS v_q3,
 round(quantile_cont(v,0.95) FILTER (WHERE note=''),6) AS v_p95, round(quantile_cont(fp,0.5) FILTER (WHERE note=''),6) AS fp_p50
FROM b GROUP BY dataset_id""")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    note = F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") < 5), "shape_mismatch") \
        .when(F.col("l_quantity") > 48, "unreadable").otherwise("")
    df = li.select("l_returnflag", "l_discount", "l_quantity", "l_tax", (F.col("l_linenumber") - 1).alias("ref"), note.alias("note"))
    return summary(df, "l_returnflag", "l_discount", "note", "l_quantity", "l_tax", "ref", ["unreadable"])


@query("point_profile", """
WITH p AS (SELECT l_extendedprice AS x, 1/(1+exp(-greatest(-500, least(500, (l_quantity-25)/10)))) AS op, l_tax AS t FROM lineitem)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE x IS NULL OR isnan(x) OR isinf(x)) AS non_finite, round(median(op),6) AS opacity_median,
 round(avg(CASE WHEN op>0.5 THEN 1.0 ELSE 0.0 END),6) AS opacity_share, round(median(t),6) AS scale_median, round(quantile_cont(t,0.99),6) AS scale_p99,
 round(quantile_cont(x,0.99)-quantile_cont(x,0.01),6) AS extent_x FROM p""")
def point_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("x"), C.sigmoid((F.col("l_quantity") - 25) / 10).alias("op"), F.col("l_tax").alias("t"))
    flat = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~C.finite(F.col("x"))).alias("non_finite"),
                  r6(F.avg((F.col("op") > 0.5).cast("double"))).alias("opacity_share"))
    q = O.quantiles(df, [], {c: C.finite_or_null(F.col(c)) for c in ("x", "op", "t")}, {"p01": 0.01, "p50": 0.5, "p99": 0.99})
    q = q.select(r6(F.col("op_p50")).alias("opacity_median"), r6(F.col("t_p50")).alias("scale_median"),
                 r6(F.col("t_p99")).alias("scale_p99"), r6(F.col("x_p99") - F.col("x_p01")).alias("extent_x"))
    return flat.crossJoin(q).select("n_rows", "non_finite", "opacity_median", "opacity_share", "scale_median", "scale_p99", "extent_x")


@query("finite_span", "SELECT min(value) AS low, max(value) AS high, count(*) AS n FROM events WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)")
def finite_span(spark, sf):
    e = table(spark, sf, "events").filter(C.finite(F.col("value")))
    return e.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n"))


def box_filter(df: DataFrame, columns: list[str], low: float = 0.05, high: float = 0.95, pad: float = 0.1) -> DataFrame:
    """Rows strictly inside the low..high quantile box of every column, padded by a share of it."""
    q = O.quantiles(df, [], {c: F.col(c) for c in columns}, {"lo": low, "hi": high})
    edges = df.crossJoin(F.broadcast(q))
    keep = F.lit(True)
    for c in columns:
        room = (F.col(f"{c}_hi") - F.col(f"{c}_lo")) * pad
        keep = keep & (F.col(c) > F.col(f"{c}_lo") - room) & (F.col(c) < F.col(f"{c}_hi") + room)
    return edges.filter(keep).select(df.columns)


@query("percentile_box_filter", """
WITH q AS (SELECT quantile_cont(l_extendedprice,0.05) a, quantile_cont(l_extendedprice,0.95) b, quantile_cont(l_quantity,0.05) c, quantile_cont(l_quantity,0.95) d FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice),2) AS total FROM lineitem, q
WHERE l_extendedprice > a-(b-a)*0.1 AND l_extendedprice < b+(b-a)*0.1 AND l_quantity > c-(d-c)*0.1 AND l_quantity < d+(d-c)*0.1 GROUP BY l_returnflag""")
def percentile_box_filter(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    kept = box_filter(li, ["l_extendedprice", "l_quantity"])
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("paired_difference", """
WITH j AS (SELECT a.user_id AS token, a.event_type AS split, b.value-a.value AS d FROM
 (SELECT user_id, event_type, date_trunc('day',ts) dy, avg(value) AS value FROM events WHERE event_id%2=0 GROUP BY 1,2,3) a JOIN
 (SELECT user_id, event_type, date_trunc('day',ts) dy, avg(value) AS value FROM events WHERE event_id%2=1 GROUP BY 1,2,3) b USING (user_id,event_type,dy))
SELECT CASE WHEN grouping(split)=1 THEN 'all' ELSE split END AS split, count(*) AS n, round(avg(d),6) AS mean_diff, round(stddev_samp(d),6) AS sd_diff,
 round(avg(CASE WHEN d>0 THEN 1.0 ELSE 0.0 END),6) AS share_better FROM j GROUP BY GROUPING SETS ((split),())""")
def paired_difference(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.date_trunc("day", "ts").alias("dy"), "event_id", "value")
    arm = F.pmod("event_id", F.lit(2))
    # both arms come out of one aggregation, so the pairing needs no join
    j = e.groupBy("user_id", "event_type", "dy").agg(F.avg(F.when(arm == 0, F.col("value"))).alias("a"),
                                                     F.avg(F.when(arm == 1, F.col("value"))).alias("b"))
    j = j.filter("a is not null and b is not null").select(F.col("event_type").alias("split"), (F.col("b") - F.col("a")).alias("d"))
    name = F.when(F.grouping("split") == 1, "all").otherwise(F.col("split"))
    return j.rollup("split").agg(name.alias("part"), F.count(F.lit(1)).alias("n"), r6(F.avg("d")).alias("mean_diff"),
                                 r6(F.stddev_samp("d")).alias("sd_diff"), r6(F.avg((F.col("d") > 0).cast("double"))).alias("share_better")) \
        .select(F.col("part").alias("split"), "n", "mean_diff", "sd_diff", "share_better")


@query("dedup_counts", "SELECT l_partkey, l_suppkey, count(*) AS copies, min(l_orderkey) AS first_order FROM lineitem GROUP BY 1,2")
def dedup_counts(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("copies"), F.min("l_orderkey").alias("first_order"))


@query("cluster_boxes", f"""WITH {POINT_SQL} SELECT label, count(*) AS size, round(avg(x),6) AS cx, round(avg(y),6) AS cy, round(avg(z),6) AS cz,
 round(min(x),6) AS x0, round(max(x),6) AS x1, round(min(y),6) AS y0, round(max(y),6) AS y1, round(min(z),6) AS z0, round(max(z),6) AS z1 FROM pts GROUP BY label""")
def cluster_boxes(spark, sf):
    return points(spark, sf).groupBy("label").agg(
        F.count(F.lit(1)).alias("size"), *[r6(F.avg(c)).alias(f"c{c}") for c in "xyz"],
        *[r6(f(c)).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))])


@query("region_counts", """SELECT count(*) FILTER (WHERE label IN (1,2,3)) AS selected, count(*) FILTER (WHERE label=0) AS unlabeled,
 count(*) FILTER (WHERE label NOT IN (0,1,2,3)) AS residual, count(DISTINCT label) AS regions FROM embeddings""")
def region_counts(spark, sf):
    chosen = F.col("label").isin(1, 2, 3)
    return table(spark, sf, "embeddings").agg(F.count_if(chosen).alias("selected"), F.count_if(F.col("label") == 0).alias("unlabeled"),
                                              F.count_if(~chosen & (F.col("label") != 0)).alias("residual"), F.countDistinct("label").alias("regions"))


@query("image_cost", """
WITH s AS (SELECT p_brand, p_partkey, p_size*100 AS w, p_size*75 AS h FROM part),
c AS (SELECT p_brand, p_partkey, CASE WHEN greatest(w,h)>3200 THEN round(w*3200.0/greatest(w,h)) ELSE w END AS cw, CASE WHEN greatest(w,h)>3200 THEN round(h*3200.0/greatest(w,h)) ELSE h END AS ch FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY cw*ch DESC, p_partkey) AS k FROM c)
SELECT p_brand, p_partkey AS worst, CAST(cw*ch AS BIGINT) AS pixels, CAST(ceil(cw*ch*24/1048576.0) AS BIGINT) AS mib_per_thread FROM r WHERE k=1""")
def image_cost(spark, sf):
    s = table(spark, sf, "part").select("p_brand", "p_partkey", (F.col("p_size") * 100).alias("w"), (F.col("p_size") * 75).alias("h"))
    longest = F.greatest("w", "h")
    cw, ch = [F.when(longest > 3200, F.round(F.col(c) * 3200.0 / longest)).otherwise(F.col(c)).cast("bigint") for c in ("w", "h")]
    px = cw * ch
    best = s.groupBy("p_brand").agg(F.min_by(F.struct("p_partkey", px.alias("px")), F.struct(-px, F.col("p_partkey"))).alias("m"))
    return best.select("p_brand", F.col("m.p_partkey").alias("worst"), F.col("m.px").alias("pixels"),
                       F.ceil(F.col("m.px") * 24 / 1048576.0).alias("mib_per_thread"))


@query("budget_terms", """
WITH t AS (SELECT c_mktsegment AS host, unnest(['balance','ceiling','reserve']) AS term, unnest([sum(c_acctbal), 900000.0, count(*)*3000.0]) AS v FROM customer GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY v, term) AS k FROM t)
SELECT host, term AS binding, round(v,2) AS budget, CAST(least(floor(greatest(v-256,0)/50000.0), 24) AS BIGINT) AS threads FROM r WHERE k=1""")
def budget_terms(spark, sf):
    t = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("host")).agg(F.sum("c_acctbal").alias("balance"), (F.count(F.lit(1)) * 3000.0).alias("reserve"))
    terms = F.array(*[F.struct(v.cast("double").alias("v"), F.lit(n).alias("term")) for n, v in
                      (("balance", F.col("balance")), ("ceiling", F.lit(900000.0)), ("reserve", F.col("reserve")))])
    low = F.array_min(terms)
    return t.select("host", low["term"].alias("binding"), F.round(low["v"], 2).alias("budget"),
                    F.least(F.floor(F.greatest(low["v"] - 256, F.lit(0.0)) / 50000.0), F.lit(24)).cast("bigint").alias("threads"))


@query("fold_maxima", "SELECT user_id, max(value) FILTER (WHERE event_type<>'error') AS peak, count(*) FILTER (WHERE event_type='error') AS failed, max(ts) AS last_ts FROM events GROUP BY user_id")
def fold_maxima(spark, sf):
    bad = F.col("event_type") == "error"
    return table(spark, sf, "events").groupBy("user_id").agg(F.max(F.when(~bad, F.col("value"))).alias("peak"), F.count_if(bad).alias("failed"), F.max("ts").alias("last_ts"))


@query("held_out_count", """SELECT source, CAST(count(*) AS BIGINT) AS photographs, CAST(count(*) - ceil(count(*)*0.9) AS BIGINT) AS by_fraction, CAST(ceil(count(*)/8.0) AS BIGINT) AS by_interval FROM documents GROUP BY source""")
def held_out_count(spark, sf):
    n = F.count(F.lit(1))
    return table(spark, sf, "documents").groupBy("source").agg(n.alias("photographs"), (n - F.ceil(n * 0.9)).cast("bigint").alias("by_fraction"), F.ceil(n / 8.0).cast("bigint").alias("by_interval"))


@query("next_run_count", """WITH b AS (SELECT p_type AS prefix, CAST(regexp_extract(p_brand,'#(\\d+)$',1) AS INT) AS k FROM part UNION ALL SELECT p_type, p_size FROM part)
SELECT prefix, repeat('0', greatest(0, 2 - length(k))) || k AS next_run FROM (SELECT prefix, CAST(coalesce(max(k),0)+1 AS VARCHAR) AS k FROM b GROUP BY prefix)""")
def next_run_count(spark, sf):
    p = table(spark, sf, "part")
    both = p.select(F.col("p_type").alias("prefix"), F.regexp_extract("p_brand", r"#(\d+)$", 1).cast("int").alias("k")) \
        .union(p.select("p_type", F.col("p_size")))
    return both.groupBy("prefix").agg(C.padded(F.coalesce(F.max("k"), F.lit(0)) + 1, 2).alias("next_run"))


@query("status_counts", "SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice),2) AS total FROM orders GROUP BY 1")
def status_counts(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("mask_sets", "SELECT source AS dir, count(*) AS files, array_to_string(list_sort(list(DISTINCT lang)), ',') AS suffixes FROM documents GROUP BY 1")
def mask_sets(spark, sf):
    # few distinct suffixes: the set is collected after they are distinct
    d = table(spark, sf, "documents").groupBy(F.col("source").alias("dir"), "lang").agg(F.count(F.lit(1)).alias("n"))
    return d.groupBy("dir").agg(F.sum("n").alias("files"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("suffixes"))


@query("mean_direction", f"""WITH {POINT_SQL}, u AS (SELECT x/l AS ux, y/l AS uy, z/l AS uz FROM (SELECT *, sqrt(x*x+y*y+z*z) AS l FROM pts) WHERE l>0),
m AS (SELECT avg(ux) AS mx, avg(uy) AS my, avg(uz) AS mz FROM u), a AS (SELECT degrees(acos(greatest(-1,least(1,(ux*mx+uy*my+uz*mz)/sqrt(mx*mx+my*my+mz*mz))))) AS ang, sqrt(mx*mx+my*my+mz*mz) AS len FROM u, m)
SELECT count(*) AS n, round(max(len),6) AS resultant, round(sqrt(avg(ang*ang)),5) AS angular_rms, round(max(ang),5) AS angular_max, round(median(ang),5) AS angular_median FROM a""")
def mean_direction(spark, sf):
    p = points(spark, sf)
    l = C.length([F.col(c) for c in "xyz"])
    u = p.filter(l > 0).select(*[(F.col(c) / l).alias(f"u{c}") for c in "xyz"])
    m = u.agg(*[F.avg(f"u{c}").alias(f"m{c}") for c in "xyz"])
    a = u.crossJoin(F.broadcast(m))
    uu, mm = [F.col(f"u{c}") for c in "xyz"], [F.col(f"m{c}") for c in "xyz"]
    ang = F.degrees(F.acos(C.clip(C.dot(uu, mm) / C.length(mm), -1.0, 1.0)))
    a = a.select(ang.alias("ang"), C.length(mm).alias("len"))
    q = O.quantiles(a, [], {"ang": F.col("ang")}, {"p50": 0.5}).select(F.round("ang_p50", 5).alias("angular_median"))
    return a.agg(F.count(F.lit(1)).alias("n"), r6(F.max("len")).alias("resultant"), F.round(F.sqrt(F.avg(F.col("ang") * F.col("ang"))), 5).alias("angular_rms"),
                 F.round(F.max("ang"), 5).alias("angular_max")).crossJoin(q)


def slice_profile(df: DataFrame, height: str, a: str, b: str, step: float, min_points: int, share: float,
                  hot_rows: int = O.HOT_ROWS) -> DataFrame:
    """Per height slice from the lowest row: rows, median position and the radius holding ``share``."""
    low = df.agg(F.min(height).alias("h0"))
    s = df.crossJoin(F.broadcast(low)).withColumn("slice", F.floor((F.col(height) - F.col("h0")) / F.lit(step)).cast("bigint"))
    rows = df.count()
    mid = O.quantiles(s, ["slice"], {"a": F.col(a), "b": F.col(b)}, {"p50": 0.5}, hot_rows, rows)
    n = s.groupBy("slice").agg(F.count(F.lit(1)).alias("points"), F.first("h0").alias("h0")).filter(F.col("points") >= min_points)
    axis = n.join(mid, "slice")
    away = s.drop("h0").join(axis, "slice")
    dist = F.sqrt((F.col(a) - F.col("a_p50")) * (F.col(a) - F.col("a_p50")) + (F.col(b) - F.col("b_p50")) * (F.col(b) - F.col("b_p50")))
    rad = O.quantiles(away, ["slice"], {"r": dist}, {"q": share}, hot_rows, rows)
    return axis.join(rad, "slice").select("slice", "points", (F.col("h0") + F.col("slice") * step + step / 2).alias("height_center"),
                                          F.col("a_p50").alias("a"), F.col("b_p50").alias("b"), F.col("r_q").alias("radius"))


SLICE_SQL = """s AS (SELECT *, CAST(floor((l_extendedprice-(SELECT min(l_extendedprice) FROM lineitem))/5000.0) AS BIGINT) AS slice FROM lineitem),
m AS (SELECT slice, count(*) AS points, median(l_quantity) AS a, median(l_tax*100) AS b FROM s GROUP BY slice HAVING count(*)>=20),
r AS (SELECT s.slice, quantile_cont(sqrt((l_quantity-a)*(l_quantity-a)+(l_tax*100-b)*(l_tax*100-b)),0.9) AS radius FROM s JOIN m USING (slice) GROUP BY 1),
ax AS (SELECT slice, points, (SELECT min(l_extendedprice) FROM lineitem)+slice*5000.0+2500.0 AS height_center, a, b, radius FROM m JOIN r USING (slice))"""


def _slices(spark, sf):
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", (F.col("l_tax") * 100).alias("t"))
    return slice_profile(li, "l_extendedprice", "l_quantity", "t", 5000.0, 20, 0.9)


@query("slice_profile", f"WITH {SLICE_SQL} SELECT slice, points, round(height_center,4) AS height_center, round(a,6) AS a, round(b,6) AS b, round(radius,6) AS radius FROM ax")
def slice_profile_query(spark, sf):
    s = _slices(spark, sf)
    return s.select("slice", "points", F.round("height_center", 4).alias("height_center"), *[r6(F.col(c)).alias(c) for c in ("a", "b", "radius")])


@query("axis_straightness", f"""WITH {SLICE_SQL}, f AS (SELECT regr_slope(a,height_center) sa, regr_intercept(a,height_center) ia, regr_slope(b,height_center) sb, regr_intercept(b,height_center) ib FROM ax)
SELECT count(*) AS slices, round(max(sqrt(pow(a-sa*height_center-ia,2)+pow(b-sb*height_center-ib,2))),5) AS max_deviation,
 round(sqrt(avg(pow(a-sa*height_center-ia,2)+pow(b-sb*height_center-ib,2))),5) AS rms_deviation, arg_min(a, slice) AS base_a, arg_min(b, slice) AS base_b FROM ax, f""")
def axis_straightness(spark, sf):
    from frondlake.session import durable

    s = durable(_slices(spark, sf))
    f = s.agg(*[g(F.col(c), F.col("height_center")).alias(f"{n}{c}") for c in "ab" for n, g in (("s", F.regr_slope), ("i", F.regr_intercept))])
    j = s.crossJoin(F.broadcast(f))
    res = [F.col(c) - F.col(f"s{c}") * F.col("height_center") - F.col(f"i{c}") for c in "ab"]
    d2 = res[0] * res[0] + res[1] * res[1]
    return j.agg(F.count(F.lit(1)).alias("slices"), F.round(F.max(F.sqrt(d2)), 5).alias("max_deviation"), F.round(F.sqrt(F.avg(d2)), 5).alias("rms_deviation"),
                 F.min_by("a", "slice").alias("base_a"), F.min_by("b", "slice").alias("base_b"))


@query("splat_profile", f"""WITH {SPLAT_SQL}, e AS (SELECT label, 1/(1+exp(-opacity)) AS op, greatest(0,least(1,0.5+0.28209479177387814*f_dc_0)) AS r,
 greatest(0,least(1,0.5+0.28209479177387814*f_dc_1)) AS g, greatest(0,least(1,0.5+0.28209479177387814*f_dc_2)) AS b,
 list_sort([exp(scale_0),exp(scale_1),exp(scale_2)])[2] AS mid FROM splat)
SELECT label, count(*) AS n, count(*) FILTER (WHERE op>0.5) AS kept, round(avg(g-greatest(r,b)),6) AS greenness, round(avg(greatest(r,g,b)-least(r,g,b)),6) AS saturation, round(max(mid),8) AS largest_mid FROM e GROUP BY label""")
def splat_profile(spark, sf):
    s = splats(spark, sf)
    rgb = [C.dc_to_rgb(F.col(f"f_dc_{i}")) for i in range(3)]
    e = s.select("label", C.sigmoid(F.col("opacity")).alias("op"), C.greenness(*rgb).alias("green"), C.saturation(*rgb).alias("sat"),
                 C.middle_size(*[F.col(f"scale_{i}") for i in range(3)]).alias("mid"))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("op") > 0.5).alias("kept"), r6(F.avg("green")).alias("greenness"),
                                  r6(F.avg("sat")).alias("saturation"), F.round(F.max("mid"), 8).alias("largest_mid"))


@query("psnr_by_group", """WITH m AS (SELECT l_returnflag AS split, avg(pow(l_discount-l_tax,2)) AS mse FROM lineitem GROUP BY 1)
SELECT split, round(CASE WHEN mse=0 THEN CAST('Infinity' AS DOUBLE) ELSE -10*log10(mse) END,5) AS psnr FROM m""")
def psnr_by_group(spark, sf):
    d = F.col("l_discount") - F.col("l_tax")
    m = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("split")).agg(F.avg(d * d).alias("mse"))
    return m.select("split", F.round(C.psnr(F.col("mse")), 5).alias("psnr"))


@query("mark_summary", f"""WITH {FRAME_SQL} SELECT event_type, min(value-k) AS low, round(median(value-k),6) AS mid, max(value-k) AS high FROM frm GROUP BY 1""")
def mark_summary(spark, sf):
    f = frames(spark, sf).select("event_type", (F.col("value") - F.col("k")).alias("d"))
    q = O.quantiles(f, ["event_type"], {"d": F.col("d")}, {"mid": 0.5, "low": 0.0, "high": 1.0})
    return q.select("event_type", F.col("d_low").alias("low"), r6(F.col("d_mid")).alias("mid"), F.col("d_high").alias("high"))


@query("iou_histogram", "SELECT CAST(least(floor(l_discount*200),19) AS BIGINT) AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
def iou_histogram(spark, sf):
    b = F.least(F.floor(F.col("l_discount") * 200), F.lit(19)).cast("bigint")
    return table(spark, sf, "lineitem").groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
