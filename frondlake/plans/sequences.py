"""Ordered queries: sampling, runs, steps, ranks, as-of lookups, rate limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from frondlake.operators import ordered as O
from frondlake.plans.derived import FRAME_SQL, frames
from frondlake.plans.registry import query
from frondlake.session import durable, table


def r6(c):
    return F.round(c, 6)


@query("step_discontinuity", f"""WITH {FRAME_SQL}, s AS (SELECT *, lag(event_id) OVER w AS f, sqrt(pow(value-lag(value) OVER w,2)+pow(k-lag(k) OVER w,2)) AS step FROM frm WINDOW w AS (PARTITION BY clip ORDER BY ts, event_id)),
p AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY step DESC, ts, event_id) AS n FROM s WHERE f IS NOT NULL),
m AS (SELECT clip, count(*) AS steps, median(step) AS med, max(step) AS mx FROM p GROUP BY clip)
SELECT m.clip, steps, round(med,6) AS median_step, round(mx,6) AS largest_step, f AS largest_from, event_id AS largest_to, round(mx/med,5) AS ratio_to_median, mx/med>=10 AS warning FROM m JOIN p ON m.clip=p.clip AND n=1""")
def step_discontinuity(spark, sf):
    s = O.step_discontinuity(frames(spark, sf), ["clip"], ["ts", "event_id"], F.col("event_id"), [F.col("value"), F.col("k")])
    return s.select("clip", "steps", r6(F.col("median_step")).alias("median_step"), r6(F.col("largest_step")).alias("largest_step"),
                    "largest_from", "largest_to", F.round("ratio_to_median", 5).alias("ratio_to_median"), "warning")


@query("every_nth", f"""WITH {FRAME_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY ts, event_id)-1 AS i FROM frm),
x AS (SELECT clip, i FROM n WHERE event_type='error')
SELECT clip, event_id, i AS clip_index FROM n WHERE i>=2 AND (i-2)%5=0 AND event_type<>'error'""")
def every_nth(spark, sf):
    # the sampling phase is fixed before exclusions
    return O.every_nth(frames(spark, sf), ["clip"], ["ts", "event_id"], 5, 2).filter("event_type <> 'error'").select("clip", "event_id", "clip_index")


@query("gaps_islands", f"""WITH {FRAME_SQL}, a AS (SELECT *, sum(CASE WHEN event_type='error' THEN 1 ELSE 0 END) OVER (PARTITION BY clip ORDER BY ts, event_id) AS g FROM frm)
SELECT clip, min(ts) AS range_start, max(ts) AS range_end, count(*) AS base_frames, CAST(sum(CASE WHEN k>=50 THEN 1 ELSE 0 END) AS BIGINT) AS kept FROM a WHERE event_type<>'error' GROUP BY clip, g""")
def gaps_islands(spark, sf):
    return O.islands(frames(spark, sf), ["clip"], ["ts", "event_id"], F.col("event_type") == "error", F.col("k") >= 50)


@query("clip_inventory", f"""WITH {FRAME_SQL} SELECT clip, event_id, row_number() OVER (PARTITION BY clip ORDER BY ts, event_id)-1 AS clip_index, min(event_id) OVER (PARTITION BY clip) AS clip_first FROM frm""")
def clip_inventory(spark, sf):
    o = O.ordered(frames(spark, sf), ["clip"], ["ts", "event_id"], O.Ordered(rank="rn"))
    first = frames(spark, sf).groupBy("clip").agg(F.min("event_id").alias("clip_first"))
    return O.attach(o, first, ["clip"], "inner").select("clip", "event_id", (F.col("rn") - 1).alias("clip_index"), "clip_first")


@query("moving_avg_edge", f"""WITH {FRAME_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY clip) AS c FROM frm),
o AS (SELECT n.clip, n.event_id, greatest(1, least(c, i+d)) AS j FROM n, range(-3,4) t(d))
SELECT o.clip, o.event_id, round(avg(m.value),6) AS value, round(avg(m.k),6) AS k FROM o JOIN n m ON o.clip=m.clip AND m.i=o.j GROUP BY 1,2""")
def moving_avg_edge(spark, sf):
    m = O.moving_average(frames(spark, sf), ["clip"], ["ts", "event_id"], {"value": F.col("value"), "k": F.col("k")}, 7)
    return m.select("clip", "event_id", r6(F.col("value")).alias("value"), r6(F.col("k")).alias("k"))


@query("catmull_path", f"""WITH {FRAME_SQL}, n AS (SELECT clip, value, k, row_number() OVER (PARTITION BY clip ORDER BY ts, event_id)-1 AS i, count(*) OVER (PARTITION BY clip) AS c FROM frm),
g AS (SELECT clip, c, f, f*(c-1)/23.0 AS t FROM (SELECT DISTINCT clip, c FROM n), range(0,24) r(f)), h AS (SELECT *, CASE WHEN f=23 THEN c-1 ELSE CAST(floor(t) AS BIGINT) END AS i FROM g),
q AS (SELECT h.clip, h.f, CASE WHEN h.f=23 THEN 0 ELSE t-h.i END AS u, p0.value a, p1.value b, p2.value d, p3.value e, p0.k ka, p1.k kb, p2.k kd, p3.k ke FROM h
 JOIN n p0 ON p0.clip=h.clip AND p0.i=greatest(h.i-1,0) JOIN n p1 ON p1.clip=h.clip AND p1.i=h.i JOIN n p2 ON p2.clip=h.clip AND p2.i=least(h.i+1,h.c-1) JOIN n p3 ON p3.clip=h.clip AND p3.i=least(h.i+2,h.c-1))
SELECT clip, CAST(f AS INT) AS frame, round(0.5*(2*b+(d-a)*u+(2*a-5*b+4*d-e)*u*u+(3*b-a-3*d+e)*u*u*u),5) AS value, round(0.5*(2*kb+(kd-ka)*u+(2*ka-5*kb+4*kd-ke)*u*u+(3*kb-ka-3*kd+ke)*u*u*u),5) AS k FROM q""")
def catmull_path(spark, sf):
    c = O.catmull_rom(frames(spark, sf), ["clip"], ["ts", "event_id"], ["value", "k"], 24)
    return c.select("clip", "frame", F.round("value", 5).alias("value"), F.round("k", 5).alias("k"))


@query("cumulative_arc", f"""WITH {FRAME_SQL}, s AS (SELECT *, coalesce(sqrt(pow(value-lag(value) OVER w,2)+pow(k-lag(k) OVER w,2)),0) AS st FROM frm WINDOW w AS (PARTITION BY clip ORDER BY ts, event_id))
SELECT clip, event_id, round(sum(st) OVER (PARTITION BY clip ORDER BY ts, event_id),5) AS arc_length FROM s""")
def cumulative_arc(spark, sf):
    a = O.cumulative_arc(frames(spark, sf), ["clip"], ["ts", "event_id"], [F.col("value"), F.col("k")])
    return a.select("clip", "event_id", F.round("arc_length", 5).alias("arc_length"))


@query("route_arc", "WITH d AS (SELECT o_orderdate AS day, round(sum(o_totalprice),2) AS v FROM orders GROUP BY 1) SELECT day, round(sum(abs(v-l)) OVER (ORDER BY day),2) AS arc_length FROM (SELECT day, v, coalesce(lag(v) OVER (ORDER BY day),v) AS l FROM d)")
def route_arc(spark, sf):
    d = table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return O.cumulative_arc(d, [], ["day"], [F.col("v")]).select("day", F.round("arc_length", 2).alias("arc_length"))


@query("tolerance_rank", """SELECT o_orderkey, 1+(SELECT count(*) FROM orders p WHERE p.o_orderpriority=o.o_orderpriority AND p.o_totalprice > o.o_totalprice + 1000.0) AS tolerance_rank FROM orders o""")
def tolerance_rank(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return O.tolerance_rank(o, ["o_orderpriority"], "o_totalprice", 1000.0).select("o_orderkey", "tolerance_rank")


@query("extrema_agreement", """WITH a AS (SELECT user_id, event_type, max(value) AS v, count(*) AS n, sum(value) AS s FROM events GROUP BY 1,2),
r AS (SELECT user_id, event_type, 1+(SELECT count(*) FROM a b WHERE b.user_id=a.user_id AND b.v>a.v+0.5) AS rv, 1+(SELECT count(*) FROM a b WHERE b.user_id=a.user_id AND b.n>a.n+0.5) AS rn, 1+(SELECT count(*) FROM a b WHERE b.user_id=a.user_id AND b.s>a.s+0.5) AS rs FROM a)
SELECT user_id, CASE WHEN count(*) FILTER (WHERE rv=1)=1 AND count(*) FILTER (WHERE rn=1)=1 AND count(*) FILTER (WHERE rs=1)=1 AND count(*) FILTER (WHERE rv=1 AND rn=1 AND rs=1)=1 THEN min(event_type) FILTER (WHERE rv=1) END AS selected FROM r GROUP BY 1""")
def extrema_agreement(spark, sf):
    a = table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.max("value").alias("v"), F.count(F.lit(1)).cast("double").alias("n"), F.sum("value").alias("s"))
    for c in "vns":
        a = O.tolerance_rank(a, ["user_id"], c, 0.5, f"r{c}")
    tops = [F.count_if(F.col(f"r{c}") == 1) == 1 for c in "vns"]
    same = F.count_if((F.col("rv") == 1) & (F.col("rn") == 1) & (F.col("rs") == 1)) == 1
    return a.groupBy("user_id").agg(F.when(tops[0] & tops[1] & tops[2] & same, F.min(F.when(F.col("rv") == 1, F.col("event_type")))).alias("selected"))


@query("interval_lead", "SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER w AS next_order, date_diff('day', o_orderdate, lead(o_orderdate) OVER w) AS gap_days FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def interval_lead(spark, sf):
    o = O.ordered(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                  O.Ordered(leads={"next_order": F.col("o_orderkey"), "nd": F.col("o_orderdate")}))
    return o.select("o_custkey", "o_orderkey", "next_order", F.datediff("nd", "o_orderdate").cast("bigint").alias("gap_days"))


@query("weighted_median", """WITH g AS (SELECT l_linestatus, l_extendedprice AS v, sum(l_quantity) AS w FROM lineitem GROUP BY 1,2),
c AS (SELECT *, sum(w) OVER (PARTITION BY l_linestatus ORDER BY v) AS c, sum(w) OVER (PARTITION BY l_linestatus) AS t, lead(v) OVER (PARTITION BY l_linestatus ORDER BY v) AS nx FROM g)
SELECT l_linestatus, round(arg_min(CASE WHEN c=t/2 AND nx IS NOT NULL THEN (v+nx)/2 ELSE v END, v),6) AS weighted_median FROM c WHERE c>=t/2 GROUP BY 1""")
def weighted_median(spark, sf):
    m = O.weighted_median(table(spark, sf, "lineitem"), ["l_linestatus"], F.col("l_extendedprice"), F.col("l_quantity"))
    return m.select("l_linestatus", r6(F.col("weighted_median")).alias("weighted_median"))


@query("scale_estimate", """WITH p AS (SELECT l_returnflag, l_extendedprice/l_quantity AS e, l_quantity AS w FROM lineitem), g AS (SELECT l_returnflag, e, sum(w) AS w FROM p GROUP BY 1,2),
c AS (SELECT *, sum(w) OVER x AS c, sum(w) OVER (PARTITION BY l_returnflag) AS t, lead(e) OVER x AS nx FROM g WINDOW x AS (PARTITION BY l_returnflag ORDER BY e)),
m AS (SELECT l_returnflag, arg_min(CASE WHEN c=t/2 AND nx IS NOT NULL THEN (e+nx)/2 ELSE e END, e) AS m FROM c WHERE c>=t/2 GROUP BY 1),
g2 AS (SELECT l_returnflag, abs(e-m) AS d, sum(w) AS w FROM g JOIN m USING (l_returnflag) GROUP BY 1,2),
c2 AS (SELECT *, sum(w) OVER x AS c, sum(w) OVER (PARTITION BY l_returnflag) AS t, lead(d) OVER x AS nx FROM g2 WINDOW x AS (PARTITION BY l_returnflag ORDER BY d))
SELECT l_returnflag, round(any_value(m),6) AS scale, round(1.4826*arg_min(CASE WHEN c=t/2 AND nx IS NOT NULL THEN (d+nx)/2 ELSE d END, d),5) AS spread FROM c2 JOIN m USING (l_returnflag) WHERE c>=t/2 GROUP BY 1""")
def scale_estimate(spark, sf):
    p = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("e"), F.col("l_quantity").alias("w"))
    m = durable(O.weighted_median(p, ["l_returnflag"], F.col("e"), F.col("w"), "m"))
    away = O.attach(p, m, ["l_returnflag"], "inner")
    d = O.weighted_median(away, ["l_returnflag"], F.abs(F.col("e") - F.col("m")), F.col("w"), "d")
    return m.join(d, "l_returnflag").select("l_returnflag", r6(F.col("m")).alias("scale"), F.round(1.4826 * F.col("d"), 5).alias("spread"))


@query("asof_price", """WITH o AS (SELECT date_trunc('day', ts) - INTERVAL 8 YEAR + to_days(CAST(user_id*7 AS INT)) AS at, event_id FROM events), d AS (SELECT o_orderdate AS at, max(o_totalprice) AS price FROM orders GROUP BY 1)
SELECT o.event_id, round(d.price,2) AS price FROM o ASOF LEFT JOIN d ON o.at >= d.at""")
def asof_price(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.date_trunc("day", "ts") - F.expr("INTERVAL 8 YEARS")
                                                       + F.make_interval(days=(F.col("user_id") * 7).cast("int"))).alias("at"))
    d = table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("at")).agg(F.max("o_totalprice").alias("price"))
    return O.asof(e, d, [], "at", ["price"]).select("event_id", F.round("prev_price", 2).alias("price"))


@query("axis_interpolate", """WITH ax AS (SELECT CAST(p_size AS DOUBLE)*40 AS h, avg(p_retailprice) AS v FROM part GROUP BY 1), q AS (SELECT event_id, value*5 AS h FROM events),
b AS (SELECT q.*, (SELECT max(h) FROM ax WHERE ax.h<=q.h) AS lo, (SELECT min(h) FROM ax WHERE ax.h>=q.h) AS hi FROM q)
SELECT event_id, round(CASE WHEN lo IS NULL THEN c.v WHEN hi IS NULL OR hi=lo THEN a.v ELSE a.v+(c.v-a.v)*(b.h-lo)/(hi-lo) END,6) AS v, CASE WHEN lo IS NULL OR hi IS NULL THEN 'nearest_slice' WHEN lo=hi THEN 'exact' ELSE 'interpolated' END AS lookup
FROM b LEFT JOIN ax a ON a.h=lo LEFT JOIN ax c ON c.h=hi""")
def axis_interpolate(spark, sf):
    ax = table(spark, sf, "part").groupBy((F.col("p_size").cast("double") * 40).alias("h")).agg(F.avg("p_retailprice").alias("v"))
    q = table(spark, sf, "events").select("event_id", (F.col("value") * 5).alias("h"))
    return O.interpolate(q, ax, [], "h", ["v"]).select("event_id", r6(F.col("v")).alias("v"), "lookup")


@query("latest_per_key", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n=1")
def latest_per_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


LADDER = ("signup", "view", "click", "purchase", "error")  # fixed values, first step first


@query("milestone_ladder", """WITH p AS (SELECT user_id, list_position(['signup','view','click','purchase','error'], event_type) AS p, ts FROM events)
SELECT user_id, ['signup','view','click','purchase','error'][max(p)] AS milestone, CAST(max(p) AS INT) AS step, arg_min(ts, (-p, ts)) AS reached FROM p GROUP BY 1""")
def milestone_ladder(spark, sf):
    steps = F.array(*[F.lit(s) for s in LADDER])
    p = table(spark, sf, "events").select("user_id", F.array_position(steps, F.col("event_type")).cast("int").alias("p"), "ts")
    return p.groupBy("user_id").agg(F.element_at(steps, F.max("p")).alias("milestone"), F.max("p").alias("step"), F.min_by("ts", F.struct(-F.col("p"), "ts")).alias("reached"))


@query("latest_completed", """WITH o AS (SELECT *, o_orderstatus='F' AND o_totalprice>=50000 AS ok, CASE WHEN o_orderstatus<>'F' THEN 'status '||o_orderstatus WHEN o_totalprice<50000 THEN 'too small' END AS why FROM orders)
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate,o_orderkey)) FILTER (WHERE ok) AS completed, CASE WHEN count(*) FILTER (WHERE ok)=0 THEN arg_max(why, (o_orderdate,o_orderkey)) END AS reason FROM o GROUP BY 1""")
def latest_completed(spark, sf):
    ok = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 50000)
    why = F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("status "), "o_orderstatus")).when(F.col("o_totalprice") < 50000, "too small")
    at = F.struct("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max_by("o_orderkey", F.when(ok, at)).alias("completed"), F.when(F.count_if(ok) == 0, F.max_by(why, at)).alias("reason"))


@query("id_runs", """WITH d AS (SELECT DISTINCT l_returnflag AS g, l_partkey AS v FROM lineitem), n AS (SELECT *, v-row_number() OVER (PARTITION BY g ORDER BY v) AS r FROM d)
SELECT g, min(v) AS low, max(v) AS high, CASE WHEN min(v)=max(v) THEN CAST(min(v) AS VARCHAR) ELSE min(v)||'-'||max(v) END AS run FROM n GROUP BY g, r""")
def id_runs(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_partkey").alias("v")).distinct()
    n = O.ordered(d, ["g"], ["v"], O.Ordered(rank="rn")).withColumn("r", F.col("v") - F.col("rn"))
    g = n.groupBy("g", "r").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return g.select("g", "low", "high", F.when(F.col("low") == F.col("high"), F.col("low").cast("string")).otherwise(F.concat_ws("-", "low", "high")).alias("run"))


@query("checkpoint_select", """WITH c AS (SELECT l_suppkey AS run, l_partkey AS step, max(l_partkey) OVER (PARTITION BY l_suppkey) AS last FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))
SELECT run, step, CASE WHEN step=last AND step+1=2000 THEN 2000 ELSE step END AS steps_label FROM c WHERE (step>0 AND step%100=0) OR step=last""")
def checkpoint_select(spark, sf):
    c = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("run"), F.col("l_partkey").alias("step")).distinct()
    last = c.groupBy("run").agg(F.max("step").alias("last"))
    keep = ((F.col("step") > 0) & (F.col("step") % 100 == 0)) | (F.col("step") == F.col("last"))
    label = F.when((F.col("step") == F.col("last")) & (F.col("step") + 1 == 2000), F.lit(2000)).otherwise(F.col("step"))
    return c.join(last, "run").filter(keep).select("run", "step", label.alias("steps_label"))


@query("even_sample", """WITH n AS (SELECT l_returnflag AS g, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)-1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS c FROM lineitem),
s AS (SELECT DISTINCT g, CAST(floor(t*(c-1)/299.0) AS BIGINT) AS i FROM (SELECT DISTINCT g, c FROM n), range(0,300) r(t))
SELECT g, n.i AS pos, l_orderkey, l_partkey FROM n JOIN s USING (g, i)""")
def even_sample(spark, sf):
    n = O.ordered(table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "g"), ["g"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
                  O.Ordered(rank="rn", totals={"c": F.lit(1)}))
    i, m = F.col("rn") - 1, F.lit(299.0)
    # row i is sampled when some t in 0..299 has floor(t * (c - 1) / 299) = i
    t = F.ceil(i * m / (F.col("c") - 1))
    hit = F.when(F.col("c") == 1, True).otherwise((t <= 299) & (F.floor(t * (F.col("c") - 1) / m) == i))
    return n.filter(hit).select("g", i.alias("pos"), "l_orderkey", "l_partkey")


@query("stage_durations", """WITH s AS (SELECT user_id, ts AS started, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ended, event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events WHERE event_type IN ('click','purchase'))
SELECT user_id, started, ended, date_diff('second', date_trunc('second',started), date_trunc('second',ended)) AS seconds FROM s WHERE a='click' AND b='purchase'""")
def stage_durations(spark, sf):
    e = table(spark, sf, "events").filter(F.col("event_type").isin("click", "purchase"))
    s = O.ordered(e, ["user_id"], ["ts", "event_id"], O.Ordered(leads={"ended": F.col("ts"), "b": F.col("event_type")}))
    return s.filter("event_type = 'click' and b = 'purchase'").select("user_id", F.col("ts").alias("started"), "ended",
                                                                     (F.unix_seconds(F.col("ended").cast("timestamp")) - F.unix_seconds(F.col("ts").cast("timestamp"))).alias("seconds"))


@query("host_guard_replay", """WITH RECURSIVE s AS (SELECT user_id, event_id, CAST(epoch_us(ts) AS DOUBLE)/1e6 AS t, value FROM events WHERE event_type<>'error'),
c AS (SELECT * FROM s WHERE value>=5 AND value<120), k AS (SELECT user_id, min(t) AS t FROM c GROUP BY 1 UNION ALL
 SELECT k.user_id, (SELECT min(t) FROM c WHERE c.user_id=k.user_id AND c.t>=k.t+86400) FROM k WHERE k.t IS NOT NULL)
SELECT e.user_id, e.event_id, CASE WHEN e.event_type='error' THEN 'probe_failed' WHEN e.value<5 THEN 'stop' WHEN k.t IS NOT NULL THEN 'release' ELSE 'none' END AS action
FROM events e LEFT JOIN k ON k.user_id=e.user_id AND k.t=CAST(epoch_us(e.ts) AS DOUBLE)/1e6 AND e.event_type<>'error' AND e.value>=5 AND e.value<120""")
def host_guard_replay(spark, sf):
    """Stop beats release; a release happens at most once per period; a failed probe changes nothing."""
    e = table(spark, sf, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    relief = e.filter("event_type <> 'error' and value >= 5 and value < 120").select("user_id", "t")
    kept = O.pair_period(relief, ["user_id"], "t", 86400.0).withColumn("hit", F.lit(True))
    j = O.attach(e, kept, ["user_id", "t"], "left")
    act = F.when(F.col("event_type") == "error", "probe_failed").when(F.col("value") < 5, "stop") \
        .when(F.col("hit") & (F.col("value") < 120), "release").otherwise("none")
    return j.select("user_id", "event_id", act.alias("action"))
