"""Text, list, map, JSON and settings queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from frondlake.functions import columns as C
from frondlake.operators import ordered as O
from frondlake.plans.registry import query
from frondlake.session import table


def n_rows(name="n"):
    return F.count(F.lit(1)).alias(name)


@query("slug_ids", "SELECT page_id, trim(regexp_replace(lower(url),'[^a-z0-9]+','-','g'),'-') AS slug FROM pages")
def slug_ids(spark, sf):
    return table(spark, sf, "pages").select("page_id", C.slug(F.col("url")).alias("slug"))


@query("json_props", "SELECT event_id, TRY_CAST(json_extract_string(props,'$.k') AS BIGINT) AS k, json_extract_string(props,'$.rotation') AS rotation FROM events")
def json_props(spark, sf):
    e = table(spark, sf, "events").withColumn("p", F.from_json("props", "k BIGINT, rotation STRING"))
    return e.select("event_id", F.col("p.k").alias("k"), F.col("p.rotation").alias("rotation"))


@query("path_classes", """SELECT CASE WHEN regexp_matches(url,'\\.html?$') THEN 'photograph' WHEN url LIKE '%?%' THEN 'mask' ELSE 'other' END AS kind, starts_with(url,'https://blog.') AS inside, count(*) AS n FROM pages GROUP BY 1,2""")
def path_classes(spark, sf):
    kind = F.when(F.col("url").rlike(r"\.html?$"), "photograph").when(F.contains("url", F.lit("?")), "mask").otherwise("other")
    return table(spark, sf, "pages").groupBy(kind.alias("kind"), F.startswith("url", F.lit("https://blog.")).alias("inside")).agg(n_rows())


@query("safe_names", "SELECT page_id, regexp_matches(regexp_extract(url,'([^/]*)$',1), '^[^./\\\\][^/\\\\]*$') AS safe FROM pages")
def safe_names(spark, sf):
    name = F.regexp_extract("url", "([^/]*)$", 1)
    return table(spark, sf, "pages").select("page_id", C.safe_filename(name).alias("safe"))


@query("size_suffix", "SELECT o_orderkey, CASE o_orderkey%4 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey*1024 WHEN 2 THEN o_custkey*1048576 ELSE NULL END AS bytes FROM orders")
def size_suffix(spark, sf):
    unit = F.get(F.array(F.lit(""), F.lit("K"), F.lit("M"), F.lit("Q")), (F.col("o_orderkey") % 4).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", C.size_bytes(F.concat(F.col("o_custkey").cast("string"), unit)).alias("bytes"))


@query("cpu_sets", "SELECT s_suppkey, array_to_string(list_sort(list_distinct(list_concat(range(s_nationkey, s_nationkey+3), [s_nationkey*2]))),',') AS cpus FROM supplier")
def cpu_sets(spark, sf):
    text = F.format_string("%d-%d,%d", "s_nationkey", F.col("s_nationkey") + 2, F.col("s_nationkey") * 2)
    return table(spark, sf, "supplier").select("s_suppkey", F.array_join(C.cpu_list(text), ",").alias("cpus"))


@query("extension_list", "SELECT p_brand, array_to_string(list_sort(list(DISTINCT '.'||lower(w))),',') AS exts FROM (SELECT p_brand, unnest(string_split(p_name,' ')) AS w FROM part) WHERE w<>'' GROUP BY 1")
def extension_list(spark, sf):
    """Every word of every name as an extension, listed per brand."""
    p = table(spark, sf, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("w")).filter("w <> ''")
    return p.select("p_brand", C.extension(F.col("w")).alias("e")).distinct().groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("e")), ",").alias("exts"))


@query("run_ids", "SELECT o_orderkey, strftime(o_orderdate,'%y%m%d')||'-'||repeat('0', greatest(0, 3 - length(n))) || n AS run_id FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS VARCHAR) AS n FROM orders)")
def run_ids(spark, sf):
    o = O.ordered(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"], ["o_orderkey"], O.Ordered(rank="n"))
    return o.select("o_orderkey", F.concat_ws("-", F.date_format("o_orderdate", "yyMMdd"), C.padded(F.col("n"), 3)).alias("run_id"))


@query("export_names", "SELECT o_orderkey, concat_ws('_', lower(o_orderstatus), CASE WHEN o_custkey%3=0 THEN NULL ELSE 'ds'||o_custkey%8 END, CASE WHEN o_orderpriority LIKE '1%' THEN 'evalall' WHEN o_orderpriority LIKE '2%' THEN 'evalint'||o_custkey%9 ELSE 'evalfrac'||(CASE WHEN o_custkey%2=0 THEN '90' ELSE '87p5' END) END) AS name FROM orders")
def export_names(spark, sf):
    mode = F.when(F.startswith("o_orderpriority", F.lit("1")), "all").when(F.startswith("o_orderpriority", F.lit("2")), "interval").otherwise("fraction")
    token = C.eval_token(mode, F.when(F.col("o_custkey") % 2 == 0, 0.9).otherwise(0.875), F.col("o_custkey") % 9)
    scale = F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("ds"), (F.col("o_custkey") % 8).cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", F.concat_ws("_", F.lower("o_orderstatus"), scale, token).alias("name"))


@query("frame_estimates", "SELECT event_id, CAST(floor((CAST(value AS DECIMAL(18,2))-0.04)/0.25)+1 AS BIGINT) AS frames FROM events")
def frame_estimates(spark, sf):
    v = F.col("value").cast("decimal(18,2)")
    return table(spark, sf, "events").select("event_id", (F.floor((v - F.lit(0.04).cast("decimal(18,2)")) * 4) + 1).cast("bigint").alias("frames"))


@query("preview_plan", "SELECT event_id, step, CAST(floor(value/(step*0.5))+1 AS BIGINT) AS frames FROM events, (SELECT unnest([1,2,4]) AS step)")
def preview_plan(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value", F.explode(F.array(F.lit(1), F.lit(2), F.lit(4))).alias("step"))
    return e.select("event_id", "step", (F.floor(F.col("value") / (F.col("step") * 0.5)) + 1).cast("bigint").alias("frames"))


@query("elapsed_text", "WITH s AS (SELECT event_id, CAST(round(value*30) AS BIGINT) AS s FROM events) SELECT event_id, CASE WHEN s>=3600 THEN printf('%dh%02dm%02ds', s//3600, s%3600//60, s%60) WHEN s>=60 THEN printf('%dm%02ds', s//60, s%60) ELSE printf('%ds', s) END AS elapsed FROM s")
def elapsed_text(spark, sf):
    return table(spark, sf, "events").select("event_id", C.elapsed(F.col("value") * 30).alias("elapsed"))


@query("typed_settings", """SELECT role AS section, count(*) AS n, count(*) FILTER (WHERE w IN ('1','true','yes','on')) AS yes, count(*) FILTER (WHERE w IN ('0','false','no','off')) AS no,
 count(*) FILTER (WHERE regexp_full_match(w,'[0-9]{1,9}')) AS integers, CAST(sum(length(w)) AS BIGINT) AS chars FROM (SELECT role, unnest(string_split(lower(text),' ')) AS w FROM conversations) GROUP BY 1""")
def typed_settings(spark, sf):
    """Every word of every text as the value of a setting, typed."""
    w = table(spark, sf, "conversations").select(F.col("role").alias("section"), F.explode(F.split(F.lower("text"), " ")).alias("w"))
    b = C.truth(F.col("w"))
    return w.groupBy("section").agg(n_rows(), F.count_if(b).alias("yes"), F.count_if(~b).alias("no"),
                                    F.count(F.when(F.col("w").rlike("^[0-9]{1,9}$"), F.col("w").try_cast("int"))).alias("integers"), F.sum(F.length("w")).alias("chars"))


@query("finite_json", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax=0 THEN NULL ELSE round(l_discount/l_tax,6) END AS v FROM lineitem""")
def finite_json(spark, sf):
    v = C.finite_or_null(F.try_divide("l_discount", "l_tax"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(v, 6).alias("v"))


@query("frame_tags", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS tags, count(*) AS n FROM events GROUP BY 1")
def frame_tags(spark, sf):
    # tags come from a small vocabulary and are distinct before they are gathered
    t = table(spark, sf, "events").groupBy("user_id", "event_type").agg(n_rows())
    return t.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("tags"), F.sum("n").alias("n"))


@query("capped_sizes", "SELECT p_partkey, CASE WHEN greatest(p_size*90,p_size*60)>1600 THEN CAST(round(p_size*90*1600.0/greatest(p_size*90,p_size*60)) AS BIGINT) ELSE p_size*90 END AS w, CASE WHEN greatest(p_size*90,p_size*60)>1600 THEN CAST(round(p_size*60*1600.0/greatest(p_size*90,p_size*60)) AS BIGINT) ELSE p_size*60 END AS h FROM part")
def capped_sizes(spark, sf):
    w, h = F.col("p_size") * 90, F.col("p_size") * 60
    big = F.greatest(w, h)
    return table(spark, sf, "part").select("p_partkey", *[F.when(big > 1600, F.round(c * 1600.0 / big)).otherwise(c).cast("bigint").alias(n) for c, n in ((w, "w"), (h, "h"))])


@query("eased_reveal", "WITH t AS (SELECT event_id, greatest(0,least(1,(value/400-0.25)/0.75)) AS t FROM events) SELECT event_id, round(t*t*(3-2*t),6) AS ease FROM t")
def eased_reveal(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(C.smoothstep((F.col("value") / 400 - 0.25) / 0.75), 6).alias("ease"))


@query("key_value_lines", "SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: len(string_split(x,' '))=2)) AS INT) AS pairs FROM documents")
def key_value_lines(spark, sf):
    lines = F.filter(F.split("text", "\n"), lambda l: F.size(F.split(l, " ")) == 2)
    return table(spark, sf, "documents").select("doc_id", F.size(lines).alias("pairs"))


@query("start_problems", "SELECT event_id, array_to_string(list_filter([CASE WHEN value<20 THEN 'ram' END, CASE WHEN CAST(json_extract_string(props,'$.k') AS INT)<10 THEN 'commit' END, CASE WHEN user_id%7=0 THEN 'drive' END], lambda x: x IS NOT NULL),',') AS problems FROM events")
def start_problems(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    checks = F.array(F.when(F.col("value") < 20, F.lit("ram")), F.when(k < 10, F.lit("commit")), F.when(F.col("user_id") % 7 == 0, F.lit("drive")))
    return table(spark, sf, "events").select("event_id", F.array_join(F.array_compact(checks), ",").alias("problems"))


@query("legend_text", "SELECT string_agg(line, chr(10) ORDER BY line) AS legend FROM (SELECT '- region '||label||': '||count(*)||' rows' AS line FROM embeddings GROUP BY label)")
def legend_text(spark, sf):
    # one line per region, gathered after counting
    c = table(spark, sf, "embeddings").groupBy("label").agg(n_rows()).select(F.format_string("- region %d: %d rows", "label", "n").alias("line"))
    return c.agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("legend"))


@query("applied_overrides", "SELECT lang, source, coalesce(CASE WHEN lang='en' THEN 'src-en' END, source) AS effective, count(*) AS n FROM documents GROUP BY 1,2,3")
def applied_overrides(spark, sf):
    base = F.create_map(F.lit("source"), F.col("source"))
    patch = F.when(F.col("lang") == "en", F.create_map(F.lit("source"), F.lit("src-en"))).otherwise(F.create_map().cast("map<string,string>"))
    # the patch wins: keys it names replace the base value
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(patch), k)), patch)
    return table(spark, sf, "documents").groupBy("lang", "source", merged["source"].alias("effective")).agg(n_rows())
