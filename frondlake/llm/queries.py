"""Registered queries of the operators and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frondlake.llm import jaccard, licences, middle, mixing, nearest, packing, repeats, sharding, sketches, topk, toxicity, trie, warc
from frondlake.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if sql:
            ORACLES[name] = sql
        return plan

    return add


#: fixed values: the references that the given pages may hold, for this equivalent only; others are checked in tests
_SQL_NAMES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "''", "nbsp": " ", "copy": "©", "reg": "®", "middot": "·",
              "ndash": "–", "mdash": "—", "hellip": "…", "eacute": "é", "rsquo": "’"}


def _sql_unescape(c: str) -> str:
    """References are cut out in order of appearance, and what lies between them copied."""
    pattern = "&(?:" + "|".join(_SQL_NAMES) + ");"
    cases = " ".join(f"WHEN '&{n};' THEN '{ch}'" for n, ch in _SQL_NAMES.items())
    return (f"array_to_string(list_transform(list_zip(regexp_split_to_array({c}, '{pattern}'), list_concat(regexp_extract_all({c}, '{pattern}'), [''])), "
            f"lambda z: z[1] || CASE z[2] {cases} ELSE '' END), '')")


def _sql_hidden(c: str, *forms: tuple[str, str]) -> str:
    for opening, closing in forms:
        c = f"regexp_replace({c}, '(?is){opening}.*?(?:{closing}|\\z)', ' ', 'g')"
    return c


def _sql_plain(c: str) -> str:
    blocks = "p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|footer|header|main|body|head|html"
    c = _sql_hidden(c, ("<title[^<>]*>", "</title\\s*>"))
    c = f"regexp_replace(regexp_replace({c}, '(?i)</?(?:{blocks})(?:[ \\t\\r\\n/][^>]*)?>', chr(10), 'g'), '<[a-zA-Z/!?][^>]*>', '', 'g')"
    c = f"regexp_replace({_sql_unescape(c)}, '[ \\t\\r]+', ' ', 'g')"
    return f"trim(regexp_replace({c}, ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"


def _sql_attribute(tag: str, name: str) -> str:
    raw = f"""regexp_extract({tag}, '(?i)\\s{name}\\s*=\\s*("[^"]*"|\\x27[^\\x27]*\\x27|[^\\s"\\x27>]+)', 1)"""
    return _sql_unescape(f"""regexp_replace({raw}, '^["\\x27]|["\\x27]$', '', 'g')""")


def _sql_id(kind: str, c: str) -> str:
    d = f"md5('{kind}|' || {c})"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({d}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


WARC_SQL = f"""WITH r AS (SELECT page_id, url AS uri, coalesce(html, '') AS body,
 {_sql_id("response", "coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '') || '|' || md5(coalesce(html, ''))")} AS refers_to,
 lower(regexp_extract(coalesce(html, ''), '(?i)<meta [^>]*charset="?([A-Za-z0-9_-]+)', 1)) AS cs FROM pages),
h AS (SELECT *, 'Content-Type: text/html' || CASE WHEN cs <> '' THEN '; charset=' || cs ELSE '' END || chr(13) || chr(10)
 || 'Content-Length: ' || CAST(strlen(body) AS VARCHAR) AS source_headers, 'sha256:' || sha256(body) AS source_payload_digest,
 {_sql_id("metadata", "refers_to")} AS meta_id, {_sql_id("conversion", "refers_to")} AS conv_id FROM r),
m AS (SELECT *, {_sql_hidden("body", ("<!--", "-->"), ("<script[^<>]*>", "</script\\s*>"), ("<style[^<>]*>", "</style\\s*>"))} AS clean FROM h),
n AS (SELECT *, list_filter(list_transform(regexp_extract_all(clean, '(?i)<a\\s[^>]*>'), lambda t: CASE WHEN regexp_matches(t, '(?i)\\shref\\s*=\\s*[^\\s>]') THEN
 chr(13) || chr(10) || 'outlink: ' || {_sql_attribute("t", "href")} END), lambda u: u IS NOT NULL) AS links FROM m),
b AS (SELECT *, {_sql_plain("clean")} AS plain,
 'title: ' || trim(regexp_replace({_sql_unescape("regexp_extract(clean, '(?is)<title[^<>]*>(.*?)</title', 1)")}, '[ \\t\\r\\n]+', ' ', 'g'))
 || chr(13) || chr(10) || 'language: ' || {_sql_attribute("regexp_extract(clean, '(?i)<html[^>]*>')", "lang")}
 || chr(13) || chr(10) || 'conversion: ' || conv_id
 || chr(13) || chr(10) || 'source-header: ' || replace(source_headers, chr(13) || chr(10), chr(13) || chr(10) || 'source-header: ')
 || array_to_string(links, '') || chr(13) || chr(10) AS fields FROM n)
SELECT page_id, refers_to, uri AS refers_to_target_uri, source_headers, source_payload_digest, 'metadata' AS record_type, meta_id AS record_id,
 conv_id AS concurrent_to, 'application/warc-fields' AS content_type, CAST(strlen(fields) AS BIGINT) AS content_length,
 'sha256:' || sha256(fields) AS block_digest, fields AS block FROM b
UNION ALL SELECT page_id, refers_to, uri, source_headers, source_payload_digest, 'conversion', conv_id, meta_id, 'text/plain; charset=utf-8',
 CAST(strlen(plain) AS BIGINT), 'sha256:' || sha256(plain), plain FROM b"""


@query("op2_warc_derivatives", WARC_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return warc.page_derivatives(table(spark, sf, "pages"))


@query("op8_exact_topk", """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
 FROM v q JOIN v c ON c.r <> q.r AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return topk.exact_topk(e, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 50 == 0, 5)


@query("op9_shards")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"))


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.removal_digest(table(spark, sf, "documents"))


@query("op4_jaccard_join")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf, "documents")).drop("class_key", "row_key")


@query("op4_jaccard_links")
def op4_links(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_links(table(spark, sf, "documents"))


@query("op1_license_scan")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return licences.licence_digest(table(spark, sf, "documents"))


@query("op3_mix_sources")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix_corpus(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_fingerprints")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    out = sketches.version_fingerprints(table(spark, sf, "documents"))
    return out.withColumn("n_before", F.size("only_before").cast("long")).withColumn("n_after", F.size("only_after").cast("long")) \
        .drop("only_before", "only_after")


_CRC_TABLE = ("list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]), "
              "lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))")


def _sql_crc32(c: str) -> str:
    """crc32 of the ASCII text c; ``crc`` is the table of the 256 byte values."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({c}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
            "lambda a, b: xor(a // 256, crc[CAST(xor(a % 256, b) AS INTEGER) + 1])), 4294967295)")


@query("op11_conversation_trie", f"""WITH t AS (SELECT {_CRC_TABLE} AS crc),
c AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS txt
 FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 100 AS base, {_sql_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM c), t),
r AS (SELECT k.c, pos, 0 AS part, role, txt FROM k JOIN c ON c.c = k.base AND pos <= h UNION ALL
 SELECT k.c, pos, 1, role, txt FROM k JOIN c ON c.c = k.c AND pos > h),
d AS (SELECT c, length(txt) AS chars, row_number() OVER w AS depth, string_agg(md5(length(role) || ':' || role || txt), '') OVER w AS path FROM r
 WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
m AS (SELECT c, depth, path, chars FROM d UNION ALL SELECT c, 0, '', 0 FROM k),
n AS (SELECT path, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM m GROUP BY 1),
l AS (SELECT c, max_by(path, depth) AS path FROM m GROUP BY 1),
e AS (SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM l GROUP BY 1),
p AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND starts_with(x.path, n.path)) AS n_children
 FROM n LEFT JOIN n p ON n.depth > 0 AND p.path = substr(n.path, 1, length(n.path) - 32)),
s AS (SELECT a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, CAST(sum((b.n_convs - 1) * b.chars) AS BIGINT) AS saved_tokens
 FROM p a JOIN p b ON starts_with(b.path, a.path) GROUP BY 1)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM p JOIN s USING (path) LEFT JOIN e USING (path)""")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf, "conversations"))


def _sql_draw(j: int) -> str:
    return f"CAST('0x' || substr(digest, {8 * j - 7}, 8) AS BIGINT)"


@query("op12_fill_in_middle", f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines, {", ".join(f"{_sql_draw(j)} AS h{j}" for j in (1, 2, 3, 4))} FROM d),
n AS (SELECT *, CAST(len(lines) AS BIGINT) AS n FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(lines[1:lo], '') AS pre, array_to_string(lines[lo + 1:hi], '') AS mid, array_to_string(lines[hi + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
 sha256(t) AS restored_sha256 FROM p""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return middle.fill_in_middle(table(spark, sf, "documents"), output=False)


@query("op13_one_bit_neighbours", """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(c.e, q.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
 FROM v q JOIN v c ON c.r <> q.r AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 10""")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.nearest(table(spark, sf, "embeddings"), F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 100 == 0, 10)
