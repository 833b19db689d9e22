"""Queries over pages: cleaning, offsets, metrics, routing, budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import pages as P
from lexmill.plans.registry import query, table

#: A document is a source, its pages are the source's texts by id.
PAGES_SQL = "pages_ AS (SELECT source AS doc_id, doc_id AS page_num, text FROM documents)"
LINES_SQL = r"""lines_ AS (
    SELECT doc_id, page_num, text, CASE WHEN ls[len(ls)] = '' THEN ls[1:len(ls) - 1] ELSE ls END AS ls
    FROM (SELECT *, regexp_split_to_array(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]') AS ls FROM pages_))"""
STRIP = r"regexp_replace({}, '^[\s\pZ\x0B\x1C-\x1F\x{{85}}]+|[\s\pZ\x0B\x1C-\x1F\x{{85}}]+$', '', 'g')"


def strip_sql(x: str) -> str:
    return STRIP.format(x)


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page_num"), "text")


CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    coalesce(text, ''), '\r\n?', E'\n', 'g'), '([\p{L}\p{N}_])-\n([a-zA-Z])', '\1\2', 'g'), '([\p{L}\p{N}_])-\n([a-zA-Z])', '\1\2', 'g'),
    '[ \t]{2,}', ' ', 'g'), '(?m)[ \t]+$', '', 'g'), '\n{3,}', E'\n\n', 'g'), '^\n+|\n+$', '', 'g')"""


@query(f"SELECT doc_id, md5({CLEAN_SQL}) AS clean_md5, length({CLEAN_SQL}) AS n_clean FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", T.clean_block(F.col("text")).alias("t"))
    return own.select("doc_id", F.md5("t").alias("clean_md5"), F.length("t").cast("long").alias("n_clean"))


EDGE_SQL = rf"""WITH {PAGES_SQL}, {LINES_SQL},
    norm AS (SELECT doc_id, page_num, ls, list_transform(ls, lambda x: lower({strip_sql('x')})) AS nl FROM lines_),
    filled AS (SELECT doc_id, page_num, list_filter(nl, lambda x: x <> '') AS f FROM norm),
    sides AS (SELECT doc_id, 'top' AS side, f[1] AS line FROM filled UNION ALL SELECT doc_id, 'end', f[len(f)] FROM filled),
    total AS (SELECT doc_id, greatest(2, ceil(count(*) * 0.6::DOUBLE)) AS least FROM pages_ GROUP BY doc_id),
    often AS (SELECT doc_id, side, line FROM sides JOIN total USING (doc_id) WHERE line IS NOT NULL
              GROUP BY doc_id, side, line HAVING count(*) >= max(least)),
    edges AS (SELECT doc_id, coalesce(list(line) FILTER (side = 'top'), []) AS h, coalesce(list(line) FILTER (side = 'end'), []) AS f FROM often GROUP BY doc_id),
    withe AS (SELECT n.*, coalesce(h, []::VARCHAR[]) AS h, coalesce(e.f, []::VARCHAR[]) AS f FROM norm n LEFT JOIN edges e USING (doc_id)),
    tops AS (SELECT *, coalesce(list_min(list_filter(range(1, len(nl) + 1), lambda i: nl[i] = '' OR NOT list_contains(h, nl[i]))) - 1, len(nl)) AS t FROM withe),
    ends AS (SELECT *, coalesce(list_max(list_filter(range(t + 1, len(nl) + 1), lambda i: nl[i] = '' OR NOT list_contains(f, nl[i]))), t) AS e FROM tops)
    SELECT page_num, t AS n_top, len(ls) - e AS n_end, md5(array_to_string(ls[t + 1:e], chr(10))) AS text_md5 FROM ends"""


@query(EDGE_SQL)
def header_footer_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = doc_pages(spark, sf_dir)
    after = P.strip_edges(own.withColumn("before", F.col("text")))
    top = P.edge_lines(own)
    rows = after.join(top, "doc_id", "left")
    norm = F.transform(T.lines(F.col("before")), lambda x: F.lower(T.strip(x)))
    none = F.array().cast("array<string>")
    n_top = F.aggregate(norm, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, x: F.struct((a["n"] + F.when(a["on"] & (x != "") & F.array_contains(F.coalesce("headers", none), x), 1).otherwise(0)).alias("n"), (a["on"] & (x != "") & F.array_contains(F.coalesce("headers", none), x)).alias("on")), lambda a: a["n"])
    kept = F.when(F.col("text") == "", F.when(F.size(norm) > 0, F.lit(None).cast("int")).otherwise(0)).otherwise(F.size(F.split("text", "\n", -1)))
    out = rows.select("page_num", n_top.cast("long").alias("n_top"), F.size(norm).alias("n"), kept.alias("kept"), F.md5("text").alias("text_md5"))
    return out.select("page_num", "n_top", (F.col("n") - F.col("n_top") - F.coalesce("kept", F.lit(0))).cast("long").alias("n_end"), "text_md5")


@query(f"""WITH {PAGES_SQL} SELECT doc_id, page_num,
    coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start,
    sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page_num)::BIGINT AS char_end FROM pages_""")
def page_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_offsets(doc_pages(spark, sf_dir)).select("doc_id", "page_num", "char_start", "char_end")


@query(f"""WITH {PAGES_SQL} SELECT doc_id, count(*) AS total_pages, sum(length(text))::BIGINT AS total_chars, round(avg(length(text)), 6) AS avg_chars,
    median(length(text))::DOUBLE AS median_chars, round(avg(CASE WHEN length(text) < 200 THEN 1.0::DOUBLE ELSE 0 END), 6) AS empty_page_ratio FROM pages_ GROUP BY doc_id""")
def density_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.density(doc_pages(spark, sf_dir)).withColumn("avg_chars", F.round("avg_chars", 6)).withColumn("empty_page_ratio", F.round("empty_page_ratio", 6))


LAYOUT_SQL = rf"""WITH {PAGES_SQL}, {LINES_SQL}, each_ AS (SELECT doc_id, unnest(ls) AS line FROM lines_),
    m AS (SELECT doc_id, length(line) AS n, length({strip_sql('line')}) AS s, length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) AS letters FROM each_),
    r AS (SELECT doc_id, avg((s < 40)::INT) AS a, avg((s = 0)::INT) AS b, avg((n > 0 AND (n - letters)::DOUBLE / greatest(n, 1) >= 0.6::DOUBLE)::INT) AS c FROM m GROUP BY doc_id)
    SELECT doc_id, round(a, 6) AS short_line_ratio, round(b, 6) AS gap_line_ratio, round(c, 6) AS digit_symbol_ratio,
    round(0.4::DOUBLE * a + 0.3::DOUBLE * b + 0.3::DOUBLE * c, 6) AS layout_complexity FROM r"""


@query(LAYOUT_SQL)
def layout_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = P.layout(doc_pages(spark, sf_dir))
    return own.select("doc_id", *[F.round(c, 6).alias(c) for c in own.columns[1:]])


@query(f"""WITH {PAGES_SQL}, b AS (SELECT doc_id, (length(text) // 200) * 200 AS low, count(*) AS n FROM pages_ GROUP BY ALL)
    SELECT doc_id, 'char_hist_' || low || '_' || (low + 200) AS bin, round(n / sum(n) OVER (PARTITION BY doc_id), 6) AS share FROM b""")
def char_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.histogram(doc_pages(spark, sf_dir)).withColumn("share", F.round("share", 6))


@query(f"""WITH {PAGES_SQL}, d AS (SELECT doc_id, count(*) AS p, sum(length(text)) AS c FROM pages_ GROUP BY doc_id)
    SELECT count(*) AS total_docs, sum(p)::BIGINT AS total_pages, sum(c)::BIGINT AS total_chars, round(avg(p), 6) AS avg_pages_per_doc FROM d""")
def doc_stats_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.merge_stats(P.density(doc_pages(spark, sf_dir))).withColumn("avg_pages_per_doc", F.round("avg_pages_per_doc", 6))


@query(rf"""WITH {PAGES_SQL}, d AS (SELECT doc_id, count(*) AS p, avg((length(text) < 900)::INT) AS e FROM pages_ GROUP BY doc_id)
    SELECT doc_id, CASE WHEN p = 0 THEN 'no_text_extracted' WHEN e >= 0.3::DOUBLE THEN 'empty_ratio' WHEN layout_complexity >= 0.6::DOUBLE THEN 'layout_complexity' END AS fallback_reason
    FROM d JOIN ({LAYOUT_SQL}) USING (doc_id)""")
def fallback_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = doc_pages(spark, sf_dir)
    both = P.density(own, min_chars=900).join(P.layout(own), "doc_id")
    return both.select("doc_id", P.fallback_reason(F.col("total_pages"), F.col("empty_page_ratio"), F.round("layout_complexity", 6)).alias("fallback_reason"))


@query("""WITH f AS (SELECT doc_id AS file_ord, 1 + n_chars // 500 AS planned_pages FROM documents),
    b AS (SELECT *, coalesce(sum(least(planned_pages, 20)) OVER (ORDER BY file_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pages_before FROM f)
    SELECT file_ord, planned_pages, pages_before, greatest(0, least(20, planned_pages, 1200 - pages_before))::BIGINT AS allowed, 1200 - pages_before <= 0 AS skipped,
    greatest(0, least(20, planned_pages, 1200 - pages_before)) < planned_pages AS truncated FROM b""")
def page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_ord"), (1 + F.floor(F.col("n_chars") / 500)).cast("long").alias("planned_pages"))
    return P.page_budget(files, per_doc=20, total=1200).select("file_ord", "planned_pages", "pages_before", "allowed", "skipped", "truncated")


@query("""SELECT doc_id, substr(sha1(source || ':' || n_chars || ':' || doc_id), 1, 12) AS file_doc_id FROM documents""")
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents")
    return own.select("doc_id", P.doc_id(F.col("source"), F.col("n_chars"), F.col("doc_id")).alias("file_doc_id"))


@query("""SELECT doc_id, 'file_name=' || source || ',source=' || lang || ',strategy=fast' || CASE WHEN n_chars < 200 THEN ',warning=short' ELSE '' END AS meta FROM documents""")
def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents")
    meta = P.page_metadata(F.col("lang"), F.lit("fast"), F.col("source"), warning=F.when(F.col("n_chars") < 200, "short").otherwise(""), truncated=F.lit("false"))
    return own.select("doc_id", F.array_join(F.transform(F.array_sort(F.map_entries(meta)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("meta"))


@query("""SELECT event_id, CASE WHEN s IN ('fast', 'auto') THEN s WHEN s = 'view' THEN 'fast' ELSE 'fast' END AS strategy, s = 'hi_res' AS hi_res_blocked,
    s IN ('hi_res', 'auto') AS warned FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'hi_res' WHEN 1 THEN 'auto' WHEN 2 THEN 'fast' ELSE event_type END AS s FROM events)""")
def strategy_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    asked = F.when(k == 0, "hi_res").when(k == 1, "auto").when(k == 2, "fast").otherwise(F.col("event_type"))
    own = table(spark, sf_dir, "events").select("event_id", P.strategy(asked).alias("s"))
    return own.select("event_id", "s.strategy", "s.hi_res_blocked", F.col("s.warning").isNotNull().alias("warned"))


@query(f"""WITH {PAGES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_num) AS k, count(*) OVER (PARTITION BY doc_id) AS total FROM pages_)
    SELECT doc_id, page_num, total >= 30 AS truncated FROM n WHERE k <= 30""")
def page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.capped(doc_pages(spark, sf_dir), override=30).select("doc_id", "page_num", "truncated")


@query("""WITH e AS (SELECT conv_id AS doc_id, turn AS ord, CASE WHEN role = 'user' THEN turn + 1 END AS page_number, text FROM conversations),
    p AS (SELECT doc_id, coalesce(page_number, 1) AS page_num, string_agg(text, chr(10) ORDER BY ord) AS text FROM e GROUP BY ALL),
    every AS (SELECT doc_id, unnest(range(1, max(page_num) + 1)) AS page_num FROM p GROUP BY doc_id)
    SELECT doc_id, page_num, md5(coalesce(text, '')) AS text_md5 FROM every LEFT JOIN p USING (doc_id, page_num)""")
def element_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations")
    elements = own.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ord"), F.when(F.col("role") == "user", F.col("turn") + 1).alias("page_number"), "text")
    return P.regroup_elements(elements).select("doc_id", F.col("page_num").cast("long").alias("page_num"), F.md5("text").alias("text_md5"))
