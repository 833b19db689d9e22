"""Queries over blocks and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import chunking as C
from lexmill.plans.page_queries import doc_pages, strip_sql
from lexmill.plans.registry import query, table

DIGITS = r"\p{Nd}²³¹⁰-⁹₀-₉①-⑨"
LS = r"regexp_split_to_array({}, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]')"
TOKENS_SQL = r"regexp_extract_all(text, '[^\s\pZ\x0B\x1C-\x1F\x{85}]+')"
PROFILE_SQL = rf"""p AS (SELECT source AS doc_id, doc_id AS page_num, text, list_filter(list_transform({LS.format('text')}, lambda x: {strip_sql('x')}), lambda x: x <> '') AS ls FROM documents),
    q AS (SELECT doc_id, page_num, text, len(ls) AS n, len(list_filter(ls, lambda x: length(x) < 40)) AS s,
        len(list_filter(ls, lambda x: length(regexp_replace(x, '[^{DIGITS}|:/\-+%,]', '', 'g'))::DOUBLE / length(x) > 0.6::DOUBLE)) AS d FROM p),
    prof AS (SELECT doc_id, page_num, text, CASE WHEN n > 0 THEN s / n ELSE 0 END AS short_r, CASE WHEN n > 0 THEN d / n ELSE 0 END AS digit_r,
        CASE WHEN n > 0 THEN ((length(text) - length(replace(text, E'\n\n', ''))) // 2) / greatest(1, length(text) - length(replace(text, E'\n', ''))) ELSE 1 END AS gap_r FROM q)"""


@query(f"WITH {PROFILE_SQL} SELECT page_num, round(short_r, 6) AS short_line_ratio, round(digit_r, 6) AS digit_symbol_ratio, round(gap_r, 6) AS gap_line_ratio, digit_r > 0.5 OR short_r > 0.6::DOUBLE AS table_heavy FROM prof")
def page_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = doc_pages(spark, sf_dir).select("page_num", C.profile(F.col("text")).alias("p"))
    return own.select("page_num", *[F.round(f"p.{c}", 6).alias(c) for c in ("short_line_ratio", "digit_symbol_ratio", "gap_line_ratio")], "p.table_heavy")


KIND_SQL = rf"""CASE WHEN t = '' THEN 'other' WHEN len(ls) = 1 AND length(t) <= 60 AND t = upper(t) AND regexp_matches(t, '\p{{L}}') THEN 'heading'
    WHEN len(ls) = 1 AND ends_with(t, ':') AND length(t) <= 80 THEN 'heading'
    WHEN len(list_filter(ls, lambda x: regexp_matches(regexp_replace(x, '^[\s\pZ]+', ''), '^(- |\* |•|1\.|a\.)'))) > 0 THEN 'list'
    WHEN contains(t, '|') OR contains(t, E'\t') THEN 'table'
    WHEN length(regexp_replace(t, '[^{DIGITS}]', '', 'g'))::DOUBLE / greatest(1, length(t)) > 0.4::DOUBLE THEN 'table'
    WHEN contains(t, '```') THEN 'code' ELSE 'paragraph' END"""


@query(rf"""WITH b AS (SELECT doc_id, unnest(string_split(text, E'\n')) AS raw FROM documents), s AS (SELECT doc_id, {strip_sql('raw')} AS t FROM b),
    k AS (SELECT doc_id, {LS.format('t')} AS ls, t FROM s) SELECT doc_id, {KIND_SQL} AS kind, count(*) AS n FROM k GROUP BY ALL""")
def block_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("raw"))
    return own.groupBy("doc_id", C.kind(F.col("raw")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"""WITH d AS (SELECT doc_id, replace(text, E'\n', E'\n\n') AS text FROM documents), b AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n'), lambda x: {strip_sql('x')}), lambda x: x <> '')) AS t FROM d)
    SELECT doc_id, count(*) AS blocks, md5(string_agg(md5(t), '' ORDER BY md5(t))) AS blocks_md5 FROM b GROUP BY doc_id""")
def block_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("page_num"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    rows = C.blocks(own).where("text != ''")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"), F.md5(F.array_join(F.array_sort(F.collect_list(F.md5("text"))), "")).alias("blocks_md5"))


@query()
def block_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("page_num"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return C.blocks(own).select("doc_id", "block_seq", "kind", "char_start", "char_end")


@query(rf"""WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: {strip_sql('x')}), lambda x: x <> '') AS s FROM documents)
    SELECT doc_id, len(s) AS sentences, md5(array_to_string(s, '|')) AS sentences_md5 FROM s""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    return own.select("doc_id", F.size("s").cast("long").alias("sentences"), F.md5(F.array_join("s", "|")).alias("sentences_md5"))


STRATEGY_SQL = "CASE WHEN digit_r > 0.5 OR short_r > 0.6::DOUBLE THEN 'fixed_table' WHEN sents = 0 THEN 'fixed' ELSE 'semantic' END"


@query(rf"""WITH {PROFILE_SQL}, c AS (SELECT doc_id, page_num, digit_r, short_r, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS sents FROM prof),
    s AS (SELECT doc_id, page_num, {STRATEGY_SQL} AS strategy FROM c),
    l AS (SELECT *, coalesce(strategy <> lag(strategy) OVER (PARTITION BY doc_id ORDER BY page_num), FALSE)::INT AS new FROM s)
    SELECT doc_id, page_num, strategy, CASE WHEN strategy = 'fixed_table' THEN 400 ELSE 700 END AS max_tokens, sum(new) OVER (PARTITION BY doc_id ORDER BY page_num)::BIGINT AS run_id FROM l""")
def config_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = doc_pages(spark, sf_dir).withColumn("config", C.strategy(F.col("text"), "semantic", F.size(T.sentences(F.col("text"))) > 0))
    return C.runs(own).select("doc_id", "page_num", "config.strategy", "config.max_tokens", "run_id")


SLIDING_SQL = rf"""t AS (SELECT doc_id, {TOKENS_SQL} AS t FROM documents), st AS (SELECT doc_id, t, unnest(range(0, len(t), 200)) AS i FROM t),
    sl AS (SELECT doc_id, i // 200 AS seq, array_to_string(t[i + 1:i + 240], ' ') AS text, len(t[i + 1:i + 240]) AS token_len FROM st),
    chunks AS (SELECT doc_id, min(seq) AS seq, text, min(token_len) AS token_len FROM sl GROUP BY doc_id, text)"""


@query(f"WITH {SLIDING_SQL} SELECT doc_id, seq, token_len, md5(text) AS text_md5 FROM chunks")
def sliding_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = C.sliding(table(spark, sf_dir, "documents"), 240, 40)
    return own.select("doc_id", F.col("seq").cast("long").alias("seq"), F.col("token_len").cast("long").alias("token_len"), F.md5("text").alias("text_md5"))


@query(f"""WITH {SLIDING_SQL}, k AS (SELECT doc_id, CASE WHEN token_len < 240 THEN 'tail' ELSE 'full' END AS strategy, token_len FROM chunks)
    SELECT doc_id, count(*) AS chunks, round_even(avg(token_len), 2) AS avg_tokens, concat_ws(',', 'full=' || nullif(count(*) FILTER (strategy = 'full'), 0), 'tail=' || nullif(count(*) FILTER (strategy = 'tail'), 0)) AS strategies FROM k GROUP BY doc_id""")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = C.sliding(table(spark, sf_dir, "documents"), 240, 40).withColumn("strategy", F.when(F.col("token_len") < 240, "tail").otherwise("full"))
    out = C.chunk_stats(own)
    return out.select("doc_id", "chunks", "avg_tokens", F.array_join(F.transform(F.array_sort(F.map_entries("strategies")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("strategies"))


@query(f"""WITH {SLIDING_SQL}, r AS (SELECT doc_id, seq, token_len, sum(token_len) OVER (ORDER BY doc_id, seq) AS running FROM chunks)
    SELECT doc_id AS doc_ord, seq AS chunk_seq, token_len FROM r WHERE running <= 1000000000""")
def token_guardrail(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = C.sliding(table(spark, sf_dir, "documents"), 240, 40)
    rows = own.select(F.col("doc_id").alias("doc_ord"), F.col("seq").cast("long").alias("chunk_seq"), F.col("token_len").cast("long").alias("token_len"))
    return C.guardrail(rows, 1_000_000_000)


@query()
def token_guardrail_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = C.sliding(table(spark, sf_dir, "documents"), 240, 40)
    rows = own.select(F.col("doc_id").alias("doc_ord"), F.col("seq").cast("long").alias("chunk_seq"), F.col("token_len").cast("long").alias("token_len"))
    return C.guardrail(rows, C.MAX_TOTAL_TOKENS)


def document_chunks(spark: SparkSession, sf_dir: str, mode: str = "semantic") -> DataFrame:
    """Each text is a document; its lines are paragraphs, 40 lines a page."""
    own = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("ls"))
    starts = F.sequence(F.lit(0), F.size("ls") - 1, F.lit(40))
    pages = own.select("doc_id", F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice("ls", i + 1, 40), "\n\n"))).alias("page_num", "text"))
    return C.chunk_documents(pages.withColumn("page_num", F.col("page_num").cast("long") + 1), mode)


@query()
def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_chunks(spark, sf_dir).select("doc_id", "chunk_id", "page_start", "page_end", "token_len", "block_types", "strategy", "merged_tail", F.md5("text").alias("text_md5"))


@query()
def semantic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("page_num"), "text")
    return C.semantic_segments(own).select("doc_id", "segment_seq", "char_start", "char_end", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, greatest(length(text) // 4, 1) AS tokens FROM documents")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", C.token_estimate(F.col("text")).alias("tokens"))


@query(rf"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\s\pZ\x0B\x1C-\x1F\x{{85}}]+', ' ', 'g')) AS t FROM documents)
    SELECT doc_id, CASE WHEN length(t) > 420 THEN t[1:417] || '...' ELSE t END AS preview, CASE WHEN doc_id % 3 = 0 THEN 'p.' || doc_id ELSE 'pp.' || doc_id || '-' || (doc_id + doc_id % 3) END AS label FROM t""")
def context_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents")
    return own.select("doc_id", C.preview(F.col("text")).alias("preview"), C.page_label(F.col("doc_id"), F.col("doc_id") + F.col("doc_id") % 3).alias("label"))


@query(f"""WITH {SLIDING_SQL}, h AS (SELECT sha1(doc_id || ':' || seq || '|' || token_len) AS h FROM chunks), b AS (SELECT h[1:3] AS b, sha1(string_agg(h, '' ORDER BY h)) AS h FROM h GROUP BY 1)
    SELECT sha1(string_agg(h, '' ORDER BY b)) AS fingerprint, count(*) AS buckets FROM b""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = C.sliding(table(spark, sf_dir, "documents"), 240, 40)
    return C.fingerprint(own.select(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("seq").cast("string")).alias("chunk_id"), "token_len"))
