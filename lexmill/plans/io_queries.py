"""Queries over readers, writers and the engine: what is written to the shared folder and read back equals the tables it came from."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.functions import text as T
from lexmill.functions.store import new_path
from lexmill.operators import chunking
from lexmill.operators import evaluate as E
from lexmill.operators import pages as P
from lexmill.operators import synth as S
from lexmill.plans.engine import Engine, RetrievalConfig
from lexmill.plans.registry import query, table
from lexmill.plans.retrieval_queries import DOCS, GOLD_SQL, ITEMS, bm25_sql
from lexmill.sources import readers, writers


@query("SELECT md5(text) AS page_md5, length(text) AS chars, count(*) AS n FROM documents WHERE text <> '' GROUP BY ALL")
def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of text files between form feeds."""
    path = new_path(spark, "text-files")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\f").text(path)
    pages = readers.text_pages(spark, f"{path}/*.txt", 1_000_000_000).where("text <> ''")
    return pages.groupBy(F.md5("text").alias("page_md5"), F.length("text").cast("long").alias("chars")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents")
def json_line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "json-lines")
    writers.json_lines(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), path)
    return readers.json_lines(spark, path, "doc_id long, lang string, source string, text string").select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query("SELECT item_id::VARCHAR AS id, md5(text) AS question_md5, 'bench' AS doc_id, item_id::INT AS page_start, CASE WHEN item_id % 3 > 0 THEN item_id::INT END AS page_end, 'a,b' || item_id AS tags FROM benchmark")
def gold_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold questions as CSV: lists between semicolons, numbers that are none."""
    path = new_path(spark, "gold") + ".csv"
    own = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), F.col("text").alias("question"), F.lit("bench").alias("doc_id"), F.col("item_id").alias("page_start"), F.when(F.col("item_id") % 3 > 0, F.col("item_id").cast("string")).otherwise("none").alias("page_end"), F.concat(F.lit("a; b"), F.col("item_id").cast("string"), F.lit(";")).alias("tags"))
    own.write.csv(path, header=True, escape='"')
    return readers.gold(spark, path).select("id", F.md5("question").alias("question_md5"), "doc_id", "page_start", "page_end", F.array_join("tags", ",").alias("tags"))


@query("SELECT doc_id::VARCHAR AS chunk_id, source AS doc_id, n_chars::INT AS token_len, md5(text) AS text_md5, lang FROM documents")
def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk records, with a map, as JSON lines."""
    path = new_path(spark, "chunks") + ".jsonl"
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("source").alias("doc_id"), "text", F.col("n_chars").alias("token_len"), F.create_map(F.lit("lang"), "lang").alias("meta"))
    writers.json_lines(own, path)
    return readers.chunks(spark, path).select("chunk_id", "doc_id", "token_len", F.md5("text").alias("text_md5"), F.col("meta")["lang"].alias("lang"))


@query("SELECT source AS doc_id, count(*) AS pages, min(doc_id) AS first, max(doc_id) AS last, sum(length(text))::BIGINT AS chars FROM documents GROUP BY source")
def parsed_doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed documents, an object with its pages each."""
    path = new_path(spark, "gold-inputs")
    pages = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.col("source").alias("doc_name"), F.col("doc_id").alias("page_num"), "text", F.lit(0).alias("char_start"), F.length("text").alias("char_end"))
    writers.gold_inputs(pages, pages.select("doc_id"), path)
    own = readers.json_lines(spark, f"{path}/parsed_docs", readers.PARSED_DOC).select("doc_id", F.explode("pages").alias("p"))
    return own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"), F.min("p.page_num").cast("long").alias("first"), F.max("p.page_num").cast("long").alias("last"), F.sum(F.length("p.text")).alias("chars"))


@query("SELECT event_type AS cache_key, min(event_type || ' answered') AS response FROM events GROUP BY event_type")
def response_cache_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache that has entries twice, and broken ones."""
    path = new_path(spark, "cache")
    own = table(spark, sf_dir, "events").select(F.col("event_type").alias("cache_key"), F.concat("event_type", F.lit(" answered")).alias("response"))
    writers.cache_store(own, path)
    writers.cache_store(own.select(F.lit(None).cast("string").alias("cache_key"), "response"), path)
    return readers.response_cache(spark, path)


@query("SELECT event_id AS window_id, upper(event_type) || CASE WHEN event_id % 2 = 0 THEN ' kept' ELSE ' asked' END AS response FROM events")
def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts whose replies are in the cache are not asked again."""
    own = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("window_id"), F.lit("s").alias("system"), F.col("event_type").alias("prompt"))
    known = own.where("cast(window_id as long) % 2 = 0").select(S.cache_key(F.col("window_id"), F.col("prompt")).alias("cache_key"), F.concat(F.upper("prompt"), F.lit(" kept")).alias("response"))
    out = S.complete(own, lambda messages, options: messages[-1]["content"].upper() + " asked", cached=known)
    return out.select(F.col("window_id").cast("long").alias("window_id"), "response")


@query("SELECT conv_id, turn, md5(question) AS question_md5 FROM (SELECT conv_id, turn, text AS question, turn % 2 = 0 AS kept FROM conversations) WHERE kept")
def model_gold_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept items without their windows."""
    path = new_path(spark, "model-gold")
    own = table(spark, sf_dir, "conversations")
    writers.model_gold(own.select("conv_id", "turn", F.col("text").alias("question"), F.col("text").alias("window_text"), F.when(F.col("turn") % 2 > 0, "duplicate").alias("reason")), path)
    back = readers.json_lines(spark, path)
    if "window_text" in back.columns or "reason" in back.columns:
        raise ValueError("windows and reasons are not written")
    return back.select("conv_id", "turn", F.md5("question").alias("question_md5"))


@query("SELECT * FROM (SELECT 'lexical' AS engine, count(*) AS items, round(avg(item_id % 2), 6) AS hit FROM benchmark UNION ALL SELECT 'semantic', count(*), round(avg(item_id % 3 % 2), 6) FROM benchmark)")
def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run files by pattern: their items and figures."""
    path = new_path(spark, "runs")
    items = table(spark, sf_dir, "benchmark")
    for engine, hit in (("lexical", F.col("item_id") % 2), ("semantic", F.col("item_id") % 3 % 2)):
        own = items.select(F.col("item_id").cast("string").alias("query_id"), hit.cast("int").alias("hit"))
        writers.run_file(spark, engine, {"engine": engine}, own.agg(F.avg("hit").alias("hit")).first().asDict(), {}, own, f"{path}/{engine}_run.json", "0", "now")
    return readers.runs(spark, [f"{path}/*_run.json", f"{path}/lexical_run.json"]).select("engine", F.size("items").cast("long").alias("items"), F.round("aggregates.hit", 6).alias("hit"))


@query(r"""WITH d AS (SELECT source AS doc_id, text FROM documents), h AS (SELECT doc_id, 'char_hist_' || (length(text) // 200 * 200) || '_' || (length(text) // 200 * 200 + 200) AS bin, count(*) AS n FROM d GROUP BY ALL),
    t AS (SELECT doc_id, count(*) AS pages, sum(length(text))::BIGINT AS chars FROM d GROUP BY doc_id) SELECT t.doc_id, pages, chars, string_agg(bin || '=' || round(n / pages, 6), ',' ORDER BY bin) AS char_hist FROM t JOIN h USING (doc_id) GROUP BY ALL""")
def document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of a document in one row; of them the sizes and the histogram."""
    own = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page_num"), "text")
    bins = F.transform(F.array_sort(F.map_entries("char_hist")), lambda e: F.concat(e["key"], F.lit("="), T.millionths(e["value"])))
    return P.document_metrics(own).select("doc_id", F.col("total_pages").cast("long").alias("pages"), F.col("total_chars").cast("long").alias("chars"), F.array_join(bins, ",").alias("char_hist"))


@query("SELECT b.item_id, d.doc_id, instr(d.text, b.text) - 1 AS char_start, instr(d.text, b.text) - 1 + length(b.text) AS char_end, 'exact' AS how, instr(d.text, b.text) - 1 AS answer_start FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def aligned_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages in the documents that hold them, found by the alignment itself."""
    from lexmill.plans.synth_queries import answer_span

    ship(spark)
    found = answer_span(spark, sf_dir).select("item_id", "doc_id")
    items, docs = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("answer")), table(spark, sf_dir, "documents").select("doc_id", "text")

    @F.pandas_udf("struct<char_start:long,char_end:long,how:string,answer_start:long>")
    def aligned(answer: pd.Series, text: pd.Series) -> pd.DataFrame:
        rows = [(*S.find_span(a, t), S.answer_span(a, t, [])[0]) for a, t in zip(answer, text, strict=True)]
        return pd.DataFrame(rows, columns=["char_start", "char_end", "how", "answer_start"])

    rows = found.join(items, "item_id").join(docs, "doc_id").withColumn("s", aligned(F.col("answer"), F.col("text")))
    return rows.select("item_id", "doc_id", "s.*")


@query("""SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '1. ' || substr(text, 1, 5) || chr(10) || '2. ' || substr(text, 3, 7) WHEN 1 THEN '1. ' || text ELSE 'No evidence was given.' END AS summary FROM conversations""")
def evidence_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations")
    spans = F.array(F.struct(F.lit(0).alias("start"), F.lit(5).alias("end")), F.struct(F.lit(2).alias("start"), F.lit(9).alias("end")))
    k = F.col("turn") % 3
    none = F.array().cast("array<struct<start:int,end:int>>")
    own = own.withColumn("spans", F.when(k == 0, spans).otherwise(none)).withColumn("raw", F.when(k == 1, F.array("text")).otherwise(F.array().cast("array<string>")))
    return own.select("conv_id", "turn", S.evidence_summary(F.col("text"), F.col("spans"), F.col("raw")).alias("summary"))


def _engine(spark: SparkSession, sf_dir: str) -> Engine:
    """Documents as chunks, each a page of its own, indexed for words only."""
    def no_model(text: str):
        raise OSError("no model here")

    own = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("source").alias("doc_id"), F.col("doc_id").cast("int").alias("page_start"), F.col("doc_id").cast("int").alias("page_end"), "text", F.floor(F.length("text") / 4).cast("int").alias("token_len"))
    engine = Engine(spark, [no_model])
    engine.build_indexes(own)
    return engine


ENGINE_SQL = f"WITH {bm25_sql(DOCS, ITEMS)}, r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, id::VARCHAR) AS rank FROM bm)"


@query(f"{ENGINE_SQL} SELECT q::VARCHAR AS query_id, id::VARCHAR AS chunk_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10")
def engine_first_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engine without a model falls back to words, whatever engine is asked for."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))
    lists = _engine(spark, sf_dir).retrieve_all(asked, RetrievalConfig(engine="hybrid", top_k=10))
    return lists.first_pass.select("query_id", "chunk_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"""{ENGINE_SQL}, {GOLD_SQL}, g AS (SELECT q, min(id) AS page FROM gold GROUP BY q), j AS (SELECT g.q, min(rank) FILTER (r.id = g.page) AS spot FROM g LEFT JOIN r ON r.q = g.q AND rank <= 40 GROUP BY g.q),
    m AS (SELECT 'top_k-lexical-' || k AS engine, q, CASE WHEN spot <= 10 THEN 1 ELSE 0 END AS hit, coalesce(CASE WHEN spot <= 10 THEN 1.0::DOUBLE / spot END, 0) AS mrr FROM j, (VALUES (40), (80)) v(k))
    SELECT engine, count(*) AS items, round(avg(hit), 6) AS pre_hit_at_10, round(avg(mrr), 6) AS mrr_at_10 FROM m GROUP BY engine""")
def engine_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two depths of the first pass, evaluated with labels of their own: each passage's first document is its gold page."""
    from lexmill.plans.synth_queries import answer_span

    page = answer_span(spark, sf_dir).groupBy("item_id").agg(F.min("doc_id").cast("int").alias("page_start"))
    none = F.lit(None).cast("int")
    gold = table(spark, sf_dir, "benchmark").join(page, "item_id").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"), "page_start", F.col("page_start").alias("page_end"), none.alias("char_start"), none.alias("char_end"), F.array().cast("array<string>").alias("tags"))
    grid = [g for g in E.ablation_grid(["lexical"]) if g["suite"] == "top_k" and g["top_k"] < 120]
    out = _engine(spark, sf_dir).evaluate(gold, [RetrievalConfig.of(**g) for g in grid], labels=[f"top_k-lexical-{g['top_k']}" for g in grid])
    return out["aggregates"].select("engine", "items", F.round("pre_hit_at_k", 6).alias("pre_hit_at_10"), F.round("mrr_at_10", 6).alias("mrr_at_10"))


@query("SELECT 'index' AS name, count(*) AS chunks, count(DISTINCT source) AS documents FROM documents")
def index_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the engine holds; the same chunks are not indexed twice."""
    engine = _engine(spark, sf_dir)
    first = engine.indexes
    if engine.build_indexes(first.chunks.drop("embedding")) is not first:
        raise ValueError("indexed twice")
    return engine.status().select("name", "chunks", "documents")


@query("""SELECT doc_id, CASE WHEN length(t) > 420 THEN left(t, 417) || '...' ELSE t END AS shown, 'p.' || doc_id AS page, greatest(length(text) // 4, 1) AS tokens FROM (SELECT doc_id, text, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)""")
def chunk_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as a reader sees them: a preview, a page label, a size."""
    own = table(spark, sf_dir, "documents")
    return own.select("doc_id", chunking.preview(F.col("text")).alias("shown"), chunking.page_label(F.col("doc_id"), F.col("doc_id")).alias("page"), chunking.token_estimate(F.col("text")).alias("tokens"))
