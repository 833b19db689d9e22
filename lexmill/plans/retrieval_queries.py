"""Queries over retrieval: BM25, vectors, fusion, reranking, context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import fusion as U
from lexmill.operators import lexical as L
from lexmill.operators import vector as V
from lexmill.plans.page_queries import strip_sql
from lexmill.plans.registry import query, table

WORD = r"'[\p{L}\p{N}_](?:[\p{L}\p{N}_-]*[\p{L}\p{N}_])?'"


def bm25_sql(chunks: str, queries: str, word: str = WORD) -> str:
    """CTEs up to bm(q, id, score); chunks and queries: SELECTs of (id, text) and (q, text)."""
    return f"""cw AS (SELECT id, regexp_extract_all(lower(text), {word}) AS w FROM ({chunks})), dl AS (SELECT id, len(w) AS dl FROM cw),
    size AS (SELECT count(*) AS n, avg(dl)::DOUBLE AS avgdl FROM dl), post AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM cw) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM post GROUP BY term), own AS (SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS plain FROM df, size), mean AS (SELECT avg(plain) AS mean FROM own),
    idf AS (SELECT term, df, CASE WHEN plain < 0 THEN 0.25::DOUBLE * mean ELSE plain END AS idf FROM own, mean),
    qw AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(regexp_extract_all(lower(text), {word})) AS term FROM ({queries})) GROUP BY ALL),
    bm AS (SELECT q, id, sum(times * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS score
           FROM qw JOIN idf USING (term) JOIN post USING (term) JOIN dl USING (id), size GROUP BY q, id)"""


DOCS, ITEMS = "SELECT doc_id AS id, text FROM documents", "SELECT item_id AS q, text FROM benchmark"
TOP = "row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, id)"


@query(f"WITH {bm25_sql(DOCS, ITEMS)} SELECT term, count(*) AS df, sum(tf)::BIGINT AS total, max(tf) AS most FROM post GROUP BY term")
def bm25_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = L.postings(table(spark, sf_dir, "documents"))
    return own.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"), F.max("tf").alias("most"))


@query(f"WITH {bm25_sql(DOCS, ITEMS)} SELECT term, df, round(idf, 6) AS idf FROM idf")
def bm25_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.build(table(spark, sf_dir, "documents")).stats.select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {bm25_sql(DOCS, ITEMS)}, r AS (SELECT *, {TOP} AS rank FROM bm) SELECT q AS item_id, id AS doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select("item_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


GOLD_SQL = "gold AS (SELECT item_id AS q, doc_id AS id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


@query(rf"""WITH {bm25_sql(DOCS, ITEMS)}, r0 AS (SELECT bm.*, source, row_number() OVER (PARTITION BY q, source ORDER BY round(score, 9) DESC, id) AS k FROM bm JOIN documents ON doc_id = id),
    r AS (SELECT *, {TOP} AS rank FROM r0 WHERE k <= 2), {GOLD_SQL},
    m AS (SELECT r.q, min(rank) FILTER (g.id IS NOT NULL) AS first FROM (SELECT * FROM r WHERE rank <= 10) r LEFT JOIN gold g ON g.q = r.q AND g.id = r.id GROUP BY r.q)
    SELECT q AS item_id, (first IS NOT NULL)::INT AS hit_at_10, (coalesce(first, 99) <= 5)::INT AS hit_at_5, round(coalesce(1.0::DOUBLE / first, 0), 6) AS mrr_at_10 FROM m""")
def bm25_retrieval_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages against documents: scores, at most two documents a source, the ten best, and whether one that holds the passage is among them."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    scored = L.best(L.build(docs, keep={"kept": F.col("source")}), items, 10, cap=2)
    found = scored.join(docs.select("doc_id", "source"), "doc_id")
    order = [F.desc(F.round("score", 9)), F.col("doc_id")]
    best = U.with_ranks(U.per_doc_cap(found, 2, "source", "item_id", order), order, "item_id").where("rank <= 10")
    texts = best.join(docs.select("doc_id", F.col("text").alias("d_text")), "doc_id").join(items.select("item_id", F.col("text").alias("i_text")), "item_id")
    first = F.min(F.when(F.contains("d_text", "i_text"), F.col("rank")))
    out = texts.groupBy("item_id").agg(first.alias("first"))
    return out.select("item_id", F.col("first").isNotNull().cast("int").alias("hit_at_10"), (F.coalesce("first", F.lit(99)) <= 5).cast("int").alias("hit_at_5"), F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 6).alias("mrr_at_10"))


NEG_CHUNKS, NEG_GOLD = "SELECT doc_id AS id, text FROM documents", "SELECT doc_id AS q, text || ' ' || source AS text FROM documents WHERE doc_id % 20 = 0"


@query(rf"""WITH {bm25_sql(NEG_CHUNKS, NEG_GOLD, "'[a-z0-9]+'")}, o AS (SELECT bm.*, {TOP} AS rank FROM bm JOIN documents c ON c.doc_id = id JOIN documents g ON g.doc_id = q WHERE NOT (c.source = g.source AND c.n_chars = g.n_chars))
    SELECT q AS id, string_agg(id, ',' ORDER BY rank) AS hard_negatives FROM o WHERE rank <= 5 GROUP BY q""")
def bm25_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chunks = docs.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("doc_id"), F.col("n_chars").alias("page_start"), "text")
    gold = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("id"), F.col("text").alias("question"), F.col("source").alias("answer_text"), F.col("source").alias("doc_id"), F.col("n_chars").alias("page_start"))
    out = L.hard_negatives(chunks, gold)
    return out.select("id", F.array_join(F.transform("hard_negative_ids", lambda x: x.cast("string")), ",").alias("hard_negatives"))


@query("""WITH s AS (SELECT vec_id, list_inner_product(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) AS score FROM embeddings),
    r AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s) SELECT vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 25""")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "embeddings")
    asked = own.where("vec_id = 0").first()
    return V.nearest(own, asked["embedding"] if asked else [], 25).select("vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def vectors_sql(name: str, dims: int, k: int) -> str:
    return f"""{name}_s AS (SELECT q.vec_id AS q, e.vec_id AS id, e.label, list_inner_product(q.embedding[1:{dims}]::DOUBLE[], e.embedding[1:{dims}]::DOUBLE[]) AS score FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id),
    {name}_r AS (SELECT *, {TOP} AS rank FROM {name}_s), {name} AS (SELECT * FROM {name}_r WHERE rank <= {k})"""


BOTH_SQL = f"{vectors_sql('sem', 64, 20)}, {vectors_sql('lex', 16, 20)}"


def both_lists(spark: SparkSession, sf_dir: str, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """Two rankings of the same vectors, by all 64 dimensions and by the first 16; queries are the ids divisible by 20."""
    own = table(spark, sf_dir, "embeddings")
    asked = own.where("vec_id % 20 = 0")
    side = lambda dims: V.search(own, asked, k, dims=dims, skip_self=True).select("query_id", F.col("vec_id").alias("chunk_id"), "score", "rank")
    return side(64), side(16)


@query(f"WITH {vectors_sql('sem', 64, 20)} SELECT q AS query_id, id AS chunk_id, round(score, 6) AS score, rank FROM sem")
def vector_topk_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_lists(spark, sf_dir)[0].select("query_id", "chunk_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {vectors_sql('sem', 64, 20)}, b AS (SELECT *, min(score) OVER (PARTITION BY q) AS lo, max(score) OVER (PARTITION BY q) AS hi FROM sem)
    SELECT q AS query_id, id AS chunk_id, round(CASE WHEN abs(hi - lo) <= 1e-9 * greatest(abs(hi), abs(lo)) THEN 1 ELSE (score - lo) / nullif(hi - lo, 0) END, 6) AS norm FROM b""")
def minmax_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.min_max(both_lists(spark, sf_dir)[0]).select("query_id", "chunk_id", F.round("norm", 6).alias("norm"))


FUSED_SQL = """f AS (SELECT coalesce(s.q, l.q) AS q, coalesce(s.id, l.id) AS id, s.rank AS srank, l.rank AS lrank, s.score AS ss, l.score AS ls, s.norm AS sn, l.norm AS ln FROM sn s FULL JOIN ln l ON s.q = l.q AND s.id = l.id),
    g AS (SELECT *, {} AS fused FROM f), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(fused, 12) DESC, ss DESC NULLS LAST, ls DESC NULLS LAST, id) AS rank FROM g)
    SELECT q AS query_id, id AS chunk_id, round(fused, 6) AS fused, srank AS semantic_rank, lrank AS lexical_rank, rank FROM r WHERE rank <= 20"""
NORMS_SQL = ", ".join(f"{n} AS (SELECT *, coalesce((score - min(score) OVER (PARTITION BY q)) / nullif(max(score) OVER (PARTITION BY q) - min(score) OVER (PARTITION BY q), 0), 1) AS norm FROM {t})" for n, t in (("sn", "sem"), ("ln", "lex")))


def _fused(rows: DataFrame) -> DataFrame:
    long = lambda c: F.col(c).cast("long").alias(c)
    return rows.select("query_id", "chunk_id", F.round("fused", 6).alias("fused"), long("semantic_rank"), long("lexical_rank"), long("rank"))


@query(f"WITH {BOTH_SQL}, {NORMS_SQL}, {FUSED_SQL.format('coalesce(1.0::DOUBLE / (60 + srank), 0) + coalesce(1.0::DOUBLE / (60 + lrank), 0)')}")
def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(U.fuse(*both_lists(spark, sf_dir), "rrf", top_semantic=20, top_lexical=20))


@query(f"WITH {BOTH_SQL}, {NORMS_SQL}, {FUSED_SQL.format('0.6::DOUBLE * coalesce(sn, 0) + 0.4::DOUBLE * coalesce(ln, 0)')}")
def weighted_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(U.fuse(*both_lists(spark, sf_dir), "weighted", top_semantic=20, top_lexical=20))


@query(f"""WITH {vectors_sql('sem', 64, 20)}, k AS (SELECT *, row_number() OVER (PARTITION BY q, label ORDER BY rank) AS k FROM sem)
    SELECT q AS query_id, id AS chunk_id, rank FROM k WHERE k <= 2""")
def per_doc_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    sem = both_lists(spark, sf_dir)[0].join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label"), "chunk_id")
    return U.per_doc_cap(sem, 2, "label").select("query_id", "chunk_id", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {vectors_sql('sem', 64, 20)}, b AS (SELECT *, sum(50 + label * 10) OVER (PARTITION BY q ORDER BY rank) AS used FROM sem)
    SELECT q AS query_id, id AS chunk_id, used::BIGINT AS used FROM b WHERE used <= 800 OR rank = 1""")
def budget_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    sem = both_lists(spark, sf_dir)[0].join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), (50 + F.col("label") * 10).alias("token_len")), "chunk_id")
    return U.budget_pack(sem, 800).select("query_id", "chunk_id", F.col("used").cast("long").alias("used"))


@query()
def mmr_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("label").alias("doc_id"), (50 + F.col("label") * 10).alias("token_len"), "embedding")
    return U.pack_context(both_lists(spark, sf_dir)[0].join(own, "chunk_id"), budget=800)


@query(rf"""WITH {bm25_sql(DOCS, ITEMS)}, r AS (SELECT *, {TOP} AS rank FROM bm), c AS (SELECT q, id, rank, list_distinct(regexp_extract_all(lower(b.text), {WORD})) AS qw, list_distinct(regexp_extract_all(lower(d.text), {WORD})) AS dw
        FROM r JOIN benchmark b ON item_id = q JOIN documents d ON doc_id = id WHERE rank <= 10),
    s AS (SELECT q, id, rank, len(list_intersect(qw, dw)) / len(qw) AS score FROM c)
    SELECT q AS query_id, id AS chunk_id, round(score, 6) AS rerank_score, row_number() OVER (PARTITION BY q ORDER BY score DESC, rank) AS rerank_rank FROM s""")
def overlap_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    best = L.search(docs, items, 10)
    rows = best.join(docs.select("doc_id", "text"), "doc_id").join(items.select("item_id", F.col("text").alias("query")), "item_id")
    out = U.rerank(rows.withColumnsRenamed({"item_id": "query_id", "doc_id": "chunk_id"}), 5)
    return out.select("query_id", "chunk_id", F.round("rerank_score", 6).alias("rerank_score"), F.col("rerank_rank").cast("long").alias("rerank_rank"))


@query(f"SELECT conv_id, turn, rtrim(CASE WHEN role = 'user' THEN 'query: ' ELSE 'passage: ' END || {strip_sql('text')}) AS prefixed FROM conversations")
def e5_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations")
    return own.select("conv_id", "turn", F.when(F.col("role") == "user", V.asked(F.col("text"))).otherwise(V.passage(F.col("text"))).alias("prefixed"))


@query()
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = V.embed(table(spark, sf_dir, "documents"))
    return own.select("doc_id", F.size("embedding").alias("dims"), F.round(V.dot(F.col("embedding"), F.col("embedding")), 4).alias("norm"))


@query("SELECT coalesce(nullif(CASE WHEN doc_id % 5 = 0 THEN '' ELSE source || doc_id END, ''), 'chunk-' || doc_id) AS id, source AS doc_id, source AS doc_name, 0 AS page_start, 0 AS page_end, n_chars::INT AS token_len FROM documents")
def chunk_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents")
    raw = own.select(F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat("source", F.col("doc_id").cast("string"))).alias("chunk_id"), F.col("doc_id").alias("pos"), "text", F.col("source").alias("doc_id"), F.col("n_chars").alias("token_len"))
    return U.normalised_chunks(raw).drop("text")


@query(rf"SELECT doc_id, len(regexp_extract_all(lower(text), {WORD})) AS words, len(list_distinct(regexp_extract_all(lower(text), {WORD}))) AS different, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS plain FROM documents")
def tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = T.words(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(w).cast("long").alias("words"), F.size(F.array_distinct(w)).cast("long").alias("different"), F.size(T.plain_words(F.col("text"))).cast("long").alias("plain"))
