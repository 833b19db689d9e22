"""Queries over evaluation. Queries are the vectors with ids divisible by 20; a vector's label is its page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.store import written
from lexmill.operators import evaluate as E
from lexmill.plans.registry import query, table
from lexmill.plans.retrieval_queries import BOTH_SQL, both_lists

RES_SQL = f"""{BOTH_SQL}, res AS (SELECT 'full' AS engine, q, id, rank FROM sem UNION ALL SELECT 'short', q, id, rank FROM lex),
    pg AS (SELECT engine, q, id, rank, c.label AS ps, CASE WHEN c.vec_id % 3 = 0 THEN 0 ELSE c.label + c.vec_id % 2 END AS pe, (c.vec_id * 37) % 500 AS cs, 40 + c.vec_id % 60 AS n FROM res JOIN embeddings c ON c.vec_id = id),
    gold AS (SELECT vec_id AS q, label AS gs, label AS ge, CASE WHEN vec_id % 40 = 0 THEN 100 END AS gcs FROM embeddings WHERE vec_id % 20 = 0),
    j AS (SELECT pg.*, gs, ge, gcs, NOT (coalesce(nullif(pe, 0), ps) < gs OR ps > coalesce(nullif(ge, 0), gs)) AS rel FROM pg JOIN gold USING (q))"""


def results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(results of two engines, gold)."""
    own = table(spark, sf_dir, "embeddings")
    sem, lex = both_lists(spark, sf_dir)
    both = written(sem.withColumn("engine", F.lit("full")).unionByName(lex.withColumn("engine", F.lit("short"))), "results")  # else each metric searches anew
    v = F.col("vec_id")
    pages = own.select(v.alias("chunk_id"), F.col("label").alias("page_start"), F.when(v % 3 == 0, 0).otherwise(F.col("label") + v % 2).alias("page_end"), ((v * 37) % 500).alias("char_start"), (40 + v % 60).alias("n_chars"))
    gold = own.where("vec_id % 20 = 0").select(v.alias("query_id"), F.col("label").alias("page_start"), F.col("label").alias("page_end"), F.when(v % 40 == 0, 100).alias("char_start"), F.array(F.concat(F.lit("page"), F.col("label").cast("string"))).alias("tags"))
    return both.join(pages, "chunk_id").withColumn("char_end", F.col("char_start") + F.col("n_chars")), gold.withColumn("char_end", F.col("char_start") + 200)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.judged(*results(spark, sf_dir))


@query(f"WITH {RES_SQL} SELECT engine, q AS query_id, max(CASE WHEN rank <= 10 AND rel THEN 1 ELSE 0 END) AS hit_at_10, max(CASE WHEN rank <= 5 AND rel THEN 1 ELSE 0 END) AS hit_at_5 FROM j GROUP BY ALL")
def hit_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).groupBy("engine", "query_id").agg(E.hit_at(10).alias("hit_at_10"), E.hit_at(5).alias("hit_at_5"))


@query(f"WITH {RES_SQL} SELECT engine, q AS query_id, round(coalesce(1.0::DOUBLE / min(rank) FILTER (rank <= 10 AND rel), 0), 6) AS mrr FROM j GROUP BY ALL")
def mrr_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).groupBy("engine", "query_id").agg(F.round(E.mrr_at(10), 6).alias("mrr"))


NDCG_SQL = "coalesce(sum(CASE WHEN rank <= 10 AND rel THEN 1 / log2(rank + 1) END) / nullif(list_sum(list_transform(range(1, 1 + count(*) FILTER (rank <= 10 AND rel)), lambda i: 1 / log2(i + 1))), 0), 0)"


@query(f"WITH {RES_SQL} SELECT engine, q AS query_id, round({NDCG_SQL}, 6) AS ndcg FROM j GROUP BY ALL")
def ndcg_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).groupBy("engine", "query_id").agg(F.round(E.ndcg_at(10), 6).alias("ndcg"))


PREC_SQL = "least(1.0::DOUBLE, sum(CASE WHEN gcs IS NOT NULL THEN greatest(0, least(cs + n, gcs + 200) - greatest(cs, gcs)) WHEN rel THEN n ELSE 0 END)::DOUBLE / sum(n))"


@query(f"WITH {RES_SQL} SELECT engine, q AS query_id, round({PREC_SQL}, 6) AS context_precision FROM j GROUP BY ALL")
def context_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.context_precision(*results(spark, sf_dir))
    return out.withColumn("context_precision", F.round("context_precision", 6))


ITEM_SQL = f"""{RES_SQL}, item AS (SELECT engine, q, 'page' || min(gs) AS tag, max(CASE WHEN rank <= 10 AND rel THEN 1 ELSE 0 END) AS pre, max(CASE WHEN rank <= 5 AND rel THEN 1 ELSE 0 END) AS post,
    coalesce(1.0::DOUBLE / min(rank) FILTER (rank <= 10 AND rel), 0) AS mrr, {NDCG_SQL} AS ndcg, {PREC_SQL} AS prec FROM j GROUP BY engine, q)"""
MEANS_SQL = "count(*) AS items, round(avg(pre), 6) AS pre_hit_at_k, round(avg(post), 6) AS post_hit_at_k, round(avg(mrr), 6) AS mrr_at_10, round(avg(ndcg), 6) AS ndcg_at_10, round(avg(prec), 6) AS context_precision"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, gold = results(spark, sf_dir)
    return E.item_metrics(first, first, gold)


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.round(c, 6).alias(c) if c in E.METRICS else c for c in rows.columns])


@query(f"WITH {ITEM_SQL} SELECT engine, {MEANS_SQL} FROM item GROUP BY engine")
def run_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(E.aggregates(items(spark, sf_dir)))


@query(f"WITH {ITEM_SQL} SELECT engine, tag, {MEANS_SQL} FROM item GROUP BY engine, tag")
def per_tag_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(E.per_tag(items(spark, sf_dir)))


@query("SELECT event_type AS key, round(quantile_cont(value::DOUBLE, 0.5::DOUBLE), 6) AS p50, round(quantile_cont(value::DOUBLE, 0.95::DOUBLE), 6) AS p95, round(avg(value), 6) AS mean FROM events GROUP BY event_type")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = E.latency(table(spark, sf_dir, "events").select(F.col("event_type").alias("key"), F.col("value").alias("ms")))
    return own.select("key", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "mean")])


DIFF_SQL = "a.engine AS engine_a, b.engine AS engine_b"


@query(f"WITH {ITEM_SQL} SELECT {DIFF_SQL}, a.q AS query_id, round(b.ndcg - a.ndcg, 6) AS diff FROM item a JOIN item b ON a.q = b.q AND a.engine < b.engine")
def engine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.paired(items(spark, sf_dir), "ndcg_at_10").withColumn("diff", F.round("diff", 6))


@query(f"""WITH {ITEM_SQL}, d AS (SELECT {DIFF_SQL}, b.ndcg - a.ndcg AS diff FROM item a JOIN item b ON a.q = b.q AND a.engine < b.engine)
    SELECT engine_a, engine_b, count(*) FILTER (diff > 1e-6) AS wins, count(*) FILTER (diff < -1e-6) AS losses, count(*) FILTER (abs(diff) <= 1e-6) AS ties, round(avg(diff), 6) AS diff_mean FROM d GROUP BY ALL""")
def win_loss_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.win_loss_tie(E.paired(items(spark, sf_dir), "ndcg_at_10")).withColumn("diff_mean", F.round("diff_mean", 6))


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.bootstrap(E.paired(items(spark, sf_dir), "ndcg_at_10"))
    return out.select("engine_a", "engine_b", *[F.round(c, 6).alias(c) for c in ("diff_mean", "ci_low", "ci_high", "p_value")])
