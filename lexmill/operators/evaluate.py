"""Retrieval metrics, run tables and comparisons.

results: (engine, query_id, rank, page_start, page_end[, doc_id, char_start, char_end, n_chars]); gold: (query_id, page_start, page_end[, doc_id, char_start, char_end]).
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_overlap(start: Column, end: Column, g_start: Column, g_end: Column) -> Column:
    """Whether page spans touch; a missing or zero end is the start."""
    last = lambda s, e: F.coalesce(F.nullif(e, F.lit(0)), s)
    return ~((last(start, end) < g_start) | (start > last(g_start, g_end)))


def judged(results: DataFrame, gold: DataFrame, match_doc: bool = False) -> DataFrame:
    """results with relevant. Documents are compared only if asked for."""
    g = gold.select(F.col("query_id"), F.col("page_start").alias("g_start"), F.col("page_end").alias("g_end"), *([F.col("doc_id").alias("g_doc")] if match_doc else []))
    hit = page_overlap(F.col("page_start"), F.col("page_end"), F.col("g_start"), F.col("g_end"))
    if match_doc:
        hit = hit & (F.col("doc_id") == F.col("g_doc"))
    return results.join(g, "query_id").withColumn("relevant", hit)


def hit_at(k: int) -> Column:
    return F.coalesce(F.max(F.when((F.col("rank") <= k) & F.col("relevant"), 1).otherwise(0)), F.lit(0))


def mrr_at(k: int) -> Column:
    return F.coalesce(1.0 / F.min(F.when((F.col("rank") <= k) & F.col("relevant"), F.col("rank"))), F.lit(0.0))


def ndcg_at(k: int) -> Column:
    """Binary gains; the ideal list has the same gains sorted."""
    inside = (F.col("rank") <= k) & F.col("relevant")
    gain = F.sum(F.when(inside, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0))
    n = F.sum(F.when(inside, 1).otherwise(0)).cast("int")
    ideal = F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    return F.when(n > 0, gain / ideal).otherwise(F.lit(0.0))


def context_precision(chunks: DataFrame, gold: DataFrame) -> DataFrame:
    """(engine, query_id, context_precision): matched characters by all characters, 1 at most. Where either side has no span (null or -1), a page overlap counts the whole chunk."""
    span = lambda c: F.when(F.col(c) >= 0, F.col(c))
    g = gold.select("query_id", F.col("page_start").alias("g_start"), F.col("page_end").alias("g_end"), span("char_start").alias("gs"), span("char_end").alias("ge"))
    rows = chunks.join(g, "query_id").withColumn("cs", span("char_start")).withColumn("ce", span("char_end"))
    size = F.greatest(F.col("n_chars"), F.lit(1))
    spans = F.col("gs").isNotNull() & F.col("ge").isNotNull() & F.col("cs").isNotNull() & F.col("ce").isNotNull()
    matched = F.when(spans, F.greatest(F.lit(0), F.least("ce", "ge") - F.greatest("cs", "gs"))).when(page_overlap(F.col("page_start"), F.col("page_end"), F.col("g_start"), F.col("g_end")), size).otherwise(0)
    return rows.groupBy("engine", "query_id").agg(F.least(F.lit(1.0), F.sum(matched) / F.sum(size)).alias("context_precision"))


def item_metrics(first: DataFrame, final: DataFrame, gold: DataFrame, pre_k: int = 10, post_k: int = 5) -> DataFrame:
    """One row per engine and gold item: hits before and after reranking, MRR, nDCG and context precision. Items without results score 0."""
    engines = first.select("engine").distinct()
    every = engines.crossJoin(F.broadcast(gold.select("query_id", "tags")))  # engines: a handful
    pre = judged(first, gold).groupBy("engine", "query_id").agg(hit_at(pre_k).alias("pre_hit_at_k"), mrr_at(10).alias("mrr_at_10"), ndcg_at(10).alias("ndcg_at_10"))
    post = judged(final, gold).groupBy("engine", "query_id").agg(hit_at(post_k).alias("post_hit_at_k"))
    out = every.join(pre, ["engine", "query_id"], "left").join(post, ["engine", "query_id"], "left").join(context_precision(final, gold), ["engine", "query_id"], "left")
    return out.fillna(0, ["pre_hit_at_k", "post_hit_at_k", "mrr_at_10", "ndcg_at_10", "context_precision"])


METRICS = ("pre_hit_at_k", "post_hit_at_k", "mrr_at_10", "ndcg_at_10", "context_precision")


def aggregates(items: DataFrame) -> DataFrame:
    return items.groupBy("engine").agg(F.count(F.lit(1)).alias("items"), *[F.avg(m).alias(m) for m in METRICS])


def latency(timings: DataFrame, key: str = "key", ms: str = "ms") -> DataFrame:
    """(key, p50, p95, mean): percentiles interpolate linearly."""
    return timings.groupBy(key).agg(F.percentile(ms, F.lit(0.5)).alias("p50"), F.percentile(ms, F.lit(0.95)).alias("p95"), F.avg(ms).alias("mean"))


def per_tag(items: DataFrame) -> DataFrame:
    tags = F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(F.lit("untagged")))
    return items.withColumn("tag", F.explode(tags)).groupBy("engine", "tag").agg(F.count(F.lit(1)).alias("items"), *[F.avg(m).alias(m) for m in METRICS if m in items.columns])


def paired(items: DataFrame, metric: str) -> DataFrame:
    """(engine_a, engine_b, query_id, diff) for each pair of engines; items that both have."""
    own = items.select("engine", "query_id", F.col(metric).cast("double").alias("m"))
    a, b = own.withColumnsRenamed({"engine": "engine_a", "m": "a"}), own.withColumnsRenamed({"engine": "engine_b", "m": "b"})
    return a.join(b, "query_id").where("engine_a < engine_b").select("engine_a", "engine_b", "query_id", (F.col("b") - F.col("a")).alias("diff"))


def win_loss_tie(diffs: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return diffs.groupBy("engine_a", "engine_b").agg(count(F.col("diff") > tolerance).alias("wins"), count(F.col("diff") < -tolerance).alias("losses"), count(F.abs("diff") <= tolerance).alias("ties"), F.avg("diff").alias("diff_mean"))


def bootstrap(diffs: DataFrame, iterations: int = 1000, alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """(engine_a, engine_b, diff_mean, ci_low, ci_high, p_value): resampled means with the seed's hash as the source of chance.

    Poisson weights: each item counts a number of times drawn with mean 1, so an iteration needs no
    shuffle of items and all iterations are sums over one pass.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), "it", "query_id"), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
    ends = list(itertools.accumulate([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)]))
    weight = F.lit(0)
    for e in ends:
        weight = weight + (u > e).cast("int")
    each = diffs.withColumn("it", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1)))).withColumn("w", weight)
    means = each.groupBy("engine_a", "engine_b", "it").agg((F.sum(F.col("w") * F.col("diff")) / F.nullif(F.sum("w"), F.lit(0))).alias("m")).where("m is not null")
    tail = F.least(F.avg(F.when(F.col("m") <= 0, 1.0).otherwise(0.0)), F.avg(F.when(F.col("m") >= 0, 1.0).otherwise(0.0)))
    ci = means.groupBy("engine_a", "engine_b").agg(F.percentile("m", F.lit(alpha / 2)).alias("ci_low"), F.percentile("m", F.lit(1 - alpha / 2)).alias("ci_high"), F.least(F.lit(1.0), 2 * tail).alias("p_value"))
    return diffs.groupBy("engine_a", "engine_b").agg(F.avg("diff").alias("diff_mean")).join(ci, ["engine_a", "engine_b"])


def ablation_grid(engines: list[str]) -> list[dict]:
    """Configurations by suite; a top_k also sets both hybrid limits."""
    out = [{"suite": "top_k", "engine": e, "top_k": k, "hybrid_top_k_semantic": k, "hybrid_top_k_lexical": k} for e in engines for k in (40, 80, 120)]
    out += [{"suite": "rerank_off", "engine": e, "rerank_top_n": 0} for e in engines]
    return out + [{"suite": "fusion", "engine": "hybrid", "fusion": f} for f in ("rrf", "weighted") if "hybrid" in engines]
