"""Fusion of ranked lists, reranking and context packing. A list: (query_id, chunk_id, score, rank)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.shipping import ship

_Q = "query_id"


def with_ranks(rows: DataFrame, order: list[Column], by: str = _Q) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))


def min_max(rows: DataFrame, by: str = _Q) -> DataFrame:
    """rows with norm: scores from 0 to 1 within the list, or 1 if all are close to equal."""
    w = Window.partitionBy(by)
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    close = F.abs(hi - lo) <= 1e-9 * F.greatest(F.abs(hi), F.abs(lo))
    return rows.withColumn("norm", F.when(close, 1.0).otherwise((F.col("score") - lo) / F.nullif(hi - lo, F.lit(0.0))))


def _both(semantic: DataFrame, lexical: DataFrame) -> DataFrame:
    side = lambda rows, name: min_max(rows).select(_Q, "chunk_id", F.col("score").alias(f"{name}_score"), F.col("rank").alias(f"{name}_rank"), F.col("norm").alias(f"{name}_norm"))
    return side(semantic, "semantic").join(side(lexical, "lexical"), [_Q, "chunk_id"], "full_outer")


def _ordered(rows: DataFrame, limit: int) -> DataFrame:
    order = [F.desc(F.round("fused", 12)), F.desc_nulls_last("semantic_score"), F.desc_nulls_last("lexical_score"), F.col("chunk_id")]
    return with_ranks(rows, order).where(F.col("rank") <= limit).drop("semantic_norm", "lexical_norm")


def rrf(semantic: DataFrame, lexical: DataFrame, k: int = 60, limit: int = 80) -> DataFrame:
    part = lambda c: F.coalesce(1 / (F.lit(max(k, 1)) + F.col(c)), F.lit(0.0))
    return _ordered(_both(semantic, lexical).withColumn("fused", part("semantic_rank") + part("lexical_rank")), limit)


def weighted(semantic: DataFrame, lexical: DataFrame, w_semantic: float = 0.6, w_lexical: float = 0.4, limit: int = 80) -> DataFrame:
    fused = w_semantic * F.coalesce("semantic_norm", F.lit(0.0)) + w_lexical * F.coalesce("lexical_norm", F.lit(0.0))
    return _ordered(_both(semantic, lexical).withColumn("fused", fused), limit)


def fuse(semantic: DataFrame, lexical: DataFrame, method: str = "rrf", k: int = 60, w_semantic: float = 0.6, w_lexical: float = 0.4, top_semantic: int = 80, top_lexical: int = 80) -> DataFrame:
    """Each side's best, fused; any method but ``weighted`` is rrf."""
    a, b, limit = semantic.where(F.col("rank") <= top_semantic), lexical.where(F.col("rank") <= top_lexical), max(top_semantic, top_lexical)
    return weighted(a, b, w_semantic, w_lexical, limit) if method == "weighted" else rrf(a, b, k, limit)


def overlap_score(query: Column, text: Column) -> Column:
    """The default reranker: the share of the query's distinct words that the text has."""
    q = F.array_distinct(T.words(query))
    return F.when(F.size(q) > 0, F.size(F.array_intersect(q, T.words(text))) / F.size(q)).otherwise(F.lit(0.0))


def rerank(candidates: DataFrame, top_n: int, scorer=overlap_score, truncate: bool = False) -> DataFrame:
    """candidates(query_id, chunk_id, query, text, rank) scored anew. top_n <= 0: all pass with score 0. The list is cut only if asked for."""
    if top_n <= 0:
        return candidates.withColumn("rerank_score", F.lit(0.0)).withColumn("rerank_rank", F.col("rank"))
    scored = candidates.withColumn("rerank_score", scorer(F.col("query"), F.col("text")))
    order = Window.partitionBy(_Q).orderBy(F.desc("rerank_score"), "rank")
    out = scored.withColumn("rerank_rank", F.row_number().over(order))
    return out.where(F.col("rerank_rank") <= top_n) if truncate else out


def per_doc_cap(rows: DataFrame, cap: int, doc_col: str = "doc_id", by: str = _Q, order: str | list[Column] = "rank") -> DataFrame:
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(by, doc_col).orderBy(order))).where(F.col("_k") <= cap).drop("_k")


def budget_pack(rows: DataFrame, budget: int, by: str = _Q) -> DataFrame:
    """The longest prefix of each list that the token budget admits, its first row in any case."""
    order = Window.partitionBy(by).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.when(F.col("token_len") > 0, F.col("token_len")).otherwise(1)).over(order)
    return rows.withColumn("used", run).where((F.col("used") <= budget) | (F.col("rank") == 1))


def select_for_context(ids: list, scores: list[float], docs: list, tokens: list[int], vectors: list | None, budget: int = 2800, weight: float = 0.5, cap: int = 2) -> list[int]:
    """Positions of a maximal-marginal-relevance choice, by falling score.

    The first pick goes by the score alone; later ones by weight * score - (1 - weight) * the largest
    similarity to a pick (weight * score without vectors). An earlier candidate wins ties; one beyond
    the budget is dropped unless nothing is chosen yet.
    """
    left = list(dict.fromkeys(ids))
    place = {c: ids.index(c) for c in left}
    chosen: list[int] = []
    used, per = 0, {}
    while left:
        best, best_value = None, None
        for c in left:
            i = place[c]
            if per.get(docs[i], 0) >= cap:
                continue
            value = scores[i]
            if chosen:
                value = weight * scores[i]
                if vectors is not None and vectors[i] is not None:
                    near = [float(np.dot(vectors[i], vectors[j])) for j in chosen if vectors[j] is not None]
                    value -= (1 - weight) * max(near) if near else 0.0
            if best is None or value > best_value:
                best, best_value = c, value
        if best is None:
            break
        left.remove(best)
        i = place[best]
        n = tokens[i] if tokens[i] > 0 else 1
        if used + n > budget and chosen:
            continue
        chosen.append(i)
        used += n
        per[docs[i]] = per.get(docs[i], 0) + 1
    return sorted(chosen, key=lambda i: -scores[i])


def pack_context(rows: DataFrame, budget: int = 2800, weight: float = 0.5, cap: int = 2) -> DataFrame:
    """rows(query_id, chunk_id, doc_id, score, rank, token_len, embedding) -> (query_id, chunk_id, doc_id, score, context_rank). A list is as long as the rerankers' candidates, not as the corpus."""
    ship(rows.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        f = frame.sort_values("rank").reset_index(drop=True)
        picked = select_for_context(f["chunk_id"].tolist(), f["score"].tolist(), f["doc_id"].tolist(), f["token_len"].tolist(), f["embedding"].tolist(), budget, weight, cap)
        out = f.loc[picked, [_Q, "chunk_id", "doc_id", "score"]]
        return out.assign(context_rank=range(1, len(out) + 1))

    return rows.groupBy(_Q).applyInPandas(each, f"{_Q} {kinds[_Q]}, chunk_id {kinds['chunk_id']}, doc_id {kinds['doc_id']}, score double, context_rank int")


def normalised_chunks(raw: DataFrame) -> DataFrame:
    """Chunk records with defaults: the id is id, chunk_id or chunk_key, or chunk-{pos}."""
    have = set(raw.columns)
    pick = lambda *names: F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in have], F.lit(None).cast("string"))
    number = lambda n: (F.coalesce(F.col(n).cast("int"), F.lit(0)) if n in have else F.lit(0)).alias(n)
    return raw.select(F.coalesce(pick("id", "chunk_id", "chunk_key"), F.concat(F.lit("chunk-"), F.col("pos").cast("string"))).alias("id"), F.coalesce(pick("text"), F.lit("")).alias("text"), F.coalesce(pick("doc_id"), F.lit("")).alias("doc_id"), F.coalesce(pick("doc_name", "doc_id"), F.lit("")).alias("doc_name"), number("page_start"), number("page_end"), number("token_len"))
