"""The engine: ingest files or pages, build indexes, retrieve, evaluate, report."""

from __future__ import annotations

import copy
import hashlib
import json
import time
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import asdict, dataclass, fields, replace
from datetime import UTC, datetime
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.store import written
from lexmill.operators import chunking, evaluate, fusion, lexical, vector
from lexmill.operators import pages as P
from lexmill.sources import readers, writers

ENGINES = ("lexical", "semantic", "hybrid")


@dataclass(frozen=True)
class RetrievalConfig:
    engine: str = "semantic"
    top_k: int = 80
    rerank_top_n: int = 5
    rerank_batch: int = 32
    context_tokens: int = 2800
    mmr_lambda: float = 0.5
    per_doc_cap: int = 2
    cache_size: int = 64
    fusion: str = "rrf"
    rrf_k: int = 60
    w_semantic: float = 0.6
    w_lexical: float = 0.4
    hybrid_top_k_semantic: int = 80
    hybrid_top_k_lexical: int = 80
    truncate_rerank: bool = False

    @classmethod
    def of(cls, **knobs) -> RetrievalConfig:
        """Unknown knobs are ignored; an unknown engine is semantic."""
        known = {f.name for f in fields(cls)}
        made = cls(**{k: v for k, v in knobs.items() if k in known})
        return made if made.engine in ENGINES else replace(made, engine="semantic")


class Cache:
    """Results by engine, query and the whole configuration; the least recently used goes first."""

    def __init__(self, size: int) -> None:
        self.size, self.rows = size, OrderedDict()

    def key(self, config: RetrievalConfig, query: str) -> str:
        return hashlib.sha1(json.dumps([asdict(config), query.strip().lower()], sort_keys=True).encode()).hexdigest()

    def get(self, key: str):
        if key not in self.rows:
            return None
        self.rows.move_to_end(key)
        return copy.deepcopy(self.rows[key])

    def put(self, key: str, value) -> None:
        self.rows[key] = copy.deepcopy(value)
        self.rows.move_to_end(key)
        while len(self.rows) > self.size:
            self.rows.popitem(last=False)


@dataclass
class Indexes:
    chunks: DataFrame
    lexical: lexical.Index
    semantic: bool
    fingerprint: str
    embedder: Callable[[str], np.ndarray]
    cache: Cache
    notices: list[str]


class Lists(NamedTuple):
    """What a configuration finds for some queries, with the stages' times (ms) and notices; fusion_counts (hybrid only): per query, how many come from either side and both."""

    first_pass: DataFrame
    reranked: DataFrame
    context: DataFrame
    timings: dict[str, float]
    notices: list[str]
    fusion_counts: DataFrame | None


class Engine:
    def __init__(self, spark: SparkSession, embedders: list[Callable[[str], np.ndarray]] | None = None, scorer: Callable[[Column, Column], Column] = fusion.overlap_score) -> None:
        self.spark, self.embedders, self.scorer = spark, embedders or [chunking.hashed_embedding], scorer
        self.indexes: Indexes | None = None

    def ingest(self, paths: list[str], mode: str = "semantic", pdf=None, per_doc: int = 800, total: int = 1200) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(pages, chunks, report) of files."""
        raw, report = readers.read_documents(self.spark, paths, per_doc, total, pdf)
        pages = written(P.with_offsets(written(P.clean_pages(written(raw, "raw")), "clean")), "pages")
        return pages, self.chunk(pages, mode), report

    def chunk(self, pages: DataFrame, mode: str = "semantic") -> DataFrame:
        return written(chunking.chunk_documents(pages, mode), "chunks")

    def build_indexes(self, chunks: DataFrame, config: RetrievalConfig | None = None) -> Indexes:
        """Chunks with embeddings, kept; built anew only if the chunks' fingerprint changed. An embedder that fails is followed by the next; without any, retrieval is lexical."""
        config = config or RetrievalConfig()
        chunks = chunks.withColumn("chunk_id", F.col("chunk_id").cast("string"))
        print_ = chunking.fingerprint(chunks).first()["fingerprint"]
        if self.indexes and self.indexes.fingerprint == print_:
            return self.indexes
        notices = []
        for embedder in self.embedders:
            try:
                embedder("probe")
            except Exception as e:  # a model that cannot be loaded; the next one is tried
                notices.append(f"embedder failed: {e}")
                continue
            ready = written(vector.embed(chunks, "text", embedder), "index")
            self.indexes = Indexes(ready, lexical.build(ready, "chunk_id"), True, print_, embedder, Cache(config.cache_size), notices)
            return self.indexes
        ready = written(chunks.withColumn("embedding", F.lit(None).cast("array<float>")), "index")
        self.indexes = Indexes(ready, lexical.build(ready, "chunk_id"), False, print_, chunking.hashed_embedding, Cache(config.cache_size), notices)
        return self.indexes

    def status(self) -> DataFrame:
        """One row: what is indexed, and whether vectors are."""
        i = self.indexes
        counts = i.chunks.agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct("doc_id").alias("documents"), F.sum("token_len").cast("long").alias("tokens"))
        return counts.select(F.lit("index").alias("name"), "chunks", "documents", "tokens", F.lit(i.semantic).alias("semantic"), F.lit(i.fingerprint).alias("fingerprint"), F.array(*map(F.lit, i.notices)).cast("array<string>").alias("notices"))

    def chunk_view(self) -> DataFrame:
        """Chunks as a reader sees them: previews, page labels and sizes."""
        return self.indexes.chunks.select("chunk_id", "doc_id", chunking.page_label(F.col("page_start"), F.col("page_end")).alias("page"), "token_len", chunking.preview(F.col("text")).alias("shown"))

    def debug_view(self, query: str, config: RetrievalConfig | None = None) -> DataFrame:
        """Each candidate of a query with its places in the first pass, after reranking and in the context."""
        lists = self.retrieve_all(self.spark.createDataFrame([("q", query)], "query_id string, query string"), config or RetrievalConfig())
        first = lists.first_pass.select("chunk_id", "doc_id", F.col("rank").alias("first_rank"), F.col("score").alias("first_score"), chunking.preview(F.col("text")).alias("shown"))
        return first.join(lists.reranked.select("chunk_id", "rerank_rank", "rerank_score"), "chunk_id", "left").join(lists.context.select("chunk_id", "context_rank"), "chunk_id", "left")

    def engine_for(self, asked: str) -> tuple[str, str | None]:
        """The engine that can run, and why it is another one."""
        i = self.indexes
        if i is None or not (i.lexical or i.semantic):
            raise RuntimeError("no index is built")
        if asked in ("semantic", "hybrid") and not i.semantic:
            return "lexical", f"{asked} is not available; lexical is used"
        if asked == "hybrid" and not i.lexical:
            return "semantic", "hybrid is not available; semantic is used"
        return asked, None

    def retrieve_all(self, queries: DataFrame, config: RetrievalConfig) -> Lists:
        """queries(query_id, query) -> first pass, reranked and context lists, kept for further use; blank queries give no rows."""
        i = self.indexes
        engine, _ = self.engine_for(config.engine)
        timings: dict[str, float] = {}
        notices: list[str] = []

        def timed(key: str, rows: DataFrame) -> DataFrame:
            began = time.perf_counter()
            out = written(rows, key)
            timings[key] = 1000 * (time.perf_counter() - began)
            return out

        began = time.perf_counter()
        asked = queries.where(F.trim("query") != "")
        chunks = i.chunks

        def lexical_list(k: int) -> DataFrame:
            found = lexical.search(chunks, asked.select("query_id", F.col("query").alias("text")), k, "chunk_id", "query_id", index=i.lexical)
            return timed("bm25", found.select("query_id", "chunk_id", "score", "rank"))

        def semantic_list(k: int, key: str) -> DataFrame:
            numbered = chunks.select("chunk_id", "embedding").withColumn("vec_id", F.xxhash64("chunk_id"))
            q = timed("encode", vector.embed(asked.select("query_id", vector.asked(F.col("query")).alias("text")), "text", i.embedder).withColumn("vec_id", F.xxhash64("query_id")))
            found = vector.search(numbered, q, k).withColumnRenamed("query_id", "q")
            named = found.join(q.select("query_id", F.col("vec_id").alias("q")), "q").join(numbered.select("vec_id", "chunk_id"), "vec_id")
            return timed(key, fusion.with_ranks(named.select("query_id", "chunk_id", "score"), [F.desc(F.round("score", 9)), F.col("chunk_id")]))

        counts = None
        if engine == "hybrid":
            semantic, words = semantic_list(config.hybrid_top_k_semantic, "vectors"), lexical_list(config.hybrid_top_k_lexical)
            first = timed("fusion", fusion.fuse(semantic, words, config.fusion, config.rrf_k, config.w_semantic, config.w_lexical, config.hybrid_top_k_semantic, config.hybrid_top_k_lexical).withColumn("score", F.col("fused")))
            counts = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("fused"), F.count("semantic_rank").alias("semantic"), F.count("lexical_rank").alias("lexical"), F.sum((F.col("semantic_rank").isNotNull() & F.col("lexical_rank").isNotNull()).cast("long")).alias("both"))
        else:
            first = semantic_list(config.top_k, "search") if engine == "semantic" else lexical_list(config.top_k)
        place = [F.col(c).cast("int").alias(c) if c in chunks.columns else F.lit(None).cast("int").alias(c) for c in ("char_start", "char_end")]
        record = chunks.select("chunk_id", "doc_id", "page_start", "page_end", *place, "text", "token_len", "embedding")
        first = timed("records", first.join(record, "chunk_id").join(asked, "query_id"))
        try:
            reranked = timed("rerank", fusion.rerank(first, config.rerank_top_n, self.scorer, config.truncate_rerank))
            if reranked.isEmpty() and not first.isEmpty():
                raise ValueError("it returned nothing")
        except Exception as e:  # a scorer can raise anything; the first pass stands in for it
            notices.append(f"reranker failed: {e}".splitlines()[0][:300])
            reranked = timed("rerank", first.where(F.col("rank") <= max(config.rerank_top_n, 1)).withColumn("rerank_score", F.lit(0.0)).withColumn("rerank_rank", F.col("rank")))
        listed = reranked.withColumn("score", F.col("rerank_score")).withColumn("rank", F.col("rerank_rank"))
        context = timed("pack", fusion.pack_context(listed.select("query_id", "chunk_id", "doc_id", "score", "rank", "token_len", "embedding"), config.context_tokens, config.mmr_lambda, config.per_doc_cap))
        timings["total"] = 1000 * (time.perf_counter() - began)
        return Lists(first, listed, context, timings, notices, counts)

    def retrieve(self, query: str, config: RetrievalConfig | None = None) -> dict:
        """One query's lists, provenance and timings (ms); repeated queries come from the cache, marked so."""
        config = config or RetrievalConfig()
        empty = {"final_chunks": [], "pre_candidates": [], "rerank_candidates": [], "provenance": {"notices": []}, "timings": {"total": 0.0}}
        if not query.strip():
            return empty
        key = self.indexes.cache.key(config, query)
        if found := self.indexes.cache.get(key):
            found["provenance"]["cache_hit"] = True
            return found
        began = time.perf_counter()
        engine, notice = self.engine_for(config.engine)
        lists = self.retrieve_all(self.spark.createDataFrame([("q", query)], "query_id string, query string"), config)
        rows = lambda found, order: [{k: v for k, v in r.asDict().items() if k != "embedding"} for r in found.orderBy(order).collect()]  # noqa: E731  as many as top_k
        out = {"final_chunks": rows(lists.context, "context_rank"), "pre_candidates": rows(lists.first_pass, "rank"), "rerank_candidates": rows(lists.reranked, "rank")}
        out["provenance"] = {"engine": engine, "notices": [*self.indexes.notices, *([notice] if notice else []), *lists.notices], "first_pass": out["pre_candidates"][:10], "rerank": out["rerank_candidates"][:10], "cache_hit": False}
        if lists.fusion_counts is not None:
            counts = lists.fusion_counts.first()
            out["provenance"]["fusion"] = {k: v for k, v in counts.asDict().items() if k != "query_id"} if counts else {}
            out["provenance"]["fused_debug"] = [{k: r[k] for k in ("chunk_id", "fused", "semantic_rank", "lexical_rank", "rank")} for r in out["pre_candidates"][:5]]
        out["timings"] = {**lists.timings, "total": 1000 * (time.perf_counter() - began)}
        self.indexes.cache.put(key, out)
        return out

    def evaluate(self, gold: DataFrame, configs: list[RetrievalConfig], folder: str | None = None, labels: list[str] | None = None) -> dict[str, DataFrame]:
        """gold(query_id, query, page_start, page_end, char_start, char_end, tags) under several configurations; indexes are built once. Run files go to folder if given.

        A configuration is known by its label: its engine, with a number where several have the same engine.
        """
        engines = [c.engine for c in configs]
        labels = labels or [e if engines.count(e) == 1 else f"{e}-{engines[:k].count(e) + 1}" for k, e in enumerate(engines)]
        if len(set(labels)) < len(configs):
            raise ValueError("labels must differ")
        gold = written(gold, "gold")  # each configuration and each metric reads it
        first, final, timings = None, None, []
        for config, label in zip(configs, labels, strict=True):
            lists = self.retrieve_all(gold.select("query_id", "query"), config)
            timings += [(label, k, ms) for k, ms in lists.timings.items()]
            own = [F.lit(label).alias("engine"), "query_id", "rank", "page_start", "page_end", "char_start", "char_end", F.length("text").alias("n_chars")]
            a, b = lists.first_pass.select(*own), lists.reranked.where(F.col("rank") <= 5).select(*own)
            first, final = (a, b) if first is None else (first.unionByName(a), final.unionByName(b))
        items = written(evaluate.item_metrics(first, final, gold), "items")
        diffs = evaluate.paired(items, "ndcg_at_10")
        out = {"items": items, "aggregates": evaluate.aggregates(items), "per_tag": evaluate.per_tag(items), "comparisons": evaluate.win_loss_tie(diffs).join(evaluate.bootstrap(diffs).drop("diff_mean"), ["engine_a", "engine_b"])}
        took = self.spark.createDataFrame(timings, "engine string, key string, ms double")  # a few rows a configuration
        out["latency"] = took.groupBy("engine", "key").agg(F.percentile("ms", F.lit(0.5)).alias("p50"), F.percentile("ms", F.lit(0.95)).alias("p95"), F.avg("ms").alias("mean"))
        if folder:
            check = chunking.fingerprint(gold.select(F.col("query_id").cast("string").alias("chunk_id"), F.xxhash64(*sorted(gold.columns)).alias("token_len"))).first()["fingerprint"]
            speed = out["latency"].collect()
            for c, label in zip(configs, labels, strict=True):
                own = out["aggregates"].where(F.col("engine") == label).first()
                took_own = {r.key: {"p50": r.p50, "p95": r.p95, "mean": r["mean"]} for r in speed if r.engine == label}
                writers.run_file(self.spark, label, asdict(c), own.asDict() if own else {}, took_own, items.where(F.col("engine") == label), f"{folder}/{label}_run.json", check, datetime.now(UTC).isoformat())
            names = ("aggregates", "per_tag", "comparisons", "latency")
            for name in names:
                writers.csv(out[name], f"{folder}/{name}.csv")
            writers.one_text(self.spark, writers.html_report({k: out[k] for k in names}), f"{folder}/report.html")
        return out

    def ablation(self, gold: DataFrame, engines: list[str], folder: str | None = None) -> dict[str, DataFrame]:
        """evaluate() over the ablation grid; a label names the suite, the engine and what the suite varies."""
        grid = evaluate.ablation_grid(engines)
        knob = {"top_k": "top_k", "rerank_off": "rerank_top_n", "fusion": "fusion"}
        labels = [f"{g['suite']}-{g['engine']}-{g[knob[g['suite']]]}" for g in grid]
        return self.evaluate(gold, [RetrievalConfig.of(**g) for g in grid], folder, labels)
