"""Exact vector search by inner product, and the default embedder."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.shipping import ship
from lexmill.operators.best import Best, tile_rows
from lexmill.operators.chunking import hashed_embedding

#: So many query vectors are sent to the executors at a time; more are answered in further passes.
QUERY_BLOCK = 8192


def passage(text: Column) -> Column:
    return F.rtrim(F.concat(F.lit("passage: "), T.strip(F.coalesce(text, F.lit("")))))


def asked(text: Column) -> Column:
    return F.rtrim(F.concat(F.lit("query: "), T.strip(F.coalesce(text, F.lit("")))))


def embed(rows: DataFrame, text_col: str = "text", embedder: Callable[[str], np.ndarray] = hashed_embedding) -> DataFrame:
    """rows with an embedding of unit length (array<float>); the embedder is loaded once per worker."""
    ship(rows.sparkSession)

    @F.pandas_udf("array<float>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([embedder(t or "").astype(np.float32) for t in texts])

    return rows.withColumn("embedding", of(F.col(text_col)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest(rows: DataFrame, query: list[float], k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, score, rank) of one query, by expressions only; Spark keeps k rows per task."""
    asked_ = F.array(*[F.lit(float(x)) for x in query])
    own = rows.select(id_col, dot(F.col(vector_col), asked_).alias("score"))
    best = own.orderBy(F.desc(F.round("score", 9)), id_col).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("score", 9)), id_col)))  # k rows


def search(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", dims: int | None = None, skip_self: bool = False) -> DataFrame:
    """(query_id, id, score, rank): the k best rows of every query. Each task keeps k rows per query while it multiplies a tile of its rows at a time; query vectors go out in blocks of bounded size."""
    ship(rows.sparkSession)
    passes = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    out = None
    for b in range(passes):
        part = queries.select(F.col(id_col).cast("long").alias("q"), F.col(vector_col).alias("v")).where(F.pmod(F.xxhash64("q"), F.lit(passes)) == b).orderBy("q").collect()
        ids = np.array([r.q for r in part], np.int64)
        vectors = np.array([r.v for r in part], np.float64).reshape(len(part), -1)[:, :dims]
        found = _best(rows, ids, vectors, k, id_col, vector_col, dims, skip_self)
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), id_col)
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _best(rows: DataFrame, ids: np.ndarray, vectors: np.ndarray, k: int, id_col: str, vector_col: str, dims: int | None, skip_self: bool) -> DataFrame:
    each = lambda batches: _kept(batches, ids, vectors, k, id_col, dims, skip_self)
    own = rows.select(F.col(id_col).cast("long").alias(id_col), vector_col).where(F.col(vector_col).isNotNull())
    return own.mapInArrow(each, f"query_id long, {id_col} long, score double")


def _kept(batches: Iterator[pa.RecordBatch], ids: np.ndarray, vectors: np.ndarray, k: int, id_col: str, dims: int | None, skip_self: bool) -> Iterator[pa.RecordBatch]:
    found, step = Best(len(ids), k), tile_rows(len(ids))
    for batch in batches:
        for at in range(0, batch.num_rows if len(ids) else 0, step):
            tile = batch.slice(at, step)
            own = tile.column(0).to_numpy()
            x = np.stack(tile.column(1).to_numpy(zero_copy_only=False))[:, :dims].astype(np.float64)
            found.add(x @ vectors.T, own, own[:, None] != ids[None, :] if skip_self else None)
    q, i, s = found.rows()
    yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(i, pa.int64()), pa.array(s)], names=["query_id", id_col, "score"])
