"""SQL names for the engine's functions, and hooks for other tokenizers, embedders, rerankers and models."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship


def register_tokenizer(spark: SparkSession, name: str, encode: Callable[[str], list]) -> None:
    """name(text) in SQL: how many tokens encode gives."""
    ship(spark)

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(encode(t or "")))

    spark.udf.register(name, count)


def register_embedder(spark: SparkSession, name: str, embed: Callable[[str], np.ndarray]) -> None:
    ship(spark)

    @F.pandas_udf("array<float>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.asarray(embed(t or ""), np.float32))

    spark.udf.register(name, of)


def register_reranker(spark: SparkSession, name: str, score: Callable[[str, str], float]) -> None:
    ship(spark)

    @F.pandas_udf("double")
    def of(queries: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([float(score(q or "", t or "")) for q, t in zip(queries, texts, strict=True)])

    spark.udf.register(name, of)
