"""Training rows for the classifiers: a bounded sample of the labelled documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A classifier learns from so many labelled rows at most, the first in the order of a hash of their ids, and of these from the first with so many
#: characters in all (20,000 a row on average); both are parameters of sample().
SAMPLE_ROWS = 6_000
SAMPLE_CHARS = 120_000_000


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by))


def sample(docs: DataFrame, labels: DataFrame, label: str, by: int, held_out: int, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> pd.DataFrame:
    """(id, text, y) of labelled rows that are not held out. Rows with a null label or id are not used; an id's smallest label and text count."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    own = own.where(remainder(F.col("id"), by) != held_out).groupBy("id").agg(F.min("y").alias("y"))
    own = own.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(own), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    out = []
    left = chars
    for r in found.orderBy(F.xxhash64("id"), "id").toLocalIterator():
        left -= len(r.text)
        if left < 0 and out:
            break
        out.append((r.id, r.text, r.y))
    return pd.DataFrame(out, columns=["id", "text", "y"])
