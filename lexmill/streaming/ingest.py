"""Streaming ingest: text files as they arrive, cleaned and appended as pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lexmill.functions import text as T


def page_stream(spark: SparkSession, folder: str, max_pages: int = 800) -> DataFrame:
    """(file_name, page_num, text) of each new text file of a folder."""
    lines = spark.readStream.format("text").option("wholetext", True).load(folder)
    rows = lines.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file_name"), F.posexplode(F.slice(F.split("value", "\f", -1), 1, max_pages)).alias("at", "text"))
    return rows.select("file_name", (F.col("at") + 1).cast("long").alias("page_num"), T.clean_block(F.col("text")).alias("text"))


def ingest(spark: SparkSession, folder: str, to: str, checkpoint: str, max_pages: int = 800) -> StreamingQuery:
    """Appends the pages of new files to a Parquet table, each file once; ends when all present files are read."""
    return page_stream(spark, folder, max_pages).writeStream.format("parquet").option("path", to).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
