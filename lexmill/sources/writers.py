"""Writers: JSON lines, statistics, run files, reports."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, in as many files as there are partitions; characters beyond ASCII stay as they are."""
    rows.write.mode(mode).json(path)


def one_json(spark: SparkSession, value: dict, path: str) -> None:
    """A small dict as one JSON file."""
    one_text(spark, json.dumps(value, ensure_ascii=False, indent=2, default=str), path)


def one_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file, through Spark's file systems."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(hpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def with_stats(rows: DataFrame, stats: dict, path: str, stats_path: str) -> None:
    json_lines(rows, path)
    one_json(rows.sparkSession, stats, stats_path)


def model_gold(items: DataFrame, path: str) -> None:
    """Kept items without their windows."""
    json_lines(items.where("reason is null").drop("window_text", "reason"), path)


def run_file(spark: SparkSession, engine: str, config: dict, aggregates: dict, latency: dict, items: DataFrame, path: str, gold_checksum: str, created_at: str) -> None:
    """A run's figures and items as one JSON; items are as many as gold questions."""
    rows = [r.asDict(recursive=True) for r in items.toLocalIterator()]
    one_json(spark, {"engine": engine, "config": config, "created_at": created_at, "gold_checksum": gold_checksum, "aggregates": aggregates, "latency": latency, "items": rows}, path)


def csv(rows: DataFrame, path: str) -> None:
    """A small table as one CSV file with a header."""
    rows.coalesce(1).write.mode("overwrite").csv(path, header=True)


def html_report(tables: dict[str, DataFrame], title: str = "Retrieval report") -> str:
    """Small tables as one HTML page."""
    parts = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, rows in tables.items():
        body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else f'{v:.4f}' if isinstance(v, float) else str(v))}</td>" for v in r) + "</tr>" for r in rows.collect())
        parts.append(f"<h2>{html.escape(name)}</h2><table border='1'><tr>{''.join(f'<th>{html.escape(c)}</th>' for c in rows.columns)}</tr>{body}</table>")
    return "\n".join(parts)


def gold_inputs(pages: DataFrame, chunks: DataFrame, folder: str) -> None:
    """Parsed documents (an object each, with pages and offsets) and chunks, for building question sets."""
    docs = pages.groupBy("doc_id", "doc_name").agg(F.array_sort(F.collect_list(F.struct("page_num", "text", "char_start", "char_end"))).alias("pages"))
    json_lines(docs, f"{folder}/parsed_docs")
    json_lines(chunks, f"{folder}/chunks.jsonl")


def cache_store(responses: DataFrame, path: str) -> None:
    responses.select("cache_key", "response").write.mode("append").parquet(path)
