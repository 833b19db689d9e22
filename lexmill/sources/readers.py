"""Readers: text, Markdown, JSON, JSON lines, CSV and (through an adapter) PDF files to tables."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.functions.store import written
from lexmill.operators import pages as P

PARSED_DOC = "doc_id string, doc_name string, pages array<struct<page_num:int,text:string>>"
GOLD = "id string, question string, doc_id string, page_start int, page_end int, answer_text string, char_start int, char_end int, tags array<string>, hard_negative_ids array<string>"
CHUNK = "id string, chunk_id string, chunk_key string, doc_id string, doc_name string, page_start int, page_end int, text string, token_len int, meta map<string,string>"
SUFFIXES = ("txt", "md", "pdf")


def text_pages(spark: SparkSession, paths: list[str] | str, max_pages: int = 800) -> DataFrame:
    """Text and Markdown files: pages between form feeds, the first max_pages; bytes that are not UTF-8 become replacement characters."""
    own = spark.read.format("binaryFile").load(paths)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return _pages(own.withColumn("pages", F.split(F.coalesce(text, F.lit("")), "\f", -1)), max_pages)


def _pages(files: DataFrame, max_pages: int) -> DataFrame:
    """(path, doc_id, file_name, page_num, text, truncated) of files with their page texts."""
    name = F.element_at(F.split("path", "/"), -1)
    doc = P.doc_id(name, F.col("length"), F.unix_seconds("modificationTime"))
    rows = files.select("path", doc.alias("doc_id"), name.alias("file_name"), F.size("pages").alias("n_pages"), F.posexplode(F.slice("pages", 1, max(max_pages, 1))).alias("at", "text"))
    return rows.where(F.lit(max_pages > 0)).select("path", "doc_id", "file_name", (F.col("at") + 1).cast("long").alias("page_num"), "text", (F.col("n_pages") > max_pages).alias("truncated"))


def _extracted(spark: SparkSession, paths: list[str] | str, max_pages: int, fetch: Callable[[bytes, int], list], kind: str) -> DataFrame:
    """(path, length, modificationTime, found, error): what ``fetch`` gets from each file, or why it failed; one broken file stops no other."""
    ship(spark)

    def tried(content: bytes) -> tuple[list, str | None]:
        try:
            return list(fetch(content, max_pages)), None
        except Exception as e:  # an extractor can raise anything; the file is reported
            return [], f"{type(e).__name__}: {e}"

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [tried(bytes(c)) for c in f["content"]]
            yield f.drop(columns=["content"]).assign(found=[x for x, _ in found], error=[e for _, e in found])

    own = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime", "content")
    return own.mapInPandas(each, f"path string, length long, modificationTime timestamp, found {kind}, error string")


def pdf_files(spark: SparkSession, paths: list[str] | str, max_pages: int = 800, extract: Callable[[bytes, int], list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages, errors) of PDF files through ``extract`` (content, max_pages) -> page texts; pypdf where it is installed. errors: (path, error)."""
    own = written(_extracted(spark, paths, max_pages, extract or _pypdf, "array<string>"), "extracted")
    return _pages(own.where("error is null").withColumn("pages", F.col("found")), max_pages), own.where("error is not null").select("path", "error")


def pdf_pages(spark: SparkSession, paths: list[str] | str, max_pages: int = 800, extract: Callable[[bytes, int], list[str]] | None = None) -> DataFrame:
    """The pages of pdf_files(). A page that cannot be read is empty, an encrypted file is tried with an empty password, a broken file has none."""
    return pdf_files(spark, paths, max_pages, extract)[0]


def layout_pages(spark: SparkSession, paths: list[str] | str, max_pages: int, extract: Callable[[bytes, int], list[tuple[int | None, str]]]) -> tuple[DataFrame, DataFrame]:
    """(pages, errors) of files through a layout extractor: ``extract`` (content, max_pages) -> elements (page number or None, text) in reading order."""
    fetch = lambda content, n: [{"page_number": p, "text": t} for p, t in extract(content, n)]
    own = written(_extracted(spark, paths, max_pages, fetch, "array<struct<page_number:int,text:string>>"), "extracted")
    elements = own.where("error is null").select(F.col("path").alias("doc_id"), F.posexplode("found").alias("ord", "e")).select("doc_id", "ord", "e.page_number", "e.text")
    texts = P.regroup_elements(elements).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_num", "text"))), lambda x: x["text"]).alias("pages"))
    files = own.join(texts.withColumnRenamed("doc_id", "path"), "path")
    return _pages(files, max_pages), own.where("error is not null").select("path", "error")


def _pypdf(content: bytes, max_pages: int) -> list[str]:
    import io

    from pypdf import PdfReader

    reader = PdfReader(io.BytesIO(content))
    if reader.is_encrypted:
        reader.decrypt("")
    out = []
    for page in reader.pages[:max_pages]:
        try:
            out.append(page.extract_text() or "")
        except ValueError:
            out.append("")
    return out


def plan_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_ord, path, full, suffix, reject): full is the path as readers name it; rejects are missing files and unknown suffixes; no exception is raised for them."""
    rows = []
    for i, p in enumerate(paths):
        suffix = os.path.splitext(p)[1].lower().lstrip(".")
        hpath = spark._jvm.org.apache.hadoop.fs.Path(p)
        system = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
        there, full = system.exists(hpath), system.makeQualified(hpath).toString()
        rows.append((i, p, full, suffix, "missing" if not there else None if suffix in SUFFIXES else "unsupported"))
    return spark.createDataFrame(rows, "file_ord long, path string, full string, suffix string, reject string")


def read_documents(spark: SparkSession, paths: list[str], per_doc: int = 800, total: int = 1200, pdf: Callable[[bytes, int], list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages, report) of many files under both page budgets, in the order given. The paths are a list that the caller typed, so it is planned on the driver.

    Files of one name in different folders are files of their own. What is missing, unknown or broken is in skipped_docs.
    """
    plan = plan_files(spark, paths).collect()
    good = [r for r in plan if not r.reject]
    plain, pdfs = [r.path for r in good if r.suffix != "pdf"], [r.path for r in good if r.suffix == "pdf"]
    raw = spark.createDataFrame([], "path string, doc_id string, file_name string, page_num long, text string, truncated boolean")
    bad = [f"{os.path.basename(r.path)}: {r.reject}" for r in plan if r.reject]
    if plain:
        raw = raw.unionByName(text_pages(spark, plain, per_doc))
    if pdfs:
        pages, errors = pdf_files(spark, pdfs, per_doc, pdf)
        raw = raw.unionByName(pages)
        broken = {r.path: r.error for r in errors.collect()}  # some of the typed paths
        bad += [f"{os.path.basename(r.path)}: {broken[r.full]}" for r in good if r.full in broken]
        good = [r for r in good if r.full not in broken]
    order = spark.createDataFrame([(r.file_ord, r.full, os.path.basename(r.path)) for r in good], "file_ord long, path string, file_name string")
    sizes = raw.groupBy("path").agg(F.count(F.lit(1)).alias("planned_pages"))
    budget = P.page_budget(order.join(sizes, "path", "left").fillna(0, ["planned_pages"]), per_doc, total)
    pages = raw.drop("truncated").join(budget.select("path", "file_ord", "allowed", "truncated"), "path").where(F.col("page_num") <= F.col("allowed")).drop("allowed", "path")
    report = P.run_report(budget)
    return pages, report.withColumn("skipped_docs", F.concat("skipped_docs", F.array(*map(F.lit, bad)) if bad else F.array().cast("array<string>")))


def parsed_docs(spark: SparkSession, folder: str, drop_empty: bool = True) -> DataFrame:
    """A folder of parsed-document JSON files as pages; empty pages go if asked for; the name is the id where missing."""
    own = spark.read.schema(PARSED_DOC).json(f"{folder}/*.json", multiLine=True)
    rows = own.select("doc_id", F.coalesce("doc_name", "doc_id").alias("doc_name"), F.explode("pages").alias("p")).select("doc_id", "doc_name", F.col("p.page_num").cast("long").alias("page_num"), F.coalesce("p.text", F.lit("")).alias("text"))
    return rows.where(F.trim("text") != "") if drop_empty else rows


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def _records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    suffix = os.path.splitext(path)[1].lower()
    if suffix in (".jsonl", ".ndjson"):
        return spark.read.schema(schema).json(path)
    if suffix == ".json":
        return spark.read.schema(schema).json(path, multiLine=True)
    raise ValueError(f"unsupported file type: {suffix}")


def gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold questions from JSON lines, a JSON list or CSV; lists in strings are cut at semicolons; numbers that are none become null."""
    if not path.lower().endswith(".csv"):
        return _records(spark, path, GOLD)
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    items = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    get = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    number = lambda c: get(c).try_cast("int").alias(c)
    lists = [(items(c) if c in raw.columns else F.array().cast("array<string>")).alias(c) for c in ("tags", "hard_negative_ids")]
    return raw.select(get("id").alias("id"), get("question").alias("question"), get("doc_id").alias("doc_id"), number("page_start"), number("page_end"), get("answer_text").alias("answer_text"), number("char_start"), number("char_end"), *lists)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    return _records(spark, path, CHUNK)


def runs(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """Run files by patterns (or plain paths), each once. An error if none is there."""
    found: set[str] = set()
    conf = spark._jsc.hadoopConfiguration()
    for p in patterns:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(p)
        found.update(s.getPath().toString() for s in hpath.getFileSystem(conf).globStatus(hpath) or [])
    if not found:
        raise FileNotFoundError(f"no runs match {patterns}")
    return spark.read.json(sorted(found), multiLine=True).withColumn("path", F.input_file_name())


def yaml_config(path: str) -> dict:
    """A YAML file as a dict; a missing one is empty."""
    if not Path(path).exists():
        return {}
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


_loaded: set[str] = set()


def load_env(path: str = ".env") -> None:
    """KEY=value lines into the environment, once per file; what is set already stays; comments and blank lines are skipped."""
    p = Path(path).resolve()
    if str(p) in _loaded or not p.exists():
        return
    _loaded.add(str(p))
    for line in p.read_text(encoding="utf-8").splitlines():
        key, eq, value = line.strip().partition("=")
        if eq and key and not key.startswith("#"):
            os.environ.setdefault(key.strip(), value.strip().strip("'\""))


def side_stats(folder: str, names: tuple[str, ...] = ("candidates_stats.json", "paraphrase_stats.json", "stats.json")) -> dict:
    """The first of some statistics files that is there and is JSON, else an empty dict."""
    for n in names:
        try:
            return json.loads((Path(folder) / n).read_text(encoding="utf-8"))
        except (OSError, ValueError):
            continue
    return {}


def response_cache(spark: SparkSession, path: str) -> DataFrame:
    """(cache_key, response) of a cache table; empty where there is none. Broken entries (no key or no response) are left out."""
    schema = "cache_key string, response string"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where("cache_key is not null and response is not null").dropDuplicates(["cache_key"])
