"""Pages: cleaning, offsets, metrics, routing and budgets. pages: (doc_id, page_num, text, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T

#: A line that opens (or closes) this share of a document's pages, two at least, is a header (footer).
EDGE_SHARE, EDGE_LEAST = 0.6, 2


def running_sum(rows: DataFrame, by: str, order: str, value: Column, name: str, block: int = 4096) -> DataFrame:
    """rows with the sum of value over the rows before, within ``by`` by the integer ``order``.

    Two levels: sums within blocks of order, and of the blocks before; so a large group is spread over tasks.
    """
    rows = rows.withColumn("_block", F.floor(F.col(order) / F.lit(block))).withColumn("_value", value)
    within = Window.partitionBy(by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(by, "_block").agg(F.sum("_value").alias("_total"))
    before = totals.withColumn("_before", F.coalesce(F.sum("_total").over(Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    summed = rows.withColumn("_own", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    out = summed.join(before.select(by, "_block", "_before"), [by, "_block"])
    return out.withColumn(name, F.col("_before") + F.col("_own")).drop("_block", "_value", "_own", "_before")


def clean(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", T.clean_block(F.col("text")))


def _edge(line: Column) -> Column:
    return F.lower(T.strip(line))


def edge_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, headers, footers): normalised lines that are on enough first or last places of a document's pages."""
    own = pages.select("doc_id", F.filter(F.transform(T.lines(F.col("text")), _edge), lambda x: x != "").alias("ls"))
    sides = own.select("doc_id", F.explode(F.array(F.struct(F.lit("top").alias("side"), F.try_element_at("ls", F.lit(1)).alias("line")), F.struct(F.lit("end").alias("side"), F.try_element_at("ls", F.lit(-1)).alias("line")))).alias("e"))
    counts = sides.groupBy("doc_id", F.col("e.side").alias("side"), F.col("e.line").alias("line")).agg(F.count(F.lit(1)).alias("n"))
    total = pages.groupBy("doc_id").agg(F.greatest(F.lit(EDGE_LEAST), F.ceil(F.count(F.lit(1)) * F.lit(EDGE_SHARE))).alias("least"))
    often = counts.where("line is not null").join(total, "doc_id").where("n >= least")
    side = lambda s: F.coalesce(F.collect_set(F.when(F.col("side") == s, F.col("line"))), F.array().cast("array<string>"))
    return often.groupBy("doc_id").agg(side("top").alias("headers"), side("end").alias("footers"))


def strip_edges(pages: DataFrame) -> DataFrame:
    """pages without their headers and footers: consecutive matching lines from the top, then from the end."""
    none = F.array().cast("array<string>")
    rows = pages.join(edge_lines(pages), "doc_id", "left").withColumn("_lines", T.lines(F.col("text")))
    rows = rows.withColumn("_norm", F.transform("_lines", _edge)).withColumn("headers", F.coalesce("headers", none)).withColumn("footers", F.coalesce("footers", none))
    off = lambda norm, edges: F.aggregate(norm, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, x: F.struct((a["n"] + F.when(a["on"] & (x != "") & F.array_contains(edges, x), 1).otherwise(0)).alias("n"), (a["on"] & (x != "") & F.array_contains(edges, x)).alias("on")), lambda a: a["n"])
    rows = rows.withColumn("_top", off(F.col("_norm"), F.col("headers")))
    rows = rows.withColumn("_end", off(F.reverse(F.slice("_norm", F.col("_top") + 1, F.size("_norm"))), F.col("footers")))
    kept = F.slice("_lines", F.col("_top") + 1, F.greatest(F.lit(0), F.size("_lines") - F.col("_top") - F.col("_end")))
    return rows.withColumn("text", F.array_join(kept, "\n")).drop("_lines", "_norm", "_top", "_end", "headers", "footers")


def clean_pages(pages: DataFrame) -> DataFrame:
    """Clean, strip headers and footers, clean again."""
    return clean(strip_edges(clean(pages)))


def with_offsets(pages: DataFrame) -> DataFrame:
    """char_range: where the page lies in its document's text, without separators."""
    out = running_sum(pages, "doc_id", "page_num", F.length("text").cast("long"), "char_start")
    return out.withColumn("char_end", F.col("char_start") + F.length("text"))


def doc_id(name: Column, size: Column, modified: Column) -> Column:
    """The name alone where size or time are unknown."""
    return F.substring(F.sha1(F.when(size.isNull() | modified.isNull(), name).otherwise(F.concat_ws(":", name, size.cast("string"), modified.cast("long").cast("string")))), 1, 12)


def page_metadata(source: Column, strategy: Column, file_name: Column, **optional: Column) -> Column:
    """A map; optional keys stand only if they say something."""
    entries = [F.lit("source"), source, F.lit("strategy"), strategy, F.lit("file_name"), file_name]
    entries += [x for k, v in optional.items() for x in (F.lit(k), v)]
    fixed = ("source", "strategy", "file_name")
    return F.map_filter(F.create_map(*entries), lambda k, v: k.isin(*fixed) | (v.isNotNull() & ~v.isin("", "false")))


# ---- metrics


def density(pages: DataFrame, min_chars: int = 200) -> DataFrame:
    n = F.length("text")
    return pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total_pages"), F.sum(n).alias("total_chars"), F.avg(n).alias("avg_chars"),
        F.percentile(n.cast("double"), F.lit(0.5)).alias("median_chars"), F.avg(F.when(n < min_chars, 1.0).otherwise(0.0)).alias("empty_page_ratio"),
    )


def layout(pages: DataFrame) -> DataFrame:
    """Shares of short, blank and sign-heavy lines of a document, and their weighted score."""
    line = pages.select("doc_id", F.explode_outer(T.lines(F.col("text"))).alias("line")).select("doc_id", "line", F.length("line").alias("n"), F.length(T.strip(F.col("line"))).alias("s"))
    letters = F.length(F.regexp_replace("line", r"[^\p{L}]", ""))
    share = lambda c: F.avg(F.when(F.col("line").isNotNull(), F.when(c, 1.0).otherwise(0.0)))
    own = line.groupBy("doc_id").agg(
        F.coalesce(share(F.col("s") < 40), F.lit(0.0)).alias("short_line_ratio"), F.coalesce(share(F.col("s") == 0), F.lit(0.0)).alias("gap_line_ratio"),
        F.coalesce(share((F.col("n") > 0) & ((F.col("n") - letters) / F.greatest("n", F.lit(1)) >= 0.6)), F.lit(0.0)).alias("digit_symbol_ratio"),
    )
    return own.withColumn("layout_complexity", 0.4 * F.col("short_line_ratio") + 0.3 * F.col("gap_line_ratio") + 0.3 * F.col("digit_symbol_ratio"))


def histogram(pages: DataFrame, width: int = 200) -> DataFrame:
    """(doc_id, bin, share): shares of pages by length, bins char_hist_{from}_{to}."""
    low = (F.floor(F.length("text") / F.lit(width)) * width).cast("long")
    counts = pages.groupBy("doc_id", low.alias("low")).agg(F.count(F.lit(1)).alias("n"))
    total = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"))
    return counts.join(total, "doc_id").select("doc_id", F.concat(F.lit("char_hist_"), F.col("low").cast("string"), F.lit("_"), (F.col("low") + width).cast("string")).alias("bin"), (F.col("n") / F.col("total")).alias("share"))


def document_metrics(pages: DataFrame, min_chars: int = 200) -> DataFrame:
    """One row per document: density, layout and the histogram as a map."""
    bins = histogram(pages).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("bin", "share")))).alias("char_hist"))
    return density(pages, min_chars).join(layout(pages), "doc_id").join(bins, "doc_id")


def merge_stats(metrics: DataFrame, seconds: str | None = None) -> DataFrame:
    return metrics.agg(F.count(F.lit(1)).alias("total_docs"), F.sum("total_pages").alias("total_pages"), F.sum("total_chars").alias("total_chars"), F.avg("total_pages").alias("avg_pages_per_doc"), *([F.sum(seconds).alias("total_parse_seconds")] if seconds else []))


def fallback_reason(total_pages: Column, empty_ratio: Column, layout_score: Column, empty_limit: float = 0.3, layout_limit: float = 0.6) -> Column:
    """Why a document needs the layout extractor; null if it does not."""
    return F.when(total_pages == 0, "no_text_extracted").when(empty_ratio >= empty_limit, "empty_ratio").when(layout_score >= layout_limit, "layout_complexity")


def page_cap(limit: int, override: int | None) -> int:
    return limit if override is None else min(limit, max(override, 0))


def capped(pages: DataFrame, limit: int = 800, override: int | None = None) -> DataFrame:
    """The first pages of each document, with a flag where an override cut it."""
    most = page_cap(limit, override)
    number = Window.partitionBy("doc_id").orderBy("page_num")
    total = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    kept = pages.withColumn("_k", F.row_number().over(number)).where(F.col("_k") <= most).drop("_k")
    return kept.join(total, "doc_id").withColumn("truncated", (F.col("_n") >= most) & F.lit(most < limit)).drop("_n")


def strategy(requested: Column, hi_res: bool = False) -> Column:
    """struct(strategy, warning, hi_res_blocked): unknown names become fast, hi_res needs its flag, auto without it is warned about."""
    s = F.lower(F.trim(requested))
    known = F.when(s.isin("fast", "auto", "hi_res", "ocr_only"), s).otherwise("fast")
    blocked = (known == "hi_res") & F.lit(not hi_res)
    warning = F.when(blocked, "hi_res is off; fast is used").when((known == "auto") & F.lit(not hi_res), "auto may need hi_res, which is off")
    return F.struct(F.when(blocked, "fast").otherwise(known).alias("strategy"), warning.alias("warning"), blocked.alias("hi_res_blocked"))


def page_budget(files: DataFrame, per_doc: int = 800, total: int = 1200) -> DataFrame:
    """files(file_ord, planned_pages) with allowed pages: each file gets what the total leaves, and is skipped if that is nothing."""
    rows = running_sum(files.withColumn("_one", F.lit(1)), "_one", "file_ord", F.least("planned_pages", F.lit(per_doc)).cast("long"), "pages_before")
    allowed = F.greatest(F.lit(0), F.least(F.lit(per_doc), F.col("planned_pages"), F.lit(total) - F.col("pages_before"))).cast("long")
    return rows.drop("_one").withColumn("allowed", allowed).withColumn("skipped", F.lit(total) - F.col("pages_before") <= 0).withColumn("truncated", F.col("allowed") < F.col("planned_pages"))


def run_report(budget: DataFrame) -> DataFrame:
    """One row: total_docs, total_pages, truncated, skipped_docs, message."""
    skipped = F.array_sort(F.collect_list(F.when(F.col("skipped"), F.col("file_name"))))
    out = budget.agg(F.sum((~F.col("skipped")).cast("long")).alias("total_docs"), F.sum("allowed").alias("total_pages"), F.max("truncated").alias("truncated"), skipped.alias("skipped_docs"))
    return out.withColumn("message", F.when(F.col("truncated"), "page limit reached").otherwise(""))


def regroup_elements(elements: DataFrame) -> DataFrame:
    """elements(doc_id, ord, page_number, text) -> pages: texts by page in order, a missing number is page 1, gaps are empty pages."""
    own = elements.withColumn("page_num", F.coalesce("page_number", F.lit(1)).cast("int"))
    text = own.groupBy("doc_id", "page_num").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"))
    every = own.groupBy("doc_id").agg(F.max("page_num").alias("m")).select("doc_id", F.explode(F.sequence(F.lit(1), "m")).alias("page_num"))
    return every.join(text, ["doc_id", "page_num"], "left").withColumn("text", F.coalesce("text", F.lit("")))
