"""Operator 10: benchmark decontamination by spaced-seed hashing, with built-in functions only.

A word is a run of letters and digits, lower-cased. Each fixed mask is laid at every word position;
its ignored positions ("0") may hold any word, so a substituted word there does not break the hit.
Passages and documents meet on the hashes of the cared-for words. The hits on one diagonal of a document
and a passage are then verified word by word: a passage position counts as found if it lies between the
first and the last hit, or within ``AROUND`` words of these, and both words are equal. A document holds a
passage if at least ``threshold`` of the passage's positions are found, over all diagonals (so insertions
and deletions only cut a diagonal). Only documents with hits are read once more for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.store import fresh, lost_matches, written

#: Fixed masks, five cared-for words each.
MASKS = ("110111", "1101011")
AROUND = 16
#: A passage table of at most so many seed rows (about 24 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_SEEDS = 1_000_000
#: So many keys of documents with hits (16 bytes each) are broadcast to find their texts; more are joined by shuffle.
BROADCAST_HITS = 2_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _seeds(hashes: Column, mask: str) -> Column:
    """The mask's hash at each start."""
    cared = [k for k, c in enumerate(mask) if c == "1"]
    starts = F.sequence(F.lit(0), F.size(hashes) - F.lit(len(mask)))
    laid = F.transform(starts, lambda i: F.xxhash64(F.lit(mask), *[F.get(hashes, i + F.lit(k)) for k in cared]))
    return F.when(F.size(hashes) >= len(mask), laid).otherwise(F.array().cast("array<bigint>"))


def _exploded(rows: DataFrame, masks: list[str], keep: list[str]) -> DataFrame:
    """rows(*keep, n, hashes) -> (*keep, start, span, seed); the arrays of all masks are laid end to end, so one generator serves them all."""
    every = F.concat(*[_seeds(F.col("hashes"), m) for m in masks])
    # the outer generator, as an inner one makes Spark compute the arrays once more in a filter below it, quadratically
    flat = rows.select(*keep, "n", every.alias("seeds")).select(*keep, "n", F.posexplode_outer("seeds").alias("at", "seed")).where("seed is not null")
    counts = [F.greatest(F.col("n") - F.lit(len(m) - 1), F.lit(0)) for m in masks]
    start, span, below = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for m, count in zip(masks, counts, strict=True):
        inside = start.isNull() & (F.col("at") < below + count)
        start, span = F.when(inside, F.col("at") - below).otherwise(start), F.when(inside, F.lit(len(m))).otherwise(span)
        below = below + count
    return flat.select(*keep, start.cast("int").alias("start"), span.cast("int").alias("span"), "seed")


def finds(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, threshold: float) -> DataFrame:
    """(_id, _of, _item, b): each row (by its id and the hash of its text) with the passages that it holds; b: struct(similarity, n_found, i_n)."""
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn("_of", F.xxhash64("_text"))  # a row's key is its id and this
    longest = max(map(len, MASKS))
    items = benchmark.select(F.col(item_col).alias("_item"), words(F.col(item_text)).alias("words"))
    items = written(items.distinct().withColumn("n", F.size("words")).where("n > 0").withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))), "passages")
    short = sorted(r[0] for r in items.where(F.col("n") < longest).select("n").distinct().collect())  # at most longest - 1 numbers
    seeds = _exploded(items.where(F.col("n") >= longest), list(MASKS), ["_item", "words"])
    for n in short:
        seeds = seeds.unionByName(_exploded(items.where(F.col("n") == n), ["1" * n], ["_item", "words"]))
    seeds = seeds.select("_item", F.xxhash64("words").alias("variant"), F.col("start").alias("i_start"), "span", "seed")
    by_seed = F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds
    rows = docs.select("_id", "_of", words(F.col("_text")).alias("words")).select("_id", "_of", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    laid = _exploded(rows, [*MASKS, *("1" * n for n in short)], ["_id", "_of"]).select("_id", "_of", F.col("start").alias("d_start"), "seed")
    diagonal = (F.col("d_start") - F.col("i_start")).alias("diagonal")
    hits = laid.join(by_seed, "seed").groupBy("_id", "_of", "_item", "variant", diagonal).agg(F.min("i_start").alias("first"), F.max(F.col("i_start") + F.col("span")).alias("behind"))
    hits = written(hits, "hits")
    passages = items.select(F.col("_item").alias("_i"), F.xxhash64("words").alias("_v"), F.col("words").alias("i_words"), F.col("n").alias("i_n"))
    keys = hits.select(F.col("_id").alias("_d"), F.col("_of").alias("_o")).distinct()
    here = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_of") == F.col("_o"))
    texts = docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_HITS else keys, here, "left_semi")
    texts = texts.groupBy(F.col("_id").alias("_d"), F.col("_of").alias("_o")).agg(F.first("_text").alias("_text"))
    near = hits.join(passages, F.col("_item").eqNullSafe(F.col("_i")) & (F.col("variant") == F.col("_v"))).join(texts, here)
    near = near.select("_id", "_of", "_item", "variant", "i_n", "first", "behind", "diagonal", "i_words", words(F.col("_text")).alias("words"))
    around = F.sequence(F.greatest(F.col("first") - AROUND, -F.col("diagonal"), F.lit(0)), F.least(F.col("behind") - 1 + AROUND, F.col("i_n") - 1))
    found = F.filter(around, lambda i: F.get(F.col("words"), i + F.col("diagonal")) == F.get(F.col("i_words"), i))
    places = near.select("_id", "_of", "_item", "variant", "i_n", F.explode_outer(found).alias("place")).where("place is not null").distinct()
    held = places.groupBy("_id", "_of", "_item", "variant", "i_n").agg(F.count(F.lit(1)).alias("n_found"))
    held = held.where(F.col("n_found") >= F.lit(threshold) * F.col("i_n"))
    return held.select("_id", "_of", "_item", F.struct((F.col("n_found") / F.col("i_n")).alias("similarity"), "n_found", "i_n").alias("b"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(id, item, n_words, n_found, similarity): one row per document and passage that it holds.

    Null texts count as empty. Passages without words are never found; those shorter than the longest
    mask must occur whole. Each row of docs is judged by its own text; rows that repeat an id, or have
    none, give one row per passage together, as do rows that repeat an item id: that of the best find.
    Empty tables give no rows. Columns other than those named are ignored.
    """
    best = finds(docs, benchmark, id_col, text_col, item_col, item_text, threshold).groupBy("_id", "_item").agg(F.max("b").alias("b"))
    return best.select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), F.col("b.i_n").cast("long").alias("n_words"), F.col("b.n_found").cast("long").alias("n_found"), F.round("b.similarity", 6).alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """docs without the rows that hold a passage, each judged by its own text; all columns stay, and so do clean rows, whatever their ids."""
    lost, of = fresh("lost_id", *docs.columns), fresh("lost_of", *docs.columns)
    bad = finds(docs, benchmark, id_col, text_col, item_col, item_text, threshold)
    bad = written(bad.select(F.col("_id").alias(lost), F.col("_of").alias(of)).distinct(), "leaking")
    return docs.join(bad, lost_matches(lost, id_col) & (F.col(of) == F.xxhash64(F.col(text_col))), "left_anti")
