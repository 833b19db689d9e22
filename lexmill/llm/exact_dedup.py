"""Operator 7: exact dedup by skew-safe combining, with built-in functions only.

Copies are texts that are identical once the characters of ``[\\x20\\x09-\\x0D]`` are deleted. Three
combining stages find the winner of each group of copies, and each compares whole contents, because
the normalised text itself is part of the grouping key beside its digest:

1. local: Spark's partial aggregation keeps one row per (digest, salt, content) in each task;
2. salted: those rows meet in (digest, salt, content) groups, so that one hot text is spread over
   ``salts`` tasks;
3. global: at most ``salts`` winners per content meet in their digest's partition.

A winner is one decimal: original length, then smallest id, so that ``max`` runs in a hash aggregate.
Only groups of two or more rows are joined back to the documents, by digest. Groups with a thousandth of
all these rows or more, a thousand groups at most, are broadcast instead, and their documents are spread
over tasks whatever a group's size. Where two contents share a digest, which the global stage notices, these
digests alone are joined by content as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.store import SHARES, fresh, lost_matches, written

BLANKS = r"[\x20\x09-\x0D]"
_MAX_LONG = "9223372036854775807"
_STEP = "100000000000000000000"  # 10^20, above any id's place in the rank


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def _rank(doc_id: Column, n_chars: Column) -> Column:
    """Larger is better: more code points, then the smaller id; a null id comes last."""
    tie = F.coalesce(F.lit(_MAX_LONG).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)"), F.lit(0).cast("decimal(20,0)"))
    return (n_chars.cast("decimal(11,0)") * F.lit(_STEP).cast("decimal(21,0)") + tie).cast("decimal(38,0)")


def _winner_id(rank: Column) -> Column:
    tie = (rank % F.lit(_STEP).cast("decimal(21,0)")).cast("decimal(21,0)")
    return F.when(tie > 0, (F.lit(_MAX_LONG).cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)") - tie).cast("long"))


def copy_groups(docs: DataFrame, id_col: str, text_col: str, salts: int, digest) -> DataFrame:
    """(digest, norm or null, rank, size): one row per group of two or more rows. ``norm`` is set only where a digest stands for several contents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(normalised(F.col(text_col)).alias("norm"), _rank(F.col(id_col), F.length(text)).alias("rank"), F.pmod(F.hash(F.col(id_col), F.length(text)), F.lit(salts)).alias("salt")).withColumn("digest", digest(F.col("norm")))
    salted = rows.groupBy("digest", "salt", "norm").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("size"))
    whole = salted.repartition("digest").groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("size").alias("size"))
    several = whole.withColumn("contents", F.count(F.lit(1)).over(_by_digest()))
    return several.where("size > 1 or contents > 1").select("digest", F.when(F.col("contents") > 1, F.col("norm")).alias("norm"), "rank", "size")


def _by_digest():
    from pyspark.sql import Window

    return Window.partitionBy("digest")


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32, digest=lambda norm: F.sha2(norm, 256)) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (the digest).

    A null text counts as an empty one; empty texts are copies of each other. A null id loses every
    tie. An empty table gives no rows. ids are the table's key: rows that repeat an id and a text of
    one length are marked alike (dedup() leaves one of them). Other columns are ignored, whatever
    their names.
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    groups = written(copy_groups(docs, "_id", "_text", salts, digest).hint("rebalance"), "copies")  # rows by size, not a file for each partition of the texts
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select("_id", _rank(F.col("_id"), F.length(text)).alias("rank"), digest(normalised(F.col("_text"))).alias("digest"), normalised(F.col("_text")).alias("norm"))
    clear = groups.where("norm is null")
    least = max(1, -(-(clear.agg(F.sum("size")).first()[0] or 0) // SHARES))
    hot = clear.where(F.col("size") >= least).select("digest", F.col("rank").alias("h_best"), F.col("size").alias("h_size"))
    cool = clear.where(F.col("size") < least).select(F.col("digest").alias("dealt"), F.col("rank").alias("best"), "size")

    def with_groups(rows: DataFrame) -> DataFrame:
        met = rows.join(F.broadcast(hot), "digest", "left")
        met = met.withColumn("dealt", F.when(F.col("h_best").isNull(), F.col("digest")).otherwise(F.concat_ws(":", "digest", "_id")))  # met rows are dealt anywhere
        met = met.join(cool, "dealt", "left")
        return met.withColumn("best", F.coalesce("h_best", "best")).withColumn("size", F.coalesce("h_size", "size"))

    clashing = groups.where("norm is not null").select(F.col("digest").alias("c_digest"), F.col("norm").alias("c_norm"), F.col("rank").alias("c_best"), F.col("size").alias("c_size"))
    out = with_groups(rows.drop("norm"))
    if not clashing.isEmpty():
        out = with_groups(rows).join(clashing, (F.col("digest") == F.col("c_digest")) & (F.col("norm") == F.col("c_norm")), "left")
        out = out.withColumn("best", F.coalesce("best", "c_best")).withColumn("size", F.coalesce("size", "c_size"))
    return out.select(
        F.col("_id").alias(id_col),
        F.when(F.col("best").isNull(), F.col("_id")).otherwise(_winner_id(F.col("best"))).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("best").isNull() | (F.col("best") == F.col("rank"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """docs without the copies that lose; all columns stay. Rows that lose are found first (ids only), so texts are not shuffled when few go.

    Rows with a null id are decided by their own text: the ids that stay are joined null-safely.
    Of rows that repeat both id and text one stays.
    """
    marked = written(annotate(docs, id_col, text_col, salts), "marked")
    rows = docs.withColumn(mine := fresh("own_sha", *docs.columns), F.sha2(normalised(F.col(text_col)), 256))
    lost, theirs = fresh("lost_id", *rows.columns), fresh("lost_sha", *rows.columns)
    gone = marked.where(~F.col("kept")).select(F.col(id_col).alias(lost), F.col("text_sha256").alias(theirs)).distinct()
    left = rows.join(gone, lost_matches(lost, id_col) & (F.col(theirs) == F.col(mine)), "left_anti")
    repeated = marked.where("kept").groupBy(id_col, "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(id_col).alias(lost)).distinct()
    if repeated.isEmpty():
        return left.drop(mine)
    repeated = written(repeated, "repeated")
    once = left.join(repeated, lost_matches(lost, id_col), "left_semi").dropDuplicates([id_col, mine])
    return left.join(repeated, lost_matches(lost, id_col), "left_anti").unionByName(once).drop(mine)
