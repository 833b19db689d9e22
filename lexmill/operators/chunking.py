"""Segmentation and chunking: pages -> blocks -> chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.shipping import ship
from lexmill.functions.store import written

#: max_tokens, min_tokens, overlap, max_pages of the two layouts.
TABLE_CONFIG, TEXT_CONFIG = (400, 200, 40, 3), (700, 200, 100, 3)
MAX_TOTAL_TOKENS = 300_000


def profile(text: Column) -> Column:
    """struct(short_line_ratio, digit_symbol_ratio, gap_line_ratio, table_heavy) over the lines that are not blank."""

    def of(own: Column) -> Column:
        n = F.size(own)
        share = lambda cond: F.when(n > 0, F.size(F.filter(own, cond)) / n).otherwise(F.lit(0.0))
        short = share(lambda x: F.length(x) < 40)
        signs = share(lambda x: F.length(F.regexp_replace(x, r"[^\p{Nd}²³¹⁰-⁹₀-₉①-⑨|:/\-+%,]", "")) / F.length(x) > 0.6)
        gaps = F.when(n > 0, T.count_of(text, "\n\n") / F.greatest(F.lit(1), T.count_of(text, "\n"))).otherwise(F.lit(1.0))
        return F.struct(short.alias("short_line_ratio"), signs.alias("digit_symbol_ratio"), gaps.alias("gap_line_ratio"))

    shares = T.let(F.filter(F.transform(T.lines(text), T.strip), lambda x: x != ""), of)
    heavy = lambda s: F.struct(s["short_line_ratio"].alias("short_line_ratio"), s["digit_symbol_ratio"].alias("digit_symbol_ratio"), s["gap_line_ratio"].alias("gap_line_ratio"), ((s["digit_symbol_ratio"] > 0.5) | (s["short_line_ratio"] > 0.6)).alias("table_heavy"))
    return T.let(shares, heavy)


def kind(raw: Column) -> Column:
    """The kind of a block, by the first rule that fits."""
    return T.let(T.strip(raw), lambda t: T.let(T.lines(t), lambda own: _kind(t, own)))


def _kind(t: Column, own: Column) -> Column:
    single = F.size(own) == 1
    digits = F.length(F.regexp_replace(t, r"[^\p{Nd}²³¹⁰-⁹₀-₉①-⑨]", ""))
    starts = lambda x: F.regexp_replace(x, f"^{T.BLANK}+", "").rlike(r"\A(?:- |\* |•|1\.|a\.)")
    return (
        F.when(t == "", "other")
        .when(single & (F.length(t) <= 60) & (t == F.upper(t)) & t.rlike(r"\p{L}"), "heading")
        .when(single & t.endswith(":") & (F.length(t) <= 80), "heading")
        .when(F.exists(own, starts), "list")
        .when(F.exists(own, lambda x: x.contains("|") | x.contains("\t")), "table")
        .when(digits / F.greatest(F.lit(1), F.length(t)) > 0.4, "table")
        .when(t.contains("```"), "code")
        .otherwise("paragraph")
    )


def cut_spans(text: Column, separator: str) -> Column:
    """The parts between matches of separator, in order: struct(text, start, end), offsets in code points."""
    parts, cuts = F.split(text, separator, -1), F.regexp_extract_all(text, F.lit(separator), F.lit(0))
    sizes = F.transform(F.arrays_zip(parts.alias("p"), cuts.alias("c")), lambda x: F.struct(F.length(x["p"]).alias("p"), F.coalesce(F.length(x["c"]), F.lit(0)).alias("c")))
    starts = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, x: F.struct((a["at"] + x["p"] + x["c"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
    return F.transform(F.arrays_zip(parts.alias("p"), starts.alias("s")), lambda x: F.struct(x["p"].alias("text"), x["s"].alias("start"), (x["s"] + F.length(x["p"])).alias("end")))


def blocks(pages: DataFrame) -> DataFrame:
    """pages -> (doc_id, page_num, block_seq, kind, text, char_start, char_end): parts between blank lines; blank ones are dropped, but a page without any gives one block of kind other."""
    spans = F.filter(cut_spans(F.col("text"), r"\n\s*\n"), lambda x: T.strip(x["text"]) != "")
    empty = F.array(F.struct(F.lit("").alias("text"), F.lit(0).alias("start"), F.lit(0).alias("end")))
    rows = pages.select("doc_id", "page_num", F.posexplode_outer(T.let(spans, lambda s: F.when(F.size(s) > 0, s).otherwise(empty))).alias("block_seq", "b"))
    return rows.select("doc_id", "page_num", "block_seq", kind(F.col("b.text")).alias("kind"), T.strip(F.col("b.text")).alias("text"), F.col("b.start").alias("char_start"), F.col("b.end").alias("char_end"))


# ---- semantic segments


@lru_cache(200_000)
def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def hashed_embedding(text: str, dims: int = 64) -> np.ndarray:
    """A deterministic vector of a text: its words hashed to signed places, of unit length (zeros without words)."""
    out = np.zeros(dims)
    for w in text.lower().split():
        h = _word_hash(w)
        out[h % dims] += 1.0 if h >> 63 else -1.0
    size = np.linalg.norm(out)
    return out / size if size else out


def _hashed_windows(parts: list[str], buffer: int, dims: int = 64) -> np.ndarray:
    """hashed_embedding of each part with its neighbours; counts are whole numbers, so sums of the parts' own are exact."""
    words = [p.lower().split() for p in parts]
    hashes = np.fromiter((_word_hash(w) for own in words for w in own), np.uint64)
    at = np.repeat(np.arange(len(parts)), [len(own) for own in words]) * dims + (hashes % np.uint64(dims)).astype(np.int64)
    own = np.bincount(at, weights=np.where(hashes >> np.uint64(63), 1.0, -1.0), minlength=len(parts) * dims).reshape(-1, dims)
    total = np.concatenate((np.zeros((1, dims)), own.cumsum(axis=0)))
    i = np.arange(len(parts))
    out = total[np.minimum(len(parts), i + buffer + 1)] - total[np.maximum(0, i - buffer)]
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, size, out=out, where=size > 0)


def semantic_groups(parts: list[str], embed: Callable[[str], np.ndarray] = hashed_embedding, percentile: float = 95.0, buffer: int = 1) -> list[str]:
    """Sentences joined up to the places where neighbouring windows differ most. Fewer than two sentences stay as they are."""
    if len(parts) < 2:
        return list(parts)
    if embed is hashed_embedding:
        vectors = _hashed_windows(parts, buffer)
    else:
        vectors = [embed(" ".join(parts[max(0, i - buffer) : i + buffer + 1])) for i in range(len(parts))]
    gaps = np.array([1 - float(a @ b) for a, b in zip(vectors, vectors[1:], strict=False)])
    cuts = [0, *(np.flatnonzero(gaps > np.percentile(gaps, percentile)) + 1).tolist(), len(parts)]
    return [" ".join(parts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def semantic_segments(pages: DataFrame, embed: Callable[[str], np.ndarray] = hashed_embedding, most: int | None = None) -> DataFrame:
    """(doc_id, page_num, segment_seq, text, char_start, char_end); a segment is found from the end of the last one on, or stands at the cursor. ``most`` bounds a page's sentences; those behind it are in no segment."""
    ship(pages.sparkSession)
    rows = pages.select("doc_id", "page_num", "text", T.sentences(F.col("text"), most).alias("parts"))
    d, p = rows.schema["doc_id"].dataType.simpleString(), rows.schema["page_num"].dataType.simpleString()

    def each(frames):
        for frame in frames:
            out = []
            for doc, page, text, parts in frame.itertuples(index=False):
                at = 0
                for k, segment in enumerate(semantic_groups(list(parts), embed)):
                    found = text.find(segment, at)
                    start = found if found >= 0 else at
                    at = start + len(segment)
                    out.append((doc, page, k, segment, start, at))
            yield pd.DataFrame(out, columns=["doc_id", "page_num", "segment_seq", "text", "char_start", "char_end"])

    return rows.mapInPandas(each, f"doc_id {d}, page_num {p}, segment_seq int, text string, char_start int, char_end int")


# ---- strategy and runs


def strategy(text: Column, mode: Column | str = "semantic", has_segments: Column | bool = True) -> Column:
    """struct(strategy, max_tokens, min_tokens, overlap, max_pages)."""
    mode = F.lit(mode) if isinstance(mode, str) else mode
    has = F.lit(has_segments) if isinstance(has_segments, bool) else has_segments

    def of(table: Column) -> Column:
        pick = lambda k: F.when(table, TABLE_CONFIG[k]).otherwise(TEXT_CONFIG[k])
        name = F.when(table, "fixed_table").when((mode != "semantic") | ~has, "fixed").otherwise("semantic")
        return F.struct(name.alias("strategy"), pick(0).alias("max_tokens"), pick(1).alias("min_tokens"), pick(2).alias("overlap"), pick(3).alias("max_pages"))

    return T.let(profile(text)["table_heavy"], of)


def runs(pages: DataFrame, config: str = "config") -> DataFrame:
    """pages with run_id: neighbouring pages of a document with the same config are one run."""
    order = Window.partitionBy("doc_id").orderBy("page_num")
    new = F.coalesce((F.col(config) != F.lag(config).over(order)).cast("int"), F.lit(0))
    return pages.withColumn("_new", new).withColumn("run_id", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


# ---- packing


def _windows(tokens: list[str], size: int, overlap: int) -> list[list[str]]:
    step = max(1, size - overlap if 0 < overlap < size else size)
    return [tokens[i : i + size] for i in range(0, len(tokens), step)]


def pack(blocks_: list[dict], max_tokens: int, min_tokens: int, overlap: int, max_pages: int, strategy_: str = "fixed", encode=str.split, decode=" ".join) -> list[dict]:
    """Chunks of a run of blocks (kind, text, page_num) under token and page budgets; the contract is in the README."""
    out: list[dict] = []
    seen: set[str] = set()
    held: list[dict] = []

    def put(text: str, tokens: int, kinds: set[str]) -> bool:
        if text in seen:
            return False
        seen.add(text)
        pages = [b["page_num"] for b in held]
        title = next((b["text"] for b in held if b["kind"] == "heading"), None)
        out.append({"page_start": min(pages), "page_end": max(pages), "section_title": title, "text": text, "token_len": tokens, "block_types": ",".join(sorted(kinds)), "strategy": strategy_, "merged_tail": False})
        return True

    def flush() -> None:
        text = "\n\n".join(b["text"] for b in held).strip()
        tokens = encode(text)
        kinds = {b["kind"] for b in held}
        carry = None
        if len(tokens) > max_tokens:
            for part in _windows(tokens, max_tokens, overlap):
                put(decode(part), len(part), kinds)
        elif tokens and put(text, len(tokens), kinds) and 0 < overlap < len(tokens):
            carry = {"kind": "overlap", "text": decode(tokens[-overlap:]), "page_num": held[-1]["page_num"], "n": overlap}
        held.clear()
        if carry:
            held.append(carry)

    for b in blocks_:
        n = len(encode(b["text"]))
        if not n:
            continue
        have = sum(x["n"] for x in held)
        wide = len({x["page_num"] for x in held} | {b["page_num"]}) > max_pages
        if held and (have + n > max_tokens or wide) and have >= min_tokens:
            flush()
        held.append({**b, "n": n})
    if held and sum(x["n"] for x in held) < min_tokens and out:
        last = out[-1]
        tail = "\n\n".join(b["text"] for b in held).strip()
        if tail:
            last["text"] = f"{last['text']}\n\n{tail}".strip()
            last.update(token_len=len(encode(last["text"])), page_end=max(last["page_end"], *(b["page_num"] for b in held)), merged_tail=True)
    elif held:
        flush()
    return out


CHUNK_FIELDS = "page_start long, page_end long, section_title string, text string, token_len int, block_types string, strategy string, merged_tail boolean"


def pack_blocks(blocks_: DataFrame) -> DataFrame:
    """blocks(doc_id, run_id, page_num, block_seq, kind, text, config) -> chunks, a run at a time. A run is part of one document, so a group is as large as a document; a batch has many groups, as a frame for each costs more than its packing."""
    ship(blocks_.sparkSession)
    runs_ = blocks_.groupBy("doc_id", "run_id").agg(F.first("config").alias("c"), F.array_sort(F.collect_list(F.struct("page_num", "block_seq", "kind", "text"))).alias("b"))

    @F.pandas_udf("array<struct<" + CHUNK_FIELDS.replace(" ", ":").replace(",:", ",") + ">>")
    def made(kinds: pd.Series, texts: pd.Series, pages: pd.Series, most: pd.Series, least: pd.Series, overlap: pd.Series, wide: pd.Series, name: pd.Series) -> pd.Series:
        rows = zip(kinds, texts, pages, most, least, overlap, wide, name, strict=True)
        return pd.Series([pack([{"kind": k, "text": t, "page_num": int(p)} for k, t, p in zip(ks, ts, ps, strict=True)], *map(int, conf[:4]), conf[4]) for ks, ts, ps, *conf in rows], dtype=object)

    out = made("b.kind", "b.text", "b.page_num", "c.max_tokens", "c.min_tokens", "c.overlap", "c.max_pages", "c.strategy")
    return runs_.select("doc_id", F.col("run_id").cast("long").alias("run_id"), F.posexplode_outer(out).alias("chunk_seq", "x")).where("x is not null").select("doc_id", "run_id", "chunk_seq", "x.*")  # outer: an inner one packs twice


def chunk_documents(pages: DataFrame, mode: str = "semantic") -> DataFrame:
    """pages(doc_id, page_num, text) -> chunks with chunk_id ``doc_id:number``. Table-heavy pages keep their blocks; others are cut into semantic segments."""
    pages = pages.withColumn("config", strategy(F.col("text"), mode, F.size(T.sentences(F.col("text"))) > 0))
    numbered = written(runs(pages), "runs")  # read three times
    conf = numbered.select("doc_id", "page_num", "run_id", "config")
    fixed = blocks(numbered.where("config.strategy != 'semantic'")).where("text != ''")
    semantic = semantic_segments(numbered.where("config.strategy = 'semantic'")).select("doc_id", "page_num", F.col("segment_seq").alias("block_seq"), F.lit("semantic").alias("kind"), "text", "char_start", "char_end")
    made = pack_blocks(fixed.unionByName(semantic).join(conf, ["doc_id", "page_num"]))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("run_id", "chunk_seq")) - 1
    return made.withColumn("chunk_id", F.concat_ws(":", F.col("doc_id").cast("string"), number.cast("string")))


def sliding(rows: DataFrame, size: int, overlap: int, id_col: str = "doc_id") -> DataFrame:
    """(id, seq, text, token_len): windows of tokens; of equal windows of a row the first stays."""
    step = max(1, size - overlap if 0 < overlap < size else size)
    own = rows.select(id_col, T.tokens(F.col("text")).alias("t"))
    starts = F.when(F.size("t") > 0, F.sequence(F.lit(0), F.greatest(F.size("t") - 1, F.lit(0)), F.lit(step)))
    parts = F.transform(starts, lambda i: F.array_join(F.slice("t", i + 1, size), " "))
    each = own.select(id_col, F.posexplode_outer(parts).alias("seq", "text"))  # outer: an inner one computes the arrays twice
    return each.where("text is not null").groupBy(id_col, "text").agg(F.min("seq").alias("seq")).withColumn("token_len", F.size(F.split("text", " ")))


def guardrail(chunks: DataFrame, limit: int = MAX_TOTAL_TOKENS) -> DataFrame:
    """chunks(doc_ord, chunk_seq, token_len) that the budget admits: the first chunk that would exceed it ends its document; later documents go on with what is left.

    The budget bounds what is kept, and the walk over the sums ends when nothing is left.
    """
    total = chunks.agg(F.sum("token_len")).first()[0] or 0
    if total <= limit:
        return chunks
    kept, left, ended = [], limit, None
    for r in chunks.select("doc_ord", "chunk_seq", "token_len").orderBy("doc_ord", "chunk_seq").toLocalIterator():
        if r.doc_ord == ended:
            continue
        if r.token_len > left:
            ended = r.doc_ord
            continue
        left -= r.token_len
        kept.append((r.doc_ord, r.chunk_seq))
        if left <= 0:
            break
    ids = chunks.sparkSession.createDataFrame(kept, "doc_ord long, chunk_seq long")
    return chunks.join(ids, ["doc_ord", "chunk_seq"], "left_semi")


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Per document: chunks, avg_tokens, chunks per strategy."""
    per = chunks.groupBy("doc_id", "strategy").agg(F.count(F.lit(1)).alias("n"), F.sum("token_len").alias("s"))
    return per.groupBy("doc_id").agg(F.sum("n").alias("chunks"), F.bround(F.sum("s") / F.sum("n"), 2).alias("avg_tokens"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("strategy", "n")))).alias("strategies"))


def fingerprint(chunks: DataFrame) -> DataFrame:
    """One row: a digest of all chunks' ids and lengths, whatever their order; digests of buckets are combined, so no task gets all rows."""
    own = chunks.select(F.sha1(F.concat_ws("|", "chunk_id", F.col("token_len").cast("string"))).alias("h"))
    bucket = own.groupBy(F.substring("h", 1, 3).alias("b")).agg(F.sha1(F.array_join(F.array_sort(F.collect_list("h")), "")).alias("h"))
    return bucket.agg(F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), "")).alias("fingerprint"), F.count(F.lit(1)).alias("buckets"))


def token_estimate(text: Column) -> Column:
    return F.greatest(F.floor(F.length(text) / 4), F.lit(1)).cast("long")


def preview(text: Column, most: int = 420) -> Column:
    t = T.squeeze(text)
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 3), F.lit("..."))).otherwise(t)


def page_label(start: Column, end: Column) -> Column:
    return F.when(start == end, F.concat(F.lit("p."), start.cast("string"))).otherwise(F.concat(F.lit("pp."), start.cast("string"), F.lit("-"), end.cast("string")))
