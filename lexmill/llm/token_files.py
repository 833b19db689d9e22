"""Operator 5: token ids in binary form, byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank of frequency over all documents (ties: the smaller id first), so
frequent ids take one byte. A document is one record: its ranks' byte lengths (1 to 4) as two bits
each, four to a control byte, and apart from them the ranks' bytes, little-endian. Records stand in
ascending id order; the shards are range partitions, numbered in order. Records travel in Parquet
binary columns, so that Spark's committer writes them anywhere, once, also if executors are lost.
Decoding looks each control byte up in a table of lengths and gathers the bytes with numpy.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.llm.store import new_path, written

#: Entries of a worker's memory of the parts of words, in each of two generations.
REMEMBERED = 300_000
_LONG = 200
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


_SHIFTS = np.array([0, 2, 4, 6], np.uint8)
_GROUP = 1 << 20  # numbers that are coded at a time


def _padded(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes of each record, place of each number among all two-bit codes)."""
    controls = -(-counts // 4)
    shift = 4 * (np.cumsum(controls) - controls) - (np.cumsum(counts) - counts)
    return controls, np.repeat(shift, counts) + np.arange(counts.sum())


def encode_records(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control bytes, their number by record, data bytes, their number by record) of records of unsigned 32-bit numbers that stand end to end."""
    x = np.ascontiguousarray(ranks, "<u4")
    code = (x > 0xFF).astype(np.uint8) + (x > 0xFFFF) + (x > 0xFFFFFF)
    controls, place = _padded(counts)
    codes = np.zeros(4 * int(controls.sum()), np.uint8)
    codes[place] = code
    control = (codes.reshape(-1, 4) << _SHIFTS).sum(axis=1, dtype=np.uint8)
    data = x.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    ends = np.concatenate(([0], np.cumsum(code.astype(np.int64) + 1)))
    last = np.cumsum(counts)
    return control, controls, data, ends[last] - ends[last - counts]


def decode_records(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of the records, end to end."""
    sizes = _LENGTHS[control].ravel()[_padded(counts)[1]]
    out = np.zeros((len(sizes), 4), np.uint8)
    out[np.arange(4) < sizes[:, None]] = data
    return out.view("<u4").ravel()


def _groups(sizes: np.ndarray, most: int = _GROUP) -> Iterator[slice]:
    """Rows in slices of some ``most`` numbers, one row at least."""
    at, total = 0, np.concatenate(([0], np.cumsum(sizes)))
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield slice(at, end)
        at = end


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a binary column, the size of each value)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class _Recent(dict):
    """A memory of two generations: when the new one is full it becomes the old one, whose entries come back when used."""

    def __init__(self, make) -> None:
        self.make, self.old = make, {}

    def __missing__(self, key: bytes) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= _LONG:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


#: Between a letter and a sign (but the apostrophe) of ASCII a word is cut in any case.
_SIGN = r"[!-&(-@\[-`{-~]"
_PART = re.compile(rf"(?<=[a-z])(?={_SIGN})|(?<={_SIGN})(?=[a-z])".encode())
_CUTS = rf"([a-z])({_SIGN})", rf"({_SIGN})([a-z])"


class Words:
    """The library's ids of texts, put together from those of the parts of their words. The tokenizer drops blanks, ignores case, and merges nothing across a blank or a part's end."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.of = Tokenizer.from_file(path)
        self.model = self.of.model
        self.parts = _Recent(self.part)

    def part(self, part: bytes) -> bytes:
        if part.isalpha():  # bytes: ASCII letters, which the tokenizer's steps before the merges leave alone
            return array("I", [t.id for t in self.model.tokenize(part.decode())]).tobytes()
        return self.whole(part.decode("utf-8", "surrogatepass"))

    def whole(self, text: str) -> bytes:
        return array("I", self.of.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None, end: bytes) -> bytes:
        """The ids and the end id as bytes. A null text counts as an empty one."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        if b"<|" in raw:  # perhaps a special token, which is told by its case
            return self.whole(text) + end
        known = self.parts
        return b"".join([known[p] for w in raw.lower().split() for p in _PART.split(w)]) + end  # bytes: ASCII only

    def batch(self, texts: pa.Array, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, how many each has). Each different part of the batch is looked up once."""
        cut = pc.ascii_lower(texts)
        for pattern in _CUTS:
            cut = pc.replace_substring_regex(cut, pattern, r"\1 \2")
        split = pc.ascii_split_whitespace(cut)
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        del cut, split
        known = self.parts
        own = [known[p] for p in coded.dictionary.cast(pa.binary()).to_pylist()]
        own.append(end.tobytes())
        pool, sizes = np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        ends -= ends[0]
        which = np.insert(coded.indices.to_numpy(), ends[1:], len(own) - 1)  # the end id behind each text
        size = sizes[which]
        until = np.concatenate(([0], np.cumsum(size)))
        counts = np.diff(until[np.concatenate(([0], ends[1:] + np.arange(1, len(ends))))])
        place = np.repeat(starts[which] - until[:-1], size)
        place += np.arange(len(place))
        return pool[place], counts


_words: dict[str, Words] = {}


def words(path: str) -> Words:
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Batches of some 4 MB of text, one row at least, with their texts; nulls are empty."""
    for whole in batches:
        texts = pc.fill_null(whole.column(1), "")
        for part in _groups(pc.binary_length(texts).to_numpy().astype(np.int64), 4 << 20):
            yield whole.slice(part.start, part.stop - part.start), texts.slice(part.start, part.stop - part.start)


def tokenized(docs: DataFrame, path: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, width, ids): a table of the ids, width (2 or 4) bytes each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, last = words(path), np.array([end], "<u4")
        for batch, texts in _slices(batches):
            odd = pc.match_substring(texts, "<|")
            flat, counts = of.batch(pc.if_else(odd, "", texts), last)
            if pc.any(odd).as_py():
                rows = np.split(flat, np.cumsum(counts)[:-1])
                for i in np.flatnonzero(odd):
                    rows[i] = np.frombuffer(of.ids(texts[i].as_py(), last.tobytes()), "<u4")
                flat, counts = np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))
            width = 2 if not len(flat) or flat.max() < 1 << 16 else 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(counts), width, np.int32)), _binary(flat.astype(f"<u{width}").view(np.uint8), counts * width)], names=["id", "width", "ids"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(each, "id long, width int, ids binary"), "ids")


def _numbers(batch: pa.RecordBatch, width: int, ids: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, their numbers end to end, how many each has) of some rows at a time."""
    widths = batch.column(width).to_numpy()
    data, sizes = _bytes_of(batch.column(ids))
    counts, ends = sizes // np.maximum(widths, 1), np.concatenate(([0], np.cumsum(sizes)))
    for part in _groups(counts):
        for w in (2, 4):  # widths change between batches of the writer
            if (widths[part] == w).all():
                yield part, data[ends[part.start] : ends[part.stop]].view(f"<u{w}"), counts[part]
                break
        else:
            own = [data[ends[r] : ends[r + 1]].view(f"<u{widths[r]}").astype("<u4") for r in range(part.start, part.stop)]
            yield part, np.concatenate(own), counts[part]


def frequency_ranks(tokens: DataFrame) -> list[int]:
    """All ids that occur, the most frequent first: as many as the vocabulary has at most, whatever the corpus."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for _, numbers, _ in _numbers(batch, 0, 1):
                n = np.bincount(numbers, minlength=len(total))
                n[: len(total)] += total
                total = n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counts = tokens.select("width", "ids").mapInArrow(each, "id long, n long")
    return [r.id for r in counts.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect()]


def write_files(docs: DataFrame, to: str, path: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The records under ``to``/records and the ranks under ``to``/ranks. Texts are tokenized once. Null ids come first."""
    spark = docs.sparkSession
    tokens = tokenized(docs, path, end, id_col, text_col)
    order = frequency_ranks(tokens)
    spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.parquet(f"{to}/ranks")
    rank = np.zeros(max(order, default=0) + 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for part, numbers, counts in _numbers(batch, 1, 2):
                control, controls, data, sizes = encode_records(rank[numbers], counts)
                own = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([own, pa.array(np.full(len(counts), shard)), pa.array(counts), _binary(control, controls), _binary(data, sizes)], names=["id", "shard", "n_tokens", "control", "data"])

    dealt = tokens.repartitionByRange("id").sortWithinPartitions("id")
    dealt.mapInArrow(each, "id long, shard long, n_tokens long, control binary, data binary").write.parquet(f"{to}/records")


def read_files(spark: SparkSession, at: str, digest) -> DataFrame:
    """(id, shard, n_tokens, value) of the records under ``at``: value is digest(ids), a long, of the ids as little-endian unsigned 32-bit integers."""
    ship(spark)
    order = [r.id for r in spark.read.parquet(f"{at}/ranks").orderBy("rank").collect()]  # the vocabulary's size at most
    ids = np.array(order, "<u4")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(2).to_numpy()
            (control, controls), (data, sizes) = _bytes_of(batch.column(3)), _bytes_of(batch.column(4))
            c_ends, d_ends = np.concatenate(([0], np.cumsum(controls))), np.concatenate(([0], np.cumsum(sizes)))
            value = []
            for part in _groups(counts):
                own = ids[decode_records(control[c_ends[part.start] : c_ends[part.stop]], data[d_ends[part.start] : d_ends[part.stop]], counts[part])]
                value += [digest(x) for x in np.split(own, np.cumsum(counts[part])[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(value, pa.int64())], names=["id", "shard", "n_tokens", "value"])

    return spark.read.parquet(f"{at}/records").select("id", "shard", "n_tokens", "control", "data").mapInArrow(each, "id long, shard long, n_tokens long, value long")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def round_trip(docs: DataFrame, path: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, n_tokens, ids_crc32): written, read back and decoded. start: the ids of all rows before it, in id order.

    A null or empty text has the end id only. Rows that repeat an id stand side by side, the shorter
    first. An empty table gives no rows. Columns other than the two named are ignored.
    """
    spark = docs.sparkSession
    to = new_path(spark, "tokens")
    write_files(docs, to, path, end, id_col, text_col)
    rows = read_files(spark, to, crc32)
    totals = spark.read.parquet(f"{to}/records").groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # a row per shard file
    before, firsts = 0, []
    for t in totals:
        firsts.append((t.shard, before))
        before += t.n
    first = spark.createDataFrame(firsts, "shard long, first long")
    within = Window.partitionBy("shard").orderBy("id", "n_tokens", "value").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(F.broadcast(first), "shard").select(F.col("id").alias(id_col), (F.col("first") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"), "n_tokens", F.col("value").alias("ids_crc32"))
