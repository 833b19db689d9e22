"""Operator 1: removal of repeated 100-byte strings by a column-wise multi-document suffix index.

Every string of ``WIDTH`` bytes (a window) belongs to the piece of its anchor: the leftmost of the
least hashes of its 32-byte strings. Equal windows have equal anchors, so they meet in the group of
the anchor's hash, and a piece (all windows of one anchor, 35 on average) is the unit that is dealt.
Within a group equal pieces count once, as their first occurrence; the others are repeats as a whole.
Groups with several different pieces are indexed: each piece is a document of a collection whose
Burrows-Wheeler transform and common prefixes grow by one symbol per document in each round, in
sequential passes over external files. Runs of common prefixes of WIDTH or more are the equal windows.

Anchors found in many documents of a sample have their pieces cut into single windows, dealt by the
window's hash, and so have groups of more than ``LARGE`` different pieces: no group gets unbounded.
(The sample only chooses how work is dealt; it does not change the result.) Equal pieces are combined
in each task before they are shuffled.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.llm.store import written

WIDTH = 100
GRAM = 32
LARGE = 20_000
#: Pieces of a collection (some 140 bytes each), unless one group has more.
BLOCK = 6_000
SAMPLE_DOCS, HOT_SHARE, HOT_LEAST = 6_000, 0.003, 12
_CHUNK = 1 << 19
_ROWS = 1_500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---- pieces


def _grams(raw: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes (a power of two) from each place on."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * _MIX
    size = 1
    while size < width:
        a = h[:-size] * np.uint64(0xD6E8FEB86659FD93)
        a ^= a >> np.uint64(29)
        a += h[size:]
        a *= _MIX
        h, size = a, 2 * size
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


def cut(raw: bytes, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows) of each piece. Windows start at first[i] .. first[i] + count[i] - 1 of raw, which is shorter than 2^20."""
    data = np.frombuffer(raw, np.uint8)
    h = _grams(data, GRAM)
    place = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
    least = _least(place, WIDTH - GRAM + 1)
    starts = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    own = least[starts]
    new = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    size = np.diff(np.append(new, len(own)))
    return h[(own[new] & np.uint64((1 << 20) - 1)).astype(np.int64)], starts[new], size


def _span(at: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return (at << 8) | windows


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(raw, doc, offset in doc, first, windows) of some texts or parts of texts at a time; parts overlap by WIDTH - 1 bytes."""
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            for at in range(0, len(raw) - WIDTH + 1, _CHUNK):
                part = raw[at : at + _CHUNK + WIDTH - 1]
                if size + len(part) >= 1 << 20:
                    yield _joined(held)
                    held, size = [], 0
                held.append((part, doc, at))
                size += len(part)
    if held:
        yield _joined(held)


def _joined(held: list[tuple[bytes, int, int]]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x[0]) for x in held])
    return b"".join(x[0] for x in held), np.array([x[1] for x in held]), np.array([x[2] for x in held]), np.cumsum(sizes) - sizes, sizes - WIDTH + 1


def _pieces(raw: bytes, docs: np.ndarray, offsets: np.ndarray, first: np.ndarray, windows: np.ndarray, single: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(key, piece hash, doc, span); the pieces whose anchor is in ``single`` (sorted; None: all) are cut into windows."""
    import xxhash

    key, start, size = cut(raw, first, windows)
    if single is None or len(single):
        fine = np.ones(len(key), bool) if single is None else np.isin(key, single)
        many = size[fine]
        each = np.repeat(start[fine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        start, size = np.concatenate((start[~fine], each)), np.concatenate((size[~fine], np.ones(len(each), size.dtype)))
        key = key[~fine]
    view, digest = memoryview(raw), xxhash.xxh3_64_intdigest
    piece = np.fromiter((digest(view[a:b]) for a, b in zip(start.tolist(), (start + size + WIDTH - 1).tolist(), strict=True)), np.uint64, len(start))
    if len(key) < len(start):  # a window's key is another hash of it
        alone = np.fromiter((xxhash.xxh64_intdigest(view[a : a + WIDTH], 7) for a in start[len(key) :].tolist()), np.uint64, len(start) - len(key))
        key = np.concatenate((key, alone))
    of = np.searchsorted(first, start, side="right") - 1
    return key.view(np.int64), piece.view(np.int64), docs[of], _span(start - first[of] + offsets[of], size)


def _firsts(key: np.ndarray, piece: np.ndarray, doc: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): order puts equal pieces together, the first occurrence in front, and new marks it."""
    order = np.lexsort((span, doc, piece, key))
    k, p = key[order], piece[order]
    return order, np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1])))


_PIECES = "key long, piece long, doc long, span long, kind int"
_REPEAT, _INDEX, _FINER = 0, 1, 2


def _batch(key: np.ndarray, piece: np.ndarray, doc: np.ndarray, span: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(key), 100_000):
        part = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(piece[part]), pa.array(doc[part]), pa.array(span[part]), pa.array(kind[part].astype(np.int32))], names=["key", "piece", "doc", "span", "kind"])


def _dealt(texts: DataFrame, single: np.ndarray | None) -> DataFrame:
    """texts(doc, text) -> the pieces, combined within each task: repeats are marked as such and dealt by document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            key, piece, doc, span = (np.concatenate(x) for x in zip(*held, strict=True))
            mixed = key * np.int64(-7046029254386353131) ^ piece
            order = np.argsort(mixed, kind="stable")
            same = mixed[order][1:] == mixed[order][:-1]
            twin = np.zeros(len(key), bool)
            twin[order[1:][same]] = twin[order[:-1][same]] = True
            rows = np.flatnonzero(twin)
            kind = np.full(len(key), _INDEX)
            if len(rows):
                order, new = _firsts(key[rows], piece[rows], doc[rows], span[rows])
                later = rows[order[~new]]
                kind[later] = _REPEAT
                key[later] = doc[later] * np.int64(-7046029254386353131)
            yield from _batch(key, piece, doc, span, kind)

        for chunk in _chunks(batches):
            held.append(_pieces(*chunk, single))
            count += len(held[-1][0])
            if count > _ROWS:
                yield from out()
                held, count = [], 0
        if held:
            yield from out()

    return texts.mapInArrow(each, _PIECES)


def _grouped(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    """Columns of batches sorted by the first, cut only between its values; about 400 000 rows at a time."""
    held: list[list] = []
    rows = 0

    def joined() -> list:
        return [np.concatenate([h[c] for h in held]) for c in range(columns)]

    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(columns)])
        rows += batch.num_rows
        if rows >= 400_000:
            all_ = joined()
            change = np.flatnonzero(all_[0][1:] != all_[0][:-1])
            if len(change):
                yield tuple(x[: change[-1] + 1] for x in all_)
                all_ = [x[change[-1] + 1 :].copy() for x in all_]
            held, rows = [all_], len(all_[0])
    if rows:
        yield tuple(joined())


def _sorted_out(pieces: DataFrame) -> DataFrame:
    """The repeats among dealt pieces, and the first occurrences of the pieces that must be indexed (or cut finer)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, piece, doc, span, kind in _grouped(batches, 5):
            old = np.flatnonzero(kind == _REPEAT)
            yield from _batch(key[old], piece[old], doc[old], span[old], kind[old])
            key, piece, doc, span = (x[kind == _INDEX] for x in (key, piece, doc, span))
            if len(key) < 2:
                continue
            twin = np.concatenate(([False], key[1:] == key[:-1]))
            twin[:-1] |= twin[1:]
            key, piece, doc, span = (x[twin] for x in (key, piece, doc, span))
            if not len(key):
                continue
            order, new = _firsts(key, piece, doc, span)
            key, piece, doc, span = (x[order] for x in (key, piece, doc, span))
            group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
            different = np.bincount(group, new)[group]
            kind = np.where(~new, _REPEAT, np.where(different > LARGE, _FINER, _INDEX))
            live = ~new | (different > 1)
            yield from _batch(key[live], piece[live], doc[live], span[live], kind[live])

    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(each, _PIECES)


# ---- the index


class _Column:
    """An external file that each round reads and writes once, from front to end."""

    def __init__(self) -> None:
        self.file = tempfile.TemporaryFile()

    def write(self, data: np.ndarray) -> None:
        self.file.seek(0)
        data.tofile(self.file)
        self.file.truncate()

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.fromfile(self.file, np.uint8)


def window_classes(raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, text, offset) of every window of the texts raw[first : first + size]; equal windows have equal classes.

    Round j inserts the suffix of j symbols of each text. A suffix's place is that of its symbol among
    the transform's symbols (stable order); its common prefix with a neighbour is one more than the
    least common prefix between the two symbols. 0 marks the start of a text; raw has no 0, and no
    text has more than 255 symbols.
    """
    m = len(first)
    end = first + size
    symbols, prefixes = _Column(), _Column()
    symbols.write(raw[end - 1])
    prefixes.write(np.zeros(m, np.uint8))
    text = pos = np.arange(m)
    for j in range(1, int(size.max(initial=0)) + 1):
        bwt, lcp = symbols.read(), prefixes.read()
        n = len(bwt)
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        ended = n - np.count_nonzero(bwt)
        by = np.argsort(pos)
        pos, text = pos[by], text[by]
        k = rank[pos]
        before, after = order[k - 1], order[np.minimum(k + 1, n - 1)]
        has_before = (k > ended) & (bwt[before] == bwt[pos])
        has_after = (k + 1 < n) & (bwt[after] == bwt[pos])
        padded = np.append(lcp, np.uint8(0))

        def least(a: np.ndarray, b: np.ndarray, has: np.ndarray, padded=padded) -> np.ndarray:
            """1 + the least prefix of the places a .. b - 1 where has, else 0."""
            out = np.zeros(len(a), np.uint8)
            if has.any():
                out[has] = np.minimum.reduceat(padded, np.stack((a[has], b[has]), axis=1).ravel())[::2] + 1
            return out

        own, next_ = least(before + 1, pos + 1, has_before), least(pos + 1, after + 1, has_after)
        new = m + k - ended
        stay = np.ones(n + len(new), bool)
        stay[new] = False
        grown, grown_lcp = np.empty(len(stay), np.uint8), np.empty(len(stay) + 1, np.uint8)
        grown[stay] = bwt
        grown_lcp[:-1][stay] = lcp
        place = end[text] - j
        goes_on = place > first[text]
        grown[new] = np.where(goes_on, raw[place - 1], 0)
        grown_lcp[new + 1] = next_
        grown_lcp[new] = own
        symbols.write(grown)
        prefixes.write(grown_lcp[:-1])
        pos, text = new[goes_on], text[goes_on]
        if not len(pos):
            break
    bwt, lcp = symbols.read(), prefixes.read()
    rank = np.empty(len(bwt), np.int64)
    rank[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    ended = len(bwt) - np.count_nonzero(bwt)
    class_of = np.cumsum(lcp < WIDTH)
    out: list[tuple[np.ndarray, ...]] = []
    text = pos = np.arange(m)
    for j in range(1, int(size.max(initial=0)) + 1):
        pos = m + rank[pos] - ended
        if j >= WIDTH:
            out.append((class_of[pos], text, size[text] - j))
        live = size[text] > j
        pos, text = pos[live], text[live]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _repeats(raws: list[bytes], doc: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, span) of the runs of windows that also start earlier, among the pieces of some groups."""
    size = np.array([len(x) for x in raws])
    raw = np.frombuffer(b"".join(raws), np.uint8)
    raw = np.where(raw == 0, np.uint8(255), raw)  # 255 is no byte of UTF-8
    class_, text, offset = window_classes(raw, np.cumsum(size) - size, size)
    at = (span >> 8)[text] + offset
    order = np.lexsort((at, doc[text], class_))
    later = order[1:][class_[order][1:] == class_[order][:-1]]
    text, at = text[later], at[later]
    order = np.lexsort((at, text))
    text, at = text[order], at[order]
    if not len(at):
        return doc[:0], span[:0]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1))))
    return doc[text[new]], _span(at[new], np.diff(np.append(new, len(at))))


def _indexed(pieces: DataFrame) -> DataFrame:
    """pieces(key, doc, span, raw) -> (doc, span) of repeats."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, doc, span, raw in _grouped(batches, 4):
            starts = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
            a = 0
            while a < len(starts) - 1:
                b = max(a + 1, int(np.searchsorted(starts, starts[a] + BLOCK, side="right")) - 1)
                part = slice(starts[a], starts[b])
                d, s = _repeats(list(raw[part]), doc[part], span[part])
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(s)], names=["doc", "span"])
                a = b

    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(each, "doc long, span long")


def _with_bytes(rows: DataFrame, texts: DataFrame) -> DataFrame:
    own = texts.select(F.col("doc").alias("d"), F.col("text").cast("binary").alias("raw"))
    at, size = F.shiftright("span", 8).cast("int"), F.col("span").bitwiseAND(255).cast("int") + F.lit(WIDTH - 1)
    return rows.join(own, F.col("doc") == F.col("d")).select("key", "doc", "span", F.substring(F.col("raw"), at + 1, size).alias("raw"))


# ---- the whole


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text): doc is the id itself, or the row's place if ids repeat or are missing."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    clash = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
    if clash.isEmpty():
        return rows.select(F.col("id").alias("doc"), "id", "text")
    ordered = rows.orderBy(F.col("id").asc_nulls_first(), F.xxhash64("text")).rdd.zipWithIndex().map(lambda x: (x[1], x[0].id, x[0].text))
    return written(docs.sparkSession.createDataFrame(ordered, "doc long, id long, text string"), "numbered")


def hot_anchors(texts: DataFrame) -> np.ndarray:
    """Hashes of the anchors that many documents of a sample have: a few thousand at most."""
    n = texts.select("doc").count()
    some = texts.sample(min(1.0, SAMPLE_DOCS / max(n, 1)), 7) if n > SAMPLE_DOCS else texts
    single = np.zeros(0, np.uint64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            key, _, doc, _ = _pieces(*chunk, single)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc)], names=["key", "doc"])

    seen = some.select("doc", "text").mapInArrow(each, "key long, doc long").distinct().groupBy("key").count()
    least = max(HOT_LEAST, HOT_SHARE * min(n, SAMPLE_DOCS))
    found = seen.where(F.col("count") >= least).orderBy(F.desc("count"), "key").limit(20_000).collect()
    return np.sort(np.array([r.key for r in found], np.int64).view(np.uint64))


def repeats(texts: DataFrame) -> DataFrame:
    """texts(doc, text) -> (doc, span) of all windows that start earlier too; span: start * 256 + windows."""
    ship(texts.sparkSession)
    own = texts.select("doc", "text")
    rows = written(_sorted_out(_dealt(own, hot_anchors(own))), "pieces")
    out = rows.where(F.col("kind") == _REPEAT).select("doc", "span")
    out = out.unionByName(_indexed(_with_bytes(rows.where(F.col("kind") == _INDEX), own)))
    finer = rows.where(F.col("kind") == _FINER)
    if not finer.isEmpty():
        out = out.unionByName(_finer_repeats(_with_bytes(finer, own)))
    return out


def _finer_repeats(pieces: DataFrame) -> DataFrame:
    """The repeats among pieces of groups that are too large to index, window by window."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for doc, span, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                raw, at, n = raw.as_py(), span >> 8, span & 255
                key = np.array([xxhash.xxh64_intdigest(raw[i : i + WIDTH], 7) for i in range(n)], np.uint64).view(np.int64)
                piece = np.array([xxhash.xxh3_64_intdigest(raw[i : i + WIDTH]) for i in range(n)], np.uint64).view(np.int64)
                yield from _batch(key, piece, np.full(n, doc), _span(at + np.arange(n), np.ones(n, np.int64)), np.full(n, _INDEX))

    found = _sorted_out(pieces.mapInArrow(each, _PIECES))
    return found.where(F.col("kind") == _REPEAT).select("doc", "span")


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256), one row per row.

    Texts are UTF-8 bytes; a null text is empty. Texts under WIDTH bytes lose nothing. Rows that repeat
    an id (or have none; these come first) are documents of their own, in the order of a hash of their
    texts. An empty table gives no rows. Columns other than the two named are ignored.
    """
    texts = _numbered(docs, id_col, text_col)
    spans = repeats(texts).groupBy("doc").agg(F.collect_list("span").alias("spans")).withColumnRenamed("doc", "d")
    rows = texts.join(spans, F.col("doc") == F.col("d"), "left").select("id", "text", "spans")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            figures = [removed((t.as_py() or "").encode("utf-8", "surrogatepass"), s.values.to_numpy() if s.is_valid else None) for t, s in zip(batch.column(1), batch.column(2), strict=True)]
            n, gone, runs, sha = zip(*figures, strict=True) if figures else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(sha, pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(each, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)


def runs(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of bytes that the spans' windows cover; runs that touch are one."""
    spans = np.sort(spans)
    start, end = spans >> 8, (spans >> 8) + (spans & 255) + WIDTH - 1
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    return start[new], reach[np.append(new[1:] - 1, len(reach) - 1)]


def removed(raw: bytes, spans: np.ndarray | None) -> tuple[int, int, int, str]:
    """(bytes, bytes removed, runs removed, SHA-256 of what is left)."""
    if spans is None or not len(spans):
        return len(raw), 0, 0, hashlib.sha256(raw).hexdigest()
    starts, ends = runs(spans)
    kept = b"".join(raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True))
    return len(raw), len(raw) - len(kept), len(starts), hashlib.sha256(kept).hexdigest()
