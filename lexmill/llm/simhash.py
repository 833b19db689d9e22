"""Operator 9: SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints within ``BITS`` differing bits agree on two of six blocks at least, so each distinct
fingerprint goes to 15 tables, one per pair of blocks, and is dealt by the bits of the two (its key).
A task sorts the fingerprints of a table by the Gray rank of their bits, those of the key first, which
puts those that share bit patterns side by side; groups of them form the nodes of an index over all
keys of the task, each with the mask of the bits on which its members agree. A search goes down the
levels with all queries at once; it adds up the differences in the bits that a level newly fixes and
drops a whole group once they exceed ``BITS`` or one lies in the key. Every link comes from it.

A key of more than ``HOT`` fingerprints is dealt anew: its other bits are cut into five blocks, of which
at least one agrees, so it goes to five tables with a longer key. What is still larger after three such
rounds is cut into parts, and each pair of parts is searched by itself. So no task gets an unbounded
group and no link is lost. A task returns only a star per component that it sees, never the pairs; stars
are merged by alternating large and small stars over written tables. Rows meet their fingerprint's component
by shuffle, or by broadcast for fingerprints with a thousandth of all rows or more (a thousand at most).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.llm.store import join_unique, without, written

BITS = 4
SHINGLE = 4
SEED = 42
HOT = 16_384
REFINED = 3
_LEAF = 16
_BLOCKS = (11, 11, 11, 11, 10, 10)
_WORK = 1 << 20
_TOGETHER = 200_000  # fingerprints of a table that a task indexes at once, unless one key has more


# ---- fingerprints


def fingerprint(text: str | None) -> int:
    """Unsigned 64 bits. A null text counts as an empty one: 0."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only the six blanks
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)), np.uint64, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _WORK):
        ones += np.unpackbits(hashes[at : at + _WORK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, fp): fp as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(each, "id long, fp long")


# ---- the index


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order."""
    r = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(k)
    return r


def _levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, mask) of the nodes of each level, from the leaves up; a node has _LEAF children at most."""
    low, high, out = fps, fps, []
    while len(low) > 1:
        cut = np.arange(0, len(low), _LEAF)
        low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
        out.append((low, ~(low ^ high)))
    return out


def near_pairs(fps: np.ndarray, bits: int = BITS, exact: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of fps (distinct, in Gray order) at ``bits`` or fewer differing bits, none of them in ``exact``, in chunks."""
    n = len(fps)
    levels = _levels(fps)
    if not levels:
        return
    key = np.uint64(exact)
    stack = [(len(levels) - 1, np.arange(a, min(n, a + 4096)), np.zeros(min(n, a + 4096) - a, np.int64), np.zeros(min(n, a + 4096) - a, np.int64)) for a in range(0, n, 4096)]
    while stack:
        level, query, node, seen = stack.pop()  # level: of the nodes; seen: differences in the bits of the nodes above
        pattern, mask = levels[level]
        open_ = mask[node] if level == len(levels) - 1 else mask[node] & ~levels[level + 1][1][node // _LEAF]
        differ = (fps[query] ^ pattern[node]) & open_
        seen = seen + np.bitwise_count(differ)
        live = (seen <= bits) & (differ & key == 0) & ((node + 1) * _LEAF ** (level + 1) > query + 1)
        query, node, seen = query[live], node[live], seen[live]
        below = n if level == 0 else len(levels[level - 1][0])
        for at in range(0, len(query), _WORK // _LEAF):
            q, p, s = (x[at : at + _WORK // _LEAF] for x in (query, node, seen))
            child = p[:, None] * _LEAF + np.arange(_LEAF)
            child, q, s = child.ravel(), np.repeat(q, _LEAF), np.repeat(s, _LEAF)
            ok = child < below
            child, q, s = child[ok], q[ok], s[ok]
            if level:
                stack.append((level - 1, q, child, s))
                continue
            ok = child > q
            child, q, s = child[ok], q[ok], s[ok]
            differ = (fps[q] ^ fps[child]) & ~mask[child // _LEAF]
            ok = (s + np.bitwise_count(differ) <= bits) & (differ & key == 0)
            yield q[ok], child[ok]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """root after the links a-b; a root is the smallest index of its component."""
    while len(a):
        a, b = root[a], root[b]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        differ = lo < hi
        a, b = lo[differ], hi[differ]
        np.minimum.at(root, b, a)
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _runs(mask: int) -> list[tuple[int, int]]:
    """(first bit, width) of the runs of ones."""
    out, at = [], 0
    while mask >> at:
        if mask >> at & 1:
            width = 1
            while mask >> (at + width) & 1:
                width += 1
            out.append((at, width))
            at += width
        else:
            at += 1
    return out


def front(fps: np.ndarray, mask: int) -> np.ndarray:
    """The fingerprints with the bits of ``mask`` moved in front of the others."""
    out, left = np.zeros(len(fps), np.uint64), 64
    for at, width in _runs(mask) + _runs(~mask & (1 << 64) - 1):
        left -= width
        out |= (fps >> np.uint64(at) & np.uint64((1 << width) - 1)) << np.uint64(left)
    return out


def stars(fps: np.ndarray, mask: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, hub) for each one that isn't its component's hub, by the links that differ in no bit of mask."""
    fps = np.unique(fps)
    moved = front(fps, mask)
    order = np.argsort(gray_rank(moved), kind="stable")
    fps, moved = fps[order], moved[order]
    width = mask.bit_count()
    root = np.arange(len(fps))
    for i, j in near_pairs(moved, bits, ((1 << width) - 1) << (64 - width)):
        root = _merge(root, i, j)
    own = np.flatnonzero(root != np.arange(len(root)))
    return fps[own], fps[root[own]]


def _pair_masks() -> list[int]:
    cuts, at = [], 0
    for w in _BLOCKS:
        cuts.append(((1 << w) - 1) << at)
        at += w
    return [cuts[i] | cuts[j] for i in range(6) for j in range(i + 1, 6)]


def longer(mask: int, bits: int = BITS) -> list[int]:
    """mask with each one of ``bits`` + 1 blocks of the other bits."""
    rest = [k for k in range(64) if not mask >> k & 1]
    cuts = [round(len(rest) * k / (bits + 1)) for k in range(bits + 2)]
    return [mask | sum(1 << k for k in rest[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dealt(fps: DataFrame, hot: int, bits: int) -> DataFrame:
    """(mask, key, pair, fp): the fingerprints of every key; pair is above 0 for a pair of parts."""
    spark = fps.sparkSession
    masks = F.array(*[F.lit(_signed(m)) for m in _pair_masks()])
    rows = fps.select("fp", F.explode(masks).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    out, seen = None, set(_pair_masks())
    for _ in range(REFINED):
        large = written(rows.groupBy("mask", "key").count().where(F.col("count") > hot).select("mask", "key"), "hot")
        if large.isEmpty():
            own = rows.withColumn("pair", F.lit(0))
            return own if out is None else out.unionByName(own)
        cool = rows.join(large, ["mask", "key"], "left_anti").withColumn("pair", F.lit(0))
        out = cool if out is None else out.unionByName(cool)
        then = spark.createDataFrame([(_signed(m), _signed(x)) for m in seen for x in longer(m, bits)], "mask long, next long")
        seen = {x for m in seen for x in longer(m, bits)}
        rows = written(rows.join(large, ["mask", "key"], "left_semi").join(F.broadcast(then), "mask").select(F.col("next").alias("mask"), F.col("fp").bitwiseAND(F.col("next")).alias("key"), "fp"), "longer")  # then: 15 * 5^2 * 5 rows at most
    sizes = rows.groupBy("mask", "key").agg(F.ceil(F.count(F.lit(1)) / hot).cast("int").alias("parts"))
    own = rows.join(sizes, ["mask", "key"]).withColumn("p", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    pairs = own.select("mask", "key", "fp", "parts", "p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q"))
    return out.unionByName(pairs.select("mask", "key", (F.least("p", "q") * F.col("parts") + F.greatest("p", "q") + 1).alias("pair"), "fp"))


def links(fps: DataFrame, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """(u, v), u > v: stars whose closure is that of all links of the distinct ``fps`` (fp)."""
    ship(fps.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def out(mask: np.ndarray, key: np.ndarray, pair: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            # one index for all keys of a table, and one for each pair of parts
            change = (mask[1:] != mask[:-1]) | (pair[1:] != pair[:-1]) | ((pair[1:] > 0) & (key[1:] != key[:-1]))
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(fp)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                u, v = stars(fp[a:b].view(np.uint64), int(mask[a]) & (1 << 64) - 1, bits)
                u, v = u.view(np.int64), v.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
            rows += batch.num_rows
            if rows < _TOGETHER:
                continue
            mask, key, pair, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            change = np.flatnonzero((mask[1:] != mask[:-1]) | (pair[1:] != pair[:-1]) | (key[1:] != key[:-1])) + 1
            cut = change[-1] if len(change) else 0  # the last key may go on
            held = [tuple(x[cut:].copy() for x in (mask, key, pair, fp))]
            rows = len(held[0][0])
            if cut:
                yield from out(mask[:cut], key[:cut], pair[:cut], fp[:cut])
        if rows:
            yield from out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    order = ["mask", "pair", "key"]
    dealt = _dealt(fps, hot, bits).select("mask", "key", "pair", "fp").repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(each, "u long, v long").distinct()


# ---- components


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v): each node that has a smaller one in its component, with the smallest one. edges: (u, v), u > v."""
    edges = written(edges.select("u", "v").distinct(), "edges")
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        tied = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        edges = written(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, hot: int = HOT) -> DataFrame:
    """(id, fingerprint, component_id), one row per row of docs.

    Null, empty and blank texts have the fingerprint 0 and are linked like any other. Rows that repeat
    an id each give a row. Null ids are no component's id unless a component has no other. An empty
    table gives no rows. Columns other than the two named are ignored.
    """
    rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "distinct")
    tied = components(links(fps.select("fp"), bits, hot))
    hub = fps.join(tied, F.col("fp") == F.col("u"), "left").select("fp", "least", "rows", F.coalesce("v", "fp").alias("hub"))
    named = hub.join(hub.groupBy("hub").agg(F.min("least").alias("component")), "hub").select("fp", "component", "rows")
    out = join_unique(rows, written(named, "named"), "fp", "rows", rows.count())
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component: that of the smallest id; all columns stay. Rows with a null id stay only where a component has no id. Of rows that repeat the id that stays, all stay."""
    found = classes(docs, id_col, text_col)
    lost = written(found.where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(id_col).distinct(), "near")
    return without(docs, lost, id_col)
