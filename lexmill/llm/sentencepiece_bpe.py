"""Operator 2: SentencePiece encoding and decoding, exact merge-type encoding by backtracking.

A text is cut into parts wherever no piece has the two characters side by side: no merge can join
them (so a part is at most a word with its marks in front). A part is encoded once per worker and kept. An Aho-Corasick automaton over the pieces gives the longest piece at each position. The encoder
takes it if the position behind it has not failed and if it is compatible with the piece before:
merging the two pieces' characters anew gives the same two pieces. Else it takes the next shorter
piece; when none is left, it marks the position as failed in a bitfield and gives back the piece
before. Characters without a piece become byte pieces. Ids are decoded one by one.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship

MARK = "▁"
#: Entries of the younger half of a worker's memory of parts; beyond that, it becomes the older half.
REMEMBERED = 100_000
_LONG = 200  # longer parts are not remembered
#: Rows that digests() takes at a time; Spark's batches of 10,000 rows and their ids would stay in a worker's memory after the task.
_ROWS = 500

# A broken byte becomes one replacement character, and so does each further byte of a broken character.
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Codec:
    """The merges of a SentencePiece BPE model with byte fallback."""

    def __init__(self, model_path: str) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.score, self.id, self.piece, self.byte, self.byte_of = {}, {}, [], [0] * 256, {}
        self.end = sp.eos_id()
        self.automaton = ahocorasick.Automaton()
        for i in range(sp.get_piece_size()):
            name = sp.id_to_piece(i)
            self.piece.append("" if sp.is_control(i) else name)
            if sp.is_byte(i):
                self.byte[int(name[3:5], 16)], self.byte_of[i] = i, int(name[3:5], 16)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[name], self.id[name] = sp.get_score(i), i
                self.automaton.add_word(name, len(name))
        self.automaton.make_automaton()
        # a number for each character that pieces have (0: any other), and which of them some piece has side by side
        known = sorted({c for name in self.score for c in name})
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in known]] = np.arange(1, len(known) + 1)
        self.joins = np.zeros((len(known) + 1) ** 2, bool)
        self.kinds = len(known) + 1
        for name in self.score:
            n = self.number[[ord(c) for c in name]]
            self.joins[n[:-1] * self.kinds + n[1:]] = True
        # what an id says: its piece's text, or its byte, those beyond ASCII as surrogateescape has them
        self.says = [chr(b + (0xDC00 if b > 127 else 0)) if (b := self.byte_of.get(i)) is not None else p.replace(MARK, " ") for i, p in enumerate(self.piece)]
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.shorter: dict[str, str | None] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: str | None, piece: str) -> bool:
        """Whether piece can follow before (None: whether it can come first)."""
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 2 * REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self.merged((before or "") + piece) == ([piece] if before is None else [before, piece])
        return known

    def next_shorter(self, piece: str) -> str | None:
        if piece not in self.shorter:
            cut = next((n for n in range(len(piece) - 1, 1, -1) if piece[:n] in self.score), 1)
            self.shorter[piece] = piece[:cut] if len(piece) > 1 else None
        return self.shorter[piece]

    def pieces(self, part: str) -> list[str]:
        """The pieces (or single characters without one) of a part."""
        n = len(part)
        longest = [1] * n
        for end, size in self.automaton.iter(part):  # a later match from the same start is longer
            longest[end - size + 1] = size
        out: list[str] = []
        failed, at = bytearray(n // 8 + 1), 0
        before, piece, pairs = None, part[: longest[0]] if n else None, self.pairs
        while piece is not None:
            end = at + len(piece)
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = pairs.get((before, piece))
                if self.fits(before, piece) if fits is None else fits:
                    out.append(piece)
                    before, at = piece, end
                    piece = part[at : at + longest[at]] if at < n else None
                    continue
            piece = self.next_shorter(piece)
            if piece is None:
                if not out:
                    raise ValueError(f"no encoding of {part[:80]!r}")
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                before = out[-1] if out else None
                at -= len(piece)
        return out

    def part_ids(self, part: str) -> list[int]:
        ids: list[int] = []
        for p in self.pieces(part):
            i = self.id.get(p)
            ids += [i] if i is not None else [self.byte[b] for b in p.encode("utf-8", "surrogatepass")]
        return ids

    def parts(self, text: str | None) -> list[str]:
        """The parts of a text, with a mark in front and for each space; none of an empty one."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        number = self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cuts = (np.flatnonzero(~self.joins[number[:-1] * self.kinds + number[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def encode(self, text: str | None) -> list[int]:
        """The library's ids, with the end id. A null text counts as an empty one."""
        return [i for p in self.parts(text) for i in self.part_ids(p)] + [self.end]

    @staticmethod
    def text_of(said: str) -> bytes:
        """The UTF-8 text of what ids say."""
        try:
            return said.encode()
        except UnicodeEncodeError:
            return said.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte").encode()

    def decode(self, ids: list[int]) -> str:
        said = "".join([self.says[i] for i in ids])
        first = next((i for i in ids if self.piece[i]), None)
        return self.text_of(said[1:] if first is not None and self.piece[first].startswith(MARK) else said).decode()


class _Memory(dict):
    """part -> its ids in decimal. When it is full, it becomes the older half and starts anew."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.old = codec, {}

    def __missing__(self, part: str) -> str:
        found = self.old.get(part)
        if found is None:
            found = " ".join(map(str, self.codec.part_ids(part)))
        if len(part) <= _LONG:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[part] = found
        return found


_workers: dict[str, tuple[Codec, _Memory, dict[str, str]]] = {}


def worker(model_path: str) -> tuple[Codec, _Memory, dict[str, str]]:
    """A worker's codec, its memory of parts, and what each id (in decimal) says; they outlast a task."""
    if model_path not in _workers:
        c = Codec(model_path)
        _workers[model_path] = c, _Memory(c), {str(i): t for i, t in enumerate(c.says)}
    return _workers[model_path]


def encode_table(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array, decoded): the ids with the end id, and the text they decode to.

    Null and empty texts have the end id only and decode to an empty text. Each row gives a row.
    Columns other than the two named are ignored; an empty table gives no rows.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, _, _ = worker(model_path)
        for batch in batches:
            ids = [c.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode(x) for x in ids])], names=["id", "ids", "decoded"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(each, f"id {rows.schema[0].dataType.simpleString()}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def _digests(batches: Iterator[pa.RecordBatch], model_path: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """The rows of digests() for batches of (id, text), some at a time."""
    c, known, says = worker(model_path)
    end = str(c.end)
    for batch in (whole.slice(at, _ROWS) for whole in batches for at in range(0, whole.num_rows, _ROWS)):
        n, ids_sha, text_sha, arrays = [], [], [], []
        for text in batch.column(1):
            text = text.as_py()
            ids = " ".join([known[p] for p in c.parts(text)] + [end])
            each_id = ids.split(" ")
            said = "".join([says[i] for i in each_id])
            n.append(len(each_id))
            if with_ids:
                arrays.append(np.array(each_id, np.int32))
            ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
            text_sha.append(hashlib.sha256(c.text_of(said[1:] if said[:1] == " " else said)).hexdigest())
        columns = {"id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if with_ids:
            flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
            columns["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_pydict(columns)


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encode_table()'s rows, and their ids (array<int>) if asked for."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digests(batches, model_path, with_ids)

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(each, f"id {rows.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids).withColumnRenamed("id", id_col)
