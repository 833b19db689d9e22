"""Operator 6: a quality classifier, histogram gradient-boosted trees over document statistics.

The trees are flattened into arrays (gbdt.Model), which numpy walks for all documents of a batch at
once. Statistics are of the whole text: sizes, repetition of words, word pairs and lines, and shares
of characters of each class.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.llm import gbdt, labelled

BY, HELD_OUT = 3, 1
ACCEPT = 0.5
FOLDS = 4
#: Of a byte: 0 lower-case letter or part of a character beyond ASCII, 1 capital, 2 digit, 3 blank, 4 sentence mark, 5 other sign.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[128:] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:'\"-"]] = 4
NAMES = ("chars", "words", "lines", "word_mean", "word_sd", "distinct", "top_word", "distinct_pairs", "distinct_lines", "top_line", "line_mean", "ended_lines", "caps_words", "capitals", "digits", "marks", "signs", "exclaimed", "once", "distinct_per_root")


def features(text: str) -> np.ndarray:
    """The statistics named in NAMES; an empty text gives zeros."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_CLASS[raw], minlength=6) / max(len(raw), 1)
    words = text.split()
    n = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    m = max(len(lines), 1)
    line = Counter(lines)
    return np.array([
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(len(lines)),
        float(sizes.mean()) if len(words) else 0.0, float(sizes.std()) if len(words) else 0.0,
        len(seen) / n, max(seen.values(), default=0) / n, len(set(zip(words, words[1:], strict=False))) / n,
        len(line) / m, max(line.values(), default=0) / m, math.log1p(len(text) / m),
        sum(x.rstrip()[-1:] in ".!?:" and x.rstrip() != "" for x in lines) / m,
        sum(map(str.isupper, words)) / n, kinds[1], kinds[2], kinds[4], kinds[5], text.count("!") / n,
        sum(c == 1 for c in seen.values()) / n, len(seen) / math.sqrt(n),
    ])


def _table(texts) -> np.ndarray:
    return np.array([features(t or "") for t in texts]).reshape(len(texts), len(NAMES))


def train(rows: pd.DataFrame) -> tuple[gbdt.Model, gbdt.Isotonic]:
    """rows: (id, text, y). Without rows of both labels the score is a constant."""
    x, y = _table(rows["text"].tolist()), rows["y"].to_numpy(np.int64)
    fold, p = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for k in range(FOLDS):
        if (fold == k).any():
            p[fold == k] = gbdt.fit(x[fold != k], y[fold != k]).probability(x[fold == k])
    whole = gbdt.fit(x, y, trees=80)
    return whole, gbdt.isotonic(p, y) if len(y) and y.min() != y.max() else gbdt.isotonic(p[:0], y[:0])


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row per row. Null texts count as empty ones, which have a
    score too. A null id is not held out. Without usable labels all scores are alike."""
    model = train(labelled.sample(docs, labels, "quality", BY, HELD_OUT, id_col, text_col))
    sent = ship(docs.sparkSession).sparkContext.broadcast(model)  # some 10 kB

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, calibrate = sent.value
        for batch in batches:
            x = np.array([features(t.as_py() or "") for t in batch.column(1)]).reshape(batch.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(calibrate(trees.probability(x)), pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(each, f"id {rows.schema[0].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
    return out.select(id_col, F.coalesce(labelled.remainder(F.col(id_col), BY) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
