"""Operator 4: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learnt: words and word beginnings whose documents are labelled toxic more often than
not, weighted by the lower end of their log odds. Features are densities of lexicon words at several
weights, their nearness to words of the second person, and rates of capitals, punctuation and
obfuscation (letters mixed with digits or signs; such words are also looked up as they are meant).
Training features come from lexicons learnt on other folds, and the calibration from predictions for
other folds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship
from lexmill.llm import gbdt, labelled

#: Words of the second person.
YOU = frozenset("you your yours yourself u ur ya du dich dir dein deine deinen ihr euch euer sie ihnen tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros os tú".split())
#: Signs and digits that stand for letters.
MEANT = str.maketrans("013457@$!|+", "oieastasiit")
_CORE = re.compile(r"^[\W_]+|[\W_]+$")
_BEGINNINGS = (4, 5, 6)
_STEPS = np.array([1.0, 2.0, 3.0, 4.0, 5.0])
_NEAR = 5
FOLDS = 4
REMEMBERED = 250_000


def terms(core: str) -> list[str]:
    """The word itself, and its beginnings marked as such."""
    return [core, *(core[:k] + "-" for k in _BEGINNINGS if len(core) >= k)]


def learn(texts: list[str], y: np.ndarray, least: int = 3) -> dict[str, float]:
    """Term -> the lower end of its log odds, where above 1."""
    seen = (Counter(), Counter())
    for text, label in zip(texts, y.tolist(), strict=True):
        cores = {_CORE.sub("", w) for w in set(text.lower().split())}
        seen[label].update({t for c in cores if c for t in terms(c)})
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    out = {}
    for t, c in seen[1].items():
        if c >= least:
            d = seen[0][t]
            low = math.log((c + 0.5) / (n1 + 1)) - math.log((d + 0.5) / (n0 + 1)) - math.sqrt(1 / (c + 0.5) + 1 / (d + 0.5))
            if low > 1:
                out[t] = low
    return out


class _Tokens(dict):
    """A token -> a number: its weight's step (low three bits), then flags: second person, capitals, obfuscated, found only as meant."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon

    def step(self, core: str) -> int:
        return int(np.searchsorted(_STEPS, max((self.lexicon.get(t, 0.0) for t in terms(core)), default=0.0), side="right"))

    def __missing__(self, token: str) -> int:
        core = _CORE.sub("", token)
        low = core.lower()
        step = self.step(low) if low else 0
        letters = sum(c.isalpha() for c in token)
        mixed = 0 < letters and any(not c.isalpha() for c in core.strip("'’-"))
        meant = 0
        if mixed and not step:
            plain = re.sub(r"[\W\d_]+", "", token.lower().translate(MEANT))
            meant = self.step(plain) if len(plain) > 2 else 0
        code = max(step, meant) | (low in YOU) << 3 | (len(low) > 1 and core.isupper()) << 4 | mixed << 5 | bool(meant) << 6
        if len(token) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[token] = code
        return code


WIDTH = 18  # features of a text


def features(text: str, tokens: _Tokens) -> np.ndarray:
    """An empty text gives zeros."""
    words = text.split()
    n = max(len(words), 1)
    code = np.fromiter(map(tokens.__getitem__, words), np.int16, len(words))
    step = code & 7
    hits = [int((step >= k).sum()) for k in range(1, 6)]
    you = np.flatnonzero(code & 8)
    strong = np.flatnonzero(step >= 3)
    near = 0.0
    if len(you) and len(strong):
        after = np.searchsorted(you, strong)
        gap = np.minimum(np.abs(strong - you[np.minimum(after, len(you) - 1)]), np.abs(strong - you[np.maximum(after - 1, 0)]))
        near = float((gap <= _NEAR).mean())
    rate = lambda bit: float(((code >> bit) & 1).sum()) / n
    signs = text.count("!") + text.count("?")
    return np.array([math.log1p(len(words)), *(h / n for h in hits), *(math.log1p(h) for h in hits), len(you) / n, near, rate(4), signs / n, rate(5), rate(6), (signs + text.count(",") + text.count(".")) / n])


class Scorer(NamedTuple):
    lexicon: dict[str, float]
    model: gbdt.Model
    calibrate: gbdt.Isotonic


def _table(texts: list[str], lexicon: dict[str, float]) -> np.ndarray:
    tokens = _Tokens(lexicon)
    return np.array([features(t, tokens) for t in texts]).reshape(len(texts), WIDTH)


def train(rows: pd.DataFrame) -> Scorer:
    """rows: (id, text, y). Without rows of both labels the score is a constant."""
    texts, y = rows["text"].tolist(), rows["y"].to_numpy(np.int64)
    if len(y) == 0 or y.min() == y.max():
        return Scorer({}, gbdt.fit(np.zeros((len(y), 1)), y), gbdt.isotonic(np.zeros(0), y[:0]))
    fold = np.arange(len(y)) % FOLDS
    x = np.zeros((len(y), WIDTH))
    for k in range(FOLDS):
        own = np.flatnonzero(fold == k)
        others = np.flatnonzero(fold != k)
        x[own] = _table([texts[i] for i in own], learn([texts[i] for i in others], y[others]))
    p = np.zeros(len(y))
    for k in range(FOLDS):
        p[fold == k] = gbdt.fit(x[fold != k], y[fold != k]).probability(x[fold == k])
    return Scorer(learn(texts, y), gbdt.fit(x, y), gbdt.isotonic(p, y))


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row; null texts count as empty ones, and empty ones have a score too."""
    sent = ship(docs.sparkSession).sparkContext.broadcast(scorer)  # bounded by the training sample
    made: list[_Tokens] = []

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        tokens = made[0] if made else made.append(_Tokens(s.lexicon)) or made[0]
        for batch in batches:
            x = np.array([features(t.as_py() or "", tokens) for t in batch.column(1)]).reshape(batch.num_rows, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s.calibrate(s.model.probability(x)), pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(each, f"id {rows.schema[0].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


#: Rows of this remainder of the id's crc32 by 4 are never learnt from.
BY, HELD_OUT = 4, 2
REJECT = 0.3


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row per row. Without usable labels all scores are alike. A null id is not held out."""
    scorer = train(labelled.sample(docs, labels, "toxic", BY, HELD_OUT, id_col, text_col))
    out = score(docs, scorer, id_col, text_col)
    return out.select(id_col, F.coalesce(labelled.remainder(F.col(id_col), BY) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, corpus: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that are predicted toxic, decided row by row in one pass; all columns stay. corpus: the documents that labels are of."""
    scorer = train(labelled.sample(corpus, labels, "toxic", BY, HELD_OUT, id_col, text_col))
    sent = ship(docs.sparkSession).sparkContext.broadcast(scorer)
    made: list[_Tokens] = []

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        tokens = made[0] if made else made.append(_Tokens(sent.value.lexicon)) or made[0]
        x = np.array([features(t or "", tokens) for t in texts]).reshape(len(texts), WIDTH)
        return pd.Series(sent.value.calibrate(sent.value.model.probability(x)))

    return docs.where(toxic(F.col(text_col)) < REJECT)
