"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled as good, the unlabelled web text is
every document without a label to learn from; labels that say bad are never
used. A text is described by numbers about its shape (shares of symbols,
capitals, repeated words, lines ...), each cut into ranges at the quantiles
of the sample; the score is the logistic of a sum of one weight for each
number's range.

1. A classifier of positives against unlabelled text orders the texts.
2. The class prior is the least ratio, over the upper parts of that order, of
   the unlabelled share to the positive share: an upper part without bad
   texts holds the prior times as many unlabelled as positive texts.
3. The weights minimise the non-negative unbiased risk: prior * risk of the
   positives as good + max(0, risk of the unlabelled as bad - prior * risk of the positives as bad).

The fit runs on at most ``most_positives`` and ``most_unlabelled`` rows, those
with the smallest hash of their id; scores are for every row. Labels of ids
whose crc32 leaves remainder 0 by ``folds`` are never read.

Null text counts as empty, an empty text has a score. A null id is in the
held-out fold and is never learned from. An id with several labels is a
positive if all of them are good. Without positives, or without unlabelled
text, nothing is learned and every score is 0.5. Rows are kept one by one;
equal texts get equal scores, and of equal hashes the smaller id is taken into
the sample first. An empty table gives an empty table. A text of any length is
described whole, while it is at hand. ``score`` reads only the columns named;
``keep_good`` keeps every column, whatever its name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roomtide.llm.text import held_out, map_batches, one_column, text_bytes

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(0x80, 0x100))
DIGITS = b"0123456789"
SIGNS = b"#*$%&|<>{}[]\\^~@=+_"
STOPS = b".,;:?"
RANGES = 16


def shape(text: bytes) -> list[float]:
    """What a score may look at; shares are of the characters or words."""
    n = max(1, len(text))
    words = text.split()
    k = max(1, len(words))
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    without = lambda chars: (len(text) - len(text.translate(None, chars))) / n
    letters = without(LETTERS)
    triples = Counter(zip(words, words[1:], words[2:]))
    return [
        np.log1p(len(words)), without(SIGNS), without(UPPER) / max(letters, 1e-9), without(DIGITS), without(STOPS), letters,
        text.count(b"!") / k, text.count(b"|") / k, text.count(b"http") / k, len(b"".join(words)) / k,
        len(seen) / k * np.log1p(k), max(seen.values(), default=0) / k,
        sum(a == b for a, b in zip(words, words[1:])) / k,
        sum(c for c in triples.values() if c > 1) / k,
        sum(w[-1] in SIGNS or w[-1] == 33 for w in words) / k,
        1 - len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)), max(map(len, words), default=0),
    ]


class Model:
    """Range borders and weights; ``prior`` is the estimated share of good texts."""

    def __init__(self, borders: list[np.ndarray], weights: np.ndarray, prior: float):
        self.borders, self.weights, self.prior = borders, weights, prior

    def ranges(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, x[:, k], side="right") + k * RANGES for k, b in enumerate(self.borders)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.ranges(x)].sum(axis=1) + self.weights[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(x))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(cells: np.ndarray, slope: Callable[[np.ndarray], np.ndarray], size: int, steps: int, decay: float) -> np.ndarray:
    """Adam over the weights; ``slope`` gives the risk's derivative by each row's logit."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    flat = cells.ravel()
    for t in range(1, steps + 1):
        d = slope(w[cells].sum(axis=1) + w[-1])
        g = np.bincount(flat, np.repeat(d, cells.shape[1]), size) + decay * w
        g[-1] = d.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.5) -> float:
    """Least ratio, with one standard error added, of the shares above a border that keeps ``least`` of the positives."""
    ratios = []
    for b in np.quantile(positive, np.linspace(0.01, 1 - least, 40)):
        p, u = (positive >= b).mean(), max((unlabelled >= b).mean(), 1e-9)
        ratios.append(u / p * (1 + np.sqrt((1 - u) / (u * len(unlabelled)) + (1 - p) / (p * len(positive)))))
    return float(np.clip(min(ratios), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 1500) -> Model | None:
    if not len(positive) or not len(unlabelled):
        return None
    every = np.concatenate([positive, unlabelled])
    borders = [np.unique(np.concatenate([np.quantile(every[:, k], np.linspace(0, 1, RANGES // 2 + 1)[1:-1]), np.quantile(every[:, k], [0.01, 0.03, 0.06, 0.94, 0.97, 0.99])])) for k in range(every.shape[1])]
    model = Model(borders, np.zeros(RANGES * len(borders) + 1), 0.5)
    cells, size, n = model.ranges(every), len(model.weights), len(positive)
    is_positive = np.arange(len(every)) < n
    share = np.where(is_positive, 1 / n, 1 / len(unlabelled))
    decay = 2 / min(n, len(unlabelled))

    # each half is ordered by a classifier of the other half
    order, half = np.zeros(len(every)), np.arange(len(every)) % 2 == 0
    for part in (half, ~half):
        weights = _descend(cells[part], lambda z: share[part] * (_logistic(z) - is_positive[part]), size, steps // 8, decay)
        order[~part] = weights[cells[~part]].sum(axis=1) + weights[-1]
    model.prior = prior = class_prior(order[:n], order[n:])

    def slope(z: np.ndarray) -> np.ndarray:
        p = _logistic(z)  # the logistic risk's slope: p - 1 as good, p as bad
        as_bad = np.logaddexp(0, z)
        negative = as_bad[n:].mean() - prior * as_bad[:n].mean()
        unbiased = np.where(is_positive, -prior * share * p, share * p)
        good = np.where(is_positive, prior * share * (p - 1), 0)
        return good + unbiased if negative >= 0 else -unbiased

    model.weights = _descend(cells, slope, size, steps, decay / 200)
    return model


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
    folds: int = 5, most_positives: int = 20_000, most_unlabelled: int = 20_000,
) -> Model | None:
    docs = one_column(docs, doc_id=doc_id, text=text)
    marks = (
        one_column(labels, doc_id=doc_id, quality=quality).where(~held_out("doc_id", folds) & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left")

    def picked(rows: DataFrame, most: int) -> DataFrame:
        return rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def numbers(rows: DataFrame, most: int) -> np.ndarray:
        # a row for each picked id as a rule; ids that repeat are cut back to the bound
        texts = docs.join(F.broadcast(picked(rows, most)), "doc_id")
        shapes = map_batches(texts, lambda b: [pa.RecordBatch.from_arrays([b.column(0), pa.array([shape(x) for x in text_bytes(b.column(1))], pa.list_(pa.float64()))], names=["doc_id", "shape"])], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, shape array<double>")
        found = shapes.orderBy(F.xxhash64("doc_id"), "doc_id", "shape").limit(most).select("shape").toArrow().column(0).to_pylist()
        return np.array(found, float)

    return fit(numbers(ids.where("quality >= 1"), most_positives), numbers(ids.where("quality is null"), most_unlabelled))


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_scores(model, text_bytes(batch.column(1))))], names=["doc_id", "held_out", "score"])

    rows = one_column(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out("doc_id", folds))
    return map_batches(rows, run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch):
        yield batch.filter(pa.array(_scores(model, text_bytes(batch.column(at))) >= threshold))

    return map_batches(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))


def _scores(model: Model | None, texts: list[bytes]) -> np.ndarray:
    return np.full(len(texts), 0.5) if model is None else model.scores(np.array([shape(x) for x in texts], float))
