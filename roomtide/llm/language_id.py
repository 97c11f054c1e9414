"""Language identification: the family first, then one-versus-one support vector machines inside it.

A text is described by its sequences of one to four bytes, in lower case and
with every run of ASCII signs but letters as one space, counted in
``FEATURES`` cells by hash; a cell's value is the square root of its count,
and the whole has length 1. Long texts are counted slice by slice.

``FAMILIES`` says which languages are closely related; a language it lacks is
a family of its own. One linear machine for each family against all others
picks the family. In it, a linear machine for every pair of its languages
votes with a probability; the language with the largest sum wins, ties go to
the first by name. Machines are fitted by dual coordinate descent on the
squared hinge loss. A margin becomes a probability by a logistic curve fitted
to margins of rows the machine hasn't seen. The score is the share of the
family among the families times the share of the language inside it.

The fit runs on at most ``most_rows`` documents, shared out evenly over the
languages, those with the smallest hash of their id; predictions are for every
row. Which ids may be candidates is decided from counts by language, so what
is shuffled doesn't grow with the table. The model holds ``FEATURES`` numbers
for each family and each pair of a family.

Only text and language of documents whose crc32 leaves a remainder by
``folds`` are read for learning. Null text, or text without a letter, is
``und`` with score 0. Null ids are held out; null languages are never learned.
Repeated rows are predicted one by one. Without anything to learn from,
every row is ``und`` with score 0; with one language every row with letters
is that language with score 1. An empty table gives an empty table. Only the
columns named are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from roomtide.llm.text import held_out, map_batches, one_column

BITS = 13
FEATURES = 1 << BITS
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)  # odd numbers that spread a sequence's bits upwards
SLICE_CHARS = 1 << 14
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
LETTERS_ONLY = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))

#: ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms su tl",
}


def family_of(lang: str, families: dict[str, str] | None = None) -> str:
    """The family of a code such as ``pt`` or ``pt-BR``; other names are their own."""
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in (FAMILIES if families is None else families).items() if code in codes.split()), f"={lang}")


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells and values of a text, or None without a letter."""
    if not LETTER.search(text):
        return None
    counts = np.zeros(FEATURES, np.int64)
    for part in cut(text):
        count(part.lower().encode("utf-8", "replace").translate(LETTERS_ONLY).split(), counts)
    at = np.flatnonzero(counts)
    value = np.sqrt(counts[at])
    return at.astype(np.int32), (value / np.linalg.norm(value)).astype(np.float32)


def cut(text: str) -> Iterator[str]:
    """Slices that end behind a space where there is one near the end."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE_CHARS)
        if end < len(text):
            end = max(text.rfind(" ", at + SLICE_CHARS // 2, end), text.rfind("\n", at + SLICE_CHARS // 2, end)) + 1 or end
        yield text[at:end]
        at = end


def count(words: list[bytes], counts: np.ndarray) -> None:
    """Add the byte sequences of length 1 to 4 of words between spaces."""
    if not words:
        return
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code, cells = raw, np.empty(4 * len(raw), np.int64)
    at = 0
    for width in range(1, 5):
        if width > 1:
            code = (code[:-1] << np.uint32(8)) | raw[width - 1:]
        cells[at:at + len(code)] = (code * np.uint32(MULTIPLIERS[width - 1])) >> np.uint32(32 - BITS)
        at += len(code)
        if len(code) < 2:
            break
    counts += np.bincount(cells[:at], minlength=FEATURES)


class Machine:
    """A linear machine with a logistic curve over its margin; the last weight is the bias."""

    def __init__(self, weights: np.ndarray, slope: float, shift: float):
        self.weights, self.slope, self.shift = weights.astype(np.float32), slope, shift


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """Weights of least squared hinge loss by dual coordinate descent; both sides weigh the same in sum."""
    w, alpha = np.zeros(FEATURES + 1), np.zeros(len(rows))
    weight = {side: cost * len(y) / (2 * max(1, (y == side).sum())) for side in (1, -1)}
    soft = np.array([1 / (2 * weight[int(side)]) for side in y])
    order = np.random.default_rng(11)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            slope = y[i] * (w[at] @ x + w[-1]) - 1 + alpha[i] * soft[i]
            new = max(0.0, alpha[i] - slope / (2 + soft[i]))  # a text and the bias have length 1 each
            step = new - alpha[i]
            if step:
                worst = max(worst, abs(step) * (2 + soft[i]))
                alpha[i] = new
                w[at] += step * y[i] * x
                w[-1] += step * y[i]
        if worst < 0.02:
            break
    return w


def logistic(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the likeliest curve, with the targets drawn in by one row of each side."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        d, v = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * margins**2).sum() + 1e-6, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, [(d * margins).sum(), d.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (float(a), float(b)) if np.isfinite([a, b]).all() and a > 0 else (2.0, 0.0)


def machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 4.0, epochs: int = 15) -> Machine:
    """Fitted to all rows; the curve to the margins that machines of one half give the other."""
    margins, half = np.zeros(len(rows)), np.arange(len(rows)) % 2 == 0
    for part in (half, ~half):
        w = descend([rows[i] for i in np.flatnonzero(part)], y[part], cost, epochs)
        for i in np.flatnonzero(~part):
            margins[i] = w[rows[i][0]] @ rows[i][1] + w[-1]
    return Machine(descend(rows, y, cost, epochs), *logistic(margins, y))


class Model:
    """Families with their languages, a machine for each family and for each pair inside one."""

    def __init__(self, languages: dict[str, list[str]], families: list[Machine], pairs: dict[str, list[Machine]]):
        self.languages, self.names, self.pairs = languages, sorted(languages), pairs
        machines = [*families, *(m for f in self.names for m in pairs[f])]
        self.weights = np.stack([m.weights for m in machines]) if machines else np.zeros((0, FEATURES + 1), np.float32)
        self.slopes, self.shifts = np.array([m.slope for m in machines]), np.array([m.shift for m in machines])
        self.first, at = {}, len(families)
        for f in self.names:
            self.first[f] = at
            at += len(pairs[f])

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text) if text else None
        if found is None or not self.names:
            return UNKNOWN, 0.0
        at, x = found
        margin = self.weights[:, at] @ x + self.weights[:, -1]
        chance = 1 / (1 + np.exp(-np.clip(self.slopes * margin + self.shifts, -30, 30)))
        family, share = 0, 1.0
        if len(self.names) > 1:
            of = chance[: len(self.names)]
            # ordered by margin on the curve; chances of far margins are equal
            family = int(np.argmax(self.slopes[: len(of)] * margin[: len(of)] + self.shifts[: len(of)]))
            share = float(of[family] / of.sum())
        name = self.names[family]
        languages = self.languages[name]
        votes = np.zeros(len(languages))
        for (i, j), p in zip(combinations(range(len(languages)), 2), chance[self.first[name]:]):
            votes[i] += p
            votes[j] += 1 - p
        best = int(np.argmax(votes))
        inside = float(votes[best] / votes.sum()) if len(languages) > 1 else 1.0
        return languages[best], min(1.0, max(0.0, share * inside))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], families: dict[str, str] | None = None) -> Model:
    languages: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        languages.setdefault(family_of(lang, families), []).append(lang)
    names, lang = sorted(languages), np.array(langs, object)
    of = np.array([family_of(x, families) for x in langs], object)
    heads = [machine(rows, np.where(of == f, 1, -1)) for f in names] if len(names) > 1 else []
    pairs = {}
    for f in names:
        pairs[f] = []
        for a, b in combinations(languages[f], 2):
            among = np.flatnonzero((lang == a) | (lang == b))
            pairs[f].append(machine([rows[i] for i in among], np.where(lang[among] == a, 1, -1)))
    return Model(languages, heads, pairs)


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, most_rows: int = 2400, families: dict[str, str] | None = None) -> Model:
    rows = one_column(docs, doc_id=doc_id, text=text, lang=lang).where(~held_out("doc_id", folds) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("lang", F.col("lang").cast("string"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return fit([], [], families)
    each = max(4, most_rows // len(counts))
    # in a sample of this share the ``each`` smallest hashes are found but for a chance of nothing
    share = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, min(1.0, (2.0 * each + 100) / n))))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    some = rows.where(place < share[F.col("lang")] * float(1 << 32))
    first = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    picked = some.withColumn("place", place).withColumn("k", F.row_number().over(first)).where(F.col("k") <= each).select("lang", "k", "text")

    def run(batch: pa.RecordBatch):
        found = [features(t) or (np.empty(0, np.int32), np.empty(0, np.float32)) for t in batch.column(2).to_pylist()]
        cells = [pa.array([x.tobytes() for x in column], pa.binary()) for column in zip(*found)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cells], names=["lang", "k", "cells", "values"])

    table = map_batches(picked, run, "lang string, k int, cells binary, values binary").orderBy("lang", "k").toArrow()
    order = np.random.default_rng(5).permutation(table.num_rows)
    cells, values, langs = (table.column(c).to_pylist() for c in ("cells", "values", "lang"))
    return fit([(np.frombuffer(cells[i], np.int32), np.frombuffer(values[i], np.float32)) for i in order], [langs[i] for i in order], families)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        langs, scores = zip(*map(known.value.predict, batch.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = one_column(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out("doc_id", folds))
    return map_batches(rows, run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
