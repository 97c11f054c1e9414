"""Fill-in-the-middle: cut a text at two line ends and put the parts in another order.

A text's units are its lines, each with its line feed. The offsets at which
units end are kept as a set of integers in containers of 65,536 places: a
sorted array of few places, a bitmap of many, or runs of neighbouring places
(empty lines), whichever is smallest, beside the cumulative cardinalities of
the containers before. The k-th end is found by a binary search for its
container and a select inside it, so a set is built once and answers both cuts.

Two numbers from the SHA-256 of seed and id choose the cuts, two more whether
a text is transformed and in which order. The forms:

``plain``  the text (it is empty, holds one of the marks, or isn't chosen)
``psm``    ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
``spm``    ``<S>`` suffix ``<P>`` prefix ``<M>`` middle

Null text counts as empty: plain, no units. A null id hashes as an empty
string. Rows are kept one by one, and rows with one id and text give one
result. Texts are of any length: a container is built from its own slice of
the text. Of other columns, ``transform`` keeps all but those with the name of
an output, which replaces them; ``digests`` returns its own columns alone. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roomtide.llm.text import map_batches, one_column

SPAN = 1 << 16
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")


class ArrayContainer:
    """Places as sorted 16-bit numbers."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype("<u2")

    @staticmethod
    def size(places: np.ndarray) -> int:
        return 2 * len(places)

    def select(self, k: int) -> int:
        return int(self.places[k])


class BitmapContainer:
    """A bit for each of the 65,536 places, and the number of bits before each group of 64."""

    def __init__(self, places: np.ndarray):
        bits = np.zeros(SPAN, bool)
        bits[places] = True
        self.bits = np.packbits(bits, bitorder="little")
        counts = bits.reshape(-1, 64).sum(axis=1)
        self.before = (np.cumsum(counts) - counts).astype("<u2")

    @staticmethod
    def size(places: np.ndarray) -> int:
        return SPAN // 8 + SPAN // 32

    def select(self, k: int) -> int:
        group = int(np.searchsorted(self.before, k, side="right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[8 * group:8 * group + 8], bitorder="little"))
        return 64 * group + int(inside[k - int(self.before[group])])


class RunContainer:
    """First places of runs, and the number of places before each."""

    def __init__(self, places: np.ndarray):
        at = self.begins(places)
        self.first, self.before = places[at].astype("<u2"), at.astype("<u2")

    @staticmethod
    def begins(places: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], np.diff(places) != 1]))

    @classmethod
    def size(cls, places: np.ndarray) -> int:
        return 4 * len(cls.begins(places))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(places: np.ndarray):
    """The smallest container of sorted distinct places (at least one); ties go to the first kind."""
    kind = min((ArrayContainer, BitmapContainer, RunContainer), key=lambda c: c.size(places))
    return kind(places)


class Boundaries:
    """The offsets, in code points, at which the units of a text end."""

    def __init__(self, text: str):
        self.keys, self.containers, sizes = [], [], []
        for key, at in enumerate(range(0, len(text), SPAN)):
            # the last place of a unit stands for its end, one further on, so a slice has its own units
            part = text[at:at + SPAN]
            places = np.flatnonzero(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4") == 10) if "\n" in part else np.empty(0, np.int64)
            if at + len(part) == len(text) and part[-1] != "\n":
                places = np.append(places, len(part) - 1)
            if len(places):
                self.keys.append(key)
                self.containers.append(container(places))
                sizes.append(len(places))
        self.upto = list(accumulate(sizes))

    def __len__(self) -> int:
        return self.upto[-1] if self.upto else 0

    def end(self, units: int) -> int:
        """The offset behind the first ``units`` units."""
        if not units:
            return 0
        k = units - 1
        which = bisect_right(self.upto, k)
        inside = k - (self.upto[which - 1] if which else 0)
        return self.keys[which] * SPAN + self.containers[which].select(inside) + 1


def draws(doc_id, seed: int) -> list[int]:
    """Four 32-bit numbers of an id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


def transformed(doc_id, text: str | None, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, characters of prefix and middle, and the new text."""
    text = text or ""
    ends = Boundaries(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends.end(low), ends.end(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restored(output: str, form: str) -> str:
    """The text that ``transformed`` had; no mark overlaps itself or another, so the first of each is the one put in."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = head[len(PREFIX):].split(SUFFIX, 1)
    else:
        suffix, prefix = head[len(SUFFIX):].split(PREFIX, 1)
    return prefix + middle + suffix


def transform(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """``df`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    new = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}
    keep = [f for f in df.schema.fields if f.name.lower() not in new]
    places, at_id, at_text = [df.columns.index(f.name) for f in keep], df.columns.index(doc_id), df.columns.index(text)

    def run(batch: pa.RecordBatch):
        rows = [transformed(i, t, seed, percent, spm_percent) for i, t in zip(batch.column(at_id).to_pylist(), batch.column(at_text).to_pylist())]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in places), *(pa.array(v, k) for v, k in zip(zip(*rows), kinds))], names=[*(f.name for f in keep), *new])

    return map_batches(df, run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), *(f"`{c}` {k}" for c, k in new.items())]))


def restore(df: DataFrame, output: str = "output", form: str = "form", text: str = "restored") -> DataFrame:
    """``df`` with the texts rebuilt from outputs and forms; a null output or an unknown form gives null."""
    keep = [f for f in df.schema.fields if f.name.lower() != text.lower()]
    places, at, at_form = [df.columns.index(f.name) for f in keep], df.columns.index(output), df.columns.index(form)

    def run(batch: pa.RecordBatch):
        back = [None if o is None or f not in FORMS else restored(o, f) for o, f in zip(batch.column(at).to_pylist(), batch.column(at_form).to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in places), pa.array(back, pa.string())], names=[*(f.name for f in keep), text])

    return map_batches(df, run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"`{text}` string"]))


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``df``: units, form, lengths, and the SHA-256 of the output and of the text rebuilt from it.

    Output and rebuilt text live for one row at a time, so neither is sent back to the JVM.
    """
    docs = one_column(df, doc_id=doc_id, text=text)

    def run(batch: pa.RecordBatch):
        rows = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            *numbers, output = transformed(i, t, **options)
            back = restored(output, numbers[1])
            rows.append((*numbers, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip(zip(*rows), kinds))], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")
