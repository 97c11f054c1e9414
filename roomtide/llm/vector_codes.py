"""Product codes of vectors, trained by exact k-means with norm-of-sum bounds.

Components become integers floor(256 x); a vector is cut into ``parts`` equal
parts, and every part position has a codebook of up to ``entries`` entries,
first those parts of the vectors with the smallest ids. A round assigns every
part to the nearest entry (squared distance, ties to the lower index), then
each entry moves to the floored mean of its parts; after the rounds all parts
are assigned once more. All sums and distances are whole numbers, so no order
of adding changes a result.

The first pass measures all distances. Of each part it keeps, for each of
``groups`` groups of entries, the distance to the nearest entry not its own,
rounded down to the upper half of a 32-bit float, and the round it was
measured in (its stamp). The driver keeps
the codebooks of all rounds. In a later round t an entry j of a bound stamped
s is at least ``bound - |C_j(t) - C_j(s)|`` away: the norm of the sum of its
moves, which is at most the sum of the norms of the single moves. Where the
largest such move of a group leaves the bound above the exact distance to the
own entry, the group holds neither a nearer entry nor a tie; only the other
groups are measured again and stamped anew. So a bound stands, with its old
stamp, until it fails.

Each pass is stored in the shared folder and read by the next, so a lost
executor repeats tasks of one pass. Sums of a round are made per task, then
by part, entry and place; what reaches the driver is a codebook in size. The
sum of errors over equal labels is made from sums of the labels, dealt over
``salts`` rows per label, so a label with many rows is not one task.

Rows take no part if their vector is null, empty, holds null or non-finite
components, has another length than the kept vector with the smallest id, or
can't be cut into equal parts. Null ids come last among the smallest; equal
ids are ordered by their vectors. Fewer vectors than entries make smaller
codebooks. Repeated rows are coded one by one. Components of 2^24 and more
are calculated with Python's integers; an error beyond 64 bits, and its
label's sum, is null. Without a kept row the result is empty. Only the
columns named are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtide.llm.text import map_batches, one_column
from roomtide.session import scratch_path

LIMIT = 1 << 24


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) as 64-bit integers, or as Python's where squares could overflow."""
    scaled = np.floor(256.0 * np.asarray(vectors, np.float64))
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        return np.vectorize(int, otypes=[object])(scaled)
    return scaled.astype(np.int64)


def packed(row: np.ndarray) -> bytes:
    """Whole numbers of a vector in the fewest bytes each, the first byte says how many (0: as text)."""
    if row.dtype == object:
        return b"\x00" + ",".join(map(str, row)).encode()
    for width in (1, 2, 4):
        if not len(row) or -(1 << 8 * width - 1) <= row.min() and row.max() < 1 << 8 * width - 1:
            return bytes([width]) + row.astype(f"<i{width}").tobytes()
    raise ValueError("a component of 2^31 and more in 64-bit integers")


def unpacked(rows: list[bytes]) -> np.ndarray:
    """The vectors of one batch as a matrix."""
    found = [np.array(list(map(int, x[1:].split(b","))), object) if not x[0] else np.frombuffer(x, f"<i{x[0]}", offset=1) for x in rows]
    if any(x.dtype == object for x in found):
        return np.stack([x.astype(object) for x in found])
    return np.stack([x.astype(np.int64) for x in found])


@dataclass
class Books:
    """The codebooks of all rounds so far: each an array (part, entry, place)."""

    history: list[np.ndarray]
    groups: int

    def __post_init__(self):
        _, entries, _ = self.history[0].shape
        self.cuts = [0, *np.cumsum([len(x) for x in np.array_split(np.arange(entries), min(self.groups, entries))]).tolist()]

    @property
    def newest(self) -> np.ndarray:
        return self.history[-1]

    def moves(self) -> np.ndarray:
        """For each stamp, part and group: the longest way of an entry from that round's codebook to the newest, rounded up."""
        out = []
        for old in self.history:
            way = np.sqrt(((self.newest - old) ** 2).sum(axis=2).astype(np.float64)) * (1 + 1e-12)
            out.append(np.stack([way[:, a:b].max(axis=1) for a, b in zip(self.cuts, self.cuts[1:])], axis=1))
        return np.stack(out)


def exact(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of parts (row, place) and entries (entry, place)."""
    total = 0
    for k in range(x.shape[1]):
        d = x[:, k, None] - book[None, :, k]
        total = total + d * d
    return total


def rounded_down(distance2: np.ndarray) -> np.ndarray:
    """Square roots as the upper halves of 32-bit floats, which are never larger."""
    root = (np.sqrt(distance2.astype(np.float64)) * (1 - 1e-6)).astype("<f4")
    return (root.view("<u4") >> 16).astype("<u2")


def opened(bounds: np.ndarray) -> np.ndarray:
    return (bounds.astype("<u4") << 16).view("<f4").astype(np.float64)


def whole_zeros(shape: tuple, *like: np.ndarray) -> np.ndarray:
    return np.zeros(shape, object if any(a.dtype == object for a in like) else np.int64)


def first_pass(x: np.ndarray, books: Books) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, part), bounds and stamps (row, part, group), and squared errors, with all distances measured."""
    n, parts, _ = x.shape
    codes, errors = np.zeros((n, parts), np.uint8), whole_zeros((n, parts), x, books.newest)
    bounds = np.zeros((n, parts, len(books.cuts) - 1), np.uint16)
    rows = np.arange(n)
    for p in range(parts):
        d = exact(x[:, p], books.newest[p])
        own = d.argmin(axis=1)
        codes[:, p], errors[:, p] = own, d[rows, own]
        bounds[:, p] = nearest_others(d, own, books.cuts)
    return codes, bounds, np.full(bounds.shape, len(books.history) - 1, np.uint8), errors


def nearest_others(d: np.ndarray, own: np.ndarray, cuts: list[int]) -> np.ndarray:
    """For each group the least distance but to the own entry, rounded down."""
    far = d.astype(np.float64)
    far[np.arange(len(d)), own] = np.inf
    return np.stack([rounded_down(far[:, a:b].min(axis=1)) for a, b in zip(cuts, cuts[1:])], axis=1)


def next_pass(x: np.ndarray, codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray, books: Books) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after the entries moved, and how many distances were measured beside those to the own entries."""
    n, parts, groups = bounds.shape
    now, moves, measured = len(books.history) - 1, books.moves(), 0
    codes, bounds, stamps = codes.copy(), bounds.copy(), stamps.copy()
    errors = whole_zeros((n, parts), x, books.newest)
    for p in range(parts):
        own, book = codes[:, p].astype(np.int64), books.newest[p]
        d_own = ((x[:, p] - book[own]) ** 2).sum(axis=1)
        near = np.sqrt(d_own.astype(np.float64)) * (1 + 1e-12)
        left = opened(bounds[:, p]) - moves[stamps[:, p], p, np.arange(groups)]
        best_d, best = d_own.copy(), own.copy()
        again = ~(left > near[:, None])
        found = {}
        for g in range(groups):
            rows = np.flatnonzero(again[:, g])
            if not len(rows):
                continue
            a, b = books.cuts[g], books.cuts[g + 1]
            d = exact(x[rows, p], book[a:b])
            measured += d.size
            at = d.argmin(axis=1)
            least = d[np.arange(len(rows)), at]
            at = at + a
            better = (least < best_d[rows]) | ((least == best_d[rows]) & (at < best[rows]))
            best_d[rows] = np.where(better, least, best_d[rows])
            best[rows] = np.where(better, at, best[rows])
            found[g] = rows, d
        for g, (rows, d) in found.items():
            a, b = books.cuts[g], books.cuts[g + 1]
            far = d.astype(np.float64)
            inside = np.flatnonzero((best[rows] >= a) & (best[rows] < b))
            far[inside, best[rows[inside]] - a] = np.inf
            bounds[rows, p, g], stamps[rows, p, g] = rounded_down(far.min(axis=1)), now
        # the entry left behind now counts for its group's bound
        left_behind = np.flatnonzero(best != own)
        group = np.searchsorted(books.cuts, own[left_behind], side="right") - 1
        kept = ~again[left_behind, group]
        rows, group = left_behind[kept], group[kept]
        bounds[rows, p, group] = rounded_down(np.minimum(np.maximum(left[rows, group], 0), near[rows] * (1 - 1e-11)) ** 2)
        stamps[rows, p, group] = now
        codes[:, p], errors[:, p] = best, best_d
    return codes, bounds, stamps, errors, measured


def moved(books: Books, sums: dict[tuple[int, int, int], tuple[int, int]]) -> Books:
    """The books with one more codebook: floored means, unused entries as they were; ``sums`` by part, entry, place."""
    book = books.newest.copy()
    for (p, e, k), (total, count) in sums.items():
        book[p, e, k] = total // count
    if book.dtype != object and np.abs(book).max() >= LIMIT:
        book = book.astype(object)
    return Books([*books.history, book], books.groups)


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in book.ravel()).encode()).hexdigest()


def _start(vectors: DataFrame, parts: int, entries: int, groups: int) -> Books | None:
    """The parts of the vectors with the smallest ids; the first of them says the length."""
    head = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()
    if not head or len(head[0].vector) % parts:
        return None
    size = len(head[0].vector)
    first = vectors.where(F.size("vector") == size).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    x = whole_numbers(np.array([r.vector for r in first], np.float64))
    return Books([np.ascontiguousarray(x.reshape(len(first), parts, size // parts).transpose(1, 0, 2))], groups)


class Coder:
    """The passes over one table; ``books`` and ``measured`` (distances by pass) tell how the training went."""

    def __init__(self, df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, groups: int = 4, salts: int = 32):
        if not 0 < entries <= 256:
            raise ValueError("an entry's index is one byte")
        self.spark, self.parts, self.rounds, self.salts = df.sparkSession, parts, rounds, salts
        self.id_type, self.label_type = (df.schema[c].dataType.simpleString() for c in (vec_id, label))
        rows = one_column(df, vec_id=vec_id, vector=vector, label=label).withColumn("vector", F.col("vector").cast("array<double>"))
        finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        self.vectors = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
        self.books = _start(self.vectors.select("vec_id", "vector"), parts, entries, groups)
        self.measured: list[int] = []

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def _state(self) -> str:
        return f"vec_id {self.id_type}, label {self.label_type}, x binary, codes binary, bounds binary, stamps binary, error binary, measured bigint"

    def assigned_first(self) -> DataFrame:
        books, parts = self.spark.sparkContext.broadcast(self.books), self.parts
        size = self.books.newest.shape[0] * self.books.newest.shape[2]

        def run(batch: pa.RecordBatch):
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = whole_numbers(flat.reshape(batch.num_rows, size))
            result = first_pass(x.reshape(len(x), parts, -1), books.value)
            yield state_batch(batch.column(0), batch.column(2), [packed(v) for v in x], *result, books.value.newest.shape[1] * parts * len(x))

        rows = self.vectors.where(F.size("vector") == size).select("vec_id", "vector", "label")
        return self._stored(map_batches(rows, run, self._state()), "codes")

    def assigned_next(self, state: DataFrame) -> DataFrame:
        books, parts = self.spark.sparkContext.broadcast(self.books), self.parts

        def run(batch: pa.RecordBatch):
            vec_id, label, x, codes, bounds, stamps, _, _ = batch.columns
            x = x.to_pylist()
            v = unpacked(x)
            n, groups = len(v), len(books.value.cuts) - 1
            old = (np.frombuffer(b"".join(c.to_pylist()), kind).reshape(n, parts, -1) for c, kind in ((codes, np.uint8), (bounds, np.uint16), (stamps, np.uint8)))
            codes, bounds, stamps = old
            result = next_pass(v.reshape(n, parts, -1), codes[:, :, 0], bounds.reshape(n, parts, groups), stamps.reshape(n, parts, groups), books.value)
            yield state_batch(vec_id, label, x, *result)

        return self._stored(map_batches(state, run, self._state()), "codes")

    def sums(self, state: DataFrame) -> dict[tuple[int, int, int], tuple[int, int]]:
        """Sum and count by part, entry and place: one row each from a task, then added up."""
        parts = self.parts
        entries, width = self.books.newest.shape[1:]

        def run(batches):
            totals = np.zeros((parts, entries, width), object)
            counts = np.zeros((parts, entries), np.int64)
            for batch in batches:
                x = unpacked(batch.column(0).to_pylist())
                x = x.reshape(len(x), parts, width)
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(x), parts)
                for p in range(parts):
                    part = np.zeros((entries, width), x.dtype)
                    np.add.at(part, codes[:, p], x[:, p])
                    totals[p] += part
                    counts[p] += np.bincount(codes[:, p], minlength=entries)
            p, e = np.nonzero(counts)
            if len(p):
                at = np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int32()) for c in at), pa.array([str(v) for v in totals[at]]), pa.array(np.repeat(counts[p, e], width))],
                    names=["part", "entry", "place", "total", "count"],
                )

        found = state.select("x", "codes").mapInArrow(run, "part int, entry int, place int, total string, count bigint")
        added = found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("count").alias("n"))
        return {(r.part, r.entry, r.place): (int(r.total), r.n) for r in added.collect()}

    def run(self) -> DataFrame:
        """``vec_id``, ``label``, ``codes``, ``error`` (null beyond 64 bits) of every kept row, stored."""
        if self.books is None:
            return self.spark.createDataFrame([], f"vec_id {self.id_type}, label {self.label_type}, codes binary, error bigint")
        state = self.assigned_first()
        for _ in range(self.rounds):
            self.books = moved(self.books, self.sums(state))
            state = self.assigned_next(state)
            self.measured.append(state.agg(F.sum("measured")).first()[0] or 0)
        number = F.col("error").cast("string").try_cast("bigint")
        return state.select("vec_id", "label", "codes", number.alias("error"))


def state_batch(vec_id, label, x: list[bytes], codes, bounds, stamps, errors, measured: int) -> pa.RecordBatch:
    """A row's part of the state; ``error`` in decimal digits, ``measured`` in the first row."""
    def cells(a: np.ndarray) -> pa.Array:
        data, size = np.ascontiguousarray(a).tobytes(), a[0].nbytes
        return pa.array([data[k:k + size] for k in range(0, len(data), size)], pa.binary())

    times = np.zeros(len(x), np.int64)
    times[0] = measured
    columns = [vec_id, label, pa.array(x, pa.binary()), cells(codes), cells(bounds), cells(stamps), pa.array([str(int(e)).encode() for e in errors.sum(axis=1)], pa.binary()), pa.array(times)]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "codes", "bounds", "stamps", "error", "measured"])


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", **options) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every kept row."""
    coder = Coder(df, vec_id, vector, label, **options)
    rows = coder.run()
    book = digest(coder.books.newest) if coder.books else None
    whole = F.when(F.count("*") == F.count("error"), F.try_sum("error"))
    by_label = coder._stored(rows.groupBy("label").agg(whole.alias("label_error")), "label-errors")
    salted = by_label.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(coder.salts - 1))).alias("of_salt"))
    salt = F.pmod(F.xxhash64("vec_id", "codes"), F.lit(coder.salts)).cast("int")
    joined = rows.withColumn("salt", salt).join(salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")))
    return joined.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(book).alias("codebooks_sha256"))
