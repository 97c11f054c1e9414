"""N-gram Jaccard join: every link between texts whose shingle sets overlap by ``threshold`` percent.

A text's set holds the distinct shingles of its words (A-Z in lower case), or
its whole word sequence if that is shorter than a shingle. Texts with the
same word sequence are one class, known by a 128-bit hash of it; all work
below is on classes, so copies are joined once however many there are.

Rare first: shingles are ordered by how often they occur in all texts, as
counted in a table of ``counters`` cells that shingles share by hash. A
shingle's code holds its frequency step in the upper 8 bits and 56 bits of
its hash below, so the codes' own order is the rare-first order. The order
only decides how much work is left, not what is found.

1. Prefixes: two sets that link have ``SHARED`` codes in common among their
   rarest n - ceil(t n) + ``SHARED`` (all codes they must share, if those are fewer).
2. Classes meet on common prefix codes, pass the length filter (no set
   smaller than t times the other) and the positional filter (what is left from
   their j-th common code on, and j - 1, can still reach the overlap), and meet on ``SHARED`` codes.
3. Round one takes, for every code, only the pairs with the member where the
   code comes first, the one with the least of its own, that meet twice. They
   are verified and their components found. Round two takes all pairs whose
   classes are still in different components, those outside a code's largest
   component against all: a large group of near copies never becomes all its pairs.
4. A pair, however often it met, is verified once: suffix filter (halving
   the rest of both sets bounds their overlap), then the exact overlap.

Which links are verified suffices for every component and every link between
components; pairs inside a component that is already connected aren't counted.

An empty table has an empty result. Texts of any length are taken whole: a text
is held with its words and its set while it is at hand. Only the columns named
are read, so other columns can't clash; ``first_of_each`` keeps every column.
Shingles are compared by 56 bits of their hash: two sets of a thousand share a
false shingle with a chance of 1 in 7 * 10^10, and one shingle decides a link
only where the overlap is at the border.
Null text counts as empty; a text without words has an empty set and links
with nothing. Rows are kept one by one: ids may repeat or be null, then a
component is known by its smallest id that isn't null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from roomtide.llm.components import smallest_nodes
from roomtide.llm.text import map_batches, mixed, one_column, signed, slices, text_bytes, word_hashes, words
from roomtide.session import scratch_path

BLOCK = 1 << 14
SEEN = 100_000
SHARED = 2


def shingle_hashes(found: list[bytes], width: int) -> np.ndarray:
    """The set of a word sequence as sorted 64-bit hashes."""
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    h, n = word_hashes(found), len(found) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
        total ^= total >> np.uint64(31)
    return np.unique(mixed(total))


def class_key(found: list[bytes]) -> tuple[int, int]:
    """128 bits of the word sequence as two signed numbers."""
    h = xxhash.xxh3_128_intdigest(b" ".join(found))
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def packed(counts: np.ndarray) -> bytes:
    """A block of counters, as places and values of those that aren't zero."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + counts[at].tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 6
    return np.frombuffer(data, np.uint16, n), np.frombuffer(data[2 * n:], np.uint32, n)


class Order:
    """Codes of shingles: frequency steps from the counters, then hash."""

    def __init__(self, counts: np.ndarray):
        self.steps = np.minimum(255, np.round(4 * np.log2(1.0 + counts))).astype(np.uint8)

    def codes(self, h: np.ndarray) -> np.ndarray:
        """Sorted codes of a set of hashes."""
        step = self.steps[(h % np.uint64(len(self.steps))).astype(np.int64)].astype(np.uint64)
        return np.sort((step << np.uint64(56)) | (h >> np.uint64(8)))


def least_overlap(n, m, percent: int):
    """Smallest overlap at which sets of n and m reach ``percent``: 100 o >= percent (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - math.ceil(percent * n / 100) + SHARED)


def could_reach(x: np.ndarray, y: np.ndarray, need: int, depth: int = 2) -> bool:
    """Suffix filter: an upper bound of the overlap of two sorted sets, from the sizes of their parts."""
    def most(a: np.ndarray, b: np.ndarray, left: int) -> int:
        if not left or min(len(a), len(b)) < 16:
            return min(len(a), len(b))
        pivot = b[len(b) // 2]
        i, j = np.searchsorted(a, pivot), len(b) // 2
        return most(a[:i], b[:j], left - 1) + most(a[i:], b[j:], left - 1)

    return most(x, y, depth) >= need


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    need = least_overlap(len(x), len(y), percent)
    return could_reach(x, y, need) and len(np.intersect1d(x, y, assume_unique=True)) >= need


class Join:
    """The steps of one join; ``links`` and ``members`` are its results."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90, counters: int = 1 << 22):
        self.spark = docs.sparkSession
        self.docs, self.width, self.percent, self.counters = one_column(docs, doc_id=doc_id, text=text), width, percent, counters
        self.id_type = docs.schema[doc_id].dataType.simpleString()

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """Every row's class and set size, and the counters' sums, from one pass over the texts."""
        width, size = self.width, self.counters

        def run(batches):
            counts = np.zeros(size, np.uint32)
            for batch in slices(batches):
                rows = []
                for t in text_bytes(batch.column(1)):
                    found = words(t)
                    h = shingle_hashes(found, width)
                    np.add.at(counts, (h % np.uint64(size)).astype(np.int64), 1)
                    rows.append((*class_key(found), len(h)))
                k1, k2, n = zip(*rows) if rows else ((), (), ())
                nulls = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(n, pa.int64()), pa.nulls(nulls, pa.int32()), pa.nulls(nulls, pa.binary())],
                    names=names,
                )
            blocks = [(b // BLOCK, counts[b:b + BLOCK]) for b in range(0, size, BLOCK)]
            blocks = [(k, packed(x)) for k, x in blocks if x.any()]
            if blocks:
                none = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(none, id_arrow), *[pa.nulls(none, pa.int64())] * 3, pa.array([k for k, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())],
                    names=names,
                )

        from pyspark.sql.pandas.types import to_arrow_type

        id_arrow = to_arrow_type(self.docs.schema["doc_id"].dataType)
        names = ["doc_id", "k1", "k2", "n", "block", "counts"]
        both = self._stored(self.docs.mapInArrow(run, f"doc_id {self.id_type}, k1 bigint, k2 bigint, n bigint, block int, counts binary"), "classes")

        def summed(table: pa.Table) -> pa.Table:
            total = np.zeros(BLOCK, np.uint64)
            for x in table.column("counts").to_pylist():
                at, values = unpacked(x)
                total[at] += values
            return pa.table({"block": table.column("block")[:1], "counts": pa.array([packed(np.minimum(total, 0xFFFFFFFF).astype(np.uint32))], pa.binary())})

        # two steps, so that one block's sum never meets as many rows as there were tasks
        parts = both.where("block is not null").select("block", "counts", (F.monotonically_increasing_id() % 64).alias("salt"))
        some = parts.groupBy("block", "salt").applyInArrow(summed, "block int, counts binary")
        return both.where("block is null").drop("block", "counts"), some.groupBy("block").applyInArrow(summed, "block int, counts binary")

    def order(self, sums: DataFrame) -> Order:
        """The counters, of fixed size, from the driver's memory."""
        counts = np.zeros(self.counters, np.uint32)
        for r in sums.toLocalIterator():
            at, values = unpacked(bytes(r["counts"]))
            counts[r["block"] * BLOCK + at.astype(np.int64)] = values
        return Order(counts)

    def prefixes(self, steps) -> DataFrame:
        """``code``, class, set size and position, for the codes of every class's prefix."""
        width, percent = self.width, self.percent

        def run(batches):
            # repeats in a task go as far as its memory of classes reaches; other tasks repeat them anyway
            seen: set[int] = set()
            for batch in slices(batches):
                codes, k1, k2, place = [], [], [], []
                for t in text_bytes(batch.column(1)):
                    found = words(t)
                    key = class_key(found)
                    whole = (key[0] << 64) ^ key[1]
                    if not found or whole in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(whole)
                    c = steps.value.codes(shingle_hashes(found, width))
                    p = prefix_length(len(c), percent)
                    codes.append(signed(c[:p]))
                    k1.append(np.full(p, key[0]))
                    k2.append(np.full(p, key[1]))
                    place.append((len(c) << 32) + np.arange(p))
                if codes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (codes, k1, k2, place)], names=["code", "k1", "k2", "place"])

        return self.docs.select("doc_id", "text").mapInArrow(run, "code bigint, k1 bigint, k2 bigint, place bigint")

    def sets(self, steps, wanted: np.ndarray) -> DataFrame:
        """The whole sets of classes whose key is in the bit table ``wanted``, one row for each."""
        width = self.width

        def run(batch: pa.RecordBatch):
            rows = []
            for t in text_bytes(batch.column(1)):
                found = words(t)
                k1, k2 = class_key(found)
                bit = k1 % (len(wanted.value) * 8)  # as in ``_held``
                if found and wanted.value[bit >> 3] >> (bit & 7) & 1:
                    rows.append((k1, k2, steps.value.codes(shingle_hashes(found, width)).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names=["k1", "k2", "codes"])

        found = map_batches(self.docs, run, "k1 bigint, k2 bigint, codes binary")
        return self._stored(found.groupBy("k1", "k2").agg(F.first("codes").alias("codes")).select(F.struct("k1", "k2").alias("key"), "codes"), "sets")

    def _bits(self, keys: DataFrame, size: int = 1 << 22) -> np.ndarray:
        """A bit table of fixed size of the one column's numbers; more of them only make it let more through."""
        def run(batches):
            table = np.zeros(size, np.uint8)
            some = False
            for batch in batches:
                k = batch.column(0).to_numpy() % (8 * size)
                np.bitwise_or.at(table, k >> 3, (1 << (k & 7)).astype(np.uint8))
                some |= batch.num_rows > 0
            if some:
                yield pa.RecordBatch.from_arrays([pa.array(range(0, size, BLOCK), pa.int32()), pa.array([table[b:b + BLOCK].tobytes() for b in range(0, size, BLOCK)], pa.binary())], names=["block", "bits"])

        def merged(table: pa.Table) -> pa.Table:
            total = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
            return pa.table({"block": table.column("block")[:1], "bits": pa.array([total.tobytes()], pa.binary())})

        whole = np.zeros(size, np.uint8)
        for r in keys.coalesce(16).mapInArrow(run, "block int, bits binary").groupBy("block").applyInArrow(merged, "block int, bits binary").toLocalIterator():
            whole[r["block"]:r["block"] + BLOCK] = np.frombuffer(bytes(r["bits"]), np.uint8)
        return whole

    def _held(self, rows: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
        """The rows whose number may be among ``numbers``: what a join would drop needn't be shuffled for it."""
        wanted, at = self.spark.sparkContext.broadcast(self._bits(numbers)), rows.columns.index(column)

        def run(batches):
            for batch in batches:
                k = batch.column(at).to_numpy() % (8 * len(wanted.value))
                yield batch.filter(pa.array((wanted.value[k >> 3] >> (k & 7) & 1).astype(bool)))

        return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields))

    def _passing(self, met: DataFrame, shared: int) -> DataFrame:
        """The pairs of ``x`` and ``y`` (struct n, pos, key) that pass the filters and meet on ``shared`` codes, each once.

        The first ``shared`` common codes of a pair that links leave at least its overlap less ``shared`` - 1,
        so rows that leave less are gone before they are counted.
        """
        p = self.percent
        small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
        need = F.ceil((small + large) * p / (100.0 + p) - 1e-9)
        rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
        kept = met.where((small * 100 >= large * p) & (rest >= need - (shared - 1)) & (F.col("x.key") != F.col("y.key")))
        pairs = kept.groupBy(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"), need.alias("need")).agg(F.count("*").alias("codes"), F.max(rest).alias("rest"))
        return pairs.where((F.col("rest") >= F.col("need")) & (F.col("codes") >= F.least(F.lit(shared), "need"))).select("a", "b")

    def _verified(self, pairs: DataFrame, steps) -> DataFrame:
        """The pairs that link, after one more pass over the texts for the sets of their classes."""
        percent, pairs = self.percent, self._stored(pairs, "pairs")
        keys = pairs.select("a.k1").unionByName(pairs.select("b.k1"))
        sets = self.sets(steps, self.spark.sparkContext.broadcast(self._bits(keys)))

        def run(batch: pa.RecordBatch):
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        left = pairs.join(sets.select(F.col("key").alias("a"), F.col("codes").alias("x")), "a")
        both = left.join(sets.select(F.col("key").alias("b"), F.col("codes").alias("y")), "b")
        key = "struct<k1: bigint, k2: bigint>"
        return self._stored(map_batches(both.select("a", "b", "x", "y"), run, f"a {key}, b {key}"), "links")

    def run(self) -> tuple[DataFrame, DataFrame]:
        """Rows with their class (``doc_id``, ``key``, ``n``), and verified links between classes (``a``, ``b``)."""
        rows, sums = self.classes()
        steps = self.spark.sparkContext.broadcast(self.order(sums))
        prefix = self._stored(self.prefixes(steps), "prefixes")
        row_of = lambda rows: rows.select("code", F.struct(F.shiftrightunsigned("place", 32).alias("n"), F.col("place").bitwiseAND((1 << 32) - 1).alias("pos"), F.struct("k1", "k2").alias("key")).alias("y"))
        # a code with one class leads nowhere; of the others, the member where it comes first
        firsts = row_of(prefix).groupBy("code").agg(
            F.min(F.struct("y.pos", "y.n", "y.key")).alias("x"), F.max(F.struct("y.pos", "y.n", "y.key")).alias("z")
        ).where("x.key != z.key").select("code", F.struct("x.n", "x.pos", "x.key").alias("x"))
        firsts = self._stored(firsts, "firsts")
        met = self._stored(row_of(self._held(prefix, "code", firsts.select("code"))).join(firsts, "code"), "met")
        links = self._verified(self._passing(met, 2), steps)

        roots = smallest_nodes(links)
        labelled = met.select("code", "y").join(roots.select(F.col("node").alias("k"), "root"), F.col("y.key") == F.col("k"), "left").select("code", "y", F.coalesce("root", "y.key").alias("label"))
        labelled = self._stored(labelled, "labelled")
        sizes = labelled.groupBy("code", "label").count()
        biggest = sizes.groupBy("code").agg(F.max(F.struct("count", "label")).alias("top"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("code", F.col("top.label").alias("top"))
        mixed_codes = labelled.join(biggest, "code")
        outside = mixed_codes.where("label != top").select("code", F.col("y").alias("x"), F.col("label").alias("own"))
        # a pair outside the largest component meets from both sides; one suffices
        second = mixed_codes.join(outside, "code").where("own != label and (label = top or x.key < y.key)")
        more = self._verified(self._passing(second.select("x", "y"), SHARED), steps)
        keyed = rows.select("doc_id", "n", F.struct("k1", "k2").alias("key"))
        return keyed, links.unionByName(more).distinct()


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90, counters: int = 1 << 22) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    join = Join(docs, doc_id, text, width, percent, counters)
    rows, links = join.run()
    # ids by class, then by component: copies are added up before anything is joined, and what is
    # joined is stored before, so that a class or component with many rows is a skewed join and no more
    classes = join._stored(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")), "classes-least")
    roots = join._stored(smallest_nodes(links).select(F.col("node").alias("key"), "root"), "roots")
    members = roots.unionByName(roots.select(F.col("root").alias("key"), "root").distinct())
    least = join._stored(members.join(classes, "key").groupBy("root").agg(F.min("least").alias("of_root")), "roots-least")
    linked = join._stored(members.join(least, "root").select("key", "of_root"), "members-least")
    answers = join._stored(classes.join(linked, "key", "left").select("key", F.coalesce("of_root", "least").alias("component")), "components")
    return rows.join(answers, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id")
    )


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and all rows with a null id."""
    found = components(docs, doc_id, text, width, percent).select(F.col("doc_id").alias("__id"), F.col("component_id").alias("__component")).distinct()
    lost = found.where("__id is not null and __id != __component").select("__id")
    return docs.join(lost, docs[doc_id] == F.col("__id"), "left_anti")
