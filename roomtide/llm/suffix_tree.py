"""Language model scores by a probabilistic suffix tree.

Symbols are the bytes of the text with A-Z in lower case, and the end, for
which stands 0xFF, a byte that UTF-8 doesn't have. A text is preceded by ends.
A context is what the last 0 to ``DEPTH`` symbols were; with the next symbol
it is a gram, a number of up to 64 bits.

A context is a state of the tree if it was seen ``least_count`` times and its
next symbols diverge from those of the context without its oldest symbol:
count * Kullback-Leibler divergence (in nats) reaches ``divergence``. With a
context all its suffixes are states. Both bounds are absolute, so the tree
grows with the corpus. A state's distribution is smoothed with its parent's,
which weighs as much as the state has distinct next symbols, the root's with
0.1 of each symbol. A symbol is scored in the state of its longest suffix.

Counts, states and distributions are tables dealt by gram; no task and no
broadcast holds the tree. Rows are taken in blocks of texts. A block asks once
for every distinct gram and word that it holds; the answers come back to the
block and meet its texts, which are read a second time. Each block's texts are
checked to be those that asked: an input that changes between the reads ends
the job. A gram or word that every block holds is a join key with a row of a
few bytes from each block.

Beside the tree stands a word model: the log10 probability of the words and
one end by their counts in the training texts. Words are known by 64-bit
hashes: among ten million distinct words, the chance that any two share one is
3 in a million; their counts would be added.

Null text counts as empty: one end, scored as such. A null id counts as held
out. Rows are kept one by one, whatever their ids; repeated rows get equal
scores. Without training texts the states are the root alone, all symbols are
equally likely and all word counts are 0. Texts are of any length: a block
has at least one. An empty table gives an empty table. Only the columns named
are read, so other columns can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from roomtide.llm.text import LOWER, held_out, one_column, signed, slices, text_bytes, word_hashes
from roomtide.session import scratch_path

DEPTH, END = 5, 0xFF
BLOCK_BYTES, BLOCK_ROWS = 32 << 20, 1 << 17
GRAM, WORD, CHECK = 0, 1, 2
END_WORD = xxhash.xxh3_64_intdigest(b" ")


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts one after another, and where each text's begin: one for each byte and one for the end."""
    gap = bytes([END]) * DEPTH
    raw = np.frombuffer(gap + b"".join([t + gap for t in texts]), np.uint8)
    code = np.zeros(len(raw) - DEPTH, np.int64)
    for k in range(DEPTH + 1):
        code = (code << 8) | raw[k:len(raw) - DEPTH + k]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths + DEPTH)])[:-1]
    edges = np.zeros(len(code) + 1, np.int8)
    edges[begins] = 1
    edges[begins + lengths + 1] -= 1  # a text of DEPTH - 1 more ends is followed by the next one
    real = np.cumsum(edges[:-1], dtype=np.int8) > 0
    return code[real], np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]


def suffix(code: Column, depth: int) -> Column:
    """The gram with a context of ``depth`` symbols."""
    return code.bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))


def context(code: Column) -> Column:
    return F.shiftright(code, 8)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def in_blocks(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The slices of a partition with the number of their block, which only their order and sizes decide."""
    from pyspark import TaskContext

    block, size, rows = TaskContext.get().partitionId() << 24, 0, 0
    for part in slices(batches):
        if size and (size + part.nbytes > BLOCK_BYTES or rows + part.num_rows > BLOCK_ROWS):
            block, size, rows = block + 1, 0, 0
        size, rows = size + part.nbytes, rows + part.num_rows
        yield block, part


def checksum(texts: list[bytes]) -> int:
    """Of a block's texts, whatever their order."""
    return sum(zlib.crc32(t) + 1 for t in texts)


class Tree:
    """Tables in the shared folder: by depth ``counts`` (code, n) and ``states`` (context, total, types); ``words`` (key, n)."""

    def __init__(self, asked: DataFrame, least_count: int, divergence: float):
        self.spark = asked.sparkSession
        #: every gram and word that any block asks for, with its count in the training texts (0 if it isn't there)
        sums = self._stored(asked.where(F.col("kind") != CHECK).groupBy("kind", "key").agg(F.sum("learned").alias("n")), "counts")
        self.words = sums.where(F.col("kind") == WORD).select("key", "n")
        row = self.words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
        self.tokens, self.distinct = row.n, row.v
        self.counts = [sums.where(F.col("kind") == GRAM).select(F.col("key").alias("code"), "n")]
        for depth in range(DEPTH - 1, -1, -1):
            shorter = self.counts[0].groupBy(suffix(F.col("code"), depth).alias("code")).agg(F.sum("n").alias("n"))
            self.counts.insert(0, self._stored(shorter, f"grams{depth}"))
        self.states: list[DataFrame | None] = [None] * (DEPTH + 1)
        kept = None
        for depth in range(DEPTH, 0, -1):
            kept = self.states[depth] = self._stored(self._states(depth, kept, least_count, divergence), f"states{depth}")

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def _totals(self, depth: int) -> DataFrame:
        seen = self.counts[depth].where("n > 0")
        return seen.groupBy(context(F.col("code")).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))

    def _states(self, depth: int, longer: DataFrame | None, least_count: int, divergence: float) -> DataFrame:
        """(context, total, types) of the states of a depth: those that diverge, and the suffixes of longer ones."""
        totals = self._totals(depth)
        above = self.counts[depth - 1].where("n > 0").withColumn("up", context(F.col("code")))
        above = above.join(self._totals(depth - 1), above["up"] == F.col("context")).select(F.col("code").alias("up_code"), (F.col("n") / F.col("total")).alias("q"))
        own = self.counts[depth].where("n > 0").select("n", context(F.col("code")).alias("of"), suffix(F.col("code"), depth - 1).alias("up_code"))
        rows = own.join(totals.where(F.col("total") >= least_count), own["of"] == F.col("context")).join(above, "up_code")
        gain = rows.groupBy("context", "total", "types").agg(F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("q"))).alias("gain"))
        found = gain.where(F.col("gain") >= divergence).select("context")
        if longer is not None:
            found = found.unionByName(longer.select(suffix(F.col("context"), depth - 1).alias("context"))).distinct()
        return totals.join(found, "context", "left_semi")

    def logs(self) -> DataFrame:
        """(key, value): log10 of the symbol's probability behind its context, for every gram that was asked for."""
        n = self.counts[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        chance = self.counts[0].select("code", ((F.col("n") + 0.1) / (n + 0.1 * 256)).alias("p"))
        for depth in range(1, DEPTH + 1):
            own = self.counts[depth].select("code", "n", context(F.col("code")).alias("context"), suffix(F.col("code"), depth - 1).alias("up_code"))
            both = own.join(self.states[depth], "context", "left").join(chance.select(F.col("code").alias("up_code"), "p"), "up_code")
            smoothed = (F.col("n") + F.col("types") * F.col("p")) / (F.col("total") + F.col("types"))
            chance = self._stored(both.select("code", F.coalesce(smoothed, F.col("p")).alias("p")), f"chances{depth}")
        return chance.select(F.col("code").alias("key"), F.log10("p").alias("value"))


def ask(rows: DataFrame) -> DataFrame:
    """(block, kind, key, learned) for the rows ``doc_id``, ``text``, ``held_out``: each distinct gram and word of a block
    with its count in the block's training texts, and a row to check the block by."""
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        number, count, check = None, 0, 0

        def answer():
            for kind, parts in held.items():
                key, n = summed(*zip(*parts))
                for at in range(0, len(key), 1 << 17):
                    yield batch(kind, key[at:at + (1 << 17)], n[at:at + (1 << 17)])
            yield batch(CHECK, np.array([check], np.int64), np.array([count], np.int64))

        def batch(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            m = len(key)
            return pa.RecordBatch.from_arrays([pa.array(np.full(m, number, np.int64)), pa.array(np.full(m, kind, np.int8)), pa.array(key), pa.array(n)], names=["block", "kind", "key", "learned"])

        for block, part in in_blocks(batches, 1):
            if block != number:
                if number is not None:
                    yield from answer()
                number, count, check, held = block, 0, 0, {GRAM: [], WORD: []}
            low = [t.translate(LOWER) for t in text_bytes(part.column(1))]
            count, check = count + len(low), check + checksum(low)
            for learned in (True, False):
                some = [t for t, out in zip(low, part.column(2).to_pylist()) if out != learned]
                if some:
                    words = np.append(word_hashes(b" ".join(some).split()), np.full(len(some), END_WORD, np.uint64))
                    for kind, found in ((GRAM, grams(some)[0]), (WORD, signed(words))):
                        key, n = np.unique(found, return_counts=True)
                        held[kind].append((key, n if learned else np.zeros(len(n), np.int64)))
            if len(held[GRAM]) > 16:
                held = {kind: [summed(*zip(*parts))] for kind, parts in held.items()}
        if number is not None:
            yield from answer()

    return rows.mapInArrow(asked, "block bigint, kind tinyint, key bigint, learned bigint")


class Index:
    """The places of distinct 64-bit keys; keys lie sorted by the upper bits of a product, so a look-up is a step or two."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        cells = self.cell(keys)
        self.order = np.argsort(cells, kind="stable")
        self.keys = np.append(keys[self.order], np.int64(0))
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(cells, minlength=1 << bits))]).astype(np.int32)

    def cell(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The places of the keys among those sorted; every key must be there."""
        cells = self.cell(keys)
        at = self.starts[cells]
        left = np.flatnonzero(self.keys[at] != keys)
        while len(left):
            at[left] += 1
            if (at[left] >= self.starts[cells[left] + 1]).any():
                raise ValueError("a block holds what it didn't ask for: the input changed between two reads")
            left = left[self.keys[at[left]] != keys[left]]
        if len(keys) and (at >= self.starts[cells + 1]).any():
            raise ValueError("a block holds what it didn't ask for: the input changed between two reads")
        return at


class Scorer:
    """A block's answers: grams with their logs, words with their counts."""

    def __init__(self, answers: pa.Table, tokens: int, distinct: int):
        kind, key, value = (answers.column(c).to_numpy() for c in ("kind", "key", "value"))
        self.index, self.value = {}, {}
        for k in (GRAM, WORD):
            mine = kind == k
            self.index[k] = Index(np.ascontiguousarray(key[mine]))
            self.value[k] = value[mine][self.index[k].order]
        counts = self.value[WORD]
        self.value[WORD] = np.log10((counts + 0.1) / (tokens + 0.1 * (distinct + 1)))
        self.known = (counts > 0).astype(np.int64)

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the log10 probability, words and end, how many are known, and their log10 probability."""
        codes, begins = grams(texts)
        score = np.add.reduceat(self.value[GRAM][self.index[GRAM].of(codes)], begins)
        words = [t.split() for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(lengths) - lengths
        keys = np.full(int(lengths.sum()), END_WORD, np.uint64)
        inside = np.ones(len(keys), bool)
        inside[starts + lengths - 1] = False
        keys[inside] = word_hashes([w for found in words for w in found])
        at = self.index[WORD].of(signed(keys))
        return score, lengths, np.add.reduceat(self.known[at], starts), np.add.reduceat(self.value[WORD][at], starts)


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10, least_count: int = 2, divergence: float = 3.0
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    The rows that aren't held out are learned from.
    """
    spark = docs.sparkSession
    rows = one_column(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out("doc_id", folds))
    id_type = docs.schema[doc_id].dataType.simpleString()
    path = scratch_path(spark, "asked")
    ask(rows).write.option("compression", "zstd").parquet(path)
    asked = spark.read.parquet(path)
    tree = Tree(asked, least_count, divergence)
    total, distinct = tree.tokens, tree.distinct

    values = {GRAM: tree.logs(), WORD: tree.words.select("key", F.col("n").cast("double").alias("value"))}
    answers = [asked.where(F.col("kind") == kind).select("block", "kind", "key").join(value, "key").select("block", "kind", "key", "value") for kind, value in values.items()]
    checks = asked.where(F.col("kind") == CHECK).select("block", "kind", "key", F.col("learned").cast("double").alias("value"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in in_blocks(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block, np.int64)), *part.columns], names=["of", "doc_id", "text", "held_out"])

    texts = rows.mapInArrow(numbered, f"of bigint, doc_id {id_type}, text string, held_out boolean")

    def folded(texts: pa.Table, answers: pa.Table) -> pa.Table:
        check = answers.filter(pa.compute.equal(answers.column("kind"), CHECK))
        scorer = Scorer(answers, total, distinct)
        out, seen = [], 0
        for part in slices(texts.to_batches()):
            low = [t.translate(LOWER) for t in text_bytes(part.column("text"))]
            seen += checksum(low)
            found, n_tokens, n_known, base = scorer.scores(low)
            out.append((part.column("doc_id"), part.column("held_out"), *map(pa.array, (n_tokens, n_known, np.full(len(low), total, np.int64), base, found))))
        if check.column("key").to_pylist() != [seen] or check.column("value").to_pylist() != [texts.num_rows]:
            raise ValueError("a block lacks texts that asked: the input changed between two reads")
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.table([pa.chunked_array(c) for c in zip(*out)], names=names)

    every = answers[0].unionByName(answers[1]).unionByName(checks)
    return texts.groupBy("of").cogroup(every.groupBy("block")).applyInArrow(
        folded, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
