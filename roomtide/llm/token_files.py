"""Token ids in compressed files with a shared dictionary.

File format, a folder of two Parquet tables, so that Spark's writers commit
whole files and a lost task leaves nothing behind:

``dictionary``  one row: the zstandard dictionary, its SHA-256, the width of an id in bytes
``blocks``      rows of about ``block_bytes`` bytes, in ascending order of the document id:
                ``first_id``, ``last_id``, ``part``, ``block`` (order), ``n_tokens`` (of the block),
                ``before`` (tokens of the part in front of it), ``dictionary_sha256``, the index (``doc_ids``, ``offsets`` with one entry more
                than documents, ``counts``) and ``data``, the documents' frames one after another

Every document is a frame of its own, compressed with the dictionary, so one
document is read by its slice of one block, found by the id range in the
Parquet statistics.

The dictionary is trained on serialized id arrays of at most
``sample_documents`` documents, those with the smallest hash of id and text,
and of these on ``sample_ids`` ids in a row from a place that the hash says.
It only affects sizes: every document is encoded whole. Without enough
material the dictionary is empty.

Reading moves no data between tasks: a block knows the tokens before it in its
part, and the parts' sums, one row for each task that wrote, go to all tasks.

Null text counts as empty. Null ids come first. Rows that share an id are
ordered by their ids' checksum and stay separate documents; equal rows are
equal documents one after another. An empty table gives files without blocks,
which read as an empty table. A text is held whole with its ids while it is
encoded, in parts of ``LONG`` characters; a frame longer than a block is a
block of its own. Only the columns named are read, so others can't clash.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roomtide.llm.pieces import PATTERN, STOPS, byte_letters, cuttable, is_regular, special_splitter
from roomtide.llm.text import SLICE, map_batches, one_column, slices
from roomtide.session import scratch_path


#: Characters that are encoded at once of one text, which may be cut behind them, and bytes of several texts.
LONG = 1 << 20
BATCH = 10 << 20
ONWARD = regex.compile(r" (?=\S)")


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, for some texts at once.

    For a plain byte-level BPE, a text may be cut before every space that is
    followed by something other than white space, and before a line feed alone (see ``pieces``). The
    library's model gets each distinct piece of the texts once: words of
    letters together in one call, joined by a sign over which no merge
    reaches, of other pieces every pre-token. Pieces stay known in two
    generations of up to ``capacity``: the older one goes when the newer is
    full. The ids are those of the whole text.
    """

    def __init__(self, path: str, capacity: int = 250_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        kind = spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        vocab = self.library.get_vocab()
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.simple = (
            spec["model"]["type"] == "BPE" and not spec["normalizer"] and kind.get("type") == "ByteLevel"
            and kind.get("use_regex") and not kind.get("add_prefix_space")
            and not any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added)
        )
        if not self.simple:
            return
        self.letters = {b: letter for letter, b in byte_letters().items()}
        space, line = self.letters[32], self.letters[10]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        # a merge over a space, or of a line feed and part of a letter, has a no-break space in it, which isn't a letter
        wordly, gap = {self.letters[b] for b in range(256) if b >= 0x80 or chr(b).isalpha()}, self.letters[0xC2] + self.letters[0xA0]
        over = [right for _, right in pairs if space in right and not right.startswith(space + gap)]
        lines = [left + right for left, right in pairs if line in left + right and wordly & set(left + right) and gap not in left + right]
        self.simple = line in vocab and not over and not lines
        self.model, self.bare = self.library.model, Tokenizer(self.library.model)
        self.find = regex.compile(PATTERN).findall
        self.spaced, self.line = np.zeros(max(vocab.values()) + 1, bool), vocab.get(line)
        self.spaced[[i for token, i in vocab.items() if token[0] == space]] = True
        self.specials = {x["content"]: x["id"].to_bytes(4, "little") for x in added}
        self.split, self.capacity = special_splitter(self.specials), capacity
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.simple:
            return [self.whole(t) for t in texts]
        if max(map(len, texts), default=0) <= LONG and sum(map(len, texts)) <= BATCH:
            parts = [self.split(t) for t in texts]
            encoded = iter(self.plain([p for x in parts for p in x if p not in self.specials]))
            return [b"".join([self.specials.get(p) or next(encoded) for p in x]) for x in parts]
        return [b"".join([self.specials.get(p) or ids for p in self.split(t) for ids in ([b""] if p in self.specials else map(self.one, cut(p)))]) for t in texts]

    def one(self, text: str) -> bytes:
        return self.plain([text])[0]

    def plain(self, texts: list[str]) -> list[bytes]:
        """The same for texts without special tokens."""
        ready = [cuttable(t) for t in texts]
        # Arrow cuts and numbers the pieces: only the distinct ones become Python's
        cuts = pc.split_pattern(pa.array([t or "" for t in ready], pa.large_string()), " ")
        numbered = cuts.flatten().dictionary_encode()
        bounds, codes, pieces = cuts.offsets.to_numpy(), numbered.indices.to_numpy().astype(np.int64), numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        heads = codes[bounds[:-1]]  # the beginnings of texts have no space in front
        firsts = {k: len(pieces) + i for i, k in enumerate(np.unique(heads).tolist())}
        codes[bounds[:-1]] = [firsts[k] for k in heads.tolist()]

        table = list(map(self.pieces.get, pieces))
        inner = np.bincount(codes, minlength=len(pieces)) > 0  # not only at beginnings
        gaps = [k for k in np.flatnonzero(inner[:len(pieces)]).tolist() if table[k] is None]
        if len(self.pieces) + len(gaps) > self.capacity:
            self.pieces, self.older = {}, self.pieces
        if len(self.tokens) > self.capacity // 8:
            self.tokens.clear()
        wanted = {pieces[k] for k in gaps}
        back = {p: self.older[p] for p in wanted if p in self.older}
        self.pieces.update(back)
        self.learn(wanted.difference(back), [pieces[k] for k in firsts])
        for k in gaps:
            table[k] = self.pieces.get(pieces[k])
        for p in [p for p in wanted if len(p) >= 64]:
            self.pieces.pop(p, None)
            self.pieces.pop(p[:-1], None)
        uncut = np.array([x is None for x in table] + [False] * len(firsts))
        table = [x or b"" for x in table] + [self.joined(self.find(pieces[k])) for k in firsts]

        ids, sizes = np.frombuffer(b"".join(table), "<u4"), np.array([len(x) // 4 for x in table])
        n = sizes[codes]
        ends = np.cumsum(n)
        places = np.repeat(((np.cumsum(sizes) - sizes)[codes] - (ends - n)).astype(np.int32), n)
        places += np.arange(len(places), dtype=np.int32)
        raw, at = ids[places].tobytes(), (4 * np.concatenate([[0], ends])[bounds]).tolist()
        out = [raw[a:b] for a, b in zip(at, at[1:])]
        irregular = np.searchsorted(bounds, np.flatnonzero(uncut[codes]), "right") - 1  # white space that isn't one sign
        for k in {*irregular.tolist(), *(k for k, t in enumerate(ready) if t is None)}:
            out[k] = self.joined(self.find(texts[k]))
        return out

    def learn(self, pieces: set[str], firsts: list[str]) -> None:
        """Ids of the pieces, and of the pre-tokens of beginnings of texts and of pieces that aren't letters alone."""
        words, stops, others, lines = set(), [], [], []
        for p in pieces:
            if p.isalpha():
                words.add(p)
            elif p[-1:] in STOPS and p[:-1].isalpha():
                stops.append(p)
            elif is_regular(p):
                (lines if p[0] == "\n" else others).append(p)
        words.update({p[:-1] for p in stops}.difference(self.pieces))
        found = [*self.each(others, " " + " ".join(others), " "), *self.each(lines, "".join(lines), "\n")]
        tokens = {x for part in (*found, *map(self.find, firsts)) for x in part}.difference(self.tokens)
        words.update({x[1:] for x in tokens if x[0] == " " and x[1:].isalpha()}.difference(self.pieces))
        self.pieces.update(self.words(list(words)))
        self.tokens.update(self.beginnings([x for x in tokens if x.isalpha()]))
        signs = {c: self.joined(c) for c in STOPS}
        for p in stops:
            self.pieces[p] = self.pieces[p[:-1]] + signs[p[-1]]
        for p, part in zip([*others, *lines], found):
            self.pieces[p] = self.joined(part)

    def each(self, pieces: list[str], text: str, sign: str) -> list[list[str]]:
        """The pre-tokens of each piece, found in the text of them all: a piece begins where a pre-token begins with the sign."""
        found: list[list[str]] = []
        for x in self.find(text) if pieces else ():
            if x[0] == sign:
                found.append([x])
            else:
                found[-1].append(x)
        return found

    def joined(self, tokens) -> bytes:
        """The ids of pre-tokens in turn."""
        out = []
        for x in tokens:
            ids = self.pieces.get(x[1:]) if x[0] == " " and len(x) > 1 and x[1] != "\n" else self.tokens.get(x)
            if ids is None:
                ids = array("I", [t.id for t in self.model.tokenize(self.lettered(x))]).tobytes()
                if len(x) < 16:
                    self.tokens[x] = ids
            out.append(ids)
        return b"".join(out)

    def lettered(self, text: str) -> str:
        """The text's bytes as the vocabulary's letters."""
        return (text if text.isascii() else text.encode().decode("latin-1")).translate(self.letters)

    def words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters with the ids they have behind a space: a word begins at an id whose string begins with one."""
        ids = self.model_ids(" ", words)
        return zip(words, parted(ids, np.flatnonzero(self.spaced[ids])))

    def beginnings(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters with the ids they have without a space in front; line feeds stand between them."""
        ids = self.model_ids("\n", words)
        at = np.flatnonzero(ids == self.line)
        return zip(words, [x[4:] for x in parted(ids, at)])

    def model_ids(self, sign: str, words: list[str]) -> np.ndarray:
        """The model's ids of the words, each behind the sign; some at a time, for its queue is slow on long strings."""
        lettered = self.lettered("".join([sign + w for w in words]))
        sign = self.letters[ord(sign)]
        each = lettered.split(sign)[1:]
        strings = [sign + sign.join(each[k:k + 128]) for k in range(0, len(each), 128)]
        return np.array([i for x in self.bare.encode_batch_fast(strings, add_special_tokens=False) for i in x.ids], "<u4")


def parted(ids: np.ndarray, begins: np.ndarray) -> list[bytes]:
    data, bounds = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def cut(text: str) -> Iterator[str]:
    """Parts of about ``LONG`` characters, cut before a space that is followed by something other than white space."""
    at = 0
    while len(text) - at > LONG:
        space = ONWARD.search(text, at + LONG)
        if not space:
            break
        yield text[at:space.start()]
        at = space.start()
    yield text[at:]


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def serialized(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary, or none where the samples are too few for one."""
    if sum(map(len, samples)) < 16 * size:
        size = sum(map(len, samples)) // 16
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=level, write_content_size=True, **extra)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))


def write(
    df: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text",
    sample_documents: int = 2000, sample_ids: int = 4096, dictionary_bytes: int = 64 << 10, block_bytes: int = 1 << 20, level: int = 3,
) -> None:
    """Encode every text and write the files to ``folder``; ``end_id`` is appended to each document."""
    spark = df.sparkSession
    docs = one_column(df, doc_id=doc_id, text=text)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def sampled(batch: pa.RecordBatch):
        lib, pieces = encoder(tokenizer), []
        texts = [x or "" for x in batch.column(1).to_pylist()]
        for x, raw in zip(texts, lib.ids(texts)):
            ids = np.frombuffer(raw + end, "<u4")
            at = xxhash.xxh3_64_intdigest(x) % max(1, len(ids) - sample_ids + 1)
            pieces.append(serialized(ids[at:at + sample_ids], lib.width))
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["ids"])

    # about twice as many candidates as are taken, from all rows; only they are sorted
    place = F.xxhash64("doc_id", "text")
    share = min(1.0, (2.0 * sample_documents + 100) / max(1, docs.count()))
    some = docs.where(F.pmod(place, F.lit(1 << 32)) < share * float(1 << 32))
    pick = some.orderBy(place, "doc_id", "text").limit(sample_documents)
    dictionary = trained([bytes(r.ids) for r in map_batches(pick, sampled, "ids binary").collect()], dictionary_bytes)
    digest = hashlib.sha256(dictionary).hexdigest()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, pack = encoder(tokenizer), _compressor(dictionary, level)
        for batch in slices(batches, BATCH):
            counts, sums, out = [], [], []
            for raw in lib.ids([x or "" for x in batch.column(1).to_pylist()]):
                raw += end
                counts.append(len(raw) // 4)
                sums.append(zlib.crc32(raw))
                out.append(pack.compress(raw if lib.width == 4 else np.frombuffer(raw, "<u4").astype("<u2").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "n", "sum", "frame"])

    # stored once: the range exchange below samples its input before it runs
    once = scratch_path(spark, "frames")
    docs.mapInArrow(frames, f"doc_id {id_type}, n bigint, sum bigint, frame binary").write.parquet(once)
    ordered = spark.read.parquet(once).repartitionByRange(F.col("doc_id").asc_nulls_first(), "sum").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "sum")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, held, size, before = TaskContext.get().partitionId(), 0, [], 0, 0

        def row():
            ids, counts, data = zip(*held)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
            values = [[part], [block], [ids[0]], [ids[-1]], [sum(counts)], [before], [digest], [list(ids)], [offsets.tolist()], [list(counts)], [b"".join(data)]]
            kinds = [pa.int32(), pa.int32(), id_arrow, id_arrow, pa.int64(), pa.int64(), pa.string(), pa.list_(id_arrow), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        id_arrow = None
        for batch in slices(batches):
            id_arrow = batch.column(0).type
            for i, n, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if held and size + len(frame) > block_bytes:
                    yield row()
                    before += sum(n for _, n, _ in held)
                    block, held, size = block + 1, [], 0
                held.append((i, n, frame))
                size += len(frame)
        if held:
            yield row()

    names = ["part", "block", "first_id", "last_id", "n_tokens", "before", "dictionary_sha256", "doc_ids", "offsets", "counts", "data"]
    schema = f"part int, block int, first_id {id_type}, last_id {id_type}, n_tokens bigint, before bigint, dictionary_sha256 string, doc_ids array<{id_type}>, offsets array<bigint>, counts array<bigint>, data binary"
    ordered.mapInArrow(blocks, schema).write.mode("overwrite").parquet(f"{folder}/blocks")
    width = 2 if _largest_id(tokenizer, end_id) < 1 << 16 else 4
    spark.createDataFrame([(bytearray(dictionary), digest, width)], "dictionary binary, dictionary_sha256 string, width int").write.mode("overwrite").parquet(f"{folder}/dictionary")


def _largest_id(tokenizer: str, end_id: int | None) -> int:
    width = encoder(tokenizer).width
    if end_id is not None and end_id >= 1 << 8 * width:
        raise ValueError(f"end id {end_id} doesn't fit into {width} bytes")
    return (1 << 8 * width) - 1


class Opened:
    """The blocks of a folder, its checked dictionary, and how to unpack a document."""

    def __init__(self, spark: SparkSession, folder: str):
        head = spark.read.parquet(f"{folder}/dictionary").first()
        self.dictionary, self.digest, self.width = bytes(head.dictionary), head.dictionary_sha256, head.width
        if hashlib.sha256(self.dictionary).hexdigest() != self.digest:
            raise ValueError(f"the dictionary in {folder} is damaged")
        self.blocks = spark.read.parquet(f"{folder}/blocks")

    def unpacker(self):
        """``ids(frame, digest)``, with one decompressor; a frame of another dictionary ends the job."""
        digest, kind, unpack = self.digest, f"<u{self.width}", _decompressor(self.dictionary)

        def ids(frame: bytes, of: str) -> np.ndarray:
            if of != digest:
                raise ValueError("this block was written with another dictionary")
            return np.frombuffer(unpack.decompress(frame), kind)

        return ids


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids_crc32``
    and, unless ``ids`` is false, ``ids`` (little-endian unsigned 32-bit)."""
    files = Opened(spark, folder)
    dictionary, id_type = files.dictionary, files.blocks.schema["first_id"].dataType.simpleString()
    parts = files.blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # a row for each task that wrote blocks: a bounded window, and small enough for all tasks
    starts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    keyed = files.blocks.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("before"))
    columns = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    files.blocks = None  # a DataFrame can't go to the tasks

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = files.unpacker()
        for batch in slices(batches):
            kinds = [batch.schema.field("first_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            for block in batch.to_pylist():
                start, rows, size = block["start"], [], 0
                data, at = block["data"], block["offsets"]
                for k, doc in enumerate(block["doc_ids"]):
                    found = unpack(data[at[k]:at[k + 1]], block["dictionary_sha256"]).astype("<u4")
                    if len(found) != block["counts"][k]:
                        raise ValueError("the index doesn't agree with the data")
                    raw = found.tobytes()
                    rows.append((doc, start, len(found), zlib.crc32(raw), raw)[: len(columns)])
                    start += len(found)
                    size += len(raw) if ids else 0
                    if size > SLICE:
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=columns)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=columns)

    return keyed.mapInArrow(documents, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if ids else ""))


def read_document(spark: SparkSession, folder: str, doc_id) -> list[list[int]]:
    """The ids of the documents with this id, by their slices of the blocks that may hold it."""
    files = Opened(spark, folder)
    wanted = F.col("first_id").isNull() | (F.col("first_id") <= doc_id) if doc_id is not None else F.col("first_id").isNull()
    wanted = wanted & (F.col("last_id") >= doc_id) if doc_id is not None else wanted
    found = files.blocks.where(wanted).withColumn("k", F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1))).where(F.get("doc_ids", "k").eqNullSafe(F.lit(doc_id)))
    cut = found.orderBy("part", "block", "k").select("dictionary_sha256", F.substring("data", F.get("offsets", "k") + 1, F.get("offsets", F.col("k") + 1) - F.get("offsets", "k")).alias("frame"))
    unpack = files.unpacker()
    return [unpack(bytes(r.frame), r.dictionary_sha256).tolist() for r in cut.collect()]
