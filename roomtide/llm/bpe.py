"""BPE encoding and decoding.

A text is cut into pre-tokens by the byte-level pattern. In each pre-token,
the symbols (first single bytes) form a doubly linked list, and a priority
queue holds the neighbours that the vocabulary can merge, by rank and then
from the left. The best pair is merged, its new neighbours are queued, and an
entry whose symbols have changed meanwhile is stale and skipped. Decoding
concatenates the vocabulary's byte strings.

Null text counts as empty: no ids. Special tokens of the vocabulary file are
matched in the text as the tokenizers library does by default. Rows are kept
one by one, whatever their ids; other columns are kept by ``encode`` and
``decode`` unless they have the name of an output, which replaces them. Of
merges with one rank the leftmost comes first. An empty table gives an empty
table. A text of any length is encoded whole, while it is at hand.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from roomtide.llm.pieces import PATTERN, PieceEncoder, byte_letters
from roomtide.llm.text import map_batches, one_column


def _vocabulary(path: str) -> tuple[dict, list[bytes]]:
    """The file's contents, and the byte string of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = spec["pre_tokenizer"] or {}
    if spec["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True) or spec["normalizer"]:
        raise ValueError(f"{path} isn't a plain byte-level BPE")
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
    strings = [b""] * (1 + max([*vocab.values(), *specials.values()]))
    for token, i in vocab.items():
        strings[i] = bytes(letters[c] for c in token) if token not in specials else token.encode()
    for token, i in specials.items():
        strings[i] = token.encode()
    return spec, strings


class Decoder:
    """Decoder of one vocabulary file (byte-level BPE)."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings

    def decode(self, ids: bytes) -> str:
        """Text of little-endian unsigned 32-bit ids."""
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


class Codec(Decoder):
    """Encoder and decoder of one vocabulary file (byte-level BPE)."""

    def __init__(self, path: str):
        spec, strings = _vocabulary(path)
        super().__init__(strings)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.of_byte = [0] * 256
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.find = regex.compile(PATTERN).findall
        self.encode = PieceEncoder(self._plain, specials)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        out = []
        for token in self.find(text):
            out.append(np.array(self.merged(token.encode()), "<u4").tobytes())
        return b"".join(out)

    def merged(self, token: bytes) -> list[int]:
        """The symbols that remain of a pre-token when no neighbours can be merged any more."""
        symbols = [self.of_byte[b] for b in token]
        n, merges = len(symbols), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            pair = (symbols[i], symbols[i + 1])
            if hit := merges.get(pair):
                queue.append((hit[0], i, pair, hit[1]))
        heapify(queue)
        while queue:
            _, i, pair, new = heappop(queue)
            j = after[i]
            if j >= n or symbols[i] != pair[0] or symbols[j] != pair[1]:
                continue  # stale
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if hit := merges.get((new, symbols[k])):
                    heappush(queue, (hit[0], i, (new, symbols[k]), hit[1]))
            if (h := before[i]) >= 0 and (hit := merges.get((symbols[h], new))):
                heappush(queue, (hit[0], h, (symbols[h], new), hit[1]))
        return [s for s in symbols if s >= 0]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker process and file."""
    return Codec(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    """One decoder for each worker process and file, without what only encoding needs."""
    return Decoder(_vocabulary(path)[1])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the ids (array of int) and the number of ids of each text."""
    keep = [c for c in df.columns if c.lower() not in (ids.lower(), n_tokens.lower())]
    at, places = df.columns.index(text), [df.columns.index(c) for c in keep]

    def run(batch: pa.RecordBatch):
        encoded = [codec(path).encode(x or "") for x in batch.column(at).to_pylist()]
        counts = np.array([len(x) // 4 for x in encoded], np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(encoded), "<i4"))
        columns = [batch.column(k) for k in places] + [pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, names=[*keep, ids, n_tokens])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
    return map_batches(df, run, ", ".join([*fields, f"`{ids}` array<int>", f"`{n_tokens}` bigint"]))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each array of ids (null: empty)."""
    at, keep = df.columns.index(ids), [c for c in df.columns if c.lower() != text.lower()]
    places = [df.columns.index(c) for c in keep]

    def run(batch: pa.RecordBatch):
        found = [decoder(path).decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(at).to_pylist()]
        columns = [batch.column(k) for k in places] + [pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*keep, text])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
    return map_batches(df, run, ", ".join([*fields, f"`{text}` string"]))


def round_trip(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of ids, and the SHA-256 of the ids and of the text decoded from them."""
    def run(batch: pa.RecordBatch):
        rows = []
        for x in batch.column(1).to_pylist():
            ids = codec(path).encode(x or "")
            back = codec(path).decode(ids).encode()
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
        counts, of_ids, of_text = map(list, zip(*rows))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[doc_id].dataType.simpleString()
    return map_batches(one_column(df, doc_id=doc_id, text=text), run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
