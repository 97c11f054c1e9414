"""Words, ids and Arrow helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

#: A-Z to a-z, as a table for bytes.translate.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: bytes) -> list[bytes]:
    """Runs of anything but space and 0x09-0x0D, with A-Z in lower case."""
    return text.translate(LOWER).split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hash of each word. Hashing a word takes less time than looking it up, so none are kept."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found)), ">u8").astype(np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of a multiply-shift hash)."""
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each value, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def held_out(column: str, folds: int):
    """crc32 of the value as text leaves remainder 0; a null value counts as empty text, so it is held out."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds == 0


#: Bytes of a batch that a function gets at once, unless one row has more.
SLICE = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows in batches of up to ``most`` bytes, or one row: what a task holds doesn't depend on the length of texts."""
    for batch in batches:
        waiting = [batch] if batch.num_rows else []
        while waiting:
            part = waiting.pop()
            n = part.num_rows
            if n > 1 and part.nbytes > most:
                waiting += [part.slice(n // 2), part.slice(0, n // 2)]
            else:
                yield part


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(batch)`` yields batches for each slice of the rows (see ``slices``)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield from function(part)

    return df.mapInArrow(run, schema)


def one_column(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns named, under fixed names: other columns, whatever they are called, can't clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))
