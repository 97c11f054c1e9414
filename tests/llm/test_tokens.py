import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roomtide.llm import bpe, token_files
from roomtide.llm.queries import tokenizer_path
from roomtide.session import scratch_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_random_texts_equal_the_library(library):
    random.seed(5)
    parts = list("ab cdé\n\t '!.,  \x1c\x85　😀1２ß") + ["<|endoftext|>", " the", "  ", " \n", "ing,"]
    coder, encoder = bpe.codec(tokenizer_path()), token_files.encoder(tokenizer_path())
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(0, 20)))
        expected = ids_of(library, text)
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == expected
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == expected
        assert coder.decode(coder.encode(text)) == library.decode(expected, skip_special_tokens=False)


def test_long_words_merge_in_rank_order(library):
    text = "abcd" * 2000
    assert bpe.codec(tokenizer_path()).merged(text.encode()) == ids_of(library, text)


def test_round_trip_of_odd_rows(odd, empty, library):
    found = bpe.round_trip(odd, tokenizer_path())
    assert sorted(found.columns) == ["decoded_sha256", "doc_id", "ids_sha256", "n_tokens"]
    assert sorted(r.n_tokens for r in found.collect()) == sorted(len(ids_of(library, r.text)) for r in odd.collect())
    assert bpe.round_trip(empty, tokenizer_path()).count() == 0


def test_encode_and_decode_replace_clashing_columns(odd, library):
    rows = bpe.decode(bpe.encode(odd, tokenizer_path()), tokenizer_path()).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert list(r.ids) == ids_of(library, r.text) and r.decoded == (r.text or "") and r.score == "clash"


def expected_files(df, library, end):
    rows, start = [], 0
    texts = [(r.doc_id, np.array(ids_of(library, r.text) + [end], "<u4")) for r in df.collect()]
    for i, ids in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1].tobytes()))):
        rows.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_files_hold_every_document(spark, request, library, table):
    df = request.getfixturevalue(table)
    folder = scratch_path(spark, "files")
    token_files.write(df, folder, tokenizer_path(), end_id=2, block_bytes=20_000)
    found = [tuple(r) for r in token_files.read(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(found, key=lambda r: r[1]) == expected_files(df, library, 2)
    one = df.where(F.col("doc_id") == 7).first()
    assert token_files.read_document(spark, folder, 7) == [ids_of(library, one.text) + [2]]
    assert token_files.read_document(spark, folder, -1) == []


def test_empty_table_and_foreign_dictionary(spark, empty, documents):
    folder, other = scratch_path(spark, "files"), scratch_path(spark, "files")
    token_files.write(empty, folder, tokenizer_path())
    assert token_files.read(spark, folder).count() == 0
    token_files.write(documents, other, tokenizer_path())
    spark.read.parquet(f"{folder}/dictionary").write.mode("overwrite").parquet(f"{other}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read(spark, other).collect()


def test_texts_are_encoded_together_as_the_library_does(library):
    random.seed(6)
    parts = ["foo ", " bar", "baz.\n", "\nqux", "\n", ". ", "ab, ", "don't ", "\x0b", "\t", "x" * 70 + " ", "x" * 70 + ", ", "<|endoftext|>", "１2 "]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(2000)]
    for capacity in (250_000, 40):
        encoder = token_files.LibraryEncoder(tokenizer_path(), capacity)
        for k in range(0, len(texts), 100):
            for text, ids in zip(texts[k:k + 100], encoder.ids(texts[k:k + 100])):
                assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text)
        assert not any(len(p) >= 64 for p in encoder.pieces)  # what is kept is bounded in bytes


def test_lines_are_pieces(library):
    """What stands on both sides of a line feed is known by itself, so other neighbours don't have to be learned."""
    encoder = token_files.LibraryEncoder(tokenizer_path())
    assert np.frombuffer(encoder.ids(["one two.\nThree four"])[0], "<u4").tolist() == ids_of(library, "one two.\nThree four")
    assert {"two.", "\nThree", "four"} <= set(encoder.pieces) and "two.\nThree" not in encoder.pieces
