import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillwright.llm import token_records as records
from tillwright.session import work_dir

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def digest(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def round_trip(spark, df, **sizes):
    path = work_dir(spark, "records")
    records.write_records(df, FILE, path, **sizes)
    records.write_index(spark, path)
    return path, records.read_index(spark, path)


def test_files_hold_the_ids_in_order(spark, texts, documents, library):
    path, index = round_trip(spark, texts(*documents), file_bytes=50_000)
    rows = index.orderBy("start").collect()
    start = 0
    for row, (doc_id, text) in zip(rows, sorted(documents), strict=True):
        ids = library(text)
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, start, len(ids))
        assert row["ids_crc32"] == digest(ids)
        start += len(ids)
    assert len({r["file"] for r in rows}) > 3


def test_odd_texts(spark, texts, odd, library):
    _, index = round_trip(spark, texts(*odd, (10, "x <|endoftext|> y")))
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids_crc32"]) for r in index.collect())
    expected = sorted((i is None, i or 0, digest(library(t))) for i, t in [*odd, (10, "x <|endoftext|> y")])
    assert found == expected
    assert [r["doc_id"] for r in index.orderBy("start").limit(2).collect()] == [None, None]


def test_empty_table(spark, texts):
    _, index = round_trip(spark, texts((1, "a")).limit(0))
    assert index.count() == 0


def test_shuffled_reads_by_the_index(spark, texts, documents, library):
    path, _ = round_trip(spark, texts(*documents), file_bytes=50_000)
    first = [tuple(r) for r in records.read_shuffled(spark, path, seed=1).collect()]
    assert {i: list(ids) for i, ids in first} == {i: library(t) for i, t in documents}
    assert [i for i, _ in first] != sorted(i for i, _ in documents)
    again = [r["doc_id"] for r in records.read_shuffled(spark, path, seed=1).collect()]
    assert again == [i for i, _ in first]
    half = records.read_shuffled(spark, path, seed=1, share=0.5).count()
    assert 0 < half < len(documents)


def test_added_tokens_are_one_id(library):
    assert library("x <|endoftext|> y") == [87, 220, 50256, 331, 2]


def test_damage_is_found():
    data = records.frame(records.pack(5, b"\x01\x00", 2)) + b"\n"
    payload, end = records.unframe(data)
    assert records.unpack(payload)[0] == 5 and end == len(data)
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(broken))


def test_memory_of_chunks_ages(library):
    coder = records.Encoder(open(FILE, encoding="utf-8").read(), memo=5)
    texts = (
        "a b c d e f g, h! i's", "a b c", "k l m n, o p", "a b c d\n\n e", " \n ", "x" * 200 + " y", "", " ", "\n",
        "one\nTwo.\nthree, four\n", " lead and trail ", "\nlead", "a\0b c\nd", "a   b\n c \nd", "it's\nhe'll\n's x",
        "d\n1 2\n- x\né ü\nÀb", "<|endoftext|>", "x <|endoftext|> y", "a\n<|endoftext|>\nb <|endoftext|", "\n\n", "a\n",
        " <|endoftext|> ",
    )
    for text in texts:
        assert coder.encode([text])[0] == b"".join(i.to_bytes(2, "little") for i in library(text)[:-1])
