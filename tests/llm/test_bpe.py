import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm.bpe import ByteBpe, PerfectHash, encode_documents, merge_bytes, read_ranks

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = read_ranks(FILE)
CODER = ByteBpe(RANKS, public_tokenizers.PATTERN, memo=50)
LIBRARY = tiktoken.Encoding(
    "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab .,'st\n\t\r \x1c\x85\u200b\u3000éß漢1٣!#🎉\u0301", max_size=60))
def test_same_ids_as_the_library(text):
    ids = CODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


def test_long_runs():
    for text in ("a" * 5000, "ab" * 3000, " " * 3000 + "x", "\n" * 999):
        assert CODER.encode(text) == LIBRARY.encode_ordinary(text)


def test_perfect_hash_has_no_empty_slot():
    found = PerfectHash(RANKS)
    assert all(key is not None for key in found.keys) and len(found.keys) == len(RANKS)
    assert all(found.get(key) == rank for key, rank in RANKS.items())
    assert found.get(b"no such token in there") is None
    assert PerfectHash({}).get(b"a") is None


def test_merges_take_the_leftmost_of_equal_rank():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aaa": 3}
    assert merge_bytes(b"aaaaa", ranks) == [2, 3]
    assert merge_bytes(b"a", ranks) == [0]
    with pytest.raises(KeyError):
        merge_bytes(b"ac", ranks)


def test_rows(texts, odd, documents):
    rows = [*odd, *documents]
    found = encode_documents(texts(*rows), FILE, public_tokenizers.PATTERN, with_ids=True).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4])
    expected = []
    for doc_id, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        expected.append((
            doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(), ids,
        ))
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert encode_documents(texts(*rows).limit(0), FILE, public_tokenizers.PATTERN).count() == 0
