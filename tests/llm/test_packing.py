import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def by_the_rule(lengths, room):
    """Tries every open sequence and counts the squares anew."""
    gaps, places = [], []
    for length in lengths:
        best = None
        for gap in sorted({g for g in gaps if g >= length}):
            after = list(gaps)
            after[after.index(gap)] = gap - length
            counts = {}
            for g in after:
                if g:
                    counts[g] = counts.get(g, 0) + 1
            squares = sum(n * n for n in counts.values())
            if best is None or squares < best[0]:
                best = squares, gap
        if best is None:
            gaps.append(room - length)
            places.append(0)
        else:
            gaps[gaps.index(best[1])] -= length
            places.append(room - best[1])
    return places, sorted(gaps)


@pytest.mark.parametrize("room, seed", [(10, 1), (30, 2), (30, 3), (64, 4)])
def test_places_by_the_rule(room, seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, room) for _ in range(120)), reverse=True)
    bins, offsets, left = packing.pack_lengths(np.array(lengths), room)
    places, gaps = by_the_rule(lengths, room)
    assert offsets.tolist() == places and sorted(left.tolist()) == gaps
    assert len(set(bins.tolist())) == len(left)


def check_places(rows, room):
    """Every sequence is filled from 0 without gap or overlap; returns how many there are."""
    filled = {}
    for sequence, offset, length in sorted(rows):
        assert offset == filled.get(sequence, 0) and length > 0
        filled[sequence] = offset + length
    assert max(filled.values(), default=0) <= room
    return len(filled)


def pieces_of(rows, library, room):
    expected = []
    for doc_id, text in rows:
        ids, start, number = library(text), 0, 0
        while start < len(ids):
            length = (len(ids) - start - 1) % room + 1 if number == 0 else room
            own = b"".join(i.to_bytes(4, "little") for i in ids[start : start + length])
            expected.append((doc_id is None, doc_id or 0, number, start, length, zlib.crc32(own)))
            start, number = start + length, number + 1
    return sorted(expected)


@pytest.mark.parametrize("room", [2048, 100])
def test_pieces_and_places(texts, odd, documents, library, room):
    rows = [*odd, *documents, (50, "x <|endoftext|> y"), (51, "w " * (room - 1)), (52, "w " * room)]
    packed = packing.pack_documents(texts(*rows), FILE, room).collect()
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    assert found == pieces_of(rows, library, room)
    n = check_places([(r["sequence_id"], r["offset"], r["length"]) for r in packed], room)
    tokens = sum(r["length"] for r in packed)
    assert n <= -(-tokens // room) * 1.01 + 1


def test_rounds_of_many_tasks(spark):
    rng = random.Random(5)
    lengths = [min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(6000)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long")
    packed = packing.pack(pieces, task_pieces=500).collect()
    assert sorted((r["doc_id"], r["length"]) for r in packed) == list(enumerate(lengths))
    n = check_places([(r["sequence_id"], r["offset"], r["length"]) for r in packed], 2048)
    one = len(packing.pack_lengths(np.array(sorted(lengths, reverse=True)), 2048)[2])
    assert one <= n <= 1.005 * one + 1


def test_lengths_that_never_fit_together_stop(spark):
    pieces = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1100).cast("long").alias("length"))
    packed = packing.pack(pieces, task_pieces=300)
    assert packed.select("sequence_id").distinct().count() == 3000


def test_wrong_lengths_are_errors(spark):
    for length in (None, 0, 11):
        with pytest.raises(Exception, match="no length from 1 to 10"):
            packing.pack(spark.createDataFrame([(1, length)], "doc_id long, length long"), 10)


def test_sequences_hold_the_ids(texts, odd, documents, library):
    rows = [*odd, *documents[:50], (7, "same"), (7, "same")]
    made = packing.sequences(texts(*rows), FILE, 500).collect()
    parts = []
    for row in made:
        assert len(row["ids"]) <= 500 and row["offsets"][0] == 0
        parts += [tuple(row["ids"][a:b]) for a, b in zip(row["offsets"], [*row["offsets"][1:], None])]
    expected = []
    for _, text in rows:
        ids = library(text)
        expected += [tuple(ids[s : s + n]) for s, n in packing.cuts(len(ids), 500)]
    assert sorted(parts) == sorted(expected)


def test_empty_table(texts):
    assert packing.pack_documents(texts((1, "a")).limit(0), FILE).count() == 0
