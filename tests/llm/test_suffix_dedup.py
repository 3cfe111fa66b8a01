import hashlib
import random
from collections import Counter

import pytest

from tillwright.llm.suffix_dedup import common, cut_repeats, front_code, front_decode, merge_runs


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if times[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def generated():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdef", k=rng.randint(2, 7))) for _ in range(60)]
    passage = " ".join(rng.choices(words, k=30))
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(0, 80)))
        if i % 3 == 0:
            text = text[: len(text) // 2] + passage + text[len(text) // 2 :]
        if i % 10 == 1:
            text = rows[-1][1][:-3] + "é" + text[:10]
        rows.append((i, text))
    rows += [(100, "ab" * 200), (101, "x" * 500), (102, passage), (103, passage), (104, "ü" * 90)]
    return rows


@pytest.mark.parametrize("length,stem,block,hot", [
    (40, 12, 1 << 22, 2000), (40, 12, 500, 2000), (40, 12, 500, 3), (40, 40, 800, 5), (7, 3, 300, 10),
])
def test_equals_brute_force(texts, odd, length, stem, block, hot):
    short = [(i, t) for i, t in odd if not t or len(t) < 1000]
    rows = [*short, *generated()]
    found = cut_repeats(texts(*rows), length=length, stem=stem, block_bytes=block, hot=hot).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, length)


def test_two_hundred_bytes_over_documents(texts, documents):
    rows = documents[:120]
    found = cut_repeats(texts(*rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, 200)


def test_kept_bytes_and_very_long_texts(texts, odd):
    rows = cut_repeats(texts(*odd), with_kept=True).collect()
    for r in rows:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    assert {r["n_removed"] for r in rows if r["doc_id"] == 5} == {len(dict(odd)[5])}
    assert cut_repeats(texts(*odd).limit(0)).count() == 0


def test_runs_merge_with_their_common_prefixes():
    rng = random.Random(2)
    for _ in range(50):
        runs = [sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 6))) for _ in range(rng.randint(0, 9)))
                for _ in range(rng.randint(0, 7))]
        coded = []
        for run in runs:
            prefixes, rests, sizes = front_code(run)
            assert list(front_decode(prefixes, rests, sizes)) == run
            coded.append(list(zip(run, prefixes.tolist(), strict=True)))
        merged = [(runs[a][b], share) for a, b, share in merge_runs(coded)]
        assert [s for s, _ in merged] == sorted(s for run in runs for s in run)
        assert all(merged[k][1] == common(merged[k - 1][0], merged[k][0], 0) for k in range(1, len(merged)))
