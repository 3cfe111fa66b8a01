import hashlib
import re
from collections import defaultdict

import pytest

from tillwright.llm.exact_dedup import Owner, PatriciaTrie, drop_copies, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, left = min(known, default=None), 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("budget", [1, 3000, 1 << 28])
def test_equals_brute_force(texts, odd, documents, budget):
    rows = [*odd, *documents]
    assert sorted(map(tuple, exact_dedup(texts(*rows), trie_bytes=budget).collect()), key=str) == brute(rows)


def test_kept_rows_have_all_columns(texts, odd):
    df = texts(*odd)
    kept = drop_copies(df)
    assert kept.columns == df.columns
    expected = sorted([(i, s) for i, _, _, k, s in brute(odd) if k], key=str)
    found = [(r["doc_id"], hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", r["text"] or "").encode()).hexdigest())
             for r in kept.collect()]
    assert sorted(found, key=str) == expected


def test_empty_table(texts):
    assert exact_dedup(texts((1, "a")).limit(0)).count() == 0
    assert drop_copies(texts((1, "a")).limit(0)).count() == 0


@pytest.mark.parametrize("budget", [1, 400, 1000, 1 << 20])
def test_trie_with_and_without_spill(tmp_path, budget):
    words = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abcabc" * 50, b"abcabc" * 50 + b"x", b"ab", b"a", b""] * 3
    trie = PatriciaTrie(budget, str(tmp_path))
    for number, word in enumerate(words):
        trie.add(word, Owner((len(word), word.decode()[:3] + str(len(word))), number, 1, 1))
    found = {o.key: (o.least, o.rows) for o in trie.owners()}
    assert found == {
        (len(w), w.decode()[:3] + str(len(w))): (words.index(w), words.count(w)) for w in set(words)
    }
    assert bool(trie.spilled) == (budget < 1 << 20)
    assert not list(tmp_path.iterdir())


def test_one_text_without_an_id_holds_a_third_of_the_rows(texts):
    rows = [(None, None)] * 150 + [(i, f"own {i}") for i in range(200)] + [(3, "again")] * 60 + [(5000 + i, "same") for i in range(90)]
    df = texts(*rows).repartition(7)
    assert sorted(map(tuple, exact_dedup(df).collect()), key=str) == brute(rows)
    assert drop_copies(df).count() == sum(kept for *_, kept, _ in brute(rows))
