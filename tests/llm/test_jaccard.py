import random

import numpy as np
import pytest

from tillwright.llm.jaccard import choose, leaf_buckets, near_texts, one_of_each, runs_for
from tillwright.llm.shingles import Shingler


def brute(rows, least=0.8):
    code = Shingler()
    sets = [frozenset(code.shingles(t or "").tolist()) for _, t in rows]
    usable = [n for n, (i, _) in enumerate(rows) if sets[n] and i is not None]
    links = {n: [] for n in usable}
    for n in usable:
        for m in usable:
            if n < m and len(sets[n] & sets[m]) >= least * len(sets[n] | sets[m]) - 1e-9:
                links[n].append(m)
                links[m].append(n)
    out = []
    for n, (i, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links.get(todo.pop(), []):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        first = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((i, len(links.get(n, [])), first, i == first))
    return sorted(out, key=str)


def generated():
    rng = random.Random(9)
    words = ["w%d" % n for n in range(400)]
    rows, number = [], 0
    passage = rng.choices(words, k=30)
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(4, 120))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((number, " ".join(copy)))
            number += 1
    for _ in range(30):
        rows.append((number, " ".join(rng.choices(words, k=20) + passage + rng.choices(words, k=20))))
        number += 1
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_equals_brute_force(texts, odd, documents, block):
    rows = [*odd, *[(1000 + i, t) for i, t in generated()], *[(5000 + i, t) for i, t in documents]]
    # A chain may run through a row that repeats an id; leave those to the test below.
    rows = [r for n, r in enumerate(rows) if r[0] is None or r[0] not in [x[0] for x in rows[:n]]]
    assert sorted(map(tuple, near_texts(texts(*rows), block=block).collect()), key=str) == brute(rows)


def test_repeated_rows_and_empty_tables(texts, odd):
    found = near_texts(texts(*odd))
    assert found.count() == len(odd)
    assert {r["n_links"] for r in found.where("doc_id = 4").collect()} == {2}
    assert near_texts(texts(*odd).limit(0)).count() == 0
    assert one_of_each(texts(*odd)).columns == texts(*odd).columns


def test_one_of_each_group_stays(texts):
    rows = [(1000 + i, t) for i, t in generated()]
    kept = {r["doc_id"] for r in one_of_each(texts(*rows)).collect()}
    assert kept == {i for i, _, _, k in brute(rows) if k}


def test_runs_follow_from_the_recall():
    assert runs_for(0.9999) > runs_for(0.99) > runs_for(0.9) >= 1


def test_pairs_at_the_threshold_share_a_path_as_often_as_promised():
    """One set holds the other, so the pair shares the fewest tokens of the common sample."""
    rng, runs, pairs = np.random.default_rng(3), runs_for(0.9999), 40_000
    apart = 0
    for _ in range(pairs):
        tokens = np.sort(rng.integers(0, 1 << 64, 250, dtype=np.uint64))
        part = np.sort(rng.permutation(tokens)[:200])
        apart += not np.intersect1d(choose(tokens, runs)[0], choose(part, runs)[0]).size
    assert apart <= 4


def test_large_buckets_of_the_same_members_split_each_in_its_own_way(spark):
    """A template puts 200 pairs into ten equal buckets; a pair shares 24 other sample tokens."""
    rng, paths, rows = np.random.default_rng(1), list(range(10)), []
    for number in range(400):
        if number % 2 == 0:
            sample = rng.integers(0, 1 << 63, 24).tolist()
        rows.append((number, number, 0, 220, paths, sample))
    schema = "id long, hi long, lo long, size long, paths array<long>, sample array<long>"
    sets = spark.createDataFrame(rows, schema)
    leaf = {}
    for row in leaf_buckets(sets, sets.select("id", "hi", "lo"), block=8).collect():
        leaf.setdefault(row["path"], set()).add(row["id"])
    met = {i for ids in leaf.values() for i in ids if i % 2 == 0 and i + 1 in ids}
    assert len(met) == 200
