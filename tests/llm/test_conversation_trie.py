import hashlib
import random
import zlib

import pytest

from tillwright.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, len int, rep string"


def digest(role, text):
    told = f"{len(role.encode())}:{role}{text}"
    return hashlib.sha256(told.encode()).hexdigest()[:32]


def turns_of(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs.setdefault(conv, []).append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    return {c: [pair for _, pair in sorted(ts)] for c, ts in convs.items()}


def regrown(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    """Nodes as a dictionary of prefixes."""
    members = {}
    for c, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[b] for b in below) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = own + sum(saved[b] for b in below)
    result = []
    for prefix, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(prefix))))
        result.append((
            min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own),
            len(children.get(prefix, [])), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=lambda r: r[:2])


def found(spark, rows, regrow=True, **settings):
    full = [(*r, "x", 1, 2, "y") for r in rows]
    turns = trie.numbered(spark.createDataFrame(full, SCHEMA).repartition(5))
    made = trie.trie(trie.regrown(turns) if regrow else trie.plain(turns), **settings)
    return sorted((tuple(r) for r in made.collect()), key=lambda r: r[:2])


def odd_rows(seed, convs=60, longest=12):
    rng = random.Random(seed)
    ids = rng.sample(range(-20, 200), convs)
    rows = []
    for c in ids:
        shared = rng.random() < 0.6
        for turn in range(rng.choice([1, 2, 3, 5, longest])):
            text = f"turn {turn} {'é' if turn % 2 else ''}" if shared and rng.random() < 0.8 else f"own {c} {turn}"
            rows.append((c, turn, rng.choice(["user", "user", "assistant"]), text))
    rows += [(300, None, "user", "n"), (300, None, "user", "n"), (300, 0, None, None), (301, 0, "", ""), (302, 5, "ab", "c"),
             (303, 5, "a", "bc"), (None, 1, "user", "lost"), (304, 1, "x", "tie b"), (304, 1, "x", "tie a"), (304, -1, "x", "L" * 100_000)]
    return rows


@pytest.mark.parametrize("seed, settings", [
    (1, {}), (2, {"max_cell_bits": 2}), (3, {"block": 3}), (4, {"max_cell_bits": 4, "block": 2}),
])
def test_equals_brute_force(spark, seed, settings):
    rows = odd_rows(seed)
    assert found(spark, rows, **settings) == brute(regrown(turns_of(rows)))
    assert found(spark, rows, regrow=False, **settings) == brute(turns_of(rows))


def test_conversations_across_tasks_and_shuffled_joins(spark):
    """One conversation holds most turns, in many range tasks; copies of it and of others share nodes."""
    rows = [(7, t, "user", f"long {t}") for t in range(700)] + [(1000 + c, t, "user", f"long {t}") for c in range(40) for t in range(3)]
    rows += [(8, t, "user", f"long {t}") for t in range(650)] + odd_rows(9, 20)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(kept, ("false", "-1")):
        spark.conf.set(k, v)
    try:
        assert found(spark, rows, block=100) == brute(regrown(turns_of(rows)))
        assert found(spark, rows, regrow=False) == brute(turns_of(rows))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN_BYTES", 100)
    rows = [(c, t, "user", f"same {t}") for c in range(500) for t in range(2)]
    assert found(spark, rows, regrow=False) == brute(turns_of(rows))


def test_all_turnless_and_empty(spark):
    # Conversations whose own turns all lie within their first h and whose base is not there.
    ids = [c for c in range(1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:20]
    rows = [(c, t, "user", f"{c} {t}") for c in ids for t in range(2)]
    assert found(spark, rows) == brute(regrown(turns_of(rows)))
    assert len(found(spark, rows)) == 1
    assert found(spark, [(None, 1, "user", "lost")]) == []
    assert trie.trie(trie.plain(trie.numbered(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_screen_proves_most_single_prefixes(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in range(400) for t in range(5)]
    turns = trie.numbered(spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA))
    paths = trie._paths(trie.plain(turns).turns, 5, 1024)
    flags = trie._screen(paths, 13).collect()
    assert sum(r["alone"] for r in flags) > 0.95 * len(flags)
    assert not any(r["alone_above"] for r in flags if r["depth"] == 1)
