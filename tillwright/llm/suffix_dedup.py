"""Removes every byte covered by a string of `LENGTH` bytes that also starts anywhere else.

Sorting all suffixes would move each byte of the corpus about two hundred times. Two steps keep the
result and move little:

1. Anchors. Each window of `LENGTH` bytes names one position in it, that of the least hash among its
   strings of `STEM` bytes. Equal windows name the same position, so only suffixes at anchors have
   to be sorted. A count of the stems' hashes over all blocks leaves the anchors whose stem occurs
   again; windows that hold a stem known to occur once cannot occur again either.
2. Sorted runs. Each block of texts sorts the suffixes at its anchors, each with the bytes that the
   windows of the anchor span, and writes them as a front-coded run: a suffix is its common prefix
   with the one before, and the rest. Runs are dealt by the hash of the stem. A task merges its runs
   with a loser tree that carries common prefixes along and compares bytes only beyond them. Suffixes
   that share their stem are neighbours then, and their windows are matched.

Equal spans of one block are sent once. Anchors with more than `HOT` occurrences, as in a passage that
a third of all documents hold, would meet in one task; their windows are matched by 128-bit
fingerprints instead, each once per block and dealt by itself, so that no task gets more than its
share.

Equal texts are one from the start; texts live in blocks of about `BLOCK_BYTES` in a bucketed table, so
that the later steps join to them without moving them again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import arrived, shipped, whole, written
from tillwright.llm.shingles import mix, powers
from tillwright.session import work_dir

LENGTH, STEM = 200, 64
BLOCK_BYTES = 1 << 21
HOT = 2000
#: Marks per window, on average.
MARKS = 2
#: Entries whose windows are matched at once.
AT_ONCE = 20_000

_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


class Hasher:
    """Rolling hashes of byte arrays; power tables grow with the longest array seen."""

    def __init__(self):
        self.value = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []

    def __getstate__(self):
        return {"value": self.value, "tables": []}

    def sums(self, data: np.ndarray, which: int = 0) -> np.ndarray:
        if not self.tables or len(self.tables[0][0]) <= len(data):
            size = max(len(data) + 1, 1 << 16)
            self.tables = [(powers(b, size), powers(pow(b, -1, 1 << 64), size)) for b in _BASES]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.tables[which][0][: len(data)], out=total[1:])
        return total

    def at(self, sums: np.ndarray, starts: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        return mix((sums[starts + size] - sums[starts]) * self.tables[which][1][starts])


class Anchors:
    """Anchors of the texts of a block: position, hash of the stem, and first and last window.

    `marks` are the positions of all stems whose hash is low, wherever they stand; most anchors are
    among them. A mark that occurs once rules out every window that holds it, which an
    anchor that is no mark would not: its stem may occur elsewhere without being an anchor there.
    All positions count from the start of the block. Windows never cross texts.
    """

    def __init__(self, hasher: Hasher, data: np.ndarray, lengths: np.ndarray, length: int, stem: int):
        self.length, self.stem = length, stem
        ends = np.cumsum(lengths)
        empty = np.zeros(0, np.int64)
        self.at, self.first, self.last, self.marks = empty, empty, empty, empty
        self.hash = self.mark_hash = empty.astype(np.uint64)
        window = np.flatnonzero(_inside(len(data), ends, length))
        if not len(window):
            return
        starts = np.arange(len(data) - stem + 1)
        stems = hasher.at(hasher.sums(data), starts, stem)
        # High half of the hash, then the position: the leftmost of the least.
        least = (stems & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
        width, span = length - stem + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: span - width], least[width - span :])
        chosen = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        change = np.flatnonzero((np.diff(chosen) != 0) | (np.diff(window) != 1))
        begin = np.concatenate([[0], change + 1])
        self.at, self.first = chosen[begin], window[begin]
        self.last = window[np.concatenate([change, [len(window) - 1]])]
        self.hash = stems[self.at]
        low = stems < np.uint64(min((1 << 64) - 1, MARKS * (1 << 64) // width))
        self.marks = np.flatnonzero(low & _inside(len(data), ends, stem))
        self.mark_hash = stems[self.marks]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the stems at anchors and marks, and at how many positions each stands."""
        both = np.concatenate([self.at, self.marks])
        _, one = np.unique(both, return_index=True)
        return np.unique(np.concatenate([self.hash, self.mark_hash])[one], return_counts=True)

    def narrow(self, again: np.ndarray) -> None:
        """Keeps anchors whose hash is in the sorted `again`, and their windows without a single mark."""
        single = self.marks[~_among(self.mark_hash, again)]
        keep = _among(self.hash, again)
        at, first, last, own = self.at[keep], self.first[keep], self.last[keep], self.hash[keep]
        if len(single) and len(at):
            where = np.searchsorted(single, at)
            before = np.where(where > 0, single[np.maximum(where - 1, 0)], -1)
            after = np.where(where < len(single), single[np.minimum(where, len(single) - 1)], 1 << 62)
            first = np.maximum(first, before + 1)
            last = np.minimum(last, after - (self.length - self.stem) - 1)
        keep = first <= last
        self.at, self.first, self.last, self.hash = at[keep], first[keep], last[keep], own[keep]


def _inside(size: int, ends: np.ndarray, length: int) -> np.ndarray:
    """Starts of strings of `length` bytes that lie within one text."""
    inside = np.ones(max(0, size - length + 1), bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - length + 1) : end] = False
    return inside


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among sorted known ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


# ---- blocks of different texts -----------------------------------------------------------


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch as one row."""
    for batch in batches:
        place: dict[bytes, int] = {}
        rows, copies = [], []
        for i, sha in enumerate(batch.column(0).to_pylist()):
            if sha in place:
                copies[place[sha]] += 1
            else:
                place[sha] = len(rows)
                rows.append(i)
                copies.append(1)
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [kept.column(0), pa.array(copies, pa.int64()), kept.column(1)], names=["sha", "copies", "text"]
        )


_BLOCKS = "block long, copies binary, lengths binary, shas binary, data binary"


def _pack(block_bytes: int):
    """Texts in order of their hash to blocks; equal ones follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shas, copies, texts, held = [], [], [], 0
        for batch in batches:
            for i, (sha, times) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True)):
                if shas and shas[-1] == sha:
                    copies[-1] += times
                    continue
                if held >= block_bytes:
                    yield _block(number, shas, copies, texts)
                    number += 1
                    shas, copies, texts, held = [], [], [], 0
                shas.append(sha)
                copies.append(times)
                texts.append(batch.column(2)[i].as_py())
                held += len(texts[-1])
        if shas:
            yield _block(number, shas, copies, texts)

    return run


def _block(number, shas, copies, texts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([np.array(copies, "<i8").tobytes()], pa.binary()),
        pa.array([np.array([len(t) for t in texts], "<i8").tobytes()], pa.binary()),
        pa.array([b"".join(shas)], pa.binary()), pa.array([b"".join(texts)], pa.binary()),
    ], names=["block", "copies", "lengths", "shas", "data"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i] for n in batch.schema.names}


def _numbers(value: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind) if value.is_valid else np.zeros(0, kind)


# ---- which stems occur again ---------------------------------------------------------------


def _stems(sent, length: int, stem: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = arrived(sent)
        for row in _rows(batches):
            found = Anchors(hasher, _numbers(row["data"], "u1"), _numbers(row["lengths"], "<i8"), length, stem)
            stems, times = found.counted()
            part = (stems % np.uint64(parts)).astype(np.int64)
            order = part.argsort(kind="stable")
            edges = np.flatnonzero(np.diff(part[order], prepend=-1))
            out = [
                (int(part[order[a]]), stems[order[a:b]].tobytes(), times[order[a:b]].astype("<i8").tobytes())
                for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True)
            ] if len(order) else []
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int32()), pa.array([row["block"].as_py()] * len(out), pa.int64()),
                    pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()),
                ], names=["part", "block", "stems", "times"])

    return run


def _again(hot: int):
    """Per block the stems that occur at least twice anywhere, and which of them are hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, stems, times = [], [], []
        for row in _rows(batches):
            blocks.append(row["block"].as_py())
            stems.append(_numbers(row["stems"], "<u8"))
            times.append(_numbers(row["times"], "<i8"))
        if not blocks:
            return
        _, place = np.unique(np.concatenate(stems), return_inverse=True)
        total = np.bincount(place, np.concatenate(times)).astype(np.int64)[place]
        at, out = 0, []
        for block, own in zip(blocks, stems, strict=True):
            count = total[at : at + len(own)]
            at += len(own)
            keep = count > 1
            if keep.any():
                out.append((block, own[keep].tobytes(), (count[keep] > hot).tobytes()))
        if out:
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
                names=["block", "stems", "hot"],
            )

    return run


# ---- sorted runs ---------------------------------------------------------------------------


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Common prefix with the one before, the rests one after the other, and their sizes."""
    prefixes, rests, before = [], [], b""
    for suffix in suffixes:
        size = common(before, suffix, 0)
        prefixes.append(size)
        rests.append(suffix[size:])
        before = suffix
    return np.array(prefixes, "<i2"), b"".join(rests), np.array([len(r) for r in rests], "<i2")


def front_decode(prefixes: np.ndarray, rests: bytes, sizes: np.ndarray) -> Iterator[bytes]:
    at, before = 0, b""
    for prefix, size in zip(prefixes.tolist(), sizes.tolist(), strict=True):
        before = before[:prefix] + rests[at : at + size]
        at += size
        yield before


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that share `known` bytes."""
    high = min(len(a), len(b))
    if a[known:high] == b[known:high]:
        return high
    low = known
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def merge_runs(runs: list[list[tuple[bytes, int]]]) -> Iterator[tuple[int, int, int]]:
    """Merges sorted runs of (string, common prefix with the one before it in the run).

    Yields (run, position, common prefix with the string yielded before). A loser tree: every inner
    node holds the run that lost there and its common prefix with the run that won. Of two strings
    that follow the last one out, the one that shares more with it comes first; only on equal
    shares are bytes compared, from there on.
    """
    count = len(runs)
    size = 1
    while size < count:
        size *= 2
    heads = [0] * count
    shares = [0] * count  # with the last string out, or with the winner the run lost to
    done = count  # stands for a run that is used up; it loses against any other

    def beats(a: int, b: int) -> bool:
        if b >= done or heads[b] >= len(runs[b]):
            return True
        if a >= done or heads[a] >= len(runs[a]):
            return False
        if shares[a] != shares[b]:
            return shares[a] > shares[b]
        x, y = runs[a][heads[a]][0], runs[b][heads[b]][0]
        same = common(x, y, shares[a])
        first = x[same : same + 1] < y[same : same + 1] or (x[same:] == y[same:] and a < b)
        shares[b if first else a] = same
        return first

    loser = [done] * size
    level = [i if i < count else done for i in range(size)]
    nodes = size // 2
    while nodes:
        up = []
        for i in range(nodes):
            a, b = level[2 * i], level[2 * i + 1]
            if beats(a, b):
                up.append(a)
                loser[nodes + i] = b
            else:
                up.append(b)
                loser[nodes + i] = a
        level = up
        nodes //= 2
    top = level[0] if level else done
    while top < done and heads[top] < len(runs[top]):
        yield top, heads[top], shares[top]
        heads[top] += 1
        if heads[top] < len(runs[top]):
            shares[top] = runs[top][heads[top]][1]
        node = (top + size) // 2
        while node:
            other = loser[node]
            if not beats(top, other):
                loser[node], top = top, other
            node //= 2


_RUN = np.dtype([
    ("prefix", "<i2"), ("rest", "<i2"), ("left", "<i2"), ("known", "u1"), ("start", "<i8"),
])


def _entries(sent, length: int, stem: int, parts: int):
    """Runs of the anchors that occur again, windows known to, and fingerprints of hot windows.

    kind 0: a run for `part`; kind 1: spans of the block known to be repeated (data: starts and
    ends); kind 2: fingerprints for `part` of windows at hot anchors (data: two 64-bit halves, times).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = arrived(sent)
        for row in _rows(batches):
            data = _numbers(row["data"], "u1")
            raw = row["data"].as_buffer().to_pybytes()
            found, hot = _narrowed(hasher, row, length, stem)
            out: list[tuple] = []
            cold = np.flatnonzero(~hot)
            groups: dict[bytes, list[int]] = {}
            first, last, at = found.first.tolist(), found.last.tolist(), found.at.tolist()
            for i in cold.tolist():
                groups.setdefault(raw[first[i] : last[i] + length] + at_bytes(at[i] - first[i]), []).append(i)
            entries: dict[int, list] = {}
            sure = []
            for members in groups.values():
                i = members[0]
                if len(members) > 1:
                    sure += members
                part = int(found.hash[i] % np.uint64(parts))
                entries.setdefault(part, []).append(
                    (raw[at[i] : last[i] + length], raw[first[i] : at[i]], len(members) > 1, first[i])
                )
            for part, own in entries.items():
                own.sort(key=lambda e: e[0])
                out.append((0, part, _run_bytes(own)))
            if sure:
                spans = np.stack([found.first[sure], found.last[sure] + length], axis=1).astype("<i8")
                out.append((1, -1, spans.tobytes()))
            if hot.any():
                prints = _prints(hasher, data, found, hot, length)[0]
                out += [(2, part, own) for part, own in _print_parts(prints, parts)]
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                    pa.array([row["block"].as_py()] * len(out), pa.int64()), pa.array(columns[2], pa.binary()),
                ], names=["kind", "part", "block", "data"])

    return run


def at_bytes(offset: int) -> bytes:
    return offset.to_bytes(4, "little")


def _run_bytes(entries: list) -> bytes:
    prefixes, rests, sizes = front_code([e[0] for e in entries])
    head = np.zeros(len(entries), _RUN)
    head["prefix"], head["rest"] = prefixes, sizes
    head["left"] = [len(e[1]) for e in entries]
    head["known"] = [e[2] for e in entries]
    head["start"] = [e[3] for e in entries]
    return len(entries).to_bytes(8, "little") + head.tobytes() + rests + b"".join(e[1] for e in entries)


def _read_run(data: bytes) -> tuple[np.ndarray, list[tuple[bytes, int]], list[bytes]]:
    count = int.from_bytes(data[:8], "little")
    head = np.frombuffer(data, _RUN, count, 8)
    at = 8 + head.nbytes
    end = at + int(head["rest"].sum(dtype=np.int64))
    suffixes = list(zip(front_decode(head["prefix"], data[at:end], head["rest"]), head["prefix"].tolist(), strict=True))
    lefts, at = [], end
    for size in head["left"].tolist():
        lefts.append(data[at : at + size])
        at += size
    return head, suffixes, lefts


def _narrowed(hasher, row: dict, length: int, stem: int) -> tuple[Anchors, np.ndarray]:
    """Anchors of a block that occur again, with which of them are hot."""
    found = Anchors(hasher, _numbers(row["data"], "u1"), _numbers(row["lengths"], "<i8"), length, stem)
    lists = row["stems"].as_py() or []
    again = np.concatenate([np.frombuffer(s["stems"], "<u8") for s in lists] + [np.zeros(0, "<u8")])
    hot = np.concatenate([np.frombuffer(s["hot"], bool) for s in lists] + [np.zeros(0, bool)])
    order = again.argsort()
    again, hot = again[order], hot[order]
    found.narrow(again)
    if not len(again):
        return found, np.zeros(0, bool)
    return found, hot[np.minimum(np.searchsorted(again, found.hash), len(again) - 1)]


def _prints(hasher, data, found: Anchors, hot: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window at a hot anchor, and where it starts."""
    sizes = (found.last - found.first + 1)[hot]
    starts = np.repeat(found.first[hot] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    halves = [hasher.at(hasher.sums(data, k), starts, length, k) for k in (0, 1)]
    return np.column_stack(halves), starts


def _print_parts(prints: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Different fingerprints with how often each occurs, dealt by the first half."""
    order = np.lexsort((prints[:, 1], prints[:, 0]))
    prints = prints[order]
    fresh = np.ones(len(prints), bool)
    fresh[1:] = (prints[1:] != prints[:-1]).any(axis=1)
    begin = np.flatnonzero(fresh)
    times = np.diff(np.append(begin, len(prints))).astype("<u8")
    table = np.column_stack([prints[begin], times])
    part = (table[:, 0] % np.uint64(parts)).astype(np.int64)
    order = part.argsort(kind="stable")
    edges = np.flatnonzero(np.diff(part[order], prepend=-1))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
        yield int(part[order[a]]), table[order[a:b]].astype("<u8").tobytes()


def _prints_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block its fingerprints that occur at least twice anywhere."""
    blocks, tables = [], []
    for row in _rows(batches):
        blocks.append(row["block"].as_py())
        tables.append(_numbers(row["data"], "<u8").reshape(-1, 3))
    if not blocks:
        return
    joined = np.concatenate(tables)
    order = np.lexsort((joined[:, 1], joined[:, 0]))
    fresh = np.ones(len(joined), bool)
    fresh[1:] = (joined[order][1:, :2] != joined[order][:-1, :2]).any(axis=1)
    place = np.empty(len(joined), np.int64)
    place[order] = np.cumsum(fresh) - 1
    again = np.bincount(place, joined[:, 2].astype(np.float64))[place] > 1
    at, out = 0, []
    for block, own in zip(blocks, tables, strict=True):
        hit = own[again[at : at + len(own)], :2]
        at += len(own)
        if len(hit):
            out.append((block, hit.astype("<u8").tobytes()))
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
            names=["block", "prints"],
        )


def _match(sent, length: int, stem: int):
    """Merges the runs of each part and returns the repeated spans of each block."""

    def spans(hasher, entries: list[tuple]):
        """Repeated windows among entries (group, right, left, known, block, start)."""
        texts = [e[2] + e[1] for e in entries]
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        owner = np.repeat(np.arange(len(entries)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        sums = hasher.sums(data)
        code = hasher.at(sums, begin[owner] + within, length)
        left = np.array([len(e[2]) for e in entries])
        # Equal windows lie alike around the anchor, within one group.
        group = np.array([e[0] for e in entries], np.uint64)
        code = mix(code ^ mix(group[owner] * np.uint64(4096) + (within - left[owner] + 2048).astype(np.uint64)))
        _, place = np.unique(code, return_inverse=True)
        known = np.array([1 + e[3] for e in entries])
        again = np.bincount(place, known[owner])[place] > 1
        start = np.array([e[5] for e in entries])[owner] + within
        out: dict[int, list] = {}
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(owner)], strict=True):
            hit = start[a:b][again[a:b]]
            if len(hit):
                cut = np.flatnonzero(np.diff(hit) > length)
                first = hit[np.concatenate([[0], cut + 1])]
                last = hit[np.concatenate([cut, [len(hit) - 1]])] + length
                out.setdefault(entries[owner[a]][4], []).append(np.stack([first, last], axis=1))
        return [(block, np.concatenate(s).astype("<i8").tobytes()) for block, s in out.items()]

    def work(hasher, blocks: list[int], blobs: list[bytes]):
        runs = [_read_run(blob) for blob in blobs]
        group, alone = -1, None
        entries: list[tuple] = []
        for run, position, shared in merge_runs([r[1] for r in runs]):
            head, suffixes, lefts = runs[run]
            entry = (suffixes[position][0], lefts[position], int(head["known"][position]), blocks[run],
                     int(head["start"][position]))
            if shared >= stem and group >= 0:
                if alone is not None:
                    entries.append((group, *alone))
                    alone = None
                entries.append((group, *entry))
                continue
            if len(entries) >= AT_ONCE:
                yield from spans(hasher, entries)
                entries = []
            group, alone = group + 1, entry  # one of its kind unless another follows
        if entries:
            yield from spans(hasher, entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = arrived(sent)
        now, blocks, blobs = None, [], []

        def flush():
            out = list(work(hasher, blocks, blobs))
            if out:
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                ], names=["block", "spans"])

        for row in _rows(batches):
            part = row["part"].as_py()
            if part != now and blobs:
                yield from flush()
                blocks, blobs = [], []
            now = part
            blocks.append(row["block"].as_py())
            blobs.append(row["data"].as_buffer().to_pybytes())
        if blobs:
            yield from flush()

    return run


def _cut(sent, length: int, stem: int, with_kept: bool):
    """Per different text: what is left of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = arrived(sent)
        for row in _rows(batches):
            data, lengths = _numbers(row["data"], "u1"), _numbers(row["lengths"], "<i8")
            copies = _numbers(row["copies"], "<i8")
            spans = [np.frombuffer(s, "<i8").reshape(-1, 2) for s in row["spans"].as_py() or []]
            prints = np.concatenate([np.zeros((0, 2), "<u8")] + [
                np.frombuffer(p, "<u8").reshape(-1, 2) for p in row["prints"].as_py() or []
            ])
            if len(prints):
                found, hot = _narrowed(hasher, row, length, stem)
                own, starts = _prints(hasher, data, found, hot, length)
                hit = starts[np.isin(own[:, 0] ^ mix(own[:, 1]), prints[:, 0] ^ mix(prints[:, 1]))]
                spans.append(np.stack([hit, hit + length], axis=1))
            depth = np.zeros(len(data) + 1, np.int64)
            if spans:
                joined = np.concatenate(spans)
                np.add.at(depth, joined[:, 0], 1)
                np.add.at(depth, joined[:, 1], -1)
            gone = np.cumsum(depth)[:-1] > 0
            ends = np.cumsum(lengths)
            sums = np.append(0, np.cumsum(gone))
            begins = gone & ~np.append(False, gone[:-1])
            begins[ends[:-1][lengths[1:] > 0]] = gone[ends[:-1][lengths[1:] > 0]]
            runs = np.append(0, np.cumsum(begins))
            raw = row["data"].as_buffer()
            shas = row["shas"].as_buffer().to_pybytes()
            out = []
            for i, (size, end) in enumerate(zip(lengths.tolist(), ends.tolist(), strict=True)):
                start = end - size
                away, spans_of = int(sums[end] - sums[start]), int(runs[end] - runs[start])
                if copies[i] > 1 and size >= length:
                    away, spans_of = size, 1
                if away == size:
                    text = b""
                elif not away:
                    text = raw[start:end]
                else:
                    text = data[start:end][~gone[start:end]].tobytes()
                own = [shas[32 * i : 32 * i + 32], size, away, spans_of, hashlib.sha256(text).hexdigest()]
                out.append((*own, bytes(text)) if with_kept else own)
            columns = list(zip(*out, strict=True))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                names=["sha", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(columns)],
            )

    return run


def cut_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    stem: int = STEM, block_bytes: int = BLOCK_BYTES, hot: int = HOT, with_kept: bool = False,
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256; `with_kept` adds the bytes left.

    Texts are UTF-8 bytes, null counting as empty. A byte goes if a string of `length` bytes that
    covers it also starts anywhere else, in the same text or another; strings never cross
    texts and are judged on the input. Texts shorter than `length` stay whole; equal longer texts
    go entirely. What is left need not be valid UTF-8. Rows that repeat each get their result; other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    hasher = shipped(spark, Hasher())
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = F.encode(whole(text_col), "UTF-8")
    texts = docs.select(F.unhex(F.sha2(data, 256)).alias("sha"), data.alias("text"))
    packed = (
        texts.mapInArrow(_merge, "sha binary, copies long, text binary")
        .repartition(partitions, "sha").sortWithinPartitions("sha").mapInArrow(_pack(block_bytes), _BLOCKS)
    )
    name = f"text_blocks_{uuid.uuid4().hex}"
    path = work_dir(spark, "text-blocks")
    packed.write.bucketBy(partitions, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    try:
        found = _spans_of(spark.table(name), hasher, length, stem, hot, partitions)
        columns = "sha binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        columns += ", kept binary" if with_kept else ""
        results = written(found.mapInArrow(_cut(hasher, length, stem, with_kept), columns), "cut-texts")
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay in the work folder
    rows = docs.select(F.col(id_col).alias("_id"), F.unhex(F.sha2(data, 256)).alias("sha"))
    return rows.join(results, "sha", "left").select(
        F.col("_id").alias(id_col), *[c for c in results.columns if c != "sha"]
    )


def _spans_of(blocks, hasher, length, stem, hot, parts) -> DataFrame:
    """The blocks with their repeated spans and their repeated hot windows."""
    stems = blocks.select("block", "lengths", "data").mapInArrow(
        _stems(hasher, length, stem, parts), "part int, block long, stems binary, times binary"
    )
    again = stems.repartition(parts, "part").mapInArrow(_again(hot), "block long, stems binary, hot binary")
    replies = written(
        again.groupBy("block").agg(F.collect_list(F.struct("stems", "hot")).alias("stems")), "stems-again"
    )
    entries = written(
        blocks.select("block", "lengths", "data").join(replies, "block")
        .mapInArrow(_entries(hasher, length, stem, parts), "kind int, part int, block long, data binary"),
        "suffix-runs",
    )
    merged = (
        entries.where("kind = 0").repartition(parts, "part").sortWithinPartitions("part")
        .select("part", "block", "data").mapInArrow(_match(hasher, length, stem), "block long, spans binary")
    )
    known = entries.where("kind = 1").select("block", F.col("data").alias("spans"))
    spans = merged.unionByName(known).groupBy("block").agg(F.collect_list("spans").alias("spans"))
    prints = (
        entries.where("kind = 2").repartition(parts, "part").select("block", "data")
        .mapInArrow(_prints_again, "block long, prints binary")
        .groupBy("block").agg(F.collect_list("prints").alias("prints"))
    )
    return (
        blocks.join(replies, "block", "left").join(spans, "block", "left").join(prints, "block", "left")
    )
