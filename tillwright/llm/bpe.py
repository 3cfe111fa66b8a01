"""Byte-level BPE encoding and decoding in two tiers.

First tier: a minimal perfect hash (hash and displace) over the vocabulary finds the id of every
pre-token that is a vocabulary entry itself. Second tier: the bytes of any other pre-token form a
linked list, a heap holds the neighbouring pairs by rank and position, and the lowest pair is
merged until none is left.

Pre-tokens are memoised per task up to a bound. Texts whose only white space is space and newline are
cut into chunks first, each from the start of white space to the end of the visible run after it:
no pre-token spans such a cut, so a chunk seen before needs no pattern run. Other texts run
the pattern as they are. The result is the same.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import islice
from operator import itemgetter

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.chunks import CHUNK, OTHER_SPACE, PART, WORD, marks_apart, parts
from tillwright.llm.common import arrived, shipped, whole

#: Strings in each of the two generations that a task remembers.
MEMO = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines `base64 rank`."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file) if a}


class PerfectHash:
    """Minimal perfect hash over byte strings: each key has a slot of its own, no slot is empty.

    Keys fall into buckets by their hash; from the fullest bucket on, each bucket gets the first
    displacement that puts its keys into free slots, and buckets of one key name a free slot. A
    lookup compares the key stored in its slot, so a string that is no key is told apart.
    """

    def __init__(self, values: dict[bytes, int]):
        self.size = len(values)
        self.buckets = max(1, self.size // 2)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [0] * self.size
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in values:
            groups[self._hash(key) % self.buckets].append(key)
        fullest_first = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        single = next((i for i, b in enumerate(fullest_first) if len(groups[b]) < 2), self.buckets)
        for bucket in fullest_first[:single]:
            hashes = [self._hash(key) >> 32 for key in groups[bucket]]
            shift = 0
            while True:
                slots = [self._slot(h, shift) for h in hashes]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for key, slot in zip(groups[bucket], slots, strict=True):
                self.keys[slot], self.values[slot] = key, values[key]
        free = (slot for slot in range(self.size) if self.keys[slot] is None)
        for bucket in fullest_first[single:]:
            for key in groups[bucket]:
                slot = next(free)
                self.shift[bucket] = -1 - slot
                self.keys[slot], self.values[slot] = key, values[key]

    @staticmethod
    def _hash(key: bytes) -> int:
        return xxhash.xxh3_64_intdigest(key)

    def _slot(self, high: int, shift: int) -> int:
        # The multiplication mixes displacement and hash, so every displacement is a new try.
        return (((high ^ (shift * 0x9E3779B1)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> 20) % self.size

    def get(self, key: bytes) -> int | None:
        if not self.size:
            return None
        value = self._hash(key)
        shift = self.shift[value % self.buckets]
        slot = -1 - shift if shift < 0 else self._slot(value >> 32, shift)
        return self.values[slot] if self.keys[slot] == key else None


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merges: always the pair of lowest rank, the leftmost on ties.

    Parts are a linked list by their start: `end[i]` is where part i ends and the next begins,
    `before[i]` where the one before begins. A heap entry is stale unless both its parts still are as they were.
    """
    n = len(piece)
    rank = ranks.get
    end = list(range(1, n + 2))
    before = list(range(-1, n))
    heap = [
        (r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        middle = end[i]
        # Gone parts end at 0; the last part has no next one.
        if not 0 < middle < n or end[middle] != stop:
            continue
        end[middle] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
            last = end[stop]
            if (r := rank(piece[i:last])) is not None:
                push(heap, (r, i, last))
        left = before[i]
        if left >= 0 and (r := rank(piece[left:stop])) is not None:
            push(heap, (r, left, stop))
    ids, i = [], 0
    while i < n:
        stop = end[i]
        ids.append(ranks[piece[i:stop]])
        i = stop
    return ids


#: What a string encodes to: the decimal names of its ids, and the bytes they decode to. A plain
#: pair of atoms, which the garbage collector need not visit.
Entry = tuple[str, bytes]
_NAMES, _DATA = itemgetter(0), itemgetter(1)


class Memo:
    """Entries of strings seen lately: two generations of at most `limit` short strings each."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def recall(self, text: str) -> Entry | None:
        entry = self.young.get(text) or self.old.get(text)
        if entry is not None:
            self.young[text] = entry
        return entry

    def put(self, text: str, entry: Entry) -> None:
        self.young[text] = entry

    def age(self) -> None:
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young


class ByteBpe:
    """Encoder and decoder over one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        self.ranks = ranks
        self.hash = PerfectHash(ranks)
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.memo = Memo(memo)

    def __getstate__(self):
        return {**self.__dict__, "pattern": self.pattern.pattern, "memo": Memo(self.memo.limit)}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.pattern = regex.compile(state["pattern"])

    def piece(self, text: str) -> list[int]:
        """Ids of one pre-token."""
        data = text.encode("utf-8", "surrogatepass")
        found = self.hash.get(data)
        return [found] if found is not None else merge_bytes(data, self.ranks)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def _known(self, text: str, pieces: Callable[[str], list[str]]) -> Entry:
        entry = self.memo.recall(text)
        if entry is None:
            ids = [i for piece in pieces(text) for i in self.piece(piece)]
            entry = (" ".join(map(str, ids)), self.decode(ids))
            if len(text) <= 64:
                self.memo.put(text, entry)
        return entry

    def _chunk(self, chunk: str) -> Entry:
        """A chunk not among the young: as one word, as a word and marks, or by the pattern."""
        entry = self.memo.recall(chunk)
        if entry is not None:
            return entry
        if WORD.fullmatch(chunk):
            return self._known(chunk, lambda word: [word])
        word, marks = marks_apart(chunk)
        if not marks or not WORD.fullmatch(word):
            return self._known(chunk, self.pattern.findall)
        one, two = self._known(word, lambda piece: [piece]), self._known(marks, lambda piece: [piece])
        entry = (f"{one[0]} {two[0]}", one[1] + two[1])
        if len(chunk) <= 64:
            self.memo.put(chunk, entry)
        return entry

    def entries(self, text: str) -> Iterator[list[Entry]]:
        """The whole text as entries, in blocks."""
        if OTHER_SPACE.search(text):
            pieces = (match.group() for match in self.pattern.finditer(text))
            # The same string as a chunk of its own has the same ids: it is one pre-token.
            while block := [self._known(p, lambda piece: [piece]) for p in islice(pieces, PART)]:
                yield block
                self.memo.age()
            return
        for part in parts(text):
            chunks = CHUNK.findall(part)
            block = list(map(self.memo.young.get, chunks))
            if None in block:
                for i in [i for i, entry in enumerate(block) if entry is None]:
                    block[i] = self._chunk(chunks[i])
                self.memo.age()
            yield block

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text."""
        return [i for block in self.entries(text) for i in _ids(block)]


def _ids(block: list[Entry]) -> Iterator[int]:
    return map(int, " ".join(map(_NAMES, block)).split())


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False, memo: int = MEMO,
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (of decimal ids joined by a space), decoded_sha256.

    `with_ids` adds the ids as an array. Null counts as empty; an empty text has no tokens. Rows
    are worked on where they are read, repeated ones each; other columns of `docs` are not read.
    The rank file is read once by the driver (its size is the vocabulary's) and sent to the tasks.
    """
    coder = shipped(docs.sparkSession, ByteBpe(read_ranks(path), pattern, memo))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = arrived(coder)
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for text in batch.column(1):
                count, ids_hash, bytes_hash, kept = 0, hashlib.sha256(), hashlib.sha256(), []
                for block in bpe.entries(text.as_py()):
                    if block:
                        names = " ".join(map(_NAMES, block))
                        ids_hash.update((" " + names if count else names).encode())
                        bytes_hash.update(b"".join(map(_DATA, block)))
                        count += names.count(" ") + 1
                        if with_ids:
                            kept += _ids(block)
                for column, value in zip(
                    columns, (count, ids_hash.hexdigest(), bytes_hash.hexdigest(), kept), strict=True
                ):
                    column.append(value)
            arrays = [
                batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                pa.array(columns[2], pa.string()),
            ]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays.append(pa.array(columns[3], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
