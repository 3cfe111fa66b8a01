"""Exact dedup with radix tries.

Rows are dealt by length and content hash, so equal texts meet in one task and a task holds whole
strings only of its own share. A task inserts every byte string into a compressed radix (Patricia)
trie; the node where a string ends owns the smallest identifier, the number of rows and how many of
them carry that identifier. When the strings of a trie exceed a byte budget, its heaviest
subtree is moved to a local file, later strings for it are appended there, and it is worked off as
a trie of its own at the end.

Copies are merged within each Arrow batch before the shuffle, so a text that a third of all rows
share reaches its trie as one row per batch. Rows then get their owner by a join on the hash, in which
the rows of such a text are salted; their texts do not take part.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import whole, written
from tillwright.operators.joins import HOT_SHARE, salted_join

WHITE = r"[\x20\x09-\x0D]+"
#: Bytes of strings a task keeps in its trie before it moves subtrees to disk.
TRIE_BYTES = 96 * 2**20
#: What a node holds besides its label: itself, its children, its owner with key and hash.
NODE_BYTES = 700

_ROWS = "_n_bytes long, _sha string, _least long, _carriers long, _rows long"


class Owner:
    """Smallest identifier of a string (nulls last), rows that carry it, and rows in all."""

    __slots__ = ("key", "least", "carriers", "rows")

    def __init__(self, key, least, carriers, rows):
        self.key, self.least, self.carriers, self.rows = key, least, carriers, rows

    def merge(self, least, carriers, rows) -> None:
        self.rows += rows
        if least == self.least:
            self.carriers += carriers
        elif least is not None and (self.least is None or least < self.least):
            self.least, self.carriers = least, carriers


class _Node:
    __slots__ = ("label", "children", "owner", "weight")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.weight = label, {}, None, 0


class _Spilled:
    """A subtree on disk: strings (without the path above) and their owners, unmerged."""

    def __init__(self, folder: str):
        handle, self.path = tempfile.mkstemp(dir=folder, suffix=".subtree")
        self.file = os.fdopen(handle, "w+b")

    def add(self, rest: bytes, owner: Owner) -> None:
        least = "" if owner.least is None else str(owner.least)
        head = f"{len(rest)},{owner.key[0]},{owner.key[1]},{least},{owner.carriers},{owner.rows}\n"
        self.file.write(head.encode())
        self.file.write(rest)

    def entries(self) -> Iterator[tuple[bytes, Owner]]:
        self.file.seek(0)
        for head in iter(self.file.readline, b""):
            size, length, sha, least, carriers, rows = head[:-1].decode().split(",")
            yield (
                self.file.read(int(size)),
                Owner((int(length), sha), int(least) if least else None, int(carriers), int(rows)),
            )
        self.file.close()
        os.unlink(self.path)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving comparisons of slices."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class PatriciaTrie:
    """Byte strings with owners; at most about `budget` bytes of labels stay in memory."""

    def __init__(self, budget: int = TRIE_BYTES, folder: str | None = None):
        self.root, self.budget, self.folder, self.held, self.spilled = _Node(b""), budget, folder, 0, 0

    def add(self, text: bytes, owner: Owner) -> None:
        node, rest, path = self.root, text, [self.root]
        while True:
            if not rest:
                if node.owner is None:
                    node.owner = owner
                else:
                    node.owner.merge(owner.least, owner.carriers, owner.rows)
                return
            child = node.children.get(rest[0])
            if child is None:
                leaf = _Node(rest)
                leaf.owner = owner
                leaf.weight = len(rest) + NODE_BYTES
                node.children[rest[0]] = leaf
                self._grow(path, leaf.weight)
                return
            if isinstance(child, _Spilled):
                child.add(rest, owner)
                return
            size = _shared(child.label, rest)
            if size < len(child.label):
                upper = _Node(child.label[:size])
                upper.weight = child.weight
                child.label = child.label[size:]
                child.weight -= size
                upper.children[child.label[0]] = child
                node.children[rest[0]] = upper
                child = upper
            node, rest = child, rest[size:]
            path.append(node)

    def _grow(self, path: list[_Node], size: int) -> None:
        for node in path:
            node.weight += size
        self.held += size
        while self.held > self.budget and self._spill():
            pass

    def _spill(self) -> bool:
        """Moves the heaviest subtree below the first fork to a file; False if there is none."""
        path = [self.root]
        while True:
            live = [c for c in path[-1].children.values() if isinstance(c, _Node)]
            if len(live) == 1 and live[0].children:
                path.append(live[0])
            else:
                break
        if not live or len(path[-1].children) < 2:
            return False  # without a fork a subtree is all there is
        heavy = max(live, key=lambda c: c.weight)
        file = _Spilled(self.folder)
        first, weight = heavy.label[0], heavy.weight
        for rest, owner in _strings(heavy):
            file.add(rest, owner)
        path[-1].children[first] = file
        for node in path:
            node.weight -= weight
        self.held -= weight
        self.spilled += 1
        return True

    def owners(self) -> Iterator[Owner]:
        """All owners; subtrees on disk follow one at a time, split further where needed."""
        waiting, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node.owner is not None:
                yield node.owner
            for child in node.children.values():
                (waiting if isinstance(child, _Spilled) else stack).append(child)
        self.root = _Node(b"")
        for subtree in waiting:
            trie = PatriciaTrie(self.budget, self.folder)
            for rest, owner in subtree.entries():
                trie.add(rest, owner)
            yield from trie.owners()


def _strings(top: _Node) -> Iterator[tuple[bytes, Owner]]:
    """Strings below a node with their owners, and what lies on disk below it already."""
    stack = [(top, b"")]
    while stack:
        node, above = stack.pop()
        here = above + node.label
        if node.owner is not None:
            yield here, node.owner
        for child in node.children.values():
            if isinstance(child, _Spilled):
                for rest, owner in child.entries():
                    yield here + rest, owner
            else:
                stack.append((child, here))


def _merge_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal texts of a batch as one; texts are compared where they lie and never made strings."""
    for batch in batches:
        found: dict[tuple, list[tuple[int, Owner]]] = {}
        texts = batch.column(3).cast(pa.binary())
        heads = [batch.column(i).to_pylist() for i in range(3)]
        for place, (identity, length, sha) in enumerate(zip(*heads, strict=True)):
            alike = found.setdefault((length, sha), [])
            for first, owner in alike:
                if texts[first].as_buffer().equals(texts[place].as_buffer()):
                    owner.merge(identity, 1, 1)
                    break
            else:
                alike.append((place, Owner((length, sha), identity, 1, 1)))
        firsts = [one for alike in found.values() for one in alike]
        heads = _owner_batch([owner for _, owner in firsts])
        kept = batch.column(3).take(pa.array([place for place, _ in firsts], pa.int64()))
        yield pa.RecordBatch.from_arrays([*heads.columns, kept], names=[*heads.schema.names, "_text"])


def _owners(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            trie = PatriciaTrie(budget, folder)
            for batch in batches:
                texts = batch.column(5).cast(pa.binary())
                heads = [batch.column(i).to_pylist() for i in range(5)]
                for i, (length, sha, least, carriers, rows) in enumerate(zip(*heads, strict=True)):
                    trie.add(texts[i].as_py(), Owner((length, sha), least, carriers, rows))
            found = []
            for owner in trie.owners():
                found.append(owner)
                if len(found) == 10_000:
                    yield _owner_batch(found)
                    found = []
            if found:
                yield _owner_batch(found)

    return run


def _owner_batch(found: list[Owner]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([o.key[0] for o in found], pa.int64()),
        pa.array([o.key[1] for o in found], pa.string()),
        pa.array([o.least for o in found], pa.int64()),
        pa.array([o.carriers for o in found], pa.int64()),
        pa.array([o.rows for o in found], pa.int64()),
    ], names=["_n_bytes", "_sha", "_least", "_carriers", "_rows"])


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.regexp_replace(whole(text_col), WHITE, " ").alias("_text"),
    ).select(
        "_id", F.octet_length("_text").cast("long").alias("_n_bytes"),
        F.sha2("_text", 256).alias("_sha"), "_text",
    )


def text_owners(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """One narrow row per different text, written: `_n_bytes, _sha, _least, _carriers, _rows`."""
    merged = _prepared(docs, id_col, text_col).mapInArrow(_merge_batch, _ROWS + ", _text string")
    owners = merged.repartition("_n_bytes", "_sha").mapInArrow(_owners(trie_bytes), _ROWS)
    return written(owners, "text-owners")


def _hot(owners: DataFrame, rows: str, total: int) -> dict[str, float]:
    """Texts that hold a large share of the rows: 1 / HOT_SHARE at most."""
    held = owners.where(F.col(rows) >= max(2, HOT_SHARE * total)).select("_sha", rows).collect()
    return {r["_sha"]: r[rows] / total for r in held}


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after every run of white space (space, tab to carriage
    return) became one space; null counts as empty, so null and empty texts are one group. The row
    with the smallest id stays; a null id counts as larger than any other. Rows that repeat both
    id and text tie, and one of them stays. Other columns of `docs` are not read, whatever their
    names. An empty table gives an empty result. Rows of a text that a large share of all rows have are
    spread over many tasks when they get their owner.
    """
    owners = text_owners(docs, id_col, text_col, trie_bytes)
    rows = _prepared(docs, id_col, text_col).drop("_text")
    total = owners.agg(F.sum("_rows")).first()[0] or 0
    hot = _hot(owners, "_rows", total)
    joined = salted_join(rows, owners.drop("_n_bytes"), "_sha", "left", hot)
    owner = F.col("_id").eqNullSafe(F.col("_least"))
    if owners.where("_carriers > 1").isEmpty():
        marked = joined.withColumn("kept", owner)
    else:  # of rows that repeat the id of their owner the first by place stays, the others do not
        tied = owner & (F.col("_carriers") > 1)
        placed = written(joined.where(tied).withColumn("_place", F.monotonically_increasing_id()), "tied-rows")
        first = placed.groupBy("_sha").agg(F.min("_place").alias("_first"))
        chosen = salted_join(placed, first, "_sha", "left", _hot(owners, "_carriers", total))
        marked = joined.where(~tied).withColumn("kept", owner).unionByName(
            chosen.withColumn("kept", F.col("_place") == F.col("_first")).drop("_place", "_first")
        )
    return marked.select(
        F.col("_id").alias(id_col), F.col("_least").alias("keep_id"),
        F.col("_rows").alias("group_size"), "kept", F.col("_sha").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """The rows of `docs` that :func:`exact_dedup` keeps, with all their columns, whatever their names.

    Null texts are empty ones, texts of any length are compared whole, and one of several rows that share
    id and text stays. An empty table stays empty.
    """
    owners = text_owners(docs, id_col, text_col, trie_bytes)
    sha = F.sha2(F.regexp_replace(whole(text_col), WHITE, " "), 256)
    keyed = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"), sha.alias("_sha"))
    own = owners.select(F.col("_least").alias("_owner_id"), F.col("_sha").alias("_owner_sha"))
    same = (F.col("_sha") == F.col("_owner_sha")) & F.col("_id").eqNullSafe(F.col("_owner_id"))
    stay = keyed.join(own, same, "left_semi")
    if not owners.where("_carriers > 1").isEmpty():
        stay = stay.dropDuplicates(["_id", "_sha"])
    return stay.select("_row.*")
