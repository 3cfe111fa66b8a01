"""Prefix trie over conversations, with what its shared prefixes save.

A prefix has a digest: the exclusive or of a hash of each (place, turn) pair in it, 120 bits. So prefixes
grow by one operation a turn, and pieces of a long conversation can be worked on apart. Texts are hashed
where they are read and never move.

A count-min sketch over all prefix digests screens them. An estimate of one proves that no other
conversation has the prefix: its node, and every one below, is emitted from the row at hand. Only
prefixes that may be shared are grouped exactly. The sketch has a bounded size; where it is too full to
prove much, more is grouped and nothing is lost.

A node is told by its smallest member and its depth. The members of a child are members of its
parent, so along a conversation the smallest member only grows, and the conversation itself is it from some
depth on. Sums over subtrees therefore become sums over members: each node's own share is booked on the
conversation that is its smallest member, and summed from the end of that conversation up.

Nothing needs a conversation or a node in one task: turns are numbered by ranges of (conversation, turn),
running values go by blocks of `BLOCK` depths, groups combine before the shuffle, rows of hot nodes and hot
conversations are salted when they get the values of their group, and the ids that end in a node travel
as sorted runs of text that one task hashes as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import arrived, shipped, whole, written
from tillwright.operators.joins import HOT_SHARE, attach, fits_broadcast, hot_keys, salted_join

#: Depths whose running values one window works out.
BLOCK = 1024
#: Rows of the sketch, and the most cells in a row, a power of two. Tasks hold a byte for each cell
#: while they count; a bit for each is broadcast: 8 MB at most.
SKETCH_ROWS = 4
MAX_CELL_BITS = 24
#: Cells sent together.
CELL_BLOCK = 1 << 14
#: Bytes of ids in one run on their way to the hash of a node's ends.
RUN_BYTES = 1 << 16

_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NODE_SCHEMA = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in _NODE)


class Conversations(NamedTuple):
    """`convs`: conv_id, len. `turns`: conv_id, depth (1 to len, no gaps), len, digest, n_bytes."""

    convs: DataFrame
    turns: DataFrame


def numbered(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """conv_id, depth (1, 2, ... in the order of turns, null first), digest, n_bytes of every turn.

    Null roles and texts count as empty; texts are hashed whole. Turns of equal number go by their digest.
    Rows that repeat all of it are turns of their own. Rows without a conversation's id are in none. Other
    columns are not read.
    """
    role, text = whole(role_col), whole(text_col)
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.substring(told, 1, 32).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"),  # parts rows that are alike
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest"), F.asc("row")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = written(sorted_rows.mapInArrow(_count_up, "task int, conv_id long, digest string, n_bytes long, depth long"), "turns")
    earlier = _earlier(local)
    if not earlier:
        return local.drop("task")
    before = local.sparkSession.createDataFrame(earlier, "task int, conv_id long, before long")
    return local.join(F.broadcast(before), ["task", "conv_id"], "left").select(
        "conv_id", "digest", "n_bytes", (F.col("depth") + F.coalesce("before", F.lit(0))).alias("depth")
    )


def _count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the sorted rows of each conversation within the task."""
    task, current, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        place = np.arange(len(ids)) - np.repeat(first, np.diff(np.r_[first, len(ids)])) + 1
        if ids[0] == current:
            place[: first[1] if len(first) > 1 else len(ids)] += count
        current, count = ids[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), task, np.int32)), batch.column("conv_id"), batch.column("digest"),
             batch.column("n_bytes"), pa.array(place, pa.int64())],
            names=["task", "conv_id", "digest", "n_bytes", "depth"],
        )


def _earlier(local: DataFrame) -> list[tuple[int, int, int]]:
    """For conversations that go on from one task to the next: the turns that earlier tasks hold.

    One row per task reaches the driver.
    """
    edges = local.groupBy("task").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last")
    )
    # Only the last conversation of a task can go on, and its rows there are the last ones.
    ends = local.join(F.broadcast(edges), "task").where("conv_id = last").groupBy("task", "first", "last").agg(
        F.max("depth").alias("n")
    )
    found, last, carried = [], None, 0
    for row in sorted(ends.collect()):
        before = carried if row["first"] == last else 0
        if before:
            found.append((row["task"], row["first"], before))
        last, carried = row["last"], row["n"] + (before if row["first"] == row["last"] else 0)
    return found


def plain(turns: DataFrame) -> Conversations:
    """Conversations as they are."""
    convs = written(turns.groupBy("conv_id").agg(F.max("depth").alias("len")), "lengths")
    return Conversations(convs, attach(turns, convs, "conv_id", "inner"))


def regrown(turns: DataFrame, family: int = 5, most: int = 9) -> Conversations:
    """Every conversation c rebuilt: the first h turns of conversation c - c % family, then its own
    turns after its first h, with h the CRC-32 of its decimal id modulo `most`.

    A base that is not there gives none. A conversation may end up without turns.
    """

    def h(conv: Column) -> Column:
        return F.crc32(conv.cast("string").cast("binary")) % most

    counts = written(turns.groupBy("conv_id").agg(F.max("depth").alias("n")), "counts")
    conv = F.col("conv_id")
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = written(
        counts.withColumn("base", conv - conv % family).join(bases, "base", "left")
        .withColumn("m", F.least(h(conv), F.coalesce("n_base", F.lit(0))))
        .select("conv_id", "base", "m", (F.col("m") + F.greatest(F.col("n") - h(conv), F.lit(0))).alias("len")),
        "conversations",
    )
    own = attach(turns.where(F.col("depth") > h(conv)), convs.select("conv_id", "m", "len"), "conv_id", "inner").select(
        "conv_id", (F.col("depth") - h(conv) + F.col("m")).alias("depth"), "len", "digest", "n_bytes"
    )
    heads = turns.where((conv % family == 0) & (F.col("depth") < most)).withColumnRenamed("conv_id", "base")
    borrowed = heads.join(convs, "base").where(F.col("depth") <= F.col("m")).select(
        "conv_id", "depth", "len", "digest", "n_bytes"
    )
    return Conversations(convs.select("conv_id", "len"), own.unionByName(borrowed))


def trie(conversations: Conversations, max_cell_bits: int = MAX_CELL_BITS, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; null for
    the root), n_convs (members), n_children, n_leaves (childless nodes in the subtree), saved_tokens (sum over
    the subtree of (n_convs - 1) times the bytes of a node's last text), ends_sha256 (of the decimal ids
    of members that end here, ascending, joined by commas).

    The root has depth 0 and all conversations, also those without turns. No conversation gives no
    row. Equal conversations share all their nodes.
    """
    convs = conversations.convs
    size = convs.agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("len").alias("deepest"), F.sum("len").alias("prefixes"),
        F.sum((F.col("len") == 0).cast("long")).alias("ends"),
    ).first()
    if not size["n"]:
        return convs.sparkSession.createDataFrame([], _NODE_SCHEMA)
    paths = _paths(conversations.turns, size["deepest"], block)
    bits = min(max_cell_bits, max(10, (4 * size["prefixes"]).bit_length()))
    screened = _screen(paths, bits)

    tails = screened.where("alone and alone_above").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *_single()
    )
    member = _members(screened.where("not alone"), convs, size)
    info = written(
        member.groupBy("conv_id").agg(
            # Depth and smallest member of the deepest node that has a smaller member than this one.
            F.coalesce(F.max(F.when(F.col("rep") != F.col("conv_id"), F.col("depth"))), F.lit(-1)).alias("q"),
            F.max(F.when(F.col("rep") != F.col("conv_id"), F.col("rep"))).alias("above"),
            # Whether it stands for a leaf; where it ends outside the shared part, it does.
            F.coalesce(
                F.max(F.when(F.col("depth") == F.col("len"), ((F.col("rep") == F.col("conv_id")) & ~F.col("kids")).cast("long"))),
                F.lit(1),
            ).alias("leaf"),
        ),
        "standing",
    )
    parent = F.when(F.col("depth") - 1 > F.col("q"), F.col("conv_id")).otherwise(F.col("above"))
    borders = screened.where("alone and not alone_above").join(info, "conv_id").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), *_single()
    )
    hot = {} if fits_broadcast(info) else hot_keys(member, ["conv_id"])["conv_id"]
    member = attach(_sums_below(member, size["deepest"], block), info, "conv_id", "inner", hot=hot)
    nodes = member.groupBy("node", "depth").agg(
        F.min("rep").alias("conv_id"),
        F.max(F.when(F.col("rep") == F.col("conv_id"), parent)).alias("parent_conv_id"),
        F.max("n").alias("n_convs"),
        F.sum(((F.col("q") <= F.col("depth")) & (F.col("depth") < F.col("len"))).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum("below").alias("saved_tokens"),
        F.max("ends").alias("ends"),
        F.min(F.when(F.col("depth") == F.col("len"), F.col("conv_id"))).alias("ender"),
    )
    hashes = _ends(member.where("depth = len and ends > 1").select("node", "conv_id"))
    shared = nodes.join(hashes, "node", "left").select(
        *_NODE[:-1],
        F.coalesce("ends_sha256", F.sha2(F.coalesce(F.col("ender").cast("string"), F.lit("")), 256)).alias("ends_sha256"),
    )
    return shared.unionByName(tails).unionByName(borders).select(*_NODE)


def _single() -> list[Column]:
    """The values of a node with one member, from that member's row."""
    inner = F.col("depth") < F.col("len")
    return [
        F.lit(1).cast("long").alias("n_convs"), inner.cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.sha2(F.when(inner, F.lit("")).otherwise(F.col("conv_id").cast("string")), 256).alias("ends_sha256"),
    ]


def _paths(turns: DataFrame, deepest: int, block: int) -> DataFrame:
    """conv_id, depth, len, n_bytes, a, b (prefix digest), above_a, above_b (that of the prefix before)."""
    own = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")), 256)
    rows = turns.select(
        "conv_id", "depth", "len", "n_bytes", F.floor((F.col("depth") - 1) / block).alias("block"),
        *[F.conv(F.substring(own, at, 15), 16, 10).cast("long").alias(name) for name, at in (("own_a", 1), ("own_b", 16))],
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select("*", F.bit_xor("own_a").over(so_far).alias("a"), F.bit_xor("own_b").over(so_far).alias("b"))
    if deepest > block:
        running = written(running, "blocks")
        # The last row of a full block holds the block's value.
        full = running.where(F.col("depth") % block == 0).select("conv_id", (F.col("block") + 1).alias("block"), "a", "b")
        blocks = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
        carried = full.select(
            "conv_id", "block", F.bit_xor("a").over(blocks).alias("carried_a"), F.bit_xor("b").over(blocks).alias("carried_b")
        )
        later = running.where("block > 0").join(carried, ["conv_id", "block"]).withColumns(
            {lane: F.col(lane).bitwiseXOR(F.col(f"carried_{lane}")) for lane in ("a", "b")}
        )
        running = running.where("block = 0").unionByName(later.select(*running.columns))
    above = [F.col(lane).bitwiseXOR(F.col(f"own_{lane}")).alias(f"above_{lane}") for lane in ("a", "b")]
    return written(running.select("conv_id", "depth", "len", "n_bytes", "a", "b", *above), "paths")


def cells(a: np.ndarray, b: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each digest in every row of the sketch: other bits of it for each."""
    mask = (1 << bits) - 1
    return [a & mask, a >> 30 & mask, b & mask, b >> 30 & mask][:SKETCH_ROWS]


def _screen(paths: DataFrame, bits: int) -> DataFrame:
    """`paths` with alone and alone_above: whether the sketch proves that the prefix, and the one before
    it, has one conversation. The root is never alone here."""
    size = min(CELL_BLOCK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((SKETCH_ROWS, 1 << bits), np.uint8)  # 2 stands for more than one
        for batch in batches:
            for row, cell in zip(sketch, cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits), strict=True):
                hit, times = np.unique(cell, return_counts=True)
                row[hit] = np.minimum(row[hit] + times, 2)
        blocks = sketch.reshape(-1, size)
        for at in range(0, len(blocks), 64):
            used = at + np.flatnonzero(blocks[at : at + 64].any(axis=1))
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array([blocks[i].tobytes() for i in used], pa.binary())], names=["block", "cells"]
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(size, np.uint8)

        def closed() -> pa.RecordBatch:
            bitmap = np.packbits(total > 1).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([bitmap], pa.binary())], names=["block", "again"])

        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if number != current:
                    if current is not None:
                        yield closed()
                    current, total = number, np.zeros(size, np.uint8)
                total = np.minimum(total + np.frombuffer(data.as_buffer(), np.uint8), 2)
        if current is not None:
            yield closed()

    counted = paths.select("a", "b").mapInArrow(count, "block long, cells binary")
    merged = counted.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, again binary")
    again = np.zeros(SKETCH_ROWS << bits, np.uint8).reshape(-1, size)
    for row in merged.toLocalIterator():
        again[row["block"]] = np.unpackbits(np.frombuffer(row["again"], np.uint8), count=size)
    sketch = shipped(paths.sparkSession, np.packbits(again.reshape(SKETCH_ROWS, -1), axis=1))

    def alone(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rows = zip(arrived(sketch), cells(a, b, bits), strict=True)
        return np.logical_or.reduce([row[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1 == 0 for row, cell in rows])

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lanes = [batch.column(name).to_numpy() for name in ("a", "b", "above_a", "above_b")]
            below_root = batch.column("depth").to_numpy() > 1
            flags = [pa.array(alone(*lanes[:2])), pa.array(alone(*lanes[2:]) & below_root)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], *flags], names=[*batch.schema.names[:6], "alone", "alone_above"])

    return paths.mapInArrow(
        flag, "conv_id long, depth long, len long, n_bytes long, a long, b long, alone boolean, alone_above boolean"
    )


def _members(candidates: DataFrame, convs: DataFrame, size) -> DataFrame:
    """A row per conversation and node that may be shared, the root included, with the node's values:
    rep (smallest member), n, kids (whether it has children), ends (members that end there), and w, what the
    node itself saves, on the row of its smallest member."""
    rows = written(
        candidates.select("conv_id", "depth", "len", "n_bytes", F.concat_ws(".", "a", "b").alias("node")), "candidates"
    )
    nodes = written(
        rows.groupBy("node").agg(
            F.min("conv_id").alias("rep"), F.count("*").alias("n"), F.max(F.col("len") > F.col("depth")).alias("kids"),
            F.sum((F.col("len") == F.col("depth")).cast("long")).alias("ends"),
        ),
        "nodes",
    )
    total = rows.count()
    # At most 1 / HOT_SHARE nodes can hold that share of the rows.
    hot = {r["node"]: r["n"] / total for r in nodes.where(F.col("n") >= max(2, HOT_SHARE * total)).select("node", "n").collect()}
    columns = ["conv_id", "depth", "len", "node", "rep", "n", "kids", "ends", "w"]
    own = F.when(F.col("rep") == F.col("conv_id"), (F.col("n") - 1) * F.col("n_bytes")).otherwise(F.lit(0))
    below = salted_join(rows, nodes, "node", "inner", hot).withColumn("w", own).select(*columns)
    root = convs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), "len", F.lit("").alias("node"), F.lit(size["least"]).cast("long").alias("rep"),
        F.lit(size["n"]).cast("long").alias("n"), F.lit(size["deepest"] > 0).alias("kids"),
        F.lit(size["ends"]).cast("long").alias("ends"), F.lit(0).cast("long").alias("w"),
    )
    return written(below.unionByName(root), "members")


def _sums_below(member: DataFrame, deepest: int, block: int) -> DataFrame:
    """`member` with below: the sum of w over this depth and all deeper ones of the conversation."""
    rows = member.withColumn("block", F.floor(F.col("depth") / block))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("below", F.sum("w").over(inside))
    if deepest < block:
        return rows.drop("block")
    totals = member.withColumn("block", F.floor(F.col("depth") / block)).groupBy("conv_id", "block").agg(F.sum("w").alias("total"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "block", F.coalesce(F.sum("total").over(deeper), F.lit(0)).alias("carried"))
    return rows.join(carried, ["conv_id", "block"]).withColumn("below", F.col("below") + F.col("carried")).drop("block", "carried")


def _ends(rows: DataFrame) -> DataFrame:
    """node, ends_sha256 of `rows` (node, conv_id): ids in ascending order, comma-joined."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, current = [], 0, None

        def run() -> pa.RecordBatch:
            columns = [pa.array([current]), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])]
            return pa.RecordBatch.from_arrays(columns, names=["node", "first", "ids"])

        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (node != current or size > RUN_BYTES):
                    yield run()
                    held, size = [], 0
                current = node
                held.append(conv)
                size += 21
        if held:
            yield run()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if node != current:
                    if digest is not None:
                        yield closed()
                    current, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest is not None:
            yield closed()

    runs = rows.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        joined, "node string, first long, ids string"
    )
    return runs.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node string, ends_sha256 string")
