"""Packs tokenized documents into sequences of bounded length by the sum-of-squares rule.

A piece goes to the open sequence whose choice leaves the sum of squared counts of open sequences per
residual gap smallest, so that gaps of many sizes stay open for what follows. Pieces come longest first,
and a sequence is opened only where no open one has room: on the document lengths at hand this needs one
or no sequence more than the tokens must have, the rule in any order without it two in a hundred.

Pieces are dealt evenly to tasks of bounded size, whatever their lengths or documents. Each task packs its
own; sequences with more than a little room are then opened up and their pieces packed again by fewer
tasks, until one task holds what is left. Every round is a written table, and a task sorts its pieces, so
that a lost executor changes nothing. Only a few numbers of each piece move, never its ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.chunks import PART
from tillwright.llm.common import arrived, shipped, whole, written
from tillwright.llm.token_records import Encoder

ROOM = 2048
END_ID = 0
#: Pieces that one task packs.
TASK_PIECES = 1 << 16
#: Sequences with a larger share of room than this are opened up again.
SLACK = 1 / 64

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_BITS_TASK, _BITS_ROUND = 22, 54


def cuts(length: int, room: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: only the first may be shorter than `room`."""
    first = length % room or min(length, room)
    return [(0, first)] + [(start, room) for start in range(first, length, room)]


def cut_documents(
    docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its text's ids and `end_id`; null texts count as empty and give a piece of one id.
    Texts of any length are taken whole. Rows without an id, and rows that repeat an id, are documents
    of their own. An empty table gives no piece. Other columns are not read. `tokenizer` is a file of the
    tokenizers library, read by the driver.
    """
    with open(tokenizer, encoding="utf-8") as file:
        encoder = shipped(docs.sparkSession, Encoder(file.read()))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def pieces(key: int | None, ids: np.ndarray) -> Iterator[tuple]:
        for number, (start, length) in enumerate(cuts(len(ids), room)):
            own = ids[start : start + length]
            yield (key, number, start, length, zlib.crc32(own.tobytes()), *([own] if with_ids else ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = arrived(encoder)
        for batch in batches:
            at, total = 0, batch.num_rows
            while at < total:
                keys, texts, held = [], [], 0
                while at < total and held < PART:
                    keys.append(batch.column(0)[at].as_py())
                    texts.append(batch.column(1)[at].as_py())
                    held += len(texts[-1])
                    at += 1
                rows = []
                for key, data in zip(keys, coder.encode(texts), strict=True):
                    ids = np.append(np.frombuffer(data, coder.kind), end_id).astype("<u4")
                    rows.extend(pieces(key, ids))
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=names)

    read = docs.select(F.col(id_col).cast("long"), whole(text_col))
    return read.mapInArrow(run, _PIECE + ", ids array<int>" * with_ids)


def pack_lengths(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece in the order given, and the room left in each sequence."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    count = np.zeros(room + 1, np.int64)  # open sequences per gap; none has a gap of 0
    standing: list[list[int]] = [[] for _ in range(room + 1)]
    left: list[int] = []
    for at, length in enumerate(lengths.tolist()):
        # Halved change of the sum, for each gap from `length` on; a sequence filled up leaves one square less.
        change = count[: room - length] - count[length:room] + 1.0
        if length < room:
            change[0] = 0.5 - count[length]
            change[count[length:room] == 0] = np.inf
        best = int(change.argmin()) if length < room else -1
        if best >= 0 and change[best] < np.inf:
            gap = length + best
            count[gap] -= 1
            chosen = standing[gap].pop()
        else:
            gap, chosen = room, len(left)
            left.append(room)
        bins[at], offsets[at] = chosen, room - gap
        left[chosen] = gap = gap - length
        if gap:
            count[gap] += 1
            standing[gap].append(chosen)
    return bins, offsets, np.array(left, np.int64)


def pack(pieces: DataFrame, room: int = ROOM, task_pieces: int = TASK_PIECES, slack: float = SLACK) -> DataFrame:
    """`pieces` with sequence_id and offset; they fill each sequence from 0 without a gap or overlap.

    `pieces` has a column `length` of 1 to `room`, and columns that tell its rows apart; rows that are alike in
    all columns may change places. Null or longer lengths are an error. Sequence ids are any numbers.
    An empty table gives an empty one.
    """
    rows, done, level = written(pieces, "pieces"), [], 0
    count = rows.count()
    while True:
        tasks = max(1, -(-count // task_pieces))
        packed = written(_packed(rows, room, tasks, level), "packed")
        loose = F.col("_gap") > slack * room
        left = 0 if tasks == 1 else packed.where(loose).count()
        if tasks == 1 or left > count / 2:  # lengths that leave room everywhere gain nothing by another round
            done.append(packed)
            break
        done.append(packed.where(~loose))
        rows, count, level = packed.where(loose).select(*pieces.columns), left, level + 1
    result = done[0]
    for further in done[1:]:
        result = result.unionByName(further)
    return result.drop("_gap")


def _packed(rows: DataFrame, room: int, tasks: int, level: int) -> DataFrame:
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in ("sequence_id", "offset", "_gap"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = table["length"]
        if lengths.null_count or pc.max(lengths).as_py() > room or pc.min(lengths).as_py() < 1:
            raise ValueError(f"a piece has no length from 1 to {room}")
        keys = [("length", "descending")] + [(c, "ascending") for c in table.column_names if c != "length"]
        table = table.sort_by(keys)
        bins, offsets, left = pack_lengths(table["length"].to_numpy(), room)
        first = (level << _BITS_ROUND) + (TaskContext.get().partitionId() << _BITS_TASK)
        for name, values in (("sequence_id", first + bins), ("offset", offsets), ("_gap", left[bins])):
            table = table.append_column(name, pa.array(values, pa.int64()))
        yield from table.combine_chunks().to_batches(max_chunksize=1 << 14)

    return rows.repartition(tasks).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID, **columns: str) -> DataFrame:
    """The pieces of :func:`cut_documents`, each with its sequence_id and offset."""
    return pack(cut_documents(docs, tokenizer, room, end_id, **columns), room)


def sequences(docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID, **columns: str) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (at most `room`), offsets (where pieces begin).

    The ids are written once; only placements are packed, and each piece's ids then go to its sequence.
    Documents alike in id and text are told apart by their place in the written table.
    """
    pieces = written(cut_documents(docs, tokenizer, room, end_id, with_ids=True, **columns), "piece-ids")
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    placed = pack(pieces.select(*place, "length"), room)
    rows = pieces.select(*place, "ids").join(placed, ["file", "row"])
    return rows.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    ).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("offsets")
    )
