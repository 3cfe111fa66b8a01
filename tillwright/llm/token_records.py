"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is framed so that a reader can walk a file, check it and cut out any part of it:

    length of the payload   8 bytes
    masked checksum of those 8 bytes   4 bytes
    payload
    masked checksum of the payload   4 bytes
    newline   1 byte

All numbers are little-endian. The checksum is CRC-32, rotated right by 15 bits plus a constant, so
that a checksum stored inside checked data does not check itself. A payload is one byte that says
whether there is a document id, the id (8 bytes), the width of a token id in bytes (1 byte: 2, or 4
for vocabularies beyond 65,536), and the ids.

Documents are dealt by ranges of their id and sorted within, and each task writes one file through
Spark's own file writer, whose commit drops what lost attempts wrote. Files stay near `FILE_BYTES`
of input, since a file is read back as one row. The index is a Parquet table beside them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.chunks import OTHER_SPACE, PART, WORD, chunks, marks_apart, parts
from tillwright.llm.common import arrived, shipped, whole
from tillwright.operators.joins import scanned_bytes as stored_bytes

#: The mask of the checksums and the id that ends a document.
MASK_DELTA = 0xA282EAD8
END_ID = 2
#: Bytes of input, as far as it is stored, that go to one file.
FILE_BYTES = 20 * 2**20
#: Chunks in each of the two generations that a task remembers with their ids.
MEMO = 600_000

def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies spell a byte as itself where that is printable Latin-1, else as the next
    character from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + n for n, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
SPACE_LETTER = chr(BYTE_LETTERS[32])

_INDEX = (
    "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, "
    "before long"
)


def masked(data: bytes) -> int:
    value = zlib.crc32(data)
    return ((value >> 15 | value << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without its newline, which the writer adds."""
    length = len(payload).to_bytes(8, "little")
    return b"".join(
        (length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little"))
    )


def unframe(data: bytes | memoryview, offset: int = 0) -> tuple[memoryview, int]:
    """The payload at `offset` and where the next record begins; damage is an error."""
    view = memoryview(data)
    head = bytes(view[offset : offset + 8])
    length = int.from_bytes(head, "little")
    if len(head) < 8 or masked(head) != int.from_bytes(view[offset + 8 : offset + 12], "little"):
        raise ValueError(f"damaged length of the record at byte {offset}")
    payload = view[offset + 12 : offset + 12 + length]
    end = offset + 12 + length + 4
    check = int.from_bytes(view[end - 4 : end], "little")
    if len(payload) < length or masked(payload) != check or bytes(view[end : end + 1]) != b"\n":
        raise ValueError(f"damaged record at byte {offset}")
    return payload, end + 1


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    known = doc_id is not None
    return bytes([known]) + (doc_id or 0).to_bytes(8, "little", signed=True) + bytes([width]) + ids


def unpack(payload: memoryview) -> tuple[int | None, np.ndarray]:
    doc_id = int.from_bytes(payload[1:9], "little", signed=True) if payload[0] else None
    return doc_id, np.frombuffer(payload, "<u2" if payload[9] == 2 else "<u4", offset=10)


class Encoder:
    """Texts to the bytes of their ids, by the tokenizers library; remembers chunks.

    A word of letters is one pre-token, so it goes straight to the library's model; any other chunk not
    seen lately goes through all of the library's steps. A text that holds the string of an added token goes
    to the library whole.
    """

    def __init__(self, file: str, memo: int = MEMO):
        self.file, self.limit, self.library = file, memo, None

    def __getstate__(self):
        return {"file": self.file, "limit": self.limit, "library": None}

    def _load(self) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(self.file)
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.width = 2 if max(vocabulary.values(), default=0) < 1 << 16 else 4
        self.kind = "<u2" if self.width == 2 else "<u4"
        self.codes = [
            number.to_bytes(self.width, "little") for number in range(max(vocabulary.values(), default=0) + 1)
        ]
        self.tokenize = self.library.model.tokenize
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [
            np.array(e.ids, self.kind)
            for e in self.library.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.library is None:
            self._load()
        out: list[bytes] = []
        for text in texts:
            if OTHER_SPACE.search(text) or any(token in text for token in self.added):
                out.append(self._ids([text])[0].tobytes())
            else:
                out.append(b"".join(self._part(part) for part in parts(text)))
        return out

    def _part(self, text: str) -> bytes:
        cut = chunks(text)
        ids = list(map(self.memo.get, cut))
        if None in ids:
            unknown = [i for i, own in enumerate(ids) if own is None]
            self._recall({cut[i] for i in unknown})
            for i in unknown:
                ids[i] = self.memo[cut[i]]
            if len(self.memo) > self.limit:
                self.memo, self.older = {}, self.memo
        return b"".join(ids)

    def _recall(self, unknown: set[str]) -> None:
        """Brings chunks to memory: from the older generation, by their parts, or by the library.

        A word with a newline before it or marks behind it is the newline, the word and the marks.
        """
        memo, older, missing, divided = self.memo, self.older, set(), []
        for chunk in unknown:
            ids = older.get(chunk)
            if ids is not None:
                memo[chunk] = ids
                continue
            word, marks = marks_apart(chunk)
            own = [marks] if marks else []
            if word[0] == "\n" and word[1:2].isalpha():
                own = ["\n", word[1:], *own]
            elif own:
                own = [word, *own]
            else:
                missing.add(chunk)
                continue
            divided.append((chunk, own))
            for part in own:
                if part not in memo:
                    if part in older:
                        memo[part] = older[part]
                    else:
                        missing.add(part)
        if missing:
            self._learn(list(missing))
        for chunk, own in divided:
            memo[chunk] = b"".join([memo[part] for part in own])

    def _learn(self, missing: list[str]) -> None:
        codes, others = self.codes, []
        for chunk in missing:
            if WORD.fullmatch(chunk):
                if chunk.isascii():
                    letters = chunk.replace(" ", SPACE_LETTER)
                else:
                    letters = chunk.encode().decode("latin-1").translate(BYTE_LETTERS)
                self.memo[chunk] = b"".join([codes[t.id] for t in self.tokenize(letters)])
            else:
                others.append(chunk)
        for chunk, own in zip(others, self._ids(others), strict=True):
            self.memo[chunk] = own.tobytes()


def write_records(
    docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, file_bytes: int = FILE_BYTES,
) -> None:
    """Writes every document's ids and `end_id` to files below `path`, in ascending id order.

    Null texts count as empty and give a record of the end id alone. Rows without an id come
    first; rows that repeat an id each get a record. An empty table gives no record. Other columns
    are not read. `tokenizer` is a file of the tokenizers library, read by the driver.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), whole(text_col).alias("_text"))
    size = stored_bytes(docs)
    if size is None or size >= 1 << 60:  # Spark's word for a size it cannot tell
        size = rows.agg(F.sum(F.octet_length("_text").cast("long") + 64)).first()[0] or 0
    # The hash spreads rows without an id; it never parts the order of different ids.
    rows = rows.withColumn("_spread", F.xxhash64("_text"))
    dealt = rows.repartitionByRange(
        max(1, -(-size // file_bytes)), F.asc_nulls_first("_id"), "_spread"
    ).sortWithinPartitions(F.asc_nulls_first("_id"), "_spread").select("_id", "_text")
    with open(tokenizer, encoding="utf-8") as file:
        encoder = shipped(docs.sparkSession, Encoder(file.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = arrived(encoder)
        for batch in batches:
            at, total = 0, batch.num_rows
            while at < total:
                ids, texts, held = [], [], 0
                while at < total and held < PART:
                    ids.append(batch.column(0)[at].as_py())
                    texts.append(batch.column(1)[at].as_py())
                    held += len(texts[-1])
                    at += 1
                frames = [
                    frame(pack(i, data + end_id.to_bytes(coder.width, "little"), coder.width))
                    for i, data in zip(ids, coder.encode(texts), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    framed = dealt.mapInArrow(run, "frame binary")
    # The cast keeps the bytes as they are; the text writer appends a newline to each.
    framed.select(F.col("frame").cast("string")).write.text(f"{path}/records")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1), strict=True):
            data = memoryview(content.as_buffer())
            rows, offset, before = [], 0, 0
            while offset < len(data):
                payload, end = unframe(data, offset)
                doc_id, ids = unpack(payload)
                check = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((offset, end - offset, doc_id, len(ids), check, before))
                offset, before = end, before + len(ids)
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(rows), pa.string())]
                    + [pa.array(c, pa.int64()) for c in columns],
                    names=["file", "offset", "length", "doc_id", "n_tokens", "ids_crc32", "before"],
                )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/records").select("path", "content")


def write_index(spark: SparkSession, path: str) -> None:
    """Walks the files of :func:`write_records`, checks every record and writes where it lies."""
    found = _files(spark, path).mapInArrow(_scan, _INDEX)
    found.write.option("compression", "zstd").parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per record: doc_id, start (ids of all records before it), n_tokens, ids_crc32, file,
    offset, length.

    Only one row per file goes through the running total over files.
    """
    index = spark.read.schema(_INDEX).parquet(f"{path}/index")
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        index.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
        .withColumn("number", number)
        .select("file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))
    )
    return index.join(files, "file").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
        "file", "offset", "length",
    )


def read_shuffled(spark: SparkSession, path: str, seed: int = 0, share: float = 1.0) -> DataFrame:
    """doc_id and ids of a `share` of the records, in an order that depends on `seed` alone.

    The index names the records; each is cut out of its file by offset and length.
    """
    key = F.xxhash64(F.lit(seed), F.regexp_extract("file", r"part-(\d+)", 1), "offset")
    chosen = spark.read.schema(_INDEX).parquet(f"{path}/index").withColumn("order", key).where(
        (F.shiftrightunsigned("order", 11) / float(1 << 53)) < share
    )
    spans = chosen.groupBy("file").agg(F.collect_list(F.struct("order", "offset", "length")).alias("spans"))
    cut = (
        _files(spark, path).join(spans, F.col("path") == F.col("file"))
        .select("content", F.explode("spans").alias("span"))
        .select("span.order", F.expr("substring(content, span.offset + 1, span.length)").alias("record"))
        .orderBy("order")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [unpack(unframe(record.as_buffer())[0]) for record in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                pa.array([doc_id for doc_id, _ in read], pa.int64()),
                pa.array([ids.tolist() for _, ids in read], pa.list_(pa.int64())),
            ], names=["doc_id", "ids"])

    return cut.mapInArrow(run, "doc_id long, ids array<long>")
