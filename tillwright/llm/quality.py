"""Quality classifier by attention over passages.

A document is a bag of passages of `PASSAGE` bytes. Every passage is encoded from its bytes: how often
each kind of byte follows each other kind, how words repeat, how lines repeat, how long words
are. From document labels alone a small network learns an encoding of the passages, gated attention
weights over them, and a logistic score of the weighted passage representation:

    h = tanh(E f + e)        a = softmax over passages of w . (tanh(V h) * sigmoid(U h))
    score = sigmoid(c . sum(a h) + d)

It is fitted on the driver from at most `TRAIN_DOCUMENTS` labelled documents, of texts over
`TRAIN_BYTES` bytes from passages spread evenly over them; every text is scored whole, where it is
read, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import arrived, shipped, whole

PASSAGE = 2048
#: Bounds of the labelled sample the model is fitted on.
TRAIN_DOCUMENTS = 4000
TRAIN_BYTES = 1 << 18
#: Scores from which a document counts as good.
GOOD = 0.3
#: Bytes of text encoded at once.
SLICE = 1 << 22

HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY, SEED = 40, 64, 0.01, 1e-4, 7

#: Kinds of bytes; the last is what no other names.
_KINDS = (
    b"aeiouy", b"bcdfghjklmnpqrstvwxz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
    b"\n\r\t\x0b\x0c", b".,;:'\"-()", b"!?", b"#$%&*@^~+=<>|\\/_[]{}`", bytes(range(128, 256)),
)
_N = len(_KINDS) + 1
_KIND = np.full(256, _N - 1, np.uint8)
for _i, _bytes in enumerate(_KINDS):
    _KIND[list(_bytes)] = _i
_SPACE, _LINE = 4, 5
FEATURES = _N * _N + 9

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Encoder:
    """Bytes to passage features. Power tables are made where they are needed first."""

    def __init__(self, passage: int = PASSAGE):
        self.passage, self.up, self.down = passage, None, None
        self.value = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64)

    def __getstate__(self):
        return {**self.__dict__, "up": None, "down": None}

    def _tables(self, size: int) -> None:
        if self.up is None or len(self.up) <= size:
            size = max(size, SLICE) + 2
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def _runs(self, inside: np.ndarray, owner: np.ndarray, data: np.ndarray):
        """Owner, length and hash of every run of `inside` bytes within one owner."""
        edge = np.empty(len(data), bool)
        edge[0] = True
        edge[1:] = (owner[1:] != owner[:-1])
        starts = np.nonzero(inside & (edge | ~np.concatenate([[False], inside[:-1]])))[0]
        last = inside & np.concatenate([edge[1:] | ~inside[1:], [True]])
        ends = np.nonzero(last)[0] + 1
        self._tables(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[: len(data)], out=total[1:])
        return owner[starts], ends - starts, (total[ends] - total[starts]) * self.down[starts]

    def features(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A row per passage; `lengths` are those of the passages, all over 0."""
        count = len(lengths)
        owner = np.repeat(np.arange(count), lengths)
        kind = _KIND[data]
        out = np.zeros((count, FEATURES), np.float32)
        pair = (owner[1:] * (_N * _N) + kind[:-1] * np.int64(_N) + kind[1:])[owner[1:] == owner[:-1]]
        table = np.bincount(pair, minlength=count * _N * _N).reshape(count, -1)
        out[:, : _N * _N] = np.sqrt(table / lengths[:, None])
        at = _N * _N
        words = self._runs((kind != _SPACE) & (kind != _LINE), owner, data)
        lines = self._runs(kind != _LINE, owner, data)
        for who, size, code in (words, lines):
            number = np.maximum(np.bincount(who, minlength=count), 1)
            again = (code[1:] == code[:-1]) & (who[1:] == who[:-1])
            order = np.lexsort((code, who))
            first = np.ones(len(code), bool)
            first[1:] = (code[order][1:] != code[order][:-1]) | (who[order][1:] != who[order][:-1])
            out[:, at] = np.bincount(who[1:][again], minlength=count) / number
            out[:, at + 1] = np.bincount(who[order][first], minlength=count) / number
            out[:, at + 2] = np.log1p(np.bincount(who, size, minlength=count) / number)
            out[:, at + 3] = np.log1p(number)
            at += 4
        out[:, at] = lengths / self.passage
        return out

    def document(self, text: bytes) -> Iterator[np.ndarray]:
        """Features of all passages of one text, slice by slice; none for an empty text."""
        step = SLICE // self.passage * self.passage
        for start in range(0, len(text), step):
            data = np.frombuffer(text[start : start + step], np.uint8)
            yield self.features(data, _lengths(len(data), self.passage))

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Features of many short texts at once, and the number of passages of each."""
        sizes = [_lengths(len(t), self.passage) for t in texts]
        counts = np.array([len(s) for s in sizes])
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.zeros((0, FEATURES), np.float32), counts
        return self.features(data, np.concatenate(sizes)), counts


def _lengths(size: int, passage: int) -> np.ndarray:
    ends = np.append(np.arange(passage, size, passage), size)
    return np.diff(ends, prepend=0) if size else np.zeros(0, np.int64)


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def passages(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Representation and attention of each passage, before the softmax over its document."""
        w = self.weights
        h = np.tanh((features - self.mean) / self.scale @ w["E"] + w["e"])
        return h, (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]

    def score(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(z @ self.weights["c"] + self.weights["d"])

    @property
    def empty(self) -> float:
        """The score of a text without passages: that of a representation of zeros."""
        return float(_sigmoid(self.weights["d"])[0])


def _softmax(attention: np.ndarray, counts: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    top = np.repeat(np.maximum.reduceat(attention, starts), counts)
    raised = np.exp(attention - top)
    return raised / np.repeat(np.add.reduceat(raised, starts), counts)


def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
    """Fits the network by Adam on bags of passages; `counts` are all over 0."""
    rng = np.random.default_rng(SEED)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 0.02
    scaled = ((features - mean) / scale).astype(np.float64)
    shape = {
        "E": (FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE),
        "w": (GATE,), "c": (HIDDEN,), "d": (1,),
    }
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k.isupper() or k in "wc" else np.zeros(s) for k, s in shape.items()}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    starts = np.cumsum(counts) - counts
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(counts))
        for at in range(0, len(order), BATCH):
            bags = order[at : at + BATCH]
            n = counts[bags]
            rows = np.repeat(starts[bags] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            step += 1
            for k, g in _gradients(w, scaled[rows], n, labels[bags]).items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
    return Model(mean, scale, w)


def _gradients(w, x, counts, labels):
    starts = np.cumsum(counts) - counts
    h = np.tanh(x @ w["E"] + w["e"])
    t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    a = _softmax((t * s) @ w["w"], counts)
    z = np.add.reduceat(a[:, None] * h, starts)
    off = (_sigmoid(z @ w["c"] + w["d"]) - labels) / len(labels)
    dz = np.repeat(off[:, None] * w["c"], counts, axis=0)
    da = (dz * h).sum(axis=1)
    mean = np.repeat(np.add.reduceat(a * da, starts), counts)
    dlogit = a * (da - mean)
    dts = dlogit[:, None] * w["w"]
    dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
    return {
        "E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ dlogit,
        "c": z.T @ off, "d": np.array([off.sum()]),
    }


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Rows that labels are never learned from: crc32 of the id as text leaves 0 by 5."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def spread(text: bytes, passage: int, most: int) -> bytes:
    """The text; of one over `most` bytes as many whole passages as they hold, evenly spread, one at least."""
    if len(text) <= most:
        return text
    count, keep = -(-len(text) // passage), max(1, most // passage)
    starts = [k * count // keep * passage for k in range(keep)]
    return b"".join(text[start : start + passage] for start in starts)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", most: int = TRAIN_DOCUMENTS, most_bytes: int = TRAIN_BYTES,
) -> Model | None:
    """The model of a bounded sample of labelled rows outside the held-out fifth.

    A text over `most_bytes` is learned from that many bytes of its passages, spread evenly over it.
    Null ids, null labels and empty texts are left out. An id with two labels gives a row for each, and rows that
    repeat an id each give one, within the bound. None if no row or only one label is left.
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id", F.lit(SEED)), "_label").limit(most)
    )
    size = F.octet_length(text_col)
    texts = docs.where(size > 0).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    encoder = shipped(docs.sparkSession, Encoder())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = arrived(encoder)
        for batch in batches:
            rows = [b"".join(f.astype("<f4").tobytes() for f in code.document(
                        spread(t.as_py().encode(), code.passage, most_bytes)))
                    for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.binary())],
                names=["id", "label", "features"],
            )

    # At most `most` rows of two numbers: small enough to send to every task.
    sample = texts.join(F.broadcast(known), "_id").select(F.col("_id").cast("long"), "_label", "_text")
    sample = sample.mapInArrow(run, "id long, label double, features binary")
    # Ids that repeat must not make the sample larger than its bound.
    sample = sample.orderBy("id", "label", F.xxhash64("features")).limit(most).toPandas()
    if sample["label"].nunique() < 2:
        return None
    bags = [np.frombuffer(f, "<f4").reshape(-1, FEATURES) for f in sample["features"]]
    counts = np.array([len(b) for b in bags])
    return train(np.concatenate(bags), counts, sample["label"].to_numpy())


def score_texts(model: Model | None, encoder: Encoder, texts: list[bytes]) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    out = np.full(len(texts), model.empty)
    at = 0
    while at < len(texts):
        held, stop = len(texts[at]), at + 1
        while stop < len(texts) and held + len(texts[stop]) <= SLICE:
            held += len(texts[stop])
            stop += 1
        if held > SLICE:
            out[at] = _long(model, encoder.document(texts[at]))
        elif held:
            features, counts = encoder.documents(texts[at:stop])
            h, attention = model.passages(features)
            full = np.nonzero(counts)[0]
            weight = _softmax(attention, counts[full])
            starts = np.cumsum(counts[full]) - counts[full]
            out[at + full] = model.score(np.add.reduceat(weight[:, None] * h, starts))
        at = stop
    return out


def _long(model: Model, slices: Iterator[np.ndarray]) -> float:
    """The score of one text whose passages come in slices, by a running softmax."""
    top, mass, z = -np.inf, 0.0, 0.0
    for features in slices:
        h, attention = model.passages(features)
        high = max(top, attention.max())
        raised = np.exp(attention - high)
        z = z * np.exp(top - high) + raised @ h
        mass = mass * np.exp(top - high) + raised.sum()
        top = high
    return float(model.score((z / mass)[None, :])[0])


def score(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1 in column `out` (a column of that name is replaced).

    Null counts as empty; empty texts have the score of no evidence. Rows stay where they are,
    repeated ones each get their score, and an empty table stays empty.
    """
    sent = shipped(docs.sparkSession, (model, Encoder()))

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted, encoder = arrived(sent)
        for texts in batches:
            yield pa.array(score_texts(fitted, encoder, texts.to_pylist()), pa.float64())

    return docs.withColumn(out, scores(F.encode(whole(text_col), "UTF-8")))


def good(docs: DataFrame, model: Model | None, text_col: str = "text", least: float = GOOD) -> DataFrame:
    """The rows whose score is at least `least`, with their columns, whatever the names of those.

    Null texts are empty ones and have the score of no evidence; texts of any length are scored whole. Repeated
    rows stay or go together. An empty table stays empty.
    """
    boxed = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    return score(boxed, model, "_text", "_score").where(F.col("_score") >= least).select("_row.*")
