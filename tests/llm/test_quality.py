import math
import re
import zlib

import numpy as np
import pytest

from tillwright.llm import quality
from tillwright.llm.common import table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))


def test_held_out_accuracy(spark, model):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    scored = quality.score(docs, model).join(labels, "doc_id").where(quality.held_out()).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in scored)
    right = sum((r["score"] >= quality.GOOD) == bool(r["quality"]) for r in scored)
    assert len(scored) > 50 and right / len(scored) > 0.95
    kept = [r["score"] >= quality.GOOD for r in scored if r["quality"]]
    assert sum(kept) / len(kept) > 0.98


def test_held_out_labels_do_not_matter(spark):
    docs = table(spark, FOLDER, "documents").limit(300).cache()
    labels = table(spark, FOLDER, "labels")
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - labels["quality"]).otherwise(labels["quality"]))
    one, two = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert all((one.weights[k] == two.weights[k]).all() for k in one.weights)


def test_odd_texts_get_scores(texts, odd, model):
    rows = quality.score(texts(*odd), model).collect()
    assert len(rows) == len(odd) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not r["text"]}
    assert empty == {model.empty}
    same = [r["score"] for r in rows if r["text"] == "one"]
    assert len(same) == 4 and len(set(same)) == 1
    assert quality.score(texts(*odd).limit(0), model).count() == 0
    assert quality.good(texts(*odd), model).columns == texts(*odd).columns


def test_without_usable_labels(spark, texts):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = texts((1, "a"), (2, "b"))
    assert quality.fit(docs, labels) is None
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}


def test_slices_and_batches_score_alike(model, monkeypatch):
    text = b"The quick brown fox. Line one!\nLine two $$$ 123\n" * 2000
    encoder = quality.Encoder()
    whole = quality.score_texts(model, encoder, [text, b"", b"x y"])
    monkeypatch.setattr(quality, "SLICE", 10_000)
    parts = quality.score_texts(model, encoder, [text, b"", b"x y"])
    assert np.allclose(whole, parts, rtol=1e-5)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    shape = {"E": (5, 4), "e": (4,), "V": (4, 3), "U": (4, 3), "w": (3,), "c": (4,), "d": (1,)}
    w = {k: rng.normal(size=s) for k, s in shape.items()}
    x, counts, labels = rng.normal(size=(7, 5)), np.array([2, 4, 1]), np.array([1.0, 0.0, 1.0])

    def loss():
        model = quality.Model(np.zeros(5), np.ones(5), w)
        h, attention = model.passages(x)
        starts = np.cumsum(counts) - counts
        p = model.score(np.add.reduceat(quality._softmax(attention, counts)[:, None] * h, starts))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, slope in quality._gradients(w, x, counts, labels).items():
        for at in np.ndindex(*shape[name]):
            w[name][at] += 1e-6
            high = loss()
            w[name][at] -= 2e-6
            low = loss()
            w[name][at] += 1e-6
            assert abs((high - low) / 2e-6 - slope[at]) < 1e-5


def test_long_texts_are_learned_from(spark, texts):
    """All texts of one label are over the bound of bytes."""
    long = "free money now!!! " * 20_000
    docs = texts(*[(i, "A calm line of prose." if i % 2 else f"{i} {long}") for i in range(16)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert model is not None
    low, high = quality.score_texts(model, quality.Encoder(), [long.encode(), b"A calm line of prose."])
    assert low < high


def test_passages_are_spread_over_a_long_text():
    text = b"".join(bytes([65 + n]) * 10 for n in range(20)) + b"z"
    assert quality.spread(text, 10, 1000) == text
    parts = quality.spread(text, 10, 45)
    assert len(parts) == 40 and [parts[k] - 65 for k in range(0, 40, 10)] == [0, 5, 10, 15]


def features_by_hand(passage):
    """One passage, byte by byte."""
    kind = [next((k for k, some in enumerate(quality._KINDS) if b in some), len(quality._KINDS)) for b in passage]
    n = len(quality._KINDS) + 1
    out = [0.0] * (n * n)
    for a, b in zip(kind, kind[1:]):
        out[a * n + b] += 1
    out = [math.sqrt(count / len(passage)) for count in out]
    white = b" \n\r\t\x0b\x0c"
    for cut in (white, white[1:]):
        runs = [r for r in re.split(b"[" + re.escape(cut) + b"]+", passage) if r]
        number = max(len(runs), 1)
        out += [
            sum(a == b for a, b in zip(runs, runs[1:])) / number, len(set(runs)) / number,
            math.log1p(sum(map(len, runs)) / number), math.log1p(number),
        ]
    return np.array([*out, len(passage) / quality.PASSAGE])


def score_by_hand(model, text):
    """The formula of the module, passage after passage."""
    w, data = model.weights, text.encode()
    if not data:
        return 1 / (1 + math.exp(-w["d"][0]))
    encoded, weights = [], []
    for start in range(0, len(data), quality.PASSAGE):
        f = (features_by_hand(data[start : start + quality.PASSAGE]) - model.mean) / model.scale
        h = np.tanh(f @ w["E"] + w["e"])
        gate = 1 / (1 + np.exp(-(h @ w["U"])))
        encoded.append(h)
        weights.append(math.exp(float((np.tanh(h @ w["V"]) * gate) @ w["w"])))
    z = sum(a * h for a, h in zip(weights, encoded)) / sum(weights)
    return 1 / (1 + math.exp(-float(z @ w["c"] + w["d"][0])))


def test_scores_equal_brute_force(texts, odd, documents, model):
    rows = [*odd, *documents[:80], (70, "a" * quality.PASSAGE), (71, "a" * (quality.PASSAGE + 1)), (72, " \n\t "), (73, "\x00\x7f~ \x1c")]
    found = [(r["text"] or "", r["score"]) for r in quality.score(texts(*rows), model).collect()]
    assert len(found) == len(rows)
    by_hand = {text: score_by_hand(model, text) for text in {text for text, _ in found}}
    assert all(abs(score - by_hand[text]) < 1e-4 for text, score in found)
