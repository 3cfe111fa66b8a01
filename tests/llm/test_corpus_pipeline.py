"""The pipeline against its stages by brute force, and the queries against their SQL."""

import hashlib
import re

import compare
import corpus_pipeline
import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
import test_jaccard
import tiktoken

import __spark_entry__ as entry
from tillwright.llm import quality, registry
from tillwright.llm.bpe import read_ranks
from tillwright.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns
        rows = [tuple(r) for r in after.collect()]
        assert 0 < len(rows) <= before
        before, docs = len(rows), spark.createDataFrame(rows, docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    expected = sorted(map(tuple, last.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == expected


def by_hand(docs, model):
    """The five stages in plain Python and SQL over rows of documents."""
    scores = quality.score_texts(model, quality.Encoder(), [(d["text"] or "").encode() for d in docs])
    docs = [d for d, score in zip(docs, scores, strict=True) if score >= 0.3]
    yield docs
    first = {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", d["text"] or ""), d["doc_id"])
    docs = [d for d in docs if d["doc_id"] in first.values()]
    yield docs
    kept = {i for i, _, _, keep in test_jaccard.brute([(d["doc_id"], d["text"]) for d in docs]) if keep}
    docs = [d for d in docs if d["doc_id"] in kept]
    yield docs
    documents = pa.Table.from_pylist(docs)  # noqa: F841  read by the SQL
    drawn = duckdb.sql(registry.ORACLE["op10_mixing"]).project("doc_id, sampled").fetchall()
    docs = [d for d in docs if dict(drawn)[d["doc_id"]]]
    yield docs
    library = tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    out = []
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        out.append({
            "doc_id": d["doc_id"], "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256((d["text"] or "").encode()).hexdigest(),
        })
    yield out


def test_stages_equal_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    model = quality.fit(docs, table(spark, FOLDER, "labels"))
    expected = by_hand([r.asDict() for r in docs.collect()], model)
    schema = docs.schema
    for (_, stage), rows in zip(corpus_pipeline.STAGES, expected, strict=True):
        found = [r.asDict() for r in stage(spark, docs, FOLDER).collect()]
        key = lambda d: d["doc_id"]
        assert sorted(found, key=key) == sorted(rows, key=key)
        if rows and "text" in rows[0]:
            docs = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


CLASHING = ["_quality_score", "_score", "_text", "_row", "_sha", "_owner_id", "_owner_sha", "_kept_id", "_id", "_cell", "_tokens",
            "_draw", "_source", "_lang", "_topic", "_chance", "_sampled", "_weight", "_salt", "size", "hi", "lo", "id", "class", "score"]


@pytest.fixture(scope="module")
def odd_docs(spark):
    long = ("Than inther thed ofbleth the thand erthat. " * 3000).strip()
    rows = [(1, None), (2, ""), (3, "one"), (4, "one"), (4, "one"), (5, long), (6, long + " tail"), (None, "one"), (None, None),
            (7, "a  b\t\tc \n d"), (8, "a b c d"), (9, "\u00e9\u00fc \u6f22\u5b57 it's \x1c x"), (10, long)]
    full = [(i, t, ["en", None, "de"][n % 3], ["s1", "s2", None][n % 3], len(t or ""), *[f"{c} {n}" for c in CLASHING])
            for n, (i, t) in enumerate(rows)]
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars int, {names}").repartition(3)


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_odd_rows_and_clashing_columns(spark, odd_docs, stage):
    """What stays is what came in, every column as it was, and as many rows as without the extra columns."""
    name, run = corpus_pipeline.STAGES[stage]
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    kept = run(spark, odd_docs, FOLDER)
    assert kept.columns == odd_docs.columns
    rows = [tuple(r) for r in kept.collect()]
    came = [tuple(r) for r in odd_docs.collect()]
    assert rows and set(rows) <= set(came)
    again = sorted(str(tuple(r)[:2]) for r in run(spark, plain, FOLDER).collect())
    assert sorted(str(r[:2]) for r in rows) == again
    assert run(spark, odd_docs.limit(0), FOLDER).collect() == []
    if name == "exact dedup":
        assert sorted(str(r[0]) for r in rows) == ["1", "3", "5", "6", "7", "9"]
    if name == "n-gram jaccard join":
        assert sorted(str(r[0]) for r in rows) == sorted(["1", "2", "3", "5", "7", "9", "None", "None"])


def test_last_stage_on_odd_rows(spark, odd_docs):
    found = corpus_pipeline.STAGES[-1][1](spark, odd_docs, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    assert len(found) == 13
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in found if r["doc_id"])
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs.limit(0), FOLDER).collect() == []


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names and set(registry.ORACLE) < set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, name):
    ours = compare.spark_rows(registry.QUERIES[name](spark, FOLDER))
    theirs = compare.duck_rows(compare.duck(FOLDER), registry.ORACLE[name])
    assert compare.differences(ours, theirs) == ""
