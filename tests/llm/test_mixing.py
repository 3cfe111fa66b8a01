import pytest
from pyspark.sql import functions as F

from tillwright.llm import mixing


@pytest.fixture
def docs(spark):
    rows = [
        (i, f"word{i % 7} " * (1 + i % 13) + ("licensed " if i % 4 == 0 else ""), ["en", "de", None][i % 3],
         ["a", "a", "a", "b", "c"][i % 5] if i % 17 else None, i % 3)
        for i in range(600)
    ] + [(None, "no id", "en", "a", 1), (700, None, "en", "a", 1), (701, "", "xx", "empty", 1), (5, "again", "en", "b", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _weight int").repartition(3)


def shares(rows, name):
    total = rows.agg(F.sum("w")).first()[0]
    return {r[0]: r[1] / total for r in rows.groupBy(name).agg(F.sum("w")).collect()}


def test_raked_weights_meet_every_target(docs):
    targets = {"source": {"a": 0.2, "b": 0.5}, "lang": 0.5, "topic": {"legal": 0.4, "prose": 0.6}}
    rows = mixing._labelled(docs.drop("_weight"), "doc_id", "text", None)
    cells = mixing.cell_tokens(rows)
    raked = mixing.rake(cells, targets).withColumn("w", F.col("_weight"))
    source, topic, lang = (shares(raked, f"_{d}") for d in ("source", "topic", "lang"))
    assert source["a"] == pytest.approx(0.2, abs=1e-6) and source["b"] == pytest.approx(0.5, abs=1e-6)
    assert topic["legal"] == pytest.approx(0.4, abs=1e-6)
    seen = shares(cells.withColumn("w", F.col("_tokens")), "_lang")
    root = {k: v**0.5 for k, v in seen.items()}
    assert lang == pytest.approx({k: v / sum(root.values()) for k, v in root.items()}, abs=1e-6)


def test_expected_tokens_meet_the_budget(docs):
    mixed = mixing.mix(docs, keep=0.6).cache()
    total, expected, drawn = mixed.agg(
        F.sum("tokens"), F.sum(F.col("tokens") * F.col("chance")), F.sum(F.when(F.col("sampled"), F.col("tokens")))
    ).first()
    assert expected == pytest.approx(0.6 * total, rel=1e-6)
    assert drawn == pytest.approx(expected, rel=0.15)
    assert mixed.where("chance < 0 or chance > 1").isEmpty()
    assert mixed.count() == docs.count()


def test_draws_repeat_and_follow_the_id(docs):
    one, two = (
        sorted(str((*r[:5], round(r["chance"], 9), r["sampled"])) for r in mixing.mix(d).collect())
        for d in (docs, docs.repartition(7))
    )
    assert one == two
    assert len({r["sampled"] for r in mixing.mix(docs, keep=1.0).where("tokens > 0").collect()}) == 1
    texts = mixing.mix(docs).where("doc_id = 701").first()
    assert (texts["tokens"], texts["chance"], texts["sampled"]) == (0, 0.0, False)


def test_kept_rows_have_all_columns(docs):
    kept = mixing.sample_mix(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(str(r["doc_id"]) for r in mixing.mix(docs).where("sampled").collect())


def test_empty_table(docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.sample_mix(docs.limit(0)).count() == 0


def tied(spark, *rows):
    names = "_source string, _lang string, _tokens long, _weight double"
    return spark.createDataFrame([(a, b, n, float(n)) for a, b, n in rows], names)


def test_tied_dimensions_meet_their_targets(spark):
    cells = tied(spark, ("a", "en", 9900), ("a", "de", 100), ("b", "en", 100), ("b", "de", 9900))
    raked = mixing.rake(cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.59, "de": 0.41}})
    raked = raked.withColumn("w", F.col("_weight"))
    assert shares(raked, "_source")["a"] == pytest.approx(0.5, abs=1e-9)
    assert shares(raked, "_lang")["en"] == pytest.approx(0.59, abs=1e-9)


def test_contradictory_targets_are_reported(spark):
    cells = tied(spark, ("a", "en", 10), ("b", "de", 10))
    with pytest.warns(UserWarning, match="source 0.*lang"):
        mixing.rake(cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.6, "de": 0.4}}, rounds=3)
