import pytest

LONG = ("alpha beta gamma delta epsilon zeta eta theta " * 4000).strip()


@pytest.fixture
def texts(spark):
    """A documents table of (id, text) rows, with extra columns whose names clash with internal ones."""

    def make(*rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, size int, id int, hi int"
        full = [(i, t, "en", "s1", len(t or ""), "x", 1, 2, 3) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd():
    """Null, empty, very long, repeated and short texts, and ties."""
    return [
        (1, None), (2, ""), (3, "one"), (4, "one"), (4, "one"), (5, LONG), (6, LONG + " tail"),
        (None, "one"), (None, None), (7, "a  b\t\tc \n d"), (8, "a b c d"), (9, "éü 漢字 🎉 it's \x1c x"),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]
