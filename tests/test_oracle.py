"""Every registered query against its SQL."""

import sys
import warnings

import compare
import pytest

import __spark_entry__ as registry
from tillwright.registry.oracle import ORACLE
from tillwright.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    ours = compare.spark_rows(QUERIES[name](spark, FOLDER))
    theirs = compare.duck_rows(connection, ORACLE[name])
    assert compare.differences(ours, theirs) == ""


def test_entry_has_rows_and_stable_columns(spark):
    df = registry.entry(spark)
    assert df.columns == registry.entry(spark).columns
    assert df.count() > 0


def test_append_takes_every_line(spark, connection):
    parts = {r["part"]: r["row_count"] for r in QUERIES["medallion_append_all"](spark, FOLDER).collect()}
    lines, orders = connection.execute(
        "SELECT COUNT(*), COUNT(DISTINCT l_orderkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    ).fetchone()
    assert parts["bronze 2001-08-02"] + parts["bronze 2001-08-03"] == lines
    assert parts["silver_transactions"] == orders < lines


def test_base_queries_work_without_a_library_of_the_training_data(monkeypatch):
    for name in [n for n in sys.modules if n.startswith(("tillwright.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)  # an import of it now fails
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert set(registry.queries()) == set(QUERIES)
        assert set(registry.oracle_sql()) == set(ORACLE)
