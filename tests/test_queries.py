"""Every named query against its SQL counterpart, and invariants for the rest."""

from pathlib import Path

import duckdb
import pytest
from check_queries import compare
from conftest import DATA

from larder.plans.catalog import QUERIES

# Each fits a hundred rounds or more; test_forecast fits the same pipelines on small tables.
TRAINED = {
    "boosted_trees",
    "sampled_boosted_trees",
    "feature_importance",
    "trained_comparison",
    "saved_model_scores",
    "histogram_boosting",
    "boosted_tree_facts",
    "histogram_boosting_facts",
}
WITH_SQL = [n for n, q in QUERIES.items() if q.sql and n not in TRAINED]
WITHOUT_SQL = [n for n, q in QUERIES.items() if not q.sql and n not in TRAINED]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name].run(spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    cursor = duck.execute(QUERIES[name].sql)
    expected = ([d[0] for d in cursor.description], cursor.fetchall())
    assert compare((df.columns, rows), expected) == "ok"


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs_without_sql(spark, name):
    assert QUERIES[name].run(spark, DATA).count() > 0


def test_every_inventory_item_is_covered():
    """The operator ids of the blueprint, each covered by at least one query."""
    families = {
        "IO": 15, "P": 17, "J": 12, "G": 30, "W": 12, "T": 8, "F": 14, "A": 17, "Q": 17,
        "M": 27, "X": 6,
    }
    expected = {f"{k}{i}" for k, n in families.items() for i in range(1, n + 1)}
    covered = {i for q in QUERIES.values() for i in q.covers}
    assert expected - covered == set()
    assert covered - expected == set()


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
