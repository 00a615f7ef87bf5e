"""Every query with SQL gives the rows DuckDB gives on the same tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_file
from sentimill.registry.queries import QUERIES as LIBRARY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()


def normal(frame):
    def cell(value):
        if value is None or value is pd.NA or value != value:
            return "NULL"
        if isinstance(value, bool) or isinstance(value, str):
            return str(value)
        if hasattr(value, "isoformat"):
            return value.isoformat()
        return "inf" if math.isinf(value) else repr(round(float(value), 6) + 0.0)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_only_optimiser_results_have_no_oracle():
    assert set(LIBRARY) - set(ORACLES) == {
        "logistic_fit", "svm_fit", "svm_cross_validate", "svm_grid_search", "lr_grid_search",
        "linear_accuracy", "linear_roc_auc", "lr_roc_curve", "linear_confusion_matrix", "linear_confusion_rates",
        "lr_best_predictions", "svm_best_predictions", "load_linear_model",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = duck.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
