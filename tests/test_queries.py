"""Every entity-resolution query against its SQL, and the driver's contract."""

import compare
import pytest

import __spark_entry__ as registry
from kindred.plans.queries import ORACLES, QUERIES

SLOW = {"er_predict_base", "er_predict_cascade", "er_training_pairs"}


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, small, con, name):
    assert compare.difference(QUERIES[name](spark, small), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_contract(spark):
    assert registry.entry(spark).count() > 0
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(QUERIES) <= set(registry.queries())


@pytest.mark.parametrize("name", ["er_predict_base", "er_predict_cascade"])
def test_predict_queries_train_as_configured(spark, small, name, monkeypatch):
    from kindred.config import Training
    from kindred.plans import train

    calls, whole = [], train.fit_trees

    def fewer(pairs, config, trees, validation=None):
        """Records what is asked for; two trees are enough to see the rest of the path."""
        calls.append((config, trees, validation, "is_validation" in pairs.columns))
        return whole(pairs, config, min(trees, 2), validation)

    monkeypatch.setattr(train, "fit_trees", fewer)
    assert QUERIES[name](spark, small).count() == spark.read.parquet(f"{small}/customer.parquet").count()
    assert calls == [(Training(), 1200, "is_validation", True), (Training(), 2, None, True)]
