"""Every query of the analytics operators against its DuckDB twin, or for its shape where SQL can't express it."""

import pytest

from tablewright.operators import balance, split
from tablewright.plans import registry

from .oracle import connected, same

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connected(DIRECTORY)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, duck, name):
    same(registry.queries()[name](spark, DIRECTORY), duck, registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in registry.examples().items() if sql))
def test_example(spark, duck, name):
    made, sql = registry.examples()[name]
    same(made(spark, DIRECTORY), duck, sql)


#: Those whose rows get places in an order.
ORDERED = ("next_value_target", "sliding_window", "pct_change", "sequential_split")


@pytest.mark.parametrize("name", ORDERED)
def test_ordered_twin_in_many_buckets(spark, duck, name, monkeypatch):
    monkeypatch.setattr(split, "ROWS_A_BUCKET", 20)
    same(registry.queries()[name](spark, DIRECTORY), duck, registry.oracle_sql()[name])


def test_running_balance_in_many_chunks(spark, duck, monkeypatch):
    monkeypatch.setattr(balance, "CHUNK", 3)
    monkeypatch.setattr(balance, "ROWS_A_RANGE", 100)
    same(registry.queries()["running_balance"](spark, DIRECTORY), duck, registry.oracle_sql()["running_balance"])


SHAPES = {
    "random_numbers": (100, {"id", "uniform", "normal", "whole"}),
    "f_regression_p": (4, {"feature", "f", "p"}),
    "kmeans_profile": (5, {"cluster", "n", "mean_balance", "mean_nation"}),
    "kmeans_elbow": (5, {"k", "cost"}),
    "automatic_k": (1, {"k"}),
    "logistic_model": (1, {"accuracy"}),
    "tree_models": (3, {"model", "accuracy"}),
    "regressions": (2, {"model", "rmse", "mae", "r2"}),
    "grid_search": (1, {"c", "gamma", "points", "accuracy"}),
    "linear_svm_model": (1, {"accuracy"}),
    "kernel_svms": (2, {"kernel", "accuracy"}),
    "validated_search": (81, {"trees", "depth", "leaf", "seed", "rmse"}),
    "window_forecast": (1, {"mse", "rmse", "mae", "r2"}),
    "saved_model": (1, {"doc_id", "prediction", "probability"}),
    "decision_mesh": (121, {"symbols", "capitals", "prediction"}),
    "generated_regression": (4, {"feature", "f"}),
    "boosted_classes": (1, {"log_loss", "accuracy", "majority_log_loss"}),
    "recurrent_forecast": (1, {"mse", "rmse", "mae", "last_value_mse"}),
    "kernel_machines": (2, {"kernel", "gap", "accuracy", "majority", "brier"}),
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_shape(spark, name):
    rows, columns = SHAPES[name]
    made = registry.queries().get(name) or registry.examples()[name][0]
    df = made(spark, DIRECTORY)
    assert set(df.columns) == columns
    found = df.collect()
    assert len(found) == rows
    if name == "boosted_classes":
        assert found[0].log_loss < 0.8 * found[0].majority_log_loss
    elif name == "recurrent_forecast":
        assert found[0].mse < 0.7 * found[0].last_value_mse
    elif name == "kernel_machines":
        assert all(r.gap <= 1e-3 and r.accuracy > r.majority for r in found)
    elif "accuracy" in columns:
        assert all(r["accuracy"] > 0.6 for r in found)


def test_entry_lists_all(spark):
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
