"""Spark queries vs their DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

KEYS = [
    "master_panel", "clean_cases", "normalize_text", "modal_geo", "fill_zero_weeks", "weekly_series", "describe_cases",
    "corr_matrix", "unit_profile", "silhouette", "roc_auc", "threshold_sweep", "forecast_errors", "future_weeks",
    "weighted_draw", "ar1_path", "registry_update", "scenario_clamp", "json_roundtrip",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    info = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert info["ok"], info


def test_every_key_runs_and_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())
