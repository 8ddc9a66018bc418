"""Driver contract: entry smoke, registry/oracle keys, oracle parity at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare, duck

FAST_KEYS = [
    "scan_bronze", "dedup_plays", "game_silver", "team_stats_margin", "season_event_counts",
    "visual_top_events_by_player", "visual_shots_made", "null_profile", "describe_numeric",
    "corr_matrix", "histogram", "game_name", "first_games", "top_shot_makers", "momentum",
    "lag_40", "regression_metrics", "expectation", "duplicate_count", "one_hot", "feature_table",
    "normalize_names", "train_split", "random_split", "fold_sizes", "simple_regression", "histograms",
    "team_feature_table", "unlisted_categories", "pipeline_violations", "category_dictionary",
    "one_hot_discovered", "csv_scan", "csv_rejects",
]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["team_name", "season"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", FAST_KEYS)
def test_oracle_parity_small(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["status"] == "ok", r
