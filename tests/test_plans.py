"""Plan guards over the registered queries (the scale rules, checked)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from courtline.operators import medallion as M
from courtline.plans.queries import registry

# five-fold fits need a game in every fold, which the smallest input lacks
SKIP = {"cv_metrics", "grid_search", "ml_results", "best_model_metrics", "tree_cv", "tree_grid"}
KEYS = [k for k in registry() if k not in SKIP]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_pairwise_joins(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (key, bad)


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["one_game"](spark, SF_SMALL))
    assert "EqualTo(user_id,7)" in plan
    from courtline.operators.analyst import team_stats_margin
    from courtline.plans import params as P
    from courtline.plans.queries import Inputs
    i = Inputs(spark, SF_SMALL)
    plan = _plan(team_stats_margin(i.home_gold, i.away_gold, P.EXCLUDED_TEAMS))
    assert "Not(In(n_name" in plan


def test_one_game_lag_filters_the_scan(spark):
    assert "EqualTo(user_id,7)" in _plan(E.queries()["one_game_lag"](spark, SF_SMALL))


def test_top_k_per_season_is_partial(spark):
    df = E.queries()["visual_top_events_by_player"](spark, SF_SMALL)
    df.collect()
    plan = _plan(df)
    assert "WindowGroupLimit" in plan


def test_columns_pruned(spark):
    df = E.queries()["play_by_event_gold"](spark, SF_SMALL)
    plan = _plan(df)
    # one orders scan, of the join key and the date that the whole-row dedup compares
    assert plan.count("o_orderkey:bigint") == 1
    assert "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_building_plans_runs_one_count_per_input(spark):
    """The count of games is shared by all plans over silver; no plan runs another job."""
    from courtline.session import release_scratch
    release_scratch(spark)
    tracker = spark.sparkContext.statusTracker()
    keys = ["forward_fill", "silver_complete", "dedup_plays", "regulation_time", "null_profile"]

    def jobs(group, names):
        spark.sparkContext.setJobGroup(group, group)
        for k in names:
            E.queries()[k](spark, SF_SMALL)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert jobs("first", keys[:1]) > 0
    assert jobs("others", keys) == 0


def test_ordinary_games_shuffle_once_for_silver(spark):
    plan = _plan(E.queries()["dedup_plays"](spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning(game_id") == 1
    # the fixture's join of events and orders may be another one
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("Window [") == 1


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_dealt_silver_shuffles_by_game_once(spark, monkeypatch, broadcast):
    """Join, fill and de-duplication share the partitions that the count of plays asks for."""
    from courtline.operators import windows
    from courtline.plans.queries import Inputs
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    plain = Inputs(spark, SF_SMALL).silver
    rows = sorted(map(repr, plain.collect()))
    monkeypatch.setattr(windows, "TASK_ROWS", 60)  # of 1020 rows: 17 tasks or the cores
    tasks = max(17, spark.sparkContext.defaultParallelism)
    spark.conf.set(key, broadcast)
    try:
        silver = Inputs(spark, SF_SMALL).silver
        plan = _plan(silver)
        assert plan.count(f", {tasks}), REPARTITION_BY_NUM") == 1
        assert plan.count("Exchange hashpartitioning") == plan.count(f", {tasks}), ") == (1 if broadcast == "10m" else 2)
        assert sorted(map(repr, silver.collect())) == rows
        assert sorted(map(repr, Inputs(spark, SF_SMALL).filled.collect())) == sorted(
            map(repr, M.fill_scores_forward(Inputs(spark, SF_SMALL).named, segment_rows=None).collect()))
        assert "EqualTo(user_id,7)" in _plan(silver.filter("game_id = 7"))
    finally:
        spark.conf.set(key, old)


def test_dealt_games_shuffle_by_game_once(spark, monkeypatch):
    from courtline.plans import params
    from courtline.plans.queries import Inputs
    from courtline.session import release_scratch
    release_scratch(spark)
    plain = Inputs(spark, SF_SMALL).game_silver
    rows = sorted(map(repr, plain.collect()))
    release_scratch(spark)
    monkeypatch.setattr(params, "LINES_PER_TASK", 200)  # of 6000 lines
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as tables of size are joined
    try:
        games = Inputs(spark, SF_SMALL).game_silver
        plan = _plan(games)
        # two for the customers of orders, two by game; the de-duplication needs none
        assert plan.count("Exchange hashpartitioning") == 4 and plan.count(", 30), ") == 2
        assert plan.count(", 30), REPARTITION_BY_NUM") == 1
        assert sorted(map(repr, games.collect())) == rows
    finally:
        spark.conf.set(key, old)
        release_scratch(spark)


def test_count_of_games_is_dealt_by_counted_keys(spark, monkeypatch):
    """The join that is counted for hot games takes tasks by the rows of both its sides."""
    from courtline.plans import params, queries
    from courtline.session import release_scratch
    key = "spark.sql.autoBroadcastJoinThreshold"
    old, counted = spark.conf.get(key), []
    monkeypatch.setattr(queries, "hot_cuts", lambda df: counted.append(df) or count(df))
    count = M.hot_cuts
    spark.conf.set(key, "-1")  # as tables of size are joined
    try:
        release_scratch(spark)
        plain = queries.Inputs(spark, SF_SMALL).cuts
        release_scratch(spark)
        monkeypatch.setattr(params, "KEYS_PER_TASK", 100)  # of 1000 events and 1500 orders
        dealt = queries.Inputs(spark, SF_SMALL).cuts
        assert dealt == plain and dealt.rows == counted[1].count() == 1020
        tasks = max(25, spark.sparkContext.defaultParallelism)
        plan = _plan(counted[1].groupBy("game_id").count())
        assert plan.count(f", {tasks}), REPARTITION_BY_NUM") == 1
        # both sides of the join, and none for the groups behind it
        assert plan.count("Exchange hashpartitioning") == plan.count(f", {tasks}), ") == 2
        assert "REPARTITION_BY_NUM" not in _plan(counted[0])
        assert counted[1].exceptAll(counted[0]).isEmpty() and counted[0].exceptAll(counted[1]).isEmpty()
    finally:
        spark.conf.set(key, old)
        release_scratch(spark)


def test_events_of_a_hot_game_are_dealt_to_several_tasks(spark, monkeypatch):
    """A game above the segment size is joined in parts, with the rows of the plain join."""
    from pyspark.sql import functions as F
    from courtline.operators import windows
    from courtline.plans import queries
    from courtline.session import release_scratch
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    release_scratch(spark)
    monkeypatch.setattr(windows, "TASK_ROWS", 10)
    monkeypatch.setattr(queries, "hot_cuts", lambda df: windows.hot_cuts(df, segment_rows=20))
    plain = M.play_by_play_silver(queries.Inputs(spark, SF_SMALL).bronze, segment_rows=None)
    rows = sorted(map(repr, plain.collect()))
    spark.conf.set(key, "-1")  # as tables of size are joined
    try:
        i = queries.Inputs(spark, SF_SMALL)
        assert not i.cuts.empty
        dealt = i.dealt_bronze
        assert dealt.exceptAll(i.bronze).isEmpty() and i.bronze.exceptAll(dealt).isEmpty()
        game = i.bronze.groupBy("game_id").count().agg(F.max("count")).first()[0]
        task = dealt.groupBy(F.spark_partition_id(), "game_id").count().agg(F.max("count")).first()[0]
        assert game >= 40 and task < game / 2
        assert sorted(map(repr, i.silver.collect())) == rows
        assert "EqualTo(user_id,7)" in _plan(i.silver.filter("game_id = 7"))
    finally:
        spark.conf.set(key, old)
        release_scratch(spark)
