"""Model-side helpers: splits, folds, pipeline ordering, expectations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from courtline.operators import modeling as ML
from courtline.operators import quality as Q
from courtline.plans.pipeline import Dataset, Pipeline
from courtline.plans.queries import TEAM_STATS_FEATURES, Inputs, registry
from courtline.session import release_scratch

SF_MEDIUM = SF_SMALL.replace("0.001", "0.01")


def test_time_split_boundaries(spark):
    df = spark.createDataFrame(
        [(p, y) for p in (1, 2, 3, 4) for y in (2021, 2022)], "period int, game_year int")
    train, test = ML.time_split(df)
    assert sorted((r.period, r.game_year) for r in test.collect()) == [(4, 2022)]
    assert sorted((r.period, r.game_year) for r in train.collect()) == \
        [(1, 2021), (2, 2021), (3, 2021)]


def test_hash_split_and_folds_are_deterministic(spark):
    df = spark.range(2000).select(F.col("id").alias("game_id"), (F.col("id") % 7).alias("event_num"))
    a = ML.hash_split(df, ["game_id", "event_num"]).orderBy("game_id").collect()
    b = ML.hash_split(df.repartition(5), ["game_id", "event_num"]).orderBy("game_id").collect()
    assert [r.split for r in a] == [r.split for r in b]
    share = sum(r.split == "test" for r in a) / len(a)
    assert 0.15 < share < 0.25
    folds = ML.with_folds(df, 5, keys=["game_id", "event_num"])
    got = {r.fold for r in folds.select("fold").distinct().collect()}
    assert got == {0, 1, 2, 3, 4}


def test_a_game_lies_in_one_fold(spark):
    df = spark.range(3000).select((F.col("id") % 60).alias("game_id"), F.col("id").alias("event_num"))
    per_game = ML.with_folds(df).groupBy("game_id").agg(F.countDistinct("fold").alias("n"))
    assert per_game.filter("n > 1").count() == 0


def test_r2_does_not_cancel(spark):
    df = spark.range(1000).select((F.col("id") % 10 + 1e9).alias("y"), (F.col("id") % 10 + 1e9 + 1).alias("p"))
    df = df.union(spark.createDataFrame([(None, 1.0), (1.0, None)], "y double, p double"))
    r = ML.regression_metrics(df, label="y", pred="p").first()
    assert (r.rows, r.r2, r.mse, r.mae) == (1000, round(1 - 1 / 8.25, 3), 1.0, 1.0)


def test_tree_finds_a_known_split(spark):
    df = spark.createDataFrame([(float(x), 10.0 if x < 4 else 20.0) for x in range(10)] * 5,
                               f"x double, {ML.LABEL} double")
    model = ML.fit(df, ML.model_catalog()["decision_tree"], ["x"])
    assert {(r.x, r.prediction) for r in model.transform(df).collect()} == {
        (float(x), 10.0 if x < 4 else 20.0) for x in range(10)}
    assert model.stages[-1].depth == 1


def _noisy(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 30, (n, 3))
    y = x[:, 0] * 2.0 - x[:, 1] + 5 * (x[:, 2] > 12) + rng.normal(size=n)
    return spark.createDataFrame([(int(i % 17), *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))],
                                 f"game_id long, a double, b double, c double, {ML.LABEL} double")


def _predicted(model, df):
    return {(r.a, r.b, r.c): round(r.prediction, 9) for r in model.transform(df).collect()}


def test_a_forest_and_a_boosting_of_one_tree_are_that_tree(spark):
    df, cols = _noisy(spark), ["a", "b", "c"]
    catalog = ML.model_catalog()
    tree = catalog["decision_tree"]
    forest = catalog["random_forest"].copy()
    forest.setParams(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=ML.TREE_DEPTH)
    boosted = catalog["gradient_boosting"].copy()
    boosted.setParams(maxIter=1, maxDepth=ML.TREE_DEPTH)
    want = _predicted(ML.fit(df, tree, cols), df)
    assert _predicted(ML.fit(df, forest, cols), df) == want
    assert _predicted(ML.fit(df, boosted, cols), df) == want


def test_scaling_changes_no_tree(spark):
    df, cols = ML.with_folds(_noisy(spark)), ["a", "b", "c"]
    best, table = ML.grid_search(df, cols, max_depth=(4,), min_instances=(5,))
    plain = ML.model_catalog()["decision_tree"].copy()
    plain.setParams(maxDepth=4, minInstancesPerNode=5)
    assert _predicted(best, df) == _predicted(ML.fit(df, plain, cols), df)
    mean = ML.cv_summary(df, {"tree": plain}, cols).first().mean_mae
    assert abs(table.first().mean_mae - mean) < 1e-9


def test_linear_fit_equals_normal_equations(spark):
    df, cols = _noisy(spark), ["a", "b", "c"]
    line = ML.fit(df, ML.model_catalog()["linear_regression"], cols).stages[-1]
    data = np.array([[1.0, r.a, r.b, r.c, r[ML.LABEL]] for r in df.collect()])
    want = np.linalg.solve(data[:, :4].T @ data[:, :4], data[:, :4].T @ data[:, 4])
    assert np.allclose([line.intercept, *line.coefficients], want, atol=1e-8)


def test_new_record_is_scored_by_the_model_on_disk(spark):
    i = Inputs(spark, SF_SMALL)
    row = registry()["score_new"](spark, SF_SMALL).first()
    data = [r for r in registry()["random_split"](spark, SF_SMALL).collect()]
    x = np.array([[1.0, *(float(r[c]) for c in TEAM_STATS_FEATURES)] for r in data])
    y, train = np.array([r.margin for r in data]), np.array([r.split == "train" for r in data])
    want = np.linalg.lstsq(x[train], y[train], rcond=None)[0]
    new = np.array([1.0, *(row[c] for c in TEAM_STATS_FEATURES)])
    fitted = x @ want
    if np.linalg.matrix_rank(x[train]) == x.shape[1]:
        assert abs(row.new_record_prediction - new @ want) < 1e-6
    assert abs(row.test_mse - ((y - fitted)[~train] ** 2).mean()) < 1e-6
    loaded = i.saved_model("team-margin", lambda: pytest.fail("fitted again"))
    assert loaded.stages[-1].coefficients.size == len(TEAM_STATS_FEATURES)


def test_one_search_serves_three_queries(spark, monkeypatch):
    release_scratch(spark)
    runs = []
    search = ML.grid_search
    monkeypatch.setattr(ML, "grid_search", lambda *a, **k: runs.append(1) or search(*a, **k))
    q = registry()
    best = [r for r in q["grid_search"](spark, SF_MEDIUM).collect() if r.best]
    assert len(best) == 1 and q["best_model_metrics"](spark, SF_MEDIUM).count() == 1
    assert q["ml_results"](spark, SF_MEDIUM).count() > 0 and len(runs) == 1


def test_first_split_of_a_tree_without_one(spark):
    df = spark.createDataFrame([(1.0, 5.0)] * 3, f"a double, {ML.LABEL} double")
    assert ML.first_split(ML.fit(df, ML.stump(), ["a"]), ["a"]) == (None, None, 5.0, 5.0)


def test_feature_columns_leave_out_label_ids_and_leaks(spark):
    df = spark.createDataFrame([(1, 2, 3, 4.0, 5, "x", 1)],
                               "game_id long, event_num int, score_margin_complete int, "
                               "period double, momentum_40 int, season string, event_type_1 tinyint")
    assert ML.feature_columns(df) == ["period", "event_type_1"]


def test_pipeline_detects_cycles():
    p = Pipeline()
    p.add(Dataset("a", lambda x: x, ("b",)))
    p.add(Dataset("b", lambda x: x, ("a",)))
    with pytest.raises(ValueError):
        p.order()


def test_null_predicate_counts_as_violation(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    rep = Q.expectation_report(df, [("x > 0", F.col("x") > 0)]).first()
    assert (rep.rows, rep.violations) == (2, 1)
