"""Feature engineering and profiling operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from courtline.operators import features as FT
from courtline.operators import profile as PR
from courtline.plans import params as P
from courtline.plans.queries import Inputs


def test_one_hot_indicators(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "a")], "id int, t string")
    out = FT.one_hot(df, {"t": ["a", "b", "c"]})
    assert out.columns == ["id", "t_a", "t_b", "t_c"]
    sums = {r.id: r.t_a + r.t_b for r in out.collect()}
    assert sums == {1: 1, 2: 1, 3: 0, 4: 1}
    report = FT.unlisted(df, {"t": ["a"]}).first()
    assert (report.expectation, report.rows, report.violations) == ("t is listed", 4, 1)


def test_one_hot_compares_in_the_type_of_the_column(spark):
    df = spark.createDataFrame([(0.1,), (0.25,)], "x float")
    rows = [tuple(r) for r in FT.one_hot(df, {"x": [0.1, 0.25]}).collect()]
    assert rows == [(1, 0), (0, 1)]
    assert FT.unlisted(df, {"x": [0.1, 0.25]}).first().violations == 0


def test_single_team_feature_table(spark):
    base = Inputs(spark, SF_SMALL).feature_base
    one = FT.feature_table(base, P.ONE_HOT_VALUES, home_team=P.HOME_TEAM)
    every = FT.feature_table(base, P.ONE_HOT_VALUES)
    assert one.columns == every.columns and not any(" " in c for c in one.columns)
    assert {r.home_team for r in one.select("home_team").distinct().collect()} <= {P.HOME_TEAM}


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([("A", "B"), ("B", "C")], "home_team string, away_team string")
    out = FT.rename_teams(df, {"A": "B", "B": "C"}).collect()
    assert [(r.home_team, r.away_team) for r in out] == [("B", "C"), ("C", "C")]


def test_calendar_season_clock(spark):
    df = spark.createDataFrame([("2023-02-14", "2022-23", "9:05:07")],
                               "game_date string, season string, wc_time_string string")
    out = FT.clock_time(FT.season_features(FT.calendar_features(df))).first()
    assert (out.game_month, out.game_day) == (2, 14)
    assert (out.game_year, out.season_two_digits) == (2022, 23)
    assert out.time_of_day == "09:05:07"


def test_clock_texts(spark):
    texts = ["7:05 PM", "12:00 am", "19:05", "9:05:07", "10:11:12 pm", "noon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "wc_time_string string")
    assert [r.time_of_day for r in FT.clock_time(df).collect()] == [
        "19:05:00", "00:00:00", "19:05:00", "09:05:07", "22:11:12", None, None, None]
    dates = spark.createDataFrame([("2023-02-14",), ("not a date",)], "game_date string")
    assert [r.game_month for r in FT.calendar_features(dates).collect()] == [2, None]


def test_quantiles_with_one_extreme_value(spark):
    df = spark.range(20_000).select((F.col("id") / 100).alias("x")).union(
        spark.range(1).select(F.lit(1e9).alias("x")))
    got = PR.describe(df, ["x"]).first()
    assert (got.p25, got.p50, got.p75) == (50.0, 100.0, 150.0)


@pytest.mark.parametrize("limit,margin", [(20_000, PR.BRACKET_MARGIN), (40, PR.BRACKET_MARGIN), (20_000, 1e-9)])
def test_exact_ranks(spark, monkeypatch, limit, margin):
    """Also with brackets that must be narrowed again, and with ones too narrow at first."""
    monkeypatch.setattr(PR, "BRACKET_VALUES", limit)
    rng = np.random.default_rng(2)
    n = 8_000
    data = {"normal": rng.normal(size=n), "ties": np.where(rng.random(n) < 0.9, 3.0, rng.integers(0, 9, n)),
            "wide": rng.normal(size=n) * 10.0 ** rng.integers(-3, 9, n),
            "ends": np.where(rng.random(n) < 0.1, np.inf, np.where(rng.random(n) < 0.1, -np.inf, rng.normal(size=n)))}
    rows = [tuple(None if rng.random() < 0.05 else float(v) for v in r) for r in zip(*data.values())]
    rows += [(float("nan"), 1.0, None, 0.0)] * 7
    df = spark.createDataFrame(rows, "normal double, ties double, wide double, ends double").repartition(5)
    ranks, want = {}, {}
    for i, c in enumerate(df.columns):
        held = np.sort([r[i] for r in rows if r[i] is not None])
        ranks[c] = [0, 1, len(held) // 4, len(held) // 2, len(held) // 2 + 1, len(held) - 8, len(held) - 1]
        want |= {(c, r): held[r] for r in ranks[c]}
    got = PR.exact_ranks(df, {c: F.col(c) for c in df.columns}, ranks, margin)
    assert set(got) == set(want)
    assert all(got[k] == want[k] or (math.isnan(got[k]) and math.isnan(want[k])) for k in want)


def test_describe_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(PR, "materialize", lambda *a: pytest.fail("wrote"))
    df = spark.range(50_000).selectExpr("id * 1.5 a", "cast(null as int) b", "id % 7 c")
    got = {r.column_name: r for r in PR.describe(df, ["a", "b", "c"]).collect()}
    assert got["a"].p50 == 37499.25 and got["b"].p50 is None and (got["c"].p25, got["c"].p75) == (1.0, 5.0)


def test_histograms_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, 5, None), (2.0, 5, None), (None, 5, None)], "a double, b int, c int")
    rows = {(r.column_name, r.bin): r["count"] for r in PR.histograms(df, ["a", "b", "c"], 2).collect()}
    assert rows == {("a", 1): 1, ("a", 2): 1, ("b", 1): 3, ("b", 2): 0}
    assert PR.histogram(df, "a", 2).columns == ["bin", "lower", "upper", "count"]


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Away Team` int, `X` int")
    assert FT.normalize_names(df).columns == ["away_team", "x"]


def test_momentum_drops_warmup(spark):
    i = Inputs(spark, SF_SMALL)
    base = i.silver.select("game_id", "event_num", "score_margin_complete")
    out = FT.momentum(base, 40)
    per_game = {r.game_id: r.n for r in base.groupBy("game_id").agg(F.count("*").alias("n")).collect()}
    expected = sum(max(0, n - 40) for n in per_game.values())
    assert out.count() == expected
    bad = out.filter(F.col("momentum_40") != F.col("score_margin_complete")
                     - F.col("score_margin_40_events_ago")).count()
    assert bad == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "v double")
    h = {r.bin: (r.lower, r.upper, r["count"]) for r in PR.histogram(df, "v", 5).collect()}
    assert h[1] == (0.0, 2.0, 2) and h[2] == (2.0, 4.0, 2)
    assert h[5] == (8.0, 10.0, 1)              # top edge closed
    assert sum(c for _, _, c in h.values()) == 6
    const = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert {r.bin: r["count"] for r in PR.histogram(const, "v", 4).collect()}[1] == 2


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(float(x), x % 3) for x in [5, 1, 9, 2, 7, 7, 3]], "a double, b int")
    d = {r.column_name: r for r in PR.describe(df, ["a", "b"]).collect()}
    pdf = df.toPandas()
    for c in ("a", "b"):
        ref = pdf[c].describe()
        assert d[c]["count"] == ref["count"]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert math.isclose(d[c][ours], ref[theirs], rel_tol=1e-9), (c, ours)
    approx = {r.column_name: r for r in PR.describe(df, ["a"], approx=True).collect()}
    assert approx["a"]["count"] == 7


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)],
                               "a double, b double, c double")
    m = {(r.column_a, r.column_b): r.corr for r in PR.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None
    assert m[("a", "a")] == 1.0 and m[("a", "b")] == m[("b", "a")] > 0.99
    low = PR.corr_lower_triangle(df, ["a", "b", "c"]).collect()
    assert len(low) == 3 and all(r.i > r.j for r in low)


def test_game_names(spark):
    df = spark.createDataFrame(
        [(1, "2022-23", "T2", None), (1, "2022-23", "T1", "T2"), (2, "2021-22", None, None)],
        "game_id long, season string, player1_team_abbreviation string, "
        "player2_team_abbreviation string")
    names = {r.game_id: r.game_name for r in PR.game_names(df).collect()}
    assert names == {1: "2022-23-T1-T2", 2: "2021-22-"}


def test_official_team_filters(spark):
    i = Inputs(spark, SF_SMALL)
    s = i.silver
    both = FT.official_teams(s, P.OFFICIAL_TEAMS, True).count()
    either = FT.official_teams(s, P.OFFICIAL_TEAMS, False).count()
    assert 0 < both < either <= s.count()


def test_regression_metrics_bounds(spark):
    from courtline.operators.modeling import regression_metrics
    df = spark.createDataFrame([(1, 1.5), (3, 2.0), (-2, 0.5), (4, 4.0)],
                               "score_margin_complete int, prediction double")
    m = regression_metrics(df).first()
    assert m.rows == 4 and m.mae >= 0 and m.mse >= 0 and m.r2 <= 1
    assert m.mae == round((0.5 + 1 + 2.5 + 0) / 4, 3) and m.mse == round((0.25 + 1 + 6.25 + 0) / 4, 3)
    perfect = regression_metrics(df.withColumn("prediction", F.col("score_margin_complete")))
    assert perfect.first().r2 == 1.0


def _categories(spark):
    return spark.createDataFrame(
        [(1, 10, "b", 1.5), (2, 9, "a", -2.0), (3, None, "b", None), (4, 10, None, 1.5), (5, 100, "c c", 30.0)],
        "id int, kind int, team string, rate double")


def test_discovered_categories_are_numbered_by_type(spark):
    got = FT.category_dictionary(_categories(spark), ["kind", "team", "rate"]).collect()
    assert sorted((r.column_name, r.code, r.value) for r in got) == [
        ("kind", 0, "9"), ("kind", 1, "10"), ("kind", 2, "100"), ("rate", 0, "-2.0"), ("rate", 1, "1.5"),
        ("rate", 2, "30.0"), ("team", 0, "a"), ("team", 1, "b"), ("team", 2, "c c")]


def test_many_categories_are_numbered_without_gaps_by_several_tasks(spark):
    df = spark.range(5000).selectExpr("id * 7919 % 5003 k", "cast(id % 3 as string) s")
    got = FT.category_dictionary(df, ["k", "s"])
    ks = [(r.code, int(r.value)) for r in got.filter("column_name = 'k'").orderBy("code").collect()]
    assert [i for i, _ in ks] == list(range(5000)) and [v for _, v in ks] == sorted(v for _, v in ks)
    assert got.filter("column_name = 's'").count() == 3


def test_sparse_indicators_agree(spark):
    df, cols = _categories(spark), ["kind", "team"]
    dictionary = FT.category_dictionary(df, cols).cache()
    more = df.unionByName(spark.createDataFrame([(6, 7, "new", 0.0)], df.schema))  # values unknown to it
    spots = {r.id: r.positions for r in FT.one_hot_positions(more, dictionary, cols).collect()}
    assert spots == {1: [1, 4], 2: [0, 3], 3: [4], 4: [1], 5: [2, 5], 6: []}
    vectors = {r.id: r.indicators for r in FT.one_hot_vector(more, dictionary, cols).collect()}
    assert all(v.size == 6 and np.flatnonzero(v.toArray()).tolist() == spots[i] for i, v in vectors.items())
    # the declared form makes the same ones
    wide = FT.one_hot(df, {"kind": [9, 10, 100], "team": ["a", "b", "c c"]})
    names = ["kind_9", "kind_10", "kind_100", "team_a", "team_b", "team_c c"]
    for r in wide.collect():
        assert [i for i, n in enumerate(names) if r[n]] == spots[r.id]
    assert FT.one_hot_vector(df.filter("id < 0"), dictionary, cols).count() == 0


def test_correlations_of_columns_with_different_nulls(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4)) + 1e6
    rows = [tuple(None if rng.random() < 0.3 else float(v) for v in r) for r in base]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.column_a, r.column_b): r.corr for r in PR.corr_matrix(df, df.columns, 9).collect()}
    want = df.toPandas().corr()
    assert all(abs(got[x, y] - want.loc[x, y]) < 1e-7 for x in df.columns for y in df.columns)
    one = PR.corr_matrix(df.limit(1), ["a", "b"]).collect() + PR.corr_matrix(df.filter("a > 0 and a < 0"), ["a"]).collect()
    assert [r.corr for r in one] == [None] * 5


def test_correlations_take_fewer_than_thirty_aggregates(spark):
    from courtline.functions.constants import PROFILE_NUMERIC_COLUMNS as cols
    taken = []
    df = spark.range(3).selectExpr(*[f"id * {i} {c}" for i, c in enumerate(cols)])
    group = type(df).groupBy
    def watched(self, *keys):
        found = group(self, *keys)
        class Counted:
            def agg(self, *a):
                taken.append(len(a))
                return found.agg(*a)
        return Counted()
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "groupBy", watched)
        PR.co_moments(df, cols)
    assert taken == [28]
