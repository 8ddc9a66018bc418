"""Silver/gold semantics on small hand-made frames and on the sf0.001 fixture."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from courtline.operators import medallion as M
from courtline.operators import quality as Q
from courtline.plans.queries import Inputs

RAW = ("game_id long, event_num string, event_type string, `season.x` string, "
       "home_team_city string, home_team_name string, away_team_city string, "
       "away_team_name string, home_description string, visitor_description string, "
       "score string, away_score int, home_score int, score_margin string, team_leading string")


def _raw(spark):
    rows = [
        (1, "2", "1", "2022-23", "Toronto", "Raptors", "Boston", "Celtics", "a", "b",
         None, None, None, None, None),
        (1, "10", "2", "2022-23", "Toronto", "Raptors", "Boston", "Celtics", None, "b",
         "2 - 0", 2, 0, "TIE", "Home"),
        (1, "9", "1.0", "2022-23", "Toronto", "Raptors", "Boston", "Celtics", "a", None,
         "0 - 2", 0, 2, "-2", "Away"),
        (1, "11", "x", "2022-23", "Toronto", "Raptors", "Boston", "Celtics", "a", "b",
         None, None, None, None, None),
        (1, "11", "x", "2022-23", "Toronto", "Raptors", "Boston", "Celtics", "a", "b",
         None, None, None, None, None),
        (2, "1", "3", "2021-22", None, "Nets", "Utah", "Jazz", "a", "b",
         None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, RAW)


def test_silver_steps(spark):
    silver = M.play_by_play_silver(_raw(spark)).orderBy("game_id", "event_num")
    rows = silver.collect()
    assert len(rows) == 5                      # exact copy removed
    r = {(x.game_id, x.event_num): x for x in rows}
    # event_num ordered numerically (9 before 10), so 10 carries TIE -> 0
    assert r[(1, 9)].score_margin == -2
    assert r[(1, 10)].score_margin == 0
    assert r[(1, 11)].score_margin == 0 and r[(1, 11)].score == "2 - 0"
    assert r[(1, 2)].score_margin is None and r[(1, 2)].score_margin_complete == 0
    assert r[(1, 2)].score_complete == "0 - 0" and r[(1, 2)].team_leading_complete == "Home"
    assert r[(1, 9)].event_type == 1          # '1.0' -> 1
    assert r[(1, 11)].event_type is None      # 'x' -> null, no ANSI error
    assert r[(1, 2)].home_team == "Toronto_Raptors"
    assert r[(2, 1)].home_team is None        # null city -> null team
    assert r[(1, 10)].play_description is None
    assert r[(1, 2)].play_description == "ab"
    assert r[(1, 2)].season == "2022-23"
    assert r[(1, 9)].event_column == 9


def test_dedup_idempotent_and_gold_sums(spark):
    i = Inputs(spark, SF_SMALL)
    silver = i.silver
    n = silver.count()
    assert M.dedup(silver).count() == n
    for gold in (M.play_by_event_gold(silver), M.play_by_event_team_gold(silver),
                 M.play_by_player_gold(silver)):
        assert gold.agg(F.sum("count")).first()[0] == n
    games = i.game_silver
    g = games.count()
    assert games.select("game_id").distinct().count() == g
    for gold in (i.home_gold, i.away_gold):
        assert gold.agg(F.sum("count")).first()[0] == g


def test_fixture_sizes(spark):
    i = Inputs(spark, SF_SMALL)
    assert i.bronze.count() == 1020
    assert i.silver.count() == 1000
    assert Q.duplicate_count(i.bronze).first()["duplicate_rows"] == 20


def test_large_event_numbers_stay(spark):
    df = spark.createDataFrame([("5000000000",), ("9007199254740993",), ("12.0",), ("x",)], "event_num string")
    got = [r.event_num for r in M.type_play_columns(df).collect()]
    assert got == [5000000000, 9007199254740993, 12, None]


def test_fill_repeats_copies_afterwards(spark, monkeypatch):
    monkeypatch.setattr(M, "COPIES_PER_ARRAY", 3)
    rows = [(1, 1, 5)] * 7 + [(1, 2, None)] * 4 + [(1, 3, 9)]
    df = spark.createDataFrame(rows, "game_id long, event_num long, score_margin int")
    for segment_rows in (2, None):
        out = M.fill_with_copies(df, segment_rows)
        assert sorted(map(tuple, out.collect())) == [(1, 1, 5)] * 7 + [(1, 2, 5)] * 4 + [(1, 3, 9)]


def test_silver_scans_the_events_once(spark):
    plan = Inputs(spark, SF_SMALL).silver._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_id#") and plan.count("Relation [event_id") == 1


def test_expectation_observation(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    out, obs = Q.expect(df, "x not null", F.col("x").isNotNull())
    assert out.count() == 3                     # warn mode keeps rows
    assert obs.get["violations"] == 1
    rep = Q.expectation_report(df, [("x's not null", F.col("x").isNotNull())]).first()
    assert (rep.rows, rep.violations) == (3, 1)


def test_sparse_and_null_profile(spark):
    rows = [(i, None if i < 10 else "a", None if i < 9 else 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, s string, d double")
    sparse = {r.column_name: r.kind for r in Q.sparse_columns(df, 0.9).collect()}
    assert sparse == {"s": "string"}          # d is exactly 90 % null: not strictly above
    nulls = {r.column_name: r.null_count for r in Q.null_counts(df).collect()}
    assert nulls == {"id": 0, "s": 10, "d": 9}
    info = {r.column_name: (r.position, r.data_type, r.non_null)
            for r in Q.column_info(df).collect()}
    assert info["d"] == (2, "double", 1)


def test_silver_with_hot_game_matches_plain_window(spark):
    """One game holds most rows; segmented silver equals the one-window silver."""
    import random
    rnd = random.Random(3)
    rows = []
    for g, n in [(1, 400), (2, 15), (3, 9)]:
        for e in range(n):
            purchase = rnd.random() < 0.2
            rows.append((g, str(e * 3), "1", "2022-23", "A", "B", "C", "D", "x", "y",
                         f"{e} - 1" if purchase else None, e if purchase else None,
                         1 if purchase else None,
                         rnd.choice(["TIE", "3", "-4"]) if purchase else None,
                         "Home" if purchase else None))
    raw = spark.createDataFrame(rows + rows[:20], RAW)
    seg = M.play_by_play_silver(raw, segment_rows=16)
    plain = M.play_by_play_silver(raw, segment_rows=None)
    cols = sorted(seg.columns)
    assert sorted(seg.columns) == sorted(plain.columns)
    from collections import Counter
    assert Counter(map(tuple, seg.select(cols).collect())) == \
        Counter(map(tuple, plain.select(cols).collect()))
    assert seg.count() == 424
