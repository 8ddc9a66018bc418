"""Hot groups, cut by rows, give what the plain window gives."""

import random

import pytest
from pyspark.sql import functions as F

from courtline.operators import windows
from courtline.operators.windows import (forward_fill, hot_cuts, lag_all_columns, lag_rows, row_digest,
                                         with_segment)


def _frame(spark, seed=7, hot_rows=300, small_games=6, spread=1):
    rnd = random.Random(seed)
    rows = []
    # one hot game with most of the rows, a few ordinary games
    for g, n in [(1, hot_rows)] + [(g, rnd.randint(1, 30)) for g in range(2, 2 + small_games)]:
        nums = rnd.sample(range(0, n * 5), n)
        for e in nums:
            v = rnd.choice([None, None, None, rnd.randint(-20, 20)])
            s = rnd.choice([None, None, f"{rnd.randint(0, 99)} - {rnd.randint(0, 99)}"])
            rows.append((g, e * spread, v, s))
    return spark.createDataFrame(rows, "game_id long, event_num long, margin int, score string")


def _rows(df, cols):
    return sorted(repr(tuple(r)) for r in df.select(*cols).collect())  # text, as NaN != NaN


@pytest.mark.parametrize("rows", [2, 7, 50, 1000])
def test_forward_fill_of_hot_groups_equals_plain(spark, rows):
    df = _frame(spark)
    cols = ["game_id", "event_num", "margin", "score"]
    plain = forward_fill(df, ["margin", "score"], segment_rows=None)
    cut = forward_fill(df, ["margin", "score"], segment_rows=rows)
    assert _rows(cut, cols) == _rows(plain, cols)


def test_forward_fill_properties(spark):
    df = _frame(spark)
    once = forward_fill(df, ["margin"], segment_rows=9)
    twice = forward_fill(once, ["margin"], segment_rows=9)
    assert _rows(once, once.columns) == _rows(twice, twice.columns)
    # no null after the first non-null within a game
    pdf = once.toPandas().sort_values(["game_id", "event_num"])
    for _, g in pdf.groupby("game_id"):
        seen = False
        for v in g["margin"]:
            if v == v and v is not None:
                seen = True
            elif seen:
                raise AssertionError("null after a non-null value")


@pytest.mark.parametrize("rows", [1, 3, 13, 1000])
@pytest.mark.parametrize("n", [1, 5, 40])
def test_lag_of_hot_groups_equals_plain(spark, rows, n):
    df = _frame(spark)
    cols = ["game_id", "event_num", "margin", "m_lag"]
    plain = lag_rows(df, "margin", n, "m_lag", segment_rows=None)
    cut = lag_rows(df, "margin", n, "m_lag", segment_rows=rows)
    assert _rows(cut, cols) == _rows(plain, cols)


def test_null_keys_and_ties(spark):
    """Null group and order keys match each other; ties are ordered by the tiebreak."""
    rnd = random.Random(3)
    rows = [(g, rnd.choice([None, *range(6)]), i, rnd.choice([None, i]))
            for i, g in enumerate([1] * 60 + [None] * 40 + [2] * 5)]
    df = spark.createDataFrame(rows, "game_id long, event_num long, id int, margin int")
    cols = ["game_id", "event_num", "id", "margin"]
    for n in (1, 4):
        plain = lag_rows(df, "margin", n, "out", tiebreak=["id"], segment_rows=None)
        cut = lag_rows(df, "margin", n, "out", tiebreak=["id"], segment_rows=8)
        assert _rows(cut, [*cols, "out"]) == _rows(plain, [*cols, "out"])
    plain = forward_fill(df, ["margin"], tiebreak=["id"], segment_rows=None)
    cut = forward_fill(df, ["margin"], tiebreak=["id"], segment_rows=8)
    assert _rows(cut, cols) == _rows(plain, cols)


def test_lag_meets_rows_before_null_order_keys(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 1, 3), (1, 2, 4), (1, 3, 5)],
                               "game_id long, event_num long, id int")
    for rows in (2, None):
        got = {r.id: r.prev for r in lag_rows(df, "id", 1, "prev", tiebreak=["id"], segment_rows=rows).collect()}
        assert got == {1: None, 2: 1, 3: 2, 4: 3, 5: 4}


@pytest.mark.parametrize("spread", [1, 1000])
def test_segments_follow_rows_not_the_key_range(spark, spread):
    df = _frame(spark, hot_rows=400, spread=spread)
    cuts = hot_cuts(df, segment_rows=100)
    assert {r["__k0"] for r in cuts.levels[0].collect()} == {1}
    assert cuts.count <= 400 // 100 and not cuts.inside
    assert hot_cuts(df, segment_rows=1000).empty


def _segment_sizes(df, cuts):
    rows = with_segment(df.withColumn("__digest", row_digest(df)), cuts)
    return {(r["game_id"], r["__seg"]): r["count"] for r in rows.groupBy("game_id", "__seg").count().collect()}


def test_each_game_has_the_cuts_its_own_rows_ask_for(spark):
    """One game of 200,000 rows beside 200 games just above the bound."""
    target = 2000
    big = spark.range(200_000).selectExpr("0 game_id", "id * 7 event_num")
    rest = spark.range(200 * 2100).selectExpr("1 + id % 200 game_id", "id event_num")
    df = big.unionByName(rest)
    cuts = hot_cuts(df, segment_rows=target)
    assert cuts.count <= (200_000 + 200 * 2100) / target + 201
    per_game = {r["__k0"]: r["n"] for r in cuts.levels[-1].groupBy("__k0").agg(
        F.sum(F.size("__cuts")).alias("n")).collect()}
    assert per_game[0] == 99 and len(cuts.levels) == 2
    assert all(per_game[g] == 1 for g in range(1, 201))
    sizes = _segment_sizes(df, cuts)
    assert max(sizes.values()) <= 2 * target and len(sizes) == cuts.count + 201


@pytest.mark.parametrize("fanout", [2, 3, 64])
def test_search_tree_finds_the_segment(spark, monkeypatch, fanout):
    monkeypatch.setattr(windows, "FANOUT", fanout)
    df = spark.range(3000).selectExpr("id % 3 game_id", "id * id % 1009 event_num")
    cuts = hot_cuts(df, segment_rows=30)
    places = {}
    for r in cuts.levels[-1].orderBy("__node").collect():
        places.setdefault(r["__k0"], []).extend(r["__cuts"])
    rows = with_segment(df.withColumn("__digest", row_digest(df)), cuts).collect()
    for r in rows:
        key = (r["event_num"], 1, r["__digest"])
        assert r["__seg"] == sum(tuple(c) < key if c["m0"] == 1 else tuple(c)[:2] < key[:2]
                                 for c in places[r["game_id"]])


def _tied(spark, n=600):
    rnd = random.Random(5)
    rows = [(1, 7, i, rnd.choice([None, None, rnd.randint(-9, 9)]), f"p{i % 4}") for i in range(n)]
    rows += [(2, rnd.randint(0, 3), i, rnd.choice([None, i]), None) for i in range(n, n + 300)]
    rows += [(3, None, i, rnd.choice([None, i]), None) for i in range(2000, 2200)]
    rows += [(g, i, i, None, "x") for g in (4, 5) for i in range(9)]
    return spark.createDataFrame(rows, "game_id long, event_num long, play int, margin int, player string")


def test_a_run_of_ties_is_cut_inside(spark):
    df = _tied(spark)
    cuts = hot_cuts(df, segment_rows=50)
    assert cuts.inside and cuts.count <= 1118 / 50
    sizes = _segment_sizes(df, cuts)
    assert sum(g == 1 for g, _ in sizes) == 12 and sum(g == 3 for g, _ in sizes) == 4
    # two parts of neighbouring runs can meet in a segment, and digests are dealt by chance
    assert max(sizes.values()) <= 2.5 * 50
    # with a tiebreak the inner cuts follow its values, not the digest
    by_play = hot_cuts(df, tiebreak=["play"], segment_rows=50)
    rows = with_segment(df.withColumn("__digest", row_digest(df)), by_play)
    spans = rows.filter("game_id = 1").groupBy("__seg").agg(
        F.min("play").alias("a"), F.max("play").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("__seg").collect()
    assert len(spans) == 12 and all(x.b < y.a for x, y in zip(spans, spans[1:]))
    assert max(r.n for r in spans) <= 100


@pytest.mark.parametrize("tiebreak", [(), ("play",), ("player",), ("player", "play")])
def test_ties_give_one_result_however_rows_arrive(spark, tiebreak):
    df = _tied(spark)
    cols = ["game_id", "event_num", "play", "margin", "player"]
    want_fill = want_lag = None
    for shuffled in (df.orderBy(F.rand(1)), df.repartition(7, "play")):
        for rows in (None, 20):
            fill = _rows(forward_fill(shuffled, ["margin"], tiebreak=tiebreak, segment_rows=rows), cols)
            lag = _rows(lag_rows(shuffled, "play", 9, "out", tiebreak=tiebreak, segment_rows=rows), [*cols, "out"])
            want_fill, want_lag = want_fill or fill, want_lag or lag
            assert fill == want_fill and lag == want_lag, rows


@pytest.mark.parametrize("kind", ["double", "date", "timestamp", "timestamp_ntz", "decimal(12,2)", "decimal(30,2)",
                                  "string", "smallint"])
def test_order_keys_of_any_type(spark, kind):
    df = spark.range(400).selectExpr("id % 2 game_id", "id play", "IF(id % 5 = 0, id, null) margin",
                                     "cast(id * 37 % 211 as int) n")
    value = {"date": "date_add(DATE'2000-01-01', n)", "timestamp": "TIMESTAMP'2000-01-01' + make_interval(0,0,0,0,0,n)",
             "timestamp_ntz": "TIMESTAMP_NTZ'2000-01-01' + make_interval(0,0,0,0,0,n)",
             "double": "IF(n = 3, double('NaN'), IF(n < 9, null, n / 3D - 20))"}.get(kind, f"cast(n as {kind})")
    df = df.selectExpr("game_id", "play", "margin", f"{value} event_num")
    cuts = hot_cuts(df, segment_rows=20)
    assert (cuts.count > 8) == (kind not in ("string", "decimal(30,2)"))
    cols = ["game_id", "event_num", "play", "margin"]
    for tiebreak in ((), ("play",)):
        plain, cut = (forward_fill(df, ["margin"], tiebreak=tiebreak, segment_rows=n) for n in (None, 20))
        assert _rows(plain, cols) == _rows(cut, cols)
        plain, cut = (lag_rows(df, "play", 3, "out", tiebreak=tiebreak, segment_rows=n) for n in (None, 20))
        assert _rows(plain, [*cols, "out"]) == _rows(cut, [*cols, "out"])


def test_cuts_of_another_order_are_refused(spark):
    df = _tied(spark)
    with pytest.raises(ValueError):
        lag_rows(df, "play", 1, "out", tiebreak=["play"], cuts=hot_cuts(df, segment_rows=50))


def test_ordinary_games_take_the_plain_window(spark):
    df = _frame(spark)
    plan = lag_rows(df, "margin", 40, "out")._jdf.queryExecution().toString()
    assert "__seg" not in plan and "Join" not in plan


def test_lag_all_columns(spark):
    df = _frame(spark)
    a = lag_all_columns(df, 3, segment_rows=4)
    b = lag_all_columns(df, 3, segment_rows=None)
    assert sorted(a.columns) == sorted(b.columns)
    assert _rows(a, b.columns) == _rows(b, b.columns)


def test_lag_first_rows_are_null(spark):
    df = _frame(spark)
    out = lag_rows(df, "event_num", 40, "prev", segment_rows=11)
    per_game = out.groupBy("game_id").agg(F.count(F.lit(1)).alias("n"),
                                          F.count("prev").alias("with_prev")).collect()
    for r in per_game:
        assert r["with_prev"] == max(0, r["n"] - 40)


def _largest_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.mark.parametrize("segment_rows", [1_000_000, 100])
def test_windows_deal_the_counted_rows_to_tasks(spark, monkeypatch, segment_rows):
    """A task's rows follow TASK_ROWS, not the bytes that were shuffled (few here)."""
    monkeypatch.setattr(windows, "TASK_ROWS", 50)
    df = _frame(spark, small_games=60)
    games = df.groupBy("game_id").count().collect()
    rows = sum(r["count"] for r in games)
    cuts = hot_cuts(df, segment_rows=segment_rows)
    assert cuts.rows == rows and cuts.empty == (segment_rows > rows)
    assert cuts.tasks(spark) == max(-(-rows // 50), spark.sparkContext.defaultParallelism)
    cols = ["game_id", "event_num", "margin", "score"]
    filled = forward_fill(df, ["margin", "score"], cuts=cuts)
    assert _rows(filled, cols) == _rows(forward_fill(df, ["margin", "score"], segment_rows=None), cols)
    lagged = lag_rows(df, "margin", 3, "back", cuts=cuts)
    assert _rows(lagged, [*cols, "back"]) == _rows(lag_rows(df, "margin", 3, "back", segment_rows=None), [*cols, "back"])
    if cuts.empty:  # a game stays whole, the others are spread
        for out in (filled, lagged):
            assert _largest_task(out) <= 300 + 150 < rows


def test_few_or_uncounted_rows_are_not_dealt(spark):
    df = _frame(spark)
    assert hot_cuts(df).rows == df.count() and hot_cuts(df).tasks(spark) == 0
    assert hot_cuts(df, segment_rows=None).tasks(spark) == 0
    none = df.limit(0)
    assert hot_cuts(none).rows == 0 and windows.even_tasks(none, ["game_id"], 1) == 0
    assert windows.task_count(spark, 1 << 60, 10) == windows.MAX_TASKS


def test_a_hot_key_is_not_dealt(spark, monkeypatch):
    df = spark.range(3000).selectExpr("IF(id < 500, NULL, id) k")
    cores = spark.sparkContext.defaultParallelism
    assert windows.even_tasks(df, ["k"], 100) == max(30, cores) and windows.even_tasks(df, ["k"], 3000) == 0
    monkeypatch.setattr(windows, "SEGMENT_ROWS", 400)  # 500 nulls
    assert windows.even_tasks(df, ["k"], 100) == 0
