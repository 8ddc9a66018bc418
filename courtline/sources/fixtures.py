"""The two raw ("bronze") inputs, derived from the test tables.

``play_by_play_bronze``: one row per play (from ``events``), with 2 % of the
rows repeated exactly, nulls in the sparse score/description/player columns,
``'TIE'`` margins, an event type the lookup lacks and overtime periods.

``game_bronze``: the game-level side (from ``lineitem`` ⋈ ``orders`` ⋈
``customer``), with every game repeated once per line, so the silver
de-duplication has work to do.

Plan notes for scale: ``nation`` and ``region`` are fixed 25- and 5-row
dimension tables at every scale factor, so they are broadcast explicitly.
The fact-to-fact joins (events ⋈ orders, lineitem ⋈ orders ⋈ customer) are
left to the planner and AQE: sort-merge by default, turned into a broadcast at
run time only when a side is measured to be small.  Each scan is pruned to the
columns used.  ``tasks`` (the number that a count of the rows asks for, 0: the planner's
choice) deals the larger side of the join by game, so that the operators behind it find
its partitions and need no shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.sources.tables import read_table


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region as (key, name, city); 25 rows at every scale."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    teams = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return teams.selectExpr("n_nationkey AS team_key", "n_name AS team_name",
                            "r_name AS team_city")


def _side(teams: DataFrame, prefix: str) -> DataFrame:
    return F.broadcast(teams.selectExpr(f"team_key AS {prefix}_key", f"team_name AS {prefix}_name",
                                        f"team_city AS {prefix}_city"))


# Column expressions of the play-level input, as SQL text (parsed once on the
# JVM side; the same text runs in the DuckDB oracle).
_PLAY_EXPRS = [
    "user_id AS game_id",
    "event_id AS event_num",
    "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 "
    "WHEN 'signup' THEN 4 ELSE 11 END AS event_type",
    "1 + CAST(floor((day(ts) - 1) / 6.0) AS INT) AS period",
    "CAST(floor((day(ts) - 1) * 48 / 30.0) AS INT) AS minute_game",
    "CAST(2018 + user_id % 5 AS STRING) || '-' || CAST(19 + user_id % 5 AS STRING) AS season",
    "o_orderdate AS game_date",
    "lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')"
    " || ':00' AS wc_time_string",
    "home_city AS home_team_city", "home_name AS home_team_name",
    "away_city AS away_team_city", "away_name AS away_team_name",
    "CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 7 = 0 THEN 'TIE' "
    "ELSE CAST(k % 41 - 20 AS STRING) END END AS score_margin",
    "CASE WHEN event_type = 'purchase' THEN CAST(k % 120 AS INT) END AS home_score",
    "CASE WHEN event_type = 'purchase' THEN CAST(k % 113 AS INT) END AS away_score",
    "CASE WHEN event_type = 'purchase' THEN CAST(k % 113 AS STRING) || ' - ' || "
    "CAST(k % 120 AS STRING) END AS score",
    "CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'Home' ELSE 'Away' END "
    "END AS team_leading",
    "CASE WHEN k % 3 <> 0 THEN 'h ' || event_type END AS home_description",
    "CASE WHEN k % 3 <> 1 THEN 'v ' || event_type END AS visitor_description",
    "CASE WHEN k % 25 = 0 THEN 'n' END AS neutral_description",
    "CAST(4 + k % 2 AS INT) AS person1type",
    "CASE WHEN k % 3 = 0 THEN 5 ELSE 0 END AS person2type",
    "CASE WHEN k % 20 = 0 THEN CAST(k % 12 AS INT) END AS player3_id",
    "CASE WHEN event_id % 10 <> 0 THEN 'Player_' || CAST(k % 12 AS STRING) END AS player1_name",
    "'T' || CAST(CASE WHEN k % 2 = 0 THEN home_key ELSE away_key END AS STRING)"
    " AS player1_team_abbreviation",
    "CASE WHEN k % 3 <> 0 THEN 'T' || CAST(CASE WHEN k % 2 = 0 THEN away_key ELSE home_key END"
    " AS STRING) END AS player2_team_abbreviation",
]


def play_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games of both sides of the play-level join, one row for each row that it reads."""
    events = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("game_id"))
    return events.unionAll(read_table(spark, sf_dir, "orders").select("o_orderkey"))


def play_by_play_bronze(spark: SparkSession, sf_dir: str, tasks: int = 0,
                        hot: DataFrame | None = None) -> DataFrame:
    """``hot`` (few rows: ``__k0``, a game, and ``__tasks``): the events of these games are
    dealt to so many tasks each, by their rows' numbers in the files, and meet their order there."""
    # every 50th event appears twice: one scan, each row emitted once or twice
    columns = ["event_id", "ts", "user_id", "event_type", "CAST(round(value * 100) AS BIGINT) AS k"]
    ev = read_table(spark, sf_dir, "events")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    if hot is None:
        ev = ev.selectExpr(*columns)
        met = F.col("user_id") == F.col("o_orderkey")
    else:
        hot = F.broadcast(hot)
        ev = ev.selectExpr(*columns, "_metadata.row_index AS row").join(
            hot, F.col("user_id") == F.col("__k0"), "left").selectExpr(
            "* EXCEPT (row, __k0, __tasks)", "coalesce(pmod(row, __tasks), 0) AS place")
        orders = orders.join(hot, F.col("o_orderkey") == F.col("__k0"), "left").selectExpr(
            "* EXCEPT (__k0, __tasks)", "explode(sequence(0L, coalesce(__tasks, 1) - 1L)) AS order_place")
        met = (F.col("user_id") == F.col("o_orderkey")) & (F.col("place") == F.col("order_place"))
    if tasks:
        ev = ev.repartition(tasks, "user_id", *([] if hot is None else ["place"]))
    ev = ev.selectExpr(
        "*", "CAST(user_id % 25 AS INT) AS home_key",
        "CAST((user_id * 7 + 3) % 25 AS INT) AS away_key",
        "explode(IF(event_id % 50 = 0, array(1, 2), array(1))) AS copy")
    teams = _teams(spark, sf_dir)
    df = ev.join(orders, met, "inner")
    df = df.join(_side(teams, "home"), "home_key").join(_side(teams, "away"), "away_key")
    return df.selectExpr(*_PLAY_EXPRS)


def game_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")


def game_bronze(spark: SparkSession, sf_dir: str, tasks: int = 0) -> DataFrame:
    li = game_lines(spark, sf_dir)
    if tasks:
        li = li.repartition(tasks, "l_orderkey")
    li = li.selectExpr("*", "CAST((l_orderkey * 7 + 3) % 25 AS INT) AS away_key")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    teams = _teams(spark, sf_dir)
    # the lines, of which there are most, are joined last and stay where their order is
    orders = orders.join(cust, orders.o_custkey == cust.c_custkey)
    df = li.join(orders, li.l_orderkey == orders.o_orderkey)
    home = _side(teams, "home")
    df = df.join(home, df.c_nationkey == F.col("home_key")).join(_side(teams, "away"), "away_key")
    return df.selectExpr(
        "l_orderkey AS game_id",
        "l_linenumber AS event_num",
        "o_orderdate AS game_date",
        "CAST(year(o_orderdate) AS STRING) || '-' || right(CAST(year(o_orderdate) + 1 AS STRING), 2)"
        " AS season",
        "home_key AS home_team_id", "home_name AS home_team_name",
        "away_key AS away_team_id", "away_name AS away_team_name",
        "CAST(80 + o_custkey % 50 AS INT) AS home_team_score",
        "CAST(80 + o_orderkey % 47 AS INT) AS away_team_score",
    )


CSV_SCHEMA = "game_id BIGINT, event_num BIGINT, event_name STRING, points DOUBLE, played_at TIMESTAMP_NTZ, note STRING"

# One event as a line of CSV: quotes are doubled, every 5th note has a line break, every
# 11th is empty; every 50th line has a number that is none, every 70th lacks a field.
_CSV_LINE = [
    "CAST(user_id AS STRING)",
    "IF(event_id % 50 = 0, 'x' || event_id, CAST(event_id AS STRING))",
    "event_type",
    "CAST(value AS STRING)",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "IF(event_id % 11 = 0, '', '\"' || replace(props, '\"', '\"\"') || IF(event_id % 5 = 0, '\n', ', ')"
    " || 'by \"\"' || event_type || '\"\"\"')",
]


def event_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """A folder of CSV files of all events, some lines malformed."""
    ev = read_table(spark, sf_dir, "events").selectExpr("event_id", *[f"{e} AS f{i}" for i, e in enumerate(_CSV_LINE)])
    names = ",".join(part.split()[0] for part in CSV_SCHEMA.split(", "))
    line = F.when(F.col("event_id") % 70 == 0, F.concat_ws(",", "f0", "f1", "f2", "f3")).otherwise(
        F.concat_ws(",", *[f"f{i}" for i in range(len(_CSV_LINE))]))
    # files without a header would lose their first line: each partition begins with one
    lines = ev.select(F.concat(F.when(F.monotonically_increasing_id() % (1 << 33) == 0, F.lit(names + "\n"))
                               .otherwise(""), line).alias("value"))
    lines.write.mode("overwrite").text(path)
    return path
