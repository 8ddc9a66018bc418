"""Analyst queries over the gold tables (dashboard data).

All joins are left to the planner.  The event lookup has 12 rows, which it sees, and
broadcasts it.  Of the home ⋈ away team join both sides are grouped by (team, season),
and AQE turns the sort-merge join into a broadcast at run time only if a side is
measured to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtline.functions.constants import EVENT_TYPE_LOOKUP

LOOKUP_SCHEMA = "event_id INT, event_name STRING"


def event_type_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_TYPE_LOOKUP, LOOKUP_SCHEMA)


def _named(gold: DataFrame, lookup: DataFrame, how: str = "inner") -> DataFrame:
    # the planner broadcasts the lookup if its measured size allows
    lk = lookup.select("event_id", "event_name")
    return gold.join(lk, gold.event_type == lk.event_id, how)


def season_event_counts(event_gold: DataFrame, lookup: DataFrame) -> DataFrame:
    """Plays per (season, event name), newest season first."""
    return (_named(event_gold, lookup)
            .select("season", F.col("event_name").alias("event_type"), "count")
            .orderBy(F.desc("season"), "event_type"))


def player_season_event_counts(player_gold: DataFrame, lookup: DataFrame) -> DataFrame:
    """Plays per (season, event name, player), newest season first."""
    return (_named(player_gold, lookup)
            .select("season", F.col("event_name").alias("event_type"), "player1_name", "count")
            .orderBy(F.desc("season"), "event_type", F.asc_nulls_first("player1_name")))


def team_stats_margin(home_gold: DataFrame, away_gold: DataFrame,
                      excluded_teams: Sequence[str] = ()) -> DataFrame:
    """Home vs away averages per (team, season), with the rounded margin.

    ``NOT IN`` keeps SQL's three-valued logic: a null team name is dropped.
    """
    h = home_gold.alias("h")
    a = away_gold.alias("a")
    j = h.join(a, (F.col("h.home_team_name") == F.col("a.away_team_name"))
               & (F.col("h.season") == F.col("a.season")))
    if excluded_teams:
        j = j.filter(~F.col("h.home_team_name").isin(list(excluded_teams)))
    return j.select(
        F.col("h.home_team_name").alias("team_name"),
        F.col("h.season").alias("season"),
        F.col("h.count").alias("count_home"),
        F.col("a.count").alias("count_away"),
        F.col("h.avg_points_for").alias("avg_points_for_home"),
        F.col("a.avg_points_for").alias("avg_points_for_away"),
        (F.round(F.col("h.avg_points_for") - F.col("a.avg_points_for"), 0) + F.lit(0.0))
        .alias("margin"),
        F.col("h.avg_points_against").alias("avg_points_against_home"),
        F.col("a.avg_points_against").alias("avg_points_against_away"),
    )


def shots_made_by_players(player_gold: DataFrame, lookup: DataFrame,
                          players: Sequence[str], event_name: str = "Shot Made") -> DataFrame:
    """Counts of one event for chosen players over seasons.

    Written as the original left join; the filter on the lookup side makes it
    an inner join, which Catalyst rewrites.
    """
    j = _named(player_gold, lookup, "left")
    return (j.filter((F.col("event_name") == event_name)
                     & F.col("player1_name").isin(list(players)))
            .select("season", F.col("player1_name").alias("player_name"), "event_name", "count")
            .orderBy("event_name", F.desc("count"), "season", "player_name"))


def latest_seasons(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recent distinct seasons (a top-k, bounded by ``n``)."""
    return df.select("season").distinct().orderBy(F.desc_nulls_last("season")).limit(n)


def top_events_by_player(player_gold: DataFrame, lookup: DataFrame, k: int = 3,
                         n_seasons: int = 10) -> DataFrame:
    """Per season (latest ``n_seasons``), the (event, player) rows ranked in the
    top ``k`` by count; ties share a rank, so more than ``k`` rows may appear.

    The season list is bounded by ``n_seasons`` rows, so the semi-join
    broadcasts it; ``rank() <= k`` becomes a partial/final WindowGroupLimit, so
    each map task keeps only its own top rows before the shuffle by season.
    """
    top = F.broadcast(latest_seasons(player_gold, n_seasons))
    p = (player_gold.filter(F.col("player1_name").isNotNull())
         .join(top, "season", "left_semi"))
    ranked = (_named(p, lookup)
              .select("season", F.col("event_name").alias("event_type"), "player1_name", "count",
                      F.rank().over(Window.partitionBy("season").orderBy(F.desc("count")))
                      .alias("ranking")))
    return ranked.filter(F.col("ranking") <= k).drop("ranking")


def avg_points_home_away(margin_table: DataFrame) -> DataFrame:
    return margin_table.select("season", "team_name", "avg_points_for_home", "avg_points_for_away")


def plays_per_event_name(silver: DataFrame, lookup: DataFrame) -> DataFrame:
    """Every lookup row with the number of plays of that type (0 if none)."""
    counts = silver.groupBy("event_type").agg(F.count(F.lit(1)).alias("plays"))
    j = lookup.join(counts, lookup.event_id == counts.event_type, "left")
    return j.select("event_id", "event_name",
                    F.coalesce("plays", F.lit(0).cast("long")).alias("plays"))
