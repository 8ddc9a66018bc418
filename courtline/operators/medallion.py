"""Bronze -> silver -> gold, as plain DataFrame functions.

Silver (play side), in order:
  project_play_columns  keep the play-level columns, season from ``season.x``
  type_play_columns     lenient int casts, ``TIE`` -> 0, ``event_column`` copy
  merge_names           home_team / away_team / play_description
  fill_scores_forward   last non-null score values within a game
  complete_scores       ``*_complete`` copies with defaults for the gaps
  dedup                 whole-row de-duplication

Gold: grouped counts and averages.  Every aggregate is a partial + final hash
aggregate, so a hot key is pre-combined on the map side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.functions import constants as K
from courtline.functions.expressions import col_of, join_names, margin_to_int, to_int
from courtline.operators.windows import SEGMENT_ROWS, Cuts, forward_fill, hot_cuts


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


INT_COLUMNS = ("event_type", "event_action_type", "video_available_flag")
MERGED_COLUMNS = ("home_team_city", "home_team_name", "away_team_city", "away_team_name",
                  "home_description", "visitor_description")


def project_play_columns(bronze: DataFrame, columns: Sequence[str] = K.PLAY_COLUMNS,
                         season_source: str = K.RAW_SEASON_COLUMN) -> DataFrame:
    """Keep the listed columns that exist, plus ``season`` (renamed from ``season.x``)."""
    src = season_source if season_source in bronze.columns else "season"
    cols = [c for c in _present(bronze, columns) if c != "season"]
    return bronze.select(*[col_of(c) for c in cols], col_of(src).alias("season"))


def type_play_columns(df: DataFrame) -> DataFrame:
    """Integer casts that never raise; ``event_num`` itself is cast (to a long, so it
    orders numerically at any size) and ``event_column`` keeps an equal copy."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    if "score_margin" in types:
        exprs["score_margin"] = margin_to_int(F.col("score_margin"), types["score_margin"])
    for c in INT_COLUMNS:
        if c in types:
            exprs[c] = to_int(F.col(c), types[c])
    if "event_num" in types:
        exprs["event_num"] = exprs["event_column"] = to_int(F.col("event_num"), types["event_num"],
                                                            "bigint")
    return df.withColumns(exprs)


def merge_names(df: DataFrame, sep: str = "_") -> DataFrame:
    """Team = city + sep + name; play_description = home + visitor text.
    Each is null when a part is null."""
    return (df
            .withColumns({
                "home_team": join_names(F.col("home_team_city"), F.col("home_team_name"), sep),
                "away_team": join_names(F.col("away_team_city"), F.col("away_team_name"), sep),
                "play_description": join_names(F.col("home_description"),
                                               F.col("visitor_description"), ""),
            })
            .drop(*MERGED_COLUMNS))


SEGMENT_COLUMN = "__event_segment"


def fill_scores_forward(df: DataFrame, cols: Sequence[str] = K.SCORE_COLUMNS,
                        segment_rows: int | None = SEGMENT_ROWS,
                        keep_segment: bool = False, cuts: Cuts | None = None,
                        digest_of: Sequence[str] | None = None) -> DataFrame:
    """Carry the last known score values forward within each game, by event order.

    ``keep_segment`` keeps the event-segment id where it is a function of ``event_num``,
    so the de-duplication after it reuses the window's partitioning.  ``cuts`` and
    ``digest_of``: see ``forward_fill``.
    """
    return forward_fill(df, _present(df, cols), by="game_id", order="event_num",
                        segment_rows=segment_rows, cuts=cuts, digest_of=digest_of,
                        segment_column=SEGMENT_COLUMN if keep_segment else None)


COPIES_PER_ARRAY = 10_000


def fill_with_copies(df: DataFrame, segment_rows: int | None = SEGMENT_ROWS,
                     cuts: Cuts | None = None) -> DataFrame:
    """``fill_scores_forward`` of rows that may be copies.

    Games are counted with their copies, so without a hot game no row has many and the
    plain window runs.  Otherwise a row and its copies are filled as one and repeated
    afterwards, so a row copied many times is no load on its game's window.  Copies
    carry equal values, so the result is the same.
    """
    cuts = hot_cuts(df, segment_rows=segment_rows) if cuts is None else cuts
    if cuts.empty:
        return fill_scores_forward(df, cuts=cuts)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    filled = fill_scores_forward(counted, cuts=cuts, digest_of=df.columns)
    size = F.lit(COPIES_PER_ARRAY)
    # two steps, so that no array is longer than the copies of a chunk
    chunks = filled.select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / size))).alias("__chunk"))
    left = F.least(size, F.col("__copies") - F.col("__chunk") * size)
    return chunks.select("*", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("__i")).select(
        *df.columns)


def complete_scores(df: DataFrame) -> DataFrame:
    """``*_complete`` copies of the score columns, with defaults where still null."""
    out = df.withColumns({
        "score_margin_complete": F.col("score_margin"),
        "score_complete": F.col("score"),
        "away_score_complete": F.col("away_score"),
        "home_score_complete": F.col("home_score"),
        "team_leading_complete": F.col("team_leading"),
    })
    return out.na.fill({k: v for k, v in K.COMPLETE_DEFAULTS.items()})


def dedup(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication (partial aggregation collapses copies map-side).

    Rows that come from the fill's window are already hash-partitioned by game, or,
    if the frame carries its event-segment column, by (game, segment): a subset of the
    whole-row key, so no second shuffle is planned.  The column is a function of
    ``event_num`` and is dropped afterwards.
    """
    out = df.dropDuplicates()
    return out.drop(SEGMENT_COLUMN) if SEGMENT_COLUMN in df.columns else out


def named_plays(bronze: DataFrame, sep: str = "_") -> DataFrame:
    """Projected, typed and named plays: what the fill reads."""
    return merge_names(type_play_columns(project_play_columns(bronze)), sep)


def play_by_play_silver(bronze: DataFrame, sep: str = "_", segment_rows: int | None = SEGMENT_ROWS,
                        cuts: Cuts | None = None) -> DataFrame:
    """Typed, named, filled, completed, de-duplicated plays.

    Without a hot game, copies counted, the plain window fills the raw rows and the
    de-duplication after it reuses its partitioning: one shuffle.  With one, exact copies
    are removed *before* the fill as well as after it.  Before: partial aggregation
    collapses copies map-side, so a row copied a billion times never reaches the
    per-game window as one giant task (copies carry identical fill values, so the
    result is unchanged).  After: rows that only became identical through the fill.
    """
    named = named_plays(bronze, sep)
    cuts = hot_cuts(named, segment_rows=segment_rows) if cuts is None else cuts
    rows = named if cuts.empty else named.dropDuplicates()
    df = fill_scores_forward(rows, keep_segment=True, cuts=cuts)
    return dedup(complete_scores(df))


def overall_game_silver(bronze: DataFrame, columns: Sequence[str] = K.GAME_COLUMNS,
                        season_source: str = K.RAW_SEASON_COLUMN) -> DataFrame:
    """One row per distinct game: game-level columns plus season."""
    src = season_source if season_source in bronze.columns else "season"
    cols = [c for c in _present(bronze, columns) if c != "season"]
    return bronze.select(*[col_of(c) for c in cols], col_of(src).alias("season")).dropDuplicates()


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------

def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def play_by_event_gold(silver: DataFrame) -> DataFrame:
    return count_by(silver, ["season", "event_type"])


def play_by_event_team_gold(silver: DataFrame) -> DataFrame:
    return count_by(silver, ["season", "event_type", "home_team"])


def play_by_player_gold(silver: DataFrame) -> DataFrame:
    """Null player names form their own group."""
    return count_by(silver, ["season", "event_type", "player1_name"])


def team_stats_season_home_gold(game_silver: DataFrame) -> DataFrame:
    return (game_silver.groupBy("home_team_name", "season")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg("home_team_score").alias("avg_points_for"),
                 F.avg("away_team_score").alias("avg_points_against")))


def team_stats_season_away_gold(game_silver: DataFrame) -> DataFrame:
    return (game_silver.groupBy("away_team_name", "season")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg("away_team_score").alias("avg_points_for"),
                 F.avg("home_team_score").alias("avg_points_against")))
