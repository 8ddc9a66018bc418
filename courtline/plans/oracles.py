"""DuckDB oracle SQL for each registered query (same column names).

Keys without an entry here are checked rows-only (model fitting).
"""

from __future__ import annotations

from courtline.functions import constants as K
from courtline.plans import params as P
from courtline.plans.pipeline import SILVER_EXPECTATION
from courtline.plans.sql_blocks import cte, sql_list, with_ctes

# Silver columns, in the order Spark produces them.
SILVER_COLUMNS = [
    "game_id", "game_date", "event_num", "event_type", "period", "minute_game",
    "wc_time_string", "neutral_description", "person1type", "person2type", "player3_id",
    "player1_name", "player1_team_abbreviation", "player2_team_abbreviation", "score",
    "away_score", "home_score", "score_margin", "team_leading", "season", "event_column",
    "home_team", "away_team", "play_description", "score_margin_complete", "score_complete",
    "away_score_complete", "home_score_complete", "team_leading_complete",
]
# FIXED VALUES: Spark type names of the silver columns (as ``info()`` reports them).
SILVER_TYPES = {
    "game_id": "bigint", "game_date": "timestamp_ntz", "event_num": "bigint", "event_type": "int",
    "period": "int", "minute_game": "int", "wc_time_string": "string",
    "neutral_description": "string", "person1type": "int", "person2type": "int",
    "player3_id": "int", "player1_name": "string", "player1_team_abbreviation": "string",
    "player2_team_abbreviation": "string", "score": "string", "away_score": "int",
    "home_score": "int", "score_margin": "int", "team_leading": "string", "season": "string",
    "event_column": "bigint", "home_team": "string", "away_team": "string",
    "play_description": "string", "score_margin_complete": "int", "score_complete": "string",
    "away_score_complete": "int", "home_score_complete": "int",
    "team_leading_complete": "string",
}
NUMERIC = {"bigint", "int", "double", "smallint", "tinyint", "float"}


def _renamed(col: str) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in P.TEAM_RENAMES.items())
    return f"CASE {col} {whens} ELSE {col} END"


# ---------------------------------------------------------------------------
# feature CTEs
# ---------------------------------------------------------------------------
_teams = sql_list(P.OFFICIAL_TEAMS)
cte("f_clean", f"""
SELECT game_id, game_date, event_num, event_type, period, minute_game, season, event_column,
       {_renamed('home_team')} AS home_team, {_renamed('away_team')} AS away_team,
       score_margin_complete, score_complete, away_score_complete, home_score_complete,
       team_leading_complete
FROM silver
WHERE period <= 4 AND home_team IN ({_teams}) AND away_team IN ({_teams})
""", ("silver",))

cte("f_base", """
SELECT * FROM (
  SELECT *, score_margin_complete - score_margin_40_events_ago AS momentum_40 FROM (
    SELECT *, CAST(month(game_date) AS INTEGER) AS game_month,
           CAST(day(game_date) AS INTEGER) AS game_day,
           TRY_CAST(split_part(season, '-', 1) AS INTEGER) AS game_year,
           lag(score_margin_complete, 40) OVER (PARTITION BY game_id ORDER BY event_num)
             AS score_margin_40_events_ago
    FROM f_clean))
WHERE momentum_40 IS NOT NULL
""", ("f_clean",))


def _one_hot_select(src: str, name=lambda s: s) -> str:
    ev = [f"CAST(CASE WHEN event_type = {v} THEN 1 ELSE 0 END AS TINYINT) AS "
          f"\"{name(f'event_type_{v}')}\"" for v in P.ONE_HOT_VALUES["event_type"]]
    aw = [f"CAST(CASE WHEN away_team = '{v}' THEN 1 ELSE 0 END AS TINYINT) AS "
          f"\"{name(f'away_team_{v}')}\"" for v in P.ONE_HOT_VALUES["away_team"]]
    return f"SELECT * EXCLUDE (event_type, away_team), {', '.join(ev + aw)} FROM {src}"


cte("categories", """
SELECT 'event_type' AS column_name, CAST(event_type AS VARCHAR) AS value,
       row_number() OVER (ORDER BY event_type) - 1 AS code
FROM (SELECT DISTINCT event_type FROM f_base WHERE event_type IS NOT NULL)
UNION ALL
SELECT 'away_team', away_team, row_number() OVER (ORDER BY away_team) - 1
FROM (SELECT DISTINCT away_team FROM f_base WHERE away_team IS NOT NULL)
""", ("f_base",))
cte("encoded", _one_hot_select("f_base"), ("f_base",))
cte("features", _one_hot_select("f_base", name=lambda s: s.replace(" ", "_").lower()), ("f_base",))
cte("train", "SELECT * FROM features WHERE period <> 4 AND game_year <> 2022", ("features",))
cte("test_split", "SELECT * FROM features WHERE period = 4 AND game_year = 2022", ("features",))
# both sides of a team's season as one row: an average per side, then a pivot
cte("sides", f"""
SELECT home_team_name AS team_name, season, 'home' AS side, count, avg_points_for, avg_points_against
FROM home_gold WHERE home_team_name NOT IN ({sql_list(P.EXCLUDED_TEAMS)})
UNION ALL
SELECT away_team_name, season, 'away', count, avg_points_for, avg_points_against FROM away_gold
""", ("home_gold", "away_gold"))
cte("margin", """
SELECT team_name, season,
       max(count) FILTER (side = 'home') AS count_home,
       max(count) FILTER (side = 'away') AS count_away,
       max(avg_points_for) FILTER (side = 'home') AS avg_points_for_home,
       max(avg_points_for) FILTER (side = 'away') AS avg_points_for_away,
       round(max(avg_points_for) FILTER (side = 'home')
             - max(avg_points_for) FILTER (side = 'away'), 0) + 0.0 AS margin,
       max(avg_points_against) FILTER (side = 'home') AS avg_points_against_home,
       max(avg_points_against) FILTER (side = 'away') AS avg_points_against_away
FROM sides GROUP BY team_name, season HAVING count(DISTINCT side) = 2
""", ("sides",))
cte("named_events", """
SELECT g.season, g.player1_name, g.count, l.event_name
FROM lookup l, player_gold g WHERE l.event_id = g.event_type
""", ("lookup", "player_gold"))


def _q(ctes, body):
    return with_ctes(ctes, body)


def _with_agg(extra_cte: str, body: str, deps) -> str:
    """A query whose body needs one more local CTE after the shared ones."""
    base = with_ctes(deps, "SELECT 1")
    head = base[: base.rfind("SELECT 1")].rstrip()
    return f"{head},\n{extra_cte}\n{body}"


def null_profile_sql() -> str:
    cols = SILVER_COLUMNS
    agg = ", ".join(f"count(*) - count({c}) AS n{i}" for i, c in enumerate(cols))
    parts = [f"SELECT '{c}' AS column_name, n{i} AS null_count, row_count FROM agg"
             for i, c in enumerate(cols)]
    return _with_agg(f"agg AS (SELECT count(*) AS row_count, {agg} FROM silver)",
                     " UNION ALL ".join(parts), ["silver"])


def sparse_columns_sql() -> str:
    cols = [c for c in SILVER_COLUMNS if SILVER_TYPES[c] in NUMERIC or SILVER_TYPES[c] == "string"]
    agg = ", ".join(f"count(*) - count({c}) AS n{i}" for i, c in enumerate(cols))
    parts = []
    for i, c in enumerate(cols):
        kind = "numeric" if SILVER_TYPES[c] in NUMERIC else "string"
        parts.append(f"SELECT '{c}' AS column_name, '{kind}' AS kind, n{i} AS null_count, "
                     f"row_count FROM agg WHERE n{i} > {P.SPARSE_THRESHOLD} * row_count")
    return _with_agg(f"agg AS (SELECT count(*) AS row_count, {agg} FROM silver)",
                     " UNION ALL ".join(parts), ["silver"])


def column_info_sql() -> str:
    cols = SILVER_COLUMNS
    agg = ", ".join(f"count({c}) AS n{i}" for i, c in enumerate(cols))
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, '{SILVER_TYPES[c]}' AS data_type, "
             f"n{i} AS non_null FROM agg" for i, c in enumerate(cols)]
    return _with_agg(f"agg AS (SELECT {agg} FROM silver)", " UNION ALL ".join(parts), ["silver"])


def describe_sql() -> str:
    d = P.FLOAT_DIGITS
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), {d}) AS mean,
  round(stddev_samp({c}), {d}) AS std, CAST(min({c}) AS DOUBLE) AS min,
  CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50,
  CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM silver"""
             for c in K.PROFILE_NUMERIC_COLUMNS]
    return _q(["silver"], " UNION ALL ".join(parts))


def corr_sql(lower_only: bool) -> str:
    cols = K.PROFILE_NUMERIC_COLUMNS
    d = P.CORR_DIGITS
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            expr = (f"round(covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / "
                    f"(stddev_samp(CAST({a} AS DOUBLE)) * stddev_samp(CAST({b} AS DOUBLE))), {d})")
            pairs = [(a, b, i, j)] + ([(b, a, j, i)] if i != j else [])
            for x, y, ii, jj in pairs:
                if lower_only and not ii > jj:
                    continue
                parts.append(f"SELECT '{x}' AS column_a, '{y}' AS column_b, {ii} AS i, {jj} AS j, "
                             f"{expr} AS corr FROM silver")
    return _q(["silver"], " UNION ALL ".join(parts))


def histogram_sql() -> str:
    n = P.HISTOGRAM_BINS
    c = "score_margin_complete"
    return _with_agg(
        f"mm AS (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM silver),\n"
        f"b AS (SELECT LEAST(CAST(floor((CAST({c} AS DOUBLE) - lo) * CAST({n} AS DOUBLE) / (hi - lo))"
        f" AS INTEGER) + 1, {n}) AS bin FROM silver, mm WHERE {c} IS NOT NULL),\n"
        f"edges AS (SELECT CAST(r AS INTEGER) AS bin FROM range(1, {n + 1}) t(r))",
        f"""SELECT e.bin, lo + (e.bin - 1) * ((hi - lo) / {n}) AS lower,
  CASE WHEN e.bin = {n} THEN hi ELSE lo + e.bin * ((hi - lo) / {n}) END AS upper,
  COALESCE(c.count, 0) AS count
FROM edges e CROSS JOIN mm LEFT JOIN (SELECT bin, count(*) AS count FROM b GROUP BY bin) c
  ON e.bin = c.bin""", ["silver"])


def histograms_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, h.* FROM ({histogram_body(c)}) h"
             for c in K.PROFILE_NUMERIC_COLUMNS]
    return _q(["silver"], " UNION ALL ".join(parts))


def histogram_body(c: str) -> str:
    n = P.HISTOGRAM_BINS
    return f"""
SELECT bin, lo + (bin - 1) * ((hi - lo) / {n}) AS lower,
       CASE WHEN bin = {n} THEN hi ELSE lo + bin * ((hi - lo) / {n}) END AS upper,
       (SELECT count(*) FROM silver WHERE bin = CASE WHEN hi = lo THEN 1 ELSE least(
          CAST(floor((CAST({c} AS DOUBLE) - lo) * CAST({n} AS DOUBLE) / (hi - lo)) AS INTEGER) + 1, {n}) END
        AND {c} IS NOT NULL) AS count
FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM silver),
     (SELECT CAST(r AS INTEGER) AS bin FROM range(1, {n + 1}) t(r))"""


def _hashed(text: str, seed: int = 42) -> str:
    """The number that ``modeling.row_hash`` makes of ``seed|text``."""
    return f"CAST('0x' || substr(md5('{seed}|' || {text}), 1, 8) AS BIGINT)"


# One-level trees, refitted independently: every cut between two neighbouring values of
# every feature, the least squared error wins.  Fit 5 sees all training rows, fits 0 to
# 4 leave out one fold each; ``least`` is the smallest leaf.
cte("fold_rows", f"""
SELECT *, CAST({_hashed("CAST(game_id AS VARCHAR)")} % 5 AS INTEGER) AS fold FROM train
""", ("train",))
cte("fits", "SELECT unnest(range(6)) AS fit")
cte("leaves", "SELECT unnest(" + str(P.STUMP_LEAVES) + ") AS least")
cte("stump_values", " UNION ALL ".join(f"""
SELECT fit, {k} AS k, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, count(*) AS n,
       sum(CAST(score_margin_complete AS DOUBLE)) AS s
FROM fits JOIN fold_rows ON fold <> fit GROUP BY ALL""" for k, c in enumerate(P.STUMP_FEATURES)),
    ("fits", "fold_rows"))
cte("stump_sides", """
SELECT fit, k, feature, (v + lead(v) OVER side) / 2 AS threshold,
       sum(n) OVER side AS n_low, sum(s) OVER side AS s_low,
       sum(n) OVER whole - sum(n) OVER side AS n_high, sum(s) OVER whole - sum(s) OVER side AS s_high
FROM stump_values
WINDOW whole AS (PARTITION BY fit, k), side AS (PARTITION BY fit, k ORDER BY v)
""", ("stump_values",))
cte("stumps", """
SELECT fit, least, feature, threshold, s_low / n_low AS low, s_high / n_high AS high
FROM stump_sides, leaves WHERE n_low >= least AND n_high >= least
QUALIFY row_number() OVER (PARTITION BY fit, least
  ORDER BY s_low * s_low / n_low + s_high * s_high / n_high DESC, k, threshold) = 1
""", ("stump_sides", "leaves"))
_stump_feature = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in P.STUMP_FEATURES) + " END"
cte("stump_folds", f"""
SELECT least, fold, avg(abs(score_margin_complete - CASE WHEN {_stump_feature} <= threshold THEN low ELSE high END))
         AS mae
FROM fold_rows JOIN stumps ON fit = fold GROUP BY least, fold
""", ("fold_rows", "stumps"))
cte("stump_scored", f"""
SELECT split, game_id, minute_game, score_margin_complete AS y,
       CASE WHEN {_stump_feature} <= threshold THEN low ELSE high END AS p
FROM (SELECT 'train' AS split, * FROM train UNION ALL SELECT 'test', * FROM test_split), stumps
WHERE fit = 5 AND least = 1
""", ("train", "test_split", "stumps"))


cte("line_moments", f"""
SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
       covar_pop(a, y) AS ac, covar_pop(b, y) AS bc
FROM (SELECT {P.LINE_FEATURES[0]} AS a, {P.LINE_FEATURES[1]} AS b, score_margin_complete AS y FROM train)
""", ("train",))
cte("line", """
SELECT (ac * bb - bc * ab) / (aa * bb - ab * ab) AS first, (bc * aa - ac * ab) / (aa * bb - ab * ab) AS second,
       my - first * ma - second * mb AS intercept
FROM line_moments
""", ("line_moments",))


def one_game_lag_sql() -> str:
    moving = [c for c in SILVER_COLUMNS if c not in ("game_id", "event_num")]
    lags = ", ".join(f"lag({c}, {K.MOMENTUM_LAG}) OVER w AS {c}" for c in moving)
    return _q(["silver"], f"""SELECT game_id, event_num, {lags} FROM silver
WHERE game_id = {P.ONE_GAME_ID}
WINDOW w AS (PARTITION BY game_id ORDER BY event_num)""")


def normalize_names_sql() -> str:
    return _q(["f_base"], _one_hot_select(
        "f_base", name=lambda s: s.replace(" ", "_").lower()))


_drop_present = [c for c in K.FEATURE_DROP_COLUMNS if c in SILVER_COLUMNS]
_players = sql_list(P.CHOSEN_PLAYERS)

ORACLES: dict[str, str] = {
    # scans, sources, sinks
    "scan_bronze": _q(["pbp"], "SELECT * FROM pbp"),
    "scan_latest_files": _q(["pbp"], """SELECT * FROM pbp WHERE season IN
        (SELECT DISTINCT season FROM pbp ORDER BY season DESC LIMIT 2)"""),
    "union_seasons": _q(["pbp"], "SELECT * FROM pbp"),
    "incremental_ingest": _q(["pbp"], "SELECT * FROM pbp"),
    "table_roundtrip": _q(["event_gold"], "SELECT * FROM event_gold"),
    "medallion_pipeline": _q(
        ["silver", "game_silver", "event_gold", "event_team_gold", "player_gold", "home_gold",
         "away_gold"], """
SELECT 'play_by_play_silver' AS table_name, count(*) AS rows FROM silver
UNION ALL SELECT 'overall_game_silver', count(*) FROM game_silver
UNION ALL SELECT 'play_by_event_gold', count(*) FROM event_gold
UNION ALL SELECT 'play_by_event_team_gold', count(*) FROM event_team_gold
UNION ALL SELECT 'play_by_player_gold', count(*) FROM player_gold
UNION ALL SELECT 'team_stats_season_home_gold', count(*) FROM home_gold
UNION ALL SELECT 'team_stats_season_away_gold', count(*) FROM away_gold"""),
    "pipeline_violations": _q(["silver"], " UNION ALL ".join(
        f"SELECT 'play_by_play_silver' AS table_name, '{name}' AS expectation, count(*) AS rows, "
        f"count(*) FILTER ({c} IS NULL) AS violations FROM silver"
        for name, c in (SILVER_EXPECTATION, *((f"{c} is known", c) for c in P.KNOWN_COLUMNS)))),
    "event_lookup": _q(["lookup", "silver"], """
SELECT l.event_id, l.event_name, COALESCE(c.plays, 0) AS plays
FROM lookup l LEFT JOIN (SELECT event_type, count(*) AS plays FROM silver GROUP BY event_type) c
  ON l.event_id = c.event_type"""),
    "feature_table": _q(["features"], "SELECT * FROM features"),
    "team_feature_table": _q(["features"],
                             f"SELECT * FROM features WHERE home_team = '{P.HOME_TEAM}'"),
    "unlisted_categories": _q(["f_base"], " UNION ALL ".join(
        f"SELECT '{c} is listed' AS expectation, count(*) AS rows, "
        f"count(*) FILTER ({c} NOT IN ({sql_list(v)})) AS violations FROM f_base"
        for c, v in P.ONE_HOT_VALUES.items())),
    "csv_scan": """
SELECT user_id AS game_id, event_id AS event_num, event_type AS event_name, value AS points,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS played_at,
       CASE WHEN event_id % 11 <> 0 THEN props || CASE WHEN event_id % 5 = 0 THEN chr(10) ELSE ', ' END
         || 'by "' || event_type || '"' END AS note
FROM events WHERE event_id % 50 <> 0 AND event_id % 70 <> 0""",
    "csv_rejects": """
SELECT CAST(user_id AS VARCHAR) AS game_id, count(*) AS rejected
FROM events WHERE event_id % 50 = 0 OR event_id % 70 = 0 GROUP BY user_id""",
    "category_dictionary": _q(["categories"], "SELECT * FROM categories"),
    "one_hot_discovered": _q(["categories"], """
SELECT game_id, event_num, score_margin_complete, concat_ws(',', e.code,
       a.code + (SELECT count(*) FROM categories WHERE column_name = 'event_type')) AS positions
FROM f_base
LEFT JOIN categories e ON e.column_name = 'event_type' AND e.value = CAST(event_type AS VARCHAR)
LEFT JOIN categories a ON a.column_name = 'away_team' AND a.value = away_team"""),
    "preview_rows": _q(["silver"], f"SELECT * FROM silver ORDER BY game_id, event_num "
                                   f"LIMIT {P.PREVIEW_ROWS}"),
    # projection / filter / shaping
    "silver_projection": _q(["p_proj"], "SELECT * FROM p_proj"),
    "silver_typed": _q(["p_typed"], "SELECT * FROM p_typed"),
    "silver_names": _q(["p_named"], "SELECT * FROM p_named"),
    "forward_fill": _q(["p_filled"], "SELECT * FROM p_filled"),
    "silver_complete": _q(["p_complete"], "SELECT * FROM p_complete"),
    "dedup_plays": _q(["silver"], "SELECT * FROM silver"),
    "drop_columns": _q(["silver"], f"SELECT * EXCLUDE ({', '.join(_drop_present)}) FROM silver"),
    "normalize_names": normalize_names_sql(),
    "regulation_time": _q(["silver"], "SELECT * FROM silver WHERE period <= 4"),
    "one_game": _q(["silver"], f"SELECT * FROM silver WHERE game_id = {P.ONE_GAME_ID}"),
    "person_type_filter": _q(["silver"],
                             "SELECT * FROM silver WHERE person1type = 4 AND person2type = 5"),
    "official_teams_either": _q(["silver"], f"""SELECT * FROM silver
        WHERE home_team IN ({_teams}) OR away_team IN ({_teams})"""),
    "official_teams_both": _q(["silver"], f"""SELECT * FROM silver
        WHERE home_team IN ({_teams}) AND away_team IN ({_teams})"""),
    "rename_teams": _q(["silver"], f"""SELECT * REPLACE ({_renamed('home_team')} AS home_team,
        {_renamed('away_team')} AS away_team) FROM silver"""),
    # quality
    "null_profile": null_profile_sql(),
    "sparse_columns": sparse_columns_sql(),
    "column_info": column_info_sql(),
    "expectation": _q(["silver"], """
SELECT 'score_margin is not null (before defaults)' AS expectation, count(*) AS rows,
       count(*) - count(score_margin) AS violations FROM silver
UNION ALL
SELECT 'score_margin_complete is not null', count(*), count(*) - count(score_margin_complete)
FROM silver"""),
    "game_silver": _q(["game_silver"], "SELECT * FROM game_silver"),
    "duplicate_count": _q(["pbp"], """
SELECT (SELECT count(*) FROM pbp) - (SELECT count(*) FROM (SELECT DISTINCT * FROM pbp))
         AS duplicate_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM pbp)) AS distinct_rows"""),
    "table_shape": _q(["silver"], f"SELECT count(*) AS rows, {len(SILVER_COLUMNS)} AS columns "
                                  f"FROM silver"),
    # gold + analyst
    "play_by_event_gold": _q(["event_gold"], "SELECT * FROM event_gold"),
    "play_by_event_team_gold": _q(["event_team_gold"], "SELECT * FROM event_team_gold"),
    "play_by_player_gold": _q(["player_gold"], "SELECT * FROM player_gold"),
    "team_stats_season_home_gold": _q(["home_gold"], "SELECT * FROM home_gold"),
    "team_stats_season_away_gold": _q(["away_gold"], "SELECT * FROM away_gold"),
    "season_event_counts": _q(["event_gold", "lookup"], """
SELECT season, (SELECT event_name FROM lookup WHERE event_id = event_type) AS event_type, count
FROM event_gold WHERE event_type IN (SELECT event_id FROM lookup)"""),
    "player_season_event_counts": _q(["named_events"], """
SELECT season, event_name AS event_type, player1_name, count FROM named_events"""),
    "team_stats_margin": _q(["margin"], "SELECT * FROM margin"),
    "visual_shots_made": _q(["named_events"], f"""
SELECT season, player1_name AS player_name, event_name, count FROM named_events
WHERE event_name = 'Shot Made' AND player1_name IN ({_players})"""),
    "visual_top_events_by_player": _q(["named_events", "player_gold"], f"""
SELECT season, event_name AS event_type, player1_name, count
FROM (SELECT e.*, 1 + (SELECT count(*) FROM named_events o WHERE o.season = e.season
                       AND o.player1_name IS NOT NULL AND o.count > e.count) AS place
      FROM named_events e
      SEMI JOIN (SELECT season FROM player_gold GROUP BY season ORDER BY season DESC
                 LIMIT {P.LATEST_SEASONS}) USING (season)
      WHERE e.player1_name IS NOT NULL)
WHERE place <= {P.TOP_K}"""),
    "visual_avg_points": _q(["margin"], """
SELECT season, team_name, avg_points_for_home, avg_points_for_away FROM margin"""),
    "latest_seasons": _q(["player_gold"], f"""
SELECT DISTINCT season FROM player_gold ORDER BY season DESC NULLS LAST
LIMIT {P.LATEST_SEASONS}"""),
    # profiles
    "first_games": _q(["silver"], f"""SELECT * FROM silver WHERE game_id IN
        (SELECT DISTINCT game_id FROM silver ORDER BY game_id LIMIT {P.FIRST_GAMES})"""),
    "game_name": _q(["silver"], """
SELECT s.*, g.game_name FROM silver s LEFT JOIN (
  SELECT game_id, min(season) || '-' || array_to_string(list_sort(list_distinct(
           list_concat(list(player1_team_abbreviation), list(player2_team_abbreviation)))), '-')
           AS game_name
  FROM silver GROUP BY game_id) g ON s.game_id = g.game_id"""),
    "top_shot_makers": _q(["silver"], f"""
SELECT game_id, player1_team_abbreviation, player1_name,
       CAST(sum(event_type) AS BIGINT) AS event_type_sum, count(*) AS shots
FROM silver WHERE event_type = 1
GROUP BY game_id, player1_team_abbreviation, player1_name
ORDER BY shots DESC, game_id, player1_team_abbreviation NULLS FIRST, player1_name NULLS FIRST
LIMIT {P.TOP_SHOT_MAKERS}"""),
    "top_shot_makers_mean": _q(["silver"], f"""
SELECT player1_name, player1_team_abbreviation, avg(shots) AS mean_shots, count(*) AS games
FROM (SELECT game_id, player1_team_abbreviation, player1_name, count(*) AS shots
      FROM silver WHERE event_type = 1
      GROUP BY game_id, player1_team_abbreviation, player1_name
      ORDER BY shots DESC, game_id, player1_team_abbreviation NULLS FIRST,
               player1_name NULLS FIRST
      LIMIT {P.TOP_SHOT_MAKERS})
GROUP BY player1_name, player1_team_abbreviation"""),
    "home_team_play_counts": _q(["silver"],
                                "SELECT home_team, count(*) AS count FROM silver GROUP BY home_team"),
    "away_team_play_counts": _q(["silver"],
                                "SELECT away_team, count(*) AS count FROM silver GROUP BY away_team"),
    "distinct_teams": _q(["silver"], """
SELECT DISTINCT value FROM (SELECT home_team AS value FROM silver
                            UNION ALL SELECT away_team FROM silver)"""),
    "describe_numeric": describe_sql(),
    "corr_matrix": corr_sql(False),
    "corr_lower_triangle": corr_sql(True),
    "margin_by_minute": _q(["silver"], f"""
SELECT game_id, minute_game, round(avg(score_margin_complete), {P.FLOAT_DIGITS}) AS mean,
       count(score_margin_complete) AS n,
       round(stddev_samp(score_margin_complete), {P.FLOAT_DIGITS}) AS std
FROM silver GROUP BY game_id, minute_game"""),
    "histogram": histogram_sql(),
    # features
    "season_features": _q(["silver"], """
SELECT *, TRY_CAST(split_part(season, '-', 1) AS INTEGER) AS game_year,
       TRY_CAST(right(season, 2) AS INTEGER) AS season_two_digits FROM silver"""),
    "calendar_features": _q(["silver"], """
SELECT *, CAST(month(game_date) AS INTEGER) AS game_month,
       CAST(day(game_date) AS INTEGER) AS game_day FROM silver"""),
    "time_of_day": _q(["silver"], """
SELECT *, strftime(strptime(wc_time_string, '%H:%M:%S'), '%H:%M:%S') AS time_of_day
FROM silver"""),
    "lag_40": _q(["silver"], f"""
SELECT game_id, event_num, score_margin_complete,
       lag(score_margin_complete, {K.MOMENTUM_LAG}) OVER (PARTITION BY game_id ORDER BY event_num)
         AS score_margin_40_events_ago
FROM silver"""),
    "momentum": _q(["f_base"], "SELECT * FROM f_base"),
    "one_game_lag": one_game_lag_sql(),
    "one_hot": _q(["encoded"], "SELECT * FROM encoded"),
    # models (SQL-expressible parts)
    "train_split": _q(["train"], "SELECT * FROM train"),
    "test_split": _q(["test_split"], "SELECT * FROM test_split"),
    "regression_metrics": _q(["test_split"], """
SELECT count(*) AS rows,
       round(1.0 - sum(e * e) / (var_pop(y) * count(*)), 3) AS r2,
       round(avg(e * e), 3) AS mse, round(avg(abs(e)), 3) AS mae
FROM (SELECT CAST(score_margin_complete AS DOUBLE) AS y,
             CAST(score_margin_complete AS DOUBLE) - CAST(score_margin_40_events_ago AS DOUBLE) AS e
      FROM test_split)"""),
    "random_split": _q(["margin"], f"""
SELECT team_name, season, count_home, count_away, avg_points_for_home, avg_points_for_away, margin,
       TRY_CAST(right(season, 2) AS INTEGER) AS season_two_digits,
       CASE WHEN {_hashed("coalesce(team_name, '') || '|' || coalesce(season, '')")} % 5 = 0
            THEN 'test' ELSE 'train' END AS split
FROM margin"""),
    "fold_sizes": _q(["train"], f"""
SELECT CAST({_hashed("CAST(game_id AS VARCHAR)")} % 5 AS INTEGER) AS fold,
       count(DISTINCT game_id) AS games, count(*) AS plays
FROM train GROUP BY 1"""),
    "simple_regression": _q(["train"], """
SELECT round(regr_slope(score_margin_complete, score_margin_40_events_ago), 6) AS slope,
       round(regr_intercept(score_margin_complete, score_margin_40_events_ago), 6) AS intercept
FROM train"""),
    "tree_split": _q(["stumps"], """
SELECT feature, threshold, round(low, 6) AS low, round(high, 6) AS high FROM stumps WHERE fit = 5 AND least = 1"""),
    "tree_errors": _q(["stump_scored"], """
SELECT 'stump' AS model, split, count(*) AS rows, round(avg(abs(y - p)), 6) AS mae FROM stump_scored GROUP BY split"""),
    "tree_by_minute": _q(["stump_scored"], """
SELECT game_id, minute_game, round(avg(y), 6) AS actual, round(avg(p), 6) AS predicted
FROM stump_scored GROUP BY game_id, minute_game"""),
    "tree_cv": _q(["stump_folds"], """
SELECT 'stump' AS model, round(avg(mae), 6) AS mean_mae, round(stddev_pop(mae), 6) AS std_mae, count(*) AS folds
FROM stump_folds WHERE least = 1"""),
    "tree_grid": _q(["stump_folds"], """
SELECT 1 AS max_depth, CAST(least AS INTEGER) AS min_instances_per_node, round(avg(mae), 6) AS mean_mae,
       row_number() OVER (ORDER BY avg(mae), least) = 1 AS best
FROM stump_folds GROUP BY least"""),
    "line_of_two": _q(["line", "test_split"], f"""
SELECT round(first, 6) AS first, round(second, 6) AS second, round(intercept, 6) AS intercept,
       round(avg(abs(score_margin_complete - first * {P.LINE_FEATURES[0]} - second * {P.LINE_FEATURES[1]}
                     - intercept)), 6) AS mae
FROM line, test_split GROUP BY first, second, intercept"""),
    "ml_results_actual": _q(["train", "test_split"], """
SELECT game_id, event_num, minute_game, score_margin_complete, 'train' AS split FROM train
UNION ALL
SELECT game_id, event_num, minute_game, score_margin_complete, 'test' FROM test_split"""),
    "histograms": histograms_sql(),
}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
