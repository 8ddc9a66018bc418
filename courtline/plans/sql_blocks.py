"""DuckDB SQL building blocks for the oracle queries.

Each oracle is one SQL string that starts from the driver's tables, so the
fixtures (PBP, GAME) and the pipeline stages are written here as named CTEs
with their dependencies; ``with_ctes`` pulls in what a query needs, in order.

Parity rules with Spark: ``||`` for concatenation (null if a part is null),
``regexp_replace(..., 'g')``, ranks/counts cast to BIGINT, ``nulls first``
stated where a limit follows.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (sql.strip(), deps)


def with_ctes(names: list[str] | tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# ---------------------------------------------------------------------------
# fixtures
# ---------------------------------------------------------------------------
cte("teams", """
SELECT n.n_nationkey AS tkey, n.n_name AS tname, r.r_name AS tcity
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")

cte("pbp_src", """
SELECT e.event_id, e.ts, e.user_id, e.event_type,
       CAST(round(e.value * 100) AS BIGINT) AS k,
       CAST(e.user_id % 25 AS INTEGER) AS home_key,
       CAST((e.user_id * 7 + 3) % 25 AS INTEGER) AS away_key
FROM (SELECT event_id, ts, user_id, event_type, value FROM events
      UNION ALL
      SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_id % 50 = 0) e
""")

cte("pbp", """
SELECT s.user_id AS game_id,
       s.event_id AS event_num,
       CASE s.event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
            WHEN 'signup' THEN 4 ELSE 11 END AS event_type,
       1 + CAST(floor((extract(day FROM s.ts) - 1) / 6.0) AS INTEGER) AS period,
       CAST(floor((extract(day FROM s.ts) - 1) * 48 / 30.0) AS INTEGER) AS minute_game,
       CAST(2018 + s.user_id % 5 AS VARCHAR) || '-' || CAST(19 + s.user_id % 5 AS VARCHAR) AS season,
       o.o_orderdate AS game_date,
       lpad(CAST(hour(s.ts) AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute(s.ts) AS VARCHAR), 2, '0')
         || ':00' AS wc_time_string,
       h.tcity AS home_team_city, h.tname AS home_team_name,
       a.tcity AS away_team_city, a.tname AS away_team_name,
       CASE WHEN s.event_type = 'purchase' THEN
         CASE WHEN s.k % 7 = 0 THEN 'TIE' ELSE CAST(s.k % 41 - 20 AS VARCHAR) END END AS score_margin,
       CASE WHEN s.event_type = 'purchase' THEN CAST(s.k % 120 AS INTEGER) END AS home_score,
       CASE WHEN s.event_type = 'purchase' THEN CAST(s.k % 113 AS INTEGER) END AS away_score,
       CASE WHEN s.event_type = 'purchase' THEN
         CAST(s.k % 113 AS VARCHAR) || ' - ' || CAST(s.k % 120 AS VARCHAR) END AS score,
       CASE WHEN s.event_type = 'purchase' THEN
         CASE WHEN s.k % 2 = 0 THEN 'Home' ELSE 'Away' END END AS team_leading,
       CASE WHEN s.k % 3 <> 0 THEN 'h ' || s.event_type END AS home_description,
       CASE WHEN s.k % 3 <> 1 THEN 'v ' || s.event_type END AS visitor_description,
       CASE WHEN s.k % 25 = 0 THEN 'n' END AS neutral_description,
       CAST(4 + s.k % 2 AS INTEGER) AS person1type,
       CASE WHEN s.k % 3 = 0 THEN 5 ELSE 0 END AS person2type,
       CASE WHEN s.k % 20 = 0 THEN CAST(s.k % 12 AS INTEGER) END AS player3_id,
       CASE WHEN s.event_id % 10 <> 0 THEN 'Player_' || CAST(s.k % 12 AS VARCHAR) END AS player1_name,
       'T' || CAST(CASE WHEN s.k % 2 = 0 THEN s.home_key ELSE s.away_key END AS VARCHAR)
         AS player1_team_abbreviation,
       CASE WHEN s.k % 3 <> 0 THEN
         'T' || CAST(CASE WHEN s.k % 2 = 0 THEN s.away_key ELSE s.home_key END AS VARCHAR) END
         AS player2_team_abbreviation
FROM pbp_src s
JOIN orders o ON o.o_orderkey = s.user_id
JOIN teams h ON h.tkey = s.home_key
JOIN teams a ON a.tkey = s.away_key
""", ("pbp_src", "teams"))

cte("game", """
SELECT o.o_orderkey AS game_id,
       l.l_linenumber AS event_num,
       o.o_orderdate AS game_date,
       CAST(year(o.o_orderdate) AS VARCHAR) || '-' || right(CAST(year(o.o_orderdate) + 1 AS VARCHAR), 2)
         AS season,
       h.tkey AS home_team_id, h.tname AS home_team_name,
       a.tkey AS away_team_id, a.tname AS away_team_name,
       CAST(80 + o.o_custkey % 50 AS INTEGER) AS home_team_score,
       CAST(80 + o.o_orderkey % 47 AS INTEGER) AS away_team_score
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN teams h ON h.tkey = c.c_nationkey
JOIN teams a ON a.tkey = CAST((o.o_orderkey * 7 + 3) % 25 AS INTEGER)
""", ("teams",))

# ---------------------------------------------------------------------------
# play silver, stage by stage
# ---------------------------------------------------------------------------
cte("p_proj", """
SELECT game_id, game_date, home_team_city, home_team_name, away_team_city, away_team_name,
       home_description, visitor_description, event_num, event_type, period, minute_game,
       wc_time_string, neutral_description, person1type, person2type, player3_id, player1_name,
       player1_team_abbreviation, player2_team_abbreviation, score, away_score, home_score,
       score_margin, team_leading, season
FROM pbp
""", ("pbp",))

cte("p_typed", """
SELECT * REPLACE (
         TRY_CAST(TRY_CAST(regexp_replace(score_margin, 'TIE', '0', 'g') AS DOUBLE) AS INTEGER)
           AS score_margin),
       event_num AS event_column
FROM p_proj
""", ("p_proj",))

cte("p_named", """
SELECT * EXCLUDE (home_team_city, home_team_name, away_team_city, away_team_name,
                  home_description, visitor_description),
       home_team_city || '_' || home_team_name AS home_team,
       away_team_city || '_' || away_team_name AS away_team,
       home_description || visitor_description AS play_description
FROM p_typed
""", ("p_typed",))

cte("p_filled", """
SELECT * REPLACE (
         last_value(score_margin IGNORE NULLS) OVER w AS score_margin,
         last_value(score IGNORE NULLS) OVER w AS score,
         last_value(away_score IGNORE NULLS) OVER w AS away_score,
         last_value(home_score IGNORE NULLS) OVER w AS home_score,
         last_value(team_leading IGNORE NULLS) OVER w AS team_leading)
FROM p_named
WINDOW w AS (PARTITION BY game_id ORDER BY event_num
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""", ("p_named",))

cte("p_complete", """
SELECT *,
       COALESCE(score_margin, 0) AS score_margin_complete,
       COALESCE(score, '0 - 0') AS score_complete,
       COALESCE(away_score, 0) AS away_score_complete,
       COALESCE(home_score, 0) AS home_score_complete,
       COALESCE(team_leading, 'Home') AS team_leading_complete
FROM p_filled
""", ("p_filled",))

cte("silver", "SELECT DISTINCT * FROM p_complete", ("p_complete",))

cte("game_silver", """
SELECT DISTINCT game_id, game_date, home_team_id, home_team_name, home_team_score,
       away_team_id, away_team_name, away_team_score, season
FROM game
""", ("game",))

# ---------------------------------------------------------------------------
# gold + lookup
# ---------------------------------------------------------------------------
cte("lookup", """
SELECT * FROM (VALUES (1, 'Shot Made'), (2, 'Shot Missed'), (3, 'Free Throw'), (4, 'Rebound'),
  (5, 'Turnover'), (6, 'Foul'), (7, 'Violation'), (8, 'Substitution'), (9, 'Timeout'),
  (10, 'Jump ball'), (12, 'Start of quarter'), (13, 'End of quarter')) t(event_id, event_name)
""")

cte("event_gold", """
SELECT season, event_type, count(*) AS count FROM silver GROUP BY season, event_type
""", ("silver",))

cte("event_team_gold", """
SELECT season, event_type, home_team, count(*) AS count FROM silver
GROUP BY season, event_type, home_team
""", ("silver",))

cte("player_gold", """
SELECT season, event_type, player1_name, count(*) AS count FROM silver
GROUP BY season, event_type, player1_name
""", ("silver",))

cte("home_gold", """
SELECT home_team_name, season, count(*) AS count,
       avg(home_team_score) AS avg_points_for, avg(away_team_score) AS avg_points_against
FROM game_silver GROUP BY home_team_name, season
""", ("game_silver",))

cte("away_gold", """
SELECT away_team_name, season, count(*) AS count,
       avg(away_team_score) AS avg_points_for, avg(home_team_score) AS avg_points_against
FROM game_silver GROUP BY away_team_name, season
""", ("game_silver",))
