"""Fixed values.

These must equal what the original notebooks use (column names of the raw
play-by-play data, the event-type lookup, the team-name lists), so they are
written out plainly, in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: event type id -> name (12 rows; id 11 has no name)
# ---------------------------------------------------------------------------
EVENT_TYPE_LOOKUP = [
    (1, "Shot Made"),
    (2, "Shot Missed"),
    (3, "Free Throw"),
    (4, "Rebound"),
    (5, "Turnover"),
    (6, "Foul"),
    (7, "Violation"),
    (8, "Substitution"),
    (9, "Timeout"),
    (10, "Jump ball"),
    (12, "Start of quarter"),
    (13, "End of quarter"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: play-level columns kept from the raw data (play silver)
# ---------------------------------------------------------------------------
PLAY_COLUMNS = [
    "game_id", "game_date", "home_team_city", "home_team_name", "away_team_city",
    "away_team_name", "home_description", "visitor_description", "event_num",
    "event_type", "event_action_type", "period", "minute_game", "wc_time_string",
    "time_quarter", "minute_remaining_quarter", "seconds_remaining_quarter",
    "neutral_description", "person1type", "player1_id", "person2type", "player2_id",
    "person3type", "player3_id", "video_available_flag", "player1_name",
    "player1_team_id", "player1_team_city", "player1_team_nickname",
    "player1_team_abbreviation", "player2_name", "player2_team_id",
    "player2_team_city", "player2_team_nickname", "player2_team_abbreviation",
    "player3_name", "player3_team_id", "player3_team_city", "player3_team_nickname",
    "player3_team_abbreviation", "score", "away_score", "home_score", "score_margin",
    "team_leading",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: game-level columns kept from the raw data (game silver)
# ---------------------------------------------------------------------------
GAME_COLUMNS = [
    "game_id", "game_date", "game_code", "day", "month_num", "week_number",
    "week_name", "if_necessary", "series_game_number", "series_text", "arena_name",
    "arena_state", "arena_city", "postponed_status", "branch_link", "game_subtype",
    "home_team_id", "home_team_name", "home_team_city", "home_team_tricode",
    "home_team_slug", "home_team_wins", "home_team_losses", "home_team_score",
    "home_team_seed", "away_team_id", "away_team_name", "away_team_city",
    "away_team_tricode", "away_team_slug", "away_team_wins", "away_team_losses",
    "away_team_score", "away_team_seed",
]

# Raw column that carries the season label in the source files.
RAW_SEASON_COLUMN = "season.x"

# ---------------------------------------------------------------------------
# FIXED VALUES: score columns carried forward within a game, and their defaults
# ---------------------------------------------------------------------------
SCORE_COLUMNS = ["score_margin", "score", "away_score", "home_score", "team_leading"]
COMPLETE_DEFAULTS = {
    "score_margin_complete": 0,
    "away_score_complete": 0,
    "home_score_complete": 0,
    "score_complete": "0 - 0",
    "team_leading_complete": "Home",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: columns removed before feature engineering
# ---------------------------------------------------------------------------
FEATURE_DROP_COLUMNS = [
    "event_action_type", "minute_remaining_quarter", "seconds_remaining_quarter",
    "neutral_description", "play_description", "score", "home_score", "away_score",
    "score_margin", "team_leading", "player1_team_nickname", "player1_team_city",
    "player2_team_nickname", "player2_team_city", "player3_team_nickname",
    "player3_team_city", "wc_time_string", "time_quarter", "person1type",
    "player1_id", "person2type", "player2_id", "person3type", "player3_id",
    "video_available_flag", "player1_name", "player1_team_id",
    "player1_team_abbreviation", "player2_name", "player2_team_id",
    "player2_team_abbreviation", "player3_name", "player3_team_id",
    "player3_team_abbreviation",
]

# Columns removed from the feature table before modelling (identifiers, text).
MODEL_DROP_COLUMNS = ["game_id", "event_num", "home_team", "team_leading_complete"]

# Numeric columns profiled in the exploratory analysis.
PROFILE_NUMERIC_COLUMNS = [
    "event_type", "period", "minute_game", "score_margin_complete",
    "away_score_complete", "home_score_complete",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: official team names (city + "_" + name), real league data
# ---------------------------------------------------------------------------
LEAGUE_TEAMS = [
    "Atlanta_Hawks", "Boston_Celtics", "Brooklyn_Nets", "Charlotte_Bobcats",
    "Charlotte_Hornets", "Chicago_Bulls", "Cleveland_Cavaliers", "Dallas_Mavericks",
    "Denver_Nuggets", "Detroit_Pistons", "Golden State_Warriors", "Houston_Rockets",
    "Indiana_Pacers", "LA_Clippers", "Los Angeles_Clippers", "Los Angeles_Lakers",
    "Memphis_Grizzlies", "Miami_Heat", "Milwaukee_Bucks", "Minnesota_Timberwolves",
    "New Jersey_Nets", "New Orleans/Oklahoma City_Hornets", "New Orleans_Hornets",
    "New Orleans_Pelicans", "New York_Knicks", "Oklahoma City_Thunder",
    "Orlando_Magic", "Philadelphia_76ers", "Phoenix_Suns", "Portland_Trail Blazers",
    "Sacramento_Kings", "San Antonio_Spurs", "Seattle_SuperSonics", "Toronto_Raptors",
    "Utah_Jazz", "Vancouver_Grizzlies", "Washington_Bullets", "Washington_Wizards",
]

# FIXED VALUES: old team name -> current team name, real league data
LEAGUE_RENAMES = {
    "Charlotte_Bobcats": "Charlotte_Hornets",
    "LA_Clippers": "Los Angeles_Clippers",
    "Vancouver_Grizzlies": "Memphis_Grizzlies",
    "Seattle_SuperSonics": "Oklahoma City_Thunder",
    "New Orleans/Oklahoma City_Hornets": "New Orleans_Pelicans",
    "New Orleans_Hornets": "New Orleans_Pelicans",
    "New Jersey_Nets": "Brooklyn_Nets",
    "Washington_Bullets": "Washington_Wizards",
}

# Lag horizon: about four minutes of play at roughly ten plays a minute.
MOMENTUM_LAG = 40
