"""Parameters the registered queries pass to the operators on the test tables.

On the test tables teams are ``<region>_<nation>`` (city ``_`` name), so the
team lists below take the place of the real league lists in
``functions.constants`` (``LEAGUE_TEAMS`` / ``LEAGUE_RENAMES``), which a caller
passes for real play-by-play data.
"""

from courtline.functions.constants import EVENT_TYPE_LOOKUP

# FIXED VALUES: region of nation i is REGIONS[i % 5] in the test tables.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# Official teams: nations 0..19 (20 of 25), in joined form.
OFFICIAL_TEAMS = [f"{REGIONS[i % 5]}_NATION_{i}" for i in range(20)]

# Old name -> new name, in joined form (nation 1 -> 2, 3 -> 4, 5 -> 6).
TEAM_RENAMES = {
    f"{REGIONS[a % 5]}_NATION_{a}": f"{REGIONS[b % 5]}_NATION_{b}"
    for a, b in ((1, 2), (3, 4), (5, 6))
}

# Categories of the one-hot columns: the event types of the lookup and type 11,
# which has no name there, and the official teams by their current names.
ONE_HOT_VALUES = {
    "event_type": sorted({event for event, _ in EVENT_TYPE_LOOKUP} | {11}),
    "away_team": sorted({TEAM_RENAMES.get(t, t) for t in OFFICIAL_TEAMS}),
}

# The team whose games the single-team feature table keeps.
HOME_TEAM = "ASIA_NATION_2"

# Game-level team names excluded by the home/away comparison (NOT IN).
EXCLUDED_TEAMS = [f"NATION_{i}" for i in range(20, 25)]

# Players picked for the shots-made chart.
CHOSEN_PLAYERS = ["Player_1", "Player_2", "Player_3"]

# The single game shown by the one-game filters.
ONE_GAME_ID = 7

# Columns of the play silver that the pipeline expects to be known.
KNOWN_COLUMNS = ["player1_name", "score_margin"]

# Features of the one-split trees and of the two-feature line, which SQL can refit.
STUMP_FEATURES = ["minute_game", "period", "game_month", "game_day", "score_margin_40_events_ago"]
LINE_FEATURES = ["score_margin_40_events_ago", "minute_game"]
# Leaf sizes of the one-split grid.
STUMP_LEAVES = [1, 40]

# Rows of events and orders dealt to a task that counts games, some 0.1 KB each in its join.
KEYS_PER_TASK = 2_500_000
# Lines of games dealt to a task, some 0.2 KB each with the game silver's de-duplication.
LINES_PER_TASK = 1_200_000

FIRST_GAMES = 20
TOP_K = 3
LATEST_SEASONS = 10
TOP_SHOT_MAKERS = 20
HISTOGRAM_BINS = 10
PREVIEW_ROWS = 10
SPARSE_THRESHOLD = 0.9
FLOAT_DIGITS = 9
CORR_DIGITS = 6
