"""The query registry: one entry per operator of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the whole test tables.
``Inputs`` builds the shared upstream frames lazily.  Two jobs run when the first plan
over the play silver of an input is built, the counts of its games (``Inputs.cuts``), and
one when the first plan over its game silver is (``Inputs.game``); otherwise nothing runs
until the caller acts on the returned frame, but for the copies and tables that a query
says it writes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions import constants as K
from courtline.operators import analyst as A
from courtline.operators import features as FT
from courtline.operators import medallion as M
from courtline.operators import modeling as ML
from courtline.operators import profile as PR
from courtline.operators import quality as Q
from courtline.operators.windows import Cuts, even_tasks, hot_cuts, lag_all_columns, lag_rows
from courtline.plans import params as P
from courtline.plans.pipeline import CHECKS_TABLE, medallion
from courtline.session import input_version, scratch_path, shared_copy, shared_value
from courtline.sources import catalog as C
from courtline.sources import files as FS
from courtline.sources.fixtures import (CSV_SCHEMA, event_csv, game_bronze, game_lines, play_by_play_bronze,
                                        play_keys)
from courtline.streaming.ingest import ingest_to_bronze



def _database(sf_dir: str) -> str:
    """A database for each input, so that tables of one input never replace those
    of another."""
    return f"courtline_{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def version(self) -> str:
        return input_version(self.spark, self.sf_dir.rstrip("/"))

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame written once per application and version of the input for all queries
        that read it more than once; a lost executor re-reads files."""
        return shared_copy(self.spark, name, self.version, build)

    @cached_property
    def cuts(self) -> Cuts:
        """The hot games and where they are cut: one count per application and version
        of the input, for the fill, the lag and all that reads silver.  Its join is dealt
        by game as well, to the tasks that a count of both sides asks for."""
        def count() -> Cuts:
            tasks = even_tasks(play_keys(self.spark, self.sf_dir), ["game_id"], P.KEYS_PER_TASK)
            return hot_cuts(M.named_plays(play_by_play_bronze(self.spark, self.sf_dir, tasks)))

        return shared_value(self.spark, "event cuts", self.version, count)

    @cached_property
    def bronze(self) -> DataFrame:
        return play_by_play_bronze(self.spark, self.sf_dir)

    @cached_property
    def dealt_bronze(self) -> DataFrame:
        """Bronze dealt by game to the tasks that its count asks for, hot games to several."""
        tasks = self.cuts.tasks(self.spark)
        return play_by_play_bronze(self.spark, self.sf_dir, tasks, self.cuts.groups) if tasks else self.bronze

    @cached_property
    def game(self) -> DataFrame:
        """Game bronze, dealt by game to the tasks that one count of its lines asks for."""
        tasks = shared_value(self.spark, "line tasks", self.version, lambda: even_tasks(
            game_lines(self.spark, self.sf_dir), ["l_orderkey"], P.LINES_PER_TASK))
        return game_bronze(self.spark, self.sf_dir, tasks)

    @cached_property
    def projected(self) -> DataFrame:
        return M.project_play_columns(self.bronze)

    @cached_property
    def typed(self) -> DataFrame:
        return M.type_play_columns(self.projected)

    @cached_property
    def named(self) -> DataFrame:
        return M.merge_names(self.typed)

    @cached_property
    def filled(self) -> DataFrame:
        return M.fill_with_copies(M.named_plays(self.dealt_bronze), cuts=self.cuts)

    @cached_property
    def completed(self) -> DataFrame:
        return M.complete_scores(self.filled)

    @cached_property
    def silver(self) -> DataFrame:
        return M.play_by_play_silver(self.dealt_bronze, cuts=self.cuts)

    @cached_property
    def silver_shared(self) -> DataFrame:
        return self.shared("play_by_play_silver", lambda: self.silver)

    @cached_property
    def game_silver(self) -> DataFrame:
        return M.overall_game_silver(self.game)

    @cached_property
    def lookup(self) -> DataFrame:
        return A.event_type_lookup(self.spark)

    @cached_property
    def event_gold(self) -> DataFrame:
        return M.play_by_event_gold(self.silver)

    @cached_property
    def player_gold(self) -> DataFrame:
        return M.play_by_player_gold(self.silver)

    @cached_property
    def home_gold(self) -> DataFrame:
        return M.team_stats_season_home_gold(self.game_silver)

    @cached_property
    def away_gold(self) -> DataFrame:
        return M.team_stats_season_away_gold(self.game_silver)

    @cached_property
    def margin_table(self) -> DataFrame:
        # the home and away gold tables both read the written game silver
        g = self.shared("overall_game_silver", lambda: self.game_silver)
        return A.team_stats_margin(M.team_stats_season_home_gold(g),
                                   M.team_stats_season_away_gold(g), P.EXCLUDED_TEAMS)

    @cached_property
    def feature_base(self) -> DataFrame:
        # silver is distinct by construction (its last step is the dedup)
        return FT.feature_base(self.silver_shared, P.OFFICIAL_TEAMS, P.TEAM_RENAMES, dedup=False,
                               cuts=self.cuts)

    @cached_property
    def feature_base_shared(self) -> DataFrame:
        # read for the dictionary and again for each encoding
        return self.shared("feature_base", lambda: self.feature_base)

    @cached_property
    def features(self) -> DataFrame:
        return FT.feature_table(self.feature_base, P.ONE_HOT_VALUES)

    def saved_model(self, name: str, build: Callable[[], PipelineModel]) -> PipelineModel:
        """The model of that name, fitted once per application and version of the input and
        loaded from disk wherever it is used."""
        path = shared_value(self.spark, f"model {name}", self.version, lambda: ML.save_model(
            build(), scratch_path(self.spark, f"model-{name}")))
        return ML.load_model(path)

    def catalog_model(self, name: str) -> PipelineModel:
        """A regressor of the catalog, fitted on the training rows."""
        train, _ = self.splits
        return self.saved_model(name, lambda: ML.fit(train, ML.model_catalog()[name], ML.feature_columns(train)))

    @cached_property
    def search(self) -> tuple[PipelineModel, DataFrame]:
        """The winner of the one grid search per input, and the search's table."""
        train, _ = self.splits

        def run() -> tuple[str, str]:
            best, table = ML.grid_search(train, ML.feature_columns(train))
            with C.namespace(self.spark, _database(self.sf_dir)) as db:
                saved = C.save_table(table.coalesce(1), "grid_search", db, comment="Settings and their mean MAE")
            return ML.save_model(best, scratch_path(self.spark, "model-best")), saved

        path, table = shared_value(self.spark, "grid search", self.version, run)
        return ML.load_model(path), self.spark.table(table)

    @cached_property
    def splits(self) -> tuple[DataFrame, DataFrame]:
        return ML.time_split(self.shared("features", lambda: self.features))


def _in(spark, sf_dir) -> Inputs:
    return Inputs(spark, sf_dir)


def _saved(spark, sf_dir, df: DataFrame, table: str, comment: str | None = None) -> DataFrame:
    """``df`` written as a table of the input's database, read back."""
    with C.namespace(spark, _database(sf_dir)) as db:
        return C.read_table(spark, C.save_table(df, table, db, comment=comment))


# ---------------------------------------------------------------------------
# scans, sources, sinks
# ---------------------------------------------------------------------------

def scan_bronze(spark, sf_dir):
    return _in(spark, sf_dir).bronze


def _season_files(spark, sf_dir) -> str:
    path = scratch_path(spark, "season_files")
    return FS.write_season_files(_in(spark, sf_dir).bronze, path)


def scan_latest_files(spark, sf_dir):
    path = _season_files(spark, sf_dir)
    return FS.read_latest(spark, path, n=2, schema=_in(spark, sf_dir).bronze.schema)


def union_seasons(spark, sf_dir):
    path = _season_files(spark, sf_dir)
    names = FS.list_folders(spark, path)
    return FS.union_seasons(FS.read_each(spark, path, names, _in(spark, sf_dir).bronze.schema))


def _scanned_csv(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    path = event_csv(spark, sf_dir, scratch_path(spark, "csv_files"))
    return FS.scan_csv(spark, path, CSV_SCHEMA, multi_line=True)


def csv_scan(spark, sf_dir):
    """Typed rows of CSV files with quoted fields and line breaks within them."""
    return _scanned_csv(spark, sf_dir)[0]


def csv_rejects(spark, sf_dir):
    """Lines of the same files that do not fit the schema, by how they begin."""
    rejects = _scanned_csv(spark, sf_dir)[1]
    return rejects.groupBy(F.substring_index("line", ",", 1).alias("game_id")).agg(
        F.count(F.lit(1)).alias("rejected"))


def incremental_ingest(spark, sf_dir):
    """Season files streamed into a bronze folder (availableNow), read back."""
    bronze = _in(spark, sf_dir).bronze
    src = _season_files(spark, sf_dir)
    target = scratch_path(spark, "bronze")
    ingest_to_bronze(spark, src, target, bronze.schema)
    return spark.read.schema(bronze.schema).parquet(target)


def table_roundtrip(spark, sf_dir):
    return _saved(spark, sf_dir, _in(spark, sf_dir).event_gold, "play_by_event_gold_copy",
                  "Plays by season and event type")


def _pipeline_checks(spark, sf_dir) -> DataFrame:
    """The checks table of one run of the pipeline per application and input version."""
    i = _in(spark, sf_dir)

    def run() -> str:
        checks = [(f"{c} is known", F.col(c).isNotNull()) for c in P.KNOWN_COLUMNS]
        with C.namespace(spark, _database(sf_dir)) as db:
            tables = medallion(expectations=checks, cuts=i.cuts).run(
                spark, db, {"play_bronze": i.dealt_bronze, "game_bronze": i.game})
        return tables[CHECKS_TABLE]

    return spark.table(shared_value(spark, "medallion run", i.version, run))


def medallion_pipeline(spark, sf_dir):
    """Run bronze -> silver -> gold as tables; each table's rows, counted as it was written."""
    return _pipeline_checks(spark, sf_dir).filter("expectation IS NULL").select("table_name", "rows")


def pipeline_violations(spark, sf_dir):
    """The expectations of the pipeline's silver, counted as it was written."""
    return _pipeline_checks(spark, sf_dir).filter("expectation IS NOT NULL")


def event_lookup(spark, sf_dir):
    """Lookup created by DDL + INSERT, joined to the silver play counts."""
    with C.namespace(spark, _database(sf_dir)) as db:
        lk = C.create_lookup_table(spark, "event_type_lookup", K.EVENT_TYPE_LOOKUP, database=db)
    return A.plays_per_event_name(_in(spark, sf_dir).silver, lk)


def feature_table(spark, sf_dir):
    with C.namespace(spark, _database(sf_dir)) as db:
        C.drop_table(spark, C.qualified("ml_game_features", db))
    return _saved(spark, sf_dir, _in(spark, sf_dir).features, "ml_game_features")


def team_feature_table(spark, sf_dir):
    """The feature table of one home team."""
    base = _in(spark, sf_dir).feature_base
    return _saved(spark, sf_dir, FT.feature_table(base, P.ONE_HOT_VALUES, home_team=P.HOME_TEAM),
                  "ml_team_features")


def unlisted_categories(spark, sf_dir):
    """Rows whose event type or away team the one-hot columns do not list."""
    return FT.unlisted(_in(spark, sf_dir).feature_base, P.ONE_HOT_VALUES)


def preview_rows(spark, sf_dir):
    return (_in(spark, sf_dir).silver.orderBy("game_id", "event_num").limit(P.PREVIEW_ROWS))


# ---------------------------------------------------------------------------
# projection / filter / shaping
# ---------------------------------------------------------------------------

def silver_projection(spark, sf_dir):
    return _in(spark, sf_dir).projected


def silver_typed(spark, sf_dir):
    return _in(spark, sf_dir).typed


def silver_names(spark, sf_dir):
    return _in(spark, sf_dir).named


def forward_fill(spark, sf_dir):
    return _in(spark, sf_dir).filled


def silver_complete(spark, sf_dir):
    return _in(spark, sf_dir).completed


def dedup_plays(spark, sf_dir):
    return _in(spark, sf_dir).silver


def drop_columns(spark, sf_dir):
    return FT.drop_columns(_in(spark, sf_dir).silver)


def normalize_names(spark, sf_dir):
    # categories with blanks make column names with blanks
    return FT.normalize_names(FT.one_hot(_in(spark, sf_dir).feature_base, P.ONE_HOT_VALUES))


def regulation_time(spark, sf_dir):
    return FT.regulation_time(_in(spark, sf_dir).silver)


def one_game(spark, sf_dir):
    return _in(spark, sf_dir).silver.filter(f"game_id = {P.ONE_GAME_ID}")


def person_type_filter(spark, sf_dir):
    s = _in(spark, sf_dir).silver
    return s.filter((F.col("person1type") == 4) & (F.col("person2type") == 5))


def official_teams_either(spark, sf_dir):
    return FT.official_teams(_in(spark, sf_dir).silver, P.OFFICIAL_TEAMS, both=False)


def official_teams_both(spark, sf_dir):
    return FT.official_teams(_in(spark, sf_dir).silver, P.OFFICIAL_TEAMS, both=True)


def rename_teams(spark, sf_dir):
    return FT.rename_teams(_in(spark, sf_dir).silver, P.TEAM_RENAMES)


# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------

def null_profile(spark, sf_dir):
    return Q.null_counts(_in(spark, sf_dir).silver)


def sparse_columns(spark, sf_dir):
    return Q.sparse_columns(_in(spark, sf_dir).silver, P.SPARSE_THRESHOLD)


def column_info(spark, sf_dir):
    return Q.column_info(_in(spark, sf_dir).silver)


def expectation(spark, sf_dir):
    return Q.expectation_report(_in(spark, sf_dir).silver, [
        ("score_margin is not null (before defaults)", F.col("score_margin").isNotNull()),
        ("score_margin_complete is not null", F.col("score_margin_complete").isNotNull()),
    ])


def game_silver(spark, sf_dir):
    return _in(spark, sf_dir).game_silver


def duplicate_count(spark, sf_dir):
    return Q.duplicate_count(_in(spark, sf_dir).bronze)


def table_shape(spark, sf_dir):
    return Q.table_shape(_in(spark, sf_dir).silver)


# ---------------------------------------------------------------------------
# gold + analyst
# ---------------------------------------------------------------------------

def play_by_event_gold(spark, sf_dir):
    return _in(spark, sf_dir).event_gold


def play_by_event_team_gold(spark, sf_dir):
    return M.play_by_event_team_gold(_in(spark, sf_dir).silver)


def play_by_player_gold(spark, sf_dir):
    return _in(spark, sf_dir).player_gold


def team_stats_season_home_gold(spark, sf_dir):
    return _in(spark, sf_dir).home_gold


def team_stats_season_away_gold(spark, sf_dir):
    return _in(spark, sf_dir).away_gold


def season_event_counts(spark, sf_dir):
    i = _in(spark, sf_dir)
    return _saved(spark, sf_dir, A.season_event_counts(i.event_gold, i.lookup), "season_event_counts")


def player_season_event_counts(spark, sf_dir):
    i = _in(spark, sf_dir)
    return _saved(spark, sf_dir, A.player_season_event_counts(i.player_gold, i.lookup),
                  "player_season_event_counts")


def team_stats_margin(spark, sf_dir):
    return _saved(spark, sf_dir, _in(spark, sf_dir).margin_table, "team_stats_margin")


def visual_shots_made(spark, sf_dir):
    i = _in(spark, sf_dir)
    return A.shots_made_by_players(i.player_gold, i.lookup, P.CHOSEN_PLAYERS)


def visual_top_events_by_player(spark, sf_dir):
    # read twice (latest seasons, ranking), so the small gold is written
    i = _in(spark, sf_dir)
    gold = i.shared("play_by_player_gold", lambda: i.player_gold)
    return A.top_events_by_player(gold, i.lookup, P.TOP_K, P.LATEST_SEASONS)


def visual_avg_points(spark, sf_dir):
    return A.avg_points_home_away(_in(spark, sf_dir).margin_table)


def latest_seasons(spark, sf_dir):
    return A.latest_seasons(_in(spark, sf_dir).player_gold, P.LATEST_SEASONS)


# ---------------------------------------------------------------------------
# profiles
# ---------------------------------------------------------------------------

def first_games(spark, sf_dir):
    # silver has the games of bronze; its filter on them reaches the scans
    i = _in(spark, sf_dir)
    return PR.first_groups(i.silver, "game_id", P.FIRST_GAMES, keys_of=i.projected)


def game_name(spark, sf_dir):
    return PR.with_game_name(_in(spark, sf_dir).silver_shared)


def top_shot_makers(spark, sf_dir):
    return PR.top_shot_makers(_in(spark, sf_dir).silver, 1, P.TOP_SHOT_MAKERS)


def top_shot_makers_mean(spark, sf_dir):
    return PR.top_shot_makers_mean(_in(spark, sf_dir).silver, 1, P.TOP_SHOT_MAKERS)


def home_team_play_counts(spark, sf_dir):
    return PR.value_counts(_in(spark, sf_dir).silver, "home_team")


def away_team_play_counts(spark, sf_dir):
    return PR.value_counts(_in(spark, sf_dir).silver, "away_team")


def distinct_teams(spark, sf_dir):
    return PR.distinct_values_long(_in(spark, sf_dir).silver, ["home_team", "away_team"])


def _profiled(spark, sf_dir):
    """The profiled columns of silver alone, written as they are read twice."""
    i = _in(spark, sf_dir)
    return i.shared("profiled", lambda: i.silver.select(*K.PROFILE_NUMERIC_COLUMNS))


def describe_numeric(spark, sf_dir):
    return PR.describe(_profiled(spark, sf_dir), K.PROFILE_NUMERIC_COLUMNS, digits=P.FLOAT_DIGITS)


def corr_matrix(spark, sf_dir):
    return PR.corr_matrix(_in(spark, sf_dir).silver, K.PROFILE_NUMERIC_COLUMNS, P.CORR_DIGITS)


def corr_lower_triangle(spark, sf_dir):
    return PR.corr_lower_triangle(_in(spark, sf_dir).silver, K.PROFILE_NUMERIC_COLUMNS,
                                  P.CORR_DIGITS)


def margin_by_minute(spark, sf_dir):
    return PR.mean_by(_in(spark, sf_dir).silver, ["game_id", "minute_game"],
                      "score_margin_complete", P.FLOAT_DIGITS)


def histogram(spark, sf_dir):
    return PR.histogram(_profiled(spark, sf_dir), "score_margin_complete", P.HISTOGRAM_BINS)


def histograms(spark, sf_dir):
    """Histograms of all six numeric columns."""
    return PR.histograms(_profiled(spark, sf_dir), K.PROFILE_NUMERIC_COLUMNS, P.HISTOGRAM_BINS)


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------

def season_features(spark, sf_dir):
    return FT.season_features(_in(spark, sf_dir).silver)


def calendar_features(spark, sf_dir):
    return FT.calendar_features(_in(spark, sf_dir).silver)


def time_of_day(spark, sf_dir):
    return FT.clock_time(_in(spark, sf_dir).silver)


def lag_40(spark, sf_dir):
    i = _in(spark, sf_dir)
    s = i.silver_shared.select("game_id", "event_num", "score_margin_complete")
    return lag_rows(s, "score_margin_complete", K.MOMENTUM_LAG, "score_margin_40_events_ago", cuts=i.cuts)


def momentum(spark, sf_dir):
    return _in(spark, sf_dir).feature_base


def one_game_lag(spark, sf_dir):
    # one game of silver: the filter reaches the scans
    i = _in(spark, sf_dir)
    g = i.silver.filter(F.col("game_id") == P.ONE_GAME_ID)
    return lag_all_columns(g, K.MOMENTUM_LAG, keep=(), suffix="", cuts=i.cuts)


def one_hot(spark, sf_dir):
    return FT.one_hot(_in(spark, sf_dir).feature_base, P.ONE_HOT_VALUES)


# ---------------------------------------------------------------------------
# models
# ---------------------------------------------------------------------------

def train_split(spark, sf_dir):
    return _in(spark, sf_dir).splits[0]


def test_split(spark, sf_dir):
    return _in(spark, sf_dir).splits[1]


def regression_metrics(spark, sf_dir):
    """Held-out metrics of the naive predictor (margin 40 events ago)."""
    test = _in(spark, sf_dir).splits[1]
    return ML.regression_metrics(test, pred="score_margin_40_events_ago")


def _train_test_cols(spark, sf_dir):
    # both read the written feature table
    train, test = _in(spark, sf_dir).splits
    return train, test, ML.feature_columns(train)


def _model_predictions(spark, sf_dir, name):
    i = _in(spark, sf_dir)
    return i.catalog_model(name).transform(i.splits[1]).select(
        "game_id", "event_num", "minute_game", ML.LABEL, ML.PREDICTION)


def linear_regression(spark, sf_dir):
    return _model_predictions(spark, sf_dir, "linear_regression")


def decision_tree(spark, sf_dir):
    return _model_predictions(spark, sf_dir, "decision_tree")


def cv_metrics(spark, sf_dir):
    train, _, cols = _train_test_cols(spark, sf_dir)
    cat = ML.model_catalog()
    return ML.cv_summary(train, {k: cat[k] for k in ("linear_regression", "decision_tree")},
                         cols)


def grid_search(spark, sf_dir):
    return _in(spark, sf_dir).search[1]


def _errors(model, name: str, train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and MAE of one model on both splits, in one aggregate."""
    both = ML.score_splits(model, train, test)
    return both.groupBy("split").agg(
        F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"),
        F.avg(ML.abs_error(pred="predictions")).alias("mae"))


def model_comparison(spark, sf_dir):
    """Train and test MAE for each regressor in the catalog."""
    i = _in(spark, sf_dir)
    parts = [_errors(i.catalog_model(name), name, *i.splits) for name in ML.model_catalog()]
    return reduce(DataFrame.unionByName, parts).select("model", "split", "rows", "mae")


def best_model_metrics(spark, sf_dir):
    """Held-out R², MSE, MAE (rounded to 3) of the grid-search winner."""
    i = _in(spark, sf_dir)
    return ML.regression_metrics(i.search[0].transform(i.splits[1]))


def ml_results(spark, sf_dir):
    i = _in(spark, sf_dir)
    return _saved(spark, sf_dir, ML.score_splits(i.search[0], *i.splits).drop("split"), "ml_results")


def ml_results_actual(spark, sf_dir):
    """The columns of the predictions table that do not depend on the fit."""
    i = _in(spark, sf_dir)
    return _saved(spark, sf_dir, ML.score_splits(i.catalog_model("decision_tree"), *i.splits).drop("predictions"),
                  "ml_results_actual")


def _stump_model(spark, sf_dir) -> PipelineModel:
    i = _in(spark, sf_dir)
    return i.saved_model("stump", lambda: ML.fit(i.splits[0], ML.stump(), P.STUMP_FEATURES))


def tree_split(spark, sf_dir):
    """The split of a one-level tree: feature, threshold, both predictions (6 digits)."""
    feature, threshold, low, high = ML.first_split(_stump_model(spark, sf_dir), P.STUMP_FEATURES)
    return spark.createDataFrame([(feature, threshold, round(low, 6), round(high, 6))],
                                 "feature string, threshold double, low double, high double")


def tree_errors(spark, sf_dir):
    """Rows and MAE of the one-level tree on the train and test splits."""
    return _errors(_stump_model(spark, sf_dir), "stump", *_in(spark, sf_dir).splits).withColumn(
        "mae", F.round("mae", 6))


def tree_by_minute(spark, sf_dir):
    """Actual and predicted margin by game and minute, one-level tree, both splits."""
    return ML.actual_vs_predicted(ML.score_splits(_stump_model(spark, sf_dir), *_in(spark, sf_dir).splits)).select(
        "game_id", "minute_game", F.round("actual", 6).alias("actual"), F.round("predicted", 6).alias("predicted"))


def tree_cv(spark, sf_dir):
    """Mean and population deviation of the one-level tree's MAE over five folds."""
    train = _in(spark, sf_dir).splits[0]
    return ML.cv_summary(train, {"stump": ML.stump()}, P.STUMP_FEATURES).select(
        "model", F.round("mean_mae", 6).alias("mean_mae"), F.round("std_mae", 6).alias("std_mae"), "folds")


def tree_grid(spark, sf_dir):
    """A grid search of scaled one-level trees over the leaf size."""
    train = _in(spark, sf_dir).splits[0]
    _, table = ML.grid_search(train, P.STUMP_FEATURES, max_depth=(1,), min_instances=P.STUMP_LEAVES, bins=512)
    return table.withColumn("mean_mae", F.round("mean_mae", 6))


def line_of_two(spark, sf_dir):
    """Coefficients of the margin on two features, and the test MAE."""
    i = _in(spark, sf_dir)
    model = i.saved_model("line", lambda: ML.fit(
        i.splits[0], ML.model_catalog()["linear_regression"], P.LINE_FEATURES))
    line = model.stages[-1]
    return model.transform(i.splits[1]).agg(F.round(F.avg(ML.abs_error()), 6).alias("mae")).select(
        *[F.lit(round(float(v), 6)).alias(n) for n, v in
          (("first", line.coefficients[0]), ("second", line.coefficients[1]), ("intercept", line.intercept))], "mae")


def fold_sizes(spark, sf_dir):
    """Games and plays of each cross-validation fold."""
    train, _, _ = _train_test_cols(spark, sf_dir)
    return ML.with_folds(train).groupBy(ML.FOLD).agg(
        F.countDistinct("game_id").alias("games"), F.count(F.lit(1)).alias("plays"))


def simple_regression(spark, sf_dir):
    """Slope and intercept of the margin on the margin 40 events ago."""
    train, _, _ = _train_test_cols(spark, sf_dir)
    model = ML.fit(train, ML.model_catalog()["linear_regression"], ["score_margin_40_events_ago"])
    line = model.stages[-1]
    return spark.createDataFrame([(round(float(line.coefficients[0]), 6), round(float(line.intercept), 6))],
                                 "slope double, intercept double")


def actual_vs_predicted(spark, sf_dir):
    i = _in(spark, sf_dir)
    return ML.actual_vs_predicted(ML.score_splits(i.catalog_model("decision_tree"), *i.splits))


def _dictionary(spark, sf_dir) -> DataFrame:
    """The categories that the feature rows hold, discovered, as a table of the input."""
    i = _in(spark, sf_dir)

    def build() -> str:
        with C.namespace(spark, _database(sf_dir)) as db:
            return C.save_table(FT.category_dictionary(i.feature_base_shared, list(P.ONE_HOT_VALUES)),
                                "category_dictionary", db, comment="Categories of the feature rows")

    return spark.table(shared_value(spark, "category dictionary", i.version, build))


def category_dictionary(spark, sf_dir):
    """The discovered one-hot categories: column, value, code."""
    return _dictionary(spark, sf_dir)


def one_hot_discovered(spark, sf_dir):
    """The feature rows with sparse indicators of all categories that occur."""
    rows = FT.one_hot_positions(_in(spark, sf_dir).feature_base_shared, _dictionary(spark, sf_dir),
                                list(P.ONE_HOT_VALUES))
    return rows.select("game_id", "event_num", "score_margin_complete",
                       F.concat_ws(",", F.col("positions").cast("array<string>")).alias("positions"))


def _team_stats_training(spark, sf_dir):
    t = _in(spark, sf_dir).margin_table.drop("avg_points_against_home",
                                              "avg_points_against_away")
    t = FT.season_features(t).drop("game_year")
    return ML.hash_split(t, ["team_name", "season"])


def random_split(spark, sf_dir):
    return _team_stats_training(spark, sf_dir)


TEAM_STATS_FEATURES = ["count_home", "count_away", "avg_points_for_home", "avg_points_for_away",
                       "season_two_digits"]


def score_new(spark, sf_dir):
    """Linear model of the home/away margin, loaded from disk: its test MSE, and one new
    record scored."""
    data = _team_stats_training(spark, sf_dir)
    test = data.filter(F.col("split") == "test")
    lr = LinearRegression(labelCol="margin", featuresCol="features")
    model = _in(spark, sf_dir).saved_model("team-margin", lambda: ML.fit(
        data.filter(F.col("split") == "train"), lr, TEAM_STATS_FEATURES))
    mse = model.transform(test).agg(
        F.avg((F.col("margin") - F.col("prediction")) ** 2)).first()[0]
    new = spark.createDataFrame([(44, 44, 98.0, 98.0, 24)],
                                "count_home LONG, count_away LONG, avg_points_for_home DOUBLE, "
                                "avg_points_for_away DOUBLE, season_two_digits INT")
    return model.transform(new).select(
        *TEAM_STATS_FEATURES, F.col("prediction").alias("new_record_prediction"),
        F.lit(mse).cast("double").alias("test_mse"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # scans, sources, sinks
    "scan_bronze": scan_bronze,
    "scan_latest_files": scan_latest_files,
    "union_seasons": union_seasons,
    "csv_scan": csv_scan,
    "csv_rejects": csv_rejects,
    "incremental_ingest": incremental_ingest,
    "table_roundtrip": table_roundtrip,
    "medallion_pipeline": medallion_pipeline,
    "pipeline_violations": pipeline_violations,
    "event_lookup": event_lookup,
    "feature_table": feature_table,
    "team_feature_table": team_feature_table,
    "unlisted_categories": unlisted_categories,
    "preview_rows": preview_rows,
    # projection / filter / shaping
    "silver_projection": silver_projection,
    "silver_typed": silver_typed,
    "silver_names": silver_names,
    "forward_fill": forward_fill,
    "silver_complete": silver_complete,
    "dedup_plays": dedup_plays,
    "drop_columns": drop_columns,
    "normalize_names": normalize_names,
    "regulation_time": regulation_time,
    "one_game": one_game,
    "person_type_filter": person_type_filter,
    "official_teams_either": official_teams_either,
    "official_teams_both": official_teams_both,
    "rename_teams": rename_teams,
    # quality
    "null_profile": null_profile,
    "sparse_columns": sparse_columns,
    "column_info": column_info,
    "expectation": expectation,
    "game_silver": game_silver,
    "duplicate_count": duplicate_count,
    "table_shape": table_shape,
    # gold + analyst
    "play_by_event_gold": play_by_event_gold,
    "play_by_event_team_gold": play_by_event_team_gold,
    "play_by_player_gold": play_by_player_gold,
    "team_stats_season_home_gold": team_stats_season_home_gold,
    "team_stats_season_away_gold": team_stats_season_away_gold,
    "season_event_counts": season_event_counts,
    "player_season_event_counts": player_season_event_counts,
    "team_stats_margin": team_stats_margin,
    "visual_shots_made": visual_shots_made,
    "visual_top_events_by_player": visual_top_events_by_player,
    "visual_avg_points": visual_avg_points,
    "latest_seasons": latest_seasons,
    # profiles
    "first_games": first_games,
    "game_name": game_name,
    "top_shot_makers": top_shot_makers,
    "top_shot_makers_mean": top_shot_makers_mean,
    "home_team_play_counts": home_team_play_counts,
    "away_team_play_counts": away_team_play_counts,
    "distinct_teams": distinct_teams,
    "describe_numeric": describe_numeric,
    "corr_matrix": corr_matrix,
    "corr_lower_triangle": corr_lower_triangle,
    "margin_by_minute": margin_by_minute,
    "histogram": histogram,
    "histograms": histograms,
    # features
    "season_features": season_features,
    "calendar_features": calendar_features,
    "time_of_day": time_of_day,
    "lag_40": lag_40,
    "momentum": momentum,
    "one_game_lag": one_game_lag,
    "one_hot": one_hot,
    "category_dictionary": category_dictionary,
    "one_hot_discovered": one_hot_discovered,
    # models
    "train_split": train_split,
    "test_split": test_split,
    "regression_metrics": regression_metrics,
    "random_split": random_split,
    "linear_regression": linear_regression,
    "decision_tree": decision_tree,
    "cv_metrics": cv_metrics,
    "grid_search": grid_search,
    "model_comparison": model_comparison,
    "best_model_metrics": best_model_metrics,
    "ml_results": ml_results,
    "ml_results_actual": ml_results_actual,
    "fold_sizes": fold_sizes,
    "simple_regression": simple_regression,
    "line_of_two": line_of_two,
    "tree_split": tree_split,
    "tree_errors": tree_errors,
    "tree_by_minute": tree_by_minute,
    "tree_cv": tree_cv,
    "tree_grid": tree_grid,
    "actual_vs_predicted": actual_vs_predicted,
    "score_new": score_new,
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)
