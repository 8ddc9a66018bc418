"""Score-margin regression with Spark ML (the data never leaves the cluster).

* time-based split (train: not the 4th period and not the last season;
  test: the 4th period of the last season)
* folds from a hash of the row key: no global sort, stable under retries
* cross-validated MAE per model, grid search over a scaled decision tree,
  test metrics, scored rows

Only metric rows (a handful of numbers) are collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from courtline.functions.constants import MODEL_DROP_COLUMNS

LABEL = "score_margin_complete"
FOLD = "fold"
PREDICTION = "prediction"

# Features that would leak the label: the label equals lagged margin + momentum,
# and the current scores determine it.
LEAKY = ("momentum_40", "away_score_complete", "home_score_complete", "event_column",
         "season_two_digits")


# Spark's trees are bounded (at most depth 30) and split on binned values; these are
# its defaults, stated because an unbounded exact tree would differ.
TREE_DEPTH, TREE_BINS = 5, 32


def time_split(features: DataFrame, test_period: int = 4, test_year: int = 2022
               ) -> tuple[DataFrame, DataFrame]:
    """(train, test): train excludes the test period and the test season."""
    train = features.filter((F.col("period") != test_period) & (F.col("game_year") != test_year))
    test = features.filter((F.col("period") == test_period) & (F.col("game_year") == test_year))
    return train, test


def hash_split(df: DataFrame, keys: Sequence[str], test_share_of: int = 5, seed: int = 42
               ) -> DataFrame:
    """Deterministic ~1/``test_share_of`` test split from a hash of ``keys``.

    Unlike ``randomSplit`` the assignment of a row never changes when a task
    is retried or partitions move.
    """
    h = F.pmod(row_hash(keys, seed), F.lit(test_share_of))
    return df.withColumn("split", F.when(h == 0, F.lit("test")).otherwise(F.lit("train")))


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """A number of 32 bits from the MD5 of ``seed|key|key..`` (nulls as empty text):
    the same in every engine, so that a split can be checked outside Spark."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def feature_columns(df: DataFrame, label: str = LABEL,
                    exclude: Sequence[str] = (*MODEL_DROP_COLUMNS, *LEAKY, FOLD)) -> list[str]:
    ex = set(exclude) | {label}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def with_folds(df: DataFrame, k: int = 5, keys: Sequence[str] = ("game_id",),
               seed: int = 42) -> DataFrame:
    """Fold id 0..k-1 from a hash of the game: deterministic under retries, computed
    per row.  A game lies in one fold, as its neighbouring plays share their
    forward-filled score and would tell the held-out fold its answers."""
    return df.withColumn(FOLD, F.pmod(row_hash(keys, seed), F.lit(k)).cast("int"))


def _assembler(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features")


def fit(train: DataFrame, estimator, cols: Sequence[str]):
    """Assemble ``cols`` into a vector and fit ``estimator`` (a PipelineModel)."""
    return Pipeline(stages=[_assembler(cols), estimator]).fit(train)


def stump(bins: int = 512, seed: int = 42) -> DecisionTreeRegressor:
    """A tree of one split.  Features with at most ``bins`` distinct values are split
    exactly, between any two of them."""
    return DecisionTreeRegressor(labelCol=LABEL, featuresCol="features", seed=seed, maxDepth=1, maxBins=bins)


def model_catalog(seed: int = 42) -> dict:
    return {
        "linear_regression": LinearRegression(labelCol=LABEL, featuresCol="features"),
        "decision_tree": DecisionTreeRegressor(labelCol=LABEL, featuresCol="features", seed=seed,
                                               maxDepth=TREE_DEPTH, maxBins=TREE_BINS),
        "random_forest": RandomForestRegressor(labelCol=LABEL, featuresCol="features", seed=seed,
                                               numTrees=20),
        "gradient_boosting": GBTRegressor(labelCol=LABEL, featuresCol="features", seed=seed,
                                          maxIter=20),
    }


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline; it loads in any later session that sees ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def first_split(model: PipelineModel, cols: Sequence[str]) -> tuple[str | None, float | None, float, float]:
    """(feature, threshold, prediction at or below it, prediction above it) of a fitted
    tree's root; (None, None, p, p) if it has no split."""
    root = model.stages[-1]._call_java("rootNode")
    if model.stages[-1].depth == 0:
        value = float(root.prediction())
        return None, None, value, value
    split = root.split()
    return (cols[split.featureIndex()], float(split.threshold()), float(root.leftChild().prediction()),
            float(root.rightChild().prediction()))


def fit_predict(train: DataFrame, score: DataFrame, estimator, cols: Sequence[str]) -> DataFrame:
    return fit(train, estimator, cols).transform(score).drop("features")


def abs_error(label: str = LABEL, pred: str = PREDICTION) -> Column:
    return F.abs(F.col(label) - F.col(pred))


def regression_metrics(scored: DataFrame, label: str = LABEL, pred: str = PREDICTION,
                       digits: int = 3) -> DataFrame:
    """R², MSE, MAE in one aggregate pass, rounded to ``digits``.

    The total sum of squares is the population variance times the count, which
    does not cancel for labels far from zero.  Rows without a label or a prediction
    count nowhere.
    """
    scored = scored.filter(F.col(label).isNotNull() & F.col(pred).isNotNull())
    y = F.col(label).cast("double")
    e = y - F.col(pred).cast("double")
    n = F.count(F.lit(1))
    sst = F.var_pop(y) * n
    return scored.agg(
        n.alias("rows"),
        F.round(F.lit(1.0) - F.try_divide(F.sum(e * e), sst), digits).alias("r2"),
        F.round(F.avg(e * e), digits).alias("mse"),
        F.round(F.avg(F.abs(e)), digits).alias("mae"))


def cv_mae(train: DataFrame, estimator, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Per-fold MAE of ``estimator``: fit on k-1 folds, score the held-out one.

    The k held-out predictions are unioned and reduced in one job.
    """
    data = train if FOLD in train.columns else with_folds(train, k)
    preds = None
    for f in range(k):
        p = fit_predict(data.filter(F.col(FOLD) != f), data.filter(F.col(FOLD) == f),
                        estimator, cols).select(FOLD, LABEL, PREDICTION)
        preds = p if preds is None else preds.unionByName(p)
    return preds.groupBy(FOLD).agg(F.avg(abs_error()).alias("mae"))


def cv_summary(train: DataFrame, models: dict, cols: Sequence[str], k: int = 5) -> DataFrame:
    """(model, mean_mae, std_mae): population std over folds, as the original."""
    parts = []
    for name, est in models.items():
        parts.append(cv_mae(train, est, cols, k).agg(
            F.lit(name).alias("model"),
            F.avg("mae").alias("mean_mae"),
            F.stddev_pop("mae").alias("std_mae"),
            F.count(F.lit(1)).alias("folds")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def grid_search(train: DataFrame, cols: Sequence[str], max_depth=(2, 5, 10),
                min_instances=(1, 2), k: int = 5, parallelism: int = 4, seed: int = 42,
                bins: int = TREE_BINS):
    """Scaled decision tree, grid over depth x leaf size, k-fold CV on MAE
    (smaller is better), refit on all training rows.  Returns (model, table)."""
    data = with_folds(train, k) if FOLD not in train.columns else train
    dt = DecisionTreeRegressor(labelCol=LABEL, featuresCol="scaled", seed=seed, maxBins=bins)
    pipe = Pipeline(stages=[
        _assembler(cols),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        dt])
    grid = (ParamGridBuilder().addGrid(dt.maxDepth, list(max_depth))
            .addGrid(dt.minInstancesPerNode, list(min_instances)).build())
    ev = RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="mae")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, foldCol=FOLD,
                        numFolds=k,
                        parallelism=parallelism, seed=seed)
    model = cv.fit(data)
    rows = []
    best = min(range(len(grid)), key=lambda i: model.avgMetrics[i])
    for i, pm in enumerate(grid):
        rows.append((int(pm[dt.maxDepth]), int(pm[dt.minInstancesPerNode]),
                     float(model.avgMetrics[i]), i == best))
    table = train.sparkSession.createDataFrame(
        rows, "max_depth INT, min_instances_per_node INT, mean_mae DOUBLE, best BOOLEAN")
    return model.bestModel, table


def score_splits(model, train: DataFrame, test: DataFrame,
                 keep: Sequence[str] = ("game_id", "event_num", "minute_game", LABEL)
                 ) -> DataFrame:
    """Predictions on both splits, recombined with a ``split`` label."""
    def one(df, name):
        return (model.transform(df).select(*keep, F.col(PREDICTION).alias("predictions"))
                .withColumn("split", F.lit(name)))
    return one(train, "train").unionByName(one(test, "test"))


def actual_vs_predicted(scored: DataFrame) -> DataFrame:
    return (scored.groupBy("game_id", "minute_game")
            .agg(F.avg(LABEL).alias("actual"), F.avg("predictions").alias("predicted")))
