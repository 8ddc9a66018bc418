"""Feature engineering for the score-margin model.

silver -> dedup -> drop columns -> regulation time -> official teams ->
rename teams -> calendar/season fields -> lagged margin + momentum ->
(optional one team) -> normalised names -> one-hot indicators.

One-hot encoding has two forms.  ``one_hot`` takes declared categories and makes a column
of each; ``category_dictionary`` discovers them, as a table, and ``one_hot_positions`` and
``one_hot_vector`` encode against it sparsely, so their number has no limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from courtline.functions import constants as K
from courtline.functions.expressions import (as_timestamp, replace_values, season_start_year,
                                             season_two_digits, time_of_day)
from courtline.operators.numbering import number_in_order
from courtline.operators.quality import expectation_report
from courtline.operators.windows import SEGMENT_ROWS, Cuts, lag_rows


def drop_columns(df: DataFrame, cols: Sequence[str] = K.FEATURE_DROP_COLUMNS) -> DataFrame:
    return df.drop(*cols)


def regulation_time(df: DataFrame, last_period: int = 4) -> DataFrame:
    return df.filter(F.col("period") <= last_period)


def official_teams(df: DataFrame, teams: Sequence[str], both: bool = True) -> DataFrame:
    """Keep plays where both (``both``) or either team is in ``teams``."""
    home = F.col("home_team").isin(list(teams))
    away = F.col("away_team").isin(list(teams))
    return df.filter((home & away) if both else (home | away))


def rename_teams(df: DataFrame, mapping: dict, cols: Sequence[str] = ("home_team", "away_team")
                 ) -> DataFrame:
    """Dictionary replace of old team names (simultaneous, not chained)."""
    return df.withColumns({c: replace_values(F.col(c), mapping) for c in cols})


def calendar_features(df: DataFrame, date_col: str = "game_date") -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    ts = as_timestamp(F.col(date_col), types.get(date_col))
    return df.withColumns({
        date_col: ts,
        "game_month": F.month(ts),
        "game_day": F.dayofmonth(ts),
    })


def season_features(df: DataFrame, season_col: str = "season") -> DataFrame:
    return df.withColumns({
        "game_year": season_start_year(F.col(season_col)),
        "season_two_digits": season_two_digits(F.col(season_col)),
    })


def clock_time(df: DataFrame, col: str = "wc_time_string", out: str = "time_of_day") -> DataFrame:
    return df.withColumn(out, time_of_day(F.col(col)))


def momentum(df: DataFrame, n: int = K.MOMENTUM_LAG, value: str = "score_margin_complete",
             segment_rows: int | None = SEGMENT_ROWS, drop_warmup: bool = True,
             cuts: Cuts | None = None) -> DataFrame:
    """``value`` n events ago within the game, and the change since then.

    The first ``n`` plays of a game have no lagged value and are dropped when
    ``drop_warmup`` (the original drops rows with a null momentum).
    """
    lagged_name = f"score_margin_{n}_events_ago" if value == "score_margin_complete" \
        else f"{value}_{n}_events_ago"
    out = lag_rows(df, value, n, lagged_name, by="game_id", order="event_num",
                   segment_rows=segment_rows, cuts=cuts)
    out = out.withColumn(f"momentum_{n}", F.col(value) - F.col(lagged_name))
    if drop_warmup:
        out = out.na.drop(subset=[f"momentum_{n}"])
    return out


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with blanks turned into underscores."""
    return df.toDF(*[c.replace(" ", "_").lower() for c in df.columns])


def _dummy_name(col: str, value) -> str:
    return f"{col}_{value}"


def one_hot(df: DataFrame, values: dict[str, Sequence], dtype: str = "tinyint") -> DataFrame:
    """Replace each column of ``values`` by 0/1 indicators named ``<col>_<value>``.

    The categories are declared, so the schema does not depend on the data, no job
    looks for them and their number has no limit; ``unlisted`` reports rows with
    other values, which get all zeros, as nulls do.  Values are compared as
    literals of the column's type, so 0.1 meets a FLOAT 0.1.
    """
    types = dict(df.dtypes)
    exprs = {_dummy_name(c, v): F.when(F.col(c) == F.lit(v).cast(types[c]), 1).otherwise(0).cast(dtype)
             for c, vs in values.items() for v in vs}
    return df.withColumns(exprs).drop(*values)


def unlisted(df: DataFrame, values: dict[str, Sequence]) -> DataFrame:
    """An expectation for each column of ``values``: rows hold a listed value or null."""
    types = dict(df.dtypes)
    return expectation_report(df, [
        (f"{c} is listed", F.col(c).isNull() | F.col(c).isin([F.lit(v).cast(types[c]) for v in vs]))
        for c, vs in values.items()])


def category_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, code): the distinct non-null values of each column as text,
    numbered from 0 in the order of the column's type (numbers by size, all else as text).

    One pass with partial aggregation, whatever the number of values; nothing is
    collected.  Save it as a table: the encodings below join to it.
    """
    types = dict(df.dtypes)
    entries = []
    for c in cols:
        numeric = isinstance(df.schema[c].dataType, NumericType)
        entries.append(F.struct(
            F.lit(c).alias("column_name"),
            (F.col(c).cast("decimal(38,10)") if numeric and types[c] not in ("float", "double")
             else F.lit(None).cast("decimal(38,10)")).alias("size"),
            (F.col(c).cast("double") if types[c] in ("float", "double") else F.lit(None).cast("double")).alias("real"),
            F.col(c).cast("string").alias("value")))
    found = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(
        F.col("value").isNotNull()).distinct()
    return number_in_order(found, "column_name", ["size", "real", "value"], "code").select(
        "column_name", "value", "code")


def encode_categories(df: DataFrame, dictionary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``<col>_code``, the dictionary's code of each value of ``cols`` (null for
    nulls and for values that the dictionary lacks).  A join per column, whose side
    the planner measures."""
    for c in cols:
        entries = dictionary.filter(F.col("column_name") == c).select(
            F.col("value").alias("__value"), F.col("code").alias(f"{c}_code"))
        df = df.join(entries, F.col(c).cast("string") == F.col("__value"), "left").drop("__value")
    return df


def dictionary_sizes(dictionary: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Categories of each column: one number per column reaches the driver."""
    found = {r["column_name"]: r["n"] for r in dictionary.groupBy("column_name").agg(
        (F.max("code") + 1).alias("n")).collect()}
    return {c: found.get(c, 0) for c in cols}


def one_hot_positions(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], out: str = "positions"
                      ) -> DataFrame:
    """``df`` with the positions of its ones in the vector of all indicators (the columns'
    categories side by side, in the order of ``cols``): the sparse form of a one-hot
    encoding, with a schema that does not depend on the data.  Nulls and unknown
    values have no position; the columns of ``cols`` go."""
    sizes, start, spots = dictionary_sizes(dictionary, cols), 0, []
    for c in cols:
        spots.append(F.col(f"{c}_code") + F.lit(start))
        start += sizes[c]
    coded = encode_categories(df, dictionary, cols)
    return coded.withColumn(out, F.array_compact(F.array(*spots))).drop(
        *cols, *[f"{c}_code" for c in cols])


def one_hot_vector(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], out: str = "indicators"
                   ) -> DataFrame:
    """The same indicators as a sparse ML vector column, for estimators; the columns of
    ``cols`` stay.  All zeros for nulls and unknown values."""
    sizes = {c: n for c, n in dictionary_sizes(dictionary, cols).items() if n}
    coded = encode_categories(df, dictionary, cols)
    # a code beyond the last category stands for nulls; dropLast gives it no place
    coded = coded.withColumns({f"{c}_code": F.coalesce(F.col(f"{c}_code"), F.lit(n)).cast("double")
                               for c, n in sizes.items()})
    stages = [VectorAssembler(inputCols=[f"__{c}_ones" for c in sizes], outputCol=out)]
    if sizes:
        encoder = OneHotEncoder(inputCols=[f"{c}_code" for c in sizes], outputCols=[f"__{c}_ones" for c in sizes],
                                dropLast=True, handleInvalid="error")
        # the model needs the largest code of each column only, which the sizes tell
        last = df.sparkSession.createDataFrame([tuple(float(n) for n in sizes.values())],
                                               [f"{c}_code" for c in sizes])
        stages.insert(0, encoder.fit(last))
    for stage in stages:
        coded = stage.transform(coded)
    return coded.drop(*[x for c in cols for x in (f"{c}_code", f"__{c}_ones")])


def feature_base(silver: DataFrame, teams: Sequence[str] | None, renames: dict | None,
                 n: int = K.MOMENTUM_LAG, segment_rows: int | None = SEGMENT_ROWS,
                 dedup: bool = True, cuts: Cuts | None = None) -> DataFrame:
    """Silver -> cleaned, calendar, lagged frame (before one-hot).

    ``dedup=False`` skips the whole-row de-duplication (a full shuffle) when
    the input is known to be distinct already, as the play silver is.  ``cuts`` may be
    those of the plays that silver was made from: the filters only take rows away.
    """
    df = silver.dropDuplicates() if dedup else silver
    df = drop_columns(df)
    df = regulation_time(df)
    if teams is not None:
        df = official_teams(df, teams, both=True)
    if renames:
        df = rename_teams(df, renames)
    df = calendar_features(df)
    df = df.withColumn("game_year", season_start_year(F.col("season")))
    return momentum(df, n, segment_rows=segment_rows, cuts=cuts)


def feature_table(base: DataFrame, values: dict[str, Sequence],
                  home_team: str | None = None) -> DataFrame:
    """The model's input from ``feature_base``: one home team or all, normalised
    names, indicators for the columns of ``values``."""
    if home_team is not None:
        base = base.filter(F.col("home_team") == home_team)
    return normalize_names(one_hot(normalize_names(base), values))
