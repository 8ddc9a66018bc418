"""Exploratory profiles: value counts, summaries, correlations, histograms,
and the data behind the notebook charts.

All of these are aggregates over the whole input.  Wide "one number per
column" profiles are computed in one pass and then unpivoted, so the plan has
a single scan and a single (tiny) shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.operators.quality import sql_text
from courtline.session import materialize

DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first(col)))


def distinct_values_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Melt ``cols`` to (variable, value), then the sorted distinct values."""
    long = df.unpivot([], list(cols), "variable", "value")
    return long.select("value").distinct().orderBy(F.asc_nulls_first("value"))


def first_groups(df: DataFrame, key: str = "game_id", n: int = 20,
                 keys_of: DataFrame | None = None) -> DataFrame:
    """Rows of the first ``n`` distinct keys in key order.  ``keys_of`` is a cheaper
    frame with the same keys to take them from (default: ``df``).

    The key list is a top-``n`` (partial top-k per partition, then one merge),
    bounded by ``n`` rows, so it is broadcast into a semi-join.
    """
    keys = (df if keys_of is None else keys_of).select(key).distinct().orderBy(
        F.asc_nulls_last(key)).limit(n)
    return df.join(F.broadcast(keys), key, "left_semi")


def describe(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = DESCRIBE_PROBS,
             approx: bool = False, accuracy: int = 100_000, digits: int | None = None
             ) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max per column, one row per column.

    Quartiles are exact (linear interpolation between closest ranks, as pandas) and
    found by ``exact_ranks``, which reads the columns a few times and neither shuffles
    nor writes them; NaN is ranked as the largest value, as Spark sorts it.
    ``approx=True`` uses ``percentile_approx`` instead.  ``digits`` rounds mean and std.
    """
    cols = list(cols)
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    base = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"count{i}"),
        rnd(F.avg(c).cast("double")).alias(f"mean{i}"),
        rnd(F.stddev_samp(c)).alias(f"std{i}"),
        F.min(c).cast("double").alias(f"min{i}"),
        F.max(c).cast("double").alias(f"max{i}"))])
    stack = ", ".join(
        f"{sql_text(c)}, count{i}, mean{i}, std{i}, min{i}, max{i}" for i, c in enumerate(cols))
    stats = base.selectExpr(
        f"stack({len(cols)}, {stack}) as (column_name, count, mean, std, min, max)")

    names = [f"p{int(round(p * 100))}" for p in probs]
    if approx:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
            for c in cols])).alias("kv")).select("kv.*").filter(F.col("value").isNotNull())
        q = long.groupBy("column_name").agg(*[
            F.percentile_approx("value", p, accuracy).alias(n) for p, n in zip(probs, names)])
        return stats.join(q, "column_name", "left").select(
            "column_name", "count", "mean", "std", "min", *names, "max")

    srows = {r["column_name"]: r for r in stats.collect()}     # one row per column
    quant = exact_quantiles(df, {c: srows[c]["count"] for c in cols}, probs)
    out = []
    for c in cols:
        r = srows[c]
        out.append((c, r["count"], r["mean"], r["std"], r["min"],
                    *[quant.get((c, p)) for p in probs], r["max"]))
    schema = ("column_name string, count long, mean double, std double, min double, "
              + ", ".join(f"{n} double" for n in names) + ", max double")
    return df.sparkSession.createDataFrame(out, schema)


#: Size of the sketches that bracket ranks, and the share of all rows by which a bracket
#: exceeds a rank on either side: some three times the sketch's error.
SKETCH_SIZE, BRACKET_MARGIN = 4096, 0.004
#: Distinct values within brackets that the driver takes; beyond it the rows within
#: brackets are written and bracketed anew.
BRACKET_VALUES = 20_000


def exact_ranks(df: DataFrame, values: dict[str, Column], ranks: dict[str, list[int]],
                margin: float = BRACKET_MARGIN) -> dict[tuple[str, int], float]:
    """{(name, rank): value}: for each named double column of ``df`` the non-null values of
    the wanted ranks (from 0, ascending, NaN last).

    One pass sketches all columns (KLL) and brackets every rank by two values.  One counts
    the rows below each bracket, and one groups the values within brackets, a small share
    of all rows, however many rows are equal.  Together they prove that a bracket holds
    its rank; one that does not is widened.
    """
    names = [n for n in values if ranks.get(n)]
    if not names:
        return {}
    number = {n: F.when(~F.isnan(values[n]), values[n]) for n in names}
    counts = df.agg(*[F.count(number[n]).alias(f"n{i}") for i, n in enumerate(names)],
                    *[F.kll_sketch_agg_double(number[n], F.lit(SKETCH_SIZE)).alias(f"s{i}")
                      for i, n in enumerate(names)])
    wanted = []
    for i, n in enumerate(names):
        wanted.append(F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(
            f"s{i}", F.expr(f"array({', '.join(f'{q / 1000}D' for q in range(1001))})"))).alias(f"q{i}"))
    found = counts.select(*wanted, *[f"n{i}" for i in range(len(names))]).first()
    out: dict[tuple[str, int], float] = {}
    sizes = {n: found[f"n{i}"] for i, n in enumerate(names)}
    grid = {n: found[f"q{i}"] for i, n in enumerate(names)}
    pending = {n: sorted({r for r in ranks[n] if r < sizes[n]}) for n in names}
    out |= {(n, r): float("nan") for n in names for r in ranks[n] if r >= sizes[n]}
    while any(pending.values()):
        spans: list[tuple[str, float, float, list[int]]] = []
        for n in names:
            for r in pending[n]:
                low, high = r / sizes[n] - margin, (r + 1) / sizes[n] + margin
                # the grid's ends are no bounds: they are open
                low = grid[n][int(low * 1000)] if low > 0.001 else -math.inf
                high = grid[n][math.ceil(high * 1000)] if high < 0.999 else math.inf
                if spans and spans[-1][0] == n and low <= spans[-1][2]:
                    spans[-1] = (n, spans[-1][1], max(high, spans[-1][2]), [*spans[-1][3], r])
                else:
                    spans.append((n, low, high, [r]))
        below = df.agg(*[F.count_if(number[n] < low) for n, low, _, _ in spans]).first()
        at = {n: F.coalesce(*[F.when(number[n].between(low, high), F.lit(i))
                              for i, (m, low, high, _) in enumerate(spans) if m == n], F.lit(None).cast("int"))
              for n in names}
        rows = df.select(F.explode(F.array(*[F.struct(at[n].alias("at"), number[n].alias("value")) for n in names]))
                         .alias("e")).select("e.*").filter(F.col("at").isNotNull())
        pairs = rows.groupBy("at", "value").agg(F.count(F.lit(1)).alias("rows"))
        listed = pairs.limit(BRACKET_VALUES + 1).collect()
        margin *= 4
        if len(listed) <= BRACKET_VALUES:
            by_span: list[list] = [[] for _ in spans]
            for p in sorted(listed, key=lambda p: p["value"]):
                by_span[p["at"]].append(p)
        else:
            kept = materialize(rows, "brackets")
            held = {r["at"]: r["n"] for r in kept.groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect()}
            inner = exact_ranks(kept, {str(i): F.when(F.col("at") == i, F.col("value")) for i in held},
                                {str(i): [r - below[i] for r in spans[i][3] if 0 <= r - below[i] < held[i]] for i in held})
            out |= {(spans[int(i)][0], r + below[int(i)]): v for (i, r), v in inner.items()}
            by_span = [[] for _ in spans]
        for i, (n, _, _, wanted_ranks) in enumerate(spans):
            for r in wanted_ranks:
                left = r - below[i]
                for p in by_span[i] if left >= 0 else ():
                    left -= p["rows"]
                    if left < 0:
                        out[n, r] = p["value"]
                        break
        pending = {n: [r for r in pending[n] if (n, r) not in out] for n in names}
    return out


def exact_quantiles(df: DataFrame, counts: dict[str, int], probs: Sequence[float]) -> dict:
    """Exact quantiles of columns; ``counts`` has the rows of each.  Returns {(column, p):
    value}, without the columns that have no rows."""
    plan: dict[tuple[str, float], tuple[int, int, float]] = {}
    targets: dict[str, list[int]] = {}
    for c, n in counts.items():
        for p in probs if n else ():
            pos = p * (n - 1)
            r0 = int(pos // 1)
            r1 = min(r0 + 1, n - 1)
            plan[c, p] = (r0, r1, pos - r0)
            targets.setdefault(c, []).extend({r0, r1})
    found = exact_ranks(df, {c: F.col(c).cast("double") for c in targets}, targets)
    out = {}
    for (c, p), (r0, r1, frac) in plan.items():
        v0, v1 = found[c, r0], found[c, r1]
        out[c, p] = v0 + (v1 - v0) * frac if frac else v0
    return out


def co_moments(df: DataFrame, cols: Sequence[str]) -> list:
    """One row for each set of columns that is null together: ``present`` (a bit for each
    column that is not), ``n``, the means ``m<i>`` and the mean products of deviations
    ``c<i>_<j>`` of the columns that are there.

    Within such a set every pair of columns has the same rows, so one mean for each
    column and one co-moment for each pair do for all correlations: 28 aggregates for
    six columns.  There are at most 2 ** columns rows, and one where nothing is null.
    """
    values = [F.col(c).cast("double") for c in cols]
    present = reduce(lambda a, b: a + b, (F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(0)
                                          for i, c in enumerate(cols)))
    return df.groupBy(present.alias("present")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.covar_pop(values[i], values[j]).alias(f"c{i}_{j}")
          for i in range(len(cols)) for j in range(i, len(cols))]).collect()


def _pair_correlation(rows: list, i: int, j: int) -> float | None:
    """Pearson's correlation of the rows that hold both columns, merged from the
    co-moments of the sets; null if a column is constant or there are no two rows."""
    n, mx, my, xx, yy, xy = 0, 0.0, 0.0, 0.0, 0.0, 0.0
    for r in rows:
        if r["present"] >> i & 1 and r["present"] >> j & 1:
            k, a, b = r["n"], r[f"m{i}"] - mx, r[f"m{j}"] - my
            share = n * k / (n + k)
            xx += k * r[f"c{i}_{i}"] + a * a * share
            yy += k * r[f"c{j}_{j}"] + b * b * share
            xy += k * r[f"c{min(i, j)}_{max(i, j)}"] + a * b * share
            n, mx, my = n + k, mx + a * k / (n + k), my + b * k / (n + k)
    if n < 2 or xx == 0 or yy == 0:
        return None
    return xy / (math.sqrt(xx) * math.sqrt(yy))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """Pairwise-complete Pearson correlations, one pass, long form (a, b, corr).

    A pair with a constant column has a null; so has the diagonal of one.  The pass runs
    when the frame is built: it leaves one small row for each set of columns that
    are null together.
    """
    cols = list(cols)
    rows = co_moments(df, cols)
    out = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            r = _pair_correlation(rows, i, j)
            out.append((a, b, i, j, r if r is None else round(r, digits)))
    return df.sparkSession.createDataFrame(
        out, "column_a string, column_b string, i int, j int, corr double")


def corr_lower_triangle(df: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """The strictly lower triangle of the matrix (what the masked heat map shows)."""
    return corr_matrix(df, cols, digits).filter(F.col("i") > F.col("j"))


def histograms(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max of each column; the top edge is closed.

    One aggregate fetches (min, max) of all columns to the driver; the binning is
    then one pass over (column, bin) pairs.  Empty bins are reported with count 0, a
    constant column puts every value in bin 1, a column without values has no bins.
    """
    edges = df.agg(*[f(c).cast("double") for c in cols for f in (F.min, F.max)]).first()
    spans = {c: (edges[2 * i], edges[2 * i + 1]) for i, c in enumerate(cols) if edges[2 * i] is not None}
    spark = df.sparkSession
    rows = [(c, b, lo + (b - 1) * ((hi - lo) / bins), hi if b == bins else lo + b * ((hi - lo) / bins))
            for c, (lo, hi) in spans.items() for b in range(1, bins + 1)]
    table = spark.createDataFrame(rows, "column_name STRING, bin INT, lower DOUBLE, upper DOUBLE")
    if not spans:
        return table.withColumn("count", F.lit(0).cast("long"))

    def bin_of(c, lo, hi):
        v = F.col(c).cast("double")
        if lo == hi:
            return F.when(v.isNotNull(), 1)
        at = F.floor((v - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)).cast("int") + 1
        return F.when(v.isNotNull(), F.least(at, F.lit(bins)))

    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), bin_of(c, *span).alias("bin"))
        for c, span in spans.items()])).alias("x")).select("x.*").filter("bin is not null")
    counts = long.groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("count"))
    return table.join(counts, ["column_name", "bin"], "left").select(
        "column_name", "bin", "lower", "upper",
        F.coalesce("count", F.lit(0).cast("long")).alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """``histograms`` of one column."""
    return histograms(df, [col], bins).drop("column_name")


def mean_by(df: DataFrame, keys: Sequence[str], value: str, digits: int | None = None
            ) -> DataFrame:
    """Mean, count and sample std of ``value`` per key (line-plot estimator)."""
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return df.groupBy(*keys).agg(
        rnd(F.avg(value)).alias("mean"),
        F.count(value).alias("n"),
        rnd(F.stddev_samp(value)).alias("std"))


def top_shot_makers(df: DataFrame, event_type: int = 1, k: int = 20) -> DataFrame:
    """Top ``k`` (game, team, player) by number of plays of ``event_type``."""
    g = (df.filter(F.col("event_type") == event_type)
         .groupBy("game_id", "player1_team_abbreviation", "player1_name")
         .agg(F.sum("event_type").cast("long").alias("event_type_sum"),
              F.count(F.lit(1)).alias("shots")))
    return g.orderBy(F.desc("shots"), "game_id", F.asc_nulls_first("player1_team_abbreviation"),
                     F.asc_nulls_first("player1_name")).limit(k)


def top_shot_makers_mean(df: DataFrame, event_type: int = 1, k: int = 20) -> DataFrame:
    """Mean shots per (player, team) over the top-``k`` rows (the bar heights)."""
    top = top_shot_makers(df, event_type, k)
    return (top.groupBy("player1_name", "player1_team_abbreviation")
            .agg(F.avg("shots").alias("mean_shots"), F.count(F.lit(1)).alias("games")))


def game_names(df: DataFrame, sep: str = "-") -> DataFrame:
    """Per game: season + the distinct team abbreviations of both player
    columns, sorted and joined by ``sep`` (nulls skipped)."""
    g = df.groupBy("game_id").agg(
        F.min("season").alias("__season"),
        F.collect_set("player1_team_abbreviation").alias("__t1"),
        F.collect_set("player2_team_abbreviation").alias("__t2"))
    teams = F.array_sort(F.array_distinct(F.concat("__t1", "__t2")))
    return g.select("game_id", F.concat_ws(sep, F.col("__season"), F.array_join(teams, sep))
                    .alias("game_name"))


def with_game_name(df: DataFrame, sep: str = "-") -> DataFrame:
    """Rows with their game name attached (grouped result joined back)."""
    return df.join(game_names(df, sep), "game_id", "left")
