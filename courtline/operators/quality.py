"""Data-quality checks: expectations, null profiles, duplicates, shape.

Every check is a single aggregate pass over the data; only the one-row (or
one-row-per-column) result ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def expect(df: DataFrame, name: str, predicate: Column) -> tuple[DataFrame, Observation]:
    """Warn-mode expectation: rows pass through untouched, and the number of
    violating rows is counted as a side metric of whatever action runs next."""
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                     F.count_if(~F.coalesce(predicate, F.lit(False))).alias("violations"))
    return out, obs


def expect_all(df: DataFrame, checks: Sequence[tuple[str, Column]] = ()
               ) -> tuple[DataFrame, Callable[[], list[tuple[str | None, int, int]]]]:
    """``df``, observed, and a function that tells, once the frame has been written, the
    rows and the violations of each check: (None, rows, 0) for the frame, then
    (name, rows, violations).  The counts are side metrics of the write, so no further
    pass over the data is needed; rows that violate a check are kept."""
    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(~F.coalesce(p, F.lit(False))).alias(f"v{i}") for i, (_, p) in enumerate(checks)])

    def report() -> list[tuple[str | None, int, int]]:
        found = obs.get
        return [(None, found["rows"], 0),
                *((name, found["rows"], found[f"v{i}"]) for i, (name, _) in enumerate(checks))]

    return out, report


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expectation_report(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per (name, predicate): rows and violating rows, all in one pass.

    A null predicate result counts as a violation (as the SQL ``IS NOT NULL``
    style expectations intend).
    """
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(~F.coalesce(p, F.lit(False))).alias(f"v{i}") for i, (_, p) in enumerate(checks)])
    stack = ", ".join(f"{sql_text(name)}, v{i}" for i, (name, _) in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) as (expectation, violations)", "rows").select(
        "expectation", "rows", "violations")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count, row_count) — one aggregate pass, then unpivot."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"{sql_text(c)}, n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) as (column_name, null_count)", "__rows as row_count")


def _kind(dtype) -> str | None:
    if isinstance(dtype, NumericType):
        return "numeric"
    if isinstance(dtype, StringType):
        return "string"
    return None


def sparse_columns(df: DataFrame, threshold: float = 0.9, kind: str | None = None) -> DataFrame:
    """Columns whose null share is strictly above ``threshold``.

    ``kind`` = 'string' / 'numeric' restricts to that family (None: both).
    """
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
    cols = [c for c, k in kinds.items() if k is not None and (kind is None or k == kind)]
    kind_map = F.create_map(*[F.lit(x) for c in cols for x in (c, kinds[c])])
    nc = null_counts(df, cols)
    return (nc.filter(F.col("null_count") > F.lit(threshold) * F.col("row_count"))
            .select("column_name", F.element_at(kind_map, F.col("column_name")).alias("kind"),
                    "null_count", "row_count"))


def column_info(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null) like a frame's ``info()``."""
    fields = df.schema.fields
    types = F.create_map(*[F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())])
    pos = F.create_map(*[F.lit(x) for i, f in enumerate(fields) for x in (f.name, i)])
    nc = null_counts(df)
    return nc.select(
        F.element_at(pos, F.col("column_name")).alias("position"),
        "column_name",
        F.element_at(types, F.col("column_name")).alias("data_type"),
        (F.col("row_count") - F.col("null_count")).alias("non_null"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row: count(*) - count(distinct row).

    Computed as one grouping by the whole row (partial aggregation first), so
    a row copied a billion times is collapsed map-side.
    """
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long")
                 .alias("duplicate_rows"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))
