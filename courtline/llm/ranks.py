"""Gapless row numbers within a key, for keys of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.session import materialize

#: Rows of a key that one task numbers, on average.
ROWS_PER_BUCKET = 10_000


def with_buckets(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.monotonically_increasing_id()), F.lit(n)))


def number_within(df: DataFrame, key: str, order: list[str], name: str, total: int,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within each ``key``, in any order.

    A window over a key would sort the whole key in one task.  Here a hash of the
    ``order`` columns and of the row's place cuts every key into buckets of about
    ``rows_per_bucket`` rows, also where all rows are alike; each is numbered alone and
    starts after the rows of the buckets before it, which a sum over bucket counts
    tells.  The rows are written with their buckets, as a place may differ when a lost
    task runs again.  Rows alike in all ``order`` columns get their numbers in any order.
    """
    df = materialize(with_buckets(df, order, max(1, -(-total // rows_per_bucket))), "buckets")
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(F.col(key).alias("_key"), F.col("_bucket").alias("_at"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    numbered = df.withColumn("_row", F.row_number().over(inside) - 1)
    joined = numbered.join(starts, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_at")))
    return joined.withColumn(name, (F.col("_start") + F.col("_row")).cast("long")).drop(
        "_bucket", "_key", "_at", "_start", "_row")
