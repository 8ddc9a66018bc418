"""Gapless numbers in sorted order, for key sets of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.session import materialize


def number_in_order(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within each ``group`` by ``order``.

    A window over a group would sort all of it in one task.  Here the rows are dealt
    by sampled ranges of (group, order) and written with the range's number; each range is
    numbered alone and starts after the group's rows in the ranges before it.  Rows
    should be distinct in (group, order).
    """
    dealt = df.repartitionByRange(F.col(group), *[F.col(o) for o in order]).withColumn(
        "__range", F.spark_partition_id())
    written = materialize(dealt, "numbering")
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (written.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    inside = Window.partitionBy(group, "__range").orderBy(*order)
    numbered = written.withColumn("__row", F.row_number().over(inside) - 1)
    return (numbered.join(starts, [group, "__range"])
            .withColumn(name, (F.col("__start") + F.col("__row")).cast("long"))
            .drop("__range", "__start", "__row"))
