"""File scans: the raw season files, newest-N selection, CSV, and the
season-partitioned layout we write them in.

Season files are written with ``partitionBy("season")``: a read that keeps
only some seasons is then resolved by partition pruning (no data files of the
other seasons are opened).  Listing the folders goes through the Hadoop
``FileSystem`` of the path, so the same code lists local, HDFS or object-store
folders; only folder names reach the driver.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from courtline.session import materialize


def read_bronze(spark: SparkSession, path: str | Sequence[str],
                schema: StructType | None = None, base_path: str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def write_season_files(df: DataFrame, path: str, season_col: str = "season",
                       max_records_per_file: int = 5_000_000) -> str:
    """One folder per season, written in parallel with few, large files.

    The rebalance hint gathers a season's rows, and adaptive execution splits the
    partitions above its advisory size by whole map outputs: a season holding a
    third of all rows, or one row copied many times, is written by many tasks.
    """
    (df.hint("rebalance", season_col).write.mode("overwrite")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(season_col).parquet(path))
    return path


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (sorted), via Hadoop FileSystem."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    names = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            names.append(name)
    return sorted(names)


def latest_paths(spark: SparkSession, path: str, n: int = 2) -> list[str]:
    base = path.rstrip("/")
    return [f"{base}/{name}" for name in list_folders(spark, base)[-n:]]


def read_latest(spark: SparkSession, path: str, n: int = 2,
                schema: StructType | None = None) -> DataFrame:
    """Rows of the ``n`` newest season folders (names sort by season)."""
    return read_bronze(spark, latest_paths(spark, path, n), schema, base_path=path)


def union_seasons(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, duplicates kept; columns missing in a file are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_each(spark: SparkSession, path: str, names: Sequence[str],
              schema: StructType | None = None) -> list[DataFrame]:
    base = path.rstrip("/")
    return [read_bronze(spark, f"{base}/{n}", schema, base_path=base) for n in names]


_CORRUPT = "__corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header line; quotes are doubled within quoted fields.  Pass a schema in
    production: inference reads the data twice.  ``multi_line`` allows line breaks within
    quoted fields, at the price that a file is no longer split between tasks, so files
    should be of moderate size.  A line that does not fit the schema becomes nulls; use
    ``scan_csv`` to tell such lines apart."""
    reader = _csv_reader(spark, multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def _csv_reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE")


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
             ) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files: the lines that fit the schema, typed, and the text of
    those that do not (``file``, ``line``), because a field does not parse or there are too
    few or too many.  The files are parsed once, into a copy that both frames read."""
    declared = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    full = StructType([*declared.fields, StructField(_CORRUPT, StringType())])
    parsed = (_csv_reader(spark, multi_line).schema(full).option("columnNameOfCorruptRecord", _CORRUPT)
              .csv(path).withColumn("__file", F.col("_metadata.file_name")))
    copy = materialize(parsed, "csv")
    rows = copy.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT, "__file")
    rejects = copy.filter(F.col(_CORRUPT).isNotNull()).select(
        F.col("__file").alias("file"), F.col(_CORRUPT).alias("line"))
    return rows, rejects
