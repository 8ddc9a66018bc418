"""Catalog tables: atomic create-or-replace, read, drop, lookup table DDL.

On the default session catalog ``CREATE OR REPLACE TABLE`` is not available, and an
overwrite deletes a table's files before the new ones are complete.  Here each write
goes to a folder of its own (a *version*) below the table's folder; the catalog is
switched to it when all files are there, and the version before stays for frames that
still read it.  So a write that fails leaves the table as it was, a frame read before
a replacement still runs, and a table may be replaced by a frame that reads it.

The switch is one catalog call where columns and layout stay the same, and two
renames where they change.  Tables are parquet; a table may be partitioned (seasons)
or bucketed by a join key so that later joins on that key read co-located files
without a shuffle.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from courtline.session import delete_path

#: Complete versions kept behind the current one.
KEEP_VERSIONS = 1


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


@contextmanager
def namespace(spark: SparkSession, name: str) -> Iterator[str]:
    """``name`` is the current database within the block, the caller's one after it."""
    before = spark.catalog.currentDatabase()
    use_database(spark, name)
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)


def table_location(spark: SparkSession, table: str, database: str | None = None) -> str:
    """Folder of a table: ``<database location>/<table>``."""
    db = database or spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(db).locationUri.rstrip("/") + "/" + table


def qualified(table: str, database: str | None = None) -> str:
    return f"`{database}`.`{table}`" if database else f"`{table}`"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def current_location(spark: SparkSession, name: str) -> str | None:
    """The folder that a table reads now, None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def versions(spark: SparkSession, root: str) -> list[str]:
    """The complete versions below a table's folder, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [f.getPath() for f in fs.listStatus(path) if f.isDirectory()]
    return sorted(p.toString() for p in found if p.getName().startswith("version-")
                  and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def drop_old_versions(spark: SparkSession, table: str, database: str | None = None,
                      keep: int = KEEP_VERSIONS) -> list[str]:
    """Delete a table's complete versions but the current one and the ``keep`` before it.
    Frames that read a deleted version must not be used any more.  Versions without
    ``_SUCCESS`` are left alone: a writer may be at work there."""
    current = current_location(spark, qualified(table, database))
    found = versions(spark, table_location(spark, table, database))
    name = (current or "").rsplit("/", 1)[-1]
    older = [v for v in found if v.rsplit("/", 1)[-1] < name]
    gone = older[:max(0, len(older) - keep)]
    for v in gone:
        delete_path(spark, v)
    return gone


def _layout(spark: SparkSession, name: str) -> tuple:
    """Columns and layout of a table: what a switch of its location must not change."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    kept = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
    columns, parts = [], spark.table(name).dtypes
    for r in rows:
        if r["col_name"] in kept:
            columns.append((r["col_name"], r["data_type"]))
    return tuple(parts), tuple(sorted(columns)), tuple(
        c.name for c in spark.catalog.listColumns(name) if c.isPartition)


def _switch(spark: SparkSession, table: str, database: str | None, ddl: str, location: str,
            comment: str | None, partition_by: Sequence[str], bucket_by: Sequence[str], buckets: int) -> None:
    """Point ``table`` at ``location``; whoever reads it sees the old rows or the new."""
    name, mark = qualified(table, database), uuid.uuid4().hex[:8]
    fresh, old = qualified(f"{table}__next_{mark}", database), qualified(f"{table}__old_{mark}", database)
    layout = f" PARTITIONED BY ({_columns(partition_by)})" if partition_by else ""
    if bucket_by and buckets:
        layout += (f" CLUSTERED BY ({_columns(bucket_by)}) SORTED BY ({_columns(bucket_by)})"
                   f" INTO {buckets} BUCKETS")
    note = f" COMMENT {_quoted(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE {fresh} ({ddl}) USING parquet{layout} LOCATION {_quoted(location)}{note}")
    try:
        if partition_by:
            spark.sql(f"ALTER TABLE {fresh} RECOVER PARTITIONS")
        if not spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        elif not partition_by and _layout(spark, fresh) == _layout(spark, name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(location)}")
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('comment' = {_quoted(comment)})" if comment else
                      f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('comment')")
        else:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
            try:
                spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
            except Exception:
                spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
                raise
            spark.sql(f"DROP TABLE {old}")  # external: its files stay for earlier frames
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    spark.catalog.refreshTable(name)


def _new_version(spark: SparkSession, table: str, database: str | None) -> str:
    return f"{table_location(spark, table, database)}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def save_table(df: DataFrame, table: str, database: str | None = None,
               comment: str | None = None, partition_by: Sequence[str] = (),
               bucket_by: Sequence[str] = (), buckets: int = 0, keep: int = KEEP_VERSIONS) -> str:
    """Create or replace a parquet table (idempotent, also across sessions).

    The rows go to a new version; if that fails, it is deleted and the table stays as it
    was.  Of the versions before, the latest ``keep`` stay.
    """
    spark = df.sparkSession
    location = _new_version(spark, table, database)
    w = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        if bucket_by and buckets:
            # only a table write buckets; the table is dropped, its files are the version
            staged = qualified(f"{table}__files_{uuid.uuid4().hex[:8]}", database)
            w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).option("path", location).saveAsTable(staged)
            spark.sql(f"DROP TABLE {staged}")
        else:
            w.save(location)
        ddl = ", ".join(f"{_columns([f.name])} {f.dataType.simpleString()}" for f in df.schema.fields)
        _switch(spark, table, database, ddl, location, comment, partition_by, bucket_by, buckets)
    except Exception:
        if current_location(spark, qualified(table, database)) != location:
            delete_path(spark, location)
        raise
    drop_old_versions(spark, table, database, keep)
    return qualified(table, database)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop if it exists; returns whether it was there.  Faults such as missing
    permissions are raised."""
    existed = spark.catalog.tableExists(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return existed


def create_lookup_table(spark: SparkSession, table: str, rows: Sequence[tuple],
                        columns: str = "event_id INT, event_name STRING",
                        database: str | None = None) -> DataFrame:
    """``CREATE TABLE (cols)`` then ``INSERT ... VALUES`` into a new version, which then
    replaces any table of that name."""
    location = _new_version(spark, table, database)
    staged = qualified(f"{table}__rows_{uuid.uuid4().hex[:8]}", database)
    spark.sql(f"CREATE TABLE {staged} ({columns}) USING parquet LOCATION {_quoted(location)}")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    try:
        spark.sql(f"INSERT INTO {staged} VALUES {values}")
        _switch(spark, table, database, columns, location, None, (), (), 0)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    drop_old_versions(spark, table, database)
    return spark.table(qualified(table, database))


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)
