"""Session construction and shared-storage locations.

On a cluster the deployment owns ``spark.checkpoint.dir`` (a shared, durable
folder) and a session without it is refused.  Only for a local master, where
driver and executors are one process, is a temporary folder made.  Every scratch
path used by the library hangs off that setting; ``release_scratch`` deletes what
a session has written there.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "courtline", extra: dict | None = None,
                input_bytes: int | None = None) -> SparkSession:
    """Session with AQE, UTC and no UI.  ``input_bytes`` (the size of the
    parquet input) applies ``cluster_conf`` sizing for a cluster run."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if input_bytes:
        conf.update(cluster_conf(input_bytes))
    for k, v in conf.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20,
                 broadcast_bytes: int = 64 << 20) -> dict:
    """Settings sized for a large cluster run over ``input_bytes`` of parquet.

    * scan splits and post-shuffle partitions target ``partition_bytes``
      (AQE coalesces small ones and splits skewed ones at run time), so a
      task's sort/aggregate buffer fits executor memory and spills rarely;
    * the initial shuffle partition count is the input size over that target,
      so the biggest shuffle (silver's window) starts with enough reducers;
    * a join side is broadcast only under ``broadcast_bytes``, measured.
    """
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.  If unset, a local master gets a temporary
    one; any other raises, as its executors could not see such a folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = tempfile.mkdtemp(prefix="courtline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end of the block, all scratch folders named within it.  So what the
    block computes must be written elsewhere (to a path taken before) by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_path(spark, path)


def scratch_root(spark: SparkSession) -> str:
    """The folder that holds all scratch data of this application."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/courtline-scratch/{spark.sparkContext.applicationId}"


_SHARED: dict[tuple[str, str, str], object] = {}


def input_version(spark: SparkSession, folder: str) -> str:
    """``folder`` with a digest of its files' names, sizes and modification times, from
    one recursive listing: another text as soon as the input changes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listing = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    files = []
    while listing.hasNext():
        f = listing.next()
        files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return f"{folder}@{zlib.crc32(chr(10).join(sorted(files)).encode()):08x}"


def shared_value(spark: SparkSession, name: str, source: str, build):
    """``build()``, once for each (application, source, name).  ``source`` names a version
    of the input; ``release_scratch`` forgets all values."""
    key = (spark.sparkContext.applicationId, source, name)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def shared_copy(spark: SparkSession, name: str, source: str, build):
    """``materialize(build(), name)``, once for each (application, source, name): later
    calls read the copy."""
    def write() -> str:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        return path

    return spark.read.parquet(shared_value(spark, f"copy of {name}", source, write))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_scratch(spark: SparkSession) -> None:
    """Deletes everything this application has written to scratch folders.  Frames
    that still read from there must not be used any more."""
    app = spark.sparkContext.applicationId
    delete_path(spark, scratch_root(spark))
    for key in [k for k in _SHARED if k[0] == app]:
        del _SHARED[key]


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    return a frame that reads it back.

    This cuts the lineage like ``checkpoint()``, but the copy is columnar:
    later readers prune columns and push filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
