"""Incremental ingestion: each season file is appended to bronze exactly once."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from courtline.plans.queries import Inputs
from courtline.session import scratch_path
from courtline.sources import files as FS
from courtline.streaming.ingest import ingest_to_bronze


def test_ingest_appends_only_new_files(spark):
    bronze = Inputs(spark, SF_SMALL).bronze
    src = scratch_path(spark, "stream-src")
    target = scratch_path(spark, "stream-bronze")
    ckpt = scratch_path(spark, "stream-ckpt")
    early = bronze.filter(F.col("season") < "2020-21")
    late = bronze.filter(F.col("season") >= "2020-21")
    FS.write_season_files(early, src)
    ingest_to_bronze(spark, src, target, bronze.schema, ckpt)
    first = spark.read.schema(bronze.schema).parquet(target).count()
    assert first == early.count()
    # a later refresh finds the new season folders only
    late.repartition("season").write.mode("append").partitionBy("season").parquet(src)
    ingest_to_bronze(spark, src, target, bronze.schema, ckpt)
    total = spark.read.schema(bronze.schema).parquet(target)
    assert total.count() == bronze.count()
    # re-running with nothing new adds nothing
    ingest_to_bronze(spark, src, target, bronze.schema, ckpt)
    assert spark.read.schema(bronze.schema).parquet(target).count() == bronze.count()
