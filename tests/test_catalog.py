"""Tables are replaced as a whole: readers see the old rows or the new ones."""

import os

import pytest
from pyspark.sql import functions as F

from courtline.operators.quality import expect_all
from courtline.plans.pipeline import CHECKS_TABLE, Dataset, Pipeline
from courtline.sources import catalog as C

DB = "courtline_versions"


@pytest.fixture
def db(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")
    for t in spark.catalog.listTables(DB):
        C.drop_table(spark, C.qualified(t.name, DB))
    return DB


def ids(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def failing(spark):
    return spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id"))


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["part"]}, {"bucket_by": ["id"], "buckets": 2}])
def test_a_failed_write_leaves_the_old_rows(spark, db, layout):
    rows = spark.range(10).withColumn("part", F.col("id") % 3)
    name = C.save_table(rows, "t", db, comment="first", **layout)
    before, root = C.current_location(spark, name), C.table_location(spark, "t", db)
    folders = C.versions(spark, root)
    with pytest.raises(Exception, match="boom"):
        C.save_table(failing(spark).withColumn("part", F.col("id") % 3), "t", db, **layout)
    assert C.current_location(spark, name) == before and C.versions(spark, root) == folders
    assert ids(spark.table(name)) == list(range(10))
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]
    assert spark.catalog.getTable(name).description == "first"


def test_a_frame_read_before_a_replacement_still_runs(spark, db):
    name = C.save_table(spark.range(5), "t", db)
    early = spark.table(name)
    C.save_table(spark.range(100, 103), "t", db, comment="second")
    assert ids(early) == [0, 1, 2, 3, 4] and ids(spark.table(name)) == [100, 101, 102]
    assert spark.catalog.getTable(name).description == "second"
    C.save_table(spark.range(7, 8), "t", db)
    assert ids(spark.table(name)) == [7] and not spark.catalog.getTable(name).description


def test_a_table_replaced_by_a_frame_that_reads_it(spark, db):
    name = C.save_table(spark.range(4), "t", db)
    for _ in range(3):
        C.save_table(spark.table(name).select((F.col("id") + 10).alias("id")), "t", db)
    assert ids(spark.table(name)) == [30, 31, 32, 33]


def test_columns_and_layout_may_change(spark, db):
    name = C.save_table(spark.range(4), "t", db)
    early = spark.table(name)
    wide = spark.range(6).selectExpr("id", "id % 2 part", "cast(id as string) `odd name`")
    C.save_table(wide, "t", db, partition_by=["part"])
    assert spark.table(name).columns == ["id", "odd name", "part"] and ids(early) == [0, 1, 2, 3]
    assert "part=0" in "".join(spark.table(name).filter("part = 0").inputFiles())
    C.save_table(wide.filter("part = 1"), "t", db, partition_by=["part"])
    assert ids(spark.table(name)) == [1, 3, 5]
    C.save_table(wide, "t", db, bucket_by=["id"], buckets=4)
    joined = spark.table(name).join(spark.table(name).withColumnRenamed("part", "p2"), "id").hint("merge")
    assert joined.count() == 6
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert details["Num Buckets"] == "4"
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_old_versions_go_when_two_newer_ones_are_there(spark, db):
    root = C.table_location(spark, "versions_test", db)
    for n in range(1, 5):
        name = C.save_table(spark.range(n), "versions_test", db)
    assert len(C.versions(spark, root)) == 2
    unfinished = os.path.join(root.removeprefix("file:"), "version-00000000000000000001-crashed")
    os.makedirs(unfinished)
    C.drop_old_versions(spark, "versions_test", db, keep=0)
    assert C.versions(spark, root) == [v for v in C.versions(spark, root) if v.endswith(
        C.current_location(spark, name).rsplit("/", 1)[-1])]
    assert os.path.isdir(unfinished) and spark.table(name).count() == 4


def test_lookup_table_is_replaced_as_a_whole(spark, db):
    early = C.create_lookup_table(spark, "lk", [(1, "it's"), (2, None)], database=db)
    now = C.create_lookup_table(spark, "lk", [(3, "c")], database=db)
    assert sorted(r.event_id for r in early.collect()) == [1, 2] and [tuple(r) for r in now.collect()] == [(3, "c")]
    assert [t.name for t in spark.catalog.listTables(db)] == ["lk"]


def test_checks_are_counted_by_the_write_itself(spark, db):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rows = spark.range(50).withColumn("v", F.when(F.col("id") % 5 > 0, F.col("id"))).repartition(3)
    rows = rows.mapInArrow(seen, rows.schema)
    watched, report = expect_all(rows, [("v is known", F.col("v").isNotNull()), ("v is small", F.col("v") < 10)])
    C.save_table(watched, "t", db)
    assert report() == [(None, 50, 0), ("v is known", 50, 10), ("v is small", 50, 42)]
    assert reads.value == 50


def test_pipeline_stores_violations(spark, db):
    p = Pipeline()
    p.add(Dataset("b", lambda a: a.filter("id > 1"), ("a",)))
    p.add(Dataset("a", lambda s: s, ("src",), expectations=(("even", F.col("id") % 2 == 0),)))
    p.add(Dataset("none", lambda a: a.filter("id > 100"), ("a",), expectations=(("none", F.col("id").isNull()),)))
    tables = p.run(spark, db, {"src": spark.range(7)})
    got = sorted(map(str, map(tuple, spark.table(tables[CHECKS_TABLE]).collect())))
    assert got == sorted(map(str, [("a", None, 7, 0), ("a", "even", 7, 3), ("b", None, 5, 0),
                                   ("none", None, 0, 0), ("none", "none", 0, 0)]))
