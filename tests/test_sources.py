"""Season files, CSV, catalog round trips, the pipeline runner."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from courtline.functions.constants import EVENT_TYPE_LOOKUP
from courtline.plans.pipeline import medallion
from courtline.plans.queries import Inputs, registry
from courtline.session import ensure_checkpoint_dir, release_scratch, scratch_path, scratch_root
from courtline.sources import catalog as C
from courtline.sources import files as FS


def test_season_files_latest_and_union(spark):
    bronze = Inputs(spark, SF_SMALL).bronze
    path = FS.write_season_files(bronze, scratch_path(spark, "seasons"))
    names = FS.list_folders(spark, path)
    assert names == sorted(names) and len(names) == 5
    latest = FS.read_latest(spark, path, 2)
    seasons = sorted(r[0] for r in latest.select("season").distinct().collect())
    assert seasons == ["2021-22", "2022-23"]
    assert latest.count() == bronze.filter(F.col("season").isin(seasons)).count()
    # the season filter is answered from the folder names (partition pruning)
    pruned = FS.read_bronze(spark, path).filter(F.col("season") == "2022-23")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    assert 0 < pruned.count() < bronze.count()
    union = FS.union_seasons(FS.read_each(spark, path, names))
    assert union.count() == bronze.count()


def test_one_season_of_identical_rows_is_written_by_several_tasks(spark):
    df = spark.range(200_000, numPartitions=8).select(
        F.lit("2022-23").alias("season"), F.lit("the same text " * 20).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        path = FS.write_season_files(df, scratch_path(spark, "seasons"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    back = FS.read_bronze(spark, path)
    assert back.select(F.input_file_name()).distinct().count() > 1 and back.count() == 200_000


def test_a_cluster_needs_a_shared_checkpoint_folder():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_queries_share_one_silver_and_release_it(spark):
    release_scratch(spark)
    for key in ("lag_40", "game_name", "one_hot"):
        registry()[key](spark, SF_SMALL).count()
    names = FS.list_folders(spark, scratch_root(spark))
    assert sum(n.startswith("play_by_play_silver") for n in names) == 1
    release_scratch(spark)
    assert not os.path.exists(scratch_root(spark))


def test_tables_of_two_inputs_live_side_by_side(spark):
    before = spark.catalog.currentDatabase()
    small = registry()["table_roundtrip"](spark, SF_SMALL)
    n = small.count()
    registry()["table_roundtrip"](spark, SF_SMALL.replace("0.001", "0.01")).count()
    assert small.count() == n and spark.catalog.currentDatabase() == before


def test_comments_keep_their_quotes(spark):
    with C.namespace(spark, "courtline_test"):
        name = C.save_table(spark.range(1), "commented", "courtline_test", comment="the team's \\ table")
        assert spark.catalog.getTable(name).description == "the team's \\ table"


def test_csv_read(spark, tmp_path):
    p = tmp_path / "plays.csv"
    p.write_text("game_id,event_num,score\n1,2,0 - 0\n1,3,\n")
    df = FS.read_csv(spark, str(p), "game_id long, event_num int, score string")
    rows = df.orderBy("event_num").collect()
    assert rows[0].score == "0 - 0" and rows[1].score is None
    inferred = FS.read_csv(spark, str(p))
    assert dict(inferred.dtypes)["event_num"] == "int"


CSV = """id,name,score,day
1,"a, ""quoted"" one",1.5,2024-01-02
2,"two
lines",,2024-01-03
x,bad number,1,2024-01-04
4,too,few
5,,7.25,2024-01-05
6,too,1,2024-01-06,many
7,"",0,not a day
8,last,-2,
"""


def test_csv_scan_agrees_with_another_reader(spark, tmp_path):
    """Rows and rejects are those of DuckDB's reader, which skips and stores errors."""
    import duckdb
    p = tmp_path / "plays.csv"
    p.write_text(CSV)
    rows, rejects = FS.scan_csv(spark, str(p), "id INT, name STRING, score DOUBLE, day DATE", multi_line=True)
    con = duckdb.connect()
    theirs = con.sql(f"""SELECT * FROM read_csv('{p}', header = true, quote = '"', escape = '"', strict_mode = true,
        columns = {{'id': 'INTEGER', 'name': 'VARCHAR', 'score': 'DOUBLE', 'day': 'DATE'}}, ignore_errors = true,
        store_rejects = true, null_padding = false, new_line = '\\n')""").fetchall()
    ours = sorted((r.id, r.name or None, r.score, r.day) for r in rows.collect())
    assert ours == sorted((a, b or None, c, d) for a, b, c, d in theirs)
    assert [r[0] for r in ours] == [1, 2, 5, 8] and ours[1][1] == "two\nlines"
    lines = {r.line.split(",")[0] for r in rejects.collect()}
    assert lines == {"x", "4", "6", "7"} and {r.file for r in rejects.collect()} == {"plays.csv"}
    bad = con.sql("SELECT count(DISTINCT line) FROM reject_errors").fetchall()[0][0]
    assert bad == len(lines)


def test_csv_scan_splits_files_without_line_breaks_in_fields(spark, tmp_path):
    p = tmp_path / "many.csv"
    p.write_text("a,b\n" + "".join(f"{i},{i if i % 10 else 'x'}\n" for i in range(5000)))
    rows, rejects = FS.scan_csv(spark, str(p), "a INT, b INT")
    assert rows.count() == 4500 and rejects.count() == 500
    assert rows.agg(F.sum("a")).first()[0] == sum(i for i in range(5000) if i % 10)
    empty = tmp_path / "empty.csv"
    empty.write_text("a,b\n")
    assert [f.count() for f in FS.scan_csv(spark, str(empty), "a INT, b INT")] == [0, 0]


def test_catalog_roundtrip(spark):
    C.use_database(spark, "courtline_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    name = C.save_table(df, "t1", "courtline_test", comment="test table")
    name = C.save_table(df.filter("k = 1"), "t1", "courtline_test")  # replace
    assert C.read_table(spark, name).count() == 1
    assert C.drop_table(spark, name) is True
    assert C.drop_table(spark, name) is False   # missing table: no error
    lk = C.create_lookup_table(spark, "lookup", EVENT_TYPE_LOOKUP, database="courtline_test")
    lk = C.create_lookup_table(spark, "lookup", EVENT_TYPE_LOOKUP, database="courtline_test")
    assert lk.count() == 12 and 11 not in {r.event_id for r in lk.collect()}


def test_pipeline_runner_order_and_tables(spark):
    p = medallion()
    order = [d.name for d in p.order()]
    assert order.index("play_by_play_silver") < order.index("play_by_event_gold")
    assert order.index("overall_game_silver") < order.index("team_stats_season_home_gold")
    i = Inputs(spark, SF_SMALL)
    tables = p.run(spark, "courtline_pipe_test", {"play_bronze": i.bronze, "game_bronze": i.game})
    assert spark.table(tables["play_by_play_silver"]).count() == 1000
    gold = spark.table(tables["play_by_event_gold"])
    assert gold.agg(F.sum("count")).first()[0] == 1000


def test_checkpoint_dir_is_set(spark):
    d = spark.conf.get("spark.checkpoint.dir")
    assert d and os.path.basename(d) == "checkpoints"


def test_cluster_conf_sizes_partitions():
    from courtline.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4)             # 100 TiB of input
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(1)["spark.sql.shuffle.partitions"]) == 200


def test_declared_schemas_match_files(spark):
    from courtline.sources.tables import SCHEMAS, read_table, table_path
    for name in SCHEMAS:
        inferred = spark.read.parquet(table_path(SF_SMALL, name)).schema
        declared = read_table(spark, SF_SMALL, name).schema
        assert [(f.name, f.dataType) for f in inferred] == \
            [(f.name, f.dataType) for f in declared], name
