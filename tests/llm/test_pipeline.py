import corpus_pipeline as pipeline
from cases import ODD, docs
from courtline.llm import queries
from courtline.session import materialize, release_scratch, scratch_root
from courtline.sources.files import list_folders
from test_near_dup import shingle_set

SMALL = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark):
    data = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, n = data.columns, data.count()
    seen = {}
    for name, stage in pipeline.STAGES:
        before = data
        data = materialize(stage(spark, before, SMALL), name)
        seen[name] = data.count()
        if name != "best_fit_packing":
            assert data.columns == columns and seen[name] <= n
            n = seen[name]
            assert data.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        if name == "near_dedup":
            sets = [shingle_set(r.text) for r in data.collect()]
            assert not any(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert data.select("doc_id").distinct().count() == n
    assert data.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def test_stages_take_odd_and_empty_tables(spark):
    for texts in (ODD, []):
        data = docs(spark, texts, clash=False)
        for name, stage in pipeline.STAGES:
            data = materialize(stage(spark, data, SMALL), name)


def test_run_leaves_its_result_only(spark):
    release_scratch(spark)
    n = pipeline.run(spark, SMALL).count()
    assert n > 0 and [x.rsplit("-", 1)[0] for x in list_folders(spark, scratch_root(spark))] == ["best_fit_packing"]


def test_every_operator_has_one_query():
    numbers = [int(k[2:].split("_")[0]) for k in queries.registry()]
    assert sorted(numbers) == list(range(1, 14))
    assert set(queries.oracles()) <= set(queries.registry())
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan",
                                               "best_fit_packing"]
