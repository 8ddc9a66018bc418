"""What a Python worker holds: it stays with the executor when its task has ended."""

import tracemalloc

import public_tokenizers
import pyarrow as pa

from cases import docs
from courtline.llm import common, near_dup, packing, secrets
from test_near_dup import near_texts


def test_few_rows_of_a_batch_are_python_values_at_once():
    batch = pa.RecordBatch.from_pydict({"i": range(4000), "t": [f"{i:01000}" for i in range(4000)]})
    tracemalloc.start()
    seen = sum(i == int(t) for i, t in common.rows_of([batch, batch.slice(0, 0), batch.slice(3999)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 4001 and peak < 2e6


def test_few_words_are_remembered():
    hashes = common.WordHashes()
    words = [b"w%d" % i for i in range(300_000)]
    assert len(set(hashes.of(words).tolist())) == 300_000 and len(hashes) <= 1 << 17


def test_one_vocabulary_for_all_operators():
    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    assert secrets.load_vocabulary(*where) is packing.load_encoding(*where)


def test_sets_take_one_python_pass(spark, monkeypatch):
    plans, write = {}, near_dup.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(near_dup, "materialize", noted)
    near_dup.near_duplicates(docs(spark, near_texts(3, groups=1)))
    assert plans["sets"].count("MapInArrow") == 1


def test_packing_plan_needs_no_python_worker(spark):
    pieces = spark.range(50).selectExpr("id as doc_id", "0 as piece", "0L as start", "id + 1 as length",
                                        "0L as ids_crc32")
    packed = packing.pack(pieces, 64)
    assert "ExistingRDD" not in packed._jdf.queryExecution().executedPlan().toString()
    assert packed.count() == 50
    assert packing.pack(pieces.limit(0), 64).count() == 0
