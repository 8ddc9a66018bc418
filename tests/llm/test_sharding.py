import zlib
from collections import defaultdict

import numpy as np

from cases import ODD, docs, small_docs
from courtline.llm import sharding
from courtline.llm.ranks import number_within


def test_documents_are_placed_once_and_slots_are_gapless(spark):
    texts = [*ODD, *(t for _, t in small_docs(spark)), *["copy of a text"] * 10]
    rows = sharding.shard_documents(docs(spark, texts)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in rows:
        t = texts[r.doc_id]
        assert r.bytes == len((t or "").encode()) + 1 and r.text_crc32 == zlib.crc32((t or "").encode())
        slots[r.shard].append(r.slot)
        shard_of[t].add(r.shard)
    assert set(slots) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())


def test_loads_are_balanced(spark):
    texts = [f"text number {i} " * (1 + i % 37) for i in range(4000)]
    rows = sharding.shard_documents(docs(spark, texts)).collect()
    for column in ("bytes", "tokens", None):
        load = np.bincount([r.shard for r in rows], [r[column] if column else 1 for r in rows], 16)
        assert load.max() < 1.05 * load.mean(), column


def test_a_group_above_a_shard_is_split(spark):
    rows = sharding.shard_documents(docs(spark, ["hot"] * 2000 + [f"other {i}" for i in range(2000)])).collect()
    load = np.bincount([r.shard for r in rows], minlength=16)
    assert load.max() < 1.2 * load.mean()


def test_place_takes_the_highest_dot_product():
    assert sharding.place(np.array([[8., 1, 1], [1, 8, 1], [1, 1, 8], [1, 1, 1]]), 2).tolist().count(0) == 2
    assert sharding.place(np.zeros((0, 3)), 4).tolist() == []


def test_empty_table_and_null_ids(spark):
    assert sharding.shard_documents(docs(spark, [])).count() == 0
    rows = sharding.shard_documents(docs(spark, [None, None, ""], ids=[None, None, None])).collect()
    assert [r.bytes for r in rows] == [1, 1, 1]


def test_numbers_within_a_hot_key(spark):
    df = spark.range(5000).selectExpr("id", "if(id < 4000, 0, id % 7) as key")
    rows = number_within(df, "key", ["id"], "n", 5000, rows_per_bucket=100).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["key"]].append(r.n)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(rows) == 5000
