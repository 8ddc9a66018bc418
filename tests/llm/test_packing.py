import bisect
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import ODD, docs, small_docs
from courtline.llm import packing, ranks

VOCAB = P.path("byte_bpe_50k.tiktoken")


def best_fit(lengths, capacity):
    """Best fit decreasing, piece by piece: the number of sequences."""
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, x)
        room = rooms.pop(at) if at < len(rooms) else capacity
        n += room == capacity
        if room > x:
            bisect.insort(rooms, room - x)
    return n


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    lengths = [min(capacity, 1 + int(rng.expovariate(4 / capacity))) for _ in range(rng.choice([1, 50, 3000]))]
    rows, n = packing.plan(Counter(lengths), capacity)
    used = Counter()
    taken = Counter()
    for length, first, ranks, each, sequence, offset in rows:
        assert first == taken[length]
        taken[length] += ranks
        for j in range(ranks):
            s, o = sequence + j // each, offset + j % each * length
            assert used[s] == o and o + length <= capacity
            used[s] += length
    assert taken == Counter(lengths) and sorted(used) == list(range(n))
    assert n == best_fit(lengths, capacity)
    assert len(rows) <= 12 * capacity


def test_plan_does_not_grow_with_counts():
    small, _ = packing.plan({i: 1000 + i for i in range(1, 1025)}, 1024)
    large, _ = packing.plan({i: 10 ** 9 + i * 1000 for i in range(1, 1025)}, 1024)
    assert len(large) < 2 * len(small) + 1024


def test_packed_documents(spark):
    texts = [*ODD, "word " * 5000, *(t for _, t in small_docs(spark, 80))]
    rows = packing.pack_documents(docs(spark, texts), VOCAB, P.PATTERN).collect()
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, x in enumerate(texts):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // 1024)))
        assert [p.length for p in pieces][1:] == [1024] * (len(pieces) - 1)
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_encodings_agree():
    t, e = Tokenizer.from_file(P.path("byte_bpe_50k.json")), packing.load_encoding(VOCAB, P.PATTERN)
    rng = random.Random(1)
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for c in rng.sample(points, 3000):
        x = f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} !{chr(c)}  {chr(c)}"
        assert t.encode(x, add_special_tokens=False).ids == e.encode_ordinary(x), c
    assert len(e.encode_ordinary("a" * 200_000)) > 0


def test_empty_and_repeated(spark):
    assert packing.pack_documents(docs(spark, []), VOCAB, P.PATTERN).count() == 0
    rows = packing.pack_documents(docs(spark, ["same text"] * 600, ids=[None] * 600), VOCAB, P.PATTERN).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 600


def test_equal_rows_share_no_bucket(spark):
    """50,000 rows alike, as null ids make them, are numbered by several tasks."""
    rows = spark.range(50_000).selectExpr("1 length", "cast(null as long) doc_id")
    sizes = [r["count"] for r in ranks.with_buckets(rows, ["doc_id"], 5).groupBy("_bucket").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 12_000
    got = ranks.number_within(rows, "length", ["doc_id"], "rank", 50_000)
    assert got.agg(F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()[:] == (50_000, 0, 49_999)
