import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ODD, SCHEMA, docs
from courtline.llm import language
from courtline.llm.queries import registry

MEDIUM = "/root/testdata/sf0.01"


def sigmoid(v):
    return 1 / (1 + math.exp(-v))


def one_segment(net, body):
    """Position probabilities of one segment, by scalar loops."""
    table, recur, out, bias = (a.astype(float) for a in net.arrays())
    hidden = recur.shape[2]
    sides = []
    for side, seq in ((0, body), (1, body[::-1])):
        h, states = [0.0] * hidden, []
        for byte in seq:
            x = table[side, :, byte]
            u = [sum(recur[side, k, j] * h[j] for j in range(hidden)) for k in range(3 * hidden)]
            r = [sigmoid(x[k] + u[k]) for k in range(hidden)]
            z = [sigmoid(x[k] + u[k]) for k in range(hidden, 2 * hidden)]
            n = [math.tanh(x[2 * hidden + k] + r[k] * u[2 * hidden + k]) for k in range(hidden)]
            h = [(1 - z[k]) * n[k] + z[k] * h[k] for k in range(hidden)]
            states.append(h)
        sides.append(states)
    found = []
    for t in range(len(body)):
        logits = [out[0, k] @ sides[0][t] + out[1, k] @ sides[1][len(body) - 1 - t] + bias[k, 0]
                  for k in range(len(bias))]
        e = [math.exp(v - max(logits)) for v in logits]
        found.append([v / sum(e) for v in e])
    return found


def test_pooled_equals_scalar_network(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 11)
    monkeypatch.setattr(language, "WIDTH", 4)
    net = language.start(3, 5, seed=4)
    net.table[:, :, :256] *= 3
    bodies = [b"a", b"hello world, this is longer than a segment", bytes(range(256)), "éñ 漢".encode(), b"x" * 22]
    marks = []
    got = language.pooled(net, bodies, marks)
    labels = []
    for body, p in zip(bodies, got):
        every = [q for at in range(0, len(body), 11) for q in one_segment(net, body[at:at + 11])]
        assert np.allclose(np.mean(every, axis=0), p, atol=1e-5)
        labels += [int(np.argmax(q)) for q in every]
    assert marks[0].tolist() == labels
    assert np.allclose(got.sum(axis=1), 1, atol=1e-5)


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    net = language.start(3, 4, dtype=np.float64)
    x = rng.integers(97, 100, size=(7, 5)).astype(np.intp)
    x[5:, 1], x[2:, 3] = language.PAD, language.PAD
    y = np.array([0, 1, 2, 1, 0])
    _, grads = language.gradients(net, x, y)
    for a, g in zip(net.arrays(), grads):
        for _ in range(20):
            spot = tuple(int(rng.integers(0, s)) for s in a.shape)
            if a is net.table:
                spot = (*spot[:2], int(rng.integers(97, 100)))
            old, losses = a[spot], []
            for step in (1e-6, -1e-6):
                a[spot] = old + step
                losses.append(language.gradients(net, x, y)[0])
            a[spot] = old
            assert abs((losses[0] - losses[1]) / 2e-6 - g[spot]) < 1e-7


@pytest.fixture(scope="module")
def model(spark):
    data = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    return language.train(data, usable=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def test_query_held_out_accuracy(spark):
    rows = registry()["op12_language"](spark, MEDIUM).collect()
    truth = {r.doc_id: r for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    right = total = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        letters = any(map(str.isalpha, truth[r.doc_id].text or ""))
        assert (r.lang_pred == "und") == (not letters)
        if r.held_out and letters and truth[r.doc_id].lang:
            total += 1
            right += r.lang_pred == truth[r.doc_id].lang
    assert total > 100 and right >= 0.97 * total, (right, total)


def test_odd_rows(spark, model):
    texts = [*ODD, "12 34 .,!", "the and of " * 60_000, "ª"]
    data = docs(spark, texts, ids=[None, 3, 3, *range(10, 10 + len(texts) - 3)])
    rows = language.predict_documents(data, model, held_out=F.col("doc_id") == 3).collect()
    assert len(rows) == len(texts)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in data.collect())
    got = {r.doc_id: r for r in rows if r.doc_id not in (None, 3)}
    for i, t in list(enumerate(texts))[3:]:
        assert (got[i + 7].lang_pred == "und") == (not any(map(str.isalpha, t))), t
        assert 0 <= got[i + 7].score <= 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    empty = language.predict_documents(docs(spark, []), model, held_out=F.lit(True))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_nothing_or_one_language_to_learn(spark):
    data = spark.createDataFrame([(1, "some text", None, None, 1), (2, None, "en", None, 1),
                                  (3, "12", "fr", None, 1)], SCHEMA)
    model = language.train(data, usable=F.lit(True))
    assert model.languages == ()
    assert {r.lang_pred for r in language.predict_documents(data, model, F.lit(True)).collect()} == {"und"}
    one = language.train(data.withColumn("lang", F.lit("xx")), usable=F.col("doc_id") < 3)
    assert one.languages == ("xx",)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_documents(data, one, F.lit(False)).collect()}
    assert got == {1: ("xx", 1.0), 2: ("und", 0.0), 3: ("und", 0.0)}


def test_sample_is_bounded_balanced_and_repeatable(spark):
    rows = [(i, f"text {i} " * 100, "aa" if i % 10 else "bb", None, 1) for i in range(2000)]
    data = spark.createDataFrame(rows, SCHEMA)
    names, cut = language.training_segments(data, F.lit(True), 200, "text", "lang")
    assert names == ["aa", "bb"]
    again = language.training_segments(data.repartition(7), F.lit(True), 200, "text", "lang")[1]
    first = sorted(map(tuple, cut.collect()))
    assert first == sorted(map(tuple, again.collect()))
    assert all(len(s) <= language.TRAIN_SEGMENT for _, s in first)
    share = {k: sum(lang == k for lang, _ in first) / language.SEGMENTS_PER_DOC for k in names}
    assert share == {"aa": 100, "bb": 100}
    a, b = (language.train(d, F.lit(True), max_rows=60) for d in (data, data.repartition(5)))
    assert all((p == q).all() for p, q in zip(a.network.arrays(), b.network.arrays()))


def test_positions_of_a_text_in_two_languages(spark, model):
    data = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    half = {k: data.filter((F.col("lang") == k) & (F.length("text") > 2000)).orderBy("doc_id").first().text[:2000]
            for k in ("en", "de")}
    mixed = half["en"] + half["de"]
    r = language.label_positions(docs(spark, [mixed, None, "7"]), model).orderBy("doc_id").collect()
    assert r[0].n_bytes == len(mixed.encode()) and r[1].runs == r[2].runs == []
    runs, cut = r[0].runs, len(half["en"].encode())
    assert [x.start for x in runs] == [0, *(x.end for x in runs[:-1])] and runs[-1].end == r[0].n_bytes
    assert all(x.lang != y.lang for x, y in zip(runs, runs[1:]))
    def held(lang, low, high):
        return sum(max(0, min(x.end, high) - max(x.start, low)) for x in runs if x.lang == lang) / (high - low)
    assert held("en", 0, cut) > 0.7 and held("de", cut, r[0].n_bytes) > 0.7
