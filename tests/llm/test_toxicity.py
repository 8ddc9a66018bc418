import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ODD, docs
from courtline.llm import toxicity
from courtline.llm.common import crc_mod

SMALL = "/root/testdata/sf0.01"


def features(text, lexicon=None):
    lexicon = lexicon or toxicity.Lexicon(dict.fromkeys((*toxicity.INSULTS, *toxicity.THREATS), 1.0),
                                          frozenset(toxicity.THREATS))
    x = toxicity.features(text, lexicon, frozenset(w[:3] for w in lexicon.weights), toxicity.grammar())
    return {(k, tuple(sorted(m))) for (k, m), v in zip(toxicity.PATTERNS, x or []) if v}


def test_grammar():
    insult, threat = toxicity.INSULT, toxicity.THREAT
    assert features("a quiet day") == set()
    assert features("an idiot") == {(insult, ())}
    assert features("you are an Idiot!") == {(insult, ("targeted",))}
    assert features("you are not an idiot") == {(insult, ("negated", "targeted"))}
    assert features("not here. idiot") == {(insult, ())}, "a clause ends a negation"
    assert features("not one two three idiot") == {(insult, ())}, "negations do not reach far"
    assert features("he said he will kill them") == {(threat, ("reported", "targeted"))}
    assert features('the sign "moron" hangs there') == {(insult, ("reported",))}
    assert features("the sign moron hangs there, idiots") == {(insult, ())}


def test_composition_equals_running_one_after_the_other():
    one, two = toxicity._marking("targeted", toxicity.TARGET, 2), toxicity._quoting()
    both = toxicity.compose(one, two)
    rng = np.random.default_rng(0)
    a = b = c = 0
    for kind in rng.integers(0, 7, 500):
        symbol = (int(kind), frozenset())
        a, mid = one.step(a, symbol)
        b, out = two.step(b, mid)
        c, joint = both.step(c, symbol)
        assert joint == out and c == a * 2 + b and c in both.states


def labelled(spark, labels=None):
    data = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = labels if labels is not None else spark.read.parquet(f"{SMALL}/labels.parquet")
    third = crc_mod(F.col("doc_id"), 3)
    model = toxicity.train(data, labels, usable=third != 1)
    return model, toxicity.score_documents(data, model, held_out=third == 1)


def test_held_out_accuracy_and_independence_of_held_out_labels(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model, scored = labelled(spark)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    hit = [r.predicted == r.toxic for r in rows]
    assert np.mean(hit) > 0.93
    assert sum(r.predicted for r in rows if not r.toxic) <= 1
    flipped = labels.withColumn("toxic", F.when(crc_mod(F.col("doc_id"), 3) == 1, 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    again, _ = labelled(spark, flipped)
    assert again == model


def test_scores_are_shares_and_odd_texts_are_scored(spark):
    lexicon = toxicity.Lexicon({"idiot": 3.0}, frozenset())
    model = toxicity.Model(lexicon, (1.0,) * len(toxicity.PATTERNS), -3.0)
    df = docs(spark, [*ODD, "you idiot " * 10_000])
    rows = {r.doc_id: r for r in toxicity.score_documents(df, model, crc_mod(F.col("doc_id"), 3) == 1).collect()}
    assert len(rows) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[len(ODD)].predicted == 1 and rows[0].score == rows[1].score < 0.1
    assert all(r.predicted == (r.score >= 0.7) for r in rows.values())


@pytest.mark.parametrize("n", [20, 20_000])
def test_the_fit_converges_on_separable_classes(n):
    rng = np.random.default_rng(4)
    y = (rng.random(n) < 0.1).astype(float)
    x = np.zeros((n, len(toxicity.PATTERNS)))
    x[:, 0] = y * rng.uniform(1, 4, n)
    x[:, 1] = y * (rng.random(n) < 0.1) * rng.uniform(1, 4, n)
    weights, bias = toxicity.fit(x, y)
    p = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert p[y == 1].min() > p[y == 0].max()
    if n > 20:  # with one or two toxic rows the prior still holds
        assert (p[y == 1] > 0.7).all() and (p[y == 0] < 0.3).all()


def test_without_labels_the_prior_stands(spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs(spark, ["you idiot", "fine"]), none, F.lit(True))
    assert model.score(toxicity.features("you idiot, you moron", model.lexicon, frozenset(
        w[:3] for w in model.lexicon.weights), toxicity.grammar())) > 0.5 > model.score(None)
    assert toxicity.score_documents(docs(spark, []), model, F.lit(False)).count() == 0


def test_the_sample_is_bounded(spark):
    data = docs(spark, [f"text {i}" for i in range(50)], clash=False)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    seen = []
    original = toxicity.fit
    toxicity.fit = lambda x, y: seen.append(len(x)) or original(x, y)
    try:
        toxicity.train(data, labels, F.lit(True), max_rows=10)
    finally:
        toxicity.fit = original
    assert seen == [10]
