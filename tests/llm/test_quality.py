import re
from collections import defaultdict

import pytest

from cases import ODD, docs, small_docs, words
from courtline.llm import quality
from courtline.llm.queries import oracles, registry
from oracle_harness import compare, duck

LONG = " ".join(f"w{i % 97} the of" for i in range(6000))
REPEATED = ["the of " * 40, "a b c " * 30 + "the of and", ("x y z the of\n" * 30),
            " ".join(f"u{i} the" for i in range(60)), LONG, "# $ % the of " * 20, "THE OF AND " * 30]


def brute(text):
    text = text or ""
    w = words(text)
    spots = defaultdict(list)
    for i in range(len(w) - 2):
        spots[tuple(w[i:i + 3])].append(i)
    covered = {p for at in spots.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_counts_equal_brute_force(spark):
    texts = [*ODD, *REPEATED, *(t for _, t in small_docs(spark, 60))]
    got = {r.doc_id: r for r in quality.quality_report(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == brute(t), (i, t)
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("lookup", [0, 1000])
def test_both_ways_to_find_repeats_agree(spark, monkeypatch, lookup):
    monkeypatch.setattr(quality, "LOOKUP_SIZE", lookup)
    got = {r.doc_id: r.n_repeat_words for r in quality.quality_report(docs(spark, REPEATED)).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(REPEATED)}


def test_rules_reject(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} the" for i in range(60))
    bad = {"symbol_ratio": good.replace("word", "wor#"), "upper_case": good.upper(),
           "stop_words": good.replace(" the", "").replace("word", "wort wurt") ,
           "alphabetic_words": good.replace("the", "12")}
    rows = quality.quality_report(docs(spark, [good, *bad.values()])).orderBy("doc_id").collect()
    assert rows[0].kept
    for r, name in zip(rows[1:], bad):
        assert name in r.failed_rules and not r.kept


def test_keep_good_keeps_rows_whole_and_repeated(spark):
    good = " ".join(f"word{i} the" for i in range(60))
    df = docs(spark, [good, good, None, "short"], ids=[None, 5, 6, 7])
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.text) for r in kept.collect()) == [(False, good), (True, good)]
    assert quality.keep_good(df.union(df)).count() == 4


def test_empty_table(spark):
    assert quality.quality_report(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality.quality_report(docs(spark, ["a"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    r = compare(spark, duck(sf), "op9", registry()["op9_quality"], oracles()["op9_quality"], sf)
    assert r["status"] == "ok", r
