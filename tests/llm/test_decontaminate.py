import random

import numpy as np
import pytest

from cases import ODD, docs, small_docs
from courtline.llm import decontaminate as dc
from courtline.llm.common import WordHashes, bitmap, in_bitmap, only_listed

RNG = random.Random(8)
VOCABULARY = [f"w{i}" for i in range(3000)]


def sentence(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def items(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts)), "item_id long, text string")


def edit(words, n):
    words = list(words)
    for _ in range(n):
        i = RNG.randrange(len(words))
        kind = RNG.randrange(3)
        if kind == 0:
            words[i] = "edited"
        elif kind == 1:
            words.insert(i, "added")
        else:
            del words[i]
    return words


def found(spark, texts, benchmark, **options):
    rows = dc.find_leaks(docs(spark, texts), items(spark, benchmark), **options).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_exact_leaks_of_the_small_tables(spark):
    texts = [t for _, t in small_docs(spark)]
    benchmark = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    spell = lambda t: b" " + b" ".join(dc.words_of(t)) + b" "
    want = {(i, j) for i, t in enumerate(texts) for j, b in enumerate(benchmark) if spell(b) in spell(t)}
    got = found(spark, [*texts, *ODD], [*benchmark, None, "", "?!"])
    assert want and want <= set(got)
    assert all(r.edits <= dc.MAX_EDIT_SHARE * r.n_words for r in got.values())


def test_recall_on_edited_copies(spark):
    benchmark = [sentence(RNG.randrange(15, 60)) for _ in range(120)]
    texts, want = [], set()
    for i in range(360):
        b = i % 120
        copy = edit(benchmark[b], int(0.1 * len(benchmark[b])))
        texts.append(" ".join([*sentence(RNG.randrange(200)), *copy, *sentence(RNG.randrange(200))]).upper())
        want.add((i, b))
    got = set(found(spark, texts, [" ".join(b) for b in benchmark]))
    assert len(want & got) >= 0.9 * len(want)
    assert got <= want


def test_short_items_and_places(spark):
    benchmark = ["unique", "two words", "a b c d e f g"]
    got = found(spark, ["x unique y", "Two, words", "0 1 a b c d e f g 2", "a b c", "two or words"], benchmark)
    assert set(got) == {(0, 0), (1, 1), (2, 2)}
    assert (got[2, 2].begin, got[2, 2].end, got[2, 2].edits) == (2, 9, 0)


def naive(item, region):
    best = None
    for b in range(len(region) + 1):
        for e in range(b, len(region) + 1):
            part = region[b:e]
            d = np.arange(len(part) + 1)
            for i, x in enumerate(item, 1):
                new = [i]
                for j, y in enumerate(part, 1):
                    new.append(min(new[-1] + 1, d[j] + 1, d[j - 1] + (x != y)))
                d = new
            best = d[-1] if best is None else min(best, d[-1])
    return best


def test_alignment_is_the_edit_distance():
    rng = np.random.default_rng(3)
    for _ in range(40):
        item, region = rng.integers(0, 4, rng.integers(1, 7)), rng.integers(0, 4, rng.integers(1, 9))
        cost, b, e = dc.align(item, region)
        assert cost == naive(item.tolist(), region.tolist())
        assert naive(item.tolist(), region[b:e].tolist()) == cost and 0 <= b <= e <= len(region)


def test_minimizers_follow_the_content():
    h = WordHashes()
    item = h.of(sentence(40))
    around = np.r_[h.of(sentence(30)), item, h.of(sentence(30))]
    assert set(dc.minimizers(item) + 30) <= set(dc.minimizers(around))
    assert np.diff(dc.minimizers(around)).max() <= dc.MINIMIZER
    assert not len(dc.minimizers(item[:3]))


def test_repetitions_reach_the_target():
    n = dc.repetitions(0.95, 0.7, 4)
    assert 1 - (1 - 0.7 ** 4) ** n >= 0.95 > 1 - (1 - 0.7 ** 4) ** (n - 1)
    assert dc.WALKS * dc.TABLES >= dc.repetitions()


@pytest.mark.parametrize("share", [0.0, 0.15])
def test_edits_above_the_threshold_are_no_leak(spark, share):
    b = sentence(40)
    near, far = edit(b, 1), b[:20] + sentence(20)
    got = found(spark, [" ".join(b), " ".join(near), " ".join(far)], [" ".join(b)], max_edit_share=share)
    assert set(got) == ({(0, 0)} if not share else {(0, 0), (1, 0)})


def test_empty_null_and_repeated(spark):
    b = " ".join(sentence(30))
    assert found(spark, [], [b]) == {} == found(spark, ["text"], [])
    df = docs(spark, [b, b, "clean " + b[:20], None], ids=[None, 3, 4, None])
    rows = dc.find_leaks(df.union(df), items(spark, [b])).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in rows) == [(-1, 0), (3, 0)]
    left = dc.drop_leaks(df, items(spark, [b])).collect()
    assert sorted(r.doc_id or -1 for r in left) == [-1, 4]
    assert dc.drop_leaks(df, items(spark, [])).count() == 4


def test_only_listed_loses_no_row(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "if(id % 2 = 0, null, 'x') as text")
    kept = {r.doc_id for r in only_listed(df, "doc_id", spark.range(0, 20_000, 40)).collect()}
    assert set(range(0, 20_000, 40)) <= kept and len(kept) < 600
    assert only_listed(df, "doc_id", spark.range(0)).count() == 0


def test_bitmap(spark):
    keys = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 500)
    table = bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"), 500)
    assert len(in_bitmap(keys.view(np.uint64), table)) == 500
    others = np.random.default_rng(2).integers(0, 2 ** 63, 20_000).view(np.uint64)
    assert len(in_bitmap(others, table)) < 20


def with_edits(words, n):
    """``n`` random edits, added words all different."""
    words = list(words)
    for k in range(n):
        i = RNG.randrange(len(words))
        match RNG.randrange(3):
            case 0:
                words[i] = f"edited{k}"
            case 1:
                words.insert(i, f"added{k}")
            case _:
                del words[i]
    return words


def test_recall_by_length_at_the_threshold(spark):
    """Every copy lies within the threshold, so brute force finds all."""
    lengths = [length for length in (7, 8, 9, 10, 12, 13, 16, 20, 27, 40, 64, 300) for _ in range(60)]
    benchmark = [sentence(length) for length in lengths]
    texts = [" ".join([*sentence(30), *with_edits(b, int(dc.MAX_EDIT_SHARE * len(b))), *sentence(30)])
             for b in benchmark]
    got = set(found(spark, texts, [" ".join(b) for b in benchmark]))
    for length in set(lengths):
        same = [i for i, n in enumerate(lengths) if n == length]
        assert len(got & {(i, i) for i in same}) >= dc.TARGET_RECALL * len(same), length


def test_edits_gathered_at_one_end(spark):
    benchmark = [sentence(1000) for _ in range(3)]
    cut, rewritten, gathered = benchmark
    places = set(RNG.sample(range(256), 150))
    texts = [[*sentence(50), *cut[150:], *sentence(50)], [*sentence(150), *rewritten[150:]],
             [f"edited{i}" if i in places else w for i, w in enumerate(gathered)]]
    got = set(found(spark, [" ".join(t) for t in texts], [" ".join(b) for b in benchmark]))
    assert got == {(i, i) for i in range(3)}


def test_words_part_at_unicode_punctuation_and_spaces():
    assert dc.words_of("of\u00a0these\u00a0animals\u2014cat") == [b"of", b"these", b"animals", b"cat"]
    assert dc.words_of("\u201cSí\u201d\u2026 l\u2019été\u3000中文。é") == [
        w.encode() for w in ("sí", "l", "été", "中文", "é")]
    assert dc.words_of("l'e\u0301te\u0301 a_b") == [b"l", "e\u0301te\u0301".encode(), b"a", b"b"]
