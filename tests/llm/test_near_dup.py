import random
from collections import defaultdict

import numpy as np
import pytest

from cases import ODD, docs, lower, small_docs
from courtline.llm import near_dup
from courtline.llm.common import WordHashes, lower_words


def shingle_set(text):
    w = lower(text).encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts, percent=85):
    """(set size, component) of each text by comparing all pairs."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                one, two = find(i), find(j)
                root[max(one, two)] = min(one, two)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(rng, base, n):
    w = list(base)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def near_texts(seed, groups=6, size=12, words=120):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(10 ** 5)}" for _ in range(words)]
        out += [edited(rng, base, rng.randrange(5)) for _ in range(size)]
        out += [" ".join(base)] * 3
    rng.shuffle(out)
    return out


def check(spark, texts, percent=85):
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs(spark, texts), percent=percent).collect()}
    assert len(got) == len(texts)
    for i, (n, component) in enumerate(brute(texts, percent)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, component, component == i), i


def test_components_equal_brute_force(spark):
    check(spark, [*ODD, *near_texts(1), "A b c d e f", "a B c d e f", *(t for _, t in small_docs(spark, 100))])


def test_chains_and_members_that_link_past_the_pivot(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 4)
    rng = random.Random(3)
    base, texts = [f"w{i}" for i in range(150)], []
    for i in range(40):  # each text is one edit from the one before, far from the first
        texts.append(" ".join(base))
        base[rng.randrange(150)] = f"n{i}"
    check(spark, texts)
    check(spark, near_texts(4, groups=2, size=25, words=80), percent=80)


def test_tiles_cover_all_pairs_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 3)
    monkeypatch.setattr(near_dup, "most_differing_bits", lambda percent: 10 ** 6)
    rows = [(1, i, 0, i, 100, bytes(320)) for i in range(20)]
    members = spark.createDataFrame(rows, "key long, rep long, pivot long, label long, n_shingles long, sketch binary")
    pairs = {(r.a, r.b) for r in near_dup.across_components(members, 85).collect()}
    assert pairs == {(i, j) for i in range(1, 20) for j in range(i + 1, 20)}


@pytest.mark.parametrize("same", [0.85, 0.95, 1.0])
def test_odd_sketches_keep_similar_sets(same):
    rng = np.random.default_rng(5)
    signer, bits = near_dup.Signer(), []
    for _ in range(200):
        n = 400
        shared = rng.integers(0, 2 ** 63, round(n * same), dtype=np.uint64)
        own = n - len(shared)  # split between the two, so |union| = n
        a, b = np.split(rng.integers(0, 2 ** 63, own, dtype=np.uint64), [own // 2])
        one, two = (np.frombuffer(signer.sketch(signer.minima(np.r_[shared, x])), np.uint8) for x in (a, b))
        bits.append(int(np.bitwise_count(one ^ two).sum()))
    assert max(bits) < near_dup.most_differing_bits(85)
    estimate = -near_dup.SKETCH_BITS / 4 * np.log(1 - 2 * np.array(bits) / near_dup.SKETCH_BITS)
    assert abs(1 - estimate.mean() / near_dup.HASHES - same) < 0.02


def test_parities_never_drop_a_link():
    rng = np.random.default_rng(6)
    for n in (3, 150, 5000):
        shared = rng.integers(0, 2 ** 63, n * 85, dtype=np.uint64)
        a, b = np.split(rng.integers(0, 2 ** 63, n * 15, dtype=np.uint64), [n * 7])
        one, two = np.r_[shared, a], np.r_[shared, b]  # Jaccard similarity 0.85
        words = [np.frombuffer(bytes(64) + near_dup.parities(x), np.uint64)[None] for x in (one, two)]
        sizes = np.array([len(one) + len(two)])
        assert near_dup.may_link(*words, sizes, 85).all()
        if n == 3:
            assert not near_dup.may_link(*words, sizes, 90).any()


def test_shingles():
    h = WordHashes(size=4)
    assert len(near_dup.shingles(lower_words("a b c d e f g"), h)) == 3
    assert len(near_dup.shingles(lower_words("a b a b a b a b a b"), h)) == 2
    assert list(near_dup.shingles(lower_words("A  B"), h)) == list(near_dup.shingles(lower_words("a\tb"), h))


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = near_dup.near_duplicates(docs(spark, [text] * 4 + [None], ids=[None, 7, 7, 9, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [
        (-1, -1, True), (-1, -1, True), (7, 7, True), (7, 7, True), (9, 7, False)]
    left = near_dup.keep_one(docs(spark, [text] * 3, ids=[None, 4, 2]))
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 2]


def test_empty_table(spark):
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = defaultdict(set)
    for r in near_dup.components(links).collect():
        got[r.label].add(r.node)
    assert got == {0: set(range(61)), 100: {100, 200, 300}}
