import re

from cases import ODD, docs, lower, small_docs
from courtline.llm import licenses

TEXTS = [*ODD, "Released under the MIT License.", "mit-license, MIT  licensed; the MIT\nLicense mit license",
         "Licensed under the Apache License, Version 2.0.", "ümit license mit licenseé",
         "GNU General Public License version 3 or any later version",
         "general public license general public license", "Licensed under CC BY-NC 4.0.",
         "SPDX-License-Identifier: BSD-3-Clause", "cc-by-nc-sa 4.0"]


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hits = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"),
                                             ("general public license", "gpl"))
            for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_base_equals_brute_force(spark):
    texts = [*TEXTS, *(t for _, t in small_docs(spark))]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def labels(text):
    return licenses.scan_text(text, licenses.Scanner(licenses.signatures()))[5]


def test_signatures():
    assert len(licenses.signatures()) >= 200
    assert "cc-by-nc-4.0" in labels("Licensed under CC BY-NC 4.0.")
    assert "bsd-3-clause" in labels("SPDX-License-Identifier: BSD-3-Clause")
    assert "gpl-3-or-later" in labels("GNU General Public License version 3 or any later version")
    assert labels("the mitten licensed nothing") == ""


def test_keywords_occur_in_what_their_patterns_match():
    """Prefilter: a signature's keyword is a word of each of its matches."""
    for r in licenses.signatures():
        assert re.search(rf"(?<![a-z0-9]){re.escape(r.keyword)}(?![a-z0-9])", re.sub(r"\(\?:|[()?]", " ", r.pattern)), r


def test_joined_spellings():
    for text, label in (("released as GPLv3", "gpl-3"), ("GPL3", "gpl-3"), ("GPLv2+ only", "gpl-2"),
                        ("under LGPLv2.1 or later", "lgpl-2.1-or-later"), ("AGPLv3.", "agpl-3"),
                        ("AGPLv3 or later", "agpl-3-or-later")):
        assert labels(text) == label, text


def test_priority_and_containment():
    assert licenses.suppress([(0, 10, 3), (2, 8, 0), (0, 10, 1), (8, 14, 2)]) == [(0, 10, 1), (8, 14, 2)]
    assert "cc-by-nc" not in labels("cc by nc sa 4 0").split(",")


def test_empty_table(spark):
    assert licenses.scan_licenses(docs(spark, [])).count() == 0
