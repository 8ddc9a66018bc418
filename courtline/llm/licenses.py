"""License scans: ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z) and joined to a line of words, ``[^\\x00-\\x2F\\x3A-
\\x60\\x7B-\\x7F]+``.  Signatures are regular expressions over that line, in
order of priority.  A signature is tried only if its keyword occurs; one search
for all keywords decides that for the hundreds of signatures at once.

Detections of different signatures overlap ("apache license version 2 0" holds
"apache license").  A detection inside another's words is suppressed if the
other is longer or, at equal extent, earlier in the list.  Base phrases are
counted wherever they occur and their labels are never suppressed.

Defined results: a null text counts as empty; null ids and repeated rows stay;
an empty table gives no rows; columns other than the two named are ignored.
Texts are scanned whole.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import map_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Signature:
    """``pattern`` matches whole words of the normalised line; ``weight`` is how
    sure a match is, 0 to 1."""

    label: str
    keyword: str
    pattern: str
    weight: float = 0.9


def _versions(label, keyword, name, versions, weight=0.95):
    for v in versions:
        number = r" ".join(v.split("."))
        yield Signature(f"{label}-{v}", keyword,
                        rf"{name}(?: licen[cs]e)?(?: v| version| ver)? ?{number}", weight)


def _creative_commons():
    terms = {"by": "attribution", "by-sa": "attribution share ?alike",
             "by-nd": "attribution no ?deriv(?:ative)?s(?: works)?",
             "by-nc": "attribution non ?commercial",
             "by-nc-sa": "attribution non ?commercial share ?alike",
             "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?"}
    for (term, words), v in itertools.product(terms.items(), ("1.0", "2.0", "2.5", "3.0", "4.0")):
        number, short = v.replace(".", " "), term.replace("-", " ")
        label = f"cc-{term}-{v}"
        yield Signature(label, "cc", rf"cc {short} {number}", 0.95)
        yield Signature(label, "commons", rf"creative commons {words}(?: license)? {number}"
                                          r"(?: international| unported| generic)?", 1.0)
        yield Signature(label, "creativecommons",
                        rf"creativecommons org licenses {short} {number}", 1.0)
    for term, words in terms.items():
        short = term.replace("-", " ")
        yield Signature(f"cc-{term}", "cc", rf"cc {short}", 0.7)
        yield Signature(f"cc-{term}", "commons", rf"creative commons {words}", 0.8)


def _gnu():
    names = {"gpl": r"(?:gnu )?general public license", "lgpl": r"(?:gnu )?lesser general public license",
             "agpl": r"(?:gnu )?affero general public license",
             "fdl": r"(?:gnu )?free documentation license"}
    versions = {"gpl": ("1", "2", "3"), "lgpl": ("2", "2.1", "3"), "agpl": ("1", "3"),
                "fdl": ("1.1", "1.2", "1.3")}
    for label, name in names.items():
        for v in versions[label]:
            n = v.replace(".", " ")
            for tail, sort in ((r" (?:or|and) any later version", "-or-later"),
                               (r" or \(?at your option\)? any later version", "-or-later"),
                               ("", "")):
                yield Signature(f"{label}-{v}{sort}", "license",
                                rf"{name}(?: as published by the free software foundation)?"
                                rf"(?: either)?(?: v| version| ver)? ?{n}{tail}", 1.0)
            yield Signature(f"{label}-{v}", label, rf"(?:gnu )?{label} ?v? ?{n}(?: 0)?", 0.9)
            yield Signature(f"{label}-{v}-or-later", label,
                            rf"(?:gnu )?{label} ?v? ?{n}(?: 0)? or later", 0.95)
        yield Signature(label, "license", name, 0.9)
    yield Signature("lgpl", "library", r"(?:gnu )?library general public license", 0.9)


def _spdx():
    ids = ("apache 1 1", "apache 2 0", "mit", "mit 0", "isc", "zlib", "unlicense", "wtfpl",
           "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "0bsd", "bsl 1 0", "mpl 1 1", "mpl 2 0",
           "epl 1 0", "epl 2 0", "cddl 1 0", "cddl 1 1", "artistic 1 0", "artistic 2 0",
           "gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0 only", "gpl 3 0 or later",
           "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0 only", "lgpl 3 0 or later",
           "agpl 3 0 only", "agpl 3 0 or later", "cc0 1 0", "cc by 4 0", "cc by sa 4 0",
           "cc by nc 4 0", "ofl 1 1", "eupl 1 1", "eupl 1 2", "ms pl", "ms rl", "osl 3 0",
           "afl 3 0", "ncsa", "postgresql", "python 2 0", "ruby", "php 3 01", "openssl", "ecl 2 0",
           "odbl 1 0", "pddl 1 0", "blueoak 1 0 0", "cecill 2 1", "upl 1 0", "mulanpsl 2 0",
           "vim", "curl", "libpng", "ijg", "bsl 1 1", "sspl 1 0", "elastic 2 0")
    for name in ids:
        label = re.sub(r"(?<=\d) (?=\d)", ".", name).replace(" ", "-")
        yield Signature(label, "spdx", rf"spdx license identifier {name}", 1.0)


def _named():
    plain = (
        ("mit", "mit", r"mit license", 0.9),
        ("mit", "mit", r"(?:licensed|released|distributed) under (?:the )?(?:terms of the )?mit(?: license)?", 1.0),
        ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
        ("mit-0", "attribution", r"mit no attribution", 0.9),
        ("isc", "isc", r"isc license", 0.9),
        ("isc", "permission", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee", 0.9),
        ("bsd", "bsd", r"bsd (?:style )?licen[cs]e", 0.8),
        ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|two clause|2 clause) bsd(?: license)?", 0.95),
        ("bsd-2-clause", "bsd", r"bsd (?:2|two) clause(?: license)?", 0.95),
        ("bsd-3-clause", "bsd", r"(?:new|modified|revised|three clause|3 clause) bsd(?: license)?", 0.95),
        ("bsd-3-clause", "bsd", r"bsd (?:3|three) clause(?: license)?", 0.95),
        ("bsd-4-clause", "bsd", r"(?:original|old|four clause|4 clause) bsd(?: license)?", 0.95),
        ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 0.95),
        ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software", 0.9),
        ("apache", "apache", r"apache (?:software )?license", 0.9),
        ("apache-2.0", "apache", r"licensed under the apache license version 2 0", 1.0),
        ("apache-2.0", "apache", r"apache org licenses license 2 0", 1.0),
        ("mpl", "mozilla", r"mozilla public license", 0.9),
        ("mpl-2.0", "mozilla", r"source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
        ("epl", "eclipse", r"eclipse public license", 0.9),
        ("cddl", "common", r"common development and distribution license", 0.9),
        ("cpl", "common", r"common public license", 0.9),
        ("artistic", "artistic", r"artistic license", 0.9),
        ("artistic", "artistic", r"perl artistic license", 0.95),
        ("unlicense", "unlicense", r"(?:the )?unlicense", 0.8),
        ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 1.0),
        ("public-domain", "domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain", 0.9),
        ("public-domain", "domain", r"public domain dedication", 0.8),
        ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 0.9),
        ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0", 1.0),
        ("wtfpl", "wtfpl", r"wtfpl", 0.9),
        ("zlib", "zlib", r"zlib (?:libpng )?license", 0.9),
        ("zlib", "altered", r"altered source versions must be plainly marked as such", 0.9),
        ("libpng", "libpng", r"libpng license", 0.9),
        ("boost", "boost", r"boost software license(?: version 1 0)?", 1.0),
        ("ofl-1.1", "sil", r"sil open font license(?: version 1 1)?", 1.0),
        ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", 0.9),
        ("postgresql", "postgresql", r"postgresql licen[cs]e", 0.9),
        ("python", "python", r"python software foundation license(?: version 2)?", 0.95),
        ("ruby", "ruby", r"ruby license", 0.8),
        ("php", "php", r"php license(?: version 3 01)?", 0.9),
        ("openssl", "openssl", r"openssl license", 0.9),
        ("sspl-1.0", "server", r"server side public license(?: version 1)?", 1.0),
        ("busl-1.1", "business", r"business source license(?: 1 1)?", 0.95),
        ("elastic-2.0", "elastic", r"elastic license(?: 2 0)?", 0.9),
        ("eupl", "union", r"european union public licen[cs]e", 0.95),
        ("osl", "open", r"open software license", 0.9),
        ("afl", "academic", r"academic free license", 0.9),
        ("odbl", "database", r"open (?:data commons open )?database license", 0.9),
        ("upl-1.0", "universal", r"universal permissive license", 0.95),
        ("ms-pl", "microsoft", r"microsoft public license", 0.95),
        ("ms-rl", "microsoft", r"microsoft reciprocal license", 0.95),
        ("cecill", "cecill", r"cecill(?: free software license agreement)?", 0.8),
        ("creative-commons", "commons", r"creative commons(?: licen[cs]e)?", 0.6),
        ("proprietary", "rights", r"all rights reserved", 0.5),
        ("proprietary", "proprietary", r"proprietary and confidential", 0.8),
        ("proprietary", "permission", r"(?:reproduction|redistribution) without (?:prior )?(?:written )?permission is (?:strictly )?prohibited", 0.8),
        ("copyright-notice", "copyright", r"copyright (?:c )?(?:19|20)\d\d", 0.4),
        ("license-reference", "license", r"see (?:the )?license(?: file)?(?: for details| for more information)?", 0.4),
        ("license-reference", "licensed", r"licensed under", 0.3),
        ("license-reference", "terms", r"subject to the terms of (?:the|this) license", 0.4),
    )
    for row in plain:
        yield Signature(*row)


def signatures() -> list[Signature]:
    """All signatures, most specific first; their order is the priority."""
    named = list(_named())
    versions = itertools.chain(
        _versions("apache", "apache", "apache(?: software)?", ("1.0", "1.1", "2.0"), 1.0),
        _versions("mpl", "mozilla", "mozilla public", ("1.0", "1.1", "2.0")),
        _versions("epl", "eclipse", "eclipse public", ("1.0", "2.0")),
        _versions("cddl", "common", "common development and distribution", ("1.0", "1.1")),
        _versions("artistic", "artistic", "artistic", ("1.0", "2.0")),
        _versions("eupl", "union", "european union public", ("1.1", "1.2")),
        _versions("osl", "open", "open software", ("1.0", "2.0", "2.1", "3.0")),
        _versions("afl", "academic", "academic free", ("1.2", "2.0", "2.1", "3.0")))
    return [*_spdx(), *_gnu(), *versions, *_creative_commons(), *named]


class Scanner:
    """The compiled signature list of one worker."""

    def __init__(self, rules: list[Signature]):
        self.rules = [(r, re.compile(rf"(?<![^ ]){r.pattern}(?![^ ])")) for r in rules]
        self.by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            self.by_keyword.setdefault(r.keyword, []).append(i)
        #: License texts are rare; most documents end at this one search.
        self.prefilter = re.compile("|".join(sorted(map(re.escape, self.by_keyword),
                                                    key=len, reverse=True)))

    def detections(self, line: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) by characters of the line, after suppression."""
        if not self.prefilter.search(line):
            return []
        found = [(m.start(), m.end(), i)
                 for k in self.by_keyword if k in line for i in self.by_keyword[k]
                 for m in self.rules[i][1].finditer(line)]
        return suppress(found)


def suppress(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Drops detections inside another's extent; equal extents keep the earlier rule."""
    kept: list[tuple[int, int, int]] = []
    reach = -1
    for a, b, i in sorted(found, key=lambda d: (d[0], -d[1], d[2])):
        if b > reach:
            kept.append((a, b, i))
            reach = b
    return kept


def phrase_starts(words: list[str], phrase: list[str]) -> list[int]:
    n, first = len(phrase), phrase[0]
    out, at = [], -1
    while True:
        try:
            at = words.index(first, at + 1)
        except ValueError:
            return out
        if words[at:at + n] == phrase:
            out.append(at)


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double, "
           "detections array<struct<label:string,word:long,n_words:long,weight:double>>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
    ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()),
    ("detections", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()),
                                       ("n_words", pa.int64()), ("weight", pa.float64())])))])

_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def scan_text(text: str, scanner: Scanner) -> tuple:
    low = text.translate(_ASCII_LOWER)
    words = WORD.findall(low)
    seen = set(words)
    starts, base = [], set()
    for phrase, label in BASE:
        parts = phrase.split()
        if seen.issuperset(parts) and (at := phrase_starts(words, parts)):
            starts += at
            base.add(label)
    line = " ".join(words)
    hits = [{"label": (r := scanner.rules[i][0]).label, "word": line.count(" ", 0, a),
             "n_words": line.count(" ", a, b) + 1, "weight": r.weight}
            for a, b, i in scanner.detections(line)]
    score = max([0.0, *(1.0 for _ in base), *(h["weight"] for h in hits)])
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {h["label"] for h in hits})), score, hits)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  rules: list[Signature] | None = None) -> DataFrame:
    """One row per document: word count, base places and labels, all ``labels``,
    ``score`` (the surest detection, 0 without any) and the ``detections``."""
    rules = signatures() if rules is None else rules

    def scan(rows: Iterator[tuple]) -> Iterator[tuple]:
        scanner = Scanner(rules)
        for doc, t in rows:
            yield (doc, *scan_text(t or "", scanner))

    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return map_rows(ids, scan, _SCHEMA, _ARROW)
