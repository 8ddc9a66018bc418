"""Secret scans: credential patterns plus a token-efficiency test.

A tokenizer's vocabulary spells ordinary strings with few tokens.  Random
strings need many, so a run of key-like characters with fewer than
``MAX_CHARS_PER_TOKEN`` characters for each token is reported, unless it is a
digest of a usual length, an identifier, or a listed known value.  A run that is
readable as a whole may still hold a key behind or between readable parts: then its
stretches of parts that are no names are tested, and each part by itself.

Base kinds, each leftmost and non-overlapping: ``assign`` (key, separator and a
value of 6 or more characters), ``access`` (AKIA keys of 20 or more) and ``hex``
(24 or more).  The method adds kind ``random``.  Spans are code-point offsets
of the whole match, end exclusive.

Defined results: a null text counts as empty and has no spans; null ids and
repeated rows are kept as they are; an empty table gives no rows; columns other
than the two named are ignored.  One document is scanned whole, at any length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import in_python, load_encoding, map_rows

KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20

#: Runs that could hold keys, and the length from which a piece of one is tested.
MIN_KEY = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
MAX_CHARS_PER_TOKEN = 2.0

#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_HEX_RUN = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
#: A part of a snake, kebab, path or camel name, with at most a short number.
_PART = re.compile(r"[a-z]*(?:[A-Z][a-z]+)*[0-9]{0,4}|[A-Z]+[0-9]{0,4}")
_SEPARATORS = re.compile(r"[+/_=-]+")
_BETWEEN = re.compile(r"[^+/_-]+")
_NUMBERS = re.compile(r"[0-9+/_=-]+")


def is_known(run: str, known: frozenset[str] = frozenset()) -> bool:
    """Digests, UUIDs, identifiers, numbers and listed values are no secrets."""
    if run in known or _UUID.fullmatch(run) or _NUMBERS.fullmatch(run):
        return True
    if len(run) in DIGEST_LENGTHS and _HEX_RUN.fullmatch(run):
        return True
    return all(map(_PART.fullmatch, _SEPARATORS.split(run)))


load_vocabulary = load_encoding


def base_spans(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    found = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def pieces(run: str) -> Iterator[tuple[int, int]]:
    """Where a key may lie within a run: the stretches of neighbouring parts that are no
    names (``=`` at the end belongs to the last), then the single parts; longest first
    at each place, ``MIN_KEY`` characters at least."""
    parts = [m.span() for m in _BETWEEN.finditer(run)]
    stretches: list[list[int]] = []
    fresh = True
    for a, b in parts:
        if _PART.fullmatch(run[a:b].rstrip("=")):
            fresh = True
        elif fresh:
            stretches.append([a, b])
            fresh = False
        else:
            stretches[-1][1] = b
    for a, b in [*map(tuple, stretches), *parts]:
        if b - a >= MIN_KEY:
            yield a, b


def random_spans(text: str, vocabulary, max_ratio: float, known: frozenset[str]) -> list:
    def inefficient(piece: str) -> bool:
        return not is_known(piece, known) and len(piece) < max_ratio * len(vocabulary.encode_ordinary(piece))

    found = []
    for m in CANDIDATE.finditer(text):
        run, start = m.group(), m.start()
        if is_known(run, known):
            continue
        if inefficient(run):
            found.append((start, m.end(), "random"))
            continue
        held: list[tuple[int, int]] = []
        for a, b in pieces(run):
            if not any(c <= a and b <= d for c, d in held) and inefficient(run[a:b]):
                held.append((a, b))
        found += [(start + a, start + b, "random") for a, b in sorted(held)]
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in ordered)


def redact(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """``text`` with every maximal run of overlapping spans replaced by ``mask``."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:]


def scan_text(text: str, enc, max_ratio: float, known: frozenset[str]) -> tuple[list, list]:
    """The base spans and all spans of a text."""
    base = base_spans(text)
    return base, base + random_spans(text, enc, max_ratio, known)


_SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, n_random long, "
           "base_sha256 string, spans string")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                    ("n_hex", pa.int64()), ("n_random", pa.int64()), ("base_sha256", pa.string()),
                    ("spans", pa.string())])


def find_secrets(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id",
                 text: str = "text", max_chars_per_token: float = MAX_CHARS_PER_TOKEN,
                 known: Iterable[str] = ()) -> DataFrame:
    """One row per document: the count of each kind, ``base_sha256`` of the
    joined base spans, and all ``spans``.

    ``vocabulary`` is the path of a tiktoken rank file present on every worker,
    ``pattern`` its split pattern.  ``known`` lists values to leave alone.
    """
    known = frozenset(known)

    def scan(rows: Iterator[tuple]) -> Iterator[tuple]:
        enc = load_vocabulary(vocabulary, pattern)
        for doc, t in rows:
            base, spans = scan_text(t or "", enc, max_chars_per_token, known)
            kinds = [s[2] for s in spans]
            yield (doc, *map(kinds.count, KINDS),
                   hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return map_rows(ids, scan, _SCHEMA, _ARROW)


def redact_secrets(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text",
                   chars: str = "n_chars", max_chars_per_token: float = MAX_CHARS_PER_TOKEN,
                   known: Iterable[str] = (), mask: str = "[SECRET]") -> DataFrame:
    """Every row and column of ``docs``; spans in ``text`` are replaced by
    ``mask`` and ``chars`` (if there is such a column) follows the new length."""
    known = frozenset(known)
    at = docs.columns.index(text)
    length = docs.columns.index(chars) if chars in docs.columns else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_vocabulary(vocabulary, pattern)
        for b in batches:
            cols, texts = list(b.columns), b.column(at).to_pylist()
            changed = {}
            for i, t in enumerate(texts):
                if t and (spans := scan_text(t, enc, max_chars_per_token, known)[1]):
                    changed[i] = texts[i] = redact(t, spans, mask)
            if changed:
                cols[at] = pa.array(texts, b.schema.field(at).type)
                if length is not None:
                    n = cols[length].to_pylist()
                    for i, t in changed.items():
                        n[i] = len(t)
                    cols[length] = pa.array(n, b.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return in_python(docs, clean, docs.schema)
