"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses, and a lexicon maps each word of a clause to a class:
insult, threat, target (whom it is about), negation, reporting verb, or other.
Four transducers read the classes from left to right and pass every insult and
threat on with a mark:

* ``target``   marks what follows a target within the clause,
* ``negation`` marks what follows a negation closely,
* ``reported`` marks what follows a reporting verb or stands in quotation marks,
* ``emit``     outputs a marked insult or threat as a pattern and drops the rest.

Their composition is one transducer, built once.  Its outputs are patterns such
as "targeted insult" or "negated, reported threat"; a match counts with the
weight of its lexicon entry.  A document's score is a logistic function of the
pattern sums.  An insult or threat without any mark is a pattern as well, and its
weight is learned like the others': where labels follow the words however their
clauses are built, as in the test tables, a word alone can decide.

Learning uses labelled rows outside the held-out third only, at most
``max_rows`` of them by hash of the id, exact copies once: word beginnings that mark toxic
documents (by log odds, G test against their number) join the hand-written
lexicon, then the pattern weights are fitted by ridge regression.  All texts are
scored whole.  Inputs of a score are the text and nothing else.

Defined results: a null or empty text gets the score of a text without matches;
null ids count as held in and keep their null; null labels are ignored, of
several labels for an id the highest holds; without usable labels the prior
weights stand; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import batches_of, in_python, map_rows, rows_of
from courtline.session import materialize

THRESHOLD = 0.7
MAX_ROWS = 20_000
MAX_STEMS = 2_000
MIN_TOXIC_DOCS = 4
MIN_TOXIC_SHARE = 0.02  # of toxic documents, so that the words of a few near copies are no lexicon
STEM_LENGTHS = range(3, 11)
MIN_LOG_ODDS = 3.0

# -- lexicon ----------------------------------------------------------------

INSULTS = ("idiot", "moron", "imbecil", "stupid", "dumb", "fool", "loser", "scum", "trash", "filth",
           "vermin", "worthless", "pathetic", "disgusting", "clown", "bastard", "coward", "jerk",
           "pervers", "dummkopf", "trottel", "abschaum", "crétin", "connard", "abruti", "salaud",
           "estúpid", "imbécil", "idiota", "basura", "gilipoll")
THREATS = ("kill", "murder", "destroy", "hurt", "beat", "punch", "stab", "strangle", "burn",
           "töte", "umbringen", "tuer", "frapper", "matar", "golpear")
TARGETS = frozenset("you your yours u he she they him her them these those people everyone "
                    "du dich dir ihr euch sie tu toi vous ils elles usted ustedes ellos ellas".split())
NEGATIONS = frozenset("not no never none nobody nothing neither nor isn't aren't wasn't don't doesn't "
                      "nicht kein keine nie niemals pas jamais aucun ni nunca jamás".split())
REPORTS = frozenset("said says say told called calls wrote claimed claims quoted quote reported "
                    "alleged allegedly sagte sagt schrieb nannte dit écrit appelé dijo llamó escribió"
                    .split())
PRIOR_WEIGHT = 3.0  # of a hand-written entry the labels say nothing about

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;\n]+|[\"“”«»]")
LETTERS = re.compile(r"[^\W\d_]+")

# -- transducers ------------------------------------------------------------

#: A symbol between transducers: its class and the marks it has got so far.
Symbol = tuple[int, frozenset[str]]


@dataclass(frozen=True)
class Transducer:
    """Deterministic and sequential: ``step(state, symbol) -> (state, symbol)``."""

    states: range
    step: object


def _marking(mark: str, after: int, span: int) -> Transducer:
    """Marks insults and threats within ``span`` words after class ``after``.
    States count the words that are left; a word of that class starts again."""

    def step(state: int, symbol: Symbol) -> tuple[int, Symbol]:
        kind, marks = symbol
        if kind == after:
            return span, symbol
        if kind in (INSULT, THREAT) and state:
            symbol = kind, marks | {mark}
        return max(0, state - 1) if kind != QUOTE else state, symbol

    return Transducer(range(span + 1), step)


def _quoting() -> Transducer:
    """State 1 lies between quotation marks."""

    def step(state: int, symbol: Symbol) -> tuple[int, Symbol]:
        kind, marks = symbol
        if kind == QUOTE:
            return 1 - state, symbol
        if state and kind in (INSULT, THREAT):
            symbol = kind, marks | {"reported"}
        return state, symbol

    return Transducer(range(2), step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Feeds the output of ``first`` to ``second``; states are pairs."""
    width = len(second.states)

    def step(state: int, symbol: Symbol) -> tuple[int, Symbol]:
        a, out = first.step(state // width, symbol)
        b, out = second.step(state % width, out)
        return a * width + b, out

    return Transducer(range(len(first.states) * width), step)


PATTERNS = [(kind, frozenset(marks)) for kind in (INSULT, THREAT)
            for n in range(4) for marks in itertools.combinations(("targeted", "negated", "reported"), n)]
NEGATED_SPAN, TARGET_SPAN, REPORT_SPAN = 3, 12, 12


def grammar() -> tuple[list[list[int]], list[list[int]]]:
    """The composition as tables: next state and output pattern (or -1) for each
    state and word class."""
    whole = _marking("targeted", TARGET, TARGET_SPAN)
    for t in (_marking("negated", NEGATION, NEGATED_SPAN),
              _marking("reported", REPORT, REPORT_SPAN), _quoting()):
        whole = compose(whole, t)
    index = {p: i for i, p in enumerate(PATTERNS)}
    after, out = [], []
    for state in whole.states:
        results = [whole.step(state, (c, frozenset())) for c in range(7)]
        after.append([s for s, _ in results])
        out.append([index.get(symbol, -1) for _, symbol in results])
    return after, out


# -- documents --------------------------------------------------------------

@dataclass(frozen=True)
class Lexicon:
    """Weighted word beginnings, and the first three letters they can have."""

    weights: dict[str, float]
    threats: frozenset[str]

    def find(self, word: str) -> tuple[str, float] | None:
        """The longest entry that ``word`` begins with."""
        for k in range(min(len(word), STEM_LENGTHS[-1]), STEM_LENGTHS[0] - 1, -1):
            if (w := self.weights.get(word[:k])) is not None:
                return word[:k], w
        return None


def features(text: str, lexicon: Lexicon, heads: frozenset[str], tables) -> list[float] | None:
    """Weight sums of the patterns matched in ``text``; None without a match."""
    low = text.lower()
    if not any(w[:3] in heads for w in LETTERS.findall(low)):
        return None
    after, out = tables
    sums = [0.0] * len(PATTERNS)
    state = 0
    for token in TOKEN.findall(low):
        if token[0] in ".!?;\n":
            state = 0  # the next clause
            continue
        weight = 0.0
        if token in "\"“”«»":
            kind = QUOTE
        elif token[:3] in heads and (entry := lexicon.find(token)):
            kind, weight = (THREAT if entry[0] in lexicon.threats else INSULT), entry[1]
        elif token in NEGATIONS:
            kind = NEGATION
        elif token in REPORTS:
            kind = REPORT
        elif token in TARGETS:
            kind = TARGET
        else:
            kind = OTHER
        pattern = out[state][kind]
        state = after[state][kind]
        if pattern >= 0:
            sums[pattern] += weight
    return [math.log1p(max(0.0, x)) for x in sums]


def extract(rows: DataFrame, lexicon: Lexicon, carried: str, arrow: pa.Schema, finish) -> DataFrame:
    """``finish(carried values, features)`` of each row; the last column is the text."""

    def run(stream: Iterator[tuple]) -> Iterator[tuple]:
        tables, heads = grammar(), frozenset(w[:3] for w in lexicon.weights)
        for *values, text in stream:
            yield finish(values, features(text or "", lexicon, heads, tables))

    return map_rows(rows, run, carried, arrow)


# -- learning ---------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...]
    bias: float

    def score(self, x: list[float] | None) -> float:
        z = self.bias + (sum(map(float.__mul__, x, self.weights)) if x else 0.0)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


_STEMS = pa.schema([("stem", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])


def stem_counts(sample: DataFrame, limit: int = 1 << 20) -> DataFrame:
    """(stem, toxic, clean): documents of either label with a word that begins so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            counts = (Counter(), Counter())
            for label, text in rows_of(batches):
                words = set(LETTERS.findall((text or "").lower()))
                counts[label].update({w[:k] for w in words for k in STEM_LENGTHS if len(w) >= k})
                if sum(map(len, counts)) > limit:
                    yield from ((s, counts[1][s], counts[0][s]) for s in {*counts[0], *counts[1]})
                    counts = (Counter(), Counter())
            yield from ((s, counts[1][s], counts[0][s]) for s in {*counts[0], *counts[1]})
        yield from batches_of(rows(), _STEMS, 1 << 14)

    counts = in_python(sample.select("toxic", "text"), run, "stem string, toxic long, clean long")
    return counts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _plogp(a: Column, expected: Column) -> Column:
    return F.when(a > 0, a * F.ln(a / expected)).otherwise(0.0)


def learn_lexicon(sample: DataFrame, toxic: int, clean: int, max_stems: int) -> Lexicon:
    """Hand-written entries plus the stems that mark toxic documents.

    Of stems that cover each other the one with the higher G stays, the longer
    one at equal G.
    """
    priors = {w: PRIOR_WEIGHT for w in (*INSULTS, *THREATS)}
    if not toxic or not clean:
        return Lexicon(priors, frozenset(THREATS))
    total = toxic + clean
    counted = materialize(stem_counts(sample).filter(
        F.col("toxic") >= max(MIN_TOXIC_DOCS, MIN_TOXIC_SHARE * toxic)), "stems")
    n = F.col("toxic") + F.col("clean")
    g = 2 * (_plogp(F.col("toxic"), n * toxic / total) + _plogp(F.col("clean"), n * clean / total)
             + _plogp(toxic - F.col("toxic"), (total - n) * toxic / total)
             + _plogp(clean - F.col("clean"), (total - n) * clean / total))
    odds = (F.ln((F.col("toxic") + 0.5) / (toxic + 1)) - F.ln((F.col("clean") + 0.5) / (clean + 1)))
    scored = counted.select("stem", g.alias("g"), odds.alias("odds")).filter(
        F.col("odds") >= MIN_LOG_ODDS)
    tested = max(1, scored.count())
    best = scored.filter(F.col("g") >= 2 * math.log(20 * tested)).orderBy(
        F.desc("g"), F.desc(F.length("stem")), "stem").limit(max_stems).collect()
    chosen: dict[str, float] = {}
    for r in best:
        if not any(r["stem"].startswith(c) or c.startswith(r["stem"]) for c in chosen):
            chosen[r["stem"]] = r["odds"]
    kept = {w: x for w, x in priors.items()
            if not any(w.startswith(c) or c.startswith(w) for c in chosen)}
    return Lexicon(kept | chosen, frozenset(THREATS))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, shrunk towards prior pattern weights:
    positive, less for negated and reported matches."""
    prior = np.array([2.0 / (1 + ("negated" in m) + ("reported" in m)) for _, m in PATTERNS] + [-3.0])
    a, w = np.c_[x, np.ones(len(x))], prior.copy()

    def loss(w):
        z = a @ w
        return np.logaddexp(0, z).sum() - y @ z + ridge / 2 * ((w - prior) ** 2).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        gradient = a.T @ (p - y) + ridge * (w - prior)
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step, size, now = np.linalg.solve(hessian, gradient), 1.0, loss(w)
        # a full step can overshoot where the classes are far apart
        while size > 1e-6 and loss(w - size * step) > now - 1e-4 * size * (gradient @ step):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


_FEATURES = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])


def train(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = MAX_ROWS,
          max_stems: int = MAX_STEMS) -> Model:
    """Lexicon and weights from at most ``max_rows`` labelled documents, those
    with the smallest hashes of their ids among the ``usable`` ones."""
    picked = (labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows rows of two numbers
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
                         .select("toxic", "text").distinct(), "labelled")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    lexicon = learn_lexicon(sample, sizes.get(1, 0), sizes.get(0, 0), max_stems)
    rows = extract(sample, lexicon, "toxic int, x array<double>", _FEATURES,
                   lambda v, x: (v[0], x or [0.0] * len(PATTERNS))).collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(PATTERNS))
    weights, bias = fit(x, np.array([r["toxic"] for r in rows], float))
    return Model(lexicon, tuple(map(float, weights)), bias)


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                     ("predicted", pa.int32())])


def score_documents(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id",
                    text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))

    def finish(values, x):
        s = model.score(x)
        return (*values, s, int(s >= threshold))

    return extract(rows, model.lexicon, "doc_id long, held_out boolean, score double, predicted int",
                   _SCORED, finish)
