"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds one ratio of a text (length, symbol, alphabetic-word,
stop-word, line and upper-case ratios).  ``compile_rules`` turns the table into
plain column expressions, so scoring is one narrow projection: no shuffle, no
user function, memory of one row.

Defined results: a null text counts as empty (no words, so it fails the base
length rule); a null id is kept as null; repeated rows give repeated results;
an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import SPACES, word_array

SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the a an and or of to in is it that this with for on as at by be are was from not have has "
    "der die das und oder in zu den von mit ist ein eine nicht auch auf für sich des im dem es "
    "le la les un une et de du des en que qui est dans pour par sur au avec pas il elle se ce "
    "el los las y o del al una unos con por para como no su lo más pero es se son").split()

_STOP_FORMS = sorted({form for x in STOP_WORDS for form in (x, x.capitalize(), x.upper())})


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie within [low, high]; None leaves a side open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Base rules, judged first: too few words, or mostly repeated three-word windows.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.5, 12.0),
    Rule("symbol_ratio", "n_symbols / n_words", None, 0.1),
    Rule("alphabetic_words", "n_alpha_words / n_words", 0.7, None),
    Rule("stop_words", "n_stop_words / n_words", 0.005, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("upper_case", "n_upper / word_chars", None, 0.4),
)


def compile_rules(rules=RULES) -> Column:
    """The names of the rules a row breaks, as an array expression.  A ratio
    with a zero denominator breaks no rule (the base rules reject such rows)."""
    broken = []
    for r in rules:
        top, bottom = (x.strip() for x in r.metric.split("/"))
        ratio = F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))
        outside = F.lit(False)
        if r.low is not None:
            outside = outside | (ratio < r.low)
        if r.high is not None:
            outside = outside | (ratio > r.high)
        broken.append(F.when(outside, F.lit(r.name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def _count_without(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


#: Up to so many repeated hashes a start is looked up in their list; beyond it all
#: windows of the text are sorted.  Both ways give the same result.
LOOKUP_SIZE = 64


def _equal_at(items: Column, i: Column, field: str, value: Column) -> Column:
    return F.coalesce(F.get(items, i)[field] == value, F.lit(False))


def with_repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by three-word windows that occur
    twice or more in the row's word array ``w`` of ``n_words`` words.

    Window hashes tell which starts can repeat; only those windows are spelled
    out and sorted with their starts, so equal windows become neighbours and a
    hash collision adds nothing.  Each start adds min(3, distance to the one
    before it) words.
    """
    w, h, s, p = (F.col(c) for c in "whsp")
    starts = F.sequence(F.lit(0), F.col("n_words") - 3)
    df = df.withColumn("h", F.when(F.col("n_words") > 3, F.transform(
        starts, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))))
    df = df.withColumn("s", F.sort_array(h))
    df = df.withColumn("d", F.array_distinct(F.filter(
        s, lambda x, i: F.coalesce(F.get(s, i - 1) == x, F.lit(False)))))
    some = F.filter(starts, lambda i: (F.size("d") > LOOKUP_SIZE) | F.array_contains("d", h[i]))
    df = df.withColumn("s", F.when(F.size("d") > 0, F.sort_array(F.transform(
        some, lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("w"),
                                 i.alias("p"))))))
    df = df.withColumn("p", F.sort_array(F.transform(
        F.filter(s, lambda x, i: _equal_at(s, i - 1, "w", x["w"])
                 | _equal_at(s, i + 1, "w", x["w"])),
        lambda x: x["p"])))
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), x - F.coalesce(F.get(p, i - 1), x - 3))),
        F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   rules=RULES) -> DataFrame:
    """One row per document: doc_id, the counts, ``base_failed``,
    ``failed_rules`` (names) and ``kept``."""
    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    return _report(df, ["doc_id"], rules)


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs``, all columns as they were, that break no rule."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    kept = _report(docs.select(row, F.col(text).alias("t")), ["row"], rules).filter("kept")
    return kept.select("row.*")


def _report(df: DataFrame, carried: list[str], rules) -> DataFrame:
    t, w, lines = F.col("t"), F.col("w"), F.col("lines")
    blank = lambda x: F.translate(x, SPACES, "")
    df = df.withColumn("t", F.coalesce(t, F.lit("")))
    df = df.select(*carried, "t", word_array(t).alias("w"),
                   F.filter(F.split(t, "\n"), lambda x: blank(x) != "").alias("lines"))
    df = df.select(
        *carried, "w",
        F.size(w).alias("n_words"),
        F.length(blank(t)).cast("long").alias("word_chars"),
        _count_without(t, SYMBOLS).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_alpha_words"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.size(F.filter(w, lambda x: x.isin(_STOP_FORMS))).cast("long").alias("n_stop_words"))
    df = with_repeated_words(df)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
              "n_alpha_words", "n_stop_words", "n_upper"]
    # a generator of one row: a filter on the verdict stays above it, instead of
    # being pushed down with a copy of every expression
    df = df.select(*carried, F.inline(F.array(F.struct(
        *(F.col(c).cast("long").alias(c) for c in counts)))))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (F.col("n_repeat_words") * 100
                          > F.col("n_words") * MAX_REPEATED_PERCENT))
    df = df.withColumn("failed_rules", compile_rules(rules))
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
