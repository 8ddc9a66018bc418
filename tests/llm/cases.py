"""Small inputs shared by the tests: odd rows, and extra columns whose names
clash with those the operators use inside."""

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("t", "w", "h", "s", "p", "d", "row", "key", "rep", "block", "kind", "uid", "items", "rank",
            "length", "group", "shard", "bytes", "tokens", "n_words", "kept", "score", "toxic", "_bucket",
            "a", "b", "label", "digest", "payload", "word", "c")

ODD = [None, "", " \t\n", "word", "one two three four", "a b c d e", "x" * 5000,
       "ünïcödé wörds ñ 漢字 😀 end", "same line\nsame line\n\nsame line", "A a A a A a A a A a",
       "tab\tand\x0bvertical\x0cfeed\rreturn", "\x00 nul and \x1f unit", "..., !!! ???"]


def docs(spark, texts, ids=None, clash=True):
    rows = [(i, t, None, None, None if t is None else len(t))
            for i, t in zip(ids or range(len(texts)), texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if clash else df


def small_docs(spark, limit=None):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    return [(r.doc_id, r.text) for r in df.collect()][:limit]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
