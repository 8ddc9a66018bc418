import hashlib
import re

import pytest

from cases import ODD, docs, small_docs
from courtline.llm import fim
from courtline.llm.queries import oracles, registry
from oracle_harness import compare, duck

SMALL = "/root/testdata/sf0.001"
TEXTS = [*ODD, "\n", "\n\n\n", "a\n", "no end", "a\nb\nc\nd", "é\nü\n漢字\n😀", "has <P> in it\nx", "<M>", "< P >\n<P",
         "<\n<S\n>\nP>\nM>", "line é\n" * 30000, "z" * 200_000, "\r\n\r\n", "a\x0bb c\n "]


def brute(text, doc_id, seed=7, fim_percent=100, spm_percent=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("clash", [False, True])
def test_outputs_equal_brute_force_and_restore(spark, clash):
    texts = TEXTS * 4 + [t for _, t in small_docs(spark, 80)]
    done = fim.transform_documents(docs(spark, texts, clash=clash))
    rows = fim.restore_documents(done).join(done.select("doc_id", "output"), "doc_id").collect()
    assert len(rows) == len(texts)
    seen = set()
    for r in rows:
        want = brute(texts[r.doc_id], r.doc_id)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want, r.doc_id
        assert r.output_sha256 == digest(want[-1]) and r.text == (texts[r.doc_id] or "")
        assert r.restored_sha256 == digest(texts[r.doc_id] or "")
        seen.add(r.form)
    assert seen == {"plain", "psm", "spm"}


def test_parameters_repeated_and_null_ids(spark):
    text = "one\ntwo\nthree\n"
    data = docs(spark, [text] * 40, ids=[None, None, 5, 5, *range(10, 46)])
    got = fim.transform_documents(data, seed=11, fim_percent=30, spm_percent=100).collect()
    want = sorted((str(r.doc_id), *brute(text, r.doc_id, 11, 30, 100)) for r in data.collect())
    assert sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert {r.form for r in got} == {"plain", "spm"}
    assert fim.transform_documents(docs(spark, [])).count() == 0


def test_restore_keeps_other_columns_and_small_batches(spark, monkeypatch):
    texts = [f"a{i}\nb{i}\nc" * 50 for i in range(50)]
    done = fim.transform_documents(docs(spark, texts)).withColumnRenamed("doc_id", "row")
    back = fim.restore_documents(done)
    assert back.columns == ["row", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "text",
                            "restored_sha256"]
    assert {r["row"]: r.text for r in back.collect()} == dict(enumerate(texts))


def test_pieces_cut_arrange_and_share_buffers():
    table = fim.PieceTable(b"abcdef")
    cut = table.cut((0, 2, 2, 6))
    assert [bytes(c) for c in cut.chunks()] == [b"", b"ab", b"", b"cdef", b""]
    assert cut.write() == b"abcdef" and cut.sha256() == hashlib.sha256(b"abcdef").hexdigest()
    moved = cut.arrange([(3, fim.SUFFIX), (1, b"")])
    assert moved.write() == b"<S>cdefab"
    assert moved.buffers[0].obj is table.buffers[0].obj
    assert [bytes(c) for c in moved.cut((3, 5)).chunks()] == [b"<S>", b"", b"cd", b"ef", b"ab"]


@pytest.mark.parametrize("output,form", [(b"text", "psm"), (b"x<P>a<S>b<M>c", "psm"), (b"<P>a<S>b<M>c", "spm"),
                                         (b"", "other")])
def test_wrong_outputs_fail(output, form):
    with pytest.raises(ValueError):
        fim.restore_text(output, form)


def test_query_equals_its_sql(spark):
    r = compare(spark, duck(SMALL), "op11_fim", registry()["op11_fim"], oracles()["op11_fim"], SMALL)
    assert r["status"] == "ok", r
