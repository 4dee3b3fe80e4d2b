"""Fill-in-middle outputs against one text at a time, and their way back."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401

from refinery.llm import fim, queries


def expected(doc_id, text):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    if h[3] % 100 < 20:
        return n, "spm", one, two - one, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", one, two - one, f"<P>{prefix}<S>{suffix}<M>{middle}"


ROWS = [
    *ODD, (8, "a <P> in it", "en", "a"), (9, "<", "en", "a"), (10, "S>", "en", "a"), (11, "<S<P<M", "en", "a"),
    *[(100 + i, prose(i, i % 7) + "é日😀" * (i % 3), "en", "c") for i in range(200)],
]


def test_rows_of_odd_texts(spark):
    docs = documents(spark, ROWS).repartition(3)
    found = fim.transformed(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    wanted = sorted(map(repr, ((row[0], *expected(row[0], row[1]), row[1] or "") for row in ROWS)))
    assert sorted(repr(tuple(row)) for row in found) == wanted
    assert {row.form for row in found} == {"plain", "psm", "spm"}
    assert fim.transformed(docs.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("<>PSMaé日😀"), max_size=12), st.integers(0, 2), st.integers(0, 99), st.integers(0, 99)), max_size=8))
def test_there_and_back(rows):
    rows = [(t, 0 if not t or any(m in t for m in ("<P>", "<S>", "<M>")) else k, *sorted((a % (len(t) + 1), b % (len(t) + 1)))) for t, k, a, b in rows]
    texts = pa.array([row[0] for row in rows], pa.string())
    kinds, first, second = (np.array([row[i] for row in rows], np.int64) for i in (1, 2, 3))
    data, begin = fim._bytes(texts, 0, len(rows)) if rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    out, at = fim.scatter(data, begin, kinds, first, second)
    outputs = [bytes(out[a:b]).decode() for a, b in zip(at, at[1:])]  # noqa: B905
    forms = [lambda p, m, s: p + m + s, lambda p, m, s: f"<P>{p}<S>{s}<M>{m}", lambda p, m, s: f"<S>{s}<P>{p}<M>{m}"]
    assert outputs == [forms[k](t[:a], t[a:b], t[b:]) for t, k, a, b in rows]
    back, at = fim.gather(out, at, kinds)
    assert [bytes(back[a:b]).decode() for a, b in zip(at, at[1:])] == [row[0] for row in rows]  # noqa: B905


def test_a_missing_mark_is_an_error():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError, match="mark"):
        fim.gather(data, np.array([0, len(data)]), np.array([1]))


def test_batches_of_several_runs(monkeypatch):
    monkeypatch.setattr(fim, "_BYTES_AT_ONCE", 10)
    texts = pa.array(["", "abc", "x" * 30, "", "é" * 4, "z", ""])[1:]
    assert [texts.slice(a, b - a).to_pylist() for a, b in fim._runs(texts)] == [["abc"], ["x" * 30, ""], ["é" * 4, "z", ""]] or \
        sum((texts.slice(a, b - a).to_pylist() for a, b in fim._runs(texts)), []) == texts.to_pylist()


def test_the_query(spark, sf_dir, given_documents):
    found = {row.doc_id: row for row in queries.op12_fill_in_middle(spark, sf_dir).collect()}
    assert len(found) == given_documents.count()
    for row in given_documents.collect():
        n, form, prefix, middle, output = expected(row.doc_id, row.text)
        sums = [hashlib.sha256(text.encode()).hexdigest() for text in (output, row.text or "")]
        assert tuple(found[row.doc_id]) == (row.doc_id, n, form, prefix, middle, *sums)
