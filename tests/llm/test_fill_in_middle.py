"""Fill-in-middle against plain slicing, and back to the exact text."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorstream.llm import fill_in_middle as fim
from sensorstream.llm import queries

from ..conftest import SF_SMALL
from .rows import awkward

MARKS = tuple(s.encode() for s in fim.SENTINELS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, rate=90, spm=20):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


ODD = ["a<P>b", "<M>", "<S", "<", "<<P", "P><P", "M>x<M", "é<é", "\x00a\x00", "  \U0001F600ab", "aB" * 50]


def test_forms_and_restored_text(spark, odder_docs):
    rows = [(r[0], r[1]) for r in awkward(unique=False)] + [(900 + i, t) for i, t in enumerate(ODD * 8)]
    docs = odder_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(900 + i, t) for i, t in enumerate(ODD * 8)], "doc_id long, text string"))
    made = fim.fill_in_middle(docs)
    want = sorted(((d, *plain(d, t), t or "") for d, t in rows), key=repr)
    got = fim.restore(made.withColumn("out", made["output"]))
    assert rows_of(got, "doc_id", "n", "form", "prefix_chars", "middle_chars", "out", "restored") == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("rate, spm", [(0, 50), (100, 0), (100, 100)])
def test_rates(spark, rate, spm):
    rows = [(i, "one two <three> four. " * (i % 5)) for i in range(60)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), rate=rate, spm_rate=spm)
    assert rows_of(got, "doc_id", *fim.RESULTS) == sorted(((i, *plain(i, t, rate, spm)) for i, t in rows), key=repr)


def test_columns_are_carried_and_replaced(odd_docs, no_docs):
    made = fim.fill_in_middle(odd_docs)
    assert made.columns == [c for c in odd_docs.columns if c != "n"] + list(fim.RESULTS)
    back = fim.restore(made)
    assert back.columns == [c for c in made.columns if c != "output"] + ["restored"]
    assert rows_of(back, "doc_id", "text", "u", "_text", "kept") == rows_of(odd_docs, "doc_id", "text", "u", "_text", "kept")
    assert fim.restore(fim.fill_in_middle(no_docs)).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(((d, n, f, p, m, sha(o), sha(t or "")) for d, t, n, f, p, m, o in ((d, t, *plain(d, t)) for d, t in docs)), key=repr)
    assert rows_of(queries.op13_fill_in_middle(spark, SF_SMALL), "doc_id", "n", "form", "prefix_chars", "middle_chars",
                   "output_sha256", "restored_sha256") == want


def test_marks_that_texts_could_complete_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("<<P>", "<S>", "<M>"), ("aa", "b", "c"), ("ab", "bc", "x"), ("", "b", "c")):
        with pytest.raises(ValueError, match="sentinels"):
            fim._marks(marks)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ <>PSM.é\U0001F600\n", max_size=60), st.integers(0, 99), st.integers(0, 99),
       st.sampled_from(["psm", "spm"]), st.integers(1, 9))
def test_rotation_in_chunks(text, x, y, form, chunk):
    if any(s in text for s in fim.SENTINELS):
        return
    old, fim.CHUNK = fim.CHUNK, chunk
    try:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        units, want = fim.Units(raw), re.findall("[A-Za-z]+|[^A-Za-z]", text)
        assert units.n == len(want)
        a, b = sorted((x % (units.n + 1), y % (units.n + 1)))
        p, m, s = ("".join(w) for w in (want[:a], want[a:b], want[b:]))
        lo, hi = units.start(a), units.start(b)
        assert (text.encode()[:lo].decode(), text.encode()[lo:hi].decode()) == (p, m)
        assert (fim.characters(raw[:lo]), fim.characters(raw[lo:hi])) == (len(p), len(m))
        buffer = bytearray(text.encode())
        fim.arrange(buffer, lo, hi, form, MARKS)
        assert buffer.decode() == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
        fim.undo(buffer, form, MARKS)
        assert buffer.decode() == text
    finally:
        fim.CHUNK = old


def test_long_text(spark):
    text = ("word, é " * 1_000_000) + "end"
    ids = [i for i in range(40) if plain(i, "x y")[1] != "plain"][:2]
    docs = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    for r in fim.restore(fim.fill_in_middle(docs, carry=False)).collect():
        want = plain(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.restored == text) == (*want[:4], True)
