"""Operators on Arrow batches: decontamination, near-duplicates, token files, CRF."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sensorstream.llm import crf_quality, decontaminate, near_dup, queries, token_files
from sensorstream.llm._text import SPACED, scan
from sensorstream.llm.components import connected_components

from . import brute
from ..conftest import SF_MID, SF_SMALL
from .rows import awkward, prose


def table(spark, name, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_scan_words_and_hashes():
    texts = [t for *_, t in ((r[1],) for r in awkward())] + ["", "same same", "same"]
    got, hashes = [], {}
    for w in scan(pa.array(texts), lower=False, word_bytes=SPACED):
        for i in range(w.texts):
            own = [w.text_bytes(k) for k in range(w.first[i], w.first[i + 1])]
            got.append([x.decode() for x in own])
            for x, h in zip(own, w.hash[w.first[i]:w.first[i + 1]], strict=True):
                assert hashes.setdefault(x, h) == h
    assert got == [brute.words(t) for t in texts]
    assert len(set(map(int, hashes.values()))) == len(hashes)


def test_runs_depend_on_words_only():
    w, = scan(pa.array(["q r a b c d z", "a b c d"]), lower=True)
    runs = w.runs(4)
    assert runs[2] == runs[w.first[1]] and len(set(map(int, runs[:4]))) == 4


def check_contamination(got, docs, items):
    want = brute.contamination([t for _, t in docs], items)
    by_id = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), brute.sha(",".join(r["items"])), r.contaminated) for r in got}
    assert by_id == {d: w for (d, _), w in zip(docs, want, strict=True)}


@pytest.mark.parametrize("block", [100_000, 120])
def test_contamination(spark, odd_docs, block):
    docs, marks = table(spark, "documents"), table(spark, "benchmark")
    got = decontaminate.contamination(docs, marks, block_windows=block).collect()
    check_contamination(got, [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in marks.collect()])
    items = [(1, prose(1, 14)), (2, "one two"), (3, "X"), (4, None), (5, ""), (6, prose(1, 14).upper()), (None, "a b c"), (10, "w1 tail")]
    own = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(odd_docs, own, block_windows=block).collect()
    check_contamination(got, [(r[0], r[1]) for r in awkward()], items)


def test_contamination_odd_tables(spark, odder_docs, no_docs):
    marks = table(spark, "benchmark")
    assert decontaminate.contamination(odder_docs, marks).count() == odder_docs.count()
    assert decontaminate.contamination(odder_docs, marks, block_windows=120).count() == odder_docs.count()
    assert decontaminate.contamination(no_docs, marks).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odder_docs, marks.limit(0)).collect())


def test_contamination_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_decontaminate(spark, SF_SMALL).collect()}
    docs, marks = table(spark, "documents").collect(), table(spark, "benchmark").collect()
    want = brute.contamination([r.text for r in docs], [(r.item_id, r.text) for r in marks])
    assert got == {r.doc_id: w for r, w in zip(docs, want, strict=True)}
    assert any(w[-1] for w in want)


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = connected_components(spark.createDataFrame(links, "u long, v long"))
    assert {x.node: x.component for x in got.collect()} == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates(spark, odd_docs):
    docs = table(spark, "documents", SF_MID)
    got = near_dup.near_duplicates(docs).collect()
    assert sorted(map(tuple, got)) == brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    got = near_dup.near_duplicates(odd_docs).collect()
    assert sorted(map(tuple, got)) == brute.near_duplicates([(r[0], r[1]) for r in awkward()])


def test_near_duplicates_in_a_large_bucket(spark):
    """A family of edited copies, most pairs below the limit, some above."""
    r, base = random.Random(3), prose(9, 150, 5000).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([2, 5, 9])):
            w[r.randrange(len(w))] = f"e{r.randrange(40)}"
        rows.append((i, " ".join(w)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute.near_duplicates(rows)


def test_near_duplicates_odd_tables(odder_docs, no_docs):
    got = near_dup.near_duplicates(odder_docs).collect()
    assert len(got) == odder_docs.count()
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_dup.near_duplicates(no_docs).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def check_tokens(got, docs, tokenizer):
    at = 0
    want = []
    for doc_id, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got)) == want


def test_token_files(spark, odd_docs, tokenizer):
    check_tokens(queries.op3_token_files(spark, SF_SMALL).collect(),
                 [(r.doc_id, r.text) for r in table(spark, "documents").collect()], tokenizer[1])


def test_token_files_odd_rows(spark, odd_docs, odder_docs, no_docs, tokenizer, tmp_path):
    token_files.write_tokens(odd_docs, str(tmp_path / "a"), tokenizer[0])
    rows = token_files.read_tokens(spark, f"file://{tmp_path}/a", with_ids=True)
    check_tokens(rows.drop("ids").collect(), [(r[0], r[1]) for r in awkward()], tokenizer[1])
    for r in rows.collect():
        assert len(r.ids) == r.n_tokens and r.ids[-1] == 1
    made = token_files.write_tokens(odder_docs, str(tmp_path / "b"), tokenizer[0])
    back = token_files.read_tokens(spark, str(tmp_path / "b")).collect()
    assert len(back) == odder_docs.count() and sum(r.n_tokens for r in back) == made["tokens"]
    assert sum(r.doc_id is None for r in back) == 2
    token_files.write_tokens(no_docs, str(tmp_path / "c"), tokenizer[0])
    assert token_files.read_tokens(spark, str(tmp_path / "c")).count() == 0


def brute_marginals(score, between):
    """Marginals of one chain by summing over all labellings."""
    import itertools
    total, good = 0.0, np.zeros(len(score))
    for path in itertools.product((0, 1), repeat=len(score)):
        w = np.exp(sum(s for s, y in zip(score, path, strict=True) if y) + sum(between[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        good += w * np.array(path)
    return good / total


def test_crf_marginals():
    r = np.random.default_rng(1)
    counts = [3, 1, 6, 2]
    first = np.concatenate([[0], np.cumsum(counts)])
    score, between = r.normal(size=sum(counts)), r.normal(size=(2, 2))
    model = crf_quality.Crf(np.zeros(1), np.ones(1), np.zeros(1), between)
    good, moves = model.marginals(score, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        assert good[a:b] == pytest.approx(brute_marginals(score[a:b], between))
    assert moves.sum() == pytest.approx(sum(c - 1 for c in counts))


def test_crf_quality_held_out(spark):
    got = {r.doc_id: r for r in queries.op1_crf_quality(spark, SF_MID).collect()}
    labels = table(spark, "labels", SF_MID).collect()
    assert len(got) == table(spark, "documents", SF_MID).count()
    assert all(r.held_out == (brute.crc_mod(d, 4) == 2) and 0 <= r.score <= 1 for d, r in got.items())
    held = [(got[x.doc_id], x.quality) for x in labels if got[x.doc_id].held_out]
    right = np.mean([r.predicted == q for r, q in held])
    good, bad = [r.score for r, q in held if q], [r.score for r, q in held if not q]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert right > 0.9 and auc > 0.9


def test_crf_odd_tables(spark, odder_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (13, 0), (14, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    model = crf_quality.train(odder_docs, labels)
    got = crf_quality.score(odder_docs, model).collect()
    assert len(got) == odder_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert crf_quality.score(no_docs, model).count() == 0
    bare = crf_quality.train(no_docs, labels)
    assert [r.score for r in crf_quality.score(odder_docs.limit(1), bare).collect()] == [0.5]
