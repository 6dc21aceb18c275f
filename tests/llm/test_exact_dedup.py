"""Exact dedup against plain grouping; the cuckoo filter against a dict."""

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorstream.llm import exact_dedup as ed
from sensorstream.llm import queries

from ..conftest import SF_SMALL
from .rows import awkward


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def want_of(rows):
    """``doc_id, keep_id, group_size, text_sha256`` of each row, and each group's largest id."""
    ids = defaultdict(list)
    for d, t in rows:
        ids[sha(t)].append(d)
    best = {k: max((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted(((d, best[sha(t)], len(ids[sha(t)]), sha(t)) for d, t in rows), key=repr), best


def check(frame, rows):
    got = frame.collect()
    want, best = want_of(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(best)            # one row a text
    assert all(r.doc_id == r.keep_id for r in kept)


def test_awkward_rows(odder_docs, odd_docs, no_docs):
    check(ed.exact_duplicates(odd_docs), [r[:2] for r in awkward()])
    check(ed.exact_duplicates(odder_docs), [r[:2] for r in awkward(unique=False)])
    assert ed.exact_duplicates(no_docs).collect() == []


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op12_exact_dedup(spark, SF_SMALL), docs)


@pytest.mark.parametrize("heavy", [2, 1_000_000])
def test_a_third_of_all_rows_alike(spark, monkeypatch, heavy):
    """Broadcast or joined, and flushed early: the same rows."""
    monkeypatch.setattr(ed, "HEAVY", heavy)
    monkeypatch.setattr(ed, "LOCAL_KEYS", 16)
    monkeypatch.setattr(ed, "SHARD_KEYS", 64)
    rows = [(i, "same" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)] + [(7, "same"), (2997, "same"), (None, "same"), (None, "alone")]
    check(ed.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), rows)


def test_same_fingerprint_and_bucket_is_verified():
    """Digests alike in all that the filter sees are told apart by the stored key."""
    index, digests = ed.CuckooIndex(2), [key(1)[:8] + bytes([i]) * 24 for i in range(6)]
    for i, d in enumerate(digests):
        index.insert(d, (True, i, i))
    assert [index.get(d) for d in digests] == [[(True, i, i), 1] for i in range(6)]
    assert index.get(key(1)[:8] + b"\xff" * 24) is None
    index.remove(digests[2], 1, None)
    assert index.get(digests[2]) is None and len(index) == 5


def test_full_filter_doubles():
    index = ed.CuckooIndex(2)
    for i in range(5000):
        index.insert(key(i), (True, i, i))
    assert index.buckets >= 5000 / ed.SLOTS and len(index) == 5000
    assert all(index.get(key(i)) == [(True, i, i), 1] for i in range(5000))
    assert not any(index.get(key(i)) for i in range(5000, 6000))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["in", "in", "out", "save"]), st.integers(0, 60)), max_size=300), st.sampled_from([2, 4, 16]))
def test_index_is_a_multiset(steps, buckets):
    index, plain, rng = ed.CuckooIndex(buckets), defaultdict(list), random.Random(len(steps))
    for what, i in steps:
        if what == "in":
            row = (True, rng.randrange(1000), 0)
            index.insert(key(i), row)
            plain[i].append(row)
        elif what == "out" and plain[i]:
            plain[i].pop(rng.randrange(len(plain[i])))
            index.remove(key(i), 1, max(plain[i], default=None))
        elif what == "out":
            index.remove(key(i), 1, None)
        else:
            index = ed.CuckooIndex.load(*index.stored())
        assert len(index) == sum(map(bool, plain.values()))
    assert {d: (k, n) for d, k, n in index} == {key(i): (max(v), len(v)) for i, v in plain.items() if v}


def test_kept_index_follows_the_documents(spark):
    def rows(ids, base):
        made = [(i, f"t{i % 40}" if i % 4 else "hot") for i in ids]
        return ed.digests(spark.createDataFrame(made, "doc_id long, text string")).withColumn("row", F.col("id") + base).cache()

    def entries(index):
        return {(r.text_sha256, r.keep_id, r.copies) for r in ed.index_entries(index).collect()}

    def plain(ids):
        return {(k, max(v), len(v)) for k, v in _by_text(ids).items()}

    def _by_text(ids):
        out = defaultdict(list)
        for i in ids:
            out[sha(f"t{i % 40}" if i % 4 else "hot")].append(i)
        return out

    first, gone, came = list(range(300)), [i for i in range(300) if i % 7 == 0 or i % 40 in (3, 9) or i > 280], list(range(410, 440))
    index = ed.build_index(rows(first, 0), 6).cache()
    assert entries(index) == plain(first)
    left = [i for i in first if i not in set(gone)]
    index = ed.update_index(index, rows(came, 0), rows(gone, 0), rows(left, 0)).cache()
    assert entries(index) == plain(left + came)
    assert set(_by_text(gone)) - set(_by_text(left + came))          # some digests went
    none = rows([], 0)
    assert entries(ed.update_index(index, none, rows([1000], 0), none)) >= {e for e in plain(left + came) if e[0] != sha("hot")}
    assert entries(ed.update_index(ed.build_index(none, 6), rows(came, 0), none, none)) == plain(came)
