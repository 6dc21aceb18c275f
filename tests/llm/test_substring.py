"""Repeated passages against counting every window."""

import random

import pytest
from pyspark.sql import functions as F

from sensorstream.llm import queries, substring_dup

from . import brute
from ..conftest import SF_MID
from .rows import awkward, prose


def result(df):
    return sorted(tuple(r) for r in df.withColumn("kept", F.sha2(F.col("kept").cast("binary"), 256)).collect())


def test_automaton_counts_places():
    r = random.Random(2)
    pieces = [[r.randrange(3) for _ in range(r.randrange(4, 14))] for _ in range(12)]
    times = [r.randrange(1, 3) for _ in pieces]
    automaton = substring_dup.SuffixAutomaton()
    for p, t in zip(pieces, times, strict=True):
        automaton.add(p, t)
    automaton.count()
    for size in (2, 3, 4, 6):
        seen = {}
        for p, t in zip(pieces, times, strict=True):
            for i in range(len(p) - size + 1):
                seen[tuple(p[i:i + size])] = seen.get(tuple(p[i:i + size]), 0) + t
        for p in pieces:
            want = [i for i in range(len(p) - size + 1) if seen[tuple(p[i:i + size])] > 1]
            assert automaton.repeated(p, size) == want


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op7_substring_dup(spark, SF_MID).collect()))
    want = brute.substrings(docs)
    assert got == sorted(want) and sum(w[2] > 0 for w in want) > 50


@pytest.mark.parametrize("limit", [500, 3])
def test_shared_passages(spark, monkeypatch, limit):
    """A passage in many surroundings, cut at different words."""
    monkeypatch.setattr(substring_dup, "SHARD_PIECES", limit)
    r, passage = random.Random(4), prose(8, 90).split()
    rows = []
    for i in range(40):
        a, b = r.randrange(0, 30), r.randrange(60, 90)
        rows.append((i, " ".join(prose(100 + i, r.randrange(0, 50)).split() + passage[a:b] + prose(200 + i, r.randrange(0, 50)).split())))
    rows.append((99, " ".join(passage + prose(3, 9).split() + passage)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(substring_dup.remove_repeats(df)) == sorted(brute.substrings(rows))


def test_finer_shards_of_a_common_passage(spark, monkeypatch):
    """Copies, near copies and repeated rows around one passage; words repeat."""
    monkeypatch.setattr(substring_dup, "SHARD_PIECES", 2)
    r, passage = random.Random(9), prose(5, 45).split() + ["again"] * 50 + prose(6, 20).split()
    rows = []
    for i in range(30):
        words = [r.choice("xyz") for _ in range(r.randrange(4))] + passage + [r.choice("xyz") for _ in range(r.randrange(4))]
        if i % 3 == 0:
            words[r.randrange(len(words))] = f"odd{i}"
        rows.append((i, " ".join(words)))
    rows += rows[:2] + [(None, rows[0][1]), (40, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = [tuple(r) for r in substring_dup.remove_repeats(df).withColumn("kept", F.sha2(F.col("kept").cast("binary"), 256)).collect()]
    assert sorted(got, key=key) == sorted(brute.substrings(rows), key=key)


@pytest.mark.parametrize("limit", [5000, 1])
def test_odd_rows(spark, odd_docs, odder_docs, no_docs, monkeypatch, limit):
    monkeypatch.setattr(substring_dup, "SHARD_PIECES", limit)
    assert result(substring_dup.remove_repeats(odd_docs)) == sorted(brute.substrings([(r[0], r[1]) for r in awkward()]))
    rows = [(r[0], r[1]) for r in awkward(unique=False)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = [tuple(r) for r in substring_dup.remove_repeats(odder_docs).withColumn("kept", F.sha2(F.col("kept").cast("binary"), 256)).collect()]
    assert sorted(got, key=key) == sorted(brute.substrings(rows), key=key)
    assert substring_dup.remove_repeats(no_docs).count() == 0
