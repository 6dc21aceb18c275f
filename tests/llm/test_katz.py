"""The backoff model against a plain version that scores token by token."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from sensorstream.llm import katz_lm, queries

from . import brute
from ..conftest import SF_SMALL
from .rows import awkward


class Plain:
    """Katz backoff by recursion over plain counters."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for t in texts:
            w = [*brute.words(brute.low(t)), "</>"]
            self.one.update(w)
            self.two.update(zip(["<>", *w], w, strict=False))
        self.total = sum(self.one.values())
        self.before = Counter()
        self.follow = defaultdict(dict)
        for (v, w), c in self.two.items():
            self.before[v] += c
            if c >= katz_lm.LEAST:
                self.follow[v][w] = c
        self.d1 = katz_lm.discounts(Counter(self.one.values()))
        self.d2 = katz_lm.discounts(Counter(self.two.values()), katz_lm.LEAST)
        self.unseen = 1 - sum(self.word(w) for w in self.one)

    def word(self, w):
        c = self.one[w]
        return (1 if c > 5 else self.d1[c]) * c / self.total if c else self.unseen

    def pair(self, v, w):
        held = self.follow.get(v, {})
        own = {x: (1 if c > 5 else self.d2[c]) * c / self.before[v] for x, c in held.items()}
        mass = sum(own.values())
        left, scale = 1 - mass, 1
        if held and left < 1e-9:
            n = self.before[v]
            left, scale = 1 / (n + 1), n / (n + 1) / mass
        if w in own:
            return own[w] * scale
        alpha = left / (1 - sum(self.word(x) for x in held)) if held else 1
        return alpha * self.word(w)

    def score(self, text):
        w = [*brute.words(brute.low(text)), "</>"]
        base = sum(math.log10((self.one[x] + 1) / (self.total + len(self.one) + 1)) for x in w)
        return len(w), sum(self.one[x] > 0 for x in w), base, sum(math.log10(self.pair(v, x)) for v, x in zip(["<>", *w], w, strict=False))


def check(got, docs, learned):
    plain = Plain([t for d, t in docs if learned(d)])
    text = dict(docs)
    assert len(got) == len(docs)
    for r in got:
        n, known, base, score = plain.score(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, plain.total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-6)
    return plain


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    learned = "crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"
    plain = check(katz_lm.score(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), learned, 2).collect(), docs,
                  lambda d: brute.crc_mod(d, 7) != 2)
    # The query is of trigrams (their scores: test_katz_order); what counts words is the same.
    got, text = queries.op9_katz_lm(spark, SF_SMALL).collect(), dict(docs)
    assert len(got) == len(docs)
    for r in got:
        n, known, base, _ = plain.score(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, plain.total) and r.base_score == pytest.approx(base, rel=1e-9)
    assert all(r.held_out == (brute.crc_mod(r.doc_id, 7) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    for v in ["<>", "the", *list(plain.one)[:20]]:            # every history adds up to one
        assert sum(plain.pair(v, w) for w in plain.one) + plain.pair(v, "never seen") == pytest.approx(1)


def test_odd_rows(spark, odd_docs, odder_docs, no_docs, monkeypatch):
    monkeypatch.setattr(katz_lm, "PACK_TOKENS", 3000)
    docs = [(r[0], r[1]) for r in awkward()]
    check(katz_lm.score(odd_docs, "doc_id % 3 <> 1").collect(), docs, lambda d: d % 3 != 1)
    got = katz_lm.score(odder_docs, "doc_id % 3 <> 1").collect()
    assert len(got) == odder_docs.count()
    repeated = [r for r in got if r.doc_id == 0]
    assert len(repeated) == 3 and len(set(repeated)) == 1
    assert katz_lm.score(no_docs).count() == 0
    assert all(np.isfinite(r.score) and r.n_known == 0 for r in katz_lm.score(odd_docs, "false").collect())


def test_blocks_round_trip():
    r = np.random.default_rng(4)
    history, word, doc = (np.sort(r.integers(0, 5, 400).astype(np.uint64)), r.integers(0, 9, 400).astype(np.uint64), r.integers(0, 6, 400))
    order = np.lexsort((doc, word, history))
    history, word, doc = history[order], word[order], doc[order]
    docs = np.stack([np.arange(6) * 100, np.zeros(6), np.arange(6), np.ones(6)], axis=1).astype(np.int64)
    got = katz_lm.unpack(katz_lm.pack(history, word, doc, docs))
    rows = Counter(zip(history.tolist(), word.tolist(), (doc * 100).tolist(), strict=True))
    assert rows == {(h, w, got["docs"][0][d]): n for h, w, d, n in zip(
        got["history"].tolist(), got["word"].tolist(), got["doc"].tolist(), got["times"].tolist(), strict=True)}
