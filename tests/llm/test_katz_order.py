"""The backoff model of any order against plain recursion, singletons stored."""

import math
from collections import Counter, defaultdict

import pytest

from sensorstream.llm import katz_lm, queries

from . import brute
from ..conftest import SF_SMALL
from .rows import awkward


class Plain:
    def __init__(self, texts, order):
        self.order = order
        self.follow = defaultdict(Counter)
        for t in texts:
            w = [*brute.words(brute.low(t)), "</>"]
            s = ["<>", *w]
            for i, x in enumerate(w):
                self.follow[()][x] += 1
                for n in range(2, order + 1):
                    if i >= n - 2:
                        self.follow[tuple(s[i - n + 2:i + 1])][x] += 1
        few = defaultdict(Counter)
        for h, f in self.follow.items():
            few[len(h)].update(f.values())
        self.d = {n: katz_lm.discounts(c) for n, c in few.items()}
        self.total = {h: sum(f.values()) for h, f in self.follow.items()}
        self.memo = {}

    def own(self, h, w):
        c = self.follow[h][w]
        return (1 if c > 5 else self.d[len(h)][c]) * c / self.total[h]

    def state(self, h):
        """A history's scale of stored followers, and alpha."""
        if h not in self.memo:
            n, left, scale = self.total[h], 1 - sum(self.own(h, x) for x in self.follow[h]), 1
            if left < 1e-9:
                scale, left = n / (n + 1) / (1 - left), 1 / (n + 1)
            self.memo[h] = scale, left / (1 - sum(self.p(h[1:], x) for x in self.follow[h])) if h else left
        return self.memo[h]

    def p(self, h, w):
        f = self.follow.get(h)
        if f is None:
            return self.p(h[1:], w)
        scale, alpha = self.state(h)
        if w in f:
            return self.own(h, w) * scale
        return alpha * self.p(h[1:], w) if h else alpha

    def score(self, text):
        w = [*brute.words(brute.low(text)), "</>"]
        s = ["<>", *w]
        return sum(math.log10(self.p(tuple(s[max(0, i - self.order + 2):i + 1]), x)) for i, x in enumerate(w))


def check(got, docs, learned, order):
    plain = Plain([t for d, t in docs if learned(d)], order)
    text = dict(docs)
    assert len(got) == len(docs)
    for r in got:
        assert r.score == pytest.approx(plain.score(text[r.doc_id]), rel=1e-6), r.doc_id
    return plain


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders(odd_docs, monkeypatch, order):
    monkeypatch.setattr(katz_lm, "PACK_TOKENS", 3000)
    docs = [(r[0], r[1]) for r in awkward()]
    check(katz_lm.score(odd_docs, "doc_id % 3 <> 1", order).collect(), docs, lambda d: d % 3 != 1, order)


def test_query_is_of_trigrams(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(queries.op9_katz_lm(spark, SF_SMALL).collect(), docs, lambda d: brute.crc_mod(d, 7) != 2, 3)
