"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  A line's features are counts of
character classes, its length, repetition within the document, and the same of
its neighbours; the chain adds weights between neighbouring labels.  Forward
and backward sums give each line's marginal, their length-weighted mean the
document's raw quality, and a logistic curve fitted on training documents the
final score.

Training takes a bounded sample of labelled documents (``TRAIN_DOCS``, by the
smallest hash, of those with at most ``TRAIN_BYTES`` bytes and ``TRAIN_LINES``
lines), each whole, each line carrying its document's label.  Scoring reads every
text in full; lines are scored batch by batch with array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import share
from ._text import slices, string_buffers

#: Most labelled documents that a model is fitted on; larger ones are not among them.
TRAIN_DOCS, TRAIN_BYTES, TRAIN_LINES = 4000, 65_536, 500
THRESHOLD = 0.7
_STEPS, _RATE, _DECAY = 250, 0.08, 1e-3


def _class_table() -> np.ndarray:
    """Character class of each byte."""
    table = np.zeros(256, dtype=np.uint8)
    table[0x61:0x7B] = 1                       # lower case
    table[0x41:0x5B] = 2                       # upper case
    table[0x30:0x3A] = 3                       # digits
    table[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4  # blanks
    for c in "#*$%&|<>{}[]=~^_\\@":
        table[ord(c)] = 5                      # symbols
    for c in "!?":
        table[ord(c)] = 6
    for c in ".,;:'\"()-":
        table[ord(c)] = 7                      # punctuation
    table[0x80:] = 8                           # other alphabets
    return table


_CLASS = _class_table()
_CLASSES = 9
_PRIME = np.uint64(0x100000001B3)


@dataclass
class Lines:
    """Lines of one slice: features, byte lengths and the lines of each text."""
    row0: int
    features: np.ndarray
    length: np.ndarray
    first: np.ndarray


def _line_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power = np.full(len(data) + 1, _PRIME, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    # Scaling to a common power compares lines wherever they stand.
    return (total[end] - total[start]) * power[len(data) - start]


def _shifted(x: np.ndarray, by: int, first: np.ndarray) -> np.ndarray:
    """Neighbouring lines' values within a text; zero beyond its ends."""
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by]
        out[first[:-1][first[:-1] < len(x)]] = 0
    else:
        out[:by] = x[-by:]
        last = first[1:] - 1
        out[last[last >= 0]] = 0
    return out


def lines_of(column: pa.Array) -> Iterator[Lines]:
    """Features of every line of every text; an empty text is one empty line."""
    offsets, raw = string_buffers(column)
    for i, j in slices(offsets):
        data = raw[offsets[i]:offsets[j]]
        off = offsets[i:j + 1] - offsets[i]
        breaks = np.flatnonzero(data == 0x0A)
        owner = np.searchsorted(off, breaks, side="right") - 1
        texts = len(off) - 1
        per_text = np.bincount(owner, minlength=texts) + 1
        first = np.concatenate([[0], np.cumsum(per_text)])
        start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
        end = np.sort(np.concatenate([breaks, off[1:]]), kind="stable")
        size = (end - start).astype(np.float64)
        kinds = _CLASS[data]
        count = np.empty((_CLASSES, len(start)))
        for k in range(_CLASSES):
            run = np.concatenate([[0], np.cumsum(kinds == k)])
            count[k] = run[end] - run[start]
        blank = kinds == 4
        begins = ~blank
        begins[1:] &= blank[:-1]
        run = np.concatenate([[0], np.cumsum(begins)])
        words = run[end] - run[start]
        least = np.maximum(size, 1)
        letters = np.maximum(count[1] + count[2] + count[8], 1)
        h = _line_hashes(data, start, end)
        doc = np.repeat(np.arange(texts), per_text)
        order = np.lexsort((h, doc))
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        again = np.zeros(len(h), dtype=bool)
        again[order] = same
        again[order[:-1]] |= same[1:]
        again &= size > 0
        own = np.stack([
            count[2] / letters, count[5] / least, count[6] / least, count[3] / least, count[7] / least,
            count[0] / least, np.minimum(count[1] / least, 1), words / least,
            again, size == 0, np.log1p(size) / 8, np.log1p(words) / 6,
            count[2] > 0.6 * letters, count[5] > 0.05 * least, count[6] > 0.05 * least,
        ], axis=1).astype(np.float64)
        near = np.concatenate([_shifted(own[:, [0, 1, 2, 8, 9]], 1, first), _shifted(own[:, [0, 1, 2, 8, 9]], -1, first)], axis=1)
        alone = (per_text[doc] == 1).astype(np.float64)[:, None]
        features = np.concatenate([own, near, alone, np.ones((len(size), 1))], axis=1)
        yield Lines(i, features, np.maximum(size, 1), first)


@dataclass
class Crf:
    """Weights: features for label good, and the 2 x 2 label transitions."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    between: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)

    def _chains(self, lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = (lines.features - self.mean) / self.scale
        return x, x @ self.weights, np.diff(lines.first)

    def marginals(self, score: np.ndarray, first: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label good for each line, and expected transitions,
        each counted with the weight of the line it leads to (default: 1).

        Chains run side by side from the longest to the shortest; a step adds
        one line to every chain that still has one.
        """
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        longest = int(n.max(initial=0))
        alive = np.searchsorted(-n[order], -np.arange(longest), side="left")
        node = np.zeros((len(score), 2))
        node[:, 1] = score
        ahead, behind = np.zeros_like(node), np.zeros_like(node)
        begin = first[:-1][order]
        t = self.between
        for k in range(longest):
            at = begin[:alive[k]] + k
            if k == 0:
                ahead[at] = node[at]
            else:
                # Log space: ahead[j] = node[j] + log sum_i exp(ahead[i] + t[i, j])
                before = ahead[at - 1]
                ahead[at] = node[at] + np.logaddexp(before[:, :1] + t[0], before[:, 1:] + t[1])
        for k in range(longest - 2, -1, -1):
            at = begin[:alive[k + 1]] + k
            after = behind[at + 1] + node[at + 1]
            behind[at] = np.logaddexp(t[:, 0] + after[:, :1], t[:, 1] + after[:, 1:])
        both = ahead + behind
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        linked = np.ones(len(score), dtype=bool)
        linked[first[:-1][n > 0]] = False
        at = np.flatnonzero(linked)
        pair = ahead[at - 1][:, :, None] + t + (node[at] + behind[at])[:, None, :]
        norm = np.logaddexp(both[at, 0], both[at, 1])
        moves = np.exp(np.minimum(pair - norm[:, None, None], 0))
        return good, moves.sum(axis=0) if weight is None else np.tensordot(weight[at], moves, axes=1)

    def slopes(self, x: np.ndarray, goal: np.ndarray, weight: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient, by weights and transitions, of the weighted log-likelihood
        of the labels ``goal``, a document's lines all having its weight, less
        half of ``_DECAY`` times the squared parameters."""
        good, moves = self.marginals(x @ self.weights, first, weight)
        linked = np.ones(len(goal), dtype=bool)
        linked[first[:-1][np.diff(first) > 0]] = False
        at = np.flatnonzero(linked)
        seen = np.zeros((2, 2))
        np.add.at(seen, (goal[at - 1].astype(int), goal[at].astype(int)), weight[at])
        return x.T @ (weight * (goal - good)) - _DECAY * self.weights, seen - moves - _DECAY * self.between

    def raw(self, lines: Lines) -> np.ndarray:
        """Length-weighted mean of the line marginals of each text."""
        _, score, _ = self._chains(lines)
        good, _ = self.marginals(score, lines.first)
        total = np.concatenate([[0], np.cumsum(good * lines.length)])
        size = np.concatenate([[0], np.cumsum(lines.length)])
        a, b = lines.first[:-1], lines.first[1:]
        return (total[b] - total[a]) / (size[b] - size[a])

    def score(self, lines: Lines) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * _logit(self.raw(lines)) + b, -500, 500)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(texts: list[str | None], labels: list[int]) -> Crf:
    """Fit by Adam on the conditional likelihood of the lines' labels.

    Every document weighs the same, however long.  Without texts, or with one
    label only, the score is the (smoothed) share of label 1.
    """
    held = list(lines_of(pa.array(texts, type=pa.large_string())))
    width = 27 if not held else held[0].features.shape[1]
    y = np.array(labels, dtype=np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Crf(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)), (0.0, float(_logit(np.array(share)))))
    if len(set(labels)) < 2:
        return model
    features = np.concatenate([c.features for c in held])
    length = np.concatenate([c.length for c in held])
    count = np.concatenate([np.diff(c.first) for c in held])
    first = np.concatenate([[0], np.cumsum(count)])
    model.mean = features.mean(axis=0)
    model.scale = features.std(axis=0) + 1e-6
    model.mean[-1], model.scale[-1] = 0.0, 1.0
    x = (features - model.mean) / model.scale
    goal = np.repeat(y, count)
    # A document's lines share its weight; labels weigh by how rare they are.
    rare = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1))
    weight = np.repeat(rare / count, count)
    state = [np.zeros(width), np.zeros(width), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, _STEPS + 1):
        slope, turn = model.slopes(x, goal, weight, first)
        for value, g, m, v in ((model.weights, slope, state[0], state[1]), (model.between, turn, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += _RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    all_lines = Lines(0, features, length, first)
    z, curve = _logit(model.raw(all_lines)), np.zeros(2)
    for _ in range(200):                      # Newton steps for the curve
        p = 1 / (1 + np.exp(-np.clip(curve[0] * z + curve[1], -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((y - p) * z).sum() - 0.1 * curve[0], (y - p).sum()])
        h = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(h, g)
        curve += np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-8:
            break
    model.curve = (float(curve[0]), float(curve[1]))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_docs: int = TRAIN_DOCS) -> Crf:
    """Fit on at most ``most_docs`` labelled documents of ``docs``.

    The sample is the documents with the smallest hash of their id, whole;
    texts of more than ``TRAIN_BYTES`` bytes or ``TRAIN_LINES`` lines are not
    drawn, the next ones by hash are.  Null texts count as empty, null labels
    and ids are left out, and a document labelled twice counts once with its
    larger label.
    """
    marked = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
              .agg(F.max(F.col(label).cast("int")).alias("label")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.octet_length(text) - F.octet_length(F.translate(text, "\n", "")) + 1
    texts = docs.where((F.octet_length(text) <= TRAIN_BYTES) & (lines <= TRAIN_LINES)).select("doc_id", text.alias("text"))
    picked = marked.join(texts.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    rows = (texts.join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
            .limit(most_docs).select("text", "label").collect())
    return fit([r.text for r in rows], [r.label for r in rows])


def score(docs: DataFrame, model: Crf) -> DataFrame:
    """``doc_id, score`` of every row: the probability that its text is good.

    Only the text is an input.  A null text is empty; an empty text is one
    empty line and has a score like any other.  Rows are scored one by one, so
    repeated ids and texts each get theirs.
    """
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared()
        for batch in batches:
            ids, row = batch.column(0), 0
            for lines in lines_of(batch.column(1)):
                got = fitted.score(lines)
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(got)), pa.array(got)], names=["doc_id", "score"])
                row += len(got)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
