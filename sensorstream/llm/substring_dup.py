"""Repeated passages: suffix automata of reference shards, matching statistics.

A word goes if it lies in a run of ``SIZE`` words that also starts anywhere
else in the corpus.  One automaton of the whole corpus, or each document
against every shard's automaton, would grow with the square of the corpus, so
text is sharded by content:

1. Every window of ``SIZE`` words has an anchor, the ``GRAM``-word run in it
   with the least hash.  Equal windows have equal anchors.  Neighbouring
   windows mostly share theirs; they form a piece.
2. An anchor that occurs once can hold no repeated window.  A piece that
   occurs twice or more as a whole is repeated: both follow from counts.
3. The pieces of an anchor that still are open are its reference shard: a
   suffix automaton of them, with the number of places of each state, is built
   in the task that holds them.  They are streamed through it, and where the
   matching statistic reaches ``SIZE`` in a state of two places or more, the
   window is repeated.
4. A shard of more than ``SHARD_PIECES`` pieces (one very common passage with
   many surroundings) would make one large automaton, so it is parted by more
   content.  A window has up to ``SIZE - GRAM`` words before its anchor.  Those
   with few and those with many each share a longer run around the anchor, the
   name of a finer shard; steps 2 and 3 are done there, and a shard still too
   large is parted again.  A shard of one place of the anchor is named by the
   whole window, so counts alone settle it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import settle
from ._text import _power_tables, _RUN, Words, mix, scan, signed

SIZE = 35
GRAM = 12
SHARD_PIECES = 5000

_ROW = "doc_id long, text_key long"
_ANCHORS = f"{_ROW}, anchor long, piece long, first int, windows int"


def _pieces(words: Words, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(text, first word, windows, anchor, piece key)`` arrays of a slice."""
    n = len(words.hash)
    if n < size:
        return
    gram = min(GRAM, size)
    grams = words.runs(gram)
    least = np.lib.stride_tricks.sliding_window_view(grams, size - gram + 1)
    at = least.argmin(axis=1) + np.arange(len(least))
    text = np.repeat(np.arange(words.texts), np.diff(words.first))
    start = np.arange(len(at))
    inside = text[start] == text[start + size - 1]
    start, at = start[inside], at[inside]
    if not len(start):
        return
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(start)))
    first = start[begin]
    end = first + count - 1 + size
    power, inverse = _power_tables(_RUN, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words.hash * power[:n], out=total[1:])
    key = mix((total[end] - total[first]) * inverse[first] + mix(count.astype(np.uint64)))
    yield text[first], first - words.first[text[first]], count, grams[at[begin]], key


def _anchors(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for words in scan(batch.column(2), lower=False):
                for text, first, count, anchor, key in _pieces(words, size):
                    who = pa.array(row + text)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(who), batch.column(1).take(who), pa.array(signed(anchor)), pa.array(signed(key)),
                         pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
                        names=["doc_id", "text_key", "anchor", "piece", "first", "windows"])
                row += words.texts
    return run


def _open_words(size: int):
    """The word hashes of a document's open pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "anchor", "first", "times", "hot", "words"]
        for batch in batches:
            row = 0
            wanted = batch.column(3).to_pylist()
            for words in scan(batch.column(2), lower=False):
                out = []
                for i in range(words.texts):
                    h, base = words.hash, words.first[i]
                    for p in wanted[row + i]:
                        a = base + p["first"]
                        out.append((row + i, p["anchor"], p["first"], p["n"], p["hot"], h[a:a + p["windows"] - 1 + size].tobytes()))
                for k in range(0, len(out), 4096):
                    some = out[k:k + 4096]
                    who = pa.array([x[0] for x in some])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(who), batch.column(1).take(who), pa.array([x[1] for x in some], pa.int64()),
                         pa.array([x[2] for x in some], pa.int32()), pa.array([x[3] for x in some], pa.int64()),
                         pa.array([x[4] for x in some], pa.bool_()), pa.array([x[5] for x in some], pa.binary())], names=names)
                row += words.texts
    return run


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with numbers of places."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]

    def _state(self, length: int, moves: dict[int, int], link: int, places: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.places.append(places)
        return len(self.link) - 1

    def add(self, sequence: list[int], times: int = 1) -> None:
        """Add a sequence that stands in ``times`` places."""
        last = 0
        for word in sequence:
            last = self._extend(last, word)
            self.places[last] += times

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        made = self._state(self.length[last] + 1, {}, 0, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = made
            at = self.link[at]
        if at >= 0:
            known = self.next[at][word]
            self.link[made] = known if self.length[known] == self.length[at] + 1 else self._split(at, word, known)
        return made

    def _split(self, at: int, word: int, known: int) -> int:
        """Part the shorter words of a state from its longer ones."""
        short = self._state(self.length[at] + 1, dict(self.next[known]), self.link[known], 0)
        self.link[known] = short
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = short
            at = self.link[at]
        return short

    def count(self) -> None:
        """Sum places up the suffix links; call once after the last ``add``."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]

    def repeated(self, sequence: list[int], size: int) -> list[int]:
        """Starts of the windows of ``size`` words that stand in two places."""
        state, matched, out = 0, 0, []
        for i, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while state and self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if matched >= size and self.places[state] > 1:
                out.append(i - size + 1)
        return out


def _shards(size: int):
    """Repeated windows of each anchor's pieces; rows come sorted by anchor.

    A row that stands for ``times`` places counts for them but has no spans to
    tell: the whole piece is known to be repeated.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for _, group in groupby(rows(batches), key=lambda r: r[2]):
            pieces = [(doc, crc, first, times, np.frombuffer(words, dtype=np.uint64).tolist())
                      for doc, crc, _, first, times, words in group]
            automaton = SuffixAutomaton()
            for *_, times, words in pieces:
                automaton.add(words, times)
            automaton.count()
            for doc, crc, first, times, words in pieces:
                if times > 1:
                    continue
                spans: list[list[int]] = []
                for s in automaton.repeated(words, size):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = s + size
                    else:
                        spans.append([s, s + size])
                held += [(doc, crc, first + a, first + b) for a, b in spans]
            if len(held) >= 4096:
                yield _spans_batch(held)
                held = []
        if held:
            yield _spans_batch(held)
    return run


def _spans_batch(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([h[k] for h in held], t) for k, t in enumerate(kinds)],
                                      names=["doc_id", "text_key", "first", "last"])


def _finer(size: int):
    """Each piece in two: its windows with few words before the anchor, and
    those with many.  ``least`` and ``most`` bound that number of words."""
    gram = min(GRAM, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(3).to_pylist()
            h = np.frombuffer(b"".join(raw), dtype=np.uint64)
            base = np.cumsum([0, *(len(w) // 8 for w in raw)])
            least, most = (batch.column(k).to_numpy().astype(np.int64) for k in (4, 5))
            power, inverse = _power_tables(_RUN, len(h) + 1)
            total = np.zeros(len(h) + 1, dtype=np.uint64)
            np.cumsum(h * power[:len(h)], out=total[1:])
            run_hash = lambda a, b, salt: signed(mix((total[b] - total[a]) * inverse[a] + mix(salt.astype(np.uint64))))  # noqa: B023, E731
            grams = Words(0, h, h, h, np.array([0, len(h)]), h).runs(gram)
            last, base = np.diff(base) - size, base[:-1]
            anchor = grams[base[:, None] + np.arange(size - gram + 1)].argmin(axis=1)
            middle = (least + most + 1) // 2
            for lo, hi in ((least, middle - 1), (middle, most)):
                a, b = np.maximum(anchor - hi, 0), np.minimum(anchor - lo, last)
                own = np.flatnonzero((lo <= hi) & (a <= b))
                if not len(own):
                    continue
                at, a, b, lo, hi = base[own], a[own], b[own], lo[own], hi[own]
                common = at + anchor[own]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)),
                     pa.array(run_hash(common - lo, common - hi + size, lo * size + hi)), pa.array(run_hash(at + a, at + b + size, b - a + 1)),
                     pa.array((batch.column(2).to_numpy()[own] + a).astype(np.int32)), pa.array((b - a + 1).astype(np.int32)),
                     pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), batch.column(6).take(pa.array(own)),
                     pa.array([raw[i][8 * x:8 * (y + size)] for i, x, y in zip(own.tolist(), a.tolist(), b.tolist(), strict=True)], pa.binary())],
                    names=["doc_id", "text_key", "anchor", "piece", "first", "windows", "least", "most", "times", "words"])
    return run


def _marks(per: DataFrame) -> DataFrame:
    """Pieces (in ``n`` places) of anchors in several places.  ``open``: a
    piece of the anchor has one place only.  ``hot``: its shard is too large."""
    anchors = (per.groupBy("anchor").agg(F.sum("n").alias("total"), F.sum((F.col("n") == 1).cast("long")).alias("single"),
                                         F.count("*").alias("kinds")).where("total > 1"))
    return per.join(anchors, "anchor").select(*per.columns, (F.col("single") > 0).alias("open"),
                                              (F.col("kinds") > SHARD_PIECES).alias("hot"))


def _whole(pieces: DataFrame, size: int) -> DataFrame:
    """The spans of whole pieces."""
    return pieces.select("doc_id", "text_key", "first", (F.col("first") + F.col("windows") - 1 + size).alias("last"))


def _in_shards(words: DataFrame, size: int) -> DataFrame:
    return (words.select("doc_id", "text_key", "anchor", "first", "times", "words").repartition("anchor")
            .sortWithinPartitions("anchor").mapInArrow(_shards(size), f"{_ROW}, first int, last int"))


def _in_finer_shards(words: DataFrame, size: int) -> Iterator[DataFrame]:
    """Spans of each level of finer shards; every level halves the places."""
    widest = size - min(GRAM, size)
    carried = ["doc_id", "text_key", "first", "words", "least", "most", "times"]
    rows = words.withColumn("least", F.lit(0)).withColumn("most", F.lit(widest)).select(carried)
    for level in range(widest.bit_length()):
        if rows.isEmpty():
            return
        parted = settle(rows.mapInArrow(_finer(size), f"{_ANCHORS}, least int, most int, times long, words binary"), f"finer-{level}")
        per = parted.groupBy("anchor", "piece").agg(
            F.sum("times").alias("n"), F.min(F.struct("doc_id", "text_key", "first", "least", "most", "words")).alias("one"))
        marked = settle(_marks(per), "finer-pieces")
        again = marked.where("n > 1").select("anchor", "piece")
        yield _whole(parted.where("times = 1").join(again, ["anchor", "piece"]), size)
        left = marked.where("open").select("anchor", "one.*", F.col("n").alias("times"), "hot")
        yield _in_shards(left.where("NOT hot"), size)
        rows = left.where("hot").select(carried)


def _text_key() -> Column:
    """What tells texts of one id apart: 64 bits of text and length."""
    text = F.col("text").cast("string")
    return F.xxhash64(text, F.octet_length(text))


def repeated_spans(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, text_key, first, last``: word ranges of repeated windows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"),
                       F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(_anchors(size), _ANCHORS)
    per = pieces.groupBy("anchor", "piece").agg(F.count("*").alias("n"))
    per = settle(per, "piece-counts")
    marks = _marks(per)
    seen = settle(pieces.join(marks, ["anchor", "piece"]).select("doc_id", "text_key", "anchor", "piece", "first", "windows", "n", "open", "hot"),
                  "pieces")
    # Of a piece in several places one goes on for all of them.
    place = F.struct("doc_id", "text_key", "first", "windows", "hot", "n")
    one = (seen.where("open AND n > 1").groupBy("anchor", "piece").agg(F.min(place).alias("one")).select("one.*", "anchor"))
    wanted = (seen.where("open AND n = 1").select("doc_id", "text_key", "first", "windows", "hot", "n", "anchor").unionByName(one)
              .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "first", "windows", "hot", "n")).alias("wanted")))
    same = F.expr("a.doc_id <=> b.doc_id AND a.text_key <=> b.text_key")
    words = settle(rows.alias("a").join(wanted.alias("b"), same).select("a.doc_id", "a.text_key", "a.text", "b.wanted")
                   .mapInArrow(_open_words(size), f"{_ROW}, anchor long, first int, times long, hot boolean, words binary"), "open-words")
    found = _whole(seen.where("n > 1"), size).unionByName(_in_shards(words.where("NOT hot"), size))
    for spans in _in_finer_shards(words.where("hot"), size):
        found = found.unionByName(spans)
    return found


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        n, gone, kept = [], [], []
        for text, own in zip(texts, spans, strict=True):
            words = (text or "").translate(_BLANK).split(" ")
            words = [w for w in words if w]
            out, at, removed = [], 0, 0
            for a, b in sorted((s["first"], s["last"]) for s in own or ()):
                if b > at:
                    out += words[at:max(a, at)]
                    removed += b - max(a, at)
                    at = b
            n.append(len(words))
            gone.append(removed)
            kept.append(" ".join(out + words[at:]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept"])


_BLANK = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the rest of the text) per row.

    Every place of a repeated window goes, the first too.  Words are compared
    as they are, case included.  A null or empty text has no words; texts of
    fewer than ``size`` words lose none.  Repeated rows repeat each other, with
    or without an id; rows of one id and different texts are told apart by
    their text.  Other columns are not read.
    """
    spans = settle(repeated_spans(docs, size), "spans")
    own = (spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "text_key", _text_key())
    same = F.expr("a.doc_id <=> b.doc_id AND a.text_key <=> b.text_key")
    return (rows.alias("a").join(own.alias("b"), same, "left").select("a.doc_id", "a.text", "b.spans")
            .mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept string"))
