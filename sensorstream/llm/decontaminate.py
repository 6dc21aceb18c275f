"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are windows of ten consecutive words of a benchmark item (an item
of fewer words is one shorter window).  For each window length the search
holds a shift table from two-word blocks to the least distance at which a
window may end, and buckets of windows by their last block.  A document is
read from block to block: a positive shift skips that many positions, a zero
shift selects a bucket, and word-by-word comparison confirms.

Benchmark windows are counted first and dealt into blocks of at most
``BLOCK_WINDOWS``, so a broadcast has a known bound at any benchmark size;
every document is searched against every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import settle, share
from ._text import ALPHANUMERIC, Words, scan

WINDOW = 10
#: Windows in one broadcast; about 150 bytes each with their tables.
BLOCK_WINDOWS = 100_000

_FOUND = "doc_id long, text_key long, n_words long, spans array<struct<first:int,last:int>>, items array<string>"


def _window_rows(size: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row = batch.column(0), 0
            for words in scan(batch.column(1), lower=True, word_bytes=ALPHANUMERIC, hashes=False):
                item, text = [], []
                for i in range(words.texts):
                    w = [words.text_bytes(k) for k in range(words.first[i], words.first[i + 1])]
                    for at in range(max(1, len(w) - size + 1) if w else 0):
                        item.append(row + i)
                        text.append(b" ".join(w[at:at + size]))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(item, type=pa.int64())), pa.array(text, type=pa.binary())],
                    names=["item_id", "window"])
                row += words.texts
    return windows


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id`` (as text), ``window`` (its words joined by one blank)."""
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(_window_rows(size), "item_id string, window binary")


class WindowSearch:
    """Wu-Manber tables for windows of one length.

    ``windows`` maps each window, a tuple of words, to its items.
    """

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = {}
        self.items = {w: frozenset(i) for w, i in windows.items()}
        for window in windows:
            for end in range(self.block, length + 1):
                block = window[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.skip), length - end)
            self.bucket.setdefault(window[length - self.block:], []).append(window)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, frozenset[str]]]:
        """``(first word, items)`` of each occurrence of a window."""
        at, n, size, length = self.length, len(words), self.block, self.length
        shift, skip = self.shift, self.skip
        while at <= n:
            block = tuple(words[at - size:at])
            step = shift.get(block, skip)
            if step == 0:
                for window in self.bucket[block]:
                    if all(x == y for x, y in zip(window, words[at - length:at], strict=True)):
                        yield at - length, self.items[window]
                step = 1
            at += step


def searches(windows: list[tuple[str | None, bytes]]) -> list[WindowSearch]:
    """Search tables, one for each window length that occurs."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, window in windows:
        words = tuple(window.split(b" "))
        held = by_length.setdefault(len(words), {}).setdefault(words, set())
        if item is not None:
            held.add(item)
    return [WindowSearch(n, w) for n, w in sorted(by_length.items())]


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "last": b} for a, b in out]


def _texts(words: Words) -> Iterator[list[bytes]]:
    """The words of each text; other bytes become blanks, so one split does."""
    blank = np.full(len(words.data), 0x20, dtype=np.uint8)
    np.copyto(blank, words.data, where=ALPHANUMERIC[words.data])
    whole = blank.tobytes()
    for i in range(words.texts):
        a, b = words.first[i], words.first[i + 1]
        yield whole[words.start[a]:words.end[b - 1]].split() if b > a else []


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared()
        for batch in batches:
            row = 0
            for words in scan(batch.column(2), lower=True, word_bytes=ALPHANUMERIC, hashes=False):
                n, spans, items = [], [], []
                for text in _texts(words):
                    found: list[tuple[int, int]] = []
                    named: set[str] = set()
                    for table in tables:
                        for at, who in table.find(text):
                            found.append((at, at + table.length))
                            named |= who
                    n.append(len(text))
                    spans.append(_merged(found))
                    items.append(sorted(named))
                count = words.texts
                carried = batch.schema.names[3:]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, count), batch.column(1).slice(row, count), pa.array(n, type=pa.int64()),
                    pa.array(spans, type=pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                    pa.array(items, type=pa.list_(pa.string())),
                    *(batch.column(c).slice(row, count) for c in carried),
                ], names=["doc_id", "text_key", "n_words", "spans", "items", *carried])
                row += count
    return run


def _overlap(spans: str) -> str:
    """Words covered by a list of sorted or unsorted spans."""
    ordered = f"array_sort({spans})"
    return (f"aggregate({ordered}, struct(0L AS hit, 0 AS reach), "
            "(a, s) -> struct(a.hit + greatest(0, s.last - greatest(s.first, a.reach)) AS hit, "
            "greatest(a.reach, s.last) AS reach), a -> a.hit)")


def _keys() -> list[Column]:
    text = F.col("text").cast("string")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS, carry: bool = False) -> DataFrame:
    """``doc_id, text_key, n_words, spans, items, n_hit, contaminated`` per row.

    ``spans`` are the word ranges (last exclusive) inside occurrences of
    benchmark windows, ``items`` the ids, as sorted text, of the items they
    come from.  Words are runs of letters, digits and non-ASCII characters with
    A-Z lowered.  A null or empty text has no words and is never hit; null
    benchmark texts hold no window; windows of an item without an id hit words
    but name no item.  Rows with the same ``doc_id`` are judged each on its own
    text.  With ``carry``, the column ``row`` holds the whole input row;
    otherwise other columns of either table are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(*_keys())
    schema = _FOUND
    if carry:
        rows = docs.select(*_keys(), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
        schema += f", row {rows.schema['row'].dataType.simpleString()}"
    windows = benchmark_windows(benchmark, size)
    total = windows.count()
    blocks = max(1, -(-total // block_windows))
    def search(block: int) -> DataFrame:
        # Dealt by the window, so the items of a window meet in one block.
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else windows
        tables = searches([(r.item_id, bytes(r.window)) for r in part.distinct().collect()])
        return rows.mapInArrow(_search(share(spark, tables)), schema)

    found = search(0)
    if blocks > 1:
        # Each block's hits are stored.  Rows of the same id and text have the
        # same hits, so one row each is merged and joined to all of them.
        hits = [settle(search(k).where("size(spans) > 0").drop("row"), "hits") for k in range(blocks)]
        merged = reduce(DataFrame.unionByName, hits).groupBy("doc_id", "text_key").agg(
            F.array_distinct(F.flatten(F.collect_set("spans"))).alias("s"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("i"))
        same = F.expr("a.doc_id <=> b.doc_id AND a.text_key <=> b.text_key")
        found = (found.alias("a").join(merged.alias("b"), same, "left")
                 .select("a.doc_id", "a.text_key", "a.n_words", F.coalesce("b.s", "a.spans").alias("spans"),
                         F.coalesce("b.i", "a.items").alias("items"), *["a.row"] * carry))
    return (found.withColumn("n_hit", F.expr(_overlap("spans")))
            .withColumn("contaminated", F.col("n_hit") > 0))


def items_digest(items: str) -> Column:
    """SHA-256 of the item ids joined by commas."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)
