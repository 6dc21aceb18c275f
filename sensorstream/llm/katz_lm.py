"""Language-model scores: a Katz backoff model with Good-Turing counts.

    P(w | u v) = d(c) * c(u v w) / c(u v)   if c(u v w) > 0
               = alpha(u v) * P(w | v)      else
    P(w | v)   = d(c) * c(v w) / c(v)       if c(v w) > 0
               = alpha(v) * P(w)            else
    P(w)       = d(c) * c(w) / N, all unseen words together what is left

and so on for higher orders; near a text's beginning histories are as long as
there are words, the beginning included.

``d`` are Good-Turing discounts for counts up to ``GT_MOST`` (with a fixed
discount where the counts of counts don't allow one), and ``alpha(v)`` is the
mass that the stored followers of ``v`` leave over that of the words they
leave out, so every history's probabilities add up to one.  A history of two
and more words is known by the hash of its words, and a "pair" below is a
history of any length and the word after it.

Texts cross the cluster once.  Map tasks turn tokens into windows (a word and
the words before it that the order asks for), sort them and pack them, with the
documents they stand in, into compressed blocks over a dictionary, one block for
each bucket.  A window goes by the last word of its history, so its pairs of
all levels (the order of the model they belong to) and all followers of its
histories meet in one bucket.  A history is "hot" if it would fill a quarter of a bucket;
windows go by their shortest history that is not, or by the pair.  The first
pass over the buckets counts how many pairs have each small count, and what
buckets must tell each other: the counts of words and of the pairs of hot
histories.  These are summed and stored by bucket.  The second pass scores the
same buckets (their shuffle files are used again) and counts all other pairs anew,
which is cheaper than to store them.

Words are known by 48 bits of their hash.
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ._scratch import partitions, settle, share
from ._text import scan

GT_MOST = 5
#: Least count of a pair that is not backed off from.
LEAST = 1
#: Order of the query's model: a word and the two before it.
ORDER = 3
#: Tokens that a map task sorts and packs at a time.
PACK_TOKENS = 1_500_000
#: Parts of a bucket, counted and scored one after the other.
PARTS = 8
_BITS = np.uint64((1 << 48) - 1)
_HISTORY_BITS = np.uint64((1 << 63) - 1)
#: The end of a text, a token, and its beginning, only a history.
END, BEGIN = 0x1E7D00000001, 0x1E7D00000002
#: What stands before the beginning in a window.
PAD = 0x1E7D00000003


# -- blocks ------------------------------------------------------------------

def _planes(x: np.ndarray) -> bytes:
    """64-bit values as planes of bytes, which compress when sorted."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: memoryview, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).reshape(-1).view("<u8")


def _small(x: np.ndarray) -> bytes:
    """32-bit values as planes of bytes."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_small(raw: memoryview, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).reshape(-1).view("<u4")


def pack(history: np.ndarray, word: np.ndarray, doc: np.ndarray, docs: np.ndarray, number: int = 0,
         before: tuple = (), names: np.ndarray | None = None, part: np.ndarray | None = None) -> bytes:
    """A block of windows sorted by part, history, word, words before, document.

    ``doc`` are rows of ``docs`` (id, null mark, row in the pack, train mark);
    ``number`` is the pack's, the texts that a map task sorted together;
    ``history`` is the last word of each history and ``before`` are the words
    before it, the nearest first.  With ``names`` words are given as their
    places in it.
    """
    columns = [history, word, *before]
    if names is None:
        names, places = np.unique(np.concatenate(columns), return_inverse=True)
        columns = np.split(places, len(columns))
    window = np.ones(len(doc), dtype=bool)
    window[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    new = window.copy()
    new[1:] |= doc[1:] != doc[:-1]
    times = np.diff(np.append(np.flatnonzero(new), len(doc)))
    entries = np.diff(np.append(np.flatnonzero(window[new]), int(new.sum())))
    part = np.zeros(len(entries), np.int64) if part is None else part[window]
    used, (local,) = _kept([doc[new]], len(docs))
    known, columns = _kept([c[window] for c in columns], len(names))
    # The first column ascends: its steps are small.
    columns[0] = np.diff(columns[0], prepend=0) % (1 << 32)
    # So do names of equal frequency.
    arrays = [_planes(np.diff(names[known], prepend=np.uint64(0))), np.searchsorted(part, np.arange(PARTS + 1)).astype("<i8").tobytes(), *map(_small, columns), _small(entries), _small(local), _small(times), docs[used].astype("<i8").T.tobytes()]
    sizes = struct.pack("<6q", len(known), len(columns), len(entries), len(times), len(used), number)
    return zstandard.compress(sizes + b"".join(arrays), 3)


def _kept(columns: list[np.ndarray], n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Values under ``n`` that occur, and the columns as places among them."""
    mark = np.zeros(n, dtype=bool)
    for c in columns:
        mark[c] = True
    place = np.cumsum(mark) - 1
    return np.flatnonzero(mark), [place[c] for c in columns]


def _opened(block: bytes) -> dict:
    """Windows as places in ``names``, with their number of ``entries`` (``doc, times``);
    the parts' first windows and entries."""
    raw = memoryview(zstandard.decompress(block))
    k, columns, w, e, d, number = struct.unpack("<6q", raw[:48])
    at = 48

    def take(n: int) -> memoryview:
        nonlocal at
        at += n
        return raw[at - n:at]

    names = np.cumsum(_from_planes(take(8 * k), k), dtype=np.uint64)
    cuts = np.frombuffer(take(8 * (PARTS + 1)), "<i8").copy()
    found = [_from_small(take(4 * w), w) for _ in range(columns)]
    found[0] = np.cumsum(found[0], dtype=np.uint32)
    entries = _from_small(take(4 * w), w)
    return {"names": names, "columns": found, "entries": entries, "cuts": cuts,
            "entry_cuts": np.append(0, np.cumsum(entries, dtype=np.int64))[cuts], "doc": _from_small(take(4 * e), e),
            "times": _from_small(take(4 * e), e), "docs": np.frombuffer(take(32 * d), "<i8").reshape(4, d).copy(), "pack": number}


def unpack(block: bytes) -> dict[str, np.ndarray]:
    """Entries ``history, word, doc, times`` and the block's ``docs``."""
    found = _opened(block)
    history, word = (np.repeat(found["names"][c], found["entries"]) for c in found["columns"][:2])
    return {"history": history, "word": word,
            "doc": found["doc"].astype(np.int64), "times": found["times"].astype(np.int64), "docs": found["docs"], "pack": found["pack"]}


def _tokens(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History, word and text of each token of a slice, ends included."""
    n = np.diff(words.first)
    text = np.repeat(np.arange(words.texts), n + 1)
    last = np.cumsum(n + 1) - 1
    word = np.empty(len(text), dtype=np.uint64)
    inner = np.ones(len(text), dtype=bool)
    inner[last] = False
    word[inner] = words.hash & _BITS
    word[last] = END
    history = np.empty_like(word)
    history[1:] = word[:-1]
    history[last - n] = BEGIN
    return history, word, text


def _longer(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The history that a pair is for the next word."""
    return _mixed(history, word) & _HISTORY_BITS


def _levels(history: np.ndarray, word: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Level, places, histories and lower histories of the pairs of each level."""
    at = np.arange(len(word))
    inside = at - np.maximum.accumulate(np.where(history == BEGIN, at, 0))     # place in its text
    lower = np.zeros_like(history)
    for level in range(2, order + 1):
        if level > 2:
            lower, history = history, np.append(np.zeros(1, np.uint64), _longer(history[:-1], word[:-1]))
        here = np.flatnonzero(inside >= level - 2)
        yield level, here, history[here], lower[here]


def _count_histories(hot: np.ndarray, order: int):
    """Counts of the longer histories all of whose words are frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, train = 0, np.array(batch.column(2).to_pylist(), dtype=bool)
            for words in scan(batch.column(3), lower=True):
                history, word, text = _tokens(words)
                learned = train[row + text]
                frequent = np.isin(history, hot)
                run_length = frequent
                for level, here, long, _ in _levels(history, word, order):
                    if level > 2:
                        run_length = frequent & np.append(False, run_length[:-1])
                        keep = run_length[here]
                        kinds, back = np.unique(long[keep], return_inverse=True)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(kinds), level)), pa.array(kinds.astype(np.int64)),
                            pa.array(np.bincount(back, weights=learned[here][keep], minlength=len(kinds)).astype(np.int64)),
                            pa.array(np.bincount(back, minlength=len(kinds)))], names=["level", "history", "c", "every"])
                row += words.texts
    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, train = 0, np.array(batch.column(2).to_pylist(), dtype=bool)
        for words in scan(batch.column(3), lower=True):
            _, word, text = _tokens(words)
            kinds, back = np.unique(word, return_inverse=True)
            learned = np.bincount(back, weights=train[row + text], minlength=len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int64)), pa.array(learned),
                                              pa.array(np.bincount(back, minlength=len(kinds)))], names=["word", "c", "every"])
            row += words.texts


def _hash(columns: list[np.ndarray], level: int) -> np.ndarray:
    """Histories of a level from their words, the last one first."""
    found = columns[level - 2]
    for c in columns[:level - 2][::-1]:
        found = _longer(found, c)
    return found


def _bucket(columns: list[np.ndarray], word: np.ndarray, hot: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """Bucket of each window: by its shortest history that is not hot, or by the pair of the longest."""
    key = columns[0].copy()
    at = np.flatnonzero(np.isin(key, hot[2]))
    for level in range(3, max(hot) + 1):
        inside = columns[level - 2][at] != PAD
        short = at[~inside]
        key[short] = _mixed(key[short], word[short])
        at = at[inside]
        key[at] = _hash([c[at] for c in columns], level)
        at = at[np.isin(key[at], hot[level])]
    key[at] = _mixed(key[at], word[at])
    return ((key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20)) % np.uint64(buckets)      # of parts as well


def _blocks(hot: dict[int, np.ndarray], buckets: int):
    """Blocks of windows by bucket."""
    order = max(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        packs = itertools.count(TaskContext.get().partitionId() << 32)

        def flush() -> Iterator[pa.RecordBatch]:
            base, docs = 0, []
            for at, (_, _, text, own) in enumerate(held):
                held[at][2][:] = text + base
                docs.append(own)
                base += len(own)
            word, doc = (np.concatenate([p[k] for p in held]) for k in (1, 2))
            first = np.concatenate([p[0] for p in held]) == BEGIN
            held.clear()
            table, number = np.concatenate(docs), next(packs)
            table[:, 2] = np.arange(len(table))
            # Words by how frequent they are: most places are small numbers.
            names, places = np.unique(np.append(word, np.array([BEGIN, PAD], np.uint64)), return_inverse=True)
            by = np.argsort(-np.bincount(places), kind="stable")
            rank = np.empty(len(by), dtype=np.int32)
            rank[by] = np.arange(len(by))
            names, places = names[by], rank[places]
            columns, last = [], places[:-2]
            for filler in [places[-2]] + [places[-1]] * (order - 2):
                last = np.append(filler, last[:-1]).astype(np.int32)
                last[first] = filler
                columns.append(last)
            bucket = _bucket([names[c] for c in columns], word, hot, buckets * PARTS)
            w = places[:-2]
            by = np.arange(len(w))
            for c in columns[2:][::-1]:
                by = by[np.argsort(c[by], kind="stable")]
            key = columns[0].astype(np.uint64) * np.uint64(len(names)) + w.astype(np.uint64)
            if order > 2 and len(names) ** 3 < 1 << 64:
                key = key * np.uint64(len(names)) + columns[1].astype(np.uint64)
            elif order > 2:
                by = by[np.argsort(columns[1][by], kind="stable")]
            by = by[np.argsort(key[by], kind="stable")]
            by = by[np.argsort(bucket[by].astype(np.uint16 if buckets * PARTS < 1 << 16 else np.uint64), kind="stable")]
            w, doc, bucket, columns = w[by], doc[by], bucket[by], [c[by] for c in columns]
            bucket, part = np.divmod(bucket.astype(np.int64), PARTS)
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(by))
            for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
                history, *before = (c[a:b] for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(bucket[a])], pa.int32()),
                     pa.array([pack(history, w[a:b], doc[a:b], table, number, before, names, part[a:b])], pa.binary())],
                    names=["bucket", "block"])

        for batch in batches:
            ids = batch.column(0)
            null = np.array(ids.is_null().to_numpy(zero_copy_only=False))
            about = np.stack([ids.fill_null(0).to_numpy(), null, np.zeros(len(ids)),
                              np.array(batch.column(2).to_pylist(), dtype=bool)], axis=1).astype(np.int64)
            row = 0
            for words in scan(batch.column(3), lower=True):
                held.append((*_tokens(words), about[row:row + words.texts]))
                row += words.texts
                if sum(len(x[0]) for x in held) >= PACK_TOKENS:
                    yield from flush()
        if held:
            yield from flush()
    return run


# -- the model ---------------------------------------------------------------

def discounts(count_of_counts: dict[int, int], least: int = 1) -> np.ndarray:
    """Katz's discount of each count from 0 to ``GT_MOST``; 1 beyond.

    Good-Turing's ``(r + 1) n(r + 1) / (r n(r))`` where that lies between 0
    and 1, else ``(r - 1/2) / r``; counts under ``least`` get 0.
    """
    out = np.ones(GT_MOST + 1)
    for r in range(GT_MOST + 1):
        n, more = count_of_counts.get(r, 0), count_of_counts.get(r + 1, 0)
        good = (r + 1) * more / (r * n) if r and n else 0
        out[r] = 0 if r < least else good if 0 < good < 1 else (r - 0.5) / r
    return out


class Unigrams:
    """Word probabilities from training counts."""

    def __init__(self, total: int, kinds: int, count_of_counts: dict[int, int]):
        self.total, self.kinds = total, kinds
        self.discount = discounts(count_of_counts)
        kept = total - sum(r * n * (1 - self.discount[r]) for r, n in count_of_counts.items() if 0 < r <= GT_MOST)
        # Where nothing is discounted, unseen words get one count more.
        self.scale = 1 / max(total, 1) if kept < total else 1 / (total + 1)
        self.unseen = 1 - kept * self.scale

    def log10(self, c: np.ndarray) -> np.ndarray:
        low = np.minimum(c, GT_MOST).astype(np.int64)
        d = np.where(c > GT_MOST, 1.0, self.discount[low])
        return np.log10(np.where(c > 0, np.maximum(d * c, 1e-300) * self.scale, max(self.unseen, 1e-300)))

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.kinds + 1))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(bucket, []).append(block)
    while held:
        yield held.popitem()


class Windows:
    """The windows of a part of a bucket, with their counts in training texts."""

    def __init__(self, opened: list[dict], part: int):
        self.columns, self.c, self.first = [], [], [0]
        for b in opened:
            here, there = (slice(*b[k][part:part + 2]) for k in ("cuts", "entry_cuts"))
            entries = b["entries"][here]
            self.columns.append([b["names"][c[here]] for c in b["columns"]])
            self.first.append(self.first[-1] + len(entries))
            if len(entries):
                learned = np.where(b["docs"][3][b["doc"][there]] == 1, b["times"][there], 0)
                self.c.append(np.add.reduceat(learned, np.cumsum(entries, dtype=np.int64) - entries))
        history, self.word, *before = map(np.concatenate, zip(*self.columns, strict=True))
        self.columns = [history, *before]
        self.c = np.concatenate(self.c) if self.c else np.zeros(0, np.int64)

    def pairs(self, level: int) -> dict[str, np.ndarray]:
        """The different pairs of a level with their counts here.

        ``rows`` are the windows that have one, ``back`` which it is, and
        ``first`` a window of each pair.
        """
        rows = np.arange(len(self.word)) if level < 3 else np.flatnonzero(self.columns[level - 2] != PAD)
        columns, word = [c[rows] for c in self.columns[:max(level - 1, 1)]], self.word[rows]
        history = _hash(columns, level) if level > 1 else np.zeros_like(word)
        _, first, back = np.unique(_mixed(history, word), return_index=True, return_inverse=True)
        lower = _hash([c[first] for c in columns], level - 1) if level > 2 else np.zeros(len(first), np.uint64)
        return {"history": history[first], "lower": lower, "word": word[first], "rows": rows, "back": back, "first": rows[first],
                "c": np.bincount(back, weights=self.c[rows], minlength=len(first)).astype(np.int64)}


_TOLD = "bucket long, level long, history long, lower long, word long, c long"


def _count_pairs(hot: dict[int, np.ndarray]):
    """What buckets tell each other: counts of words (level 1, history 0, and 1
    as lower for those in several parts or after a hot history) and of pairs of hot histories;
    and how many other pairs have each small count (bucket -1, the count as word)."""
    columns = "history", "lower", "word", "c"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "level", "history", "lower", "word", "c"]
        for bucket, blocks in _by_bucket(batches):
            opened = list(map(_opened, blocks))
            few = {level: np.zeros(GT_MOST + 1) for level in hot}
            held = {level: [] for level in hot}
            for part in range(PARTS):
                windows = Windows(opened, part)
                for level in range(1, max(hot) + 1):
                    found = windows.pairs(level)
                    told = np.isin(found["history"], hot[level])
                    if level == 1:
                        follows = np.isin(windows.columns[0], hot[2])
                        found["lower"] = (np.bincount(found["back"], weights=follows, minlength=len(told)) > 0).astype(np.uint64)
                    own = found["c"][~told]
                    few[level] += np.bincount(own[own <= GT_MOST + 1], minlength=GT_MOST + 2)[1:]
                    held[level].append([found[k][told] for k in columns])
            for level in few:
                history, lower, word, c = map(np.concatenate, zip(*held[level], strict=True))
                _, first, back = np.unique(_mixed(history, word), return_index=True, return_inverse=True)
                c, lower_ = np.bincount(back, weights=c, minlength=len(first)), lower[first]
                if level == 1:
                    np.maximum.at(lower_, back, lower)
                    lower_[np.bincount(back) > 1] = 1
                none = np.zeros(GT_MOST + 1)
                rows = [(none - 1, none + level, none, none, np.arange(1, GT_MOST + 2), few[level]),
                        (np.full(len(first), bucket), np.full(len(first), level), history[first], lower_, word[first], c)]
                for row in rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(x).astype(np.int64)) for x in row], names=names)
    return run


def _read_bucket(path: str, bucket: int) -> dict[str, np.ndarray]:
    local = urlparse(path).scheme in ("", "file")
    fs, root = (pyarrow.fs.LocalFileSystem(), urlparse(path).path) if local else pyarrow.fs.FileSystem.from_uri(path)
    folder = f"{root}/bucket={bucket}"
    names = ["level", "history", "lower", "word", "c", "owner"]
    if fs.get_file_info(folder).type == pyarrow.fs.FileType.NotFound:
        return {n: np.zeros(0, np.int64) for n in names}
    table = pyarrow.dataset.dataset(folder, filesystem=fs, format="parquet").to_table(columns=names)
    return {n: table.column(n).to_numpy() for n in names}


def _told(path: str, bucket: int) -> dict[int, dict[str, np.ndarray]]:
    """What a bucket was told, by level, each in the order of its keys."""
    stored, found = _read_bucket(path, bucket), {}
    for level in np.unique(stored["level"]).tolist():
        part = {k: v[stored["level"] == level] for k, v in stored.items()}
        part |= {k: part[k].astype(np.uint64) for k in ("history", "lower", "word")}
        part["key"] = _mixed(part["history"], part["word"])
        by = np.argsort(part["key"])
        found[level] = {k: v[by] for k, v in part.items()}
    return found


def _own(c: np.ndarray, total: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """Discounted shares of pairs among all of their histories."""
    low = np.minimum(c, GT_MOST).astype(np.int64)
    return np.where(c > GT_MOST, 1.0, discount[low]) * c / np.maximum(total, 1)


def pair_values(history: np.ndarray, c: np.ndarray, below: np.ndarray, discount: np.ndarray,
                left: dict[int, tuple[float, float, int]]) -> np.ndarray:
    """log10 P(w | v) of pairs from their counts.

    ``below`` is log10 of the words' probabilities one level below.  ``left``
    holds the sums of the pairs' own shares and of those probabilities, and the
    counts, of hot histories; of the others all pairs must be here.
    """
    names, back = np.unique(history, return_inverse=True)
    across = np.array(sorted(left), dtype=np.uint64)
    at = np.searchsorted(names, across)
    here = np.flatnonzero(names[np.minimum(at, len(names) - 1)] == across)
    total = np.bincount(back, weights=c, minlength=len(names))
    hot = [(at[k], *left[int(across[k])]) for k in here]
    for k, _, _, count in hot:
        total[k] = count
    own = _own(c, total[back], discount)
    mass = np.bincount(back, weights=own, minlength=len(names))
    words = np.bincount(back, weights=np.where(c > 0, 10.0 ** below, 0.0), minlength=len(names))
    for k, m, p, _ in hot:
        mass[k], words[k] = m, p
    # A history that would leave nothing leaves one count; one never seen leaves all.
    none = 1 - mass < 1e-9
    shrink = np.where(none, total / (total + 1) / np.maximum(mass, 1e-300), 1.0)
    alpha = np.where(none, 1 / (total + 1), 1 - mass) / np.maximum(1 - words, 1e-12)
    alpha[total == 0] = 1.0
    return np.where(c > 0, np.log10(np.maximum(own * shrink[back], 1e-300)), np.log10(alpha)[back] + below)


def _hot_sums(shared, level: int):
    """Sums over a bucket's share of the followers of each hot history of a level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            for bucket in batch.column(0).to_pylist():
                told = _told(model["path"], bucket)
                if level not in told:
                    continue
                log = model["words"].log10(told[1]["c"])
                for n in range(2, level + 1):
                    part, under = told[n], told[n - 1]
                    below = log[np.searchsorted(under["key"], _mixed(part["lower"], part["word"]))]
                    if n < level:
                        log = pair_values(part["history"], part["c"], below, model["discount"][n], model["left"][n])
                mine = (part["owner"] == 1) & (part["c"] > 0)
                history, c = part["history"][mine], part["c"][mine]
                names, back = np.unique(history, return_inverse=True)
                total = np.array([model["hot"][level][x] for x in names.tolist()], dtype=np.int64)
                sums = [np.bincount(back, weights=x, minlength=len(names)) for x in (
                    _own(c, total[back], model["discount"][level]), 10.0 ** below[mine])]
                yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), *map(pa.array, sums)], names=["history", "mass", "p"])
    return run


def _score(shared):
    """Each document's share of its sums from the windows of a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        words = model["words"]
        for bucket, blocks in _by_bucket(batches):
            opened, told = list(map(_opened, blocks)), _told(model["path"], bucket)
            sums = [np.zeros((4, b["docs"].shape[1])) for b in opened]
            for part in range(PARTS):
                windows = Windows(opened, part)
                if not len(windows.word):
                    continue
                log = base = known = None
                for level in range(1, model["order"] + 1):
                    found = windows.pairs(level)
                    c = found["c"]
                    if level in told:
                        key, all_ = _mixed(found["history"], found["word"]), told[level]
                        at = np.minimum(np.searchsorted(all_["key"], key), len(all_["key"]) - 1)
                        c = np.where(all_["key"][at] == key, all_["c"][at], c)
                    if level == 1:
                        log, base, known = (x[found["back"]] for x in (words.log10(c), words.base(c), c > 0))
                    elif len(c):
                        log[found["rows"]] = pair_values(found["history"], c, log[found["first"]], model["discount"][level],
                                                         model["left"][level])[found["back"]]
                for b, own, a, z in zip(opened, sums, windows.first[:-1], windows.first[1:], strict=True):
                    here, there = (slice(*b[k][part:part + 2]) for k in ("cuts", "entry_cuts"))
                    doc, n, entries = b["doc"][there], b["times"][there].astype(np.float64), b["entries"][here]
                    for k, x in enumerate((log, base, known, np.ones(len(log)))):
                        own[k] += np.bincount(doc, weights=n * np.repeat(x[a:z], entries), minlength=own.shape[1])
            for b, own in zip(opened, sums, strict=True):
                docs = b["docs"]
                counts = np.stack([docs[0], docs[1], docs[2], own[2], own[3]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["pack"]], pa.int64()),
                    pa.array([zstandard.compress(_planes(own[:2].ravel().view(np.uint64)), 3)], pa.binary()),
                    pa.array([zstandard.compress(_planes(counts.ravel().view(np.uint64)), 3)], pa.binary()),
                ], names=["pack", "sums", "counts"])
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of the packs of a partition."""
    packs: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for number, sums, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = [zstandard.decompress(x) for x in (sums, counts)]
            raw = [_from_planes(x, len(x) // 8) for x in raw]
            packs.setdefault(number, []).append((raw[0].view("<f8").reshape(2, -1), raw[1].view("<i8").reshape(5, -1)))
    while packs:
        _, parts = packs.popitem()
        sums, counts = (np.concatenate([p[k] for p in parts], axis=1) for k in (0, 1))
        rows, at, back = np.unique(counts[2], return_index=True, return_inverse=True)
        add = lambda x: np.bincount(back, weights=x, minlength=len(rows))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([
            pa.array(counts[0][at], mask=counts[1][at] == 1), pa.array(add(counts[4]).astype(np.int64)),
            pa.array(add(counts[3]).astype(np.int64)), pa.array(add(sums[1])), pa.array(add(sums[0]))],
            names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def _mixed(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    from ._text import mix
    return mix(mix(history.astype(np.uint64)) + word.astype(np.uint64))


def score(docs: DataFrame, train: str = "true", order: int = 2) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row.

    The model is learned from the rows for which the SQL condition ``train``
    over ``doc_id`` holds (null: no) and scores all.  Tokens are the words with
    A-Z lowered and one end; a null or empty text is its end alone.
    ``base_score`` is the add-one unigram score, ``score`` the model's, both
    sums of log10.  Repeated rows are learned and scored each; other columns
    are not read.  Without training rows all tokens are unseen.  ``order`` is
    2 for a model of word pairs, 3 for triples, and so on.
    """
    if order < 2:
        raise ValueError(f"order {order} is under 2")
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.crc32(text.cast("binary")), F.lit(-1)).alias("text_crc"),
                       F.coalesce(F.expr(train), F.lit(False)).alias("train"), text.alias("text"))
    words = settle(rows.mapInArrow(_count_words, "word long, c long, every long").groupBy("word")
                   .agg(F.sum("c").alias("c"), F.sum("every").alias("every")), "words")
    seen = words.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("every")).first()
    total, kinds, every = (int(x or 0) for x in seen)
    few = {r.c: r.n for r in words.where(f"c BETWEEN 1 AND {GT_MOST + 1}").groupBy("c").agg(F.count("*").alias("n")).collect()}
    buckets = partitions(spark)
    # At most 4 * buckets words can be this frequent.
    hot = {r.word: r.c for r in words.where(F.col("every") * 4 * buckets > every).select("word", "c").collect()}
    ends = hot.get(END, 0) or sum(r.c for r in words.where(F.col("word") == END).collect())
    hot.pop(END, None)
    hot[BEGIN] = ends
    hots = {level: {} for level in range(3, order + 1)} | {1: {0: total}, 2: hot}
    arrays = lambda: {level: np.array(sorted(h), dtype=np.uint64) for level, h in hots.items()}
    if order > 2:
        longer = rows.mapInArrow(_count_histories(arrays()[2], order), "level long, history long, c long, every long")
        for r in (longer.groupBy("level", "history").agg(F.sum("c").alias("c"), F.sum("every").alias("every"))
                  .where(F.col("every") * 4 * buckets > every).collect()):
            hots[r.level][r.history] = r.c
    blocks = rows.mapInArrow(_blocks(arrays(), buckets), "bucket int, block binary")
    dealt = blocks.rdd.map(lambda r: (r[0], bytes(r[1]))).partitionBy(buckets, lambda b: b)
    blocks = spark.createDataFrame(dealt, "bucket int, block binary")
    counted = settle(blocks.mapInArrow(_count_pairs(arrays()), _TOLD), "told")
    path, same = scratch_path(spark, "llm", "pairs-told"), Window.partitionBy("level", "history", "word")
    # A word of one bucket is told where its parts or a hot history's sums need it.
    (counted.where("bucket >= 0").select("bucket", "level", "history", "lower", "word", F.sum("c").over(same).alias("c"),
                                         (F.min("bucket").over(same) == F.col("bucket")).cast("byte").alias("owner"),
                                         F.count("*").over(same).alias("n"))
     .where("n > 1 OR level > 1 OR lower = 1").drop("n").repartition("bucket").write.partitionBy("bucket").parquet(path))
    summed = spark.read.schema("level long, history long, lower long, word long, c long, owner byte, bucket int").parquet(path)
    pair_few = {level: {} for level in hots}
    for r in (counted.where("bucket < 0").select("level", F.col("word").alias("c"), F.col("c").alias("n"))
              .unionByName(summed.where(f"owner = 1 AND level > 1 AND c BETWEEN 1 AND {GT_MOST + 1}").select("level", "c", F.lit(1).cast("long").alias("n")))
              .groupBy("level", "c").agg(F.sum("n").alias("n")).collect()):
        pair_few[r.level][r.c] = int(r.n)
    model = {"words": Unigrams(total, kinds, few), "path": path, "hot": hots, "order": order, "left": {},
             "discount": {level: discounts(n, LEAST) for level, n in pair_few.items()}}
    for level in range(2, order + 1):
        found = {}
        if hots[level]:
            ids = spark.range(0, buckets, 1, buckets)
            sums = ids.mapInArrow(_hot_sums(share(spark, model), level), "history long, mass double, p double")
            found = {r.history: (r.mass, r.p) for r in sums.groupBy("history").agg(F.sum("mass").alias("mass"), F.sum("p").alias("p")).collect()}
        model["left"][level] = {h: (*found.get(h, (0.0, 0.0)), n) for h, n in hots[level].items()}
    model = share(spark, model)
    # A pack's documents meet again: few rows, each with the sums of many.
    parts = blocks.mapInArrow(_score(model), "pack long, sums binary, counts binary").repartition("pack")
    scored = parts.mapInArrow(_gather, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
