"""Fill-in-middle: a text's parts exchanged in place by block rotation.

A text is cut in two places into prefix, middle and suffix.  The cuts are
found by a scan over the bytes that counts units (runs of ASCII letters, or
single other characters), chunk by chunk.  Sentinels are inserted into a
bytearray, ``<P>prefix<M>middle<S>suffix``, and two neighbouring blocks of it
change places by three reversals: ``reverse(reverse(A) + reverse(B))`` is
``B + A``.  ``psm`` exchanges middle and suffix, ``spm`` the suffix with all
before it.  The inverse rotation and the removal of the sentinels give the
text back, byte for byte.

Reversals swap chunks from both ends, so a document needs its own bytes and a
fixed number of chunks, however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import string_buffers

#: Marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 texts, so many are rearranged, and so many of those as ``spm``.
RATE, SPM_RATE = 90, 20
#: Bytes worked on at once.
CHUNK = 1 << 20
#: Bytes of texts in one batch of results.
BATCH_BYTES = 4 << 20

RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")
_ADDED = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
          T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
          T.StructField("output", T.StringType())]

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _heads(text: np.ndarray) -> np.ndarray:
    """Which bytes begin a character."""
    return (text & 0xC0) != 0x80


def _unit_starts(text: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Which bytes of ``text[lo:hi]`` begin a unit."""
    letter = _LETTER[text[max(lo - 1, 0):hi]]
    goes_on = letter[1:] & letter[:-1]
    return _heads(text[lo:hi]) & ~(goes_on if lo else np.concatenate([[False], goes_on]))


def characters(text: np.ndarray) -> int:
    return sum(int(np.count_nonzero(_heads(text[at:at + CHUNK]))) for at in range(0, len(text), CHUNK))


class Units:
    """Units of one text: their number, and where each begins."""

    def __init__(self, text: np.ndarray):
        self.text = text
        counts = [int(np.count_nonzero(_unit_starts(text, at, min(at + CHUNK, len(text)))))
                  for at in range(0, len(text), CHUNK)]
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.n = int(self.before[-1])

    def start(self, unit: int) -> int:
        """The byte at which a unit begins; the text's length for unit ``n``."""
        if unit >= self.n:
            return len(self.text)
        chunk = int(np.searchsorted(self.before, unit, side="right")) - 1
        at = chunk * CHUNK
        inside = np.flatnonzero(_unit_starts(self.text, at, min(at + CHUNK, len(self.text))))
        return at + int(inside[unit - int(self.before[chunk])])


def reverse(view: np.ndarray) -> None:
    """Reverse in place, a chunk from each end at a time."""
    lo, hi = 0, len(view)
    while hi - lo > 1:
        k = min(CHUNK, (hi - lo) // 2)
        head = view[lo:lo + k].copy()
        view[lo:lo + k] = view[hi - k:hi][::-1]
        view[hi - k:hi] = head[::-1]
        lo, hi = lo + k, hi - k


def rotate(buffer: bytearray, lo: int, at: int) -> None:
    """Exchange ``buffer[lo:at]`` with ``buffer[at:]`` by three reversals."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    reverse(view[lo:at])
    reverse(view[at:])
    reverse(view[lo:])


def arrange(buffer: bytearray, a: int, b: int, form: str, marks: tuple[bytes, ...]) -> None:
    """Insert the sentinels at the cuts and exchange the blocks of ``form``."""
    prefix, suffix, middle = marks
    buffer[b:b] = suffix
    buffer[a:a] = middle
    buffer[0:0] = prefix
    first = a + len(prefix)
    rotate(buffer, first if form == "psm" else 0, b + len(prefix) + len(middle))


def undo(buffer: bytearray, form: str, marks: tuple[bytes, ...]) -> None:
    """The inverse rotation; sentinels out."""
    prefix, suffix, middle = marks
    if form == "psm":
        first, last = buffer.find(suffix), buffer.find(middle)
    else:
        first, last = 0, buffer.find(prefix)
    moved = last - first                     # the suffix with its mark
    rotate(buffer, first, last)
    end = len(buffer) - moved
    m = first if form == "psm" else buffer.find(middle)
    del buffer[end:end + len(suffix)]
    del buffer[m:m + len(middle)]
    del buffer[:len(prefix)]


def _marks(sentinels: tuple[str, str, str]) -> tuple[bytes, ...]:
    """As bytes; marks that a text's end and another mark could form are refused."""
    first = {s[:1] for s in sentinels}
    if len(set(sentinels)) < 3 or "" in sentinels or any(c in first for s in sentinels for c in s[1:]):
        raise ValueError("three different sentinels are needed, none with a first character inside another")
    return tuple(s.encode() for s in sentinels)


def _texts(values: list[bytearray]) -> pa.Array:
    """UTF-8 as it is, invalid bytes too."""
    return pa.array(values, type=pa.binary()).cast(pa.string(), safe=False)


def _batch(schema: pa.Schema, kept: list[pa.Array], added: dict[str, list], row: int) -> pa.RecordBatch:
    n = len(next(iter(added.values())))
    made = [_texts(v) if k in ("output", "restored") else pa.array(v, type=schema.field(k).type) for k, v in added.items()]
    return pa.RecordBatch.from_arrays([c.slice(row, n) for c in kept] + made, schema=schema)


def _transformer(marks: tuple[bytes, ...], rate: int, spm_rate: int) -> Callable:
    """Columns in: the text, the four draws, then those to carry."""
    def one(text: np.ndarray, draws: list[int]) -> tuple:
        units = Units(text)
        buffer = bytearray(text)
        if not units.n or draws[2] % 100 >= rate or any(m in buffer for m in marks):
            return units.n, "plain", None, None, buffer
        form = "spm" if draws[3] % 100 < spm_rate else "psm"
        a, b = (units.start(u) for u in sorted(d % (units.n + 1) for d in draws[:2]))
        arrange(buffer, a, b, form, marks)
        return units.n, form, characters(text[:a]), characters(text[a:b]), buffer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = string_buffers(batch.column(0))
            draws = [batch.column(k).to_pylist() for k in range(1, 5)]
            kept = batch.columns[5:]
            schema = pa.schema([*list(batch.schema)[5:], ("n", pa.int64()), ("form", pa.string()),
                                ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
            done, held = [], 0
            for i in range(batch.num_rows):
                text = data[offsets[i]:offsets[i + 1]]
                done.append(one(text, [d[i] for d in draws]))
                held += len(text)
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    added = dict(zip(RESULTS, map(list, zip(*done)), strict=True))
                    yield _batch(schema, kept, added, i + 1 - len(done))
                    done, held = [], 0
    return run


def _others(rows: DataFrame, taken: tuple[str, ...]) -> list[str]:
    return [c for c in rows.columns if c.lower() not in taken]


def _carried(rows: DataFrame, columns: list[str]) -> Column:
    return F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in columns)).alias("_row")


def fill_in_middle(docs: DataFrame, sentinels: tuple[str, str, str] = SENTINELS, rate: int = RATE,
                   spm_rate: int = SPM_RATE, seed: str = "1", carry: bool = True) -> DataFrame:
    """``docs`` with ``n, form, prefix_chars, middle_chars, output`` per row.

    ``n`` counts units, ``form`` is ``plain``, ``psm`` or ``spm``, ``output``
    the arranged text.  Draws come from the SHA-256 of ``seed:doc_id``, so
    reruns agree and repeated rows get the same; a null id counts as no text
    there.  A null or empty text, and one that holds a sentinel, stays plain: its
    output is the text itself, and the part lengths are null.  ``carry=False``
    returns only ``doc_id`` beside the results.  Columns named like the results
    are replaced, whatever their case.
    """
    marks = _marks(sentinels)
    columns = _others(docs, RESULTS) if carry else ["doc_id"]
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(hashed, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col("text").cast("string").alias("text"), *draws, _carried(docs, columns))
    schema = T.StructType([rows.schema["_row"], *_ADDED])
    made = rows.mapInArrow(_transformer(marks, rate, spm_rate), schema)
    return made.select(*(F.col("_row")[c].alias(c) for c in columns), *RESULTS)


def _restorer(marks: tuple[bytes, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = string_buffers(batch.column(0))
            forms = batch.column(1).to_pylist()
            schema = pa.schema([batch.schema.field(2), ("restored", pa.string())])
            done, held = [], 0
            for i, form in enumerate(forms):
                buffer = bytearray(data[offsets[i]:offsets[i + 1]])
                if form in ("psm", "spm"):
                    undo(buffer, form, marks)
                done.append(buffer)
                held += len(buffer)
                if held >= BATCH_BYTES or i + 1 == len(forms):
                    yield _batch(schema, [batch.column(2)], {"restored": done}, i + 1 - len(done))
                    done, held = [], 0
    return run


def restore(made: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """The rows of :func:`fill_in_middle` with ``restored``, the text before
    it, in place of ``output``; a null text comes back empty."""
    columns = _others(made, ("output", "restored"))
    rows = made.select("output", "form", _carried(made, columns))
    schema = T.StructType([rows.schema["_row"], T.StructField("restored", T.StringType())])
    back = rows.mapInArrow(_restorer(_marks(sentinels)), schema)
    return back.select(*(F.col("_row")[c].alias(c) for c in columns), "restored")
