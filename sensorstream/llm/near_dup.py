"""Near-duplicate documents: MinHash, banding, verification, components.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes),
   128 universal-hash minima over it, and a 128-bit key of the whole set.
   Documents with the same set form a class at once; only the class's
   smallest document goes on.
2. Four minima make a band, 32 bands a document: two sets with similarity
   0.75 share no band with probability 5e-6.
3. A band bucket is never expanded into all pairs.  Its members are compared
   with its smallest member, and links join them into components.  Members
   that are connected need no further comparison.  The members of buckets that
   still hold several components are compared through an exact prefix filter
   on their rarest shingles, so no link between unconnected members is lost.
4. A pair whose signatures agree in under 57 % of the minima is dropped (4.7
   standard deviations below 0.75); the rest is confirmed on full sets.
5. Large-star and small-star connect the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._scratch import bounded, settle
from ._text import mix, random_words, scan, signed
from .components import connected_components

SHINGLE = 5
BANDS, BAND_ROWS = 32, 4
MINIMA = BANDS * BAND_ROWS
#: Least share of agreeing minima for a pair to be confirmed on its full sets.
SIGNATURE_SHARE = 0.57

_SKETCH = "doc_id long, n_shingles long, key_hi long, key_lo long, bands array<long>, minima binary"
_PIECE = 1 << 15


def shingle_sets(words) -> Iterator[np.ndarray]:
    """Distinct shingle hashes (sorted) of each text of a slice.

    A text with fewer than five words has its whole sequence as its one
    shingle; one without words has none.
    """
    runs = words.runs(SHINGLE)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        n = int(b - a)
        if n >= SHINGLE:
            yield np.unique(runs[a:b - SHINGLE + 1])
        elif n:
            h = np.uint64(n)
            for x in words.hash[a:b]:
                h = mix(np.array([h ^ x], dtype=np.uint64) + np.uint64(0x51ED270B))[0]
            yield np.array([h], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of each universal hash (multiply-shift) over each non-empty set.

    Sets are laid back to back and cut into pieces of bounded length, so a
    very long text needs no more memory than a short one.
    """
    out = np.full((len(sets), MINIMA), np.iinfo(np.uint64).max, dtype=np.uint64)
    group: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        if not group:
            return
        rows = np.array([g for g, _ in group])
        x = np.concatenate([p for _, p in group])
        at = np.cumsum([0, *(len(p) for _, p in group[:-1])])
        buffer = np.empty_like(x)
        for k in range(MINIMA):
            np.multiply(x, a[k], out=buffer)
            np.add(buffer, b[k], out=buffer)
            np.minimum.at(out[:, k], rows, np.minimum.reduceat(buffer, at))
        group.clear()

    for i, s in enumerate(sets):
        for lo in range(0, len(s), _PIECE):
            part = s[lo:lo + _PIECE]
            group.append((i, part))
            held += len(part)
            if held >= _PIECE:
                flush()
                held = 0
    flush()
    return (out >> np.uint64(32)).astype(np.uint32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = random_words(MINIMA, 101) | np.uint64(1), random_words(MINIMA, 202)
    salt = random_words(MINIMA, 303).reshape(BANDS, BAND_ROWS) | np.uint64(1)
    names = random_words(BANDS, 404)
    for batch in batches:
        ids, row = batch.column(0), 0
        for words in scan(batch.column(1), lower=True):
            sets = list(shingle_sets(words))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            minima = _minima(sets, a, b)
            grouped = minima.astype(np.uint64).reshape(len(sets), BANDS, BAND_ROWS)
            bands = signed(mix((mix(grouped * salt) * salt).sum(axis=2, dtype=np.uint64) + names))
            keys = np.array([list(divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64)) for s in sets],
                            dtype=np.uint64).reshape(len(sets), 2)
            offsets = np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.slice(row, len(sets)), pa.array(n), pa.array(signed(keys[:, 0].copy())),
                pa.array(signed(keys[:, 1].copy())),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel())),
                pa.array([m.tobytes() for m in minima], type=pa.binary()),
            ], names=["doc_id", "n_shingles", "key_hi", "key_lo", "bands", "minima"])
            row += len(sets)


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key_hi, key_lo, bands, minima`` of each document."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sketch, _SKETCH)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, row = batch.column(0), 0
        for words in scan(batch.column(1), lower=True):
            sets = [s.tobytes() for s in shingle_sets(words)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, len(sets)), pa.array(sets, type=pa.binary())], names=["doc_id", "shingles"])
            row += len(sets)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        one = [np.frombuffer(x, dtype=np.uint32) for x in batch.column(2).to_pylist()]
        two = [np.frombuffer(x, dtype=np.uint32) for x in batch.column(3).to_pylist()]
        if one:
            share = (np.stack(one) == np.stack(two)).mean(axis=1)
            yield batch.filter(pa.array(share >= SIGNATURE_SHARE)).select([0, 1])


def _linked(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose full sets are similar enough."""
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                least, most = sorted((len(x), len(y)))
                if 100 * least < percent * most:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, type=pa.bool_())).select([0, 1])
    return confirm


def _confirmed(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``(u, v)`` that are links."""
    ends = settle(pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct(), "ends")
    minima = settle(sketches.select("doc_id", "minima").join(bounded(ends), "doc_id", "left_semi"), "minima")
    seen = (pairs.join(minima.select(F.col("doc_id").alias("u"), F.col("minima").alias("mu")), "u")
            .join(minima.select(F.col("doc_id").alias("v"), F.col("minima").alias("mv")), "v")
            .select("u", "v", "mu", "mv").mapInArrow(_agreeing, "u long, v long"))
    seen = settle(seen, "agreeing")
    wanted = settle(seen.select(F.col("u").alias("doc_id")).union(seen.select("v")).distinct(), "wanted")
    sets = (docs.join(bounded(wanted), "doc_id", "left_semi").select("doc_id", "text")
            .mapInArrow(_full_sets, "doc_id long, shingles binary"))
    sets = settle(sets, "sets")
    return (seen.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su")), "u")
            .join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv")), "v")
            .select("u", "v", "su", "sv").mapInArrow(_linked(percent), "u long, v long"))


def _with_component(members: DataFrame, links: DataFrame) -> DataFrame:
    found = connected_components(links).select(F.col("node").alias("doc_id"), "component")
    return members.join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, row = batch.column(0).to_numpy(), 0
        for words in scan(batch.column(1), lower=True):
            sets = list(shingle_sets(words))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids[row:row + len(sets)], n)), pa.array(signed(np.concatenate(sets)))],
                names=["doc_id", "shingle"])
            row += len(sets)


def _prefix_pairs(open_docs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can still be links: an exact filter.

    With shingles ordered from rare to frequent, two sets of the asked
    similarity share a shingle among their first ``n - ceil(percent * n / 100)
    + 1``.  Copies edited in different places have their own shingles there,
    so they make no pair unless they are close.  A frequent shingle is not
    expanded into all pairs: only documents outside the component that holds
    most of its documents are paired.
    """
    rows = settle(docs.join(bounded(open_docs), "doc_id", "left_semi").select("doc_id", "text")
                  .mapInArrow(_shingle_rows, "doc_id long, shingle long"), "shingles")
    often = rows.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    sizes = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    # Shingles of one document only come first and make no pair: places of the
    # others follow them.
    order = Window.partitionBy("doc_id").orderBy("often", "shingle")
    shared = rows.join(often, "shingle").withColumn("k", F.row_number().over(order)).withColumn(
        "m", F.count("*").over(Window.partitionBy("doc_id")))
    first = (shared.join(sizes, "doc_id").withColumn("place", F.expr("n - m + k"))
             .where(F.expr(f"place <= n - ceil({percent} * n / 100.0) + 1"))
             .join(open_docs, "doc_id").select("shingle", "doc_id", "component", "n", "place"))
    first = settle(first, "prefixes")
    parts = first.groupBy("shingle", "component").agg(F.count("*").alias("held"))
    main = (parts.groupBy("shingle").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("held", "component"))
                                         .alias("main")).where("parts > 1").select("shingle", "main"))
    outside = first.join(main, "shingle").where("component <> main").drop("main")
    every = first.select("shingle", F.col("doc_id").alias("other"), F.col("component").alias("theirs"), F.col("n").alias("m"),
                         F.col("place").alias("spot"))
    # What may still follow a common shingle bounds the whole intersection.
    reach = F.expr(f"1 + least(n - place, m - spot) >= ceil({percent} * (n + m) / ({percent} + 100.0))")
    return (outside.join(every, "shingle")
            .where(F.col("component") != F.col("theirs"))
            .where(reach)
            .select(F.least("doc_id", "other").alias("u"), F.greatest("doc_id", "other").alias("v")).distinct())


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents link where ``100 * intersection >= percent * union`` of their
    shingle sets; a component is what links reach; its smallest document is
    kept.  A text that is null or without words has the empty set, links with
    nothing and is kept.  Rows with the same ``doc_id`` are one document of
    several texts: they share a component.  A row with a null ``doc_id`` takes
    part as no document: its component is null and it is kept.  Columns other
    than ``doc_id`` and ``text`` are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = settle(sketch(docs), "sketches")
    named = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("key_hi", "key_lo").agg(F.min("doc_id").alias("rep"))
    member = settle(named.select("doc_id", "key_hi", "key_lo").join(classes, ["key_hi", "key_lo"])
                    .select("doc_id", "key_hi", "key_lo", "rep"), "classes")
    # Of a class only its smallest document goes on.
    others = member.where("doc_id <> rep").select("doc_id", "key_hi", "key_lo")
    banded = (named.select("doc_id", "key_hi", "key_lo", "bands").join(others, ["doc_id", "key_hi", "key_lo"], "left_anti")
              .select("doc_id", F.explode(F.array_distinct("bands")).alias("band")))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).where("n > 1")
    members = settle(banded.join(buckets, "band").select("band", "doc_id", "low"), "buckets")
    same = member.where("doc_id <> rep").select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))
    rep_docs = docs.where("doc_id IS NOT NULL")

    tried = settle(members.where("doc_id <> low").select(F.col("low").alias("u"), F.col("doc_id").alias("v"))
                   .distinct(), "pairs")
    links = settle(_confirmed(tried, named, rep_docs, percent), "links")
    placed = settle(_with_component(members.select("band", "doc_id"), links), "placed")
    mixed = (placed.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .where("a <> b").select("band"))
    open_docs = settle(placed.join(mixed, "band").select("doc_id", "component").distinct(), "open")
    rest = _prefix_pairs(open_docs, rep_docs, percent).join(tried, ["u", "v"], "left_anti")
    links = links.unionByName(settle(_confirmed(settle(rest, "pairs"), named, rep_docs, percent), "links"))
    # Documents of a class hang on its first one, which hangs on its component.
    found = connected_components(links.unionByName(same))
    sized = sketches.select("doc_id", "n_shingles")
    return (sized.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
