"""Exact deduplication by an index of live digests in cuckoo filters.

Texts are equal when their SHA-256 digests are.  Digests are dealt to shards by
their last bytes.  A shard's index is a cuckoo filter: 16-bit fingerprints in
buckets of four, each digest at home in two buckets, entries moved on to their
other bucket to make room.  Beside each fingerprint stands the place of its
stored key, the whole digest with the row to keep and the number of copies; a
fingerprint that hits is verified against that key.  If no room can be made,
the filter is doubled and refilled from the stored keys.

A run has two passes of the same index.  In every input partition copies meet
first, so one digest held by a third of all rows reaches its shard as one
record a partition.  The shards then settle which row of each digest stays.
Decisions go back to the rows by digest: those of the few digests that hold
more than one row in ``HEAVY`` are broadcast (at most ``HEAVY`` digests), the
others are joined.

The index can be kept as a table, one row a shard, and updated with added and
removed documents.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import partitions, settle

SLOTS = 4
KICKS = 500
DIGEST_BYTES = 32
#: Digests that a shard is made for; it may hold more.
SHARD_KEYS = 1 << 17
#: Digests that an input partition's index holds before it passes them on.
LOCAL_KEYS = 1 << 17
#: A digest with more than one in so many of all rows is broadcast.
HEAVY = 1000
_MIX = 0x9E3779B1


class CuckooIndex:
    """Digests with the row to keep and a number of copies each."""

    def __init__(self, buckets: int = 64):
        self.entries: list[list] = []            # [keep, copies] of each stored key
        self.keys = bytearray()
        self.free: list[int] = []
        self.live = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * SLOTS * buckets))      # 0: free
        self.places = array("i", bytes(4 * SLOTS * buckets))
        self.turn = 0

    def __len__(self) -> int:
        return self.live

    @property
    def buckets(self) -> int:
        return self.mask + 1

    def key(self, place: int) -> bytes:
        return bytes(self.keys[place * DIGEST_BYTES:(place + 1) * DIGEST_BYTES])

    def _home(self, digest: bytes) -> tuple[int, int]:
        """Fingerprint and first bucket."""
        return int.from_bytes(digest[:2], "little") or 1, int.from_bytes(digest[2:8], "little") & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * _MIX & self.mask)

    def _find(self, digest: bytes) -> int:
        """The slot of a digest, or -1."""
        mark, bucket = self._home(digest)
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.key(self.places[slot]) == digest:
                    return slot
        return -1

    def get(self, digest: bytes) -> list | None:
        slot = self._find(digest)
        return None if slot < 0 else self.entries[self.places[slot]]

    def insert(self, digest: bytes, keep, copies: int = 1) -> None:
        """Add copies; of all rows to keep the greatest stays."""
        entry = self.get(digest)
        if entry is not None:
            entry[0] = max(entry[0], keep)
            entry[1] += copies
            return
        if self.free:
            place = self.free.pop()
            self.keys[place * DIGEST_BYTES:(place + 1) * DIGEST_BYTES] = digest
            self.entries[place] = [keep, copies]
        else:
            place = len(self.entries)
            self.keys += digest
            self.entries.append([keep, copies])
        self.live += 1
        if not self._place(digest, place):
            self._grow()

    def remove(self, digest: bytes, copies: int, keep) -> None:
        """Take copies away; ``keep`` is the row to keep of those that are left.

        With none left the digest is deleted.  An unknown digest changes nothing.
        """
        slot = self._find(digest)
        if slot < 0:
            return
        place = self.places[slot]
        entry = self.entries[place]
        entry[1] -= copies
        if entry[1] > 0 and keep is not None:
            entry[0] = keep
            return
        self.prints[slot] = 0
        self.entries[place] = None
        self.free.append(place)
        self.live -= 1

    def _place(self, digest: bytes, place: int) -> bool:
        """Find a slot for a stored key, moving others; False if none was found.

        Then one stored key, not always this one, is without a slot.
        """
        mark, bucket = self._home(digest)
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.places[slot] = mark, place
                    return True
        for _ in range(KICKS):
            self.turn = (self.turn * 5 + 3) & 0xFFFF
            slot = bucket * SLOTS + (self.turn >> 7) % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            place, self.places[slot] = self.places[slot], place
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.places[slot] = mark, place
                    return True
        return False

    def _grow(self) -> None:
        """Double until all stored keys have a slot."""
        size = self.buckets
        while True:
            size *= 2
            self._clear(size)
            if all(self._place(self.key(i), i) for i, e in enumerate(self.entries) if e is not None):
                return

    def __iter__(self) -> Iterator[tuple[bytes, object, int]]:
        """``digest, keep, copies`` of each live digest."""
        for i, e in enumerate(self.entries):
            if e is not None:
                yield self.key(i), e[0], e[1]

    def stored(self) -> tuple[int, bytes, bytes, bytes, list, list[int]]:
        """Buckets, fingerprints, places, keys, rows to keep and copies, without gaps."""
        at, live = {}, []
        for i, e in enumerate(self.entries):
            if e is not None:
                at[i] = len(live)
                live.append(i)
        places = array("i", (at.get(p, 0) if m else 0 for m, p in zip(self.prints, self.places, strict=True)))
        return (self.buckets, self.prints.tobytes(), places.tobytes(), b"".join(map(self.key, live)),
                [self.entries[i][0] for i in live], [self.entries[i][1] for i in live])

    @classmethod
    def load(cls, buckets: int, prints: bytes, places: bytes, keys: bytes, keep: list, copies: list[int]) -> CuckooIndex:
        index = cls(buckets)
        index.prints, index.places = array("H", prints), array("i", places)
        index.keys, index.live = bytearray(keys), len(keep)
        index.entries = [list(e) for e in zip(keep, copies, strict=True)]
        return index


# A row to keep is (has an id, id, row): a null id is below all others, and the
# row number tells repeated rows apart.
_RECORD = "digest binary, has_id boolean, id long, row long, copies long"


def _records(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    found = list(index)
    for at in range(0, len(found), 10_000):
        part = found[at:at + 10_000]
        yield pa.RecordBatch.from_arrays([
            pa.array([d for d, *_ in part], pa.binary()), pa.array([k[0] for _, k, _ in part], pa.bool_()),
            pa.array([k[1] for _, k, _ in part], pa.int64()), pa.array([k[2] for _, k, _ in part], pa.int64()),
            pa.array([n for *_, n in part], pa.int64())], names=["digest", "has_id", "id", "row", "copies"])


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    digest, has_id, id_, row, copies = (batch.column(k).to_pylist() for k in range(5))
    return zip(digest, zip(has_id, id_, row, strict=True), copies, strict=True)


def _meet_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within an input partition; what a full index holds is passed on."""
    index = CuckooIndex()
    for batch in batches:
        for digest, keep, copies in _columns(batch):
            index.insert(digest, keep, copies)
            if len(index) >= LOCAL_KEYS:
                yield from _records(index)
                index = CuckooIndex()
    yield from _records(index)


def _meet_in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All copies of each digest; records come shard by shard."""
    index, now = CuckooIndex(), None
    for batch in batches:
        for shard, (digest, keep, copies) in zip(batch.column(5).to_pylist(), _columns(batch), strict=True):
            if shard != now:
                yield from _records(index)
                index, now = CuckooIndex(), shard
            index.insert(digest, keep, copies)
    yield from _records(index)


def _shard_of(shards: int) -> Column:
    """By the digest's last bytes, which the filter does not use."""
    return F.pmod(F.conv(F.substring(F.hex("digest"), -7, 7), 16, 10).cast("int"), F.lit(shards))


def _by_shard(records: DataFrame, shards: int, *order: str) -> DataFrame:
    n = max(partitions(records.sparkSession), shards)
    return records.repartition(n, "shard").sortWithinPartitions("shard", *order)


def shards_for(rows: int, least: int) -> int:
    return max(least, -(-rows // SHARD_KEYS))


def digests(docs: DataFrame) -> DataFrame:
    """``digest, has_id, id, row, copies`` of each row; a null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    id_ = F.col("doc_id").cast("long")
    return docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), id_.isNotNull().alias("has_id"),
                       F.coalesce(id_, F.lit(0)).alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.lit(1).cast("long").alias("copies"))


def live_digests(rows: DataFrame) -> DataFrame:
    """One record for each digest of :func:`digests`: the row to keep, all copies."""
    local = rows.mapInArrow(_meet_locally, _RECORD)
    shards = shards_for(rows.count(), partitions(rows.sparkSession))
    return _by_shard(local.withColumn("shard", _shard_of(shards)), shards).mapInArrow(_meet_in_shards, _RECORD)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal when identical; null counts as empty.  Of equal texts the
    row with the greatest id stays (null below all others, ``keep_id`` null if
    there is no other); of rows that share that id too, one stays.  An empty
    table has no rows.  Other columns are not read.
    """
    rows = settle(digests(docs), "digests")
    total = rows.count()
    found = settle(live_digests(rows), "live").where("copies > 1")
    repeated = found.select("digest", F.when(F.col("has_id"), F.col("id")).alias("keep_id"), F.col("row").alias("keep_row"),
                            F.col("copies").alias("group_size"))
    # Fewer than HEAVY digests can hold more than one row in HEAVY each.
    heavy = F.broadcast(repeated.where(F.col("group_size") * HEAVY > total))
    light = repeated.where(F.col("group_size") * HEAVY <= total)
    judged = rows.join(heavy, "digest").unionByName(
        rows.join(heavy, "digest", "left_anti").join(light, "digest", "left"))
    id_ = F.when(F.col("has_id"), F.col("id"))
    alone = F.col("keep_row").isNull()
    return judged.select(id_.alias("doc_id"), F.when(alone, id_).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"))


# -- a kept index ------------------------------------------------------------

_STATE = ("shard int, shards int, buckets long, prints binary, places binary, keys binary, has_ids array<boolean>, "
          "ids array<long>, rows array<long>, copies_of array<long>")
_NAMES = [f.split()[0] for f in _STATE.split(", ")]


def _state(shard: int, shards: int, index: CuckooIndex) -> pa.RecordBatch:
    buckets, prints, places, keys, keep, copies = index.stored()
    values = [shard, shards, buckets, prints, places, keys, *([k[i] for k in keep] for i in range(3)), copies]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.bool_()),
             *[pa.list_(pa.int64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=_NAMES)


def _apply(shards: int) -> Callable:
    """A shard's state, then what is removed, then what is added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, now = CuckooIndex(), None
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != now:
                    if now is not None:
                        yield _state(now, shards, index)
                    index, now = CuckooIndex(), r["shard"]
                if r["step"] == 0:
                    s = r["state"]
                    keep = list(zip(s["has_ids"], s["ids"], s["rows"], strict=True))
                    index = CuckooIndex.load(s["buckets"], s["prints"], s["places"], s["keys"], keep, s["copies_of"])
                else:
                    keep = None if r["row"] is None else (r["has_id"], r["id"], r["row"])
                    if r["step"] == 1:
                        index.remove(r["digest"], r["copies"], keep)
                    else:
                        index.insert(r["digest"], keep, r["copies"])
        if now is not None:
            yield _state(now, shards, index)
    return run


def _changes(records: DataFrame, shards: int, step: int) -> DataFrame:
    return records.select(_shard_of(shards).alias("shard"), F.lit(step).alias("step"), "digest", "has_id", "id", "row", "copies",
                          F.lit(None).cast(f"struct<{_STATE.replace(' ', ':').replace(',:', ',')}>").alias("state"))


def build_index(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """The index of :func:`digests` rows: one row a shard that holds any."""
    shards = shards or shards_for(rows.count(), partitions(rows.sparkSession))
    return _by_shard(_changes(rows.mapInArrow(_meet_locally, _RECORD), shards, 2), shards, "step").mapInArrow(_apply(shards), _STATE)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame, content: DataFrame) -> DataFrame:
    """The index after documents came and went.

    ``added`` and ``removed`` are rows as :func:`digests` makes them (a removed
    row with the row number it had); ``content`` holds the rows of before that
    are still there.  Where rows of a digest are removed and others are left,
    the greatest of those in ``content`` is the one to keep.  Digests without
    rows are deleted; removing what the index does not hold changes nothing.
    """
    first = index.select("shards").first()
    if first is None:
        return build_index(added)
    shards = first[0]
    gone = removed.mapInArrow(_meet_locally, _RECORD).groupBy("digest").agg(F.sum("copies").alias("copies"))
    left = (content.join(gone.select("digest"), "digest", "left_semi").groupBy("digest")
            .agg(F.max(F.struct("has_id", "id", "row")).alias("keep")))
    gone = gone.join(left, "digest", "left").select("digest", "keep.has_id", "keep.id", "keep.row", "copies")
    states = index.select("shard", F.lit(0).alias("step"), F.lit(None).cast("binary").alias("digest"),
                          F.lit(None).cast("boolean").alias("has_id"),
                          *(F.lit(None).cast("long").alias(c) for c in ("id", "row", "copies")),
                          F.struct(*_NAMES).alias("state"))
    came = _changes(added.mapInArrow(_meet_locally, _RECORD), shards, 2)
    return (_by_shard(states.unionByName(_changes(gone, shards, 1)).unionByName(came), shards, "step")
            .mapInArrow(_apply(shards), _STATE))


def index_entries(index: DataFrame) -> DataFrame:
    """``text_sha256, keep_id, copies`` of every live digest of an index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                keys = s["keys"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[at:at + DIGEST_BYTES].hex() for at in range(0, len(keys), DIGEST_BYTES)], pa.string()),
                    pa.array([i if h else None for h, i in zip(s["has_ids"], s["ids"], strict=True)], pa.int64()),
                    pa.array(s["copies_of"], pa.int64())], names=["text_sha256", "keep_id", "copies"])
    return index.mapInArrow(run, "text_sha256 string, keep_id long, copies long")
