"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``VNODES`` virtual nodes on a ring of ``CELLS`` cells.  A
document's cell is a hash of its id and text; it belongs to the shard of the
next virtual node clockwise.  A shard holds at most its share of the rows
(the whole number above or below the mean, so that the shares make up all
rows); documents that overflow a full shard continue clockwise to the next
node of a shard with room.

Documents of a cell are alike to the ring, so the walk needs only the number
of rows in each cell: a table of at most ``CELLS`` rows, whatever the input.
It yields, for each cell, which ranks go to which shard from which slot on.
Ranks within a cell come from counts of like rows by input partition: a running
sum over those gives each count its first rank, and the rows behind a count are
numbered among themselves.  So rows of one id and text, a third of all or not,
never meet in one task.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._scratch import settle

CELL_BITS = 13
CELLS = 1 << CELL_BITS
VNODES = 64
#: Bytes a row takes besides its text.
ROW_BYTES = 16


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(cell, shard)`` of each virtual node, clockwise.

    A node's place depends on its own name alone, so another shard moves
    nothing but what falls to its nodes.  Nodes on one cell stand in the order
    of a second hash.
    """
    nodes = []
    for shard in range(shards):
        for k in range(vnodes):
            name = f"shard-{shard}/node-{k}".encode()
            place = zlib.crc32(name, 0x5EED) * 0x9E3779B1 & 0xFFFFFFFF
            nodes.append((place >> 32 - CELL_BITS, zlib.crc32(name), shard))
    return [(cell, shard) for cell, _, shard in sorted(nodes)]


def walk(counts: dict[int, int], shards: int, vnodes: int = VNODES) -> list[dict]:
    """Segments ``cell, lo, hi, shard, slot``: ranks ``lo:hi`` of a cell go to
    a shard, the first of them to ``slot``."""
    nodes = ring(shards, vnodes)
    cells = [cell for cell, _ in nodes]
    total = sum(counts.values())
    # Shares differ by one; the extra rows go to the first shards.
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    filled: dict[int, int] = defaultdict(int)
    placed: dict[int, int] = defaultdict(int)          # ranks of a cell that have a place
    waiting = defaultdict(list)
    for cell in sorted(counts):
        waiting[bisect_left(cells, cell) % len(nodes)].append(cell)
    out = []
    open_nodes = len(nodes)
    # What one node's shard cannot hold moves on to the next node with room.
    at = 0
    while waiting:
        if at in waiting:
            shard, over = nodes[at][1], []
            for cell in waiting.pop(at):
                n = min(counts[cell] - placed[cell], room[shard] - filled[shard])
                if n:
                    out.append({"cell": cell, "lo": placed[cell], "hi": placed[cell] + n,
                                "shard": shard, "slot": filled[shard]})
                    filled[shard] += n
                    placed[cell] += n
                if placed[cell] < counts[cell]:
                    over.append(cell)
            if over:
                after = (at + 1) % open_nodes
                waiting[after] = over + waiting.get(after, [])
        at = (at + 1) % open_nodes
    return out


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_rank``, their place in their cell by hash, id, size and
    checksum, like rows by input partition."""
    like = ["_cell", "_hash", "doc_id", "size", "text_crc32", "_part"]
    before = Window.partitionBy("_cell").orderBy(*like[1:]).rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*like).agg(F.count("*").alias("_n"))
              .select(*(F.col(c).alias(f"_{c}_") for c in like), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in like]
    number = F.row_number().over(Window.partitionBy(*like).orderBy("_row")) - 1
    return (rows.withColumn("_no", number).join(starts, same).withColumn("_rank", F.col("_start") + F.col("_no"))
            .drop("_no", "_start", *(f"_{c}_" for c in like)))


def ring_shards(docs: DataFrame, shards: int, vnodes: int = VNODES, carry: bool = True) -> DataFrame:
    """``docs`` with ``size, text_crc32, law, shard, slot`` per row.

    Shards hold as many rows as each other, give or take one (law ``rows``),
    and slots of a shard run from 0 without gaps.  ``size`` is the text's
    UTF-8 bytes plus 16; a null text has none and the checksum 0.  Rows are
    placed by a hash of id and text, then by id, size and checksum, so reruns
    agree; repeated rows tie and get places next to each other.  With fewer
    rows than shards, some shards stay empty.  ``carry=False`` returns only
    ``doc_id`` beside the result.  Columns named like the results are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("size", "text_crc32", "law", "shard", "slot")
    text = F.col("text").cast("string").cast("binary")
    rows = (docs.withColumn("size", (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long"))
            .withColumn("text_crc32", F.coalesce(F.crc32(text), F.lit(0)).cast("long")))
    if not carry:
        rows = rows.select("doc_id", "size", "text_crc32")
    hashed = F.xxhash64(F.col("doc_id").cast("string"), "text_crc32")
    rows = rows.withColumn("_hash", hashed).withColumn(
        "_cell", F.shiftrightunsigned(F.col("_hash"), 64 - CELL_BITS).cast("int"))
    rows = settle(rows.withColumn("_row", F.monotonically_increasing_id())
                  .withColumn("_part", F.shiftright("_row", 33).cast("int")), "rows")
    counts = {r["_cell"]: r["n"] for r in rows.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
    plan = json.dumps(walk(counts, shards, vnodes))
    segments = (spark.range(1).select(F.inline(F.from_json(
        F.lit(plan), "array<struct<cell:int,lo:long,hi:long,shard:int,slot:long>>"))))
    ranked = _ranked(rows)
    # At most CELLS + shards * vnodes segments.
    placed = ranked.join(F.broadcast(segments), (F.col("_cell") == F.col("cell")) & (F.col("_rank") >= F.col("lo")) &
                         (F.col("_rank") < F.col("hi")))
    return (placed.withColumn("law", F.lit("rows")).withColumn("slot", F.col("slot") + F.col("_rank") - F.col("lo"))
            .drop("_hash", "_cell", "_rank", "_row", "_part", "cell", "lo", "hi"))
