"""Merkle manifest of a dataset: a hash tree over its rows, with a proof for each.

Rows of a group (a language) are ranked, and a rank's base-8 digits say where
the row stands in the group's binary tree.  The digit columns are grouped away
one after another, the lowest first: a group of up to eight nodes becomes one
struct that nests them and holds the hashes of the three binary levels between.
Three digits make a block of 512 rows, the largest group ever collected; one
shuffle by (group, block) serves all three groupings.  Roots of blocks are the
nodes of the next tier, until a group has one block.  The groups' roots make a
tree of their own in the same way.

On the way down, a block's row meets the path from its root upwards by a union
and one grouping; nested ``transform`` then adds each node's siblings to that
path, and ``explode`` emits the rows with their proofs.  No proof is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._scratch import bounded, partitions, settle

#: Binary levels in a digit, and digits in a block.
DIGIT_BITS, DIGITS = 3, 3
BLOCK_BITS = DIGIT_BITS * DIGITS
#: Columns of a row's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One binary level of a proof: ``sib`` is null where a node had none beside it.
PATH = "array<struct<sib:string,left:boolean,on:boolean>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """Hash of a row: each value as its UTF-8 length, a colon and itself, ``-`` for null."""
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return digest(F.concat(*map(written, fields)))


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``_pos``, a row's place among those of its group, and
    ``_n``, their number.  ``order`` begins with the group and leaves no ties.

    One range shuffle: no group is sorted in one task.  A part's rows are
    numbered as they stand; of each group in each part only the first number
    and the count are summed up.
    """
    spark = rows.sparkSession
    sorted_rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    placed = settle(sorted_rows.withColumn("_at", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright("_at", 33)), "ranked")
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
            .select(F.col(group).alias("_group"), F.col("_part").alias("_run"),
                    (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
                    F.sum("_rows").over(Window.partitionBy(group)).alias("_n")))
    # At most one row a part and one more a group.
    runs = bounded(settle(runs, "runs"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_run"))
    return (placed.join(runs, same).withColumn("_pos", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_group", "_run", "_shift"))


def levels_above(count: Column) -> Column:
    """Binary levels above ``count`` nodes."""
    return F.when(count > 1, F.length(F.bin(count - 1))).otherwise(0)


def _raised(hashes: Column) -> Column:
    """The next level: two consecutive hashes make one, a last one alone too."""
    pair = lambda i: digest(F.concat(F.get(hashes, 2 * i), F.coalesce(F.get(hashes, 2 * i + 1), F.lit(""))))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / 2).cast("int")), pair)


def _tier(nodes: DataFrame, group: str) -> DataFrame:
    """``group, _block, _left, hash, tree`` of each block of nodes.

    ``nodes`` have ``_pos``, ``_left`` (levels between them and the group's
    root), ``hash`` and ``item``.
    """
    digits = [f"_d{k}" for k in range(DIGITS)]
    radix = (1 << DIGIT_BITS) - 1
    rows = nodes.select(group, "_left", F.shiftright("_pos", BLOCK_BITS).alias("_block"), "hash", "item",
                        *(F.shiftright("_pos", DIGIT_BITS * k).bitwiseAND(radix).cast("int").alias(d)
                          for k, d in enumerate(digits)))
    rows = rows.repartition(partitions(nodes.sparkSession), group, "_block")
    for k, digit in enumerate(digits):
        kid = F.struct(F.col(digit).alias("digit"), "hash", "item")
        rows = (rows.groupBy(group, "_block", "_left", *digits[k + 1:])
                .agg(F.array_sort(F.collect_list(kid), lambda a, b: a["digit"] - b["digit"]).alias("kids")))
        rows = rows.withColumn("l0", F.col("kids")["hash"])
        for b in range(DIGIT_BITS):
            below = F.col(f"l{b}")
            rows = rows.withColumn(f"l{b + 1}", F.when(F.lit(DIGIT_BITS * k + b) < F.col("_left"), _raised(below)).otherwise(below))
        inner = F.struct(F.array(*(F.col(f"l{b}") for b in range(DIGIT_BITS))).alias("levels"), "kids")
        rows = rows.select(group, "_block", "_left", *digits[k + 1:],
                           F.get(F.col(f"l{DIGIT_BITS}"), F.lit(0)).alias("hash"), inner.alias("item"))
    return rows.withColumnRenamed("item", "tree")


def _tiers(nodes: DataFrame, group: str) -> list[DataFrame]:
    """Stored blocks of each tier; the last has one block a group."""
    tiers = []
    while True:
        tiers.append(settle(_tier(nodes, group), "tier"))
        if not tiers[-1].agg(F.max("_block")).first()[0]:
            return tiers
        above = F.greatest(F.col("_left") - BLOCK_BITS, F.lit(0))
        nodes = tiers[-1].select(group, F.col("_block").alias("_pos"), above.alias("_left"), "hash",
                                 F.struct(F.col("_block").alias("_below")).alias("item"))


def _nodes_of(tree: Column, path: Column, left: Column, k: int) -> Column:
    """``item, path`` of every node in a block; ``path`` goes on from its root."""
    def place(kid: Column, i: Column) -> Column:
        steps = F.array(*(F.struct(
            F.get(F.get(tree["levels"], F.lit(b)), F.shiftright(i, b).bitwiseXOR(F.lit(1))).alias("sib"),
            (F.shiftright(i, b).bitwiseAND(F.lit(1)) == 1).alias("left"),
            (F.lit(DIGIT_BITS * k + b) < left).alias("on")) for b in range(DIGIT_BITS)))
        whole = F.concat(F.filter(steps, lambda s: s["on"]), path)
        if k == 0:
            return F.struct(kid["item"].alias("item"), whole.alias("path"))
        return _nodes_of(kid["item"], whole, left, k - 1)
    found = F.transform(tree["kids"], place)
    return found if k == 0 else F.flatten(found)


def _down(tier: DataFrame, group: str, tops: DataFrame) -> DataFrame:
    """Each node of a tier: ``group``, the fields of its item, ``path, top``.

    ``tops`` has ``group, _block, path, top`` of each block of the tier.
    """
    tree_type, top_type = (tier.schema["tree"].dataType.simpleString(), tops.schema["top"].dataType.simpleString())
    blocks = tier.select(group, "_block", "_left", "tree", F.lit(None).cast(PATH).alias("path"),
                         F.lit(None).cast(top_type).alias("top"))
    paths = tops.select(group, "_block", F.lit(None).cast("int").alias("_left"), F.lit(None).cast(tree_type).alias("tree"),
                        "path", "top")
    met = blocks.unionByName(paths).groupBy(group, "_block").agg(
        F.max("_left").alias("_left"), *(F.first(c, ignorenulls=True).alias(c) for c in ("tree", "path", "top")))
    nodes = F.explode(_nodes_of(F.col("tree"), F.col("path"), F.col("_left"), DIGITS - 1))
    return met.select(group, nodes.alias("_node"), "top").select(group, "_node.item.*", "_node.path", "top")


def _all_down(tiers: list[DataFrame], group: str, tops: DataFrame) -> DataFrame:
    """Down all tiers; ``tops`` has ``group, path, top`` of each group's root."""
    tops = tops.withColumn("_block", F.lit(0).cast("long"))
    for tier in tiers[:0:-1]:
        tops = _down(tier, group, tops).withColumnRenamed("_below", "_block")
    return _down(tiers[0], group, tops)


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: Sequence[str] = FIELDS,
             extra: dict[str, Column] | None = None) -> DataFrame:
    """``order, group, leaf, path, subroot, root`` of every row of ``docs``.

    ``leaf`` hashes the row's ``fields``.  Leaves of a group stand by ``order``
    (null first; rows alike in it by their hash, and repeated rows, whose
    leaves are the same, in any order).  ``path`` lists the levels above the
    leaf up to ``root``: ``sib`` is the hash beside (null: none), ``left``
    whether it stands on the left.  ``subroot`` is the group's root; groups
    stand by name, null first.  A group of one row has its leaf as root, and
    an only group its root as the whole's.  An empty table has no rows.

    ``extra`` columns are kept with each row; other columns are not read, so no
    name of theirs matters.
    """
    extra = extra or {}
    made = docs.select(F.col(group).alias("_g"), F.col(order).alias("_o"), leaf(*(F.col(f"`{f}`") for f in fields)).alias("hash"),
                       F.struct(F.lit(0).alias("_"), *(v.alias(k) for k, v in extra.items())).alias("_extra"),
                       F.monotonically_increasing_id().alias("_row"))
    rows = ranked(settle(made, "leaves"), "_g", ("_g", "_o", "hash", "_row"))
    leaves = rows.select("_g", "_pos", levels_above(F.col("_n")).alias("_left"), "hash",
                         F.struct(F.col("_o"), F.col("hash").alias("leaf"), "_extra").alias("item"))
    tiers = _tiers(leaves, "_g")
    # The groups' roots are the leaves of one more tree.
    roots = ranked(settle(tiers[-1].select("_g", "hash", F.lit(0).alias("_all")), "roots"), "_all", ("_all", "_g"))
    upper = _tiers(roots.select("_all", "_pos", levels_above(F.col("_n")).alias("_left"), "hash",
                                F.struct("_g", F.col("hash").alias("subroot")).alias("item")), "_all")
    whole = upper[-1].select("_all", F.array().cast(PATH).alias("path"), F.col("hash").alias("top"))
    tops = _all_down(upper, "_all", whole).select(
        "_g", "path", F.struct("subroot", F.col("top").alias("root")).alias("top"))
    return _all_down(tiers, "_g", settle(tops, "tops")).select(
        F.col("_o").alias(order), F.col("_g").alias(group), "leaf", "path", "top.subroot", "top.root",
        *(F.col("_extra")[k].alias(k) for k in extra))


def proof_digest(path: Column) -> Column:
    """Hash of the siblings of a path, from the leaf upwards."""
    return digest(F.array_join(F.transform(path, lambda s: s["sib"]), ""))


def folded(hash_: Column, path: Column) -> Column:
    """The root that a leaf's hash and a path lead to."""
    def up(below: Column, step: Column) -> Column:
        beside = F.coalesce(step["sib"], F.lit(""))
        return digest(F.when(step["left"], F.concat(beside, below)).otherwise(F.concat(below, beside)))
    return F.aggregate(path, hash_, up)
