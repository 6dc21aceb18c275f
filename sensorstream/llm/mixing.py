"""Mixing sources to target weights by Pareto order sampling.

A source's words are to be taken ``target / size`` times.  The whole part of
that is certain: so many copies of every document.  The rest is a sample of
fixed size, in words: each document has the inclusion probability ``p`` of the
remaining fraction (equal within a source, unequal between them) and the rank

    (u / (1 - u)) / (p / (1 - p)),   u uniform from a hash of its id,

and documents are taken in order of rank until the next one does not fit.  What
is still missing is filled in the same way by the documents after it that are
at most half as large as what is missing, in rounds: each leaves less than half
of the words that were missing before it.  In the end the one document nearest
in size to the last missing words is taken too if that comes nearer to the
target.

Rows of one id and text tie.  They are counted as one group with a number of
rows; a group at a limit gives as many rows as fit.  Ranks are cut into
``CELLS`` cells a source: sums by cell are small and find the cell in which the
limit lies, and only that cell's groups are put in order.  So no source,
however large, is sorted in one task, and no group of repeated rows meets in one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._scratch import settle

#: Weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MOST = 3
CELLS = 4096
#: First hex digits of a digest that make the uniform number: 13 are 52 bits.
_DIGITS = 13


def word_count(text: str) -> str:
    """SQL: number of runs of characters other than blanks (null: 0)."""
    return f"coalesce(size(regexp_extract_all({text}, '[^ \\\\x09-\\\\x0D]+', 0)), 0)"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from one row a source.

    The total is shared by weight; a source is cut at ``most`` times its own
    size and the excess goes to the others by weight.  In order of
    ``most * size / weight`` the cut sources come first, so running sums find
    the level at which the others stand.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", pick).withColumn("cap", most * F.col("source_size").cast("double"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").isNull(), "source")
    rows = (rows.withColumn("total", F.sum("source_size").over(everything).cast("double"))
            .withColumn("cut", F.coalesce(F.sum("cap").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("left", F.sum("weight").over(before.rowsBetween(0, Window.unboundedFollowing))))
    # If this source and all later ones share what the earlier ones leave:
    rows = rows.withColumn("level", (F.col("total") - F.col("cut")) / F.col("left"))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return (rows.withColumn("open", level)
            .select("source", "source_size", F.least("cap", F.col("weight") * F.col("open")).alias("target")))


def _draw(docs: DataFrame, seed: str) -> DataFrame:
    """Size, text key and uniform number.

    Rows without an id differ by their text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit(":"), F.xxhash64("text").cast("string")))
    digest = F.md5(F.concat(F.lit(seed + ":"), name).cast("binary"))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")
    return (docs.withColumn("size", F.expr(word_count("text")).cast("long"))
            .withColumn("_u", (number + 0.5) / float(1 << 4 * _DIGITS))
            .withColumn("_key", F.xxhash64("text")))


def _rank() -> Column:
    """Random odds over inclusion odds; null where nothing is sampled."""
    return F.when(F.col("_p") > 1e-12, (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p"))))


def _by_source(rows: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """Left join of a one-row-a-source table, as stored: Spark knows its size
    and broadcasts it only if that is small."""
    table = settle(table, name).withColumnRenamed("source", "_source")
    return rows.join(table, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


_AT = "struct<rank:double,key:bigint>"


def _at() -> Column:
    return F.struct(F.col("_rank").alias("rank"), F.col("_key").alias("key"))


def _round(groups: DataFrame, state: DataFrame) -> DataFrame:
    """One pass in order of rank: ``source, _lo, _cap, _cut, _some, _gap``.

    ``groups`` are those that may be taken; ``state`` has for each source the
    missing words ``_gap``, and ``_lo`` and ``_cap`` as they come back.  Groups
    before ``_cut`` are taken whole (all of them if it is null), and ``_some``
    rows of the one at it; ``_gap`` is what is missing then.
    """
    found = _by_source(groups, state.select("source", "_gap"), "gap").withColumn("_words", F.col("size") * F.col("_rows"))
    cells = found.groupBy("source", "_cell").agg(F.sum("_words").alias("_words"), F.first("_gap").alias("_gap"))
    along = Window.partitionBy("source").orderBy("_cell")
    # The first cell whose sum passes what is wanted holds the limit.
    cells = settle(cells.withColumn("_upto", F.sum("_words").over(along)), "cells")
    edge = (cells.where("_upto > _gap").groupBy("source")
            .agg(F.min(F.struct("_cell", (F.col("_upto") - F.col("_words")).alias("_before"))).alias("_e"))
            .select("source", F.col("_e._cell").alias("_edge"), F.col("_e._before").alias("_before")))
    order = Window.partitionBy("source").orderBy("_rank", "_key")
    inside = (_by_source(found, edge, "edge").where("_cell = _edge")
              .withColumn("_run", F.col("_before") + F.sum("_words").over(order)).where("_run > _gap"))
    first = inside.groupBy("source").agg(F.min(F.struct(_at().alias("at"), "size", (F.col("_run") - F.col("_words")).alias("taken"))).alias("_f"))
    whole = cells.groupBy("source").agg(F.max("_upto").alias("_all"))
    ends = (whole.alias("w").join(first.alias("f"), F.expr("w.source <=> f.source"), "left")
            .select(F.col("w.source").alias("_s"), "_all", "_f"))
    some = F.floor((F.col("_gap") - F.col("_f.taken")) / F.col("_f.size")).cast("long")
    return (state.join(ends, F.col("source").eqNullSafe(F.col("_s")))
            .select("source", "_lo", "_cap", F.col("_f.at").alias("_cut"), F.coalesce(some, F.lit(0)).alias("_some"),
                    F.coalesce(F.col("_gap") - F.col("_f.taken") - some * F.col("_f.size"), F.col("_gap") - F.col("_all")).alias("_gap")))


def _after(groups: DataFrame, state: DataFrame) -> DataFrame:
    """Groups behind the limits, as large as ``_cap`` at most."""
    held = _by_source(groups, state.select("source", "_lo", F.col("_cap").alias("_most")), "limits")
    return held.where(F.col("_lo").isNotNull() & (_at() > F.col("_lo")) & (F.col("size") <= F.col("_most")) & (F.col("size") > 0)
                      ).drop("_lo", "_most")


def _row_limits(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """``source, _pick, _limit``: of the rows of a pick's group those with row
    numbers up to ``_limit`` are ``_some`` many.  Counts by input partition find
    the one in which that row lies; only its rows are numbered."""
    part = F.shiftright("_row", 33).alias("_part")
    members = (_by_source(rows, picks.groupBy("source").agg(F.collect_list(F.struct(F.col("_cut").alias("at"), "_some")).alias("_picks")), "picks")
               .withColumn("_mine", F.filter("_picks", lambda x: x["at"] == _at())).where("size(_mine) > 0")
               .select("source", _at().alias("_pick"), F.element_at("_mine", 1)["_some"].alias("_some"), part, "_row"))
    members = settle(members, "members")
    counts = members.groupBy("source", "_pick", "_part", "_some").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("source", "_pick").orderBy("_part"))
    at = (counts.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_some")) & (F.col("_upto") - F.col("_n") < F.col("_some")))
          .select(F.col("source").alias("_s"), F.col("_pick").alias("_p"), F.col("_part").alias("_q"),
                  (F.col("_some") - F.col("_upto") + F.col("_n")).alias("_nth")))
    number = F.row_number().over(Window.partitionBy("source", "_pick", "_part").orderBy("_row"))
    inside = members.join(settle(at, "at"), F.expr("source <=> _s AND _pick = _p AND _part = _q"))
    return inside.withColumn("_no", number).where("_no = _nth").select("source", "_pick", F.col("_row").alias("_limit"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST, seed: str = "mix", carry: bool = True) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken`` per row.

    ``size`` counts words (null or empty text: 0), ``copies`` how often the mix
    takes the document and ``taken`` the words that makes.  Null is a source of
    its own, the last.  A row's random number depends on its ``doc_id`` (a null
    one: its text) and ``seed`` alone, so reruns agree; of rows with the same id
    and text as many are taken as fit, which of them is all the same.  Documents
    without words are taken as often as their rank says and change no sum.  A
    source without words has target 0.  Extra columns stay; ``size``,
    ``source_size``, ``target``, ``copies`` and ``taken`` are replaced if they
    exist.  ``carry=False`` returns only ``doc_id`` and ``source`` beside the
    results.  Of the texts only those of groups at a limit are stored.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    keep = docs.columns if carry else ["doc_id", "source"]
    slim_rows = settle(_draw(docs, seed).select("doc_id", "source", "size", "_u", "_key"), "drawn")
    sizes = slim_rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    times = F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    shares = settle(targets(sizes, weights, most).withColumn("_times", times)
                    .withColumn("_whole", F.floor(F.col("_times") + 1e-12))
                    .withColumn("_p", F.greatest(F.col("_times") - F.col("_whole"), F.lit(0.0)))
                    .withColumn("_rest", F.greatest(F.col("target") - F.col("_whole") * F.col("source_size"), F.lit(0.0))),
                    "shares")
    slim = slim_rows.groupBy("source", "_u", "_key", "size").agg(F.count("*").alias("_rows"))
    groups = settle(_by_source(slim, shares.select("source", "_p"), "p").withColumn("_rank", _rank()).where("_rank IS NOT NULL")
                    # Ranks grow with u, so cells of equal width in u are in order.
                    .withColumn("_cell", F.floor(F.col("_u") * CELLS).cast("int")).drop("_p"), "groups")
    state = shares.where("_p > 1e-12").select("source", F.lit(None).cast(_AT).alias("_lo"), F.lit(None).cast("double").alias("_cap"),
                                              F.col("_rest").alias("_gap"))
    rounds, open_groups = [], groups
    while True:
        done = settle(_round(open_groups, state), "round")
        rounds.append(done)
        # Half of what is missing at most: the rest shrinks by half a round, so the rounds are few.
        state = done.where("_cut IS NOT NULL").select("source", F.col("_cut").alias("_lo"), (F.col("_gap") / 2).alias("_cap"), "_gap")
        open_groups = settle(_after(open_groups, state), "open")
        if open_groups.isEmpty():
            break
    passes = reduce(DataFrame.unionByName, rounds)
    rule = F.struct(F.col("_lo").alias("lo"), F.col("_cap").alias("cap"), F.col("_cut").alias("cut"))
    rules = settle(passes.groupBy("source").agg(F.collect_list(rule).alias("_rules"), F.min("_gap").alias("_gap"),
                                                F.min("_cut").alias("_first")), "rules")
    # One more document may close what is missing: the nearest in size from the first limit on
    # (a group at a limit has rows left).
    left = (_by_source(groups, rules, "left").where(F.col("_first").isNotNull() & (_at() >= F.col("_first")) & ~_taken())
            .withColumn("_off", F.abs(F.col("_gap") - F.col("size"))).where("_off < _gap"))
    close = (left.groupBy("source").agg(F.min(F.struct("_off", "_rank", "_key")).alias("_c"))
             .select("source", F.struct(F.col("_c._rank").alias("rank"), F.col("_c._key").alias("key")).alias("_cut"), F.lit(1).cast("long").alias("_some")))
    picks = settle(passes.where("_some > 0").select("source", "_cut", "_some").unionByName(close)
                   .groupBy("source", "_cut").agg(F.sum("_some").alias("_some")), "picks")
    at_limits = picks.groupBy("source").agg(F.collect_list("_cut").alias("_picks")).withColumnRenamed("source", "_s")
    plan = (shares.drop("_times", "_rest").join(rules.select(F.col("source").alias("_t"), "_rules"), F.col("source").eqNullSafe(F.col("_t")), "left")
            .join(at_limits, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "_t"))
    rows = _by_source(_draw(docs, seed) if carry else slim_rows, plan, "plan").withColumn("_rank", _rank())
    ranked = F.col("_rank").isNotNull()
    at_limit = F.coalesce(ranked & F.exists("_picks", lambda x: x == _at()), F.lit(False))
    whole = rows.where(~at_limit).withColumn("_chosen", ranked & _taken()).drop("_rules", "_picks")
    # Only here rows are numbered, so only these are stored.
    some = settle(rows.where(at_limit).drop("_rules", "_picks").withColumn("_row", F.monotonically_increasing_id()), "some")
    limits = settle(_row_limits(some.select("source", "_rank", "_key", "_row"), picks).withColumnRenamed("source", "_s"), "limits")
    some = (some.join(limits, F.col("source").eqNullSafe(F.col("_s")) & (_at() == F.col("_pick")), "left")
            .withColumn("_chosen", F.coalesce(F.col("_row") <= F.col("_limit"), F.lit(False))))
    rows = whole.unionByName(some.select(whole.columns))
    return (rows.withColumn("copies", (F.col("_whole") + F.col("_chosen").cast("long")).cast("long"))
            .select(*keep, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def _taken() -> Column:
    """Is a group taken whole by one of its source's ``_rules``?"""
    return F.coalesce(F.exists("_rules", lambda r: (
        (r["lo"].isNull() | (_at() > r["lo"])) & (r["cap"].isNull() | (F.col("size") <= r["cap"]))
        & (r["cut"].isNull() | (_at() < r["cut"])))), F.lit(False))


def take(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it is taken."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").withColumn("copy", times)
