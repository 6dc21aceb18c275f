"""Document quality rules with adaptive thresholds.

Every document gets a few whole-number measures.  A quantile sketch for each
language, source and measure counts documents on a fixed grid of values: cells
are added to merge two sketches, in any order, with the same result.  From the
quartiles of a sketch come fences, ``REACH`` interquartile ranges beyond, with
a least distance so that a group of like documents has room; a document
outside a fence of its group is rejected.  Groups of fewer than ``LEAST_DOCS``
documents use their language's merged sketch, and small languages the
sketch of all.  Two fixed rules come before (see ``base_failed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._columns import BLANKS, WORD, let
from ._scratch import settle

LEAST_WORDS = 50
REPEAT_PERCENT = 50
REACH = 4
LEAST_DOCS = 100
#: Measure: (SQL over the base columns, last cell of the grid, least distance
#: of a fence from its quartile).  Shares are in thousandths, lengths in
#: hundredths of a character; values beyond the grid count in its last cell.
MEASURES = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", 1000, 30),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 1000, 250),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 1000, 200),
    "capitals": ("1000 * n_capitals div greatest(word_chars, 1)", 1000, 150),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 4000, 250),
}
#: Measures of which too little is suspect as well.
TWO_SIDED = ("word_length",)
_SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in their text.

    Windows are sorted by content, so equal ones are neighbours: the work is
    ``n log n`` for any text.
    """
    def covered(windows: Column) -> Column:
        again = F.filter(windows, lambda x, i: (
            ((i > 0) & (F.get(windows, i - 1)["w"] == x["w"])) |
            ((i < F.size(windows) - 1) & (F.get(windows, i + 1)["w"] == x["w"]))))
        return let(F.array_sort(F.transform(again, lambda x: x["at"])), lambda at: F.aggregate(
            F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))

    def windows(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        def sorted_if_repeated(h: Column) -> Column:
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("w"), i.alias("at")))), covered))
        return let(every, sorted_if_repeated)

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(windows(w)))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with counts of words, characters, symbols, lines and repeats."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(F.col("_text"), F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    dup = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    counts = let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("again")))
    return (docs.withColumn("_text", text).withColumn("_lines", dup).withColumn("_counts", counts)
            .withColumn("n_words", F.col("_counts.n").cast("long"))
            .withColumn("word_chars", F.length(F.translate("_text", BLANKS, "")).cast("long"))
            .withColumn("n_symbols", (F.length("_text") - F.length(F.translate("_text", _SYMBOLS, ""))).cast("long"))
            .withColumn("n_dup_lines", F.col("_lines.dup").cast("long"))
            .withColumn("n_lines", F.col("_lines.n").cast("long"))
            .withColumn("n_repeat_words", F.col("_counts.again").cast("long"))
            .withColumn("n_capitals", (F.length("_text") - F.length(F.regexp_replace("_text", "[A-Z]", ""))).cast("long"))
            .drop("_text", "_lines", "_counts"))


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, cell, docs``: one quantile sketch a group."""
    values = F.array(*(F.struct(F.lit(name).alias("measure"),
                                F.expr(f"least(greatest({sql}, 0), {top})").cast("int").alias("cell"))
                       for name, (sql, top, _) in MEASURES.items()))
    return (measured.where("NOT base_failed").select("lang", "source", F.explode(values).alias("v"))
            .groupBy("lang", "source", "v.measure", "v.cell").agg(F.count("*").alias("docs")))


def _fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``low`` and ``high`` of each group and measure, and its documents."""
    merged = sketch.groupBy(*by, "measure", "cell").agg(F.sum("docs").alias("docs"))
    along = Window.partitionBy(*by, "measure").orderBy("cell")
    whole = Window.partitionBy(*by, "measure")
    ranked = merged.withColumn("upto", F.sum("docs").over(along)).withColumn("n", F.sum("docs").over(whole))
    quartile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("n"), F.col("cell")))
    found = ranked.groupBy(*by, "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("n").alias("n"))
    least = F.element_at(F.create_map(*(F.lit(x) for name, (_, _, room) in MEASURES.items() for x in (name, room))),
                         F.col("measure"))
    room = F.greatest(REACH * (F.col("q3") - F.col("q1")), least)
    return found.select(*by, "measure", "n", (F.col("q3") + room).alias("high"),
                        F.when(F.col("measure").isin(*TWO_SIDED), F.col("q1") - room).alias("low"))


def thresholds(sketch: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, fences`` (measure to low and high) of each group."""
    own, lang, every = (_fences(sketch, by) for by in (["lang", "source"], ["lang"], []))
    pick = lambda name: F.when(F.col("g.n") >= least_docs, F.col(f"g.{name}")).when(
        F.col("l.n") >= least_docs, F.col(f"l.{name}")).otherwise(F.col(f"a.{name}"))
    return (own.alias("g").join(lang.alias("l"), F.expr("g.lang <=> l.lang AND g.measure = l.measure"))
            .join(every.alias("a"), F.expr("g.measure = a.measure"))
            .groupBy("g.lang", "g.source").agg(F.map_from_entries(F.collect_list(F.struct(
                F.col("g.measure"), F.struct(pick("low").alias("low"), pick("high").alias("high"))))).alias("fences")))


def judge(measured: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Measured documents with ``base_failed``, ``broken`` and ``kept``.

    ``measured`` is read twice, so it should be a stored table.
    """
    failed = F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")
    measured = measured.withColumn("base_failed", failed)
    limits = settle(thresholds(sketches(measured), least_docs), "thresholds")
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "fences")
    joined = measured.join(limits, F.expr("lang <=> _lang AND source <=> _source"), "left")
    broken = F.array_compact(F.array(*(
        F.when(F.expr(f"least(greatest({sql}, 0), {top}) > fences['{name}'].high"
                      f" OR least(greatest({sql}, 0), {top}) < fences['{name}'].low"), F.lit(name))
        for name, (sql, top, _) in MEASURES.items())))
    return (joined.withColumn("broken", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(broken))
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
            .drop("_lang", "_source", "fences"))


def quality_rules(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``broken`` rules and ``kept``.

    ``base_failed``: under 50 words, or over half of the words in repeated
    three-word windows.  Other documents are kept unless a measure lies
    outside the fences of their language and source; ``broken`` names those
    measures.  A null text counts as empty and fails; null languages and
    sources are groups of their own; repeated rows count and are judged each.
    Extra columns stay, and columns named like the results are replaced.
    """
    docs = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_capitals",
                     "base_failed", "broken", "kept")
    return judge(settle(measure(docs), "measured"), least_docs)
