r"""Personal data: patterns propose, checksums confirm, context words weigh.

Patterns propose spans of six kinds.  Validators confirm them: parts of an
address up to 255, Luhn for card numbers, mod-97 for bank accounts, numbers of
digits.  Each span starts with its kind's score; words near it raise or lower
the score, and spans under ``LEAST_SCORE`` are dropped, except for the four
base kinds, which stay whatever their score.

All of it is built-in columns.  Places come from splitting a text at a
pattern's matches: the lengths of the pieces and of the matches in turn.
Patterns are written so that a long run of like characters is read once: a
match starts only at a run's beginning (or where the match before ended), and
repetitions never give back.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._columns import let

#: Code points on each side of a span in which context words count.
NEAR = 48
LEAST_SCORE = 0.5
RAISE, LOWER = 0.3, 0.3
_JOINT = "\x01"


@dataclass(frozen=True)
class Kind:
    name: str
    #: Texts without a match of ``gate`` are not searched further.
    gate: str
    pattern: str
    score: float
    base: bool
    near: str
    against: str = r"\b(?:example|sample|dummy|placeholder|version|beispiel|ejemplo|exemple)\b"


KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
         0.8, True, r"\b(?:e-?mail|mail|contact|write|correo|kontakt|adresse)\b"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         0.6, True, r"\b(?:ip|host|server|address|addr|login|client|servidor|serveur)\b"),
    Kind("card", r"[0-9](?:[ -]?[0-9]){12}", rf"[0-9][0-9{_JOINT}]++",
         0.7, True, r"\b(?:card|credit|visa|mastercard|payment|karte|tarjeta|carte)\b"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]",
         0.6, True, r"\b(?:phone|call|tel|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone|anrufen)\b"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[ ]?[A-Z0-9]{4}",
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+)(?![A-Za-z0-9])",
         0.7, False, r"\b(?:iban|account|bank|konto|cuenta|compte)\b"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         0.35, False, r"\b(?:ssn|social security|tax id|taxpayer)\b"),
)
BASE = tuple(k.name for k in KINDS if k.base)

_DIGITS = "[^0-9]"


def _chars(x: Column) -> Column:
    return F.split(x, "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its right Luhn digit."""
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.transform(F.filter(_chars(F.reverse(digits)), lambda c: c != ""), worth),
                       F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, its blanks removed, leaves 1 modulo 97."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    step = lambda r, c: F.when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97).otherwise(
        (r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(_chars(turned), lambda c: c != ""), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, _DIGITS, "")
    if kind == "ip":
        def part(x: Column) -> Column:
            # Leading zeros don't count; a part of zeros alone is 0.
            return let(F.ltrim(x, F.lit("0")), lambda n: (F.length(n) <= 3) & F.coalesce(n.try_cast("int") <= 255, n == ""))
        return F.forall(F.split(match, r"\."), part)
    if kind == "card":
        return let(digits, lambda d: F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(F.translate(match, " ", ""))
    if kind == "ssn":
        area, rest = F.substring(match, 1, 3), F.substring(match, 5, 7)
        return ~(area.isin("000", "666") | (area >= "900") | rest.startswith("00") | rest.endswith("0000"))
    return F.lit(True)


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, in order."""
    source = text
    if kind.name == "card":
        # Single blanks or hyphens between digits join them: one mark each,
        # which keeps every place and makes a number a plain run.
        source = F.regexp_replace(F.translate(text, _JOINT, "\x02"), "(?<=[0-9])[ -](?=[0-9])", _JOINT)

    def place(both: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<m:string,start:int,end:int>>").alias("out"))

        def step(a: Column, x: Column) -> Column:
            begin = a["at"] + F.length(x["gap"])
            end = begin + F.length(x["m"])
            return F.struct(end.alias("at"), F.when(
                _valid(kind.name, x["m"]), F.array_append(a["out"], F.struct(x["m"].alias("m"), begin.alias("start"), end.alias("end")))
            ).otherwise(a["out"]).alias("out"))

        return F.aggregate(both, start, step, lambda a: a["out"])

    def weigh(x: Column) -> Column:
        around = F.lower(F.concat(F.substring(text, F.greatest(x["start"] - NEAR + 1, F.lit(1)), F.least(x["start"], F.lit(NEAR))),
                                  F.lit(" "), F.substring(text, x["end"] + 1, F.lit(NEAR))))
        return let(around, lambda a: F.struct(
            F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(kind.score) + F.when(F.rlike(a, F.lit(kind.near)), RAISE).otherwise(0.0)
                                           - F.when(F.rlike(a, F.lit(kind.against)), LOWER).otherwise(0.0))).alias("score")))

    def search(t: Column) -> Column:
        matches = F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0))
        gaps = F.split(t, kind.pattern, -1)
        return let(matches, lambda m: let(gaps, lambda g: F.transform(place(F.transform(
            m, lambda x, i: F.struct(x.alias("m"), F.get(g, i).alias("gap")))), weigh)))

    found = let(source, search)
    if not kind.base:
        found = F.filter(found, lambda x: x["score"] >= LEAST_SCORE)
    return F.when(F.rlike(text, F.lit(kind.gate)), found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: an array of ``kind, start, end, score``.

    Places are code points, the end exclusive; spans are ordered by kind, then
    start.  Spans of one kind don't overlap, those of different kinds may.  A
    null or empty text has none.  Every row is judged by itself; extra columns
    stay, an existing column ``pii`` is replaced.
    """
    docs = docs.drop("pii").withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = [_spans(F.col("_text"), k) for k in KINDS]
    # Nothing to find without a digit or an @.
    some = F.rlike(F.col("_text"), F.lit("[0-9@]"))
    return docs.withColumn("pii", F.when(some, F.concat(*found)).otherwise(F.array().cast(_SPAN))).drop("_text")


def redact(docs: DataFrame) -> DataFrame:
    """``text`` with every span of ``pii`` replaced by its kind in brackets."""
    def cut(spans: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        step = lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))
                                   ).otherwise(F.struct(s["end"].alias("at"), F.concat(
                                       a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]),
                                       F.lit("["), s["kind"], F.lit("]")).alias("out")))
        return F.aggregate(spans, begin, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    by_place = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return docs.withColumn("text", F.when(F.size("pii") == 0, F.col("text")).otherwise(cut(by_place)))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def base_spans() -> Column:
    return F.filter("pii", lambda s: reduce(lambda a, b: a | b, (s["kind"] == k for k in BASE)))
