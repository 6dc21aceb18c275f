"""Texts without an id whose 32-bit checksums are equal."""

import random
import zlib

from sensorstream.llm import substring_dup

SCHEMA = "doc_id long, text string"


def test_equal_checksums_of_texts_without_id(spark):
    words = lambda seed, n: " ".join(f"w{random.Random(seed * 1000 + i).randrange(10**6)}" for i in range(n))
    twice, once = words(1, 60), words(2, 60)
    ends = random.Random(3)
    end = lambda: "".join(ends.choices("abcdefghijklmnopqrstuvwxyz", k=12))
    seen = {zlib.crc32(t.encode()): t for t in (f"{twice} {end()}" for _ in range(200_000))}
    other = next(t for t in (f"{once} {end()}" for _ in range(500_000)) if zlib.crc32(t.encode()) in seen)
    first = seen[zlib.crc32(other.encode())]
    docs = spark.createDataFrame([(None, first), (None, other), (7, f"{twice} tail")], SCHEMA)
    got = {r.kept: (r.n_words, r.n_removed) for r in substring_dup.remove_repeats(docs).collect()}
    assert got == {first.split(" ")[-1]: (61, 60), other: (61, 0), "tail": (61, 60)}
