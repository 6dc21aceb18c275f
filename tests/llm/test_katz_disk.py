"""What the backoff model of triples writes to the shared folder."""

import os
import random

from sensorstream.llm import katz_lm
from sensorstream.session import ensure_storage_root


def _files(top):
    return {f"{d}/{f}": os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def test_pairs_are_not_stored(spark):
    draw = random.Random(3)
    words = [f"word{k}" for k in range(3000)]
    odds = [1 / (k + 1) for k in range(3000)]
    texts = [" ".join(draw.choices(words, odds, k=400)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    top = ensure_storage_root(spark).removeprefix("file://")
    before = _files(top)
    assert katz_lm.score(docs, "doc_id % 7 <> 2", 3).count() == 300
    written = sum(n for f, n in _files(top).items() if f not in before)
    assert 0 < written < sum(map(len, texts))
