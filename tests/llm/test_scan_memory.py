"""What a worker holds while it scans many short texts."""

import tracemalloc

import pyarrow as pa

from sensorstream.llm import _text


def test_scan_of_short_texts_is_bounded(monkeypatch):
    monkeypatch.setattr(_text, "_powers", {})
    column = pa.array(["some words of text " * 50] * 4000, pa.large_string())
    tracemalloc.start()
    try:
        n = sum(len(words.runs(5)) + 4 for words in _text.scan(column, lower=True))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 4000 * 200
    assert peak < 32 << 20
