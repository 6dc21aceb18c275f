"""The fitting sample of the line model, and the gradient it is fitted by."""

import itertools

import numpy as np

from sensorstream.llm import crf_quality


def test_very_long_texts_are_left_out_and_the_next_ones_taken(spark, monkeypatch):
    monkeypatch.setattr(crf_quality, "fit", lambda texts, labels: sorted(zip(texts, labels, strict=True)))
    most = crf_quality.TRAIN_LINES
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string").unionAll(spark.sql(
        f"SELECT 20L AS doc_id, repeat('long line\\n', 2500000) AS text UNION ALL SELECT 21L, repeat('x', {crf_quality.TRAIN_BYTES + 1}) "
        f"UNION ALL SELECT 22L, repeat('\\n', {most}) UNION ALL SELECT 23L, repeat('\\n', {most - 1}) "
        f"UNION ALL SELECT 24L, repeat('x', {crf_quality.TRAIN_BYTES}) UNION ALL SELECT 25L, NULL"))
    labels = spark.range(26).selectExpr("id AS doc_id", "id % 2 AS quality")
    got = crf_quality.train(docs, labels)
    want = [(f"text {i}", i % 2) for i in range(20)] + [("\n" * (most - 1), 1), ("x" * crf_quality.TRAIN_BYTES, 0), ("", 1)]
    assert got == sorted(want)
    assert len(crf_quality.train(docs, labels, most_docs=22)) == 22


def test_slopes_are_the_gradient_of_the_likelihood():
    """Against differences of the log-likelihood, summed over all label paths."""
    r = np.random.default_rng(8)
    first = np.array([0, 1, 4, 4, 9])
    x, goal = r.normal(size=(9, 3)), np.array([1, 0, 0, 0, 1, 1, 0, 1, 1.0])
    weight = np.repeat([0.5, 2.0, 0, 0.3], np.diff(first))
    weights, between = r.normal(size=3), r.normal(size=(2, 2))

    def path(score, between, labels):
        return sum(score[labels == 1]) + sum(between[a, b] for a, b in itertools.pairwise(labels))

    def objective(weights, between):
        total = -crf_quality._DECAY / 2 * ((weights ** 2).sum() + (between ** 2).sum())
        for a, b in itertools.pairwise(first):
            if b > a:
                score = x[a:b] @ weights
                every = [path(score, between, np.array(p)) for p in itertools.product([0, 1], repeat=b - a)]
                total += weight[a] * (path(score, between, goal[a:b].astype(int)) - np.logaddexp.reduce(every))
        return total

    model = crf_quality.Crf(np.zeros(3), np.ones(3), weights, between)
    slope, turn = model.slopes(x, goal, weight, first)
    e = 1e-6
    for i in range(3):
        d = np.eye(3)[i] * e
        assert abs((objective(weights + d, between) - objective(weights - d, between)) / (2 * e) - slope[i]) < 1e-6
    for i, j in itertools.product([0, 1], repeat=2):
        d = np.zeros((2, 2))
        d[i, j] = e
        assert abs((objective(weights, between + d) - objective(weights, between - d)) / (2 * e) - turn[i, j]) < 1e-6
