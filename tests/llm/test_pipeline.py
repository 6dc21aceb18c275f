"""The corpus pipeline against its stages in plain Python."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sensorstream.llm._scratch import settle

from . import brute
from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], SF_SMALL), name))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dup", "decontaminate", "mixing", "token_files"]
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:5])


def test_each_stage(spark, stages):
    rows = [[(r.doc_id, r.text) for r in s.collect()] for s in stages[:5]]
    passed = {d for d, _ in rows[1]}
    assert all(not brute.quality_counts(t)[-1] for _, t in rows[1])
    fixed = [d for d, t in rows[0] if not brute.quality_counts(t)[-1]]
    assert passed <= set(fixed) and len(passed) >= 0.9 * len(fixed)
    assert sorted(d for d, _ in rows[2]) == [d for d, _, _, kept in brute.near_duplicates(rows[1]) if kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = [d for (d, _), w in zip(rows[2], brute.contamination([t for _, t in rows[2]], items), strict=True) if not w[-1]]
    assert sorted(d for d, _ in rows[3]) == sorted(clean)
    source = {r.doc_id: r.source for r in stages[3].collect()}
    size = {d: len(brute.words(t)) for d, t in rows[3]}
    sizes, taken = Counter(), Counter()
    for d in size:
        sizes[source[d]] += size[d]
    for d, _ in rows[4]:
        taken[source[d]] += size[d]
    for s, t in brute.mix_targets(sizes).items():
        assert abs(taken[s] - t) <= max(1, max(size[d] for d in size if source[d] == s) / 2)


def test_token_stage(stages):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer, at, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for doc_id, text in sorted((r.doc_id, r.text) for r in stages[4].collect()):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, stages[5].collect())) == want


def test_run_agrees(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF_SMALL).collect()) == sorted(stages[5].collect())


def test_odd_tables(spark, odder_docs, no_docs):
    for docs in (odder_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:4]:
            docs = settle(stage(spark, docs, SF_SMALL), name)
            assert docs.columns == odder_docs.columns
        corpus_pipeline.to_token_files(spark, docs, SF_SMALL).count()
