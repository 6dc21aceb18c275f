"""Merkle manifest against a plain tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorstream.llm import merkle, queries

from ..conftest import SF_SMALL
from .rows import awkward


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """Root, and of each leaf the hashes beside its way up (None: alone)."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            path.append((level[i ^ 1] if i ^ 1 < len(level) else None, i & 1))
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def fold(h, path):
    for sib, left in path:
        h = sha(sib + h if left else h + (sib or ""))
    return h


def plain(rows):
    """``doc_id, lang, leaf, subroot, root, path`` of rows ``doc_id, source, lang, n_chars, text``."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], leaf(*r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([h for _, h in groups[g]])
    if not order:
        return []
    root, tops = tree([trees[g][0] for g in order])
    return [(d, g, h, trees[g][0], root, low + top) for g, top in zip(order, tops, strict=True)
            for (d, h), low in zip(groups[g], trees[g][1], strict=True)]


def found(frame):
    return sorted(((r.doc_id, r.lang, r.leaf, r.subroot, r.root, [(s.sib, int(s.left)) for s in r.path])
                   for r in frame.collect()), key=repr)


def rows_of(odd):
    return [(r[0], r[3], r[2], r[4], r[1]) for r in odd]


def test_awkward_rows(odd_docs, odder_docs, no_docs):
    assert found(merkle.manifest(odd_docs)) == sorted(plain(rows_of(awkward())), key=repr)
    odder = merkle.manifest(odder_docs)
    assert found(odder) == sorted(plain(rows_of(awkward(unique=False))), key=repr)
    assert all(r.ok for r in odder.select((merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).collect())
    assert merkle.manifest(no_docs).collect() == []


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (2, [None, "en"]), (9, ["en"]), (70, ["en", "en", "de", None, "\U0001F600", "z", "", "fr"])])
def test_many_tiers(spark, monkeypatch, n, langs):
    """Blocks of four, so that groups and the groups' tree have several tiers."""
    for name, value in (("DIGIT_BITS", 1), ("DIGITS", 2), ("BLOCK_BITS", 2)):
        monkeypatch.setattr(merkle, name, value)
    rows = [(i * 7 % n, "s", langs[i % len(langs)], i, f"t{i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(merkle.manifest(docs)) == sorted(plain(rows), key=repr)


def test_blocks_of_full_size(spark):
    """More rows than a block, a third of them one row repeated."""
    rows = [(i if i % 3 else 3, None, "en" if i % 5 else "fr", 1, "same" if i % 3 == 0 else f"t{i}") for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert found(merkle.manifest(docs)) == sorted(plain(rows), key=repr)


def test_query_finds_the_tampered(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*merkle.FIELDS).collect()
    by_id = {r.doc_id: r for r in docs}
    want = {}
    for d, _, h, sub, root, path in plain([tuple(r) for r in docs]):
        r = by_id[d]
        changed = leaf(r.doc_id, r.source, r.lang, r.n_chars + 1, r.text) if zlib.crc32(str(d).encode()) % 7 == 0 and r.n_chars is not None else h
        end = fold(changed, path)
        want[d] = (h, sub, root, sha("".join(s or "" for s, _ in path)), end, end == root)
    got = {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
           for r in queries.op11_merkle(spark, SF_SMALL).collect()}
    assert got == want and len({w[-1] for w in want.values()}) == 2
