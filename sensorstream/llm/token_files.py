"""Token-id output: flat unsigned integer files with 64-bit document offsets.

Layout of a written set (one folder in shared storage):

* ``part-00007.bin``: token ids of the part's documents back to back, little
  endian, uint16 if every id of the vocabulary fits, else uint32;
* ``part-00007.idx``: three int64 arrays of the part's ``n`` documents: their
  ids (0 for a null id), a 0/1 null mark, and ``n + 1`` token offsets in the
  part, the last one being the part's length;
* ``manifest.json``: dtype and, for each part in order, its number of
  documents, tokens and its *base*, the prefix sum of the parts before it.

Documents are range-partitioned by ``doc_id``, so token ``base + offset`` is a
document's place in the whole set and each part is written by one task.  A
task writes under an attempt's own name and renames when complete; a repeated
task writes the same bytes, so losing an executor does no harm.  Readers map
the files into memory.

Encoding: the tokenizer normalises and splits at white space, so the ids of a
text are those of its blank-separated pieces in turn.  Pieces are encoded by
the tokenizer in batches and kept in a bounded per-worker table.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END_ID = 1
#: Pieces kept by a worker before a table is started anew (about 100 bytes each).
CACHE_PIECES = 900_000
_BLANKS = " \t\n\x0b\x0c\r"


def _fs(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if urlparse(folder).scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), urlparse(folder).path if "://" in folder or folder.startswith("file:") else folder
    return pyarrow.fs.FileSystem.from_uri(folder)


def _write(folder: str, name: str, chunks: list[bytes]) -> None:
    """Write a file whole or not at all."""
    fs, path = _fs(folder)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(own, f"{path}/{name}")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself, or the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Pieces of Latin letters, digits and marks: case and splitting are plain.
_SIMPLE = regex.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")


def _worker_tables(key: tuple) -> tuple[dict, dict]:
    """Tables of this worker process, shared by the tasks that it runs in turn
    (this module itself travels by value, anew for each task)."""
    home = sys.modules.setdefault("_token_tables_of_worker", types.ModuleType("_token_tables_of_worker"))
    return home.__dict__.setdefault(key, ({}, {}))


class PieceEncoder:
    """Ids of whole texts as little-endian bytes, through tables.

    A text's blank-separated pieces are looked up in a table.  A new piece of
    Latin characters is lowered and cut by the tokenizer's own pattern, and its
    parts, of which there are far fewer, are looked up in a second table or
    given to the tokenizer's model.  Other pieces, and all pieces for a
    tokenizer of another make, go through the whole tokenizer.
    """

    def __init__(self, tokenizer_file: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.dtype = np.dtype(dtype).newbyteorder("<")
        self.code = {"uint16": "<%dH", "uint32": "<%dI"}[dtype]
        held = _worker_tables((tokenizer_file, dtype))
        self.table: dict[str, bytes] = held[0]
        self.parts: dict[str, bytes] = held[1]
        self.letters = _byte_letters()
        self.pattern = self._own_pattern(json.loads(self.tokenizer.to_str()))

    @staticmethod
    def _own_pattern(spec: dict) -> regex.Pattern | None:
        """The pattern that cuts words, if the tokenizer lowers, cuts by a
        pattern and maps bytes, and does nothing else."""
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in cuts] != ["Split", "ByteLevel"]:
            return None
        if not cuts[0]["invert"] or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"] or spec.get("post_processor"):
            return None
        return regex.compile(cuts[0]["pattern"]["Regex"])

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(self.code % len(ids), *ids)

    def _learn(self, new: list[str]) -> None:
        hard, parts, model, letters = [], self.parts, self.tokenizer.model, self.letters
        for piece in new:
            if self.pattern is None or "<|" in piece or not _SIMPLE.fullmatch(piece):
                hard.append(piece)
                continue
            got = []
            for part in self.pattern.findall(piece.lower()):
                ids = parts.get(part)
                if ids is None:
                    # Simple pieces have no ASCII but printable characters, which stand for themselves.
                    mapped = part if part.isascii() else "".join([letters[b] for b in part.encode()])
                    ids = parts[part] = self._bytes([t.id for t in model.tokenize(mapped)])
                got.append(ids)
            self.table[piece] = b"".join(got)
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for at in range(0, len(hard), 4096):
            some = hard[at:at + 4096]
            for piece, got in zip(some, encode(some, add_special_tokens=False), strict=True):
                self.table[piece] = self._bytes(got.ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [_spaced(t).split(" ") for t in texts]
        table, every = self.table, set().union(*pieces)
        new = every.difference(table)
        if len(self.parts) > CACHE_PIECES:
            self.parts.clear()
        if len(table) + len(new) > CACHE_PIECES:
            table.clear()
            new = every
        self._learn(list(new))
        return [b"".join(map(table.__getitem__, text)) for text in pieces]


def _spaced(text: str) -> str:
    """``text`` with a space for each blank; a search that finds none costs next to nothing."""
    for blank in _BLANKS[1:]:
        text = text.replace(blank, " ")
    return text


def _encode_part(tokenizer_file: str, folder: str, dtype: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, encoder = TaskContext.get().partitionId(), PieceEncoder(tokenizer_file, dtype)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        ids, nulls, lengths = [], [], []
        fs, path = _fs(folder)
        name = f"part-{part:05d}"
        own = f"{path}/.{name}.bin.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    piece = batch.slice(at, 256)
                    for x in piece.column(0).to_pylist():
                        ids.append(x or 0)
                        nulls.append(x is None)
                    for got in encoder.encode([t or "" for t in piece.column(1).to_pylist()]):
                        out.write(got)
                        out.write(end)
                        lengths.append(len(got) // encoder.dtype.itemsize + 1)
        if not ids:
            fs.delete_file(own)
            return
        fs.move(own, f"{path}/{name}.bin")
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
        _write(folder, f"{name}.idx", [np.array(ids, "<i8").tobytes(), np.array(nulls, "<i8").tobytes(), offsets.tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([len(ids)]), pa.array([int(offsets[-1])])],
                                         names=["part", "docs", "tokens"])
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = END_ID) -> dict:
    """Encode ``docs`` (``doc_id``, ``text``) into ``folder``; return the manifest.

    Every document, a null or empty text too, gets its ids and ``end_id``.
    Documents stand in ascending ``doc_id`` order, null ids first; rows with
    the same id keep a fixed order by their text.  Other columns are not read.
    An empty table makes a manifest without parts.  ``folder`` must be
    reachable from every executor; the tokenizer file too, as it is installed
    on each.
    """
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1)
    dtype = "uint16" if top <= 1 << 16 else "uint32"
    fs, path = _fs(folder)
    fs.create_dir(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    made = ordered.mapInArrow(_encode_part(tokenizer_file, folder, dtype, end_id), "part long, docs long, tokens long")
    parts, base = [], 0
    for r in sorted(made.collect()):        # one row a part
        parts.append({"part": r.part, "docs": r.docs, "tokens": r.tokens, "base": base})
        base += r.tokens
    manifest = {"dtype": dtype, "end_id": end_id, "tokens": base, "parts": parts}
    _write(folder, "manifest.json", [json.dumps(manifest).encode()])
    return manifest


class TokenPart:
    """One written part, mapped into memory."""

    def __init__(self, folder: str, part: dict, dtype: str):
        fs, path = _fs(folder)
        name = f"{path}/part-{part['part']:05d}"
        n = part["docs"]
        self.base = part["base"]
        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            index = np.memmap(f"{name}.idx", dtype="<i8", mode="r")
            self.tokens = np.memmap(f"{name}.bin", dtype=f"<{np.dtype(dtype).str[1:]}", mode="r")
        else:
            read = lambda f: fs.open_input_file(f).read_buffer()
            index = np.frombuffer(read(f"{name}.idx"), "<i8")
            self.tokens = np.frombuffer(read(f"{name}.bin"), f"<{np.dtype(dtype).str[1:]}")
        self.ids, self.null, self.offsets = index[:n], index[n:2 * n], index[2 * n:]
        if len(self.offsets) != n + 1 or self.offsets[-1] != len(self.tokens):
            raise ValueError(f"{name}: index and token file don't fit together")

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start in the whole set, ids)`` of each document."""
        for i in range(len(self.ids)):
            a, b = int(self.offsets[i]), int(self.offsets[i + 1])
            yield None if self.null[i] else int(self.ids[i]), self.base + a, self.tokens[a:b]


def _read_parts(folder: str, dtype: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for part in batch.to_pylist():
                held: list[tuple] = []
                for doc, start, ids in TokenPart(folder, part, dtype):
                    wide = ids.astype("<u4")
                    held.append((doc, start, len(ids), zlib.crc32(wide.tobytes()), wide if with_ids else None))
                    if len(held) == 1024:
                        yield _batch(held, with_ids)
                        held = []
                if held:
                    yield _batch(held, with_ids)
    return run


def _batch(held: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    arrays = [pa.array([h[k] for h in held], type=pa.int64()) for k in range(4)]
    if with_ids:
        arrays.append(pa.array([h[4] for h in held], type=pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) from written files.

    Each task maps its parts' files; ``ids_crc32`` is over the ids as
    little-endian 32-bit integers.
    """
    fs, path = _fs(folder)
    manifest = json.loads(fs.open_input_file(f"{path}/manifest.json").read())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    parts = manifest["parts"]
    if not parts:
        return spark.range(0).selectExpr(*(f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in schema.split(", ")))
    rows = spark.createDataFrame([(p["part"], p["docs"], p["base"]) for p in parts], "part long, docs long, base long")
    return (rows.repartition(len(parts), "part").mapInArrow(_read_parts(folder, manifest["dtype"], with_ids), schema))
