"""Token ids in Arrow files of fixed-size-list batches.

A corpus is written as shards in ascending document order. A shard is two Arrow IPC files: the
sequences (``ids`` and ``mask``, fixed-size lists of equal length, so that sequence ``i`` is a slice of a
memory-mapped buffer) and an index with one row per document (``doc_id, start, n_tokens`` in the shard).
Documents follow each other without gaps; only a shard's last sequence is padded, with mask false.

Defined results: a null text counts as empty and holds the end id alone; an empty table writes no
shard; rows that repeat a ``doc_id`` are kept, in the order of their ids' bytes; null ids come first.
A task that is run again writes files of a new name, and only those of the task that counted are listed.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm._store import Scratch, small_batches, worker_own

SEQUENCE, BATCH = 2048, 128
#: Bytes of text that a shard is meant for, the least number of shards, and the most (shards then grow).
SHARD_BYTES, MIN_SHARDS, MAX_SHARDS = 16 << 20, 32, 50_000
#: Sampled ids per shard from which the shards' bounds are taken.
BOUND_SAMPLES = 20
#: Distinct words whose ids a worker keeps.
CACHE = 250_000


#: Words of Latin letters that close with ASCII marks: what the tokenizer's rules make of them is known (two pieces at most).
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ſ]+)([!-/:-@[-`{-~]*)")


class Pieces(dict):
    """Packed ids of a piece, by the tokenizer's model alone."""

    def __init__(self, tokenizer, spelling: dict, dtype: str):
        super().__init__()
        self.model, self.spelling, self.dtype = tokenizer.model.tokenize, spelling, dtype

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelling)
        ids = [t.id for t in self.model(spelled)]
        own = self[piece] = struct.pack(f"<{len(ids)}{self.dtype}", *ids)
        return own


class WordEncoder(dict):
    """Packed ids of a word. Words are encoded one by one: no rule of the tokenizer reaches across ASCII white space.

    That holds for tokenizers that drop white space before their merges, as word-end BPE does. For such a tokenizer
    (lower case, one piece for a run of letters and one for a run of marks) plain words go to its model piece by
    piece, which takes a fifth of the time; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str, dtype: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.dtype = Tokenizer.from_file(path), "H" if dtype == "<u2" else "I"
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # How the model spells each byte of a character's UTF-8 form: one character.
        alphabet = {b: spell(c)[0][0][k] for c in map(chr, range(0x180)) for k, b in enumerate(c.encode())}
        self.pieces = Pieces(self.tokenizer, str.maketrans({chr(b): c for b, c in alphabet.items()}), self.dtype)
        self.plain = False
        if isinstance(self.tokenizer.normalizer, normalizers.Sequence) and self.tokenizer.pre_tokenizer:
            probe = "Être\u00df,;' ABC'S x!"
            self.plain = True
            self.plain = b"".join(self[w.encode()] for w in probe.split()) == self._whole(probe)
            self.clear()

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}{self.dtype}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        text = word.decode()
        found = PLAIN.fullmatch(text) if self.plain else None
        if found and (letters := found[1].lower()).isalpha():
            ids = self.pieces[letters]
            if found[2]:
                ids += self.pieces[found[2]]
        else:
            ids = self._whole(text)
        self[word] = ids
        return ids

    def encode(self, texts: list[bytes | None], end: bytes) -> list[bytes]:
        get = self.__getitem__
        return [b"".join(map(get, (t or b"").split())) + end for t in texts]


def _encoder(path: str, dtype: str) -> WordEncoder:
    return worker_own(("tokens", path, dtype), lambda: WordEncoder(path, dtype))


def _encode(path: str, dtype: str, end_id: int, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = _encoder(path, dtype), np.array([end_id], dtype).tobytes()
        for b in batches:
            ids = b.column(0)
            shard = np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), side="right")
            coded = coder.encode(b.column(1).cast(pa.binary()).to_pylist(), end)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), ids, pa.array(coded, pa.binary())], ["shard", "doc_id", "ids"])

    return run


def _files(uri: str):
    if "://" in uri or uri.startswith("file:"):
        return pa.fs.FileSystem.from_uri(uri)
    return pa.fs.LocalFileSystem(), uri


class ShardWriter:
    """Streams documents into one shard; holds one batch of sequences at a time."""

    def __init__(self, folder: str, shard: int, dtype: str):
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        self.name, self.dtype, self.docs, self.tokens = f"{shard:06d}-{uuid.uuid4().hex}", dtype, 0, 0
        kind = pa.from_numpy_dtype(np.dtype(dtype))
        self.schema = pa.schema([("ids", pa.list_(kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.outs = [files.open_output_stream(f"{root}/{self.name}.{x}") for x in ("arrow", "index.arrow")]
        self.data = pa.ipc.new_file(self.outs[0], self.schema)
        self.index = pa.ipc.new_file(self.outs[1], self.index_schema)
        self.held, self.held_bytes, self.rows = [], 0, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // np.dtype(self.dtype).itemsize
        self.rows.append((doc_id, self.tokens, n))
        self.docs, self.tokens = self.docs + 1, self.tokens + n
        self.held.append(ids)
        self.held_bytes += len(ids)
        if len(self.rows) >= 65_536:
            self._index()
        if self.held_bytes >= SEQUENCE * BATCH * np.dtype(self.dtype).itemsize:
            self._flush(False)

    def _index(self) -> None:
        if self.rows:
            self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*self.rows)], schema=self.index_schema))
        self.rows = []

    def _flush(self, last: bool) -> None:
        """Write whole batches; at the end also the rest, its last sequence padded."""
        flat, size = np.frombuffer(b"".join(self.held), self.dtype), SEQUENCE * BATCH
        mask = np.ones(len(flat), bool)
        if last:
            pad = -len(flat) % SEQUENCE
            flat, mask = np.concatenate([flat, np.zeros(pad, self.dtype)]), np.concatenate([mask, np.zeros(pad, bool)])
        upto = len(flat) if last else len(flat) - len(flat) % size
        for at in range(0, upto, size):
            self._write(flat[at : min(at + size, upto)], mask[at : min(at + size, upto)])
        self.held, self.held_bytes = [flat[upto:].tobytes()], flat[upto:].nbytes

    def _write(self, ids: np.ndarray, mask: np.ndarray) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), SEQUENCE) for x in (ids, mask)]
        self.data.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        self._index()
        for x in (self.data, self.index, *self.outs):
            x.close()


class ShardReader:
    """Random access to a shard: batches are views of the mapped file."""

    def __init__(self, folder: str, name: str):
        files, root = _files(folder)
        local = isinstance(files, pa.fs.LocalFileSystem)
        at = lambda x: pa.memory_map(f"{root}/{name}.{x}") if local else files.open_input_file(f"{root}/{name}.{x}")
        self.data, self.index = pa.ipc.open_file(at("arrow")), pa.ipc.open_file(at("index.arrow"))

    def flat(self, batch: int) -> np.ndarray:
        """All ids of a batch, without a copy."""
        return self.data.get_batch(batch).column(0).values.to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence ``i``."""
        batch = self.data.get_batch(i // BATCH)
        k = i % BATCH
        cut = slice(k * SEQUENCE, (k + 1) * SEQUENCE)
        return batch.column(0).values.to_numpy(zero_copy_only=True)[cut], batch.column(1).values[cut].to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for k in range(self.index.num_record_batches):
            b = self.index.get_batch(k)
            yield from zip(*(c.to_pylist() for c in b.columns))

    def document_ids(self) -> Iterator[tuple[int | None, int, int, list[np.ndarray]]]:
        """(doc_id, start, n_tokens, views of its ids), one batch of ids in hand at a time."""
        size, have, flat = SEQUENCE * BATCH, -1, None
        for doc_id, start, n in self.documents():
            parts, at = [], start
            while at < start + n:
                if at // size != have:
                    have = at // size
                    flat = self.flat(have)
                upto = min(start + n, (have + 1) * size)
                parts.append(flat[at - have * size : upto - have * size])
                at = upto
            yield doc_id, start, n, parts


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = 1) -> list[tuple[str, int, int]]:
    """Encode ``doc_id, text`` and write shards to ``folder``; (name, documents, tokens) of each, in order.

    The list has at most ``MAX_SHARDS`` rows. Shard bounds come from a sample of ids of bounded size.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    if not n:
        return []
    shards = int(min(MAX_SHARDS, max(MIN_SHARDS, -(-(size or 0) // SHARD_BYTES))))
    some = docs.select("doc_id").where("doc_id is not null").sample(min(1.0, BOUND_SAMPLES * shards * 1.2 / n), seed=7)
    ids = np.sort(np.array([r[0] for r in some.limit(4 * BOUND_SAMPLES * shards).collect()], np.int64))
    bounds = np.unique(ids[np.linspace(0, len(ids) - 1, shards + 1).astype(int)[1:-1]]) if len(ids) else ids
    import json

    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = len(json.load(f)["model"]["vocab"])
    dtype = "<u2" if vocabulary <= 60_000 else "<u4"
    coded = docs.mapInArrow(_encode(tokenizer, dtype, end_id, bounds), "shard int, doc_id long, ids binary")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, done = None, None, []
        for b in batches:
            for shard, doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if shard != now:
                    if out:
                        out.close()
                        done.append((now, out.name, out.docs, out.tokens))
                    out, now = ShardWriter(folder, shard, dtype), shard
                out.add(doc_id, ids)
        if out:
            out.close()
            done.append((now, out.name, out.docs, out.tokens))
        if done:
            cols = list(zip(*done))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1]), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["shard", "name", "docs", "tokens"])

    written = coded.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "ids").mapInArrow(write, "shard int, name string, docs long, tokens long")
    return [tuple(r[1:]) for r in sorted(written.collect())]


def read_documents(spark: SparkSession, folder: str, shards: list[tuple[str, int, int]]) -> DataFrame:
    """One row per document from the files: doc_id, start over all shards, n_tokens, ids_crc32."""
    rows, start = [], 0
    for name, _, tokens in shards:
        rows.append((name, start))
        start += tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out = []
                for doc_id, at, n, parts in ShardReader(folder, name).document_ids():
                    crc = 0
                    for x in parts:
                        crc = zlib.crc32(x.astype("<u4").tobytes(), crc)
                    out.append((doc_id, base + at, n, crc))
                    if len(out) == 20_000:
                        yield _rows(out)
                        out = []
                if out:
                    yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(rows, "name string, base long").repartition(max(1, len(rows)))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "tokens").path("shards")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards = write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, folder, shards)
