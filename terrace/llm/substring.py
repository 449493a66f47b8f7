"""Substring dedup by prefix-partitioned suffix trees over words.

Every word position starts a suffix. Suffixes are dealt into groups by a prefix of variable length: one word
where its suffixes fit a group, else three, else the whole window; the lengths come from counts over the whole
corpus, kept in two tables of fixed size. Each group fits in memory and builds its subtree down to the depth of the window
(20 words): suffixes are ordered by their path's label, so that the leaves below one node of that depth lie together. A
deep internal node (two leaves or more) is a repeat; its first leaf stays, all others start a window that is covered.
Runs of such windows in a document make up its maximal repeats.

A label is a 64-bit hash chained word by word (its first links are the prefixes' labels). Only labels of one group are held
against each other, and a group has ``GROUP`` suffixes at most but for one window's own: of N windows, fewer than N * GROUP / 2 ** 65
are expected to be taken for another (0.06 of 10 ** 12). Records travel as arrays, a row for each group and batch. What repeats
within a batch is decided there and goes past the groups, so a passage in very many documents gives its group one record a batch.

Defined results: a null text has no words; a text of fewer words than the window stays; a null id is smaller than all others.
Rows that share an id are judged each on its own text, by the places of all of them: a window goes if it also starts at a smaller id
or at the same id and an earlier start, in whichever row. Columns of the input keep their names and values, whatever the names; a
column named like a result (``n_words``, ``n_removed``, ``removed_spans``) is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from terrace.llm._store import Scratch, claim, hand_back, release_shuffles, small_batches, tidy, worker_own

#: Words of a window, and of the short and the middle prefix.
WINDOW, SHORT, MIDDLE = 20, 1, 3
#: Entries of the prefix tables.
SHORT_TABLE, MIDDLE_TABLE = 1 << 12, 1 << 16
#: Suffixes of a group at most, groups at least, words of a batch, hashed words that a worker keeps, bytes of text of a final bucket.
GROUP, MIN_GROUPS, BATCH_WORDS, CACHE, BUCKET_BYTES = 2_000_000, 64, 500_000, 120_000, 8 << 20
NO_ID = -(1 << 63)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


def labels(words: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Chained labels of all prefixes of the given lengths; entry i is that of the words from i on."""
    n, out = len(words) - max(lengths) + 1, []
    if n <= 0:
        return [np.zeros(0, np.uint64) for _ in lengths]
    h = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(max(lengths)):
            h ^= words[k : k + n]
            h *= np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
            if k + 1 in lengths:
                out.append(h.copy())
    return out


#: A document: its id, and a hash of its id and text that tells rows of one id apart.
DOC = np.dtype([("id", "<i8"), ("row", "<i8")])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of documents: these, numbers of words, the hashes of all words; documents in ascending order."""
    ids, parts, size, hashes = [], [], 0, worker_own("substring", WordHashes)
    for b in batches:
        for doc_id, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
            words = (text or b"").split()
            if len(words) >= WINDOW:
                ids.append((doc_id, row))
                parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
                size += len(words)
            if size >= BATCH_WORDS:
                yield _ordered(ids, parts)
                ids, parts, size = [], [], 0
    if ids:
        yield _ordered(ids, parts)


def _ordered(ids: list, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.array(ids, DOC)
    order = np.lexsort([ids["row"], ids["id"]])
    return ids[order], np.array([len(parts[k]) for k in order]), np.concatenate([parts[k] for k in order])


def _starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows inside one document: place in the batch, the document's number, start in the document."""
    n = sizes - WINDOW + 1
    doc = np.repeat(np.arange(len(sizes)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.cumsum(sizes) - sizes, n) + start, doc, start


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many suffixes have each short and each middle prefix, by table entry (the middle table behind the short one)."""
    total = np.zeros(SHORT_TABLE + MIDDLE_TABLE, np.int64)
    for _, sizes, words in _texts(batches):
        place, _, _ = _starts(sizes)
        short, middle = labels(words, (SHORT, MIDDLE))
        total[:SHORT_TABLE] += np.bincount((short[place] % np.uint64(SHORT_TABLE)).astype(np.int64), minlength=SHORT_TABLE)
        total[SHORT_TABLE:] += np.bincount((middle[place] % np.uint64(MIDDLE_TABLE)).astype(np.int64), minlength=MIDDLE_TABLE)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])


class Groups:
    """Which group a suffix belongs to, by the shortest prefix that is rare enough. Two tables of fixed size."""

    def __init__(self, counts: np.ndarray):
        short, middle = counts[:SHORT_TABLE], counts[SHORT_TABLE:]
        most = max(1, min(GROUP, -(-int(short.sum()) // MIN_GROUPS)))
        self.short, n = self._pack(short, most, 0)
        self.short[short > most] = -1
        self.middle, n = self._pack(middle, most, n)
        self.split = np.maximum(1, -(-middle // most))
        wide = np.flatnonzero(self.split > 1)
        self.middle[wide] = n + np.cumsum(self.split[wide]) - self.split[wide]
        self.count = int(n + self.split[wide].sum())

    @staticmethod
    def _pack(counts: np.ndarray, most: int, first: int) -> tuple[np.ndarray, int]:
        fit = np.where(counts <= most, counts, 0)
        group = first + (np.cumsum(fit) - fit) // most
        return group.astype(np.int64), int(group[-1]) + 1

    def of(self, short: np.ndarray, middle: np.ndarray, whole: np.ndarray) -> np.ndarray:
        group = self.short[(short % np.uint64(SHORT_TABLE)).astype(np.int64)]
        deep = np.flatnonzero(group < 0)
        if len(deep):
            entry = (middle[deep] % np.uint64(MIDDLE_TABLE)).astype(np.int64)
            group[deep] = self.middle[entry] + ((whole[deep] >> np.uint64(20)) % self.split[entry].astype(np.uint64)).astype(np.int64)
        return group


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return np.flatnonzero(first)


def _packed(ids: np.ndarray, starts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Documents, how many starts each has, and the starts; ``ids`` come in runs. Starts take two bytes where they fit."""
    at = _runs(ids["row"])
    sizes = np.diff(np.append(at, len(ids))).astype("<u4")
    wide = len(starts) and int(starts.max()) > 0xFFFF
    return ids[at].tobytes(), sizes.tobytes(), starts.astype("<u4" if wide else "<u2").tobytes()


def _unpacked(ids: bytes, sizes: bytes, starts: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.frombuffer(sizes, "<u4")
    n = int(sizes.sum())
    return np.repeat(np.frombuffer(ids, DOC), sizes), np.frombuffer(starts, "<u4" if len(starts) == 4 * n and n else "<u2").astype(np.int64)


def _records(groups: Groups, buckets: int):
    """A row for each group and batch: labels of the suffixes, their documents and starts.

    Those that repeat within the batch need no decision any more: they get rows of their own, by final bucket behind the groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, words in _texts(batches):
            place, doc, start = _starts(sizes)
            short, middle, whole = (h[place] for h in labels(words, (SHORT, MIDDLE, WINDOW)))
            group = groups.of(short, middle, whole)
            del short, middle, words
            order = np.argsort(whole, kind="stable")  # equal labels stay in order of document and start
            head = np.zeros(len(order), bool)
            head[_runs(whole[order])] = True
            again = np.zeros(len(order), bool)
            again[order] = ~head
            if len(ids) > 1 and (ids["id"][1:] == ids["id"][:-1]).any():  # rows of one id: a window doesn't repeat itself at its own place
                again[order] = ~_first_place(whole[order], ids["id"][doc[order]], start[order])
            first = np.flatnonzero(~again)
            first = first[np.argsort(group[first], kind="stable")]
            rows = [(int(group[own[0]]), whole[own].tobytes(), *_packed(ids[doc[own]], start[own])) for own in _parts(first, group)]
            late = np.flatnonzero(again)
            bucket = groups.count + _bucket(ids["row"], buckets)[doc]
            late = late[np.argsort(bucket[late], kind="stable")]
            rows += [(int(bucket[own[0]]), b"", *_packed(ids[doc[own]], start[own])) for own in _parts(late, bucket)]
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["group", *RECORD])

    return run


RECORD = ["labels", "ids", "sizes", "starts"]


def _parts(order: np.ndarray, value: np.ndarray) -> list[np.ndarray]:
    """``order`` cut where the value of its members changes."""
    return np.split(order, _runs(value[order])[1:]) if len(order) else []


def _first_place(label: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True where id and start are the least of all with the same label."""
    order = np.lexsort([start, ids, label])
    at = _runs(label[order])
    first = order[np.repeat(at, np.diff(np.append(at, len(order))))]
    out = np.zeros(len(label), bool)
    out[order] = (ids[order] == ids[first]) & (start[order] == start[first])
    return out


def _subtree(count: int, buckets: int):
    """Repeats of one group: leaves of deep internal nodes but for each node's first, packed by the documents' final bucket.

    A group from ``count`` on holds places that are known to repeat, of one final bucket.
    """

    def run(table: pa.Table) -> pa.Table:
        claim("subtrees")  # hashed words are of no use here
        cols = [[x.as_buffer() for x in table.column(n)] for n in RECORD]
        if table.column("group")[0].as_py() >= count:
            known = [_unpacked(*x) for x in zip(*cols[1:])]
            ids, start = (np.concatenate([k[i] for k in known]) for i in (0, 1))
        else:
            label = np.concatenate([np.frombuffer(x, np.uint64) for x in cols[0]])
            order = np.argsort(label, kind="stable")
            at = _runs(label[order])
            size = np.diff(np.append(at, len(order)))
            leaves = np.sort(order[np.repeat(size > 1, size)])  # below an internal node
            del order, at, size
            label = label[leaves]
            ends = np.cumsum([len(x) // 8 for x in cols[0]])
            ids, start = np.empty(len(leaves), DOC), np.empty(len(leaves), np.int64)
            for k, x in enumerate(zip(*cols[1:])):  # places of the leaves only
                lo, hi = np.searchsorted(leaves, [ends[k - 1] if k else 0, ends[k]])
                if hi > lo:
                    own = _unpacked(*x)
                    where = leaves[lo:hi] - (ends[k - 1] if k else 0)
                    ids[lo:hi], start[lo:hi] = own[0][where], own[1][where]
            late = ~_first_place(label, ids["id"], start)
            ids, start = ids[late], start[late]
        bucket = _bucket(ids["row"], buckets)
        order = np.lexsort([start, ids["row"], ids["id"], bucket])
        ids, start, bucket = ids[order], start[order], bucket[order]
        rows = [(int(bucket[own[0]]), *_packed(ids[own], start[own])) for own in _parts(np.arange(len(bucket)), bucket)]
        cols = list(zip(*rows)) if rows else [[]] * 4
        hand_back()
        return pa.table([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "ids", "sizes", "starts"])

    return run


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _apply(schema: pa.Schema, text: int, joined: bool):
    """Take covered words out of the texts of one bucket."""

    def run(docs: pa.Table, covered: pa.Table) -> pa.Table:
        claim("subtrees")
        at: dict[int, list] = {}
        for row in zip(*(covered.column(n).to_pylist() for n in ("ids", "sizes", "starts"))):
            ids, start = _unpacked(*row)
            cuts = np.append(_runs(ids["row"]), len(ids))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                at.setdefault(int(ids["row"][lo]), []).append(start[lo:hi])
        out, n_words, n_removed, spans = [], [], [], []
        for row, own in zip(docs.column(docs.num_columns - 2).to_pylist(), docs.column(text).cast(pa.binary()).to_pylist()):
            words = (own or b"").split()
            gone = None
            if starts := at.get(row):
                starts = np.concatenate(starts)
                edge = np.zeros(len(words) + 1, np.int32)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + WINDOW, -1)
                gone = np.cumsum(edge)[:-1] > 0
            n_words.append(len(words))
            if gone is None or not gone.any():
                out.append(b" ".join(words) if joined else own)
                n_removed.append(0)
                spans.append([])
            else:
                out.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
                n_removed.append(int(gone.sum()))
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append(turns.tolist())
        hand_back()
        cols = [docs.column(k) for k in range(docs.num_columns - 2)]
        cols[text] = pa.chunked_array([pa.array(out, pa.binary()).cast(pa.string())])
        return pa.table([*cols, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.int32()))], schema=schema)

    return run


#: Columns that the operator adds.
ADDED = ["n_words", "n_removed", "removed_spans"]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", *, joined: bool = True) -> DataFrame:
    """``docs`` without the words of windows that also start earlier; adds n_words, n_removed and removed_spans.

    ``removed_spans`` holds starts and ends (in words) of the maximal repeats that went. The kept words are joined by one
    space; with ``joined`` false, a text that loses nothing stays as it is.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "substring")
    docs = docs.drop(*ADDED)
    number = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID))
    row = F.xxhash64(number, F.col(f"`{text}`"))
    plain = docs.select(number.alias("id"), row.alias("row"), F.col(f"`{text}`").alias("text"))
    size = docs.agg(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    counts = np.zeros(SHORT_TABLE + MIDDLE_TABLE, np.int64)
    for at, n in plain.mapInArrow(tidy(_count), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # as many rows as the tables have entries
        counts[at] = n
    groups, buckets = Groups(counts), int(max(MIN_GROUPS, -(-size // BUCKET_BYTES)))
    records = plain.mapInArrow(tidy(_records(groups, buckets)), "group int, " + ", ".join(f"{n} binary" for n in RECORD))
    found = records.repartition(max(MIN_GROUPS, groups.count), "group").groupBy("group").applyInArrow(_subtree(groups.count, buckets), "bucket int, ids binary, sizes binary, starts binary")
    covered = scratch.save(found, "covered")
    del records, found
    release_shuffles(spark)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_bucket(own, buckets))], [*b.schema.names, "bucket"])

    # Columns travel under numbers, so that names of the input cannot clash with those of the operator.
    names, kinds = docs.columns, [f.dataType.simpleString() for f in docs.schema]
    kinds[names.index(key)] = "bigint"
    inner = [F.col(f"`{n}`").cast("long").alias(f"c{k}") if n == key else F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)]
    columns = ", ".join(f"c{k} {kind}" for k, kind in enumerate(kinds))
    numbered = docs.select(*inner, row.alias("row")).mapInArrow(dealt, f"{columns}, row bigint, bucket int")
    result = f"{columns}, n_words long, n_removed long, removed_spans array<int>"
    schema = to_arrow_schema(spark.createDataFrame([], result).schema)
    pairs = numbered.groupBy("bucket").cogroup(covered.groupBy("bucket"))
    return pairs.applyInArrow(_apply(schema, names.index(text), joined), result).toDF(*names, *ADDED)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = remove_repeats(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
