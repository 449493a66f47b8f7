"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints with at most ``d`` differing bits share at
least ``8 - d`` of them, so of any ``3 + d`` positions they share three: the index has postings of the values at
three of these positions. Exact copies are folded before it is built (one entry for each distinct fingerprint).
Members of a posting share three bytes for certain; shared bytes of all positions are counted by pair, pairs below
``8 - d`` are dropped, the others are verified on their bits, and the links' spanning forest goes on. A dense posting
is split by the values at further positions until the count is sure, in parts that then hold at most 2 to the power
``8 d`` fingerprints.

Defined results: a text without words (or null) has fingerprint 0 and links like any other; fewer words than
a shingle's give one shingle of them all; repeated rows share their fingerprint and component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm._store import Scratch, small_batches, tidy, worker_own
from terrace.llm.graph import components

#: Shingle hashes that are unpacked to bits at a time.
CHUNK = 1 << 15
#: Postings up to this size are counted as one table; larger ones are split.
TABLE = 512
#: Positions whose values make a posting.
KEYED = 3


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64 values."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(s, seed) for s in map(b" ".join, zip(*(words[k:] for k in range(shingle))))])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), CHUNK):
        ones += np.unpackbits(rows[at : at + CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed long) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t or b"", shingle, seed) for t in b.column(1).cast(pa.binary()).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, fp long").withColumnRenamed("key", key)


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the verified pairs among distinct fingerprints."""
    root = list(range(len(fps)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def link(i: int, j: int) -> bool:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
        return i != j

    out = []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        out.extend(p for p in zip(i.tolist(), j.tolist()) if link(*p))

    todo = [np.arange(len(fps))]
    while todo:
        part = todo.pop()
        own = fps[part]
        if len(own) <= TABLE:
            differ = np.bitwise_count(own[:, None] ^ own[None, :])
            add(*(part[x] for x in np.nonzero(np.triu(enough(own, distance) & (differ <= distance), 1))))
            continue
        varying = int(np.bitwise_or.reduce(own ^ own[0]))
        places = [0xFF << k for k in range(0, 64, 8) if varying & 0xFF << k]
        if len(places) > distance:  # the count is not sure yet: a pair shares all but ``distance`` of these positions
            for keep in combinations(places, len(places) - distance):
                key = own & np.uint64(sum(keep))
                order = np.argsort(key, kind="stable")
                starts = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
                todo += [part[np.sort(x)] for x in np.split(order, starts[1:]) if len(x) > 1]
            continue
        # The values differ in few positions, so every neighbour is one of a bounded number of bit patterns.
        bits = [k for k in range(64) if varying >> k & 1]
        order = np.argsort(own)
        for k in range(1, distance + 1):
            for flips in combinations(bits, k):
                other = own ^ np.uint64(sum(1 << x for x in flips))
                at = np.minimum(np.searchsorted(own, other, sorter=order), len(own) - 1)
                hits = np.flatnonzero((own[order[at]] == other) & (own < other))
                add(part[hits], part[order[at[hits]]])
    return out


def enough(fps: np.ndarray, distance: int) -> np.ndarray:
    """The count filter: which pairs share as many positional bytes as fingerprints at this distance do."""
    octets = fps.view(np.uint8).reshape(-1, 8)
    shared = np.zeros((len(fps), len(fps)), np.uint8)
    for k in range(8):
        shared += octets[:, None, k] == octets[None, :, k]
    return shared >= 8 - distance


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints of column ``fp``, a spanning forest of each posting."""
    if not 0 < distance <= 3:
        raise ValueError("the index is made for one to three differing bits")
    masks = [int.from_bytes(bytes(255 * (k in keep) for k in range(8)), "big", signed=True) for keep in combinations(range(KEYED + distance), KEYED)]
    postings = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("positions", "bytes")
    held = distinct.select("fp", postings).groupBy("positions", "bytes").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, found = b.column(0), []
            flat, ends = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy() - column.offsets[0].as_py()
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
                fps = np.sort(flat[lo:hi])
                found += [(fps[i], fps[j]) for i, j in _forest(fps, distance)]
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], ["a", "b"])

    return held.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 3, seed: int = 42, distance: int = 2) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest key reachable) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    fps = scratch.save(fingerprints(docs, key, text, shingle=shingle, seed=seed), "fps")
    classes = scratch.save(fps.groupBy("fp").agg(F.min(key).alias("first")), "classes")
    roots = components(links(classes.select("fp"), distance), scratch, "links")
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch.save(rooted.join(least, "root").select(F.col("fp").alias("__fp"), "component_id"), "named")
    return fps.join(named, fps.fp == named["__fp"]).select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Postings of near copies up to this size give all their pairs at once; larger ones those with so many members first.
SMALL, HUBS = 24, 3
#: Texts that are asked which shingles are common, in how many of them one is, and how many such shingles are kept.
ASKED, COMMON, MOST_COMMON = 4000, 4, 200_000
#: Entries that a task collects before it hands them on, and blocks of them by partition.
ENTRIES, BLOCKS = 400_000, 4
#: Bits of a set's parities.
PARITIES = 512
#: Words of the fixed bitmap that keeps texts without an open pair from being shuffled.
BITMAP = 1 << 16
#: What is sent of a shingle in the prefix of a text: its hash, the text, the size of the text's set and the place in its order.
_ENTRY = np.dtype([("token", np.uint64), ("h1", np.int64), ("h2", np.int64), ("size", np.uint32), ("at", np.uint32)])
_LOW = np.uint64(0x0101010101010101)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 120_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 3)
        return h


def _lanes(h: np.ndarray, n: int) -> np.ndarray:
    """``n`` independent 64-bit hashes from each hash, (n, hashes)."""
    with np.errstate(over="ignore"):
        x = h[None, :] + (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sketch(h: np.ndarray, n: int) -> np.ndarray:
    """SimHash of a set of hashes in ``n`` lanes, as bytes: a bit is 1 if it is set in over half of the hashes.

    Bits are counted in the bytes of a word, 255 hashes at a time.
    """
    ones = np.zeros((n, 8, 8), np.int64)
    for at in range(0, len(h), 255 * 64):
        x = _lanes(h[at : at + 255 * 64], n)
        x = np.concatenate([x, np.zeros((n, -x.shape[1] % 255), np.uint64)], axis=1).reshape(n, -1, 255)
        for b in range(8):
            ones[:, b] += (x >> np.uint64(b) & _LOW).sum(axis=2).view(np.uint8).reshape(n, -1, 8).sum(axis=1, dtype=np.int64)
    return np.packbits((2 * ones > len(h)).reshape(n * 8, 8), axis=1).reshape(-1)


def _common(docs: DataFrame, text: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are in many texts of a sample, ascending, and in how many. They only order the shingles of a text."""
    share = ASKED / max(1, docs.count())
    asked = docs.where(F.pmod(F.col("__h1"), F.lit(1_000_003)) < F.lit(int(min(1.0, share) * 1_000_003) + 1)).select("__h1", "__h2", text)
    tokens = asked.mapInArrow(tidy(_shingle_rows(shingle)), "token long").groupBy("token").count().where(F.col("count") >= COMMON)
    held = tokens.orderBy(F.desc("count"), "token").limit(MOST_COMMON).collect()
    found = np.array([r[0] for r in held], np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], np.array([r[1] for r in held], np.int64)[order]


def _shingle_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(2).cast(pa.binary()).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_shingle_set(t or b"", shingle).view(np.int64))], ["token"])

    return run


def _prefix(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set, rare ones first: two sets of this Jaccard similarity share one of them at least."""
    n = len(tokens) - math.ceil(similarity * len(tokens) - 1e-9) + 1
    known, counts = common
    if not len(known):
        return tokens[:n]
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return tokens[np.argsort(np.where(known[at] == tokens, counts[at], 0), kind="stable")[:n]]


def _prefixes(shingle: int, similarity: float, common, blocks: int):
    """Entries of all texts' prefixes, in blocks by shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, n = [], set(), 0

        def blocked():
            entries = np.concatenate(held) if held else np.zeros(0, _ENTRY)
            block = (entries["token"] % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            entries, block = entries[order], block[order]
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            parts = [x.tobytes() for x in np.split(entries, starts[1:])] if len(starts) else []
            return pa.RecordBatch.from_arrays([pa.array(block[starts], pa.int32()), pa.array(parts, pa.binary())], ["block", "entries"])

        for b in batches:
            for h1, h2, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                if (h1, h2) in texts:
                    continue
                texts.add((h1, h2))
                tokens = _shingle_set(text or b"", shingle)
                first = _prefix(tokens, common.value, similarity)
                rows = np.empty(len(first), _ENTRY)
                rows["token"], rows["h1"], rows["h2"], rows["size"], rows["at"] = first, h1, h2, len(tokens), np.arange(len(first))
                held.append(rows)
                n += len(rows)
                if n >= ENTRIES:
                    yield blocked()
                    held, texts, n = [], set(), 0
        yield blocked()

    return run


def _possible(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether two texts can be as similar if the shingle of these entries is the first that they share.

    No similar pair is lost: it is let through at the first shingle that it shares, whatever is said at others.
    """
    sx, sy = x["size"].astype(np.int64), y["size"].astype(np.int64)
    shared = np.minimum(sx - x["at"], sy - y["at"])
    return shared >= similarity * (sx + sy - shared) - 1e-9


def _first_pairs(similarity: float):
    """Pairs of texts that meet in a posting, ``large`` false: all of a small one, of a large one those with a few members.

    Members of large postings come out as well, ``large`` true: text, shingle, and size and place in one number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for b in batches for x in b.column(1).to_pylist()]
        entries = np.frombuffer(b"".join(blobs), _ENTRY)
        del blobs
        entries = entries[np.lexsort([entries["h2"], entries["h1"], entries["token"]])]
        same = np.ones(len(entries), bool)
        for f in ("token", "h1", "h2"):
            same[1:] &= entries[f][1:] == entries[f][:-1]
        if len(entries):
            same[0] = False
        entries = entries[~same]  # a text once in each posting
        starts = np.flatnonzero(np.diff(entries["token"], prepend=~entries["token"][:1])) if len(entries) else np.zeros(0, np.int64)
        sizes = np.diff(starts, append=len(entries))
        of = np.repeat(sizes, sizes)
        small = entries[(of > 1) & (of <= SMALL)]
        pairs = []

        def add(x, y):
            ok = _possible(x, y, similarity)
            pairs.append(np.column_stack([x["h1"][ok], x["h2"][ok], y["h1"][ok], y["h2"][ok]]))

        for d in range(1, SMALL):
            i = np.flatnonzero(small["token"][:-d] == small["token"][d:])
            add(small[i], small[i + d])
        for lo, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            members = entries[lo : lo + n]
            turn = np.argsort(members["h1"].view(np.uint64) * np.uint64(2 * lo + 1) ^ members["token"])[: HUBS - 1]
            for hub in np.union1d([0], turn).tolist():
                x = np.repeat(members[hub : hub + 1], n)
                after = np.arange(n) > hub
                add(members[~after][:-1], x[~after][:-1])
                add(x[after], members[after])
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 4), np.int64)
        for lo in range(0, len(found), 65_536):
            part = found[lo : lo + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(part), bool)), *(pa.array(np.ascontiguousarray(part[:, k])) for k in range(4))], ["large", "a1", "a2", "b1", "b2"])
        rest = entries[of > SMALL]
        for lo in range(0, len(rest), 65_536):
            part = rest[lo : lo + 65_536]
            cols = [part["h1"], part["h2"], part["token"].view(np.int64), part["size"].astype(np.int64) << 32 | part["at"].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(part), bool)), *(pa.array(np.ascontiguousarray(c)) for c in cols)], ["large", "a1", "a2", "b1", "b2"])

    return run


def _other_pairs(similarity: float):
    """All pairs of a large posting whose texts are in different groups by now, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = []
            for members in b.column(0):
                rows = members.values
                h1, h2, packed, r1, r2 = (rows.field(k).to_numpy() for k in (0, 1, 2, 4, 5))
                parities = np.frombuffer(b"".join(rows.field(3).to_pylist()), np.uint64).reshape(-1, PARITIES // 64)
                m = np.empty(len(rows), _ENTRY)
                m["h1"], m["h2"], m["size"], m["at"] = h1, h2, packed >> 32, packed & 0xFFFFFFFF
                order = np.lexsort([h2, h1])
                m, parities = m[order], parities[order]
                root, sizes = np.unique(np.column_stack([r1, r2])[order], axis=0, return_inverse=True, return_counts=True)[1:]
                root = root.reshape(-1)
                most = int(sizes.argmax())
                for i in np.flatnonzero(root != most).tolist():
                    j = np.flatnonzero((root != root[i]) & ((root == most) | (np.arange(len(m)) > i)))
                    j = j[_possible(np.repeat(m[i : i + 1], len(j)), m[j], similarity)]
                    differ = np.bitwise_count(parities[j] ^ parities[i]).sum(axis=1, dtype=np.int64)  # of both sets together, at least
                    both = m["size"][j].astype(np.int64) + int(m["size"][i])
                    j = j[(both - differ) >= similarity * (both + differ) - 1e-9]
                    x, y = m[np.minimum(i, j)], m[np.maximum(i, j)]
                    pairs.append(np.column_stack([x["h1"], x["h2"], y["h1"], y["h2"]]))
            found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in range(4)], ["a1", "a2", "b1", "b2"])

    return run


def _shingle_set(text: bytes, shingle: int) -> np.ndarray:
    words = text.lower().split()
    hashes = worker_own("near copies", _Hashes)
    h, k = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), min(shingle, len(words))
    chain = np.zeros(max(1, len(h) - shingle + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            chain = (chain ^ h[j : j + len(chain)]) * np.uint64(0xFF51AFD7ED558CCD)
            chain ^= chain >> np.uint64(32)
    return np.unique(chain)


def _parities(tokens: np.ndarray) -> bytes:
    """Parity of the number of hashes in each of ``PARITIES`` classes: two sets differ in as many hashes as bits, at least."""
    return np.packbits(np.bincount((tokens >> np.uint64(20) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1).tobytes()


def _profile(tokens: np.ndarray) -> bytes:
    """How many hashes are in each class, two to four a class on average: sets differ in as many hashes as their profiles, at least."""
    classes = 8
    while 4 * classes < len(tokens):
        classes *= 2
    return np.minimum(np.bincount((tokens >> np.uint64(20) & np.uint64(classes - 1)).astype(np.int64), minlength=classes), 255).astype(np.uint8).tobytes()


def _may_be_similar(x: bytes, y: bytes, similarity: float) -> bool:
    """False only where the profiles show that the sets cannot be as similar."""
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (x, y))
    if max(x.max(), y.max()) == 255:
        return True
    while len(x) > len(y):
        x = x.reshape(2, -1).sum(axis=0)
    while len(y) > len(x):
        y = y.reshape(2, -1).sum(axis=0)
    both, differ = int(x.sum() + y.sum()), int(np.abs(x - y).sum())
    return both - differ >= similarity * (both + differ) - 1e-9


def _of_sets(shingle: int, make):
    """Rows of texts with what ``make`` gives of their sets of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [make(_shingle_set(t or b"", shingle)) for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(held, pa.binary())], ["s1", "s2", "held"])

    return run


def _similar(x: bytes, y: bytes, similarity: float) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both)


def _kept_pairs(test, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [test(x, y, similarity) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays(b.columns[:4], names=["a1", "a2", "b1", "b2"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(sides: DataFrame, marked: DataFrame, first: DataFrame, key: str, text: str, shingle: int, make) -> DataFrame:
    """``held``: what ``make`` gives of the set of shingles of the different texts ``s1, s2``.

    Only these texts are shuffled, one row of each: a bitmap of fixed size holds back the others.
    """
    slot = F.pmod(F.col("s1"), F.lit(64 * BITMAP))
    held = sides.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(s1, {64 * BITMAP}) & 63 as int))")).alias("bits"))
    bitmap = np.zeros(BITMAP, np.int64)
    for word, bits in held.collect():  # BITMAP rows at most
        bitmap[word] = bits
    # One row, looked up in the JVM: a Python function here would hold a second worker beside that of the kernel below.
    bitmap = marked.sparkSession.createDataFrame([(bitmap.tolist(),)], "__bits array<long>")
    maybe = F.expr(f"shiftrightunsigned(get(__bits, cast(shiftright(pmod(__h1, {64 * BITMAP}), 6) as int)), cast(pmod(__h1, 64) as int)) & 1") == 1

    ids = first.join(sides, (first.h1 == sides.s1) & (first.h2 == sides.s2), "left_semi").select("h1", "h2", F.col("id").alias("__id"))
    some = marked.select("__h1", "__h2", F.col(key).alias("__own"), F.col(text).alias("__text")).join(F.broadcast(bitmap), maybe).drop("__bits")
    one = some.join(ids, (F.col("__h1") == F.col("h1")) & (F.col("__h2") == F.col("h2")) & F.col("__own").eqNullSafe(F.col("__id")))
    return one.select("h1", "h2", "__text").mapInArrow(tidy(_of_sets(shingle, make)), "s1 long, s2 long, held binary").dropDuplicates(["s1", "s2"])


def _tested(pairs: DataFrame, sets_of, make, test, similarity: float, scratch: Scratch, tag: str) -> DataFrame:
    """Those of the pairs that pass a test of what is held of their sets."""
    sides = pairs.select(F.col("a1").alias("s1"), F.col("a2").alias("s2")).unionByName(pairs.select(F.col("b1").alias("s1"), F.col("b2").alias("s2"))).distinct()
    held = scratch.save(sets_of(sides, make), f"{tag}-held")
    left = pairs.join(held.withColumnRenamed("held", "x"), (F.col("a1") == F.col("s1")) & (F.col("a2") == F.col("s2"))).drop("s1", "s2")
    both = left.join(held.withColumnRenamed("held", "y"), (F.col("b1") == F.col("s1")) & (F.col("b2") == F.col("s2"))).select("a1", "a2", "b1", "b2", "x", "y")
    out = scratch.save(both.mapInArrow(tidy(_kept_pairs(test, similarity)), "a1 long, a2 long, b1 long, b2 long"), tag)
    scratch.drop(f"{tag}-held")
    return out


def _verified(pairs: DataFrame, sets_of, similarity: float, scratch: Scratch, tag: str) -> DataFrame:
    """Those of the open pairs whose sets of shingles are as similar as asked for. Profiles, a small part of the sets, go first."""
    close = _tested(pairs, sets_of, _profile, _may_be_similar, similarity, scratch, f"{tag}-close")
    return _tested(close, sets_of, np.ndarray.tobytes, _similar, similarity, scratch, tag)


def _rooted(links: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``n1, n2, root`` of every text that has a link: the smallest text that it is connected with."""
    ends = [F.struct(F.col(f"{x}1").alias("h1"), F.col(f"{x}2").alias("h2")).alias(x) for x in "ab"]
    return components(links.select(*ends), scratch, tag).select(F.col("node.h1").alias("n1"), F.col("node.h2").alias("n2"), "root")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one of smallest ``key`` (null last).

    Exact copies are folded. The shingles of each different text are ordered, those common in a sample last; two texts as similar
    as asked for share one of their first shingles, so the postings of these hold every such pair. Sizes and places in the order
    rule out pairs that cannot be; the sets of all others are compared exactly. Large postings go in two rounds: pairs with a few
    of the members first, then all that are still in different groups. Rows that repeat key and text count as one document; a
    null text is an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "copies")
    marked = docs.withColumn("__h1", F.xxhash64(F.coalesce(text, F.lit("")))).withColumn("__h2", F.xxhash64(F.lit("second"), F.coalesce(text, F.lit(""))))
    first = scratch.save(marked.select(F.col("__h1").alias("h1"), F.col("__h2").alias("h2"), F.col(key).alias("id")).groupBy("h1", "h2").agg(F.min("id").alias("id")), "first")
    common = spark.sparkContext.broadcast(_common(marked, text, shingle))  # MOST_COMMON at most
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = marked.select("__h1", "__h2", text).mapInArrow(tidy(_prefixes(shingle, similarity, common, BLOCKS * parts)), "block int, entries binary")
    found = entries.repartition(parts, "block").mapInArrow(tidy(_first_pairs(similarity)), "large boolean, a1 long, a2 long, b1 long, b2 long")
    found, pair = scratch.save(found, "pairs"), ["a1", "a2", "b1", "b2"]
    sets_of = lambda sides, make: _sets(sides, marked, first, key, text, shingle, make)
    verify = lambda pairs, tag: _verified(pairs, sets_of, similarity, scratch, tag)
    tried = scratch.save(found.where("not large").select(*pair).distinct(), "tried")
    joined = _rooted(verify(tried, "similar"), scratch, "links")
    # Large postings once more: what is still apart there is compared wholly.
    large = found.where("large").select(F.col("a1").alias("h1"), F.col("a2").alias("h2"), F.col("b1").alias("token"), F.col("b2").alias("place"))
    members = scratch.save(sets_of(large.select(F.col("h1").alias("s1"), F.col("h2").alias("s2")).distinct(), _parities).withColumnRenamed("held", "parities"), "members")
    known = members.join(joined, (members.s1 == joined.n1) & (members.s2 == joined.n2), "left").drop("n1", "n2")
    placed = large.join(known, (large.h1 == known.s1) & (large.h2 == known.s2))
    member = F.struct("h1", "h2", "place", "parities", F.coalesce("root.h1", "h1").alias("r1"), F.coalesce("root.h2", "h2").alias("r2"))
    again = placed.groupBy("token").agg(F.collect_list(member).alias("m")).select("m").mapInArrow(tidy(_other_pairs(similarity)), "a1 long, a2 long, b1 long, b2 long").distinct()
    rest = scratch.save(again.join(tried, pair, "left_anti"), "rest")
    roots = joined
    if not rest.isEmpty():
        stars = joined.select(F.col("root.h1").alias("a1"), F.col("root.h2").alias("a2"), F.col("n1").alias("b1"), F.col("n2").alias("b2"))
        roots = _rooted(stars.unionByName(verify(rest, "similar2")), scratch, "links2")
    rooted = first.join(roots, (first.h1 == roots.n1) & (first.h2 == roots.n2), "left").withColumn("root", F.coalesce("root", F.struct("h1", "h2")))
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")).alias("k"))
    kept = scratch.save(kept.select(F.col("k.id").alias("__id"), F.col("k.h1").alias("__k1"), F.col("k.h2").alias("__k2")), "kept")
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2"))
    return marked.join(kept, same).dropDuplicates([key, "__h1", "__h2"]).select(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
