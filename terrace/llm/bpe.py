"""Byte-level BPE by DuckDB recursive queries, one engine in each Python worker.

Texts are split by the tokenizer's pattern. Of a batch's distinct pieces, those that are tokens themselves are
taken as they are; the others become token-position rows of a recursive query that joins them to the merge
table and contracts each piece's leftmost pair of minimum rank, step by step, until no pair of a piece is in the
table. An ordered aggregation gives the ids and, by the ids' bytes, the decoded piece.

A step also contracts the pairs whose turn is sure to come: those of lower rank than anything that their left token could
join with after the byte before it, or their right token before the byte behind it (``lefts`` and ``rights`` hold these least
ranks by token and byte). As a pair's result only joins at higher ranks, the ids are those of one pair at a time; it takes a few
steps for most pieces of any length. A query takes pieces by their bytes; one that outgrows its memory is halved. Pieces of
over ``LONG`` bytes, and one that alone outgrows a query, are contracted by the same rule along a linked list and a heap.

Defined results: a null text counts as empty, has no ids and decodes to nothing; repeated rows encode alike; columns
other than the key and the text, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type

from terrace.llm._store import ARROW_ROWS, small_batches, tidy, worker_own

#: Distinct pieces that a worker keeps, and the bytes from which a piece is long (a position takes ten bits of a row's key).
CACHE, LONG = 250_000, 1024
#: New pieces after which a query is worth its cost, pieces of texts that wait for it, and bytes of the pieces of one query.
FRESH, HELD, QUERY_BYTES = 40_000, 2_000_000, 400_000
#: Megabytes that DuckDB may take.
ENGINE_MB = 200

#: A row is a token of piece ``k // 1024`` after ``n`` contractions of its piece: the key ``k`` (piece and position of its first
#: byte), the token, the next token, the bytes before it, after it and after the next token, the rank of the pair (also
#: the id of what it contracts to), and whether its turn is sure to come. Pieces without a mergeable pair are done.
STEPS = """
WITH RECURSIVE step(k, n, t, r, before, after, beyond, m, sure) AS (
  SELECT s.k, CAST(0 AS SMALLINT), s.t, s.r, s.before, s.after, s.beyond, {rank}
  FROM (
    SELECT k, t, lead(t) OVER o AS r, lag(b) OVER o AS before, lead(b) OVER o AS after, lead(b, 2) OVER o AS beyond
    FROM start WINDOW o AS (PARTITION BY k // 1024 ORDER BY k)) s {merges}
  UNION ALL
  SELECT s.k, s.n, s.t, s.r, s.before, s.after, s.beyond, {rank}
  FROM (
    SELECT k, n, t, before, after, go,
           CASE WHEN after IS NOT NULL THEN CASE WHEN go THEN lead(t, 2) OVER o ELSE lead(t) OVER o END END AS r,
           CASE WHEN after IS NOT NULL THEN CASE WHEN go THEN lead(after, 2) OVER o ELSE lead(after) OVER o END END AS beyond,
           lag(go) OVER o AS gone
    FROM (
      SELECT k, CAST(n + 1 AS SMALLINT) AS n, CASE WHEN go THEN m ELSE t END AS t, before, CASE WHEN go THEN beyond ELSE after END AS after, go
      FROM (
        SELECT step.*, m IS NOT NULL AND (sure OR m * 1024 + k % 1024 = least.v) AS go
        FROM step JOIN (SELECT k // 1024 AS w, min(m * 1024 + k % 1024) AS v FROM step WHERE m IS NOT NULL GROUP BY ALL) least ON least.w = step.k // 1024))
    WINDOW o AS (ORDER BY k)) s {merges}
  WHERE s.gone IS NOT TRUE)
""".format(
    rank="merges.m, merges.m < coalesce(lefts.m, 65536) AND merges.m <= coalesce(rights.m, 65536)",
    merges="""
  LEFT JOIN merges ON merges.pair = CAST(s.t AS UINTEGER) * 65536 + CAST(s.r AS UINTEGER)
  LEFT JOIN lefts ON lefts.pair = s.before * 65536 + s.t
  LEFT JOIN rights ON rights.pair = s.r * 256 + s.beyond""",
)

#: What the pieces came to: each token's id and the bytes (in hex) that it stands for, in order.
ENCODED = """
SELECT w, string_agg(spelled, ' ' ORDER BY k)
FROM (SELECT k // 1024 AS w, k, n, t FROM step) JOIN (SELECT k // 1024 AS w, max(n) AS n FROM step GROUP BY ALL) USING (w, n) JOIN tokens USING (t) GROUP BY w
"""
#: Parts ids from decoded bytes in what is kept of a piece: no byte of a text in UTF-8.
END = b"\xff"
NO_RANK = 1 << 32


def last_pair(token: bytes, ranks: dict[bytes, int]) -> list[bytes] | None:
    """The two tokens that a token's own bytes contract to before the last step: its one pair that contraction can meet.

    Two neighbours that make up a token came from their own bytes alone, by the order in which the token's bytes contract.
    """
    part = [token[k : k + 1] for k in range(len(token))]
    while len(part) > 2:
        found = [ranks.get(a + b, NO_RANK) for a, b in zip(part, part[1:])]
        if (least := min(found)) == NO_RANK:
            return None
        k = found.index(least)
        part[k : k + 2] = [part[k] + part[k + 1]]
    return part


class Merges:
    """The rank file as tables of a DuckDB connection, and the pieces encoded so far."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(self.ranks.values()) >= 1 << 16:
            raise ValueError("a pair's key holds ranks below 65536")
        self.pattern = regex.compile(pattern)
        self.octets = np.array([self.ranks[bytes([k])] for k in range(256)], np.int32)
        self.by_rank = {r: t for t, r in self.ranks.items()}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": f"{ENGINE_MB}MB", "temp_directory": ""})
        pairs, lefts, rights = {}, {}, {}
        for token, rank in self.ranks.items():
            if len(token) > 1 and (pair := last_pair(token, self.ranks)):
                left, right = (self.ranks[t] for t in pair)
                if rank <= max(left, right):
                    raise ValueError("a token ranks above one that it is made of")
                pairs[left << 16 | right] = rank
                for held, key in ((lefts, pair[0][-1] << 16 | right), (rights, left << 8 | pair[1][0])):
                    held[key] = min(rank, held.get(key, rank))
        for name, held, kind in (("merges", pairs, pa.uint32()), ("lefts", lefts, pa.int32()), ("rights", rights, pa.int32())):
            rows = pa.table({"pair": pa.array(held.keys(), kind), "m": pa.array(held.values(), pa.int32())})  # noqa: F841  read by name
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
        rows = pa.table({"t": pa.array(self.ranks.values(), pa.int32()), "spelled": pa.array([f"{r} {t.hex()}" for t, r in self.ranks.items()])})  # noqa: F841
        self.con.execute("CREATE TABLE tokens AS SELECT * FROM rows")
        self.forget()

    def forget(self) -> None:
        self.at, self.known = Numbered(), []

    def learn(self) -> None:
        """Encode the pieces that were numbered but are not known yet: ids as decimal text, ``END``, bytes as decoded, ``END``."""
        new, lo = self.at.new, len(self.known)
        self.at.new = []
        self.known += [b""] * len(new)
        query, size = [], 0
        for k, p in enumerate(new, lo):
            b = p.encode()
            rank = self.ranks.get(b)
            if rank is not None:
                self.known[k] = b"%d%b%b%b" % (rank, END, b, END)
            elif len(b) > LONG:
                self._contracted(k, b)
            else:
                query.append((k, b))
                size += len(b)
                if size >= QUERY_BYTES:
                    self._query(query)
                    query, size = [], 0
        if query:
            self._query(query)

    def _contracted(self, k: int, piece: bytes) -> None:
        ids = self.contract(piece)
        self.known[k] = b" ".join(b"%d" % i for i in ids) + END + b"".join(map(self.by_rank.__getitem__, ids)) + END

    def _query(self, pieces: list[tuple[int, bytes]]) -> None:
        sizes = np.fromiter((len(b) for _, b in pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        octets = np.frombuffer(b"".join(b for _, b in pieces), np.uint8)
        key = np.arange(ends[-1]) + np.repeat(1024 * np.arange(len(pieces)) - ends + sizes, sizes)
        start = pa.table({"k": pa.array(key.astype(np.int32)), "t": pa.array(self.octets[octets]), "b": pa.array(octets.astype(np.int16))})  # noqa: F841
        try:
            found = self.con.execute(STEPS + ENCODED).fetchall()
        except duckdb.OutOfMemoryException:
            if len(pieces) == 1:
                return self._contracted(*pieces[0])
            half = len(pieces) // 2
            self._query(pieces[:half])
            return self._query(pieces[half:])
        for w, spelled in found:
            tokens = spelled.split(" ")
            self.known[pieces[w][0]] = b"%b%b%b%b" % (" ".join(tokens[::2]).encode(), END, bytes.fromhex("".join(tokens[1::2])), END)

    def contract(self, piece: bytes) -> list[int]:
        """The same contraction for one long piece: the pair of least rank, leftmost first."""
        part = [piece[k : k + 1] for k in range(len(piece))]
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap = [(self.ranks[part[k] + part[k + 1]], k, part[k], part[k + 1]) for k in range(len(part) - 1) if part[k] + part[k + 1] in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, k, left, right = heapq.heappop(heap)
            j = after[k]
            if part[k] != left or j >= len(part) or part[j] != right:
                continue
            part[k], part[j], after[k] = left + right, None, after[j]
            if after[k] < len(part):
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < len(part) and (r := self.ranks.get(part[a] + part[b])) is not None:
                    heapq.heappush(heap, (r, a, part[a], part[b]))
        return [self.ranks[t] for t in part if t is not None]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[bytes], list[bytes]]]:
        """By text: the pieces' ids as decimal text, and the pieces as decoded."""
        return (found for found, _ in self.stream((t, None) for t in texts))

    def stream(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        """For (text, row) pairs, what ``encode`` gives by text and the row: texts wait as piece numbers until a query is worth its cost."""
        held, size = [], 0
        for text, row in rows:
            text = text or ""
            pieces = self.pattern.findall(text) if len(text) < HELD else (p.group() for p in self.pattern.finditer(text))
            held.append((np.fromiter(map(self.at.__getitem__, pieces), np.int32), row))
            size += len(held[-1][0])
            if len(self.at.new) >= FRESH or size >= HELD:
                yield from self._emit(held)
                held, size = [], 0
                if len(self.at) > CACHE:
                    self.forget()
        yield from self._emit(held)

    def _emit(self, held: list) -> Iterator[tuple]:
        self.learn()
        for numbers, row in held:
            parts = b"".join(map(self.known.__getitem__, numbers.tolist())).split(END)
            yield (parts[:-1:2], parts[1::2]), row


class Numbered(dict):
    """Numbers pieces as they come up, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        k = self[piece] = len(self)
        self.new.append(piece)
        return k


def _merges(path: str, pattern: str) -> Merges:
    return worker_own(("bpe", path, pattern), lambda: Merges(path, pattern))


def encode(docs: DataFrame, ranks: str, pattern: str, *, key: str = "doc_id", text: str = "text", full: bool = False) -> DataFrame:
    """``key``, n_tokens, ids_sha256, decoded_sha256; with ``full`` also ``ids`` (array of int) and ``decoded`` (binary)."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[key], docs[text])
    kind = rows.schema[0].dataType.simpleString()
    rows_type = to_arrow_type(rows.schema[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _merges(ranks, pattern)
        names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if full else [])]
        kinds = [rows_type, pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]
        pairs = ((t, k) for b in batches for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        out = []
        for (own, decoded), k in coder.stream(pairs):
            spelled, whole = b" ".join(own), b"".join(decoded)
            row = (k, spelled.count(b" ") + bool(spelled), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(whole).hexdigest())
            out.append((*row, [int(x) for x in spelled.split()], whole) if full else row)
            if len(out) == ARROW_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)

    return rows.mapInArrow(tidy(run), f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * full)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
