import base64
import hashlib
import random
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from terrace.llm import bpe, token_file
from terrace.llm._store import Scratch

TEXTS = ["", None, "  ", "Hello, WORLD!! it's 'tis don't", "a<|endoftext|>b <|startoftext|>", "ÉTÉ İstanbul Σίσυφος ﬁ ｆｕｌｌ", "中文字 é ́x", "1234567890 3.14", "x" * 3000, "a b c\x1cd\x85e", "\n\n\n tab\t\t", "🙂🙂 family 👩‍👩‍👧", "$$$*** ###", "w " * 5000]


def texts():
    rng = random.Random(8)
    letters = "abcXYZéÉßŁ中Σσ 12.,!'~́\n\t  "
    return TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")


def test_files_hold_what_the_library_gives(spark):
    rows = texts()
    tokenizer, folder = Tokenizer.from_file(P.path("word_bpe_49k.json")), Scratch(spark, "t").path("shards")
    docs = frame(spark, rows)
    shards = token_file.write_tokens(docs.repartition(5), folder, P.path("word_bpe_49k.json"))
    got = sorted(token_file.read_documents(spark, folder, shards).collect())
    start, flat = 0, []
    for i, t in enumerate(rows):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes())), (i, t)
        start += len(ids)
        flat.append(ids)
    at, flat = 0, np.concatenate(flat)
    for name, _, tokens in shards:  # equal sequences, masks that leave out the padding
        reader = token_file.ShardReader(folder, name)
        n = -(-tokens // token_file.SEQUENCE)
        parts = [reader.sequence(i) for i in range(n)]
        assert all(len(ids) == len(mask) == token_file.SEQUENCE for ids, mask in parts)
        held = np.concatenate([ids[mask] for ids, mask in parts])
        assert (held == flat[at : at + tokens]).all()
        at += tokens
    assert at == len(flat)


def test_shards_of_many_batches(tmp_path):
    writer = token_file.ShardWriter(str(tmp_path), 0, "<u2")
    rng, docs = np.random.default_rng(1), []
    for i in range(60):
        docs.append(rng.integers(0, 49_000, rng.integers(0, 30_000)).astype("<u2"))
        writer.add(i, docs[-1].tobytes())
    writer.close()
    reader = token_file.ShardReader(str(tmp_path), writer.name)
    for (i, _, n, parts), want in zip(reader.document_ids(), docs, strict=True):
        assert n == len(want) and (np.concatenate([*parts, np.zeros(0, "<u2")]) == want).all(), i


def test_repeated_and_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "z"), (3, "b"), (3, "a"), (3, "a")], "doc_id long, text string")
    folder = Scratch(spark, "t").path("shards")
    got = token_file.read_documents(spark, folder, token_file.write_tokens(docs, folder, P.path("word_bpe_49k.json"))).collect()
    assert sorted((r.start, r.doc_id) for r in got) == [(0, None), (2, 3), (4, 3), (6, 3)]
    empty = token_file.write_tokens(docs.limit(0), folder, P.path("word_bpe_49k.json"))
    assert empty == [] and token_file.read_documents(spark, folder, empty).count() == 0


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_recursive_queries_encode_like_the_library(spark):
    rows, coder = texts(), library()
    got = sorted(bpe.encode(frame(spark, rows), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, full=True).collect())
    for r, t in zip(got, rows, strict=True):
        ids = coder.encode_ordinary(t or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (t or "").encode()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("seed", range(3))
def test_query_and_heap_contract_alike(seed):
    own, rng = bpe.Merges(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), random.Random(seed)
    pieces = {"".join(rng.choice("aeinrst the") for _ in range(rng.randint(2, 300))) for _ in range(300)} | {"aaaa" * 15, "abab" * 200, "é" * 511, "a" * 1024}
    numbers = [own.at[p] for p in pieces]
    own.learn()
    for p, k in zip(pieces, numbers):
        rank = own.ranks.get(p.encode())
        want = [rank] if rank is not None else own.contract(p.encode())
        assert own.known[k].split(bpe.END) == [b" ".join(b"%d" % i for i in want), p.encode(), b""]


def test_caches_may_forget_between_texts(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "FRESH", 20)
    monkeypatch.setattr(bpe, "HELD", 2000)
    own, coder = bpe.Merges(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), library()
    for t, (ids, back) in zip(texts(), own.encode(texts()), strict=True):
        assert [int(x) for x in b" ".join(ids).split()] == coder.encode_ordinary(t or "") and b"".join(back) == (t or "").encode()


def test_many_distinct_long_pieces():
    """Runs of 20 Han characters and words of up to 60 random letters, each of its own."""
    rng = random.Random(4)
    rows = [" ".join("".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(20)) for _ in range(3000))]
    rows += [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice((24, 60)))) for _ in range(3000))]
    own, coder = bpe.Merges(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), library()
    for t, (ids, back) in zip(rows, own.encode(rows), strict=True):
        assert [int(x) for x in b" ".join(ids).split()] == coder.encode_ordinary(t) and b"".join(back) == t.encode()


def test_a_query_that_outgrows_its_memory_is_halved():
    rng = random.Random(5)
    t = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60)) for _ in range(40))
    own = bpe.Merges(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    held, sizes = own.con, []

    class Small:
        def execute(self, sql):
            start = sys._getframe(1).f_locals["start"]
            sizes.append(len(set((start["k"].to_numpy() // 1024).tolist())))
            if sizes[-1] > 10 or len(sizes) > 6:
                raise duckdb.OutOfMemoryException("too large")
            held.register("start", start)
            return held.execute(sql)

    own.con = Small()
    ((ids, _),) = own.encode([t])
    assert [int(x) for x in b" ".join(ids).split()] == library().encode_ordinary(t) and 1 in sizes
