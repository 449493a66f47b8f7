"""Language identification by prediction by partial matching.

For each language a variable-order tree of byte contexts is learned and frozen. A text is scored by
its exact code length under each tree: a byte costs -log2 of its probability in the longest known
context; a context that has not seen the byte is left at the price of its escape probability (method C: distinct
symbols over total plus distinct symbols, without exclusions), down to a uniform order. Contexts do not
reach across white space and letters are lower-cased, so a text's length is the sum of its words' lengths,
each closed by one separator, and equal words are scored once. Runs of digits, ``@`` and ``=`` are words of their own, so that the
letters beside them keep the contexts of letters. Every byte but white space is coded.

Grams (a context and the byte after it) are counted by the executors; the driver gets the sums of those that the trees keep.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for every text if there was
nothing to learn from; ties go to the language that is first in code point order; repeated rows score alike. Columns of the
input keep their names and values, whatever the names; one named like a result (``lang_pred``, ``score``, ``lang_bits``) is replaced by it.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm._store import small_batches, tidy, worker_own

#: Longest context in bytes.
ORDER = 4
#: Bounds of what is learned from: documents of a language (chosen by a hash of their id), and languages.
SAMPLE_DOCS, MAX_LANGUAGES = 1500, 400
#: A context of three bytes or more is kept with the bytes that followed it at least so often; the grams of all trees at most.
LEAST, MAX_GRAMS = 3, 2_000_000
#: Bytes of words that are counted together.
COUNTED = 4 << 20
#: Entries that a worker keeps of words and of contexts.
CACHE = 200_000
#: A text that costs more bits a byte than this in its best language is in none of them: keys and numbers in a text cost up to ten bits
#: or so (an escape or two and the byte), a script that no language has costs twenty.
FOREIGN_BITS = 14.0
UNKNOWN = "und"


class ContextTrees:
    """Frozen trees of all languages: bits of a symbol in a context, and of leaving a context."""

    def __init__(self, grams: list[tuple[str, bytes, int]]):
        self.langs = sorted({lang for lang, _, _ in grams})
        counts: dict[str, dict[bytes, int]] = {lang: {} for lang in self.langs}
        for lang, gram, n in grams:
            counts[lang][gram] = n
        self.bits, self.leave = [], []
        for lang in self.langs:
            total, kinds = Counter(), Counter()
            for gram, n in counts[lang].items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            self.bits.append({g: -math.log2(n / (total[g[:-1]] + kinds[g[:-1]])) for g, n in counts[lang].items()})
            self.leave.append({c: -math.log2(kinds[c] / (total[c] + kinds[c])) for c in total})

    def cost(self, gram: bytes) -> list[float]:
        """Bits of the last byte of ``gram`` after those before it, by language."""
        out = []
        for bits, leave in zip(self.bits, self.leave):
            more, g = 0.0, gram
            while g and g not in bits:
                more += leave.get(g[:-1], 0.0)
                g = g[1:]
            out.append(more + (bits[g] if g else 8.0))
        return out


class Scorer:
    """Code lengths of texts, with the costs of words and of contexts kept between batches."""

    def __init__(self, trees: ContextTrees):
        self.trees = trees
        self._forget_words()
        self._forget_grams()

    def _forget_words(self):
        """The table of words has a column of bits for each language, and one of the bytes that count."""
        self.word_at, self.word_bits = {}, np.zeros((0, len(self.trees.langs) + 1))

    def _forget_grams(self):
        self.gram_at, self.gram_bits = {}, np.zeros((4096, len(self.trees.langs)))

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.word_at]
        if len(self.word_at) + len(new) > CACHE:
            self._forget_words()
            new = list(words)
        if len(self.gram_at) > CACHE:
            self._forget_grams()
        at, bits, cost, index, ends = self.gram_at, self.gram_bits, self.trees.cost, [], []
        for w in new:
            s = b" " + w + b" "
            ends.append(len(index))
            for i in range(1, len(s)):
                g = s[i - ORDER if i > ORDER else 0 : i + 1]
                k = at.get(g)
                if k is None:
                    k = at[g] = len(at)
                    if k == len(bits):
                        bits = self.gram_bits = np.concatenate([bits, np.zeros_like(bits)])
                    bits[k] = cost(g)
                index.append(k)
        if new:
            rows = bits[np.array(index)]
            start = len(self.word_at)
            self.word_at.update(zip(new, range(start, start + len(new))))
            counted = np.array([len(w) + 1 for w in new])
            self.word_bits = np.concatenate([self.word_bits, np.column_stack([np.add.reduceat(rows, ends, axis=0), counted])])

    def lengths(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bits by text and language, and the bytes that were coded (with a separator for each word)."""
        split = [words_of(t) for t in texts]
        out, at = np.zeros((len(texts), len(self.trees.langs) + 1)), 0
        while at < len(split):
            upto, words = at, set()
            while upto < len(split) and len(words) < CACHE // 2:
                words.update(split[upto])
                upto += 1
            self._learn(words)
            get = self.word_at.__getitem__
            for i in range(at, upto):
                if ws := split[i]:
                    index = np.fromiter(map(get, ws), np.int64, len(ws))
                    for lo in range(0, len(index), 65_536):
                        out[i] += self.word_bits[index[lo : lo + 65_536]].sum(axis=0)
            at = upto
        return out[:, :-1], out[:, -1]


#: What is in no word of letters.
_SIGNS = re.compile(rb"[0-9@=]+")


def words_of(text: bytes) -> list[bytes]:
    return _SIGNS.sub(rb" \g<0> ", text).split()


def _has_letter(text: str) -> bool:
    return bool(re.search("[A-Za-z]", text)) or any(map(str.isalpha, text))


def grams_of(words: list[bytes]) -> tuple[list[bytes], list[int]]:
    """How often each byte followed each context of up to ``ORDER`` bytes, as context and byte together.

    A context begins at the word's leading separator at the earliest: no space but as its first byte.
    """
    octets = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    grams, counts = [], []
    code, inner = np.zeros(len(octets), np.uint64), np.ones(len(octets), bool)  # of the gram that ends here; no space behind its first byte
    for k in range(ORDER + 1):  # bytes of context
        if len(octets) <= max(1, k):
            break
        code = code[min(k, 1) :] | octets[: len(octets) - k].astype(np.uint64) << np.uint64(8 * k)
        if k > 1:
            inner = inner[1:] & (octets[1 : len(octets) - k + 1] != 32)
        elif k == 1:
            inner = inner[1:]
        own = code[1:] if k == 0 else code[inner]
        found, n = np.unique(own, return_counts=True)
        grams += [int(c).to_bytes(k + 1, "big") for c in found]
        counts += n.tolist()
    return grams, counts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of each language with their number, summed over some ``COUNTED`` bytes."""

    def counted(lang: str, words: list[bytes]) -> pa.RecordBatch:
        grams, n = grams_of(words)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.binary()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    held: dict[str, list] = {}
    size: Counter = Counter()
    for b in batches:
        for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for word in words_of((text or "").lower().encode()):
                held.setdefault(lang, []).append(word)
                size[lang] += len(word) + 1
                if size[lang] >= COUNTED:
                    yield counted(lang, held.pop(lang))
                    size[lang] = 0
    for lang, words in held.items():
        yield counted(lang, words)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> ContextTrees:
    """Fit the trees on a bounded sample of labelled rows: about ``SAMPLE_DOCS`` of each language, by a hash of ``key``.

    All words of the sampled texts count, whole. The trees keep grams of up to three bytes and those seen ``LEAST`` times, the most
    frequent ``MAX_GRAMS`` of them. More than ``MAX_LANGUAGES`` labels raise an error.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return ContextTrees([])
    share = F.create_map(*[F.lit(x) for s, n in sizes.items() for x in (s, min(1.0, SAMPLE_DOCS / n))])
    chosen = rows.where((F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1_000_003)) / 1_000_003.0) < share[F.col("lang")])
    grams = chosen.select("text", "lang").mapInArrow(tidy(_counts), "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = grams.where((F.octet_length("gram") <= 3) | (F.col("n") >= LEAST)).orderBy(F.octet_length("gram") > 3, F.desc("n"), "lang", "gram").limit(MAX_GRAMS)
    return ContextTrees([(r[0], bytes(r[1]), int(r[2])) for r in kept.collect()])


#: Columns that the operator adds.
ADDED = ["lang_pred", "score", "lang_bits"]


def identify(docs: DataFrame, trees: ContextTrees, text: str = "text") -> DataFrame:
    """Add lang_pred, score (posterior of the best language under equal priors) and lang_bits (bits a byte, null for ``und``)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(trees)  # MAX_GRAMS at most
    docs = docs.drop(*ADDED)
    model, names = uuid.uuid4().hex, docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_own(("language", model), lambda: Scorer(shared.value))
        langs = scorer.trees.langs
        for b in batches:
            texts = b.column(at).to_pylist()
            known = [bool(langs) and t is not None and _has_letter(t) for t in texts]
            bits, sizes = scorer.lengths([t.lower().encode() if k else b"" for t, k in zip(texts, known)])
            pred, score, rate = [], [], []
            for i, k in enumerate(known):
                best = int(bits[i].argmin()) if k else -1
                pred.append(langs[best] if k else UNKNOWN)
                score.append(float(1 / np.exp2(np.minimum(bits[i][best] - bits[i], 0)).sum()) if k else 0.0)
                rate.append(float(bits[i][best] / max(1, sizes[i])) if k else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], [*names, "lang_pred", "score", "lang_bits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(tidy(run), f"{schema}, lang_pred string, score double, lang_bits double")


def held_out(key: str, parts: int, part: int):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts)) == part


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = learn(docs.where(~held_out("doc_id", 5, 0)))
    found = identify(docs.select("doc_id", "text"), trees)
    return found.select("doc_id", F.coalesce(held_out("doc_id", 5, 0), F.lit(False)).alias("held_out"), "lang_pred", "score")
