"""Quality classifier: supervised subword embeddings.

Words, word pairs and n-grams of a word's UTF-8 bytes are hashed to learned vectors, averaged over the whole document and fed to a
softmax over two classes; vectors and output are learned together by stochastic gradient descent in numpy.  Training
takes at most ``MAX_ROWS`` labelled rows and ``MAX_BYTES`` of their whole texts (those of lowest hash that fit;
documented bounds, so that fitting fits one machine, see `common.labelled`); scoring covers every document in tasks.  As the output is linear in the
averaged vector, a trained model is one number per bucket: a document's logit is their mean over its features.

Null and empty texts have no features and get the logit of the bias.  Labels other than 0 and 1, and rows without a
document, teach nothing.  If no row or one class only is left, every score is the share of ones (0.5 of nothing).
Repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import byte_words, labelled, spread

BUCKETS, DIM, EPOCHS, RATE = 1 << 18, 12, 6, 0.5
MAX_ROWS, MAX_BYTES = 3000, 24 << 20
MEMO, SHORT, BLOCK, PART = 300_000, 64, 1 << 20, 1 << 21
NGRAMS = (3, 4)
REPEAT, LEAST_DOCS = 0, 3
CRC_TABLE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


@dataclass
class Model:
    weights: np.ndarray  # by bucket: what the feature adds to the logit of class 1
    bias: float


class Features:
    """Buckets of words: their own and those of the n-grams of ``<word>``; the first ``keep`` words are remembered."""

    def __init__(self, keep: int = MEMO):
        self.keep = keep
        self.memo: dict[bytes, tuple[int, np.ndarray]] = {}

    def word(self, word: bytes) -> tuple[int, np.ndarray]:
        got = self.memo.get(word)
        if got is None:
            marked = b"<" + word + b">"
            own = zlib.crc32(word)
            if len(word) > SHORT:
                return own, np.concatenate([[own % BUCKETS], *(long_grams(marked, n) for n in NGRAMS)]).astype(np.int32)
            grams = {marked[k : k + n] for n in NGRAMS for k in range(len(marked) - n + 1)}
            got = own, np.array([own % BUCKETS, *(zlib.crc32(g, 7) % BUCKETS for g in grams)], np.int32)
            if len(self.memo) < self.keep:
                self.memo[word] = got
        return got

    def document(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets and their counts over words, n-grams and pairs."""
        words = [self.word(w) for w in byte_words(text)]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        every = np.concatenate([*(g for _, g in words), pairs(np.array([h for h, _ in words], np.uint64))])
        return np.unique(every, return_counts=True)


def long_grams(word: bytes, n: int) -> np.ndarray:
    """Buckets of the distinct n-grams (of at most four bytes) of a long word, as ``zlib.crc32(gram, 7)`` gives them."""
    every, grams = np.frombuffer(word, np.uint8), np.zeros(0, np.uint32)
    for k in range(0, len(every) - n + 1, BLOCK):
        part = every[k : k + BLOCK + n - 1].astype(np.uint32)
        size = len(part) - n + 1
        packed = np.zeros(size, np.uint32)
        for i in range(n):
            packed = (packed << np.uint32(8)) | part[i : i + size]
        grams = np.union1d(grams, packed)
    return gram_buckets(grams, n)


def gram_buckets(grams: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each packed n-gram: that of ``zlib.crc32(gram, 7)``."""
    crc = np.full(len(grams), 7 ^ 0xFFFFFFFF, np.uint32)
    for i in reversed(range(n)):
        byte = (grams >> np.uint32(8 * i)) & np.uint32(255)
        crc = CRC_TABLE[(crc ^ byte) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return (crc ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS)


def pairs(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words; a word that follows itself is the same pair whatever the word."""
    mixed = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    found = ((mixed >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32)
    found[hashes[:-1] == hashes[1:]] = REPEAT
    return found


def train(rows: list[tuple[str | None, int]], seed: int = 1) -> Model:
    """Stochastic gradient descent, one document at a time."""
    ones = sum(y for _, y in rows)
    if not 0 < ones < len(rows):
        share = ones / len(rows) if rows else 0.5
        edge = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(edge / (1 - edge))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output = np.zeros((2, DIM), np.float32)
    bias = np.log(np.array([len(rows) - ones, ones]) / len(rows))
    reader = Features()
    docs = [(b, (c / c.sum()).astype(np.float32), y) for t, y in rows for b, c in [reader.document(t)] if len(b)]
    seen = np.zeros(BUCKETS, np.int64)
    for b, _, _ in docs:
        seen[b] += 1
    vectors[seen < LEAST_DOCS] = 0  # what few texts hold says which text it is, not how good
    docs = [(b[own], c[own], y) for b, c, y in docs for own in [seen[b] >= LEAST_DOCS]]
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(docs)):
            buckets, share, y = docs[k]
            rate = RATE * (1 - done / steps)
            hidden = share @ vectors[buckets]
            logit = output @ hidden + bias
            chance = np.exp(logit - logit.max())
            chance /= chance.sum()
            wrong = chance - np.eye(2)[y]
            back = wrong @ output
            output -= (rate * np.outer(wrong, hidden)).astype(np.float32)
            bias -= 0.02 * rate * wrong
            # each bucket moves by its share of the average, scaled by the size of the text as in one step per feature
            vectors[buckets] -= (rate * np.minimum(1.0, share * 50))[:, None] * back[None, :].astype(np.float32)
            done += 1
    return Model((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


class Index(dict):
    """Places of words in order of first sight, with what each adds to a logit."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.reader = weights.astype(np.float64), Features(keep=0)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.own, self.sums, self.sizes = array("Q"), array("d"), array("q")

    def learn(self, words: Iterable[bytes]) -> None:
        """Short words are hashed together: their n-grams as numbers, each once a word."""
        new = [w for w in dict.fromkeys(words) if w not in self]
        short = [w for w in new if len(w) <= SHORT]
        own = np.fromiter(map(zlib.crc32, short), np.int64, len(short))
        sums, sizes = self.weights[own % BUCKETS], np.ones(len(short), np.int64)
        length = np.fromiter(map(len, short), np.int64, len(short)) + 2
        every = np.frombuffer(b"".join([b"<" + w + b">" for w in short]), np.uint8).astype(np.int64)
        starts = np.cumsum(length) - length
        for n in NGRAMS:
            number = np.maximum(length - n + 1, 0)
            at = spread(starts, number)
            gram = np.repeat(np.arange(len(short)), number) << 32
            for i in range(n):
                gram |= every[at + i] << 8 * (n - 1 - i)
            gram = np.unique(gram)
            word = gram >> 32
            sums += np.bincount(word, self.weights[gram_buckets((gram & 0xFFFFFFFF).astype(np.uint32), n)], len(short))
            sizes += np.bincount(word, minlength=len(short))
        long = [(crc, self.weights[b].sum(), len(b)) for w in new if len(w) > SHORT for crc, b in [self.reader.word(w)]]
        for kept, values, others in zip((self.own, self.sums, self.sizes), (own, sums, sizes), zip(*long, strict=True) if long else ((), (), ()), strict=True):
            kept.extend(values.tolist())
            kept.extend(others)
        for place, word in enumerate([*short, *(w for w in new if len(w) > SHORT)], len(self)):
            self[word] = place


def logits(texts: list[str | None], index: Index, bias: float) -> np.ndarray:
    """The mean weight over the features of each text, plus the bias."""
    words = [byte_words(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    index.learn(chain.from_iterable(words))
    every = np.fromiter(map(index.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    if not len(every):
        return np.full(len(texts), bias)
    own, sums, grams = (np.frombuffer(a, a.typecode) for a in (index.own, index.sums, index.sizes))
    text = np.repeat(np.arange(len(texts)), sizes)
    two = pairs(own[every])
    inside = text[1:] == text[:-1]  # a pair does not span two texts
    total = np.bincount(text, sums[every], len(texts)) + np.bincount(text[1:], index.weights[two] * inside, len(texts))
    number = np.bincount(text, grams[every], len(texts)) + np.maximum(sizes - 1, 0)
    return bias + total / np.maximum(number, 1)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score``, the probability of class 1, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def scored(batches):
        weights, bias = shared.value
        index = Index(weights)
        for batch in batches:
            texts, out = batch.column(1).to_pylist(), []
            ends = np.cumsum([len(t or "") for t in texts]) // PART
            for part in np.split(np.arange(len(texts)), np.nonzero(np.diff(ends))[0] + 1):
                if len(index) > MEMO:
                    index.clear()
                out.append(logits([texts[k] for k in part], index, bias))
            chance = 1 / (1 + np.exp(-np.concatenate(out)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, usable) -> DataFrame:
    return score(docs, train(labelled(docs, labels, usable, "quality", MAX_ROWS, MAX_BYTES)))
