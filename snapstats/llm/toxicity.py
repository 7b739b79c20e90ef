"""Toxicity by multiple-instance learning: only documents carry labels, sentences are scored.

A sentence's chance is a logistic function of the distinct words in it; a document's is their noisy-or with a leak,
``1 - (1 - leak) * prod(1 - chance)``.  Word weights, bias and leak are learned together from document labels, in
numpy, by proximal gradient steps (L1, so that most words weigh nothing) on a loss that allows for some wrong labels.
A word weighs what itself and its beginnings of four to seven letters weigh, so that inflected and compound forms of a
stem tell together; only features that toxic texts hold markedly more often take part.
Sentences below ``FLOOR`` count as clean, so that thousands of harmless ones do not add up.  The sentences of
``OFFENDING`` and more are located by code points.

Training takes at most ``MAX_ROWS`` labelled rows and ``MAX_BYTES`` of their whole texts (see `common.labelled`; the model
holds words of these only, so it is bounded as well); every document is scored, in tasks.

Words lie between blanks, without punctuation around them and in lower case; text written without blanks is one word.
A sentence ends with a word that ends in ``.``, ``!`` or ``?`` (quotes and brackets may follow), or at a line break.
Null and empty texts have no sentence and get the leak.  Rows without a doc_id teach nothing but are scored.  If no
row or one class only is left, every score is the share of ones (0.5 of nothing).  Repeated rows are scored alike.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import labelled, spread

MAX_ROWS, MAX_BYTES = 4000, 8 << 20
LEAST_DOCS, SURE, STEPS, RATE, SPARSE, WRONG = 3, 2.5, 150, 0.6, 1.5, 0.02
STEMS = (4, 5, 6, 7)
FLOOR, OFFENDING = 0.1, 0.5
MEMO, PART = 300_000, 1 << 21

BREAK = "\x1e"  # stands for a line break between words
TOKEN = re.compile(r"\n|[^ \t\n\x0b\x0c\r]+")
ENDS = re.compile(r"[.!?。！？…]['\")\]}»”’]*$")
SCORED = "doc_id long, score double, sentences array<struct<start:long,end:long,chance:double>>"


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    leak: float


def tokens(text: str | None) -> list[str]:
    """The words of a text with a ``BREAK`` for each line break, split at the six ASCII blanks only."""
    text = text or ""
    if not text.isascii():  # str.split would split at other blanks too
        return [BREAK if t == "\n" else t for t in TOKEN.findall(text)]
    return [t.decode() for t in text.replace("\n", f" {BREAK} ").encode().split()]


def features(word: str) -> list[str]:
    """The word itself and its beginnings of ``STEMS`` letters."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n <= len(word))]


class Words(dict):
    """Places of raw words in order of first sight, each with the number of what it means (-1: nothing) and whether it ends a sentence."""

    def __init__(self, number):
        super().__init__()
        self.number = number
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.keys, self.ends = array("q"), array("b")

    def __missing__(self, word: str) -> int:
        key = word.lower()
        key = key if key.isalnum() else re.sub(r"^[\W_]+|[\W_]+$", "", key)
        self.keys.append(self.number(key) if key else -1)
        self.ends.append(word == BREAK or (not word[-1].isalnum() and ENDS.search(word) is not None))
        self[word] = place = len(self.ends) - 1
        return place

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word of all texts: its text, its sentence (numbered over all texts) and its key."""
        lists = [tokens(t) for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        every = np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(len(texts)), sizes)
        if not len(every):
            return text, text, text
        starts = np.r_[True, (np.frombuffer(self.ends, np.int8)[every[:-1]] > 0) | (text[1:] != text[:-1])]
        return text, np.cumsum(starts) - 1, np.frombuffer(self.keys, np.int64)[every]


def telling(words: list[str], text: np.ndarray, key: np.ndarray, labels: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Features of the words that texts of label 1 hold markedly more often, and all pairs of (word, such a feature)."""
    number: dict[str, int] = {}
    every = [[number.setdefault(f, len(number)) for f in features(w)] for w in words]
    of_word = np.repeat(np.arange(len(words)), np.array([len(x) for x in every], np.int64))
    feature = np.fromiter(chain.from_iterable(every), np.int64, len(of_word))
    ends = np.searchsorted(of_word, np.arange(len(words) + 1))
    held = np.unique(text[key >= 0] * max(len(words), 1) + key[key >= 0])
    doc, word = held // max(len(words), 1), held % max(len(words), 1)
    size = ends[word + 1] - ends[word]
    at = spread(ends[word], size)
    held = np.unique(np.repeat(doc, size) * max(len(number), 1) + feature[at])
    doc, which = held // max(len(number), 1), held % max(len(number), 1)
    docs, ones, share = np.bincount(which, minlength=len(number)), np.bincount(which, labels[doc], len(number)), labels.mean()
    tells = (ones >= LEAST_DOCS) & (ones - docs * share >= SURE * np.sqrt(docs * share * (1 - share)))
    place = np.cumsum(tells) - 1
    own = tells[feature]
    return [f for f, i in number.items() if tells[i]], of_word[own], place[feature[own]]


def train(rows: list[tuple[str | None, int]]) -> Model:
    """Proximal gradient steps, scaled by word as in Adagrad, over all rows at a time."""
    labels = np.array([y for _, y in rows], float)
    if not 0 < labels.sum() < len(rows):
        return Model({}, 0.0, float(labels.mean()) if rows else 0.5)
    known: dict[str, int] = {}
    text, sentence, key = Words(lambda w: known.setdefault(w, len(known))).read([t for t, _ in rows])
    number = int(sentence[-1]) + 1 if len(sentence) else 0
    doc = np.zeros(number, np.int64)
    doc[sentence] = text
    names, of_word, feature = telling(list(known), text, key, labels)
    kept = np.isin(key, of_word)
    pair = np.unique(sentence[kept] * max(len(known), 1) + key[kept])
    sent, word = pair // max(len(known), 1), pair % max(len(known), 1)
    weights, scale = np.zeros(len(names)), np.zeros(len(names))
    bias, leak = -4.0, 0.01
    bias_scale = leak_scale = 0.0
    for step_number in range(1, STEPS + 1):
        sparse = SPARSE / len(rows) * min(1.0, 2 * step_number / STEPS)  # grows, so that words first may show what they tell
        by_word = np.bincount(of_word, weights[feature], len(known))
        z = bias + np.bincount(sent, by_word[word], number)
        chance = 1 / (1 + np.exp(-z))
        clean = (1 - leak) * np.exp(-np.bincount(doc, np.logaddexp(0, z), len(rows)))
        seen = WRONG + (1 - 2 * WRONG) * (1 - clean)
        back = (1 - 2 * WRONG) * clean * ((1 - labels) / (1 - seen) - labels / seen) / len(rows)  # by the evidence of a text
        by_sentence = back[doc] * chance
        step = np.bincount(feature, np.bincount(word, by_sentence[sent], len(known))[of_word], len(names))
        scale += step * step
        rate = RATE / np.sqrt(scale + 1e-9)
        weights -= rate * step
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparse, 0)
        bias_step, leak_step = float(by_sentence.sum()), float((back / (1 - leak)).sum())
        bias_scale += bias_step**2
        leak_scale += leak_step**2
        bias = min(bias - 0.3 * bias_step / np.sqrt(bias_scale + 1e-12), -3.0)
        leak = min(max(leak - 0.01 * leak_step / np.sqrt(leak_scale + 1e-12), 1e-3), 0.4)
    return Model({w: float(x) for w, x in zip(names, weights, strict=True) if x}, float(bias), float(leak))


def places(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each word of `tokens`, in code points."""
    return [t.span() for t in TOKEN.finditer(text or "")]


class Scorer:
    """Scores texts with a model; the words seen are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.words = Words(self.number)
        self.clear()

    def clear(self) -> None:
        self.words.clear()
        self.known, self.found = {}, array("d")

    def number(self, word: str) -> int:
        """That of a word with any feature of the model; its weight is the sum of theirs."""
        own = [w for f in features(word) if (w := self.model.weights.get(f)) is not None]
        if own and word not in self.known:
            self.known[word] = len(self.found)
            self.found.append(sum(own))
        return self.known.get(word, -1)

    def part(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Scores, and the offending sentences of each text as (start, end, chance)."""
        if len(self.words) > MEMO:
            self.clear()
        text, sentence, key = self.words.read(texts)
        spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        known = key >= 0
        if not known.any():
            return np.full(len(texts), self.model.leak), spans
        weights = np.frombuffer(self.found)
        pair = np.unique(sentence[known] * len(weights) + key[known])
        own, at = np.unique(pair // len(weights), return_inverse=True)
        chance = 1 / (1 + np.exp(-self.model.bias - np.bincount(at, weights[pair % len(weights)])))
        first = np.searchsorted(sentence, own)
        counted = chance >= FLOOR
        clean = np.bincount(text[first[counted]], np.log1p(-np.minimum(chance[counted], 1 - 1e-12)), len(texts))
        for k in np.nonzero(chance >= OFFENDING)[0]:
            spans[text[first[k]]].append((int(first[k]), int(own[k]), float(chance[k])))
        for i, found in enumerate(spans):
            if found:  # words are placed in texts that offend only
                at_word, start = places(texts[i]), int(np.searchsorted(text, i))
                for j, (a, s, c) in enumerate(found):
                    b = int(np.searchsorted(sentence, s, "right"))
                    last = b - 1 if self._is_break(texts[i], at_word[b - 1 - start]) and b - 1 > a else b
                    found[j] = (at_word[a - start][0], at_word[last - 1 - start][1], c)
        return 1 - (1 - self.model.leak) * np.exp(clean), spans

    @staticmethod
    def _is_break(text: str, span: tuple[int, int]) -> bool:
        return text[span[0] : span[1]] == "\n"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ``score`` and the offending ``sentences`` (start, end, chance) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))

    def scored(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts, scores, spans = batch.column(1).to_pylist(), [], []
            ends = np.cumsum([len(t or "") for t in texts]) // PART
            for part in np.split(np.arange(len(texts)), np.nonzero(np.diff(ends))[0] + 1):
                some, found = scorer.part([texts[k] for k in part])
                scores.append(some)
                spans += [[dict(zip(("start", "end", "chance"), s, strict=True)) for s in x] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(scores), pa.float64()), pa.array(spans, spans_type)], ["doc_id", "score", "sentences"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, SCORED)


def toxicity_scores(docs: DataFrame, labels: DataFrame, usable) -> DataFrame:
    return score(docs, train(labelled(docs, labels, usable, "toxic", MAX_ROWS, MAX_BYTES)))


def offending_sentences(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, start, end, chance of each offending sentence."""
    return score(docs, model).select("doc_id", F.explode("sentences").alias("s")).select("doc_id", "s.*")
