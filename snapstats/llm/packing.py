"""Best-fit packing planned over the length histogram.

Best-fit decreasing looks at lengths only, so it runs over the counts of the (at most ``capacity``) lengths: open
sequences of the same free space form a run of sequence numbers, and one step places a whole run of equal pieces.
The plan maps the rank of a piece among those of its length to a sequence and an offset; its size depends on the
number of lengths, not of pieces.  Ranks come from counts per (length, hash bucket), so that a hot length is ranked
by many tasks, and pieces look up their slot in the broadcast plan.

Null text: an empty document, which still has its end token.  Rows repeating an id are packed one by one; rows
equal in everything are told apart by rank only.  Null ids are carried.  No rows: no pieces.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right, insort
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstats.llm.common import stage

CAPACITY = 2048
#: Words remembered by a task, and pieces per bucket of a length.
MEMO, BUCKET_ROWS = 500_000, 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Words(dict):
    """Ids (little-endian bytes) of words without blanks, by the tokenizer; the first ``MEMO`` stay remembered.

    Its pattern takes a run of letters, or of signs, as one piece, so a word is its letters and the signs behind
    them, and letters that normalisation leaves alone may go straight to the tokenizer's model, as their bytes.
    """

    def __init__(self, coder, most: int):
        super().__init__()
        self.coder, self.model, self.most = coder, coder.model, most
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.alphabet = {b: 256 + k for k, b in enumerate(rest)}  # how the byte-level vocabulary writes bytes

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(".,!?;:*&%#$")
        if core != word and core and core[-1].lower().isalpha():
            ids = self[core] + self[word[len(core):]]
        elif word.isalpha() and word == word.lower() and is_normalized("NFC", word):
            text = word.encode().decode("latin-1").translate(self.alphabet)
            ids = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
        else:
            ids = np.array(self.coder.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < self.most:
            self[word] = ids
        return ids

    def encoded(self, text: str) -> bytes:
        if text.isascii() and "<|" not in text:
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces of every document: ids of the whole text, then ``end_id``, cut every ``capacity`` ids.

    The tokenizer is a path that executors can read; it never joins over blanks, so words are encoded one by one.
    """

    def cut(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        words = Words(Tokenizer.from_file(tokenizer), MEMO)
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = words.encoded(text or "") + end
                out += [(doc_id, k, k * capacity, len(part := ids[k * step : (k + 1) * step]) // 4, zlib.crc32(part))
                        for k in range(-(-len(ids) // step))]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, pieces, first sequence, pieces per sequence, offset).

    A run of ``n`` sequences with ``free`` space each takes ``free // length`` pieces per sequence, the tightest
    runs first; a last sequence that is not filled up becomes a run of its own.
    """
    plan, runs, sequences = [], [], 0  # runs: (free, first sequence, number), sorted by free space

    def put(length: int, rank: int, left: int, free: int, first: int, number: int) -> int:
        """Fill a run as far as pieces are left; returns how many were placed."""
        each = free // length
        full, part = divmod(min(left, each * number), each)
        offset = capacity - free
        if full:
            plan.append((length, rank, full * each, first, each, offset))
            if free > each * length:
                insort(runs, (free - each * length, first, full))
        if part:
            plan.append((length, rank + full * each, part, first + full, part, offset))
            insort(runs, (free - part * length, first + full, 1))
        rest = number - full - bool(part)
        if rest:
            insort(runs, (free, first + full + bool(part), rest))
        return full * each + part

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        at = bisect_right(runs, (length, -1, -1))
        while left and at < len(runs):
            placed = put(length, rank, left, *runs.pop(at))
            rank, left = rank + placed, left - placed
            at = bisect_right(runs, (length, -1, -1))
        if left:
            number = -(-left // (capacity // length))
            put(length, rank, left, capacity, sequences, number)
            sequences += number
    return plan


def ranked(pieces: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``rank`` of each piece among those of its length (from 0), and the histogram."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = -(-sum(counts.values()) // bucket_rows) or 1
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).alias("bucket")
    dealt = pieces.withColumn("bucket", bucket)
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start"))
    return dealt.withColumn("number", number).join(offsets, ["length", "bucket"]).withColumn(
        "rank", F.col("number") + F.col("before") - 1).drop("bucket", "number", "before"), counts


def place(rows: DataFrame, plan: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """Sequence and offset of ranked pieces."""
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def look_up(batches):
        steps = shared.value
        key = steps[:, 0] * (1 << 48) + steps[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            step = steps[np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1]
            row, column = np.divmod(rank - step[:, 1], np.maximum(step[:, 4], 1))
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(step[:, 3] + row), pa.array(step[:, 5] + column * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows.mapInArrow(look_up, PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and offset."""
    pieces = stage(token_pieces(docs, tokenizer, capacity), "pieces")
    rows, counts = ranked(pieces)
    return place(rows, best_fit(counts, capacity))
