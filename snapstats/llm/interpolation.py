"""Language-model scores by deleted interpolation.

P(word | previous) = l2 * count(previous, word) / count(previous) + l1 * count(word) / N + l0 / (V + 1), where the
weights depend on how often the previous word was seen (buckets of powers of two).  They are learned by
expectation-maximisation on a tenth of the training documents, whose own counts are deleted from the estimates.
The end of a text is a token; it is also what comes before the first word.

Tokens are never shuffled one by one.  Documents are read into batches of about a million tokens, each a dictionary
of word hashes and the places of its tokens in it, stored bucketed by batch; no table stays in the catalogue.  A batch
sends the counts of its distinct words and word pairs to the shard of each hash, so that a word of any frequency is one
entry per batch; a shard adds them up and replies to every batch with the corpus' counts of just its entries; the join
of replies and batches moves only the replies.  The number of shards grows with the number of tokens.

Null and empty texts are an end token only.  A null doc_id belongs to the training part.  Rows that repeat an id
are scored one by one.  Without training text every weight is on the uniform part.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import byte_words, stage
from snapstats.session import scratch_path

BATCH_TOKENS, SHARD_KEYS, HELD_PART = 1_000_000, 3_000_000, 10
TRAIN, TUNE, OTHER = 0, 1, 2
BATCHES = "batch long, part int, ids array<long>, ends binary, words binary, tokens binary, n_tokens long"
SENT = "shard int, batch long, kind int, part int, keys binary, counts binary"
REPLY = "batch long, kind int, shard int, counts binary"
SCORES = "doc_id long, part int, n_tokens long, n_known long, base_score double, score double"


def packed(values: np.ndarray) -> bytes:
    """Compressed byte planes: of small or slowly growing numbers most planes are blank."""
    return zlib.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def unpacked(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# --- batches -----------------------------------------------------------------------------------------


def _batches(frames):
    number, open_ = 0, {}

    def closed(part: int) -> pa.RecordBatch:
        nonlocal number
        memo, ids, ends, tokens = open_.pop(part)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, memo), np.uint64, len(memo))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        tokens = place[np.concatenate(tokens)]
        name, number = (TaskContext.get().partitionId() << 32) | number, number + 1
        row = [[name], [part], [ids], [packed(np.array(ends, np.int64))], [packed(np.diff(hashes[order], prepend=np.uint64(0)))],
               [packed(tokens)], [len(tokens)]]
        kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                                          [f.split()[0] for f in BATCHES.split(", ")])

    for frame in frames:
        for doc_id, text, part in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            memo, ids, ends, tokens = open_.setdefault(part, ({b"": 0}, [], [], []))
            words = [*map(bytes.lower, byte_words(text)), b""]
            tokens.append(np.fromiter((memo.setdefault(w, len(memo)) for w in words), np.uint32, len(words)))
            ids.append(doc_id)
            ends.append((ends[-1] if ends else 0) + len(words))
            if ends[-1] >= BATCH_TOKENS:
                yield closed(part)
    for part in list(open_):
        yield closed(part)


def batches(docs: DataFrame, held_out: Column) -> DataFrame:
    """Batches of one part each (training, tuning, other), stored by batch."""
    spark = docs.sparkSession
    tune = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_PART)) == 0
    part = F.when(F.coalesce(held_out, F.lit(False)), OTHER).when(tune, TUNE).otherwise(TRAIN)
    rows = docs.select(F.col("doc_id").cast("long"), "text", part.alias("part")).mapInArrow(_batches, BATCHES)
    name = f"llm_batches_{uuid.uuid4().hex}"
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "batch").option(
        "path", scratch_path(spark, "batches")).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalogue's entry only: the files lie at a path of their own
    return stored


def pair_keys(words: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A 64-bit key of each token and the one before it."""
    end = np.uint64(xxhash.xxh64_intdigest(b""))
    own = words[tokens]
    before = np.concatenate([[end], own[:-1]])
    key = before * np.uint64(0x9E3779B97F4A7C15) ^ (own + np.uint64(0x7F4A7C15F39CC060)) * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


def _entries(words: bytes, tokens: bytes):
    """Of both kinds (words, pairs): sorted distinct keys, their counts, and the entry of each token."""
    words, tokens = np.cumsum(unpacked(words, "<u8"), dtype=np.uint64), unpacked(tokens, "<u4")
    yield words, np.bincount(tokens, minlength=len(words)), tokens
    keys, inverse, counts = np.unique(pair_keys(words, tokens), return_inverse=True, return_counts=True)
    yield keys, counts, inverse


def _slices(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range of hashes begins."""
    edges = np.array([(k << 64) // shards for k in range(shards)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _sent(shards: int):
    def send(frames):
        for frame in frames:
            for batch, part, words, tokens in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                out = []
                for kind, (keys, counts, _) in enumerate(_entries(words, tokens)):
                    at = _slices(keys, shards)
                    for k in np.nonzero(np.diff(at))[0].tolist():
                        own = slice(at[k], at[k + 1])
                        out.append((k, batch, kind, part, packed(np.diff(keys[own], prepend=np.uint64(0))), packed(counts[own].astype(np.uint32))))
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 [f.split()[0] for f in SENT.split(", ")])

    return send


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    """A shard's replies; and, for words, a row of batch -1 with the number of distinct training words."""
    out = []
    for (kind, shard), rows in frame.groupby(["kind", "shard"]):
        keys = [np.cumsum(unpacked(k, "<u8"), dtype=np.uint64) for k in rows["keys"]]
        sizes = np.array([len(k) for k in keys])
        part = np.repeat(rows["part"].to_numpy(), sizes)
        counts = np.concatenate([unpacked(c, "<u4") for c in rows["counts"]])
        found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        train = np.bincount(inverse, np.where(part != OTHER, counts, 0), len(found)).astype(np.uint64)
        tune = np.bincount(inverse, np.where(part == TUNE, counts, 0), len(found)).astype(np.uint64)
        if kind == 0:
            out.append((-1, 0, shard, packed(np.array([(train > 0).sum()], np.uint64))))
        for batch, own in zip(rows["batch"], np.split(inverse, np.cumsum(sizes)[:-1]), strict=True):
            out.append((batch, kind, shard, packed(np.concatenate([train[own], tune[own]]))))
    return pd.DataFrame(out, columns=["batch", "kind", "shard", "counts"])


def _token_counts(frames):
    """Per batch of joined rows: the row, and per token the counts (training, tuning) of word, previous word and pair."""
    for frame in frames:
        for row in frame.to_pylist():
            at = {0: [], 1: []}
            for r in sorted(row["replies"], key=lambda r: (r["kind"], r["shard"])):
                at[r["kind"]].append(unpacked(r["counts"], "<u8").reshape(2, -1))
            end = np.uint64(xxhash.xxh64_intdigest(b""))
            (words, _, tokens), (_, _, pairs) = _entries(row["words"], row["tokens"])
            word, pair = (np.concatenate(at[k], axis=1).astype(np.int64) for k in (0, 1))
            ends = np.searchsorted(words, end)
            before = np.concatenate([[ends], tokens[:-1]])
            yield row, word[:, tokens], word[:, before], pair[:, pairs]


# --- weights -----------------------------------------------------------------------------------------

STEPS = 4  # steps of an estimate per power of two, for learning the weights only
NONE = -9999


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """0 for a previous word never seen, else one more than the power of two of its count."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


def estimates(word: np.ndarray, before: np.ndarray, pair: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    return pair / np.maximum(before, 1), word / max(total, 1)


def _histogram(total: int):
    def count(frames):
        for _, word, before, pair in _token_counts(frames):
            word, before, pair = (c[0] - c[1] for c in (word, before, pair))
            two, one = estimates(word, before, pair, total)
            q2, q1 = (np.where(f > 0, np.round(np.log2(np.maximum(f, 1e-300)) * STEPS), NONE).astype(np.int64) for f in (two, one))
            rows, n = np.unique(np.stack([bucket_of(before), q2, q1]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(r) for r in rows), pa.array(n)], ["bucket", "q2", "q1", "n"])

    return count


def learn(rows: np.ndarray, vocabulary: int, rounds: int = 40) -> np.ndarray:
    """Weights (64 buckets x 3) of (bucket, q2, q1, n) rows; buckets without rows take those of all rows together."""
    uniform = 1 / (vocabulary + 1)
    value = lambda q: np.where(q == NONE, 0.0, np.exp2(q / STEPS))
    parts = np.stack([value(rows[:, 1]), value(rows[:, 2]), np.full(len(rows), uniform)], axis=1)

    def fitted(own: np.ndarray, start: np.ndarray) -> np.ndarray:
        weights = start
        for _ in range(rounds):
            shares = parts[own] * weights
            shares /= shares.sum(axis=1, keepdims=True)
            weights = (shares * rows[own, 3:4]).sum(axis=0) / rows[own, 3].sum()
            weights = np.maximum(weights, 1e-9 * (start > 0))
            weights /= weights.sum()
        return weights

    seen, unseen = np.array([1, 1, 1]) / 3, np.array([0, 0.5, 0.5])
    every = rows[:, 0] > 0
    general = fitted(every, seen) if every.any() else seen
    out = np.tile(general, (64, 1))
    out[0] = np.array([0, *(general[1:] / general[1:].sum())])
    for bucket in np.unique(rows[:, 0]):
        out[bucket] = fitted(rows[:, 0] == bucket, seen if bucket else unseen)
    return out


# --- scores ------------------------------------------------------------------------------------------


def _scored(weights: np.ndarray, total: int, vocabulary: int):
    def score(frames):
        for row, word, before, pair in _token_counts(frames):
            word, before, pair = word[0], before[0], pair[0]
            two, one = estimates(word, before, pair, total)
            own = weights[bucket_of(before)]
            chance = own[:, 0] * two + own[:, 1] * one + own[:, 2] / (vocabulary + 1)
            base = np.log10((word + 0.5) / (total + 0.5 * (vocabulary + 1)))
            ends = unpacked(row["ends"], "<i8")
            starts = np.concatenate([[0], ends[:-1]])
            sums = [np.add.reduceat(x, starts) for x in ((word > 0).astype(np.int64), base, np.log10(chance))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(np.full(len(ends), row["part"], np.int32)), pa.array(ends - starts),
                 *(pa.array(s) for s in sums)], [f.split()[0] for f in SCORES.split(", ")])

    return score


def interpolated_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = batches(docs, held_out)
    sizes = dict(rows.groupBy("part").agg(F.sum("n_tokens")).collect())
    total = sizes.get(TRAIN, 0) + sizes.get(TUNE, 0)
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sum(sizes.values()) // SHARD_KEYS))
    sent = rows.select("batch", "part", "words", "tokens").mapInArrow(_sent(shards), SENT)
    replies = stage(sent.groupBy("shard").applyInPandas(_added, REPLY), "replies")
    stats = replies.where("batch = -1").agg(F.collect_list("counts")).first()[0]
    vocabulary = int(sum(unpacked(s, "<u8")[0] for s in stats))
    own = replies.where("batch >= 0").groupBy("batch").agg(F.collect_list(F.struct("kind", "shard", "counts")).alias("replies"))
    joined = rows.join(own.hint("merge"), "batch")
    if total:
        tuned = joined.where(F.col("part") == TUNE).mapInArrow(_histogram(total - sizes.get(TUNE, 0)), "bucket long, q2 long, q1 long, n long")
        found = tuned.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).collect()
        weights = learn(np.array([tuple(r) for r in found], np.int64).reshape(-1, 4), vocabulary)
    else:
        weights = np.tile(np.array([0.0, 0.0, 1.0]), (64, 1))
    scores = joined.mapInArrow(_scored(weights, total, vocabulary), SCORES)
    return scores.select("doc_id", (F.col("part") == OTHER).alias("held_out"), "n_tokens", "n_known",
                         F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
