"""SimHash near-duplicates found through Golay codes.

The 64 bits of a fingerprint are three segments (22, 21, 21 bits), each read as a word of the perfect [23, 12]
Golay code.  A segment's indices are the data bits of the codewords nearest to it and to its one-bit neighbours:
two segments at most two bits apart share an index (some word is within one bit of both, and it has one nearest
codeword).  Segments one bit apart differ in parity, so it is enough that the odd one gives all its indices and the
even one that of itself: these are the close indices.  Fingerprints at most four bits apart agree in one of these
ways, which are the keys:
  - some segment is equal, and the next one (in a ring) differs in at most two bits: (segment, index of the next);
  - some segment is equal and the next one differs in three or more, so the last one in at most one:
    (segment, close index of the last);
  - all three differ, as 1+1+1 or 1+1+2: (close index, close index) of two of them, for each two.
Buckets of a key are verified by counting differing bits.  A small bucket is joined with itself with the test
inside the join; in a large one each task walks from fingerprint to fingerprint over those not reached yet, and
hands back a spanning forest, so copies are never expanded into pairs.  A bucket beyond ``BLOCK`` is dealt to
tasks by pairs of blocks, which together see every pair.

Null or empty text: fingerprint zero, linked like any other.  Equal fingerprints are one node.  Null ids are
carried; a component of null ids only has a null component_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstats.llm import similar
from snapstats.llm.common import byte_words, row_key, stage
from snapstats.llm.components import connected_components

WIDTHS = (22, 21, 21)
SMALL, BLOCK = 24, 16384


# --- fingerprints ------------------------------------------------------------------------------------


def fingerprint(text: str | None, words: int = 4) -> int:
    """Majority of the bits of XXH64 (seed 42) over the shingles, repeats included; zero without words."""
    got = [w.lower() for w in byte_words(text)]
    if not got:
        return 0
    shingles = [b" ".join(got)] if len(got) < words else list(map(b" ".join, zip(*(got[k:] for k in range(words)), strict=False)))
    n = len(shingles)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        got = np.array([fingerprint(t) for t in batch.column(0).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(got, pa.int64())], [*batch.schema.names[1:], "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, the row's key and ``fp`` (the 64 bits as a signed long), one row per input row."""
    return docs.select("text", F.col("doc_id").cast("long"), *row_key()).mapInArrow(
        _fingerprints, "doc_id long, _k1 long, _k2 long, fp long")


# --- Golay keys --------------------------------------------------------------------------------------

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(words: np.ndarray) -> np.ndarray:
    """Modulo the generator: the syndrome of 23-bit words."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - 11))
    return rest


def _errors() -> np.ndarray:
    """By syndrome: the one error pattern of at most three bits."""
    one = 1 << np.arange(23)
    patterns = [0, *one]
    patterns += [a | b for i, a in enumerate(one) for b in one[:i]]
    patterns += [a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    patterns = np.array(patterns, np.int64)
    out = np.zeros(2048, np.int64)
    out[_remainder(patterns)] = patterns
    return out


def indices(segment: np.ndarray, width: int, errors: np.ndarray) -> np.ndarray:
    """Rows of sorted indices (12 bits) of the segments and their one-bit neighbours; repeats are -1."""
    near = segment[:, None] ^ np.concatenate([[0], 1 << np.arange(width)])[None, :]
    found = np.sort((near ^ errors[_remainder(near)]) >> 11, axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def golay_keys(fps: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``fps``, key) pairs."""
    bits = fps.view(np.uint64)
    parts, every, close, at = [], [], [], 0
    for width in WIDTHS:
        part = ((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
        near = indices(part, width, errors)
        even = np.bitwise_count(part) % 2 == 0
        own = np.full_like(near, -1)
        own[:, 0] = (part ^ errors[_remainder(part)]) >> 11
        parts.append(part)
        every.append(near)
        close.append(np.where(even[:, None], own, near))
        at += width
    places, keys = [], []

    def put(tag: int, rows: np.ndarray, head: np.ndarray, tail: np.ndarray) -> None:
        """Each head with all indices of the same row of ``tail``."""
        row, col = np.nonzero(tail >= 0)
        places.append(rows[row])
        keys.append((tag << 40) | (head[row] << 12) | tail[row, col])

    whole = np.arange(len(fps))
    for i in range(3):
        put(i, whole, parts[i], every[(i + 1) % 3])
        put(3 + i, whole, parts[i], close[(i + 2) % 3])
        first, second = close[i], close[(i + 1) % 3]
        for col in range(first.shape[1]):
            rows = np.nonzero(first[:, col] >= 0)[0]
            put(6 + i, rows, first[rows, col], second[rows])
    return np.concatenate(places), np.concatenate(keys)


def _keyed(batches):
    errors = _errors()
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for k in range(0, len(every), 20_000):
            fps = every[k : k + 20_000].astype(np.int64)
            place, keys = golay_keys(fps, errors)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fps[place], pa.int64())], ["key", "fp"])


# --- links -------------------------------------------------------------------------------------------


def _forest(fps: np.ndarray, most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links (a, b) that connect what pairs within ``most`` bits connect; each node but one per tree is a ``b``."""
    rest, sides = np.unique(fps).view(np.uint64), ([], [])
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            here = todo.pop()
            near = np.bitwise_count(rest ^ here) <= most
            if near.any():
                found, rest = rest[near], rest[~near]
                sides[0].append(np.full(len(found), here))
                sides[1].append(found)
                todo.extend(found)
    return sides


def _verify(most: int):
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = _forest(frame["fp"].to_numpy(np.int64), most)
        empty = np.zeros(0, np.uint64)
        return pd.DataFrame({"a": np.concatenate([*a, empty]).astype(np.uint64).view(np.int64),
                             "b": np.concatenate([*b, empty]).astype(np.uint64).view(np.int64)})

    return one


def links(fps: DataFrame, most: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints (``fp``) whose components are those of all pairs within ``most`` bits."""
    if most > 4:
        raise ValueError("the keys guarantee up to four differing bits")
    width = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # some fifty keys each: more tasks than for the rows themselves
    keyed = stage(fps.select("fp").distinct().repartition(width, "fp").mapInArrow(_keyed, "key long, fp long"), "golay-keys")
    hot = stage(keyed.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > SMALL), "golay-hot")
    few = keyed.join(hot, "key", "left_anti")
    other = few.select("key", F.col("fp").alias("other"))
    pairs = few.join(other, (few["key"] == other["key"]) & (few["fp"] < other["other"])
                     & (F.bit_count(few["fp"].bitwiseXOR(other["other"])) <= most)).select(
        F.col("fp").alias("a"), F.col("other").alias("b"))
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    many = keyed.join(hot, "key").select("key", "fp", blocks.alias("n"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("own"))
    dealt = many.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    walked = dealt.groupBy("key", "i", "j").applyInPandas(_verify(most), "a long, b long")
    return pairs.unionByName(walked).distinct()


def near_duplicates(docs: DataFrame, most: int = 4) -> DataFrame:
    """doc_id, row key, ``fp`` and ``component_id``: the smallest doc_id reachable over links."""
    fps = stage(fingerprints(docs), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = connected_components(links(nodes, most))
    joined = nodes.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = joined.join(least, "label").select("fp", "component_id", "label")
    return fps.join(classes, "fp")


def keep_one(docs: DataFrame, most: int = 4, least: float = similar.LEAST) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest doc_id (null last; ties: any one equal row).

    Groups are those of the fingerprints, joined where they hold texts of five-word similarity ``least`` or more.
    """
    groups = stage(near_duplicates(docs, most).select("doc_id", "_k1", "_k2", "label"), "near-groups")
    merged = connected_components(similar.links(docs, groups, least)).select(F.col("node").alias("label"), F.col("label").alias("_to"))
    groups = groups.join(merged, "label", "left").withColumn("label", F.coalesce("_to", "label"))
    first = groups.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_k1", "_k2")).alias("f"))
    chosen = first.select(F.col("f._k1").alias("_k1"), F.col("f._k2").alias("_k2"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    kept = docs.select(row, *row_key()).join(chosen, ["_k1", "_k2"], "left_semi")
    number = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy("_k1"))
    return kept.withColumn("_n", number).where("_n = 1").select("_row.*")
