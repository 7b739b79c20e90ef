"""Pairs of texts whose sets of five-word shingles have a Jaccard similarity of ``LEAST`` or more.

Each set is sketched by ``BANDS`` keys of ``ROWS`` minima each; sets that share a key are candidates, which a pair of
similarity j does with chance 1 - (1 - j^ROWS)^BANDS: at 0.8 all but one pair in a million (6e-7), and fewer are missed above.
Candidates are then verified by their exact sets.  Only pairs of different groups (``label``) are of interest, so
keys within one group are left at once.  A small bucket of a key is expanded into pairs; in a large one tasks walk
from set to set over those not reached yet, by pairs of blocks, as `simhash` does with fingerprints.  A block holds about
``BLOCK`` sets or ``GRAMS`` shingles, whichever are fewer, so that long texts make more blocks and not larger ones.

Words are those of the fingerprints.  Texts of fewer than five words have no shingles and are similar to nothing,
null and empty ones among them.  Null ids and repeated rows are as good as others: rows of one text are one set, and a set
is compared once per label.  Empty tables have no links.  Texts of any length are read whole; one set must fit a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import byte_words, row_key, stage

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 20, 3
SMALL, BLOCK, GRAMS = 24, 1024, 1 << 22
CHUNK = 1 << 12


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of the five-word shingles."""
    got = [w.lower() for w in byte_words(text)]
    each = {b" ".join(s) for s in zip(*(got[k:] for k in range(WORDS)), strict=False)}
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 7) for s in each), np.uint64, len(each)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band, from the minima of the hashes under ``BANDS * ROWS`` fixed mixings."""
    rng = np.random.default_rng(5)
    flips = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None]
    factors = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None] | np.uint64(1)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for k in range(0, len(hashes), CHUNK):
        mixed = (hashes[None, k : k + CHUNK] ^ flips) * factors
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, mixed.min(1))
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], np.uint64).view(np.int64)


def _sketched(batches):
    for batch in batches:
        keep, names, sizes, keys = [], [], [], []
        for i, text in enumerate(batch.column(0).to_pylist()):
            got = shingles(text)
            if len(got):
                keep.append(i)
                names.append(xxhash.xxh64_intdigest(got.tobytes(), 9))
                sizes.append(len(got))
                keys.append(band_keys(got))
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), pa.array(flat, pa.int64()))
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(1).take(rows), batch.column(2).take(rows), pa.array(np.array(names, np.uint64).view(np.int64)),
             pa.array(sizes, pa.int64()), bands], ["_k1", "_k2", "s", "n", "bands"])


def _sets(batches):
    for batch in batches:
        sets = pa.array([shingles(t).view(np.int64) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["s", "grams"])


def _forest(labels: np.ndarray, sets: list[np.ndarray], least: float) -> set[tuple[int, int]]:
    """Links between labels that connect what pairs of similar sets connect."""
    sizes = np.array([len(g) for g in sets])
    grams, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    rest, out = np.ones(len(sets), bool), set()
    for first in range(len(sets)):
        todo = [first] if rest[first] else []
        rest[first] = False
        while todo and rest.any():
            here = todo.pop()
            own = np.zeros(len(grams), bool)
            own[flat[starts[here] : starts[here] + sizes[here]]] = True
            both = np.add.reduceat(own[flat], starts, dtype=np.int64)
            near = np.nonzero(rest & (both >= least * (sizes + sizes[here] - both)))[0]
            rest[near] = False
            out |= {(int(labels[here]), int(labels[k])) for k in near if labels[k] != labels[here]}
            todo.extend(near.tolist())
    return out


def _walk(least: float):
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        found = _forest(frame["label"].to_numpy(np.int64), [np.asarray(g, np.int64) for g in frame["grams"]], least)
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return one


def links(docs: DataFrame, groups: DataFrame, least: float = LEAST) -> DataFrame:
    """Links (a, b) between labels of ``groups`` (row key, label) that hold a pair of similar texts."""
    texts = docs.select("text", *row_key())
    sketched = texts.mapInArrow(_sketched, "_k1 long, _k2 long, s long, n long, bands array<long>")
    named = sketched.join(groups.select("_k1", "_k2", "label").distinct(), ["_k1", "_k2"])
    nodes = stage(named.dropDuplicates(["s", "label"]), "similar-sets")
    keyed = nodes.select("s", "label", "n", F.explode("bands").alias("key"))
    keys = stage(keyed.groupBy("key").agg(
        F.count("*").alias("m"), F.sum("n").alias("held"), F.min("label").alias("lo"), F.max("label").alias("hi")).where(
        "lo <> hi").select("key", "m", "held"), "similar-keys")
    met = stage(keyed.join(keys, "key"), "similar-buckets")
    few = met.where(F.col("m") <= SMALL).select("key", "s", "label", "n")
    other = few.select("key", *[F.col(c).alias(f"{c}_2") for c in ("s", "label", "n")])
    alike = F.least("n", "n_2") >= F.lit(least) * F.greatest("n", "n_2")
    pairs = stage(few.join(other, "key").where((F.col("label") < F.col("label_2")) & alike).select(
        "s", "label", "s_2", "label_2").distinct(), "similar-pairs")
    many = met.where(F.col("m") > SMALL)
    wanted = pairs.select("s").unionByName(pairs.select(F.col("s_2").alias("s"))).unionByName(many.select("s")).distinct()
    chosen = nodes.join(wanted, "s", "left_semi").groupBy("s").agg(F.min(F.struct("_k1", "_k2")).alias("k")).select("s", "k.*")
    found = texts.join(stage(chosen, "similar-wanted"), ["_k1", "_k2"]).select("s", "text")
    sets = stage(found.mapInArrow(_sets, "s long, grams array<long>").dropDuplicates(["s"]), "similar-shingles")
    both = F.size(F.array_intersect("grams", "grams_2"))
    close = pairs.join(sets, "s").join(sets.select(F.col("s").alias("s_2"), F.col("grams").alias("grams_2")), "s_2").where(
        both >= F.lit(least) * (F.size("grams") + F.size("grams_2") - both)).select(F.col("label").alias("a"), F.col("label_2").alias("b"))
    blocks = F.greatest(F.ceil(F.col("m") / F.lit(BLOCK)), F.ceil(F.col("held") / F.lit(GRAMS))).cast("int")
    spread = many.select("key", "s", "label", blocks.alias("n"), F.pmod(F.xxhash64("s", "label"), blocks).cast("int").alias("own"))
    dealt = spread.select("key", "s", "label", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "s", "label")
    walked = dealt.join(sets, "s").groupBy("key", "i", "j").applyInPandas(_walk(least), "a long, b long")
    return close.unionByName(walked).distinct()
