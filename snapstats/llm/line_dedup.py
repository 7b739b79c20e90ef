"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

A run holds, per line key (128 bits of hash), the number of documents seen and the largest id among them, sorted
by hash.  A new batch is merge-anti-joined with what the runs already settle (a key that has reached the document
threshold with an id at least as large has nothing more to learn), and what is left becomes the batch's own run.
``FANOUT`` runs of a level are compacted into one run of the next.  Counts add up and maxima merge, so the runs of
any order of batches give the same verdicts.

Null text: one empty line.  A null doc_id is a document of its own below all others.  Rows that repeat an id count
as one document, and each is rewritten by its own text.  Other columns are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstats.llm.common import SPACES, ascii_lower, row_key, stage, text_of

BATCHES, FANOUT = 4, 2
LOWEST = -(2**63)
HASH = ("_h1", "_h2")
RUN = T.StructType([T.StructField(c, T.LongType()) for c in (*HASH, "n_docs", "last")])


class LineRuns:
    """The levels; every run is a Parquet table below the shared folder."""

    def __init__(self, spark: SparkSession, at_least: int = 3, fanout: int = FANOUT):
        self.spark, self.at_least, self.fanout = spark, at_least, fanout
        self.levels: list[list[DataFrame]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy(*HASH).agg(
            F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))

    def settled(self) -> DataFrame:
        """Keys found in enough documents, with the largest id that holds them."""
        runs = [r for level in self.levels for r in level]
        known = self._merged(runs) if runs else self.spark.createDataFrame([], RUN)
        return known.where(F.col("n_docs") >= self.at_least)

    def add(self, lines: DataFrame) -> None:
        """``lines``: the two hashes and ``_d``, the document, of one batch; a document is in one batch only."""
        keys = lines.select(*HASH, "_d").distinct().groupBy(*HASH).agg(
            F.count("*").alias("n_docs"), F.max("_d").alias("last"))
        if self.levels:
            old = self.settled().select(*HASH, F.col("last").alias("_last"))
            keys = keys.join(old.hint("merge"), [*(keys[h] == old[h] for h in HASH), keys["last"] <= old["_last"]], "left_anti")
        self._push(0, keys)

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stage(run.select(*RUN.names).sortWithinPartitions(*HASH), f"line-run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._merged(full))


def line_hashes(docs: DataFrame, batches: int = BATCHES, least_chars: int = 20) -> DataFrame:
    """One row per line whose key is long enough: batch, document, row key, place and hashes; written once."""
    whole = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("_d"), *row_key(),
                        F.split(text_of(), "\n").alias("lines"))  # keys first: rows of a line carry no text
    rows = whole.select("_d", "_k1", "_k2", F.posexplode_outer("lines").alias("_pos", "line"))
    keyed = rows.select("_d", "_k1", "_k2", "_pos", ascii_lower(F.btrim("line", F.lit(SPACES))).alias("key"))
    return stage(keyed.where(F.char_length("key") >= least_chars).select(
        F.pmod(F.xxhash64("_d"), F.lit(batches)).cast("int").alias("_batch"), "_d", "_k1", "_k2", "_pos",
        F.xxhash64("key").alias("_h1"), F.xxhash64(F.lit(1), "key").alias("_h2")), "lines", "_batch")


def dedup_lines(docs: DataFrame, at_least: int = 3, least_chars: int = 20, batches: int = BATCHES) -> DataFrame:
    """The input with ``text`` rewritten, and ``n_lines`` and ``n_dropped``.

    A key of at least ``least_chars`` characters found in at least ``at_least`` documents loses its lines
    except in the document of the largest id.
    """
    lines = line_hashes(docs, batches, least_chars)
    runs = LineRuns(docs.sparkSession, at_least)
    for k in range(batches):
        runs.add(lines.where(F.col("_batch") == k))
    known = stage(runs.settled(), "settled-lines")
    gone = (lines.join(known, [*HASH]).where(F.col("_d") < F.col("last"))
            .groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set("_pos")).alias("_gone")))
    keys = dict(zip(("_k1", "_k2"), row_key(), strict=True))
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("text").alias("_text"),
                       *keys.values()).join(gone, ["_k1", "_k2"], "left")
    parts = F.split(F.coalesce(F.col("_text"), F.lit("")), "\n")
    rows = rows.select("_row", "_text", "_gone", parts.alias("_parts"))
    starts = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda p: p + 1))
    ends = F.concat(F.col("_gone"), F.array(F.size("_parts")))
    kept = F.flatten(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                                 lambda g: F.slice("_parts", g["a"] + 1, g["b"] - g["a"])))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return rows.select("_row.*", text.alias("text"), F.size("_parts").cast("long").alias("n_lines"),
                       F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
