"""Quality rules as a ledger: every rule is evaluated once per document and kept as a bit beside the
measurements; policies are masks over the bits, and ablations are counts over the distinct bit patterns.

Null texts are empty (no words, every length rule fails).  Columns of the input other than id and text are
not looked at.  Repeated rows give repeated ledger rows.  A doc_id of null is carried through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstats.llm.common import SPACES, byte_words

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")
LEDGER = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)


#: What makes a document fail, over the measurements.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "upper_case": "100 * n_upper > 60 * n_letters",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "few_letters": "100 * n_letters < 20 * word_chars",
}
BIT = {rule: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules."""

    name: str
    version: int
    rules: tuple[str, ...] = tuple(RULES)

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy("all_rules", 1)


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    key = ids[: n - window + 1]
    for k in range(1, window):  # renumbered at each step, so that the product fits 64 bits
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(seen) + ids[k : n - window + 1 + k]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k : n - window + 1 + k] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = byte_words(text)
    lines = text.split("\n")
    full = [x for x in lines if x.strip(SPACES)]
    if text.isascii():
        joined = b"".join(words)
        upper = len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        letters = upper + len(joined) - len(joined.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    else:
        letters = sum(map(str.isalpha, text))
        upper = sum(map(str.isupper, text))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(full) - len(set(full)),
        repeat_words(words),
        len(full),
        letters,
        upper,
    )


def _measure_batches(batches):
    """The first column as it is, and the measurements of the second."""
    for batch in batches:
        got = [measure(t) for t in batch.column(1).to_pylist()]
        columns = list(zip(*got, strict=True)) or [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], [batch.schema.names[0], *MEASURES])


def _bits() -> Column:
    bits = F.lit(0).cast("long")
    for rule, failed in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(BIT[rule])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, measurements, ``failure_bits`` (bit i: the i-th of ``RULES`` failed)."""
    measured = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_measure_batches, LEDGER)
    return measured.withColumn("failure_bits", _bits())


def passes(policy: Policy, bits: str = "failure_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(rows: DataFrame, *policies: Policy) -> DataFrame:
    """A boolean column ``<name>_v<version>`` per policy, from the stored bits alone."""
    return rows.withColumns({f"{p.name}_v{p.version}": passes(p) for p in policies})


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, fail it alone (kept again without it), and are rejected.

    The rows are first counted per bit pattern (at most 2^rules of them), so one narrow shuffle serves all rules.
    """
    spark = rows.sparkSession
    patterns = rows.groupBy(F.col("failure_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                               for r in policy.rules])).alias("r")
    rejected = F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0))
    counted = patterns.select("bits", "n", each).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        rejected.alias("n_rejected"))
    names = spark.createDataFrame([(r,) for r in policy.rules], "rule string")
    return names.join(counted, "rule", "left").fillna(0)


def filter_documents(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The rows that the policy keeps, with their columns unchanged."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    kind = whole.schema["row"]
    schema = T.StructType([kind, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    measured = whole.mapInArrow(_measure_batches, schema)
    return measured.where(_bits().bitwiseAND(F.lit(policy.mask)) == 0).select("row.*")
