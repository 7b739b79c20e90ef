"""The registered queries of this package: each operator over the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapstats.llm import alignment, decontaminate, interpolation, licenses, line_dedup, packing, quality_classifier, quality_rules, secrets, simhash, toxicity, warc, whitening
from snapstats.llm.common import crc_mod, table, text_of

QUERIES = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the registered queries, by default that of packing."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op7_quality_rules(spark, sf_dir):
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failure_bits",
                       (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
                       quality_rules.passes(quality_rules.STRICT).alias("kept"))


@query
def op3_line_dedup(spark, sf_dir):
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"))


@query
def op9_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_decontamination(spark, sf_dir):
    rows = decontaminate.item_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", F.col("item").alias("item_id"), "coverage", "n_windows", "n_slots", "n_changed", "consistent",
                       F.col("class").alias("class_id"), "n_items")


@query
def op8_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op5_warc(spark, sf_dir):
    rows = warc.round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op1_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    rows = quality_classifier.quality_scores(docs, labels, F.col("doc_id").isNotNull() & ~held_out)
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_lm_scores(spark, sf_dir):
    return interpolation.interpolated_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)


@query
def op4_secrets(spark, sf_dir):
    rows = secrets.scan(table(spark, sf_dir, "documents"))
    base, spans = F.col("base"), F.col("spans")
    return rows.select("doc_id", *[secrets.number_of(k, base).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                       F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"), secrets.listed(spans).alias("spans"),
                       "n_copied", "n_owner_specific")


@query
def op10_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    rows = toxicity.toxicity_scores(docs, labels, F.col("doc_id").isNotNull() & ~held_out)
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                       F.size("sentences").cast("long").alias("n_offending"))


@query
def op12_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
