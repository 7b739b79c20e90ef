"""Secret scans with corpus-wide ownership, in DataFrame operations only.

Candidates are spans of four kinds: assignments of a value to a secret's name, access keys, long hex runs, and other
long mixed tokens.  Over the corpus, each candidate's value is counted by distinct repositories (documents) and
distinct owners (sources).  Equal texts count as one repository, and each source as an owner.  A value in
``COPIED_OWNERS`` owners or ``COPIED_REPOS`` repositories is a copied example; any other is live-looking.  The first
three kinds are always reported, with that verdict; a mixed token becomes a span of kind ``live`` unless it is copied
or lies in another span.

Places are code points.  They come from the pieces between matches, so that a text of many matches takes time in
proportion.  Null text is empty; a null source is an owner of its own; a null doc_id is a repository of its own.
Rows equal in id and text are scanned once and reported each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstats.llm.common import row_key, stage, text_of

#: Kinds in the order of the report: pattern and the group that is the value.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    "access": (r"AKIA[A-Z0-9]{16,}", 0),
    "hex": (r"[0-9a-f]{24,}", 0),
    "live": (r"[A-Za-z0-9_-]{20,}", 0),
}
ORDER = {kind: i for i, kind in enumerate(KINDS)}
LEAST_VALUE, LEAST_SIGNS, COPIED_OWNERS, COPIED_REPOS = 6, 10, 3, 100


def _mixed(value: Column) -> Column:
    """Digits, letters, and many different characters."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_SIGNS)


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """Row key, owner, kind, start, end, value of every candidate span."""
    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("_repo"), F.col(f"`{owner}`").cast("string").alias("_owner"),
                       text_of().alias("_text"), F.xxhash64(text_of()).alias("_same"))
    some = F.lit(False)
    for pattern, _ in KINDS.values():
        some = some | F.col("_text").rlike(pattern)
    found = F.array(*[
        F.struct(F.lit(ORDER[kind]).alias("kind"), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)).alias("matches"),
                 F.regexp_extract_all("_text", F.lit(pattern), F.lit(group)).alias("values"),
                 F.split("_text", pattern, -1).alias("between"))
        for kind, (pattern, group) in KINDS.items()])
    kinds = rows.where(some).select("_k1", "_k2", "_repo", "_owner", "_same", F.explode(found).alias("f"))
    each = kinds.select("_k1", "_k2", "_repo", "_owner", "_same", F.col("f.kind").alias("kind"), F.posexplode_outer(F.arrays_zip(
        F.col("f.matches").alias("m"), F.col("f.values").alias("v"), F.col("f.between").alias("b"))).alias("i", "x"))
    each = each.where("x.m is not null").select(
        "_k1", "_k2", "_repo", "_owner", "_same", "kind", "i", F.col("x.v").alias("value"), F.char_length("x.m").alias("m"), F.char_length("x.b").alias("b")).distinct()
    so_far = F.sum(F.col("m") + F.col("b")).over(Window.partitionBy("_k1", "_k2", "_owner", "kind").orderBy("i"))
    placed = each.withColumn("end", so_far).withColumn("start", F.col("end") - F.col("m"))
    good = F.when(F.col("kind") == ORDER["assign"], F.char_length("value") >= LEAST_VALUE).when(
        F.col("kind") == ORDER["live"], _mixed(F.col("value"))).otherwise(True)
    return placed.where(good).select("_k1", "_k2", "_repo", "_owner", "_same", "kind", "start", "end", "value")


def ownership(spans: DataFrame) -> DataFrame:
    """Per value: distinct repositories (equal texts are one) and owners.  Made distinct first, so that a hot value is spread."""
    value = [F.xxhash64("value").alias("h1"), F.xxhash64(F.lit(1), "value").alias("h2")]
    held = spans.select(*value, "_same", F.coalesce("_repo", "_k1").alias("_repo"), "_owner")
    repos = held.groupBy("h1", "h2", "_same").agg(F.min("_repo").alias("_repo")).select("h1", "h2", "_repo").distinct()
    owners = held.select("h1", "h2", "_owner").distinct()
    return repos.groupBy("h1", "h2").agg(F.count("*").alias("n_repos")).join(
        owners.groupBy("h1", "h2").agg(F.count("*").alias("n_owners")), ["h1", "h2"])


def scan(docs: DataFrame, owner: str = "source", copied_owners: int = COPIED_OWNERS,
         copied_repos: int = COPIED_REPOS) -> DataFrame:
    """doc_id, ``base`` and ``spans`` (sorted arrays of kind, start, end, and whether copied) of every row."""
    spans = stage(candidates(docs, owner), "secret-spans")
    owned = stage(ownership(spans), "secret-owners")
    keyed = spans.withColumns({"h1": F.xxhash64("value"), "h2": F.xxhash64(F.lit(1), "value")})
    judged = keyed.join(owned, ["h1", "h2"])
    copied = (F.col("n_owners") >= copied_owners) | (F.col("n_repos") >= copied_repos)
    one = F.struct(F.col("start").cast("long").alias("start"), F.col("kind"), F.col("end").cast("long").alias("end"),
                   F.col("n_owners"), F.col("n_repos"), copied.alias("copied"))
    live = F.col("kind") == ORDER["live"]
    # a base span that covers a mixed token is found by the last end before it, in order
    before = F.max(F.when(~live, F.col("end"))).over(
        Window.partitionBy("_k1", "_k2", "_owner").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(~live, F.col("start"))).over(
        Window.partitionBy("_k1", "_k2", "_owner").orderBy(F.col("start"), F.col("kind")).rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    kept = judged.withColumn("free", free).where(~live | (F.col("free") & ~copied))
    by_row = kept.groupBy("_k1", "_k2", "_owner").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), F.col(f"`{owner}`").cast("string").alias("_owner"))
    same = (rows["_k1"] == by_row["_k1"]) & (rows["_k2"] == by_row["_k2"]) & rows["_owner"].eqNullSafe(by_row["_owner"])
    every = F.coalesce(by_row["spans"], F.array().cast(by_row.schema["spans"].dataType))
    return rows.join(by_row, same, "left").select("doc_id", every.alias("spans")).select(
        "doc_id", F.filter("spans", lambda s: s["kind"] != ORDER["live"]).alias("base"), "spans",
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
        F.size(F.filter("spans", lambda s: ~s["copied"])).cast("long").alias("n_owner_specific"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(kind: str, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == ORDER[kind])).cast("long")
