"""Benchmark decontamination by templates, in DataFrame operations only.

Numbers (with their separators and decimals), names (capitalised words inside a sentence) and units after a number
become typed placeholders; windows of five template words of documents meet those of benchmark items by hash.
Capitalised words elsewhere may be names or not: a window that holds any has a second hash, in which they are names.
A fixed-size bit table of the benchmark's hashes (2^20 bits, whatever the benchmark's size) is tested inside the
document's own row first, so that only windows that may match are shuffled.  An item is found in a document where at
least 0.8 of its distinct windows are.  Then the words in the slots are compared along each alignment: a value of the
item must always become the same value, else the match is only a coincidence of placeholders; equal values mean a
copy, others a re-parameterised one.

Items of fewer than five words are too short to tell and never match, and so are windows of fewer than
``LITERALS`` plain words; null texts are empty.  Items of the same template are one class, whose windows are joined
once; a variant is what the class's items of equal words are, named by the smallest item_id, and each is compared with
the document by itself.  Repeated rows of a document are found alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import row_key, stage, text_of

WINDOW, LITERALS, SHARE = 5, 2, 0.8
BITS = 20
#: Units of measure that follow a number.
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "min", "h", "hours", "minutes", "seconds", "days",
         "weeks", "months", "years", "percent", "dollars", "euros", "usd", "eur", "miles", "feet", "inches", "pounds",
         "meters", "metres", "liters", "litres", "grams", "degrees", "mph")
#: A marked word: the mark, one letter of type, and the word itself.  Type s: a capital that sentences start with.
MARK = "¤"
#: A number where a word may start: its separators and decimals stay with it.
NUMBER = rf"\p{{N}}(?<![\p{{L}}\p{{N}}{MARK}].)(?:[.,]?\p{{N}}+)*+"


def marked_words(text: Column) -> Column:
    """Lower-case words; those in slots carry their type before them.

    The patterns test the character itself first and look behind only where it is of the kind sought.
    """
    text = F.replace(text, F.lit(MARK), F.lit(" "))
    named = F.regexp_replace(text, r"\p{Lu}(?<=[\p{Ll}\p{N},;] .)", f"{MARK}n$0")
    named = F.regexp_replace(named, rf"\p{{Lu}}(?<![\p{{L}}\p{{N}}{MARK}].)", f"{MARK}s$0")
    united = F.regexp_replace(named, rf"({NUMBER} ?)((?i:{'|'.join(UNITS)})(?!\p{{L}}))", f"$1 {MARK}u$2")
    numbered = F.regexp_replace(united, NUMBER, f"{MARK}d$0")
    whole = F.when(text.rlike(r"\p{N}"), numbered).otherwise(named)
    # a point or comma between two digits stays in the number
    between = rf"[^\p{{L}}\p{{N}}{MARK}.,]++|[.,](?:(?!\p{{N}})|(?<!\p{{N}}.))"
    return F.array_remove(F.split(F.lower(whole), between), "")


def bare(word: Column) -> Column:
    """The word without its mark."""
    return F.when(word.startswith(MARK), F.substr(word, F.lit(3))).otherwise(word)


def template(words: Column) -> Column:
    plain = F.lit(f"{MARK}s")
    return F.transform(words, lambda w: F.when(w.startswith(plain), F.substr(w, F.lit(3))).when(
        w.startswith(MARK), F.substring(w, 1, 2)).otherwise(w))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it or the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def codes(words: Column, names: bool = False) -> Column:
    """A hash per template word; with ``names`` a capital that sentences start with is a name."""
    start = F.xxhash64(F.lit(f"{MARK}n")) if names else None
    return F.transform(words, lambda w: F.when(~w.startswith(MARK), F.xxhash64(w)).when(
        w.startswith(f"{MARK}s"), F.xxhash64(F.substr(w, F.lit(3))) if start is None else start).otherwise(F.xxhash64(F.substring(w, 1, 2))))


def windows(hashes: Column, size: int = WINDOW) -> Column:
    """The hash of each window of ``size`` word hashes, in order; empty for short texts."""
    return let(hashes, lambda h: F.when(F.size(h) >= size, F.transform(
        F.sequence(F.lit(1), F.size(h) - (size - 1)), lambda i: F.xxhash64(F.slice(h, i, size)))).otherwise(F.array().cast("array<long>")))


def item_windows(words: Column, size: int = WINDOW) -> Column:
    """The hashes of each window of words, null where too few of them are plain.

    ``h`` takes a capital that sentences start with as a plain word, ``g`` (null without any) as a name.  As equal
    templates have equally many plain words, this test is made on the side of the benchmark only.
    """
    def at(h: Column, g: Column, part: Column) -> Column:
        slots = F.size(F.filter(part, lambda w: w.startswith(MARK)))
        starts = F.size(F.filter(part, lambda w: w.startswith(f"{MARK}s")))
        return F.struct(F.when(slots - starts <= size - LITERALS, h).alias("h"),
                        F.when((starts > 0) & (slots <= size - LITERALS), g).alias("g"))

    both = F.arrays_zip(windows(codes(words), size).alias("h"), windows(codes(words, True), size).alias("g"))
    return F.transform(both, lambda x, i: at(x["h"], x["g"], F.slice(words, i + 1, size)))


def _bit_table(hashes: DataFrame, bits: int = BITS) -> DataFrame:
    """One row: an array of 2^bits bits as longs, set at the low bits of the hashes."""
    words = 1 << (bits - 6)
    low = hashes.select(F.pmod("h", F.lit(1 << bits)).alias("b"))
    filled = low.groupBy(F.shiftright("b", 6).cast("int").alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v"))
    none = hashes.sparkSession.range(words).select(F.col("id").cast("int").alias("i"), F.lit(0).cast("long").alias("v"))
    return none.unionByName(filled).groupBy("i").agg(F.bit_or("v").alias("v")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("bits"))


def benchmark_items(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """member (item_id), its words, ``w`` (windows, those of the class), ``t``, the variant it belongs to, and the class ``item``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("member"), marked_words(text_of()).alias("words"))
    # a passage's first word may or may not look like a name where it stands, so no window starts there
    every = item_windows(F.col("words"), size)
    none = F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("g"))
    rows = items.select("member", "words", let(every, lambda w: F.when(F.size(w) > 1, F.concat(
        F.array(none), F.slice(w, 2, F.size(w)))).otherwise(w)).alias("w"), F.xxhash64(template(F.col("words"))).alias("t"))
    rows = stage(rows.withColumn("v", F.transform("words", bare)), "benchmark-items")
    variants = rows.groupBy("w", "t", "v").agg(F.min("member").alias("variant"))
    classes = variants.groupBy("w", "t").agg(F.min("variant").alias("item"))
    return stage(rows.join(variants, ["w", "t", "v"]).join(classes, ["w", "t"]).select(
        "member", "variant", "item", "words", "w"), "benchmark-members")


def benchmark_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants (item, variant, n_items, words) and the windows of classes (item, n distinct windows, place, own, h)."""
    variants = items.groupBy("item", "variant").agg(F.count("*").alias("n_items"), F.min_by("words", "member").alias("words"))
    own = F.transform("w", lambda x: x["h"])
    distinct = F.array_distinct(F.filter(own, lambda h: h.isNotNull()))
    classes = items.where("member = item").dropDuplicates(["item"]).select("item", "w", F.size(distinct).alias("n")).where("n > 0")
    each = classes.select("item", "n", F.posexplode("w").alias("place", "x"))
    places = each.select("item", "n", "place", F.col("x.h").alias("own"), F.explode(F.array_distinct(F.array("x.h", "x.g"))).alias("h"))
    return variants, places.where("own is not null and h is not null")


def matches(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, size: int = WINDOW) -> DataFrame:
    """One row per document row and variant of items found in it; ``class`` is the least item of its template."""
    return _matches(docs, benchmark_items(benchmark, size), share, size)


def item_matches(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, size: int = WINDOW) -> DataFrame:
    """One row per document row and item found in it: `matches` with every member of a variant in its own row."""
    items = benchmark_items(benchmark, size)
    found = _matches(docs, items, share, size)
    return found.join(items.select("member", F.col("variant").alias("item")), "item").withColumn("item", F.col("member")).drop("member")


def _matches(docs: DataFrame, items: DataFrame, share: float, size: int) -> DataFrame:
    variants, places = benchmark_windows(items)
    places = stage(places, "benchmark-windows")
    variants = stage(variants, "benchmark-variants")
    bits = stage(_bit_table(places.select("h")), "benchmark-bits")
    table = bits.select("bits").scalar()

    def hit(h: Column) -> Column:
        low = h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
        return F.getbit(F.get("bits", F.shiftright(low, 6)), low.bitwiseAND(F.lit(63))) == 1

    def found(words: Column) -> Column:
        """The windows whose bit is set: hash, place and words."""
        def placed(w: Column) -> Column:
            return F.transform(F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda q: hit(F.get(w, q))), lambda q: F.struct(
                F.get(w, q).alias("h"), q.alias("q"), F.slice(words, q + 1, size).alias("doc_words")))

        none = F.array().cast("array<struct<h:long,q:int,doc_words:array<string>>>")
        plain = let(windows(codes(words), size), placed)
        names = F.when(F.exists(words, lambda w: w.startswith(f"{MARK}s")), let(windows(codes(words, True), size), placed)).otherwise(none)
        return F.when(F.size(words) >= size, F.concat(plain, names)).otherwise(none)

    # the outer explode keeps the optimizer from testing the array in a filter, which would compute it twice
    hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text", table.alias("bits")).select(
        "doc_id", "_k1", "_k2", F.explode_outer(let(marked_words(text_of()), found)).alias("f")).where("f is not null").select(
        "doc_id", "_k1", "_k2", "f.*")
    hits = stage(hits.distinct(), "window-hits")
    met = hits.join(places, "h").drop("h")
    met = stage(met.withColumn("line", F.col("q") - F.col("place")), "window-matches")
    pair = ["_k1", "_k2", "item"]
    covered = met.groupBy(*pair, "own").agg(F.max("n").alias("n"), F.max("doc_id").alias("doc_id")).groupBy(*pair).agg(
        F.count("*").alias("n_windows"), F.max("n").alias("n"), F.max("doc_id").alias("doc_id"))
    covered = stage(covered.where(F.col("n_windows") >= F.lit(share) * F.col("n")), "window-coverage")
    one = [*pair, "variant"]
    read = met.join(covered.select(*pair), pair, "left_semi").select(*pair, "line", "place", "q", "doc_words").distinct()
    read = read.join(variants.select("item", "variant", "words"), "item").withColumn(
        "item_words", F.slice("words", F.col("place") + 1, size)).drop("words")
    same = F.transform("item_words", bare) == F.transform("doc_words", bare)
    read = stage(read.withColumn("same", same.cast("int")), "window-variants")
    # a place of the item is read where most windows lie on the same line of alignment, a verbatim one first
    support = read.groupBy(*one, "line").agg(F.count("*").alias("m"), F.sum("same").alias("e"))
    best = read.join(support, [*one, "line"]).groupBy(*one, "place").agg(
        F.max_by(F.struct("item_words", "doc_words"), F.struct("m", "e", "line", "q")).alias("best")).select(*one, "best.*")
    slots = best.select(*one, F.explode(F.arrays_zip("item_words", "doc_words")).alias("s"))
    slots = slots.where(F.col("s.item_words").startswith(MARK)).select(
        *one, F.col("s.item_words").startswith(f"{MARK}s").alias("start"), bare(F.col("s.item_words")).alias("value"), bare(F.col("s.doc_words")).alias("got"))
    slots = slots.groupBy(*one, "value").agg(F.min("start").alias("start"), F.min("got").alias("low"), F.max("got").alias("high"))
    changed = (F.col("low") != F.col("value")) | (F.col("high") != F.col("value"))
    # a capital that only starts sentences is a slot where it changed
    slots = slots.where(~F.col("start") | changed).groupBy(*one).agg(
        F.count("*").alias("n_slots"), F.count_if(F.col("low") != F.col("high")).alias("n_mixed"), F.count_if(changed).alias("n_changed"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    every = covered.join(variants.select("item", "variant", "n_items"), "item").join(slots, one, "left")
    return every.select(
        "doc_id", "_k1", "_k2", F.col("variant").alias("item"), F.col("item").alias("class"), "n_items",
        (F.col("n_windows") / F.col("n")).alias("coverage"), "n_windows", zero("n_slots"), zero("n_changed"),
        (zero("n_mixed") * 2 <= zero("n_slots")).alias("consistent"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows in which no item is found, with their columns unchanged."""
    found = matches(docs, benchmark, share).where("consistent").select("_k1", "_k2").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(row, *row_key()).join(found, ["_k1", "_k2"], "left_anti").select("_row.*")
