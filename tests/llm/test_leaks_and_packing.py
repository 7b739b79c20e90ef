import random
import re
import zlib
from collections import Counter

import numpy as np
import odd
import pytest

import corpus_pipeline
from snapstats.llm import decontaminate, packing
from snapstats.llm.queries import QUERIES, tokenizer_path

PLAIN = re.compile(r"[^\W_]+")


def counted(frame, *columns):
    return Counter(tuple(r) for r in (frame.select(*columns) if columns else frame).collect())


# --- decontamination ---------------------------------------------------------------------------------

ITEM = "A train leaves Berlin at 9 and travels 120 km to Hamburg while another train leaves Berlin at 11 on the same line"


def found(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item"]): r for r in decontaminate.matches(docs, bench).collect()}


def test_copies_and_new_parameters_are_found(spark):
    got = found(spark, [
        f"Noise before. {ITEM}. Noise after.",
        ITEM.replace("Berlin", "Paris").replace("Hamburg", "Lyon").replace("120 km", "75 miles").replace("9", "8"),
        ITEM.replace("at 11", "at 12").replace("leaves Berlin at 12", "leaves Rome at 12"),
        ITEM.replace("train", "bus").replace("travels", "goes"),
        "Nothing of the kind is in this text although it is long enough to have windows",
        None, "", "short", ITEM[: len(ITEM) // 2],
    ])
    assert {k: (r["n_slots"] > 0, r["n_changed"], r["consistent"]) for k, r in got.items()} == {
        (0, 0): (True, 0, True), (1, 0): (True, 5, True), (2, 0): (True, 2, True)}


def test_mixed_slots_are_no_match(spark):
    item = "First Anna has 3 red apples and Anna has 3 green apples so Anna eats 3 old apples"
    bad = "First Bob has 4 red apples and Eve has 5 green apples so Tom eats 6 old apples"
    assert not found(spark, [bad], [item])[0, 0]["consistent"]


def test_classes_short_items_and_empty_tables(spark, odd_docs):
    got = found(spark, [ITEM, ITEM], [ITEM, ITEM, None, "too short", "1 2 3 4 5 6 7"])
    assert set(got) == {(0, 0), (1, 0)}
    bench = spark.createDataFrame([(1, odd.rows()[4][1], "x")], "item_id long, text string, doc_id string")
    kept = decontaminate.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert counted(kept) == Counter(r for r in odd.rows() if r[1] != odd.rows()[4][1])
    assert counted(decontaminate.decontaminate(odd_docs, bench.where("false"))) == Counter(odd.rows())
    assert decontaminate.decontaminate(odd_docs.where("false"), bench).count() == 0


def leaks(documents, benchmark):
    """(doc_id, item_id) by five-word windows without case and punctuation: on these tables what templates find."""
    bench = {i: PLAIN.findall((t or "").lower()) for i, t in benchmark}
    out = set()
    for d, text in documents:
        words = PLAIN.findall((text or "").lower())
        held = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item, w in bench.items():
            own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
            if own and len(own & held) >= 0.8 * len(own):
                out.add((d, item))
    return out


def test_leaks_match_brute_force(spark, sf_dir, documents):
    want = leaks(documents, [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()])
    assert want and set(counted(QUERIES["op6_decontamination"](spark, sf_dir), "doc_id", "item_id")) == want


def test_every_variant_of_a_template_is_compared(spark):
    items = ["What is the sum of 4 and 4 in base ten", "What is the sum of 4 and 7 in base ten", "What is the sum of 4 and 7 in base ten"]
    got = found(spark, [f"Noise. {items[1]}", f"{items[0]}. And so on. {items[1]}"], items)
    assert {k: (r["n_changed"], r["consistent"], r["class"], r["n_items"]) for k, r in got.items()} == {
        (0, 0): (1, False, 0, 1), (0, 1): (0, True, 0, 2), (1, 0): (0, True, 0, 1), (1, 1): (0, True, 0, 2)}
    docs = spark.createDataFrame([(0, f"Noise. {items[1]}")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r["item"], r["n_changed"]) for r in decontaminate.item_matches(docs, bench).collect()} == {(0, 1), (1, 0), (2, 0)}
    assert decontaminate.decontaminate(docs, bench).count() == 0


def test_names_at_sentence_starts_numbers_and_units(spark):
    items = [
        "Natalia sold clips to 48 of her friends in April. Natalia then sold half as many clips in May. How many clips did Natalia sell altogether",
        "The shop paid 800 for the old table and then 90 for the lamp before it sold both of them for 1000 in all",
        "A runner covers 12km before noon and another 15km after it and then rests for 9h at home before the last 3km",
    ]
    texts = [
        items[0].replace("Natalia", "Maria").replace("48", "52"),
        items[1].replace("800", "1,250").replace("90", "3.5").replace("1000", "1,253.5"),
        items[2].replace("12km", "5km").replace("15km", "9km").replace("3km", "21 miles"),
        items[0].lower(), "Noise. Noise.  " + items[0].replace("Natalia", "Then") + "\n",
    ]
    got = found(spark, texts, items)
    assert {k: (r["consistent"], r["n_changed"]) for k, r in got.items()} == {
        (0, 0): (True, 2), (1, 1): (True, 3), (2, 2): (True, 4), (4, 0): (True, 1)}


# --- packing -----------------------------------------------------------------------------------------


def pieces_of(documents, capacity):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    out = []
    for d, text in documents:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out.append((d, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return Counter(out)


def check_places(rows, capacity):
    """Sequences without gaps or overflow, and few of them."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    assert len(by) <= 11 / 9 * -(-total // capacity) + 1
    return len(by)


def test_packing_of_documents(spark, sf_dir, documents):
    rows = QUERIES["op8_packing"](spark, sf_dir).collect()
    assert Counter(tuple(r)[:5] for r in rows) == pieces_of(documents, packing.CAPACITY)
    check_places(rows, packing.CAPACITY)


@pytest.mark.parametrize("capacity", [7, 100])
def test_packing_of_odd_rows(spark, odd_docs, capacity, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 50)
    rows = packing.pack(odd_docs, tokenizer_path(), capacity).collect()
    assert Counter(tuple(r)[:5] for r in rows) == pieces_of([(r[0], r[1]) for r in odd.rows()], capacity)
    check_places(rows, capacity)
    assert packing.pack(odd_docs.where("false"), tokenizer_path()).count() == 0


def test_ranks_cover_a_hot_length(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).alias("start"),
                                    F.when(F.col("id") < 900, 5).otherwise(F.col("id") % 7 + 1).cast("long").alias("length"),
                                    F.lit(1).cast("long").alias("ids_crc32"))
    ranks, counts = packing.ranked(rows, bucket_rows=100)
    got = {}
    for r in ranks.collect():
        got.setdefault(r["length"], []).append(r["rank"])
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(n)) for k, n in counts.items()}


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for capacity in (10, 64):
        for _ in range(20):
            counts = Counter(rng.choices(range(1, capacity + 1), k=rng.randint(1, 300)))
            free = []
            for length in sorted(counts.elements(), reverse=True):
                fit = [f for f in free if f >= length]
                if fit:
                    free.remove(min(fit))
                free.append((min(fit) if fit else capacity) - length)
            plan = packing.best_fit(counts, capacity)
            rows = [dict(sequence_id=first + k // each, offset=offset + k % each * length, length=length)
                    for length, _, number, first, each, offset in plan for k in range(number)]
            assert Counter(r["length"] for r in rows) == counts
            assert check_places(rows, capacity) == len(free)


# --- pipeline ----------------------------------------------------------------------------------------


def rejected(text):
    """The rules by hand, from the measures of odd.py and counts of lines and letters."""
    n_words, chars, symbols, dup_lines, repeated = odd.rule_measures(text)
    lines = [x for x in (text or "").split("\n") if x.strip(odd.SPACE)]
    letters, upper = sum(c.isalpha() for c in text or ""), sum(c.isupper() for c in text or "")
    return (n_words < 50 or repeated > n_words / 2 or symbols > 0.3 * n_words or upper > 0.6 * letters
            or dup_lines > len(lines) / 2 or chars < 2 * n_words or chars > 25 * n_words or letters < 0.2 * chars)


def one_of_each_group(rows):
    """Rows left where those within four bits, or of five-word similarity 0.8, are one group; the least id stays."""
    own = {d: c for d, _, c in odd.near_duplicates(rows)}
    sets = {}
    for d, t in rows:
        words = [w.lower() for w in odd.words(t)]
        sets.setdefault(frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)), d)
    sets.pop(frozenset(), None)
    to = {c: c for c in own.values()}

    def root(c):
        while to[c] != c:
            c = to[c]
        return c

    every, similar = list(sets.items()), set()
    for i, (one, d) in enumerate(every):
        for two, e in every[:i]:
            if len(one & two) >= 0.8 * (len(one) + len(two) - len(one & two)):
                low, high = sorted((root(own[d]), root(own[e])))
                to[high] = low
                similar.add((d, e))
    first = {}
    for d, c in own.items():
        first[root(c)] = min(d, first.get(root(c), d))
    return [(d, t) for d, t in rows if first[root(own[d])] == d], similar


def test_pipeline_matches_brute_force(spark, sf_dir, documents):
    rows = [(d, t) for d, t in documents if not rejected(t)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert kept.columns == docs.columns and counted(kept, "doc_id", "text") == Counter(rows)
    low = {}
    key = lambda x: x.strip(odd.SPACE).translate(odd.LOWER)
    for d, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 20:
                low.setdefault(key(x), set()).add(d)
    rows = [(d, "\n".join(x for x in t.split("\n") if len(low.get(key(x), ())) < 3 or max(low[key(x)]) == d)) for d, t in rows]
    kept = corpus_pipeline.STAGES[1][1](spark, kept, sf_dir)
    assert counted(kept, "doc_id", "text", "n_chars") == Counter((d, t, len(t)) for d, t in rows)
    rows, similar = one_of_each_group(rows)
    assert similar
    kept = corpus_pipeline.STAGES[2][1](spark, kept, sf_dir)
    assert kept.columns == docs.columns and counted(kept, "doc_id", "text") == Counter(rows)
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _ in leaks(rows, bench)}
    rows = [(d, t) for d, t in rows if d not in hit]
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(tuple(r)[:5] for r in packed) == pieces_of(rows, packing.CAPACITY)
    check_places(packed, packing.CAPACITY)


def test_words_are_encoded_as_the_tokenizer_does():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    words = packing.Words(coder, 100)
    rng = random.Random(1)
    pool = "aAbz\u00e9\u00c9\u00df\u0130\u0131\u03a3\u03c3\u03c2kK019 .,'!?*\n\t\u00a0\u3000\x1cc\u0301\u0331H\u0308\u6f22\u5b57\u3042ri\u00aa\u00b2\u00bd\U0001f600<|>startoftext&"
    for n in range(8000):
        text = "".join(rng.choices(pool, k=rng.randint(0, 14)))
        text += "<|endoftext|>" + text if n % 50 == 0 else "it's they'LL don'T <|ENDOFTEXT|>." if n % 51 == 0 else ""
        assert words.encoded(text) == np.array(coder.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
