import random
from collections import Counter

import numpy as np
import odd
import pytest

from snapstats.llm import components, line_dedup, quality_rules, simhash
from snapstats.llm.queries import QUERIES


def counted(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def pairs():
    return [(r[0], r[1]) for r in odd.rows()]


# --- quality rules -----------------------------------------------------------------------------------

MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_rules_match_brute_force(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_rules"](spark, sf_dir).collect()}
    for d, t in documents:
        want = odd.rule_measures(t)
        assert tuple(got[d][m] for m in MEASURED) == want
        assert got[d]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[d]["base_failed"] and got[d]["kept"])


def test_rules_on_odd_rows(odd_docs):
    rows = quality_rules.ledger(odd_docs)
    assert counted(rows, "doc_id", *MEASURED) == Counter((d, *odd.rule_measures(t)) for d, t in pairs())
    kept = quality_rules.filter_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {16, 17}
    assert quality_rules.ledger(odd_docs.where("false")).count() == 0


def test_ablation_counts(odd_docs):
    rows = quality_rules.ledger(odd_docs).cache()
    bits = [r["failure_bits"] for r in rows.collect()]
    mask = quality_rules.STRICT.mask
    got = {r["rule"]: (r["n_failed"], r["n_only"], r["n_rejected"]) for r in quality_rules.ablation(rows, quality_rules.STRICT).collect()}
    for i, rule in enumerate(quality_rules.RULES):
        assert got[rule] == (sum(b >> i & 1 for b in bits), sum(b & mask == 1 << i for b in bits), sum(b & mask != 0 for b in bits))
    both = quality_rules.apply_policies(rows, quality_rules.BASE, quality_rules.STRICT)
    assert both.where("all_rules_v1 and not base_v1").count() == 0


# --- line dedup --------------------------------------------------------------------------------------


def test_lines_match_brute_force(spark, sf_dir, documents):
    got = counted(QUERIES["op3_line_dedup"](spark, sf_dir), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == Counter(odd.line_dedup(documents))


@pytest.mark.parametrize("batches", [1, 5])
def test_lines_of_odd_rows(odd_docs, batches):
    from pyspark.sql import functions as F

    out = line_dedup.dedup_lines(odd_docs, batches=batches).withColumn("sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    assert counted(out, "doc_id", "n_lines", "n_dropped", "sha") == Counter(odd.line_dedup(pairs()))
    assert {"line", "_k1", "source"} <= set(out.columns)


def test_lines_of_no_rows(odd_docs):
    assert line_dedup.dedup_lines(odd_docs.where("false")).count() == 0


def test_runs_skip_settled_keys_and_compact(spark):
    runs = line_dedup.LineRuns(spark, at_least=3, fanout=2)
    batch = lambda ids: spark.createDataFrame([(1, 1, i) for i in ids], "_h1 long, _h2 long, _d long")
    runs.add(batch([50, 60, 70]))
    runs.add(batch([10, 20]))
    assert [len(x) for x in runs.levels] == [0, 1]
    assert [tuple(r) for r in runs.levels[1][0].collect()] == [(1, 1, 3, 70)]  # nothing new in the second batch
    runs.add(batch([90]))
    assert [tuple(r) for r in runs.settled().collect()] == [(1, 1, 4, 90)]


# --- SimHash -----------------------------------------------------------------------------------------


def test_simhash_matches_brute_force(spark, sf_dir, documents):
    got = counted(QUERIES["op9_simhash"](spark, sf_dir), "doc_id", "fingerprint", "component_id")
    assert got == Counter(odd.near_duplicates(documents))


def test_simhash_of_odd_rows(odd_docs):
    from pyspark.sql import functions as F

    out = simhash.near_duplicates(odd_docs).withColumn("f", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    assert counted(out, "doc_id", "f", "component_id") == Counter(odd.near_duplicates(pairs()))
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    classes = {(c, None if c is not None else f) for _, f, c in odd.near_duplicates(pairs())}
    assert kept.count() == len(classes)
    assert simhash.near_duplicates(odd_docs.where("false")).count() == 0
    assert simhash.keep_one(odd_docs.where("false")).count() == 0


def test_golay_keys_meet_within_four_bits():
    rng = random.Random(1)
    errors = simhash._errors()
    assert len(set(errors.tolist())) == 2048
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        place, keys = simhash.golay_keys(np.array([a, b], np.uint64).view(np.int64), errors)
        assert set(keys[place == 0].tolist()) & set(keys[place == 1].tolist())


def test_large_buckets_keep_every_link(spark, monkeypatch):
    """A dense group, chains that leave it, and small blocks: the same components as all pairs."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        f = rng.choice(sorted(fps))
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            f ^= 1 << bit
        fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(60)}
    nodes = sorted(fps)
    label = {f: f for f in nodes}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for i, f in enumerate(nodes):
        for g in nodes[:i]:
            if (f ^ g).bit_count() <= 4:
                label[root(f)] = root(g)
    want = {frozenset(f for f in nodes if root(f) == r) for r in {root(f) for f in nodes}}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    frame = spark.createDataFrame([(signed(f),) for f in nodes], "fp long")
    for small, block in ((1, 7), (10**6, 7), (4, 10**6)):
        monkeypatch.setattr(simhash, "SMALL", small)
        monkeypatch.setattr(simhash, "BLOCK", block)
        found = {}
        for r in components.connected_components(simhash.links(frame)).collect():
            found.setdefault(r["label"], set()).add(r["node"] % (1 << 64))
        linked = {frozenset(s) for s in found.values()}
        assert linked == {s for s in want if len(s) > 1}


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201)], "a long, b long")
    got = {r["node"]: r["label"] for r in components.connected_components(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


# --- five-word similarity ----------------------------------------------------------------------------


def five_words(text):
    got = odd.words((text or "").translate(odd.LOWER))
    return {tuple(got[k : k + 5]) for k in range(len(got) - 4)}


def similarity(a, b):
    return len(a & b) / max(1, len(a | b))


@pytest.mark.parametrize("small, block, grams", [(24, 3, 1 << 22), (1, 3, 1 << 22), (1, 1024, 700)])
def test_keep_one_reaches_five_word_similarity(spark, monkeypatch, small, block, grams):
    """Texts at 0.8 or a little more, far apart by fingerprint, and some just below: as by brute force."""
    from snapstats.llm import similar

    monkeypatch.setattr(similar, "SMALL", small)
    monkeypatch.setattr(similar, "BLOCK", block)
    monkeypatch.setattr(similar, "GRAMS", grams)
    rng = random.Random(4)
    rows = []
    for _ in range(25):
        text = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for changes in (0, 6, 7, 9):
            again = list(text)
            for k in range(changes):
                again[k * 300 // max(1, changes) + 10] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(again)))
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    sets, fps = [five_words(t) for _, t in rows], [odd.fingerprint(t) for _, t in rows]
    far = 0
    for i in range(len(rows)):
        for j in range(i):
            near, alike = (fps[i] ^ fps[j]).bit_count() <= 4, similarity(sets[i], sets[j]) >= 0.8
            far += alike and not near
            if near or alike:
                label[max(root(i), root(j))] = min(root(i), root(j))
    assert far > 10
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {root(i) for i in range(len(rows))}


def test_similarity_of_odd_rows(spark, odd_docs):
    """Null ids and texts, repeated rows, short texts; each row a label of its own."""
    from pyspark.sql import functions as F

    from snapstats.llm import similar
    from snapstats.llm.common import row_key

    long = " ".join(f"w{k}" for k in range(200))
    rows = [(None, long), (None, long), (1, long + " end"), (2, None), (3, ""), (4, "a b c d"), (5, "a b c d"), (6, long.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = docs.select(*row_key(), F.coalesce("doc_id", F.lit(0)).alias("label"))
    found = {tuple(sorted(r)) for r in similar.links(docs, groups).collect()}
    assert found == {(0, 1), (0, 6), (1, 6)}
    assert similar.links(docs.where("false"), groups.where("false")).count() == 0
