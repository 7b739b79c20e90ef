import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import odd

from snapstats.llm import interpolation, quality_classifier, warc
from snapstats.llm.common import labelled
from snapstats.llm.queries import QUERIES


def counted(frame, *columns):
    return Counter(tuple(r) for r in (frame.select(*columns) if columns else frame).collect())


# --- archives ----------------------------------------------------------------------------------------


def wanted(pages):
    body = [(p, (h or "").encode()) for p, _, h in pages]
    least = {}
    for p, b in body:
        if len(b) >= 100 and p is not None:
            least[b] = min(p, least.get(b, p))
    out = Counter()
    for p, b in body:
        first = least.get(b)
        again = first is not None and p != first
        out[(p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
    return out


def test_archives_of_pages(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert counted(QUERIES["op5_warc"](spark, sf_dir)) == wanted(pages)


def test_archives_of_odd_pages(spark):
    long = "<p>" + "x" * 200 + "</p>"
    pages = [(5, "http://a/\r\nX: y", long), (3, None, long), (3, "http://b", long), (9, "u", long), (None, "n", long), (None, None, None),
             (7, "", "short"), (8, "", "short"), (-4, "é", "\r\n\r\n" * 100), (2**62, "far", "é" * 60), (1, "z", "é" * 60), (6, "m", "w" * 400_000)]
    pages += [(i, "d", f"page {i} " * 40) for i in range(100, 160)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for roll, shard in ((1 << 24, 1 << 24), (500, 4000)):
        out = warc.round_trip(frame.selectExpr("*", "1 as digest", "2 as shard"), roll, shard)
        assert counted(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == wanted(pages)
    assert out.select("file").distinct().count() > 10
    assert warc.round_trip(frame.where("false")).count() == 0


def test_archives_are_the_same_again(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"u{i}", f"page {i % 40} " * 30) for i in range(200)], "page_id long, url string, html string")
    first = counted(warc.write_archives(frame, f"file://{tmp_path}/a", 2000, 20_000))
    again = counted(warc.write_archives(frame.repartition(7), f"file://{tmp_path}/b", 2000, 20_000))
    assert first == again and len(first) > 5
    assert not list(tmp_path.glob("*/*.tmp"))


# --- quality classifier ------------------------------------------------------------------------------


def test_long_words_give_all_their_grams(monkeypatch):
    monkeypatch.setattr(quality_classifier, "BLOCK", 50)
    for word in ("\u6f22\u5b57\u3042\u00e9" * 9 + "tail of x" * 30).replace(" ", "").encode(), bytes(range(33, 250)) * 3, b"a" * 65, b"b" * 64:
        marked = b"<" + word + b">"
        grams = {marked[k : k + n] for n in (3, 4) for k in range(len(marked) - n + 1)}
        want = Counter([zlib.crc32(word) % quality_classifier.BUCKETS, *(zlib.crc32(g, 7) % quality_classifier.BUCKETS for g in grams)])
        reader = quality_classifier.Features()
        assert Counter(reader.word(word)[1].tolist()) == want
        assert (word in reader.memo) == (len(word) <= 64)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.93 * len(held)


def test_large_texts_leave_room_for_the_others(spark):
    from pyspark.sql import functions as F

    texts = [(i, ("x" * 900 if i < 20 else f"text {i}") * (20 if i < 3 else 1)) for i in range(60)] + [(7, "second text of seven"), (30, "text 30")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    for most, room in ((1000, 200_000), (1000, 9_000), (25, 200_000), (1000, 90_000)):
        got = labelled(docs, labels, F.lit(True), "quality", most, room)
        fit = {(d, t) for d, t in texts if len(t) <= room // 100}
        assert len(got) <= most and sum(len(t) for t, _ in got) <= room
        assert len(got) == min(most, len(fit) if room > 50_000 else len(got)) and len(got) > 20
    texts = [(i, "y" * 80) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert len(labelled(docs, labels, F.lit(True), "quality", 1000, 8_050)) == 80
    assert len(labelled(docs, labels, F.lit(True), "quality", 1000, 8_000)) == 80
    assert len(labelled(docs, labels, F.lit(True), "quality", 10, 8_000)) == 10


def test_scores_do_not_hang_on_parts(spark, monkeypatch):
    texts = ["", None, "one", "two words", "a b a b c", "one"] * 5
    model = quality_classifier.train([("one two", 1), ("a b", 0)] * 5)
    index = quality_classifier.Index(model.weights)
    want = quality_classifier.logits(texts, index, model.bias)
    monkeypatch.setattr(quality_classifier, "PART", 3)
    monkeypatch.setattr(quality_classifier, "MEMO", 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], 1 / (1 + np.exp(-want)))


def test_scores_of_odd_rows(spark, odd_docs):
    from pyspark.sql import functions as F

    model = quality_classifier.train([("good words here", 1), ("bad*** words&&&", 0)] * 20)
    got = {}
    for r in quality_classifier.score(odd_docs, model).collect():
        got.setdefault(r["doc_id"], set()).add(r["score"])
    assert got[2] == got[3] == got[1] == {1 / (1 + math.exp(-model.bias))} and len(got[5]) == 1
    for d, text in [(r[0], r[1]) for r in odd.rows() if r[0] in (4, 10, 11, 19)]:
        buckets, counts = quality_classifier.Features().document(text)
        logit = model.bias + float((model.weights[buckets].astype(float) * counts).sum() / counts.sum())
        assert math.isclose(next(iter(got[d])), 1 / (1 + math.exp(-logit)), rel_tol=1e-4)
    assert quality_classifier.score(odd_docs.where("false"), model).count() == 0
    labels = spark.createDataFrame([(4, 1, 0), (None, 0, 0), (5, None, 0), (99, 0, 1), (4, 7, 0)], "doc_id long, quality int, text int")
    assert labelled(odd_docs, labels, F.col("doc_id").isNotNull(), "quality", 100, 1 << 24) == [(odd.rows()[3][1], 1)]
    assert {round(r["score"], 3) for r in quality_classifier.quality_scores(odd_docs, labels, F.lit(True)).collect()} == {0.999}
    assert {r["score"] for r in quality_classifier.quality_scores(odd_docs, labels.where("false"), F.lit(True)).collect()} == {0.5}


# --- interpolated language model ---------------------------------------------------------------------


def tokens(text):
    return [w.translate(odd.LOWER) for w in odd.words(text)] + [None]


def base_rows(documents, held):
    count, total = Counter(), 0
    for d, t in documents:
        if not held(d):
            count.update(tokens(t))
            total += len(tokens(t))
    low = lambda w: math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1)))
    return [(d, held(d), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total, sum(map(low, tokens(t)))) for d, t in documents]


def same(frame, want):
    key = lambda r: (r[0] is None, r[0] or 0, *map(repr, r[1:5]), round(r[5], 6))
    got = sorted((tuple(r) for r in frame.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()), key=key)
    want = sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def held_out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


def test_language_model_on_documents(spark, sf_dir, documents):
    out = QUERIES["op2_lm_scores"](spark, sf_dir).cache()
    same(out, base_rows(documents, held_out))
    held = out.where("held_out").selectExpr("sum(score) / sum(n_tokens)", "sum(base_score) / sum(n_tokens)").first()
    assert held[0] > held[1]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("llm_batches")]


def test_language_model_matches_its_formula(spark, documents, monkeypatch):
    """Small batches and shards: counts over all of them, and the probability of every token."""
    from snapstats.llm.common import crc_mod

    monkeypatch.setattr(interpolation, "BATCH_TOKENS", 700)
    monkeypatch.setattr(interpolation, "SHARD_KEYS", 2000)
    kept = []
    monkeypatch.setattr(interpolation, "learn", lambda rows, v, old=interpolation.learn: kept.append(old(rows, v)) or kept[-1])
    some = documents[:60]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    out = interpolation.interpolated_scores(frame, crc_mod("doc_id", 5) == 1).cache()
    same(out, base_rows(some, held_out))
    one, two, total = Counter(), Counter(), 0
    for d, t in some:
        if not held_out(d):
            one.update(tokens(t))
            two.update(zip([None, *tokens(t)], tokens(t), strict=False))
            total += len(tokens(t))
    weights, got = kept[0], {r["doc_id"]: r["score"] for r in out.collect()}
    assert np.allclose(weights.sum(axis=1), 1)
    for d, t in some:
        want = 0.0
        for u, w in zip([None, *tokens(t)], tokens(t), strict=False):
            a, b, c = weights[one[u].bit_length()]
            want += math.log10(a * two[u, w] / max(one[u], 1) + b * one[w] / total + c / (len(one) + 1))
        assert math.isclose(got[d], want, rel_tol=1e-9)


def test_language_model_of_odd_rows(spark, odd_docs):
    from snapstats.llm.common import crc_mod

    same(interpolation.interpolated_scores(odd_docs, crc_mod("doc_id", 5) == 1), base_rows([(r[0], r[1]) for r in odd.rows()], held_out))
    assert interpolation.interpolated_scores(odd_docs.where("false"), crc_mod("doc_id", 5) == 1).count() == 0
    only_held = interpolation.interpolated_scores(odd_docs.where("doc_id = 4"), crc_mod("doc_id", 1) == 0).first()
    assert only_held["train_tokens"] == 0 and only_held["base_score"] == only_held["score"] == 0
