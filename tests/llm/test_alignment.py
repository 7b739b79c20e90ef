import hashlib
import random
from collections import Counter

import numpy as np
import odd
import pytest

from snapstats.llm import alignment
from snapstats.llm.queries import QUERIES, tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
POOL = "aAbzéÉßİK019 .,'!?*\n\t 　\x1c\x85 ć漢あri\U0001f600<|>_-   \x00tsllre"


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(tokenizer_path(A), tokenizer_path(B))


@pytest.fixture(scope="module")
def groups():
    """The groups of a whole text by the plain libraries; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    one, two = Tokenizer.from_file(tokenizer_path(A)), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    one.encode_special_tokens = True
    letters = alignment.byte_letters()
    assert ByteLevel().decode(["".join(letters)]) == bytes(letters.values()).decode("utf-8", "replace")

    def of(text):
        if not text:
            return None
        a, b, want = one.encode(f" {text}", add_special_tokens=False).ids, two.encode(text), f" {text}".encode()
        bytes_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [two.id_to_piece(i)]]
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            return None
        out, i, j, at_a, at_b, left, right = [], 0, 0, 0, 0, [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                at_a += len(bytes_a[i])
                left.append(a[i])
                i += 1
            else:
                at_b += len(bytes_b[j])
                right.append(b[j])
                j += 1
            if at_a == at_b:
                out.append((left, right))
                left, right = [], []
        return out

    return of


def brute(documents, groups):
    links, base = [], []
    for d, text in documents:
        own = groups(text)
        links.append(Counter((x, y) for left, right in own or () for x in left for y in right))
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own or ())
        base.append((d, sum(len(x) for x, _ in own or ()), sum(len(y) for _, y in own or ()), len(own or ()), links[-1].total(),
                     hashlib.sha256(shown.encode()).hexdigest() if own else ""))
    held = Counter(p for x in links for p in x)
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return Counter((*row, sum(n for p, n in x.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in x.items())) for row, x in zip(base, links, strict=True))


def odd_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choices(POOL, k=rng.randint(0, 40))) for _ in range(400)]
    texts += ["x " * 9, " ", "  ", "\n", "a\n ", "a \n", "<|endoftext|> <s></s> <0x41>", "▁ ▁a", "\U0001f600" * 300, "it's they'LL don'T", " " * 300 + "\n" * 300]
    return [(i % 90 or None, t) for i, t in enumerate(texts)]


def test_segments_give_the_ids_of_whole_texts(encoders, groups):
    segments = alignment.Segments(encoders)
    documents = odd_texts()
    sizes, shas, _, _, _ = alignment.part_of([t for _, t in documents], segments)
    for (_, text), size, sha in zip(documents, sizes.tolist(), shas, strict=True):
        own = groups(text) or ()
        assert size[:3] == [sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own)], text
        assert bool(sha) == bool(own)


def test_queries_match_brute_force(spark, sf_dir, documents, groups):
    rows = QUERIES["op12_alignment"](spark, sf_dir)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert Counter(tuple(r) for r in rows.select(names).collect()) == brute(documents, groups)


@pytest.mark.parametrize("batch_bytes, slice_bytes", [(1, 20), (500, 1 << 20), (1 << 24, 1 << 24)])
def test_odd_rows_in_any_batches(spark, groups, batch_bytes, slice_bytes):
    documents = odd_texts() + [(r[0], r[1]) for r in odd.rows()]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in documents], "doc_id long, text string, batch int, docs string").repartition(3)
    rows = alignment.align(frame, tokenizer_path(A), tokenizer_path(B), batch_bytes, slice_bytes)
    assert Counter(tuple(r) for r in rows.collect()) == Counter((*r[:6], *r[6:]) for r in brute(documents, groups).elements())


def test_empty_table(spark, odd_docs):
    assert alignment.align(odd_docs.where("false"), tokenizer_path(A), tokenizer_path(B)).count() == 0


def test_runs_are_merged_and_answered(monkeypatch):
    rng = np.random.default_rng(2)
    for block in (1, 3, 4096):
        monkeypatch.setattr(alignment, "BLOCK", block)
        sets = [np.unique(rng.integers(0, 40, n) << 16 | rng.integers(0, 6, n)) for n in (0, 1, 50, 90, 200)]
        counts = [rng.integers(1, 9, len(s)) for s in sets]
        runs = []
        for keys, values in zip(sets, counts, strict=True):
            writer = alignment.Writer()
            writer.add(keys, values)
            runs.append(writer.close())
        total, most = Counter(), Counter()
        for keys, values in zip(sets, counts, strict=True):
            total.update(dict(zip(keys.tolist(), values.tolist(), strict=True)))
        for key, n in total.items():
            most[key >> 16] = max(most[key >> 16], n)
        got = [(k, v) for keys, values in alignment.merged(runs) for k, v in zip(keys.tolist(), values.tolist(), strict=True)]
        assert got == sorted(total.items())
        for keys, run in zip(sets, alignment.handed_back(alignment.with_best(alignment.merged(runs)), runs), strict=True):
            back = [(k, v) for own, values in alignment.blocks(run) for k, v in zip(own.tolist(), values.tolist(), strict=True)]
            assert back == [(k, 2 * total[k] + (total[k] == most[k >> 16])) for k in keys.tolist()]


def test_large_groups_are_counted_by_id(encoders, monkeypatch):
    texts = ["\U0001f600\U0001f601 éé", "\U00012345" * 30, "plain words"]
    want = alignment.part_of(texts, alignment.Segments(encoders))
    monkeypatch.setattr(alignment, "MANY_LINKS", 0)
    got = alignment.part_of(texts, alignment.Segments(encoders))
    assert all(np.array_equal(x, y) for x, y in zip(want, got, strict=True))
