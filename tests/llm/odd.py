"""Awkward rows and brute-force versions that the tests compare with."""

import hashlib
import re

import xxhash

SPACE = " \t\n\x0b\x0c\r"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
LINE = "This line is long enough to be a key"


def rows():
    """(doc_id, text, lang, source, n_chars, _k1, line): nulls, blanks, repeats, ties, long texts, clashing names."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts = [
        (1, None), (2, ""), (3, " \n\t\n"), (4, base), (5, base), (5, base), (None, base), (None, None),
        (6, f"{LINE}\nother\n  {LINE.upper()}  \n{LINE}"), (7, f"{LINE}\n{LINE}"), (8, f"x\n{LINE}\n\ny"), (9, LINE),
        (9, f"second text of nine\n{LINE}"), (None, f"{LINE}\nnull holds it too"),
        (10, "Éa ÉA ßx ÄÖ nbsp  em \x1cfs " * 3), (11, "word " * 40_000), (12, "\n".join(f"line number {i % 977} of many" for i in range(20_000))),
        (13, "\U0001f600 emoji Á combining \x00 nul"), (14, "a b c"), (15, "one"), (16, " ".join(f"w{i}" for i in range(400))),
        (17, " ".join(f"w{i}" for i in range(399)) + " changed"), (18, "THIS IS LOUD!! " * 30), (19, "the*** a&&& of%%% " * 30),
    ]
    return [(d, t, "en", "s", len(t or ""), i, "clash") for i, (d, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k1 long, line string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(documents):
    """[(doc_id, n_lines, n_dropped, sha)] in the input's order."""
    key = lambda x: x.strip(SPACE).translate(LOWER)
    low = -(2**63)
    held = {}
    for d, t in documents:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                held.setdefault(key(x), set()).add(low if d is None else d)
    out = []
    for d, t in documents:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == (low if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def fingerprint(text):
    got = words((text or "").translate(LOWER))
    if not got:
        return 0
    shingles = [got[k : k + 4] for k in range(max(1, len(got) - 3))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(documents, most=4):
    """[(doc_id, fingerprint, component_id)]."""
    fps = [fingerprint(t) for _, t in documents]
    nodes = sorted(set(fps))
    label = {f: f for f in nodes}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for i, f in enumerate(nodes):
        for g in nodes[:i]:
            if (f ^ g).bit_count() <= most:
                label[root(f)] = root(g)
    least = {}
    for (d, _), f in zip(documents, fps, strict=True):
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return [(d, f"{f:016x}", least.get(root(f))) for (d, _), f in zip(documents, fps, strict=True)]


def rule_measures(text):
    text = text or ""
    got = words(text)
    seen = {}
    for k in range(len(got) - 2):
        seen.setdefault(tuple(got[k : k + 3]), []).append(k)
    repeated = {k + o for places in seen.values() if len(places) > 1 for k in places for o in range(3)}
    full = [x for x in text.split("\n") if words(x)]
    return (len(got), sum(map(len, got)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(repeated))
