import hashlib
import re
from collections import Counter

import odd

from snapstats.llm import secrets
from snapstats.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def expected(documents):
    return Counter((d, *(sum(s[1] == k for s in base(t)) for k in range(3)), digest(base(t))) for d, t in documents)


def counted(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_base_spans_of_documents(spark, sf_dir, documents):
    got = QUERIES["op4_secrets"](spark, sf_dir)
    assert counted(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == expected(documents)


def run(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, value string, start int")
    out = secrets.scan(frame)
    return out.select("doc_id", secrets.listed(out["base"]).alias("base"), secrets.listed(out["spans"]).alias("spans"),
                      "n_copied", "n_owner_specific").collect()


def test_awkward_matches(spark):
    texts = ["token=token: abcdefgh", "é\U0001f600 PassWord'=  \"ab token='s3cr.et=x' secret:secret=abcdef", "AKIA" * 9 + " AKIA123",
             "x" * 5 + "0123456789abcdef" * 2 + "g" + "a" * 24, None, "", "api_key : ABCDEF12 apikey=\nabcdef", "token = " + "f" * 40,
             "tokenſecret=abcdefg toKen=abcdefg", " ".join(["token=abc", "token=abcdef0", "a" * 30] * 3000)]
    rows = [(i, t, "s", "v", 1) for i, t in enumerate(texts)] + [(3, texts[3], "s", "v", 1), (None, texts[0], None, None, None), (2, texts[7], None, "v", 1)]
    want = Counter((r[0], ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base(r[1]))) for r in rows)
    assert Counter((r["doc_id"], r["base"]) for r in run(spark, rows)) == want
    assert run(spark, rows[:0]) == []


def test_ownership_parts_copies_from_live_tokens(spark):
    live, copied = "Zk3-Qp9_xT7vB2nM4sLw8", "Ex4mple-Key_0123456789AB"
    rows = [(1, f"a {live} b", "one", "v", 1), (2, f"again {live}", "one", "v", 1)]
    rows += [(10 + i, f"see {copied} and token = 'sample-0001'", f"owner{i}", "v", 1) for i in range(4)]
    rows += [(20, f"secret={live}x", "two", "v", 1), (21, "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1", "two", "v", 1)]
    got = {r["doc_id"]: r for r in run(spark, rows)}
    assert got[1]["spans"] == f"live:2:{2 + len(live)}" and got[2]["spans"] == f"live:6:{6 + len(live)}"
    assert got[10]["spans"] == got[10]["base"] != "" and (got[10]["n_copied"], got[10]["n_owner_specific"]) == (1, 0)
    assert got[20]["spans"] == got[20]["base"] != "" and got[20]["n_owner_specific"] == 1
    assert got[21]["spans"] == ""


def test_odd_rows(odd_docs):
    out = secrets.scan(odd_docs)
    assert counted(out, "doc_id") == Counter((r[0],) for r in odd.rows())


def test_no_gap_between_live_and_copied(spark):
    mirrored, two, sample = "Zk3-Qp9_xT7vB2nM4sLw8", "Hq5-Wn2_aK8cV6yR3dJf1", "Ex4mple-Key_0123456789AB"
    rows = [(i, f"a {mirrored} b", f"owner{i}", "v", 1) for i in range(2)]
    rows += [(10 + i, f"text {i} {two}", f"owner{i}", "v", 1) for i in range(2)]
    rows += [(100 + i, f"{i} see {sample}", "hot", "v", 1) for i in range(secrets.COPIED_REPOS)]
    got = {r["doc_id"]: r for r in run(spark, rows)}
    assert all(got[i]["spans"] == f"live:2:{2 + len(mirrored)}" and got[i]["n_owner_specific"] == 1 for i in range(2))
    assert all(got[10 + i]["spans"] == f"live:7:{7 + len(two)}" and got[10 + i]["n_owner_specific"] == 1 for i in range(2))
    assert all(got[100 + i]["spans"] == "" for i in range(secrets.COPIED_REPOS))
