"""The filter audit against plain sets of documents."""

import re
from itertools import permutations

import numpy as np

from tessera.llm import filter_audit

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(w) < 100:
            f.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows):
            f.add("E")
        fails.append((lang or "", i, f))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [(i, f) for p, i, f in fails if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, x in enumerate(order):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                shapley[x] += len(gone)
                failing = sum(x in f for _, f in own)
                out[part, "".join(order), k + 1] = [len(left), len(gone), failing - len(gone), sum(f == {x} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(shapley[order[k - 1]])
    return out


def test_audit_against_plain_sets(spark):
    rng = np.random.default_rng(4)
    texts = []
    for k in range(60):
        words = [f"w{x}" for x in rng.integers(0, (400, 60)[k % 2], int(rng.integers(60, 160)))]
        if k % 3 == 0:
            words = [w.upper() for w in words]
        if k % 5 == 0:
            words.append("100%")
        texts.append(" ".join(words))
    rows = [(i, texts[i % 60], ("en", "fr", "de")[i % 3], "s", 0) for i in range(150)]
    rows += [(1000 + i, texts[0], ("en", "")[i % 2], "s", 0) for i in range(80)]  # a third are copies
    rows += [(None, texts[0], "en", None, None)] * 2 + [(5, texts[5], "de", "s", 0)] * 2 + [(2000, None, None, None, None), (2001, "", "", None, None), (2002, "x " * 30_000, "en", "s", 1), (2003, "ÀÉ ß", "xx", "s", 1)]
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 1100, 3)] + [(6, None, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as A", "'x' as part", "2 as `digest`", "3 as `a.b`")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'z' as text")
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in filter_audit.audit(docs, marks).collect()}
    assert got == plain(rows, labels)
    assert len(got) == 600 * 5


def test_audit_of_nothing_and_without_labels(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None)], DOCS)
    rows = filter_audit.audit(one, labels).collect()
    assert len(rows) == 600 and {r["kept"] for r in rows if r["step"] == 5} == {0} and {r["part"] for r in rows} == {""}
    assert {r["shapley"] for r in rows} == {0, 120}
