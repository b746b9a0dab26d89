"""Sketches, the next document and edited versions against sets and lists."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import text_sketch
from tessera.llm.entries import op11_text_sketch

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def pieces(text):
    return Counter(re.findall(text_sketch.PARAGRAPH, text or ""))


def jaccard(a, b):
    a, b = pieces(a), pieces(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def texts(lists):
    return text_sketch.Texts(pa.array(lists, pa.list_(pa.int64())))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(-4, 60), max_size=80), st.lists(st.integers(-4, 60), max_size=80)), min_size=1, max_size=6))
def test_differences_are_those_of_the_multisets(pairs):
    one, other = texts([p[0] for p in pairs]), texts([p[1] for p in pairs])
    pair, key, sign = text_sketch.differing(one, other, cells=12)
    for k, (a, b) in enumerate(pairs):
        a, b = Counter(a), Counter(b)
        assert sum((pair == k) & (sign == 1)) == sum((a - b).values())
        assert sum((pair == k) & (sign == -1)) == sum((b - a).values())
        plain = {x for x in a if a[x] == 1 and b[x] == 0}  # found by name, as they don't repeat
        assert plain <= set(key[(pair == k) & (sign == 1)].view(np.int64).tolist())


def test_a_sketch_that_is_too_small_fails_and_a_larger_one_does_not():
    one, other = texts([list(range(5000))]), texts([[]])
    assert not text_sketch.Sketches.minus(one.sketched(np.arange(1), 48), other.sketched(np.arange(1), 48)).peel()[3][0]
    pair, key, sign = text_sketch.differing(one, other)
    assert sorted(key.view(np.int64).tolist()) == list(range(5000)) and (sign == 1).all() and (pair == 0).all()


def test_a_fingerprint_reads_back():
    some = texts([[1, 2, 2, -9], [], list(range(100))]).sketched(np.arange(3), 48)
    back = text_sketch.parsed(some.texts())
    assert all((getattr(some, n) == getattr(back, n)).all() for n in ("count", "total", "check"))
    with pytest.raises(ValueError):
        text_sketch.parsed([*some.texts(), *texts([[1]]).sketched(np.arange(1), 24).texts()])


def line(k):
    return f"Line {k} says {k * k}. And more {k}!\n"


def rows():
    rng = np.random.default_rng(3)
    out = [(int(i) * 3, "".join(line(k) for k in rng.integers(0, 500, int(rng.integers(0, 60)))), "en", "s", 0) for i in rng.permutation(300)]
    out += [(9, "same text. " * 5, "en", "s", 0)] * 120 + [(9, f"tie {k}.", "en", "s", 0) for k in range(30)]  # one id, a third of all
    out += [(-5, "först \U0001f600 text ohne Ende", None, None, None), (None, None, None, None, None), (None, "", None, None, None), (10_000, "".join(map(line, range(4000))), "en", "s", 0), (10_001, "x" * 30_001, "en", "s", 0)]
    return out


def expected(rows):
    order = sorted(((i is None, i or 0, xxhash.xxh64((t or "").encode(), seed=42).intdigest(), t or "") for i, t, *_ in rows), key=lambda r: (r[0], r[1], r[2] - (r[2] >> 63 << 64)))
    out = []
    for k, (none, i, _, text) in enumerate(order):
        after = order[(k + 1) % len(order)][3]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((None if none else i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(text, edited), 9), round(jaccard(text, after), 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("some", [slice(None), slice(0, 1), slice(0, 2), slice(0, 0)])
def test_edited_versions_against_lists(spark, tmp_path, some):
    own = rows()[some]
    spark.createDataFrame(own, DOCS).selectExpr("*", "1 as id", "2 as key", "3 as block", "'x' as `a.b`").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_text_sketch(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=str) == expected(own)
    same = {}
    for r in got:
        same.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    if len(own) > 2:
        assert len(same[9, 55]) == 1  # equal texts
        assert len({r["fingerprint"] for r in got if not r["n_chars"]}) == 1


def test_changes_between_versions(spark):
    old = [(1, "".join(map(line, range(30)))), (2, "".join(map(line, range(400)))), (3, "gone. text."), (4, None), (5, "twice."), (5, "twice."), (None, "a. b."), (7, "")]
    new = [(1, "".join(map(line, [*range(29), 77]))), (2, "".join(map(line, range(200, 900)))), (4, ""), (5, "twice."), (6, "new."), (None, "a. c."), (7, "now. full.")]
    tables = [spark.createDataFrame(t, "doc_id bigint, text string").selectExpr("*", "1 as n", "2 as mark") for t in (old, new)]
    got = {r["doc_id"]: r for r in text_sketch.changes(*tables).collect()}
    a, b = dict(old), dict(new)
    assert set(got) == {*a, *b} and len(got) == 8
    for i, r in got.items():
        gone, come = pieces(a.get(i)) - pieces(b.get(i)), pieces(b.get(i)) - pieces(a.get(i))
        named = {xxhash.xxh64(p.encode(), seed=42).intdigest() for p in gone if pieces(a.get(i))[p] == 1}
        assert named == {x % (1 << 64) for x in r["removed"]} if gone.total() == len(named) else named <= {x % (1 << 64) for x in r["removed"]}
        assert (len(r["removed"]), len(r["added"])) == (gone.total(), come.total())
        assert r["likeness"] == pytest.approx(jaccard(a.get(i), b.get(i)))
    assert got[1]["cells"] == text_sketch.CELLS < got[2]["cells"]
    empty = tables[0].where("false")
    assert text_sketch.changes(empty, empty).count() == 0
