"""The near-duplicate stage against brute force over five-word sets."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tessera.llm import shingles

from .test_operators import DOCS, words


def grams(text):
    w = shingles.normalised(text).split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}


def survivors(rows):
    sets = [grams(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    keys = [(r[0] is None, r[0] or 0) for r in rows]
    return sorted(min(k for k, g in zip(keys, group, strict=True) if g == h) for h in set(group))


def near_rows():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(25):
        base = words(rng, int(rng.integers(20, 300)), 5000).split()
        rows.append((10 * i, " ".join(base)))
        for k in range(1, 5):  # one to four changed words
            copy = list(base)
            for at in rng.integers(0, len(base), k):
                copy[at] = f"new{rng.integers(10**6)}"
            rows.append((10 * i + k, " ".join(copy)))
    rows += [(900, None), (901, " "), (902, "Two  words"), (903, "two words"), (904, "two other"), (None, rows[0][1] + " more"), (None, "nobody's own text")]
    return [(i, t, "en", "a", 0) for i, t in rows] + [(902, "Two  words", "en", "a", 0)]


def test_stage_links_at_similarity(spark, tmp_path):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("extra", F.lit(1)).repartition(3)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in cp.near_duplicates(spark, docs, "").collect())
    assert got == survivors(rows) and 30 < len(got) < 80


def test_tiles_lose_no_pair(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS)
    got = shingles.keep_one(docs, tile=100).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == survivors(rows)
