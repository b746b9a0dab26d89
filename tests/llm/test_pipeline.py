"""The pipeline's stages, each against brute force on its own input, and the whole run against the chain of stages."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tessera.llm import langid, mixing
from tessera.llm.entries import tokenizer_path

from .test_operators import DOCS, WORDS, brute_targets
from .test_shingles import survivors

KEY = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    parts = {"en": ["the", "ing", "ould", "and", "wh"], "fr": ["eaux", "que", "é", "oi", "lle"]}
    rows = []
    for i in range(160):
        lang = ("en", "fr")[i % 2]
        text = " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(int(rng.integers(20, 200))))
        rows.append((i, text + (f' token = "{KEY}" end' if i % 10 == 0 else ""), lang, f"src{i % 3}", len(text)))
    rows += [(1000 + i, rows[0][1], "en", "src0", 1) for i in range(80)]  # a third are copies
    rows += [(2000, None, "en", "src1", None), (2001, "12345 !!", None, "src1", 8), (2002, "", None, None, 0), (None, rows[4][1] + " more", "en", None, 1)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOCS).withColumn("extra", F.lit(1)).withColumn("row", F.lit("r")).withColumn("parts", F.lit(2)).withColumn("__row", F.lit(3)).withColumn("__lang", F.lit(4)).withColumn("a.b", F.lit(5)).withColumn("c0", F.lit(6)).repartition(4).write.parquet(f"file://{path}/documents.parquet")
    return f"file://{path}"


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.cache()]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], folder).cache())
    return out


def test_names_and_columns(stages):
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
    assert all(s.columns == stages[0].columns for s in stages[1:5])


def test_language_stage(stages):
    before, after = ({str(r["doc_id"]): r for r in s.collect()} for s in stages[:2])
    wordless = {k for k, r in before.items() if not re.search(r"[^\W\d_]", r["text"] or "")}
    assert wordless == {"2000", "2001", "2002"} and set(before) - set(after) == wordless
    assert np.mean([after[k]["lang"] == before[k]["lang"] for k in after if before[k]["lang"]]) > 0.97
    assert all(after[k]["text"] == before[k]["text"] and after[k]["lang"] != langid.UNKNOWN for k in after)


def test_duplicate_stage(stages):
    before, after = (s.collect() for s in stages[1:3])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == survivors([(r["doc_id"], r["text"]) for r in before])


def test_secret_stage(stages):
    before, after = ({str(r["doc_id"]): r["text"] for r in s.collect()} for s in stages[2:4])
    assert set(before) == set(after)
    assert all(after[k] == before[k].replace(KEY, "[SECRET]") for k in before)


def test_mixing_stage(stages):
    before, after = (s.collect() for s in stages[3:5])
    size = Counter()
    for r in before:
        size[r["source"]] += len(re.findall(WORDS, r["text"]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = brute_targets([size[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))])
    got, words = Counter(), {str(r["doc_id"]): re.findall(WORDS, r["text"]) for r in before}
    for r in after:
        own = re.findall(WORDS, r["text"])
        got[r["source"]] += len(own)
        whole = iter(words[str(r["doc_id"])])
        assert all(w in whole for w in own)  # in the document's order
    assert all(abs(got[s] - t) <= 0.02 * t + 60 for s, t in zip(order, want, strict=True))


def test_packing_stage_and_run(spark, stages, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in stages[4].collect():
        ids = np.array(tokenizer.encode(r["text"], add_special_tokens=False).ids + [1], "<u4")
        for s in range(0, len(ids), 2048):
            want[(r["doc_id"], s, zlib.crc32(ids[s : s + 2048].tobytes()))] += 1
    last = stages[5].collect()
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in last) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in last)
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in cp.run(spark, folder).collect()) == want


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() == 0
