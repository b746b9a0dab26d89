"""The Merkle manifest against a plain tree over lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import entries, merkle

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """(root, [path of each leaf]); a path is [(before, after)]."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i - i % 3 : i - i % 3 + 3]
            paths[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], paths


def plain(rows):
    """A list of result rows, from (doc_id, text, lang, source, n_chars)."""
    groups = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    found = []
    for g in groups:
        own = sorted((r[0] is None, r[0] or 0, leaf((r[0], r[3], r[2], r[4], r[1])), r) for r in rows if r[3] == g)
        found.append((own, *tree([o[2] for o in own])))
    root, tops = tree([f[1] for f in found])
    out = []
    for (own, subroot, paths), top in zip(found, tops, strict=True):
        for (_, _, h, r), path in zip(own, paths, strict=True):
            path = path + top
            seen = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and seen is not None:
                seen = seen.replace("\n", "")
            f = leaf((r[0], r[3], r[2], r[4], seen))
            for before, after in path:
                f = sha(before, f, after)
            out.append((r[0], h, subroot, root, sha(*(a + b for a, b in path)), f, f == root))
    return sorted(out, key=str)


ROWS = [(i * 7 % 2500, f"line {i}\nnext {i % 40}" if i % 3 else f"one line {i}", ("en", None)[i % 2], "hot", i) for i in range(2000)]
ROWS += [(3000 + i, f"a\n{i}", "fr", ("b", "é", None, "")[i % 4], None) for i in range(41)]
ROWS += [(None, "no id\n", None, "b", 1), (None, None, None, None, None), (5000, "", "en", "alone", 0), (5001, "x\n" * 60_000, "en", "b", 120_000)]
ROWS += [(42, "again", "en", "hot", 5)] * 3 + [(43, "same id", "en", "hot", 1), (43, "other text", "en", "hot", 1)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:2], ROWS[:1], ROWS[2000:2004], ROWS[:730]])
def test_manifest_against_a_plain_tree(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as id", "2 as leaf", "'x' as `group_by`", "3 as `a.b`")
    docs.repartition(5).write.parquet(path)
    got = [tuple(r) for r in entries.op12_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == plain(rows)


def test_manifest_of_nothing(spark):
    none = spark.createDataFrame([], "group_by string, id bigint, leaf string")
    assert merkle.manifest(none).collect() == []


def test_a_changed_order_or_number_of_rows_changes_the_root(spark):
    rows = spark.range(50).select(F.lit("g").alias("group_by"), "id", merkle.leaf(F.col("id")).alias("leaf"))
    root = merkle.manifest(rows).first()["root"]
    assert merkle.manifest(rows.where("id < 49")).first()["root"] != root
    assert merkle.manifest(rows.withColumn("id", -F.col("id"))).first()["root"] != root
    assert merkle.manifest(rows.repartition(7)).first()["root"] == root
