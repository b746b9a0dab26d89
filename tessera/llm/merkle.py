"""Merkle manifest of a table: Pregel-style supersteps over an RDD of tree nodes.

Leaves are numbered by group and id in one range sort. In a superstep upward every node messages its parent, and a
parent that has the messages of its run of three hashes them and is a node of the next superstep; a barrier ends each superstep, so
a parent is complete when its messages are grouped. Groups' roots are the leaves of one more tree of the same kind.
In the reverse supersteps each parent messages its children the digests of their siblings and its own path, down to
the leaves. Messages of up to six levels stay in the partition they are in: nodes are dealt by the subtree they belong to, so
only one superstep in six shuffles, and each has a third of the nodes of the one before.

Digests are 32 bytes in messages, and lower-case hex text where they are hashed and in results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .support import shared_dir, written

#: Children of a node, and levels of the tree between two shuffles.
FAN, LOCAL_LEVELS = 3, 6

PATH = "array<struct<before: string, after: string>>"


def leaf(*values: Column) -> Column:
    """SHA-256 over the values, each as its length in UTF-8 bytes, a colon and itself, or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, own, lambda acc, step: F.sha2(F.concat(step["before"], acc, step["after"]).cast("binary"), 256))


def proof(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "").cast("binary"), 256)


def _digest(run: tuple) -> bytes:
    return hashlib.sha256("".join(d.hex() for _, d, *_ in run).encode()).digest()


def _place(key: tuple[int, int, int]) -> int:
    """A node's partition by the subtree that it belongs to; a node and its parent differ only every LOCAL_LEVELS levels."""
    level, tree, at = key
    return zlib.crc32(b"%d:%d" % (tree, at // FAN ** (LOCAL_LEVELS - 1 - (level - 1) % LOCAL_LEVELS)))


def _stands(key: tuple[int, int, int], run: tuple) -> bool:
    """A tree with one node left: it stands for itself on all further levels."""
    return key[2] == 0 and len(run) == 1


def _up(nodes: RDD, level: int, first: bool, parts: int) -> RDD:
    """One superstep: nodes of ``level`` message their parents, which gather the run, in order."""

    def send(some: Iterable) -> Iterator:
        for (_, tree, at), value in some:
            yield (level + 1, tree, at // FAN), (at % FAN, *value)

    stays = not first and level % LOCAL_LEVELS != 0
    inbox = nodes.mapPartitions(send, preservesPartitioning=stays).groupByKey(parts, _place)
    return inbox.mapPartitions(lambda some: ((key, tuple(sorted(run, key=lambda m: m[0]))) for key, run in some), preservesPartitioning=True)


def _complete(families: RDD) -> RDD:
    """Parents with their runs hash, and are nodes."""
    return families.mapPartitions(lambda some: ((key, (run[0][1] if _stands(key, run) else _digest(run),)) for key, run in some), preservesPartitioning=True)


def _down(families: RDD, paths: RDD, level: int, parts: int) -> RDD:
    """One reverse superstep: parents of ``level``, who know their path and their group's root, message each child its siblings and these."""

    def meet(some: Iterable) -> Iterator:
        for key, both in some:
            run, (subroot, path) = (value for _, value in sorted(both, key=lambda m: m[0]))
            _, tree, at = key
            for place, digest, *load in run:
                before, after = (b"".join(d for p, d, *_ in run if (p < place, p > place)[k]) for k in (0, 1))
                yield (level - 1, tree, FAN * at + place), (digest, load, subroot, path if _stands(key, run) else ((before, after), *path))

    def mark(kind: int):
        return lambda some: ((key, (kind, value)) for key, value in some)

    both = families.mapPartitions(mark(0), preservesPartitioning=True).union(paths.mapPartitions(mark(1), preservesPartitioning=True))
    stays = level > 1 and (level - 1) % LOCAL_LEVELS != 0
    return both.groupByKey(parts, _place).mapPartitions(meet, preservesPartitioning=stays)


def _numbered(rows: RDD) -> tuple[RDD, int, int]:
    """Rows ``(group, *load)`` in order of group to ``((0, group's number, place in it), load)``, the number of groups and the most rows of one.

    A first pass counts: of each partition the driver gets its first and last group and three numbers.
    """

    def count(some: Iterable) -> Iterator:
        first = last = None
        groups = n = most = head = 0
        for row in some:
            if not groups or row[0] != last:
                if groups:
                    most = max(most, n)
                    head = head or n
                else:
                    first = row[0]
                last, n, groups = row[0], 0, groups + 1
            n += 1
        if groups:
            yield first, last, groups, head or n, n, max(most, n)

    seen = rows.mapPartitionsWithIndex(lambda k, some: ((k, *c) for c in count(some))).collect()
    starts: dict[int, tuple[int, int]] = {}
    number, n, most, before = -1, 0, 0, None
    for k, first, last, groups, head, tail, own in sorted(seen, key=lambda s: s[0]):
        if number < 0 or first != before:
            number, n = number + 1, 0
        starts[k] = (number, n)
        most = max(most, own, n + head)
        number += groups - 1
        n = n + tail if groups == 1 else tail
        before = last

    def assign(k: int, some: Iterable) -> Iterator:
        number, n = starts.get(k, (0, 0))
        last = None
        for row in some:
            if last and row[0] != last[0]:
                number, n = number + 1, 0
            last = row
            yield (0, number, n), row[1:]
            n += 1

    return rows.mapPartitionsWithIndex(assign), number + 1, most


def _levels(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def manifest(rows: DataFrame) -> DataFrame:
    """(id, carried, leaf, subroot, root, path) for ``rows(group_by, id, leaf[, carried])``, written to the shared folder.

    Leaves of a group ascend by id, groups by their bytes, the null group first. Null ids come last; rows with the same id
    stand in the order of their digests, and repeated rows, which have the same digest, each have a leaf. ``path`` has for each level the
    digests before and after the node in its run, joined. No rows: none. A group of any size is dealt over all tasks, by
    subtrees; of each partition a few numbers come to the driver, and the root.
    """
    spark = rows.sparkSession
    carries = "carried" in rows.columns
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("carried", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root")), T.StructField("path", T._parse_datatype_string(PATH))])
    carried = F.unhex("carried") if carries else F.lit(None).cast("binary")
    # the name of a group can be long; beyond the sort its digest tells it apart
    flat = rows.select(F.col("group_by").cast("string").alias("g"), "id", F.unhex("leaf").alias("leaf"), carried.alias("carried"), F.monotonically_increasing_id().alias("row"))
    # digests are computed once, and the sort reads them instead of texts
    flat = written(flat, "leaves").orderBy(F.col("g").asc_nulls_first(), F.col("id").asc_nulls_last(), "leaf", "row")
    nodes, trees, most = _numbered(flat.select(F.unhex(F.sha2("g", 256)), "leaf", "id", "carried").rdd.map(lambda r: (r[0] and bytes(r[0]), bytes(r[1]), (r[2], r[3] and bytes(r[3])))))
    if not trees:
        return spark.createDataFrame([], schema)
    parts = nodes.getNumPartitions()
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    inner, outer = max(1, _levels(most)), _levels(trees)
    held: list[RDD] = []
    try:
        for level in range(inner + outer):
            if level == inner:  # the groups' roots are the leaves of the last tree
                nodes = nodes.map(lambda n: ((inner, -1, n[0][1]), n[1]))
            families = _up(nodes, level, level in (0, inner), parts).persist(StorageLevel.MEMORY_AND_DISK)
            if level % LOCAL_LEVELS == 0:
                families.checkpoint()
            held.append(families)
            nodes = _complete(families)
        root = nodes.first()[1][0]
        paths = nodes.mapPartitions(lambda some: ((key, (value[0], ())) for key, value in some), preservesPartitioning=True)
        for level in range(inner + outer, 0, -1):
            paths = _down(held[level - 1], paths, level, parts)
            if level == inner + 1:  # a leaf of the last tree is a group's root
                paths = paths.map(lambda n: ((inner, n[0][2], 0), (n[1][0], n[1][3])))
            elif level > 1:
                paths = paths.mapPartitions(lambda some: ((key, value[2:]) for key, value in some), preservesPartitioning=True)

        def row(node: tuple) -> tuple:
            _, (own, ((key, carried),), subroot, path) = node
            return key, carried and carried.hex(), own.hex(), subroot.hex(), root.hex(), [(a.hex(), b.hex()) for a, b in path]

        return written(spark.createDataFrame(paths.map(row), schema, verifySchema=False), "manifest")
    finally:
        for families in held:
            families.unpersist()


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS s,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents),
crc AS (SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * strlen(CAST(doc_id AS VARCHAR))), lambda b:
          (ascii(substr(CAST(doc_id AS VARCHAR), CAST(b // 8 + 1 AS BIGINT), 1)) >> (b % 8)) & 1)), lambda acc, bit:
          CASE WHEN xor(acc & 1, bit) = 1 THEN xor(acc >> 1, 3988292384::BIGINT) ELSE acc >> 1 END) AS c FROM d),
l AS (SELECT d.*, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN xor(c, 4294967295::BIGINT) % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
             ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS seen
      FROM d JOIN crc USING (doc_id)),
up AS (SELECT 0 AS k, s, i, leaf AS h FROM l
       UNION ALL SELECT k + 1, s, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, max(i) OVER (PARTITION BY s) AS m FROM up) WHERE m > 0 GROUP BY k, s, i // 3),
sub AS (SELECT s, h AS subroot FROM up QUALIFY k = max(k) OVER (PARTITION BY s)),
top AS (SELECT 0 AS k, s AS i, subroot AS h FROM sub
        UNION ALL SELECT k + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, max(i) OVER () AS m FROM top) WHERE m > 0 GROUP BY k, i // 3),
steps AS (SELECT k, s, i, count(*) OVER w AS n, h FROM up WINDOW w AS (PARTITION BY k, s)
          UNION ALL SELECT k + 1000, -1, i, count(*) OVER w AS n, h FROM top WINDOW w AS (PARTITION BY k)),
sides AS (SELECT a.k, a.s, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
          FROM steps a JOIN steps b ON a.k = b.k AND a.s = b.s AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.k, a.s, a.i),
path AS (SELECT l.s AS ls, l.i AS li, g.k, before, after
         FROM l JOIN sides g ON (g.s = l.s AND g.i = l.i // CAST(pow(3, g.k) AS BIGINT)) OR (g.s = -1 AND g.i = l.s // CAST(pow(3, g.k - 1000) AS BIGINT))),
proof AS (SELECT ls, li, list(before ORDER BY k) AS b, list(after ORDER BY k) AS a, string_agg(before || after, '' ORDER BY k) AS p FROM path GROUP BY ls, li),
fold AS (SELECT l.s, l.i, 0 AS k, seen AS h, coalesce(len(b), 0) AS n FROM l LEFT JOIN proof ON ls = l.s AND li = l.i
         UNION ALL SELECT f.s, f.i, f.k + 1, sha256(b[f.k + 1] || h || a[f.k + 1]), n FROM fold f JOIN proof ON ls = f.s AND li = f.i WHERE f.k < n)
SELECT l.doc_id, leaf, subroot, r.h AS root, sha256(coalesce(p, '')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM l JOIN sub USING (s) JOIN fold f ON f.s = l.s AND f.i = l.i AND f.k = f.n LEFT JOIN proof ON ls = l.s AND li = l.i
CROSS JOIN (SELECT h FROM top QUALIFY k = max(k) OVER ()) r
"""
