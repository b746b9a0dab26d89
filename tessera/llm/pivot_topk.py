"""Exact top-k by inner product with a pivot-distance index.

Vectors are scaled to integers. One more coordinate, the root of what a vector's squared norm lacks to
the largest, gives all of them the same norm; a query has zero there. Then distance falls as inner
product rises, and the triangle inequality holds for it.

Pivots, more of them for larger tables, are chosen from a bounded sample. Each vector is keyed by its nearest pivot and
its distance from it; the distances of a pivot's vectors are cut into annuli, so that a cell holds about
``CELL`` vectors. A query sorts the annuli by the least distance that the triangle inequality allows. It expands them in
rounds, the nearest first: each round's answers tighten the bound that its k-th score sets, annuli beyond it are never
visited, and the query stops once none is left within it. Within a cell, sorted by distance, it looks at the stretch
that the same bound leaves.

A cell's vectors are loaded once and its queries stream past them, so memory is bounded by ``CELL``; a cell that more
than ``QUERIES`` ask for is dealt to several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .support import hashed_sample, picked, written

SCALE = 256
#: Pivots at least and at most, and vectors for each beside the root of their number.
PIVOTS, MOST_PIVOTS, ROOT = 16, 1024, 8
#: Bound of the sample that pivots are chosen from.
SAMPLE = 2048
#: Annuli that a query has expanded after each round; the last round takes the rest within its bound.
ROUNDS = (1, 4, 1 << 40)
#: Queries of a cell in one task, at most about.
QUERIES = 4096
#: Vectors in a cell, about, and annuli of a pivot at most; larger annuli are dealt to parts.
CELL, ANNULI = 4096, 64
#: Relative slack of the bounds for rounding: more is searched, never less.
SLACK = 1e-9


def scaled(embedding: list[float] | None, scale: int = SCALE) -> np.ndarray | None:
    """floor(scale * x) with x as double; None if the vector or a component is null or not finite."""
    if embedding is None:
        return None
    try:
        x = np.array(embedding, np.float64)
    except TypeError:
        return None
    if x.ndim != 1 or not np.isfinite(x).all():
        return None
    x = np.floor(scale * x)
    if len(x) and np.abs(x).max() >= 2**31:
        raise ValueError("a component doesn't fit 32 bits once scaled")
    return x.astype("<i4")


def _ints(rows: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), "<i4") for v in rows]


def _matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Rows as doubles; shorter ones end in zeros."""
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integral rows, as int64."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= 2**53:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return (a @ b.T).astype(np.int64)


def choose_pivots(rows: np.ndarray, extra: np.ndarray, count: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Farthest-first choice among the sample; (points, their extra coordinates)."""
    x = np.concatenate([rows, extra[:, None]], axis=1)
    chosen = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(x)) and near.max() > 0:
        k = int(near.argmax())
        chosen.append(k)
        near = np.minimum(near, ((x - x[k]) ** 2).sum(axis=1))
    return rows[chosen], extra[chosen]


def _distances(rows: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    sq = (rows**2).sum(axis=1)[:, None] + extra[:, None] ** 2 + (pivots**2).sum(axis=1)[None] + pivot_extra[None] ** 2
    return np.sqrt(np.maximum(sq - 2 * (rows @ pivots.T + extra[:, None] * pivot_extra[None]), 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None, cell: int = CELL) -> DataFrame:
    """(query_id, rank from 1, id_col, score) of each query's ``k`` best rows of ``vectors`` by integer inner product.

    Ties go to the smaller id. A row with the query's own id is no candidate. Null ids, null vectors and
    vectors with a null or non-finite component take no part; shorter vectors count as ending in zeros;
    rows equal in id and vector count once. Fewer candidates than ``k``: all of them. Extra columns are
    ignored, whatever they are called. Empty tables: no rows.
    """
    spark = vectors.sparkSession

    def integral(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scaled(v.as_py()) for v in b.column(1)]
            ok = [i for i, r in enumerate(rows) if r is not None]
            norms = [int((rows[i].astype(np.int64) ** 2).sum()) for i in ok]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ok, pa.int64())), pa.array([rows[i].tobytes() for i in ok], pa.binary()), pa.array(norms, pa.int64()), pa.array([len(rows[i]) for i in ok], pa.int32())], names=["id", "v", "norm", "width"])

    def table(df: DataFrame) -> DataFrame:
        rows = picked(df, id=id_col, x=vector_col).select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x")).where("id is not null")
        return rows.mapInArrow(integral, "id bigint, v binary, norm bigint, width int")

    # Of equal vectors the k + 1 smallest ids can be in an answer; the group limit runs before the shuffle.
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    base = written(table(vectors).distinct().withColumn("n", first).where(F.col("n") <= k + 1).drop("n"), "vectors")
    asked = written(table(queries).distinct(), "queries")
    facts = base.agg(F.max("norm").alias("norm"), F.max("width").alias("width"), F.count("*").alias("n")).first()
    width = max(facts["width"] or 0, (asked.agg(F.max("width").alias("width")).first()["width"] or 0), 1)
    top = facts["norm"] or 0
    sample = hashed_sample(base, SAMPLE, ["v", "id"], facts["n"])
    if sample:
        rows = _matrix([np.frombuffer(r["v"], "<i4") for r in sample], width)
        pivots = pivots or min(MOST_PIVOTS, max(PIVOTS, math.isqrt(facts["n"]) // ROOT))
        points, point_extra = choose_pivots(rows, np.sqrt(np.array([top - r["norm"] for r in sample], float)), pivots)
    else:
        points, point_extra = np.zeros((1, width)), np.zeros(1)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 2048):
                b = whole.slice(s, 2048)
                d = _distances(_matrix(_ints(b.column(1)), width), np.sqrt(top - b.column(2).to_numpy().astype(float)), points, point_extra)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], names=["id", "v", "pivot", "d"])

    keyed = base.select("id", "v", "norm").mapInArrow(key, "id bigint, v binary, pivot int, d double")
    cuts = [i / ANNULI for i in range(1, ANNULI)]
    rings: dict[int, tuple[np.ndarray, int]] = {}
    bounds = np.zeros((0, 4))  # pivot, annulus, least and largest distance
    stats = keyed.groupBy("pivot").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.percentile_approx("d", cuts, 2000).alias("cuts")).orderBy("pivot").collect()  # a row for each pivot
    for r in stats:
        count = int(min(ANNULI, max(1, -(-r["n"] // cell))))
        inner = np.unique([r["cuts"][round(i * ANNULI / count) - 1] for i in range(1, count)])
        rings[r["pivot"]] = (inner, max(1, -(-r["n"] // (cell * count))))
        edges = np.concatenate([[r["lo"]], inner, [r["hi"]]])
        bounds = np.concatenate([bounds, np.array([[r["pivot"], i, edges[i], edges[i + 1]] for i in range(len(inner) + 1)])])

    parts = {p: n for p, (_, n) in rings.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pivot, d, ids = b.column(2).to_numpy(), b.column(3).to_numpy(), b.column(0).to_numpy()
            ring, part = np.zeros(len(d), np.int32), np.zeros(len(d), np.int32)
            for p in np.unique(pivot):
                own = pivot == p
                ring[own] = np.searchsorted(rings[p][0], d[own], side="left")
                part[own] = (ids[own] * 2654435761 % 4294967296) % parts[p]
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(ring), pa.array(part), *b.columns[:2], b.column(3)], names=["pivot", "ring", "part", "id", "v", "d"])

    cells = "pivot int, ring int, part int, "
    placed = written(keyed.mapInArrow(place, cells + "id bigint, v binary, d double"), "cells")

    def route(done: int, most: int):
        """Queries to the cells that this round expands: annuli number ``done`` to ``most`` by their least distance, within reach."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for s in range(0, whole.num_rows if len(bounds) else 0, 512):
                    b = whole.slice(s, 512)
                    x = _matrix(_ints(b.column(1)), width)
                    d = _distances(x, np.zeros(len(x)), points, point_extra)
                    at_pivot = d[:, bounds[:, 0].astype(int)]
                    low = np.maximum(0, np.maximum(bounds[None, :, 2] - at_pivot, at_pivot - bounds[None, :, 3]))
                    rank = np.argsort(np.argsort(low, axis=1, kind="stable"), axis=1)
                    kth = b.column(2).to_numpy(zero_copy_only=False).astype(float)  # NaN: fewer than k so far
                    sq = (x**2).sum(axis=1) + top
                    reach = np.sqrt(np.maximum(sq - 2 * np.where(np.isnan(kth), -np.inf, kth), 0))
                    go = (rank >= done) & (rank < most) & (low <= (reach * (1 + SLACK) + SLACK)[:, None])
                    q, c = np.nonzero(go)
                    n = np.array([parts[int(p)] for p in bounds[c, 0]], np.int64) if len(c) else np.zeros(0, np.int64)
                    q, c, n0 = np.repeat(q, n), np.repeat(c, n), n
                    part = np.arange(len(q)) - np.repeat(np.cumsum(n0) - n0, n0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bounds[c, 0].astype(np.int32)), pa.array(bounds[c, 1].astype(np.int32)), pa.array(part.astype(np.int32)), b.column(0).take(pa.array(q)), b.column(1).take(pa.array(q)), pa.array(d[q, bounds[c, 0].astype(int)]), b.column(2).take(pa.array(q))],
                        names=["pivot", "ring", "part", "id", "v", "d", "kth"],
                    )

        return run

    routed = cells + "id bigint, v binary, d double, kth bigint"

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell, the cell's vectors by distance before its queries."""
        now, held, queries_now = None, [], []
        vec = None

        def answer() -> pa.RecordBatch:
            out = _best(vec, queries_now, width, top, k)
            queries_now.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["query_id", "v", "id", "score"])

        for b in batches:
            cell_id = list(zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 8)), strict=True))
            tag, ids, d, kth = b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(6).to_pylist(), b.column(7).to_pylist()
            for i, v in enumerate(b.column(5)):
                if cell_id[i] != now:
                    if queries_now:
                        yield answer()
                    now, held, vec = cell_id[i], [], None
                if not tag[i]:
                    held.append((ids[i], np.frombuffer(v.as_buffer(), "<i4"), d[i]))
                    continue
                if vec is None:
                    vec = (np.array([h[0] for h in held], np.int64), _matrix([h[1] for h in held], width), np.array([h[2] for h in held]))
                queries_now.append((ids[i], v.as_py(), d[i], kth[i]))
                if len(queries_now) >= 256:
                    yield answer()
        if queries_now:
            yield answer()

    own_cell = ["pivot", "ring", "part"]

    def visited(who: DataFrame) -> DataFrame:
        stored = placed.withColumn("copy", F.lit(0))
        often = who.groupBy(*own_cell).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("copies")).where("copies > 1")
        often = written(often, "often")
        if often.isEmpty():
            who = who.withColumn("copy", F.lit(0))
        else:  # cells with many queries stand once for each share of these
            copies = F.coalesce("copies", F.lit(1))
            who = who.join(often, own_cell, "left").withColumn("copy", F.pmod(F.xxhash64("id", "v"), copies).cast("int"))
            stored = placed.join(often, own_cell, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
        both = stored.select(*own_cell, F.lit(0).alias("tag"), "id", "v", "d", F.lit(None).cast("bigint").alias("kth"), "copy").union(who.select(*own_cell, F.lit(1).alias("tag"), "id", "v", "d", "kth", "copy"))
        both = both.repartition(*own_cell, "copy").sortWithinPartitions(*own_cell, "copy", "tag", "d", "id")
        return both.mapInArrow(visit, "query_id bigint, v binary, id bigint, score bigint")

    by_query = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "id")
    every, done = None, 0
    for most in ROUNDS:
        if every is None:
            open_ = asked.select("id", "v", F.lit(None).cast("bigint").alias("kth"))
        else:
            kth = every.withColumn("n", F.row_number().over(by_query)).where(F.col("n") == k).select(F.col("query_id").alias("id"), "v", F.col("score").alias("kth"))
            open_ = asked.select("id", "v").join(kth, ["id", "v"], "left")
        found = written(visited(written(open_.mapInArrow(route(done, most), routed), "routes")), "found")
        every, done = found if every is None else every.union(found), most
    ranked = every.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score").toDF("query_id", "rank", id_col, "score")


def _best(vec, queries: list[tuple], width: int, top: int, k: int) -> tuple[list, list, list, list]:
    """The k best of a cell's vectors for each query, none below its k-th score so far."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    if vec is None or not len(vec[0]):
        return out
    ids, rows, d = vec
    x = _matrix([np.frombuffer(q[1], "<i4") for q in queries], width)
    sq = (x**2).sum(axis=1) + top
    reach = np.array([np.inf if q[3] is None else np.sqrt(max(s - 2.0 * q[3], 0)) * (1 + SLACK) + SLACK for q, s in zip(queries, sq, strict=True)])
    at = np.array([q[2] for q in queries])
    lo, hi = np.searchsorted(d, at - reach, "left"), np.searchsorted(d, at + reach, "right")  # vectors outside are too far
    if lo.min() >= hi.max():
        return out
    a, z = int(lo.min()), int(hi.max())
    scores = products(x, rows[a:z])
    own_ids = ids[a:z]
    for i, (query_id, v, _, kth) in enumerate(queries):
        s = scores[i, lo[i] - a : max(hi[i], lo[i]) - a]
        own = own_ids[lo[i] - a : max(hi[i], lo[i]) - a]
        ok = own != query_id
        if kth is not None:
            ok &= s >= kth
        s, own = s[ok], own[ok]
        if len(s) > k:
            keep = s >= np.partition(s, len(s) - k)[len(s) - k]
            s, own = s[keep], own[keep]
        pick = np.lexsort((own, -s))[:k]
        out[0].extend([query_id] * len(pick))
        out[1].extend([v] * len(pick))
        out[2].extend(own[pick].tolist())
        out[3].extend(s[pick].tolist())
    return out
