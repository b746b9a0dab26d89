"""SimHash fingerprints and near-duplicate classes by a segment-popcount grid join.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit segments. Flipping one bit
moves one count by one, so the Manhattan distance of two embeddings never exceeds their Hamming
distance. The segments are dealt to three groups; of four differing bits or fewer, some group
sees at most one. Within that group the counts are a point of a unit grid, and two fingerprints
meet if their points are equal or unit neighbours. Only points with an even sum are copied to
neighbour cells: neighbours always have sums of different parity. Meeting pairs pass the
Manhattan bound over all 32 segments first, then the exact Hamming test.

Equal texts and equal fingerprints are one node throughout. Within a cell only the edges of a
spanning forest leave the task, so a group of near copies yields as many links as members. A cell
over ``TILE`` rows is dealt to tiles, one for each pair of its blocks: no pair is lost and no task
grows with the group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .support import picked, plain, place, written

BITS = 64
#: Bit ranges of the three pigeonhole groups; their segments are two bits wide, the last of an odd group one.
GROUPS = ((0, 22), (22, 43), (43, 64))
#: Differing bits that still link; the grid serves up to 5 (three groups, one differing bit in one of them).
MAX_BITS = 4
TILE = 65_536
#: Bytes of normalised text hashed at a time.
CHUNK = 1 << 18
#: Cells up to this many rows are compared together, larger ones by a search that removes what it has found.
SMALL_CELL = 128

_SPACE = re.compile(rb"[\x20\x09-\x0D]")

# The constants of the XXH64 algorithm.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_spans(data: bytes, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[start:start+size]`` for every span at once."""
    with np.errstate(over="ignore"):
        raw = np.frombuffer(data + bytes(40), np.uint8)
        lanes = np.ascontiguousarray(np.ndarray((len(raw) - 7,), "<u8", raw.data, strides=(1,)))
        seed = np.uint64(seed)
        at, left = start.astype(np.int64), size.astype(np.int64)
        acc = np.full(len(at), seed + P5, np.uint64)
        long = np.flatnonzero(left >= 32)
        if len(long):
            v = [np.full(len(long), x, np.uint64) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            go = np.arange(len(long))
            while len(go):
                rows = long[go]
                for k in range(4):
                    v[k][go] = _rotl(v[k][go] + lanes[at[rows] + 8 * k] * P2, 31) * P1
                at[rows] += 32
                left[rows] -= 32
                go = go[left[rows] >= 32]
            h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                h = (h ^ (_rotl(x * P2, 31) * P1)) * P1 + P4
            acc[long] = h
        acc += size.astype(np.uint64)
        for _ in range(3):
            go = np.flatnonzero(left >= 8)
            if not len(go):
                break
            acc[go] = _rotl(acc[go] ^ (_rotl(lanes[at[go]] * P2, 31) * P1), 27) * P1 + P4
            at[go] += 8
            left[go] -= 8
        go = np.flatnonzero(left >= 4)
        acc[go] = _rotl(acc[go] ^ ((lanes[at[go]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[go] += 4
        left[go] -= 4
        for _ in range(3):
            go = np.flatnonzero(left >= 1)
            acc[go] = _rotl(acc[go] ^ (raw[at[go]].astype(np.uint64) * P5), 11) * P1
            at[go] += 1
            left[go] -= 1
        acc = (acc ^ (acc >> np.uint64(33))) * P2
        acc = (acc ^ (acc >> np.uint64(29))) * P3
        return acc ^ (acc >> np.uint64(32))


def _bit_counts(parts: list[bytes], width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each part, words joined by single spaces: set bits by position, and the number of shingles."""
    data = b"\n".join(parts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = np.flatnonzero(raw[ends] == 10)  # the last word of each part
    words = np.diff(np.concatenate(([-1], last)))
    n = np.maximum(words - width + 1, 1)
    first = last - words + 1
    begin = np.concatenate(([0], np.cumsum(n)[:-1]))
    word = np.arange(n.sum()) + np.repeat(first - begin, n)
    stop = np.minimum(word + width - 1, np.repeat(last, n))
    h = xxh64_spans(data, starts[word], ends[stop] - starts[word], seed)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, begin, axis=0, dtype=np.int64), n


def fingerprints_of(texts: list[str | None], width: int = 4, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit fingerprints; zero for texts without a word."""
    count, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    parts: list[bytes] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if parts:
            c, n = _bit_counts(parts, width, seed)
            np.add.at(count, owner, c)
            np.add.at(total, owner, n)
        parts.clear()
        owner.clear()
        held = 0

    for i, text in enumerate(texts):
        raw = (text or "").encode().lower()
        at, carried, begun = 0, [], False
        while at < len(raw):  # a slice at a time, cut at white space: a long text's words are never all in a list
            end = min(at + CHUNK, len(raw))
            if end < len(raw):
                gap = _SPACE.search(raw, end)
                end = gap.start() if gap else len(raw)
            new = raw[at:end].split()
            at = end
            words = carried + new
            if not new or (len(words) < width and at < len(raw)):
                carried = words
                if at < len(raw) or begun or not words:
                    continue
            parts.append(b" ".join(words))
            owner.append(i)
            held += len(parts[-1])
            carried = words[-(width - 1) :] if width > 1 else []
            begun = True
            if held >= CHUNK:
                flush()
    flush()
    bit = 2 * count > total[:, None]
    return np.packbits(bit, axis=1, bitorder="little").view("<u8").reshape(-1)


def unary(fp: np.ndarray) -> np.ndarray:
    """Each two-bit segment's count in unary; the popcount of two codes' XOR is the Manhattan distance."""
    even = np.uint64(0x5555555555555555)
    up = fp >> np.uint64(1)
    return ((fp | up) & even) | (((fp & up) & even) << np.uint64(1))


def _digits(fp: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The counts of the segments of bits lo to hi, a row each."""
    bits = ((fp[:, None] >> np.arange(lo, hi, dtype=np.uint64)) & np.uint64(1)).astype(np.int64)
    if (hi - lo) % 2:
        bits = np.concatenate([bits, np.zeros((len(bits), 1), np.int64)], axis=1)
    return bits[:, ::2] + bits[:, 1::2]


def grid_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells that each fingerprint enters: (cell, row of fp, at home)."""
    cells, rows, homes = [], [], []
    base = np.int64(0)
    at = np.arange(len(fp))
    for lo, hi in GROUPS:
        d = _digits(fp, lo, hi)
        place = 3 ** np.arange(d.shape[1], dtype=np.int64)
        most = np.full(d.shape[1], 2)
        if (hi - lo) % 2:
            most[-1] = 1
        code = base + d @ place
        cells.append(code)
        rows.append(at)
        homes.append(np.ones(len(fp), bool))
        even = d.sum(axis=1) % 2 == 0
        for k in range(d.shape[1]):
            for step in (-1, 1):
                ok = np.flatnonzero(even & (d[:, k] + step >= 0) & (d[:, k] + step <= most[k]))
                cells.append(code[ok] + step * place[k])
                rows.append(ok)
                homes.append(np.zeros(len(ok), bool))
        base += np.int64(3 ** d.shape[1])
    return np.concatenate(cells), np.concatenate(rows), np.concatenate(homes)


def _linked(a: np.ndarray, b: np.ndarray, ua: np.ndarray, ub: np.ndarray, most: int) -> np.ndarray:
    """Indexes of linked pairs: first the bound on the embeddings, then the exact distance."""
    near = np.flatnonzero(np.bitwise_count(ua ^ ub) <= most)
    return near[np.bitwise_count(a[near] ^ b[near]) <= most]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the edges: (node, least node), loops left out."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        m = np.minimum(low[x], low[y])
        np.minimum.at(low, low[x], m)
        np.minimum.at(low, low[y], m)
        low = low[low]
        if np.array_equal(low, before):
            break
    other = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[low[other]], nodes[other]


def _search(fp: np.ndarray, un: np.ndarray, home: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges within one large cell; what a search has reached is compared with the rest only."""
    left = np.arange(len(fp))
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    for seed in np.flatnonzero(home):
        queue = [seed]
        here = np.searchsorted(left, seed)
        if here == len(left) or left[here] != seed:
            continue
        left = np.delete(left, here)
        while queue and len(left):
            x = queue.pop()
            hit = _linked(np.broadcast_to(fp[x], len(left)), fp[left], np.broadcast_to(un[x], len(left)), un[left], most)
            if len(hit):
                found = left[hit]
                edges.append((np.full(len(found), x), found))
                left = np.delete(left, hit)
                queue.extend(found.tolist())
    if not edges:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges])


def cell_edges(cell: np.ndarray, fp: np.ndarray, home: np.ndarray, most: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within cells; rows are sorted by cell, those at home first."""
    un = unary(fp)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(cell)) + 1))
    ends = np.append(starts[1:], len(cell))
    out_a, out_b = [], []
    for s, e in zip(starts[ends - starts > SMALL_CELL], ends[ends - starts > SMALL_CELL], strict=True):
        a, b = _search(fp[s:e], un[s:e], home[s:e], most)
        out_a.append(fp[s:e][a])
        out_b.append(fp[s:e][b])
    end = np.repeat(ends, ends - starts)
    small = np.repeat(ends - starts, ends - starts) <= SMALL_CELL
    go = np.flatnonzero(home & small)
    for shift in range(1, SMALL_CELL):
        go = go[go + shift < end[go]]
        if not len(go):
            break
        hit = go[_linked(fp[go], fp[go + shift], un[go], un[go + shift], most)]
        out_a.append(fp[hit])
        out_b.append(fp[hit + shift])
    if not out_a or not sum(map(len, out_a)):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return forest(np.concatenate(out_a), np.concatenate(out_b))


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for k in range(0, whole.num_rows, 4096):
            fp = whole.slice(k, 4096).column(0).to_numpy().view(np.uint64)
            cell, row, home = grid_rows(fp)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(fp[row].view(np.int64)), pa.array(home)], names=["cell", "fp", "home"])


def _meet(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            key = np.concatenate(([0], np.cumsum((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)))) if len(cols[0]) else cols[0]
            a, b = cell_edges(key, cols[3].view(np.uint64), cols[4], most)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            last = tuple(x[-1] for x in cols[:3])
            same = (cols[0] == last[0]) & (cols[1] == last[1]) & (cols[2] == last[2])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut or (held and tuple(x[-1] for x in held[-1][:3]) != last):
                held.append(tuple(x[:cut] for x in cols))
                yield out(tuple(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append(tuple(x[cut:] for x in cols))
        if held:
            yield out(tuple(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def links(fps: DataFrame, most: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Distinct ``fps(fp)`` to links ``(a, b)`` that connect what Hamming distance connects."""
    if most > 5:
        raise ValueError("three groups find fingerprints at up to five differing bits")
    cells = fps.select("fp").mapInArrow(_expand, "cell int, fp bigint, home boolean")
    # Cells have at most 3**11 codes in each group: counting them is bounded by that, whatever the input.
    hot = cells.groupBy("cell").count().where(F.col("count") > tile).select("cell", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    hot = written(hot, "hot-cells")
    if hot.isEmpty():
        dealt = cells.select("cell", F.lit(0).alias("lo"), F.lit(0).alias("hi"), "fp", "home")
    else:
        block = F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1))).cast("int")
        dealt = cells.join(hot, "cell", "left").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)))
        dealt = dealt.select("cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "fp", "home")
    placed = dealt.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", F.desc("home"))
    return placed.mapInArrow(_meet(most), "a bigint, b bigint")


def _marked(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """``rows(row, id, text)`` to (id, row, fp)."""
    base = rows.select("id", "row", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                fp = fingerprints_of(b.column(2).to_pylist(), width, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["id", "row", "fp"])

    return written(base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, row bigint, fp bigint"), "fingerprints")


def _classes(marked: DataFrame, most: int) -> DataFrame:
    """(fp, least) for each distinct fingerprint; least is the first row of its component by id, nulls last."""
    nodes = written(marked.groupBy("fp").agg(F.min(F.struct(F.isnull("id").alias("no"), "id", "row")).alias("low")), "nodes")
    roots = components(links(nodes, most)).withColumnRenamed("node", "fp")
    inside = written(roots.join(nodes, "fp"), "members")
    least = written(inside.groupBy("root").agg(F.min("low").alias("least")), "least")
    joined = inside.join(least, "root").select("fp", "least")
    return written(nodes.join(joined, "fp", "left").select("fp", F.coalesce("least", "low").alias("least")), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, most: int = MAX_BITS, seed: int = 42) -> DataFrame:
    """One row for each row of ``docs``: ``(id_col, fp bigint, component_id)``.

    component_id is the least id reachable over links, the row's own included. Null and wordless
    texts have fingerprint zero and link like any other; equal fingerprints always link. A null id
    stays a row and counts in no minimum; a component of null ids only has component_id null.
    Long texts are read whole, a stretch at a time. Repeated rows stay repeated. Extra columns are ignored, whatever
    they are called. No rows: no rows.
    """
    marked = _marked(picked(docs, id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id()), width, seed)
    found = marked.join(_classes(marked, most), "fp", "left")
    return found.select("id", "fp", F.col("least.id").alias("component_id")).toDF(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, most: int = MAX_BITS, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component: the least id's, rows with a null id last; of rows with the same id the first.

    All columns stay as they are, whatever they are called. Null, empty and long texts: as for ``near_duplicates``.
    """
    kept = written(plain(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    marked = _marked(kept.select("row", F.col(place(docs, id_col)).alias("id"), F.col(place(docs, text_col)).alias("text")), width, seed)
    first = _classes(marked, most).select(F.col("least.row").alias("row")).distinct()
    return kept.join(first.hint("shuffle_hash"), "row", "left_semi").drop("row").toDF(*docs.columns)
