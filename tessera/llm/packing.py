"""Sequence packing by non-negative least squares over a length histogram.

One pass over the texts yields, for each document, the number of ids and the CRC of every
window-long piece and of the rest; the ids themselves are dropped again. Whole pieces are sequences
of their own. The rests form a histogram of at most ``window - 1`` lengths, which alone goes to the
driver. There all combinations of up to three lengths that fill a window exactly are columns of a
sparse matrix; accelerated projected gradients solve for non-negative repeat counts, which are
rounded and cut back to what the histogram holds. The residual counts are packed greedily: the
longest length left, then the longest that still fits, repeated as often as the counts allow.

A rest's rank within its length is its rank within the task that read it, written beside it, plus
the counts of earlier tasks: no task holds a length's rows, however common the length is.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .support import picked, written

WINDOW = 2048
#: Steps of the projected-gradient solver at most, and the share of the rests that it may leave unfitted.
STEPS, GAP = 300, 0.002


@lru_cache(maxsize=2)
def _fast(path: str):
    """(tiktoken encoder, special strings) of a byte-level BPE file: the same ids for texts without these strings."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [x["content"] for x in spec["added_tokens"]]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_byte = {chr(b): b for b in printable}
    as_byte |= {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in set(printable))}
    ranks = {bytes(as_byte[c] for c in token): n for token, n in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), special


@lru_cache(maxsize=2)
def _full(path: str):
    """The encoder of ``tokenizers``, loaded for the first text that needs it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(text: str | None, path: str, end_id: int = 1) -> np.ndarray:
    """A document's ids, little-endian unsigned 32-bit, with ``end_id`` after the text's own."""
    fast, special = _fast(path)
    text = text or ""
    own = _full(path).encode(text, add_special_tokens=False).ids if any(x in text for x in special) else fast.encode_ordinary(text)
    own.append(end_id)
    return np.array(own, "<u4")


def _short(ids: np.ndarray) -> bytes:
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else ids.tobytes()


def combinations(window: int, depth: int = 3) -> np.ndarray:
    """All sorted combinations of up to ``depth`` (2 or 3) positive lengths that sum to the window; zero fills a place."""
    a = np.arange(1, window // 2 + 1)
    out = [np.stack([np.zeros_like(a), a, window - a])]
    if depth > 2:
        for x in range(1, window // 3 + 1):
            b = np.arange(x, (window - x) // 2 + 1)
            out.append(np.stack([np.full_like(b, x), b, window - x - b]))
    return np.concatenate(out, axis=1)


def repeat_counts(histogram: np.ndarray, combos: np.ndarray, steps: int = STEPS, gap_share: float = GAP) -> np.ndarray:
    """min |A x - h| over x >= 0, with A's column k counting the lengths of combination k.

    Columns that use a length which doesn't occur can only add error; they are left out. The steps end early once what
    is unfitted adds up to ``gap_share`` of the histogram.
    """
    window = len(histogram)
    usable = ((combos == 0) | (histogram[combos] > 0)).all(axis=0)
    c = combos[:, usable]
    x = np.zeros(combos.shape[1])
    if not c.shape[1]:
        return x
    h = histogram.astype(float)
    h[0] = 0
    each = np.bincount(c.ravel(), minlength=window).astype(float)
    each[0] = 0
    # Jacobi scaling: A D A' has eigenvalues of at most the depth squared with D = 1 / (largest use of a column's lengths).
    scale = 1 / np.maximum(each[c].max(axis=0), 1)
    y = z = np.zeros(c.shape[1])
    t = 1.0
    for _ in range(steps):
        fit = np.bincount(c.ravel(), weights=np.broadcast_to(z, c.shape).ravel(), minlength=window)
        gap = fit - h
        gap[0] = 0
        if np.abs(gap).sum() <= gap_share * h.sum():
            y = z
            break
        new = np.maximum(z - scale * gap[c].sum(axis=0) / 3, 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = np.maximum(new + (t - 1) / t_new * (new - y), 0)
        y, t = new, t_new
    x[usable] = y
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Combinations and how often each is used; together they never exceed the histogram."""
    combos = combinations(window)
    x = repeat_counts(histogram, combos)
    left = histogram.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []
    order = np.argsort(-x, kind="stable")
    for k in order[x[order] > 1e-3]:
        parts = [int(v) for v in combos[:, k] if v]
        need = {v: parts.count(v) for v in parts}
        most = min(left[v] // n for v, n in need.items())
        times = int(min(most, max(1, round(float(x[k])))))
        if times:
            for v, n in need.items():
                left[v] -= times * n
            chosen.append((tuple(parts), times))
    return chosen


def residual(left: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Greedy patterns for the counts that the plan leaves; uses every count up."""
    left = left.copy()
    chosen: list[tuple[tuple[int, ...], int]] = []
    present = np.flatnonzero(left)
    while len(present):
        parts: list[int] = []
        room = window
        taken: dict[int, int] = {}
        while True:
            at = int(np.searchsorted(present, room, side="right")) - 1
            while at >= 0 and left[present[at]] <= taken.get(int(present[at]), 0):
                at -= 1
            if at < 0:
                break
            v = int(present[at])
            n = min(room // v, int(left[v]) - taken.get(v, 0))
            parts += [v] * n
            taken[v] = taken.get(v, 0) + n
            room -= n * v
        times = min(int(left[v]) // n for v, n in taken.items())
        for v, n in taken.items():
            left[v] -= times * n
        chosen.append((tuple(parts), times))
        present = present[left[present] > 0]
    return chosen


def layout(histogram: np.ndarray, window: int = WINDOW) -> tuple[dict[int, np.ndarray], int]:
    """For each length, runs of ranks as rows (first rank, first sequence, offset); and the number of sequences."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(window, np.int64)
    sequence = 0

    def place(chosen: list[tuple[tuple[int, ...], int]]) -> None:
        nonlocal sequence
        for parts, times in chosen:
            offset = 0
            for v in parts:
                runs.setdefault(v, []).append((int(used[v]), sequence, offset))
                used[v] += times
                offset += v
            sequence += times

    place(plan(histogram, window))
    place(residual(histogram - used, window))
    return {v: np.array(r, np.int64) for v, r in runs.items()}, sequence


def measured(docs: DataFrame, path: str, id_col: str, text_col: str, window: int, end_id: int, keep: bool = False) -> DataFrame:
    """Lengths and CRCs of each document, with its ranks within the task that read it.

    part: the task's number; rank: earlier rests of this length in it; before: earlier whole pieces in it; ids, with
    ``keep`` only: the ids, two bytes each if that is enough for all of a document's, else four.
    """
    base = picked(docs, id=id_col, text=text_col)
    names = ["id", "part", "rank", "before", "tokens", "full", "rest", "rest_crc", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, before = [0] * window, 0
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                rows = []
                for text in b.column(1):
                    ids = encode(text.as_py(), path, end_id)
                    rest = len(ids) % window
                    cut = len(ids) - rest
                    full = [zlib.crc32(ids[i : i + window]) for i in range(0, cut, window)]
                    rows.append((seen[rest], before, len(ids), full, rest, zlib.crc32(ids[cut:]) if rest else None, _short(ids) if keep else None))
                    seen[rest] += 1
                    before += len(full)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary())
                cols = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([part] * len(rows), pa.int32()), *cols], names=names)

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, part int, rank bigint, before bigint, tokens bigint, full array<bigint>, rest int, rest_crc bigint, ids binary")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``window`` ids.

    Returns (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset), and with ``keep_ids`` the ids of each
    piece as an array. Null texts count as empty and still hold ``end_id``. Null ids stay rows. Repeated rows are packed
    once each, at places of their own; of rests with one length those read first get the first places. Long texts are cut
    every ``window`` ids. Extra columns are ignored. No rows: no pieces.
    """
    found = written(measured(docs, path, id_col, text_col, window, end_id, keep_ids), "lengths")
    sizes = written(found.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.size("full")).alias("whole")), "sizes")
    counts = sizes.groupBy("rest").agg(F.sum("n").alias("n")).collect()  # at most `window` rows
    histogram = np.zeros(window, np.int64)
    for r in counts:
        histogram[r["rest"]] = r["n"]
    histogram[0] = 0
    runs, planned = layout(histogram, window)

    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.select("part", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank0"))
    parts = sizes.groupBy("part").agg(F.sum("whole").alias("whole"))  # one row for each task of the first pass
    parts = parts.select("part", F.coalesce(F.sum("whole").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before0"))
    shifts = written(ranked.join(parts, "part"), "shifts")
    # as many rows as tasks times lengths: too many to broadcast on a large input; ids stream past them unsorted
    placed = found.join(shifts.hint("shuffle_hash"), ["part", "rest"]).select(
        "id", "tokens", "full", "rest", "rest_crc", (F.col("rank") + F.col("rank0")).alias("rank"), (F.col("before") + F.col("before0")).alias("before"), "ids"
    )
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            at, rows = [], []
            for i, (tokens, full, rest, crc, rank, before) in enumerate(zip(*(b.column(c).to_pylist() for c in range(1, 7)), strict=True)):
                for k, own in enumerate(full):
                    at.append(i)
                    rows.append((k * window, window, own, tokens, planned + before + k, 0))
                if rest:
                    own = runs[rest]
                    first, sequence, offset = own[np.searchsorted(own[:, 0], rank, side="right") - 1].tolist()
                    at.append(i)
                    rows.append((tokens - rest, rest, crc, tokens, sequence + rank - first, offset))
            cols = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
            if keep_ids:  # a document's pieces follow each other, so its ids are theirs one after the other
                ends = np.cumsum([0, *(r[1] for r in rows)]).astype(np.int32)
                flat = [np.frombuffer(x.as_py(), "<u2" if len(x.as_py()) == 2 * n.as_py() else "<u4") for x, n in zip(b.column(7), b.column(1), strict=True)]
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype("<i4") if flat else np.empty(0, "<i4"))))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *cols], names=names)

    kind = placed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{x} bigint" for x in names[1:7]) + ", ids array<int>" * keep_ids
    return placed.mapInArrow(run, schema).toDF(id_col, *names[1:])
