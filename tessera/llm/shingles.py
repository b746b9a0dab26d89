"""Near-duplicate classes by exact Jaccard similarity of word shingles, over SimHash candidates.

Candidates come from two sides. Fingerprints over five-word shingles go through the segment-popcount grid of
``simhash``, which links them at up to ``MOST_BITS`` differing bits. At similarity 0.8 fingerprints differ in some ten
bits, in 13 and more now and then, and a grid that finds 13 of 64 bits compares almost everything with everything; so
min-hashes complete the candidates: each of ``BANDS`` keys mixes the minima of ``ROWS`` permutations of a
text's shingles, and texts with an equal key are joined to the least text under it. A pair at similarity s
shares no key with probability ``(1 - s**ROWS)**BANDS``: 6e-5 at 0.8, 3e-7 at 0.85. A component of
candidates goes to one task, which compares all its texts exactly, so that a pair that shares no key but
hangs together by others is found as well. A component over ``TILE`` shingles is dealt to tiles, one for
each pair of its blocks: no pair is lost and no task grows with the group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .simhash import BITS, CHUNK, _rotl, forest, links, xxh64_spans
from .support import place, plain, written

WIDTH = 5
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 32, 6
#: Differing bits of the fingerprints that the grid finds, its most.
MOST_BITS = 5
#: Shingles of a tile's block.
TILE = 2_000_000

_RANDOM = np.random.default_rng(8)
_FLIP = _RANDOM.integers(0, 2**64, BANDS * ROWS, np.uint64)
_TIMES = _RANDOM.integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)


def normalised(text: str | None) -> bytes:
    """The text's words, ASCII letters in lower case, with single spaces; empty for null."""
    return b" ".join((text or "").encode().lower().split())


def hashes(parts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each of some ``normalised`` texts in turn, repeats included, and each one's first place.

    A text under ``width`` words is one shingle, the empty one too.
    """
    data = b"\n".join(parts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = np.flatnonzero(raw[ends] == 10)
    words = np.diff(np.concatenate(([-1], last)))
    n = np.maximum(words - width + 1, 1)
    begin = np.concatenate(([0], np.cumsum(n)[:-1]))
    word = np.arange(n.sum()) + np.repeat(last - words + 1 - begin, n)
    stop = np.minimum(word + width - 1, np.repeat(last, n))
    return xxh64_spans(data, starts[word], ends[stop] - starts[word]), begin


def bands(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys."""
    out = np.empty((len(begin), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(BANDS):
            key = np.full(len(begin), k + 1, np.uint64)
            for r in range(k * ROWS, (k + 1) * ROWS):
                key = _rotl((key ^ np.minimum.reduceat((h ^ _FLIP[r]) * _TIMES[r], begin)) * np.uint64(0x9E3779B185EBCA87), 31)
            out[:, k] = key * np.uint64(0xC2B2AE3D27D4EB4F)
    return out


def prints(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """SimHash fingerprints: a bit is 1 if set in over half of a text's hashes, repeats included."""
    n = np.diff(np.append(begin, len(h)))
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * np.add.reduceat(bits, begin, axis=0, dtype=np.int64) > n[:, None]
    assert most.shape[1] == BITS
    return np.packbits(most, axis=1, bitorder="little").view("<u8").reshape(-1)


def edges(texts: list[str | None], least: float = LEAST_SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges, as places, of the texts whose shingle sets have a Jaccard similarity of ``least`` or more.

    Each text is compared with those of fitting size that no search has reached yet.
    """
    sets = [np.unique(hashes([normalised(t)])[0]) for t in texts]
    size = np.array([len(s) for s in sets], np.int64)
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    mark = np.zeros(len(names), np.int32)
    left = np.arange(len(texts))
    rest = flat  # the shingles of those left, in their order
    out: list[tuple[np.ndarray, np.ndarray]] = []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue = [int(left[0])]
            rest, left = rest[size[left[0]] :], left[1:]
            continue
        x = queue.pop()
        own = flat[begin[x] : begin[x] + size[x]]
        mark[own] = 1
        common = np.add.reduceat(mark[rest], np.concatenate(([0], np.cumsum(size[left])[:-1])))
        mark[own] = 0
        gone = common >= least * (size[x] + size[left] - common)
        if gone.any():
            found = left[gone]
            out.append((np.full(len(found), x), found))
            queue += found.tolist()
            rest, left = rest[np.repeat(~gone, size[left])], left[~gone]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *(e[0] for e in out)]), np.concatenate([none, *(e[1] for e in out)])


def _marked(rows: DataFrame) -> DataFrame:
    """``rows(row, id, text)`` to (id, row, digest, size, fp, bands): digest is one of the normalised text, size its shingles."""
    base = rows.select("id", "row", "text")

    def slices(texts: Iterator[str | None]) -> Iterator[list[bytes]]:
        held: list[bytes] = []
        size = 0
        for t in texts:
            held.append(normalised(t))
            size += len(held[-1])
            if size >= CHUNK:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                node, size, keys, marks = [], [], [], []
                for parts in slices(t.as_py() for t in b.column(2)):
                    h, begin = hashes(parts)
                    keys.append(bands(h, begin))
                    marks.append(prints(h, begin))
                    size.append(np.diff(np.append(begin, len(h))))
                    node += [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
                flat = pa.array(np.concatenate(keys).view(np.int64).reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * BANDS), flat)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.binary()), pa.array(np.concatenate(size)), pa.array(np.concatenate(marks).view(np.int64)), lists], names=["id", "row", "digest", "size", "fp", "bands"])

    return written(base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, row bigint, digest binary, size bigint, fp bigint, bands array<bigint>"), "shingles")


def _compared(group: pa.Table) -> pa.Table:
    node = group.column("node").to_numpy()
    a, b = edges(group.column("text").to_pylist())
    a, b = forest(node[a], node[b]) if len(a) else (node[a], node[b])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each class of texts that similarity links: the least id's, rows with a null id last; of
    rows with the same id the first.

    Texts with the same words in order are one class whatever their white space and ASCII case, null and wordless
    ones too. Long texts count whole. All columns stay as they are, whatever they are called. No rows: no rows.
    """
    kept = written(plain(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    marked = _marked(kept.select("row", F.col(place(docs, id_col)).alias("id"), F.col(place(docs, text_col)).alias("text")))
    nodes = marked.groupBy("digest").agg(F.min(F.struct(F.isnull("id").alias("no"), "id", "row")).alias("low"), F.max("size").alias("size"), F.max("fp").alias("fp"), F.first("bands").alias("bands"))
    nodes = written(nodes.select(F.col("low.row").alias("node"), "low", "size", "fp", "bands"), "nodes")
    cells = nodes.select("node", F.explode("bands").alias("cell"))
    centres = written(cells.groupBy("cell").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a <> top").select("cell", "a"), "cells")
    by_keys = cells.join(centres, "cell").select("a", F.col("node").alias("b"))
    same = written(nodes.groupBy("fp").agg(F.min("node").alias("a")), "prints")
    at_b = same.select(F.col("fp").alias("b"), F.col("a").alias("nb"))
    by_bits = links(same, MOST_BITS).join(same.select(F.col("fp").alias("a"), F.col("a").alias("na")), "a").join(at_b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    by_print = nodes.join(same, "fp").select("a", F.col("node").alias("b"))
    near = components(by_keys.union(by_bits).union(by_print))
    inside = written(near.join(nodes.select("node", "size"), "node"), "candidates")
    parts = inside.groupBy("root").agg(F.ceil(F.sum("size") / tile).cast("int").alias("tiles"))
    dealt = inside.join(parts, "root").select("root", "node", "tiles", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("block"))
    texts = kept.select(F.col("row").alias("node"), F.col(place(docs, text_col)).alias("text"))
    dealt = texts.join(dealt.hint("shuffle_hash"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "text")
    found = components(dealt.groupBy("root", "lo", "hi").applyInArrow(_compared, "a bigint, b bigint"))
    member = written(found.join(nodes.select("node", "low"), "node"), "members")
    least = member.groupBy("root").agg(F.min("low").alias("least"))
    gone = written(member.join(least, "root").where("low.row <> least.row").select("node"), "gone")
    first = nodes.join(gone, "node", "left_anti").select(F.col("node").alias("row"))
    return kept.join(first.hint("shuffle_hash"), "row", "left_semi").drop("row").toDF(*docs.columns)
