"""Chroma audio fingerprints and the alignment of recordings.

Audio is cut into overlapping frames; the power at each pitch class makes a frame of twelve numbers.
Over these frames an integral image gives the sum of any rectangle of time and pitch in four look-ups.
Sixteen filters compare neighbouring rectangles; each answer is quantised to two bits in Gray code, and
the 32 bits are one packed integer for each step of time.

Recordings with equal fingerprints are one class. A query and a class are aligned if, at one offset, at least
``LEAST_VOTES`` places have a landmark, half of the bits of two packed integers, in common, and the share of differing
bits over the overlap, their bit error, is small enough; the offset is that with most votes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import picked, written

RATE = 4000
FRAME, HOP = 1024, 128
#: Frames that one packed integer looks at.
SPAN = 32
LOW_HZ, HIGH_HZ = 80.0, 1900.0
#: Filters as (kind, first pitch class, pitch classes, frames); the rules in ``pack`` name the kinds.
FILTERS = (
    (0, 0, 4, 32),
    (1, 2, 4, 24),
    (2, 4, 4, 16),
    (3, 6, 4, 12),
    (0, 1, 6, 24),
    (1, 3, 6, 32),
    (2, 5, 6, 12),
    (3, 7, 4, 16),
    (0, 0, 8, 16),
    (1, 3, 8, 8),
    (2, 6, 6, 24),
    (3, 0, 12, 32),
    (0, 2, 8, 32),
    (1, 4, 8, 8),
    (2, 0, 12, 24),
    (3, 0, 12, 16),
)
#: Thresholds that cut a filter's answer, a log ratio, into four ranges.
LEVELS = (-0.3, 0.0, 0.3)
#: Steps between the two packed integers that vote together.
GAP = 4
#: Votes, at least, of two recordings that agree over ``GAP + WINNOW`` steps.
WINNOW = 4
LEAST_VOTES = 2
MAX_BIT_ERROR = 0.25
#: Steps that two recordings share, at least, or all of the shorter one; what fewer steps say is chance.
LEAST_OVERLAP = 20
SALTS = 16
#: Deviation of an excerpt's noise, full scale being 1.
NOISE = 0.02
#: Queries, and classes, that meet in a task.
BLOCK = 8192


def decode_wav(data: bytes | None) -> tuple[np.ndarray, int]:
    """Mono samples of 16-bit PCM WAV bytes in -1 to 1, and their rate; none for null or other data."""
    if not data or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return np.zeros(0), RATE
    at, channels, rate, bits = 12, 1, RATE, 16
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data" and bits == 16 and channels:
            body = data[at + 8 : at + 8 + size]
            x = np.frombuffer(body[: len(body) - len(body) % (2 * channels)], "<i2").reshape(-1, channels)
            return x.mean(axis=1) / 32768, rate
        at += 8 + size + size % 2
    return np.zeros(0), RATE


def encode_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    body = np.clip(np.round(samples * 32767), -32768, 32767).astype("<i2").tobytes()
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(body), b"WAVE", b"fmt ", 16, 1, 1, rate, 2 * rate, 2, 16, b"data", len(body)) + body


def melody(values: list[float] | None, note: float = 0.0625, rate: int = RATE) -> bytes | None:
    """A recording made from numbers: each is a note, its pitch one of 24 halftones by its value from -0.6 to 0.6."""
    if values is None:
        return None
    v = np.array([np.nan if x is None else x for x in values], float)
    v = np.where(np.isfinite(v), np.clip(v, -0.6, 0.6), 0.0)
    key = np.clip(np.floor((v + 0.6) / 1.2 * 24), 0, 23)
    n = int(note * rate)
    phase = 2 * np.pi * np.outer(220.0 * 2 ** (key / 12), np.arange(n) / rate)
    tone = 0.6 * np.sin(phase) + 0.2 * np.sin(2 * phase)
    return encode_wav((tone * np.minimum(1, np.minimum(np.arange(n), np.arange(n)[::-1]) / 16)).reshape(-1), rate)


def _classes(rate: int) -> np.ndarray:
    """Which pitch class a spectrum's line belongs to: (lines, 12)."""
    hz = np.fft.rfftfreq(FRAME, 1 / rate)
    out = np.zeros((len(hz), 12))
    use = (hz >= LOW_HZ) & (hz <= min(HIGH_HZ, rate / 2))
    out[np.flatnonzero(use), np.round(12 * np.log2(hz[use] / 440)).astype(int) % 12] = 1
    return out


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """Normalised pitch-class frames, (time, 12)."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    power = np.abs(np.fft.rfft(frames * np.hanning(FRAME), axis=1)) ** 2
    c = power @ _classes(rate)
    norm = np.sqrt((c**2).sum(axis=1, keepdims=True))
    return np.where(norm > 1e-6, c / np.maximum(norm, 1e-6), 0.0)


def pack(frames: np.ndarray) -> np.ndarray:
    """Packed integers, one for each stretch of ``SPAN`` frames; silent ones are zero."""
    steps = len(frames) - SPAN + 1
    if steps < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(steps)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return image[t + t1, p1] - image[t + t0, p1] - image[t + t1, p0] + image[t + t0, p0]

    out = np.zeros(steps, np.uint32)
    for kind, p, h, w in FILTERS:
        p1, mid_p, mid_t = min(12, p + h), p + h // 2, w // 2
        if kind == 0:  # earlier against later
            a, b = area(0, mid_t, p, p1), area(mid_t, w, p, p1)
        elif kind == 1:  # lower against upper
            a, b = area(0, w, p, mid_p), area(0, w, mid_p, p1)
        elif kind == 2:  # the diagonals of a quartering
            a = area(0, mid_t, p, mid_p) + area(mid_t, w, mid_p, p1)
            b = area(0, mid_t, mid_p, p1) + area(mid_t, w, p, mid_p)
        else:  # the middle third of time against the rest
            a = area(w // 3, w - w // 3, p, p1)
            b = area(0, w // 3, p, p1) + area(w - w // 3, w, p, p1)
        level = np.searchsorted(LEVELS, np.log((1 + np.maximum(a, 0)) / (1 + np.maximum(b, 0))))
        out = (out << np.uint32(2)) | (level ^ (level >> 1)).astype(np.uint32)
    silent = area(0, SPAN, 0, 12) < 1e-6
    return np.where(silent, np.uint32(0), out)


def fingerprints(media: DataFrame, id_col: str = "id", audio_col: str = "audio") -> DataFrame:
    """(id_col, prints array<bigint>) for each row; empty for null, undecodable and too short audio.

    Long recordings count whole, null ids and repeated rows stay, extra columns are ignored. No rows: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                rows = [pack(chroma(*decode_wav(a.as_py()))).astype(np.int64) for a in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int64()))], names=["id", "prints"])

    base = picked(media, id=id_col, audio=audio_col).withColumn("audio", F.col("audio").cast("binary"))
    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, prints array<bigint>").toDF(id_col, "prints")


def landmarks(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) that vote: six for each two packed integers ``GAP`` steps apart, every two of their four halves.
    Two places that differ in up to two of the 64 bits share one, equal integers do whatever their partners. Silence has none."""
    if len(prints) <= GAP:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = prints[:-GAP].astype(np.int64), prints[GAP:].astype(np.int64)
    at = np.flatnonzero((a > 0) & (b > 0))
    halves = [a[at] >> 16, a[at] & 0xFFFF, b[at] >> 16, b[at] & 0xFFFF]
    values = [k << 32 | halves[i] << 16 | halves[j] for k, (i, j) in enumerate(((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)))]
    return np.tile(at, 6), np.concatenate(values)


def matched(asked: list[np.ndarray], others: list[np.ndarray], least_votes: int, most_error: float) -> Iterator[tuple[int, int, int, int, float]]:
    """(query, other, offset, votes, bit error) of the alignments; each place of a query has one vote for an offset."""
    found = [landmarks(q) for q in asked]
    who = np.repeat(np.arange(len(asked)), [len(f[0]) for f in found])
    at, value = (np.concatenate([np.empty(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
    order = np.argsort(value, kind="stable")
    who, at, value = who[order], at[order], value[order]
    span = max(map(len, asked), default=0)
    for m, prints in enumerate(others):
        m_at, m_value = landmarks(prints)
        lo, hi = np.searchsorted(value, m_value), np.searchsorted(value, m_value, "right")
        n = hi - lo
        if not n.any():
            continue
        hit = np.arange(n.sum()) + np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        width = span + len(prints)
        vote = np.unique(((who[hit] * width) + at[hit] - np.repeat(m_at, n) + len(prints)) * span + at[hit])
        cell, votes = np.unique(vote // span, return_counts=True)
        cell, votes = cell[votes >= least_votes], votes[votes >= least_votes]
        q, offset = cell // width, cell % width - len(prints)
        long = np.array([len(asked[k]) for k in q.tolist()], np.int64)
        shared = np.minimum(long, len(prints) + offset) - np.maximum(offset, 0)
        enough = shared >= np.minimum(LEAST_OVERLAP, np.minimum(long, len(prints)))
        q, offset, votes = q[enough], offset[enough], votes[enough]
        best = np.lexsort((offset, -np.abs(offset), votes, q))
        for i in best[np.append(np.diff(q[best]) != 0, True)] if len(best) else ():
            d, bits = bit_error(asked[q[i]], prints, int(offset[i]))
            if bits and d / bits <= most_error:
                yield int(q[i]), m, int(offset[i]), int(votes[i]), d / bits


def bit_error(a: list[int], b: list[int], offset: int) -> tuple[int, int]:
    """(differing bits, compared bits) with step i of ``a`` on step i - offset of ``b``."""
    lo, hi = max(0, offset), min(len(a), len(b) + offset)
    if hi <= lo:
        return 0, 0
    x = np.array(a[lo:hi], np.uint64) ^ np.array(b[lo - offset : hi - offset], np.uint64)
    return int(np.bitwise_count(x).sum()), 32 * (hi - lo)


def classes(prints: DataFrame, id_col: str = "id") -> DataFrame:
    """(id_col, class_id) for each row of ``prints(id_col, prints)``: the least id with the same fingerprint.

    Empty fingerprints are one class. Null ids stay and count in no minimum, so a class of null ids only has class_id
    null. Repeated rows stay, extra columns are ignored. No rows: no rows.
    """
    named = picked(prints, id=id_col, prints="prints").withColumn("key", F.xxhash64("prints"))
    reps = named.groupBy("key", "prints").agg(F.min("id").alias("class_id")).withColumnRenamed("prints", "same")
    found = named.join(reps, "key").where(F.col("prints") == F.col("same"))
    return found.select("id", "class_id").toDF(id_col, "class_id")


def align(prints: DataFrame, queries: DataFrame, id_col: str = "id", least_votes: int = LEAST_VOTES, most_error: float = MAX_BIT_ERROR) -> DataFrame:
    """(query_class, match_class, offset, votes, bit_error): the alignments of all queries with all other classes.

    ``prints`` and ``queries``: (id_col, prints). Both go by their classes as ``classes`` gives them, a query's among
    the queries; a class with the query's very fingerprint is no match. Step i of the query stands on step i - offset
    of the match. Offsets at which fewer than ``LEAST_OVERLAP`` steps, or all of the shorter
    recording, stand on each other don't count; of those with as many votes the one nearest to zero does. Empty fingerprints align with nothing;
    zeros, that is silence, don't vote. Classes of null ids only are left out. Repeated rows are one class, extra
    columns are ignored. Long recordings count whole. No rows: no rows.
    """

    def distinct(table: DataFrame, name: str) -> DataFrame:
        own = picked(table, id=id_col, prints="prints").where("id is not null and size(prints) > 0")
        return written(own.withColumn("key", F.xxhash64("prints")).groupBy("key", "prints").agg(F.min("id").alias("class_id")), name)

    reps, own = distinct(prints, "classes"), distinct(queries, "queries")
    kind = reps.schema["class_id"].dataType.simpleString()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        q, m = ([np.array(p, np.uint64) for p in t.column("prints").to_pylist()] for t in (left, right))
        found = [f for f in matched(q, m, least_votes, most_error) if not np.array_equal(q[f[0]], m[f[1]])]
        at = lambda k: pa.array([f[k] for f in found], pa.int64())
        cols = [left.column("class_id").take(at(0)), right.column("class_id").take(at(1)), at(2).cast(pa.int32()), at(3), pa.array([f[4] for f in found], pa.float64())]
        return pa.table(dict(zip(("query_class", "match_class", "offset", "votes", "bit_error"), cols, strict=True)))

    # Votes are counted where they arise and never leave a task: blocks of queries meet parts of the classes.
    blocks, parts = own.count() // BLOCK + 1, SALTS * (reps.count() // (SALTS * BLOCK) + 1)
    left = own.select("class_id", "prints", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = reps.select("class_id", "prints", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("key", F.lit(2)), F.lit(parts)).alias("part"))
    names = ["class_id", "prints", "block", "part"]
    left, right = (x.select(*(F.col(c).alias(f"{side}_{c}") for c in names)).toDF(*names) for x, side in ((left, "q"), (right, "m")))
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(meet, f"query_class {kind}, match_class {kind}, offset int, votes bigint, bit_error double")


def excerpts(media: DataFrame, id_col: str = "id", audio_col: str = "audio") -> DataFrame:
    """(id_col, audio): each recording as another microphone may hear a part of it: from a quarter on, between the steps
    of the original's frames, with quiet noise, the same for equal audio. Null and undecodable audio is null. Repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                out = []
                for a in b.column(1):
                    x, rate = decode_wav(a.as_py())
                    part = x[len(x) // 4 + HOP // 2 :]
                    rng = np.random.default_rng(zlib.crc32(a.as_py() or b""))
                    out.append(encode_wav(part + rng.normal(0, NOISE, len(part)), rate) if len(x) else None)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "audio"])

    base = picked(media, id=id_col, audio=audio_col).withColumn("audio", F.col("audio").cast("binary"))
    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, audio binary").toDF(id_col, "audio")


def record(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A media table for tables without one: (id_col, audio), each vector played as a melody.

    A null vector has null audio; null and non-finite components play as zero. Repeated rows and null ids stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([melody(v.as_py()) for v in b.column(1)], pa.binary())], names=["id", "audio"])

    base = picked(vectors, id=id_col, v=vector_col).withColumn("v", F.col("v").cast("array<double>"))
    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, audio binary").toDF(id_col, "audio")
