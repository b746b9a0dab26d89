"""Chunked arrays in Zarr's version 2 layout: a group with an array (channel, y, x) for each pyramid level.

Chunks are files of their own, deflated, in C order. Reading is distributed over chunks, of which only those of the
wanted level and channels are opened; writing gives each chunk to one task. The small JSON files go through the driver.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frames, tiles

CHUNK = 1024


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _text(spark: SparkSession, path: str) -> str | None:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, value: dict) -> None:
    p, fs = _path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()


def _inflate(data: bytes, codec: str | None) -> bytes:
    if codec is None:
        return data
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(data)
    return zlib.decompressobj(47).decompress(data)  # zlib's or gzip's header; what follows the stream is not read


def write(px: DataFrame, path: str, size: tuple[int, int], bits: int = 16, is_mask: bool = False, pixel_sizes: tuple[float, float] = (1.0, 1.0), channel_names: list[str] | None = None, **_: object) -> None:
    """All levels of ``(c, y, x, v)``; pixels that are missing are zero, and chunks without any are not stored."""
    spark = px.sparkSession
    if "c" not in px.columns:
        px = px.withColumn("c", F.lit(0))
    levels, _, _ = frames.pyramid_plan(*size)
    kind = np.dtype(f"<u{bits // 8}")
    channels = (px.agg(F.max("c")).first()[0] or 0) + 1

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        level, c, ty, tx = (k.as_py() for k in key)
        block = np.zeros((CHUNK, CHUNK), kind)
        y, x = (rows[k].to_numpy() % CHUNK for k in ("y", "x"))
        block[y, x] = rows["v"].to_numpy().astype(kind)
        return pa.table({"level": pa.array([level], pa.int32()), "chunk": [f"{c}.{ty}.{tx}"], "value": pa.array([zlib.compress(block.tobytes(), 1)], pa.binary())})

    tiled = tiles.tile_of(frames.pyramid(px.select("c", "y", "x", F.col("v").cast("bigint").alias("v")), levels, is_mask), CHUNK)
    found = tiled.groupBy("level", "c", "ty", "tx").applyInArrow(one, "level int, chunk string, value binary")
    parts = f"{path}/.parts"
    found.select("level", "chunk", F.col("value").cast("string").alias("value")).write.mode("overwrite").partitionBy("level", "chunk").text(parts)
    _put(spark, f"{path}/.zgroup", {"zarr_format": 2})
    top, fs = _path(spark, path)
    for old in fs.listStatus(top):  # levels of what was there; the new chunks are all in the parts by now
        if old.isDirectory() and old.getPath().getName().isdigit():
            fs.delete(old.getPath(), True)
    for k in range(levels + 1):
        shape = [channels, *(-(-d // 2**k) for d in size)]
        _put(spark, f"{path}/{k}/.zarray", {"zarr_format": 2, "shape": shape, "chunks": [1, CHUNK, CHUNK], "dtype": kind.str, "order": "C", "fill_value": 0, "filters": None, "compressor": {"id": "zlib", "level": 1}})
        folder, _ = _path(spark, f"{parts}/level={k}")
        for chunk in fs.listStatus(folder) if fs.exists(folder) else ():
            (part,) = (f.getPath() for f in fs.listStatus(chunk.getPath()) if f.getPath().getName().startswith("part-"))
            target, _ = _path(spark, f"{path}/{k}/{chunk.getPath().getName().removeprefix('chunk=')}")
            fs.delete(target, False)
            fs.rename(part, target)
    fs.delete(_path(spark, parts)[0], True)
    scale = [{"type": "scale", "scale": [1.0, *map(float, pixel_sizes)]}]
    _put(spark, f"{path}/.zattrs", {"multiscales": [{"version": "0.4", "datasets": [{"path": str(k), "coordinateTransformations": scale} for k in range(levels + 1)]}], "channel_names": channel_names})


def meta(spark: SparkSession, path: str) -> dict:
    """Pixel sizes (y, x), channel names, size and bits of a pixel; one micrometre where nothing is said."""
    spec = json.loads(_text(spark, f"{path.rstrip('/')}/.zarray") or _text(spark, f"{path.rstrip('/')}/0/.zarray") or "{}")
    found = json.loads(_text(spark, f"{path}/.zattrs") or "{}")
    scale = [1.0, 1.0]
    for m in found.get("multiscales", ()):
        for t in m["datasets"][0].get("coordinateTransformations", ()):
            scale = t.get("scale", scale)[-2:]
    return {"pixel_sizes": tuple(scale), "channel_names": found.get("channel_names"), "size": tuple(spec.get("shape", ())[-2:]), "bits": 8 * np.dtype(spec.get("dtype", "<u2")).itemsize}


def read(spark: SparkSession, path: str, level: int = 0, numbers: list[int] | None = None) -> DataFrame:
    """(c, y, x, v) of a level of a group, or of an array, of all channels or those numbered from 1; arrays of two
    dimensions are channel 0. Chunks that aren't stored have no rows."""
    path = path.rstrip("/")
    folder = path if _text(spark, f"{path}/.zarray") else f"{path}/{level}"
    said = _text(spark, f"{folder}/.zarray")
    if said is None:
        raise ValueError(f"{path} holds no array of level {level}")
    spec = json.loads(said)
    codec = (spec.get("compressor") or {}).get("id")
    if codec not in (None, "zlib", "gzip", "zstd") or spec.get("order", "C") != "C" or spec.get("filters") or len(spec["shape"]) not in (2, 3):
        raise ValueError("only arrays of two or three dimensions in C order, plain or by zlib, gzip or zstd, can be read")
    shape, chunks, kind = spec["shape"], spec["chunks"], np.dtype(spec["dtype"])
    if len(shape) == 2:
        shape, chunks = [1, *shape], [1, *chunks]
    real = kind.kind == "f"
    nested = spec.get("dimension_separator", ".") == "/"
    depth = len(spec["shape"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                at = [int(k) for k in (name.split("/")[-depth:] if nested else name.split("/")[-1].split("."))]
                c0, y0, x0 = (k * n for k, n in zip([0, *at] if depth == 2 else at, chunks, strict=True))
                block = np.frombuffer(_inflate(content.as_py(), codec), kind, int(np.prod(chunks))).reshape(chunks)
                block = block[: shape[0] - c0, : shape[1] - y0, : shape[2] - x0]
                for i, image in enumerate(block):
                    if numbers is not None and c0 + i + 1 not in numbers:
                        continue
                    for k in range(0, len(image), 64):
                        part = image[k : k + 64]
                        y, x = np.indices(part.shape, np.int32)
                        v = part.ravel().astype(np.float64 if real else np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(v.size, c0 + i, np.int32)), pa.array(y.ravel() + np.int32(y0 + k)), pa.array(x.ravel() + np.int32(x0)), pa.array(v)], names=["c", "y", "x", "v"])

    names = "*" + "/*" * (depth - 1) if nested else "[0-9]*"
    files = spark.read.format("binaryFile").load(f"{folder}/{names}").select("path", "content")
    if numbers is not None and not nested and depth == 3 and chunks[0] == 1:
        files = files.where(F.split(F.element_at(F.split("path", "/"), -1), r"\.")[0].cast("int").isin([n - 1 for n in numbers]))
    return files.mapInArrow(run, f"c int, y int, x int, v {'double' if real else 'bigint'}")
