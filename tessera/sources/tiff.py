"""TIFF files: grey pages of unsigned integers, in strips or tiles, plain or deflated, with OME metadata.

Files are read with Spark's binary source, so any file system it knows will do; each page's strips and tiles
become rows in the executors. Pages of a file are one image's channels. BigTIFF and classic TIFF are both read;
BigTIFF is written.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format: sizes and codes of field types, and tags.
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 12: "d", 13: "I", 16: "Q", 18: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIPS, SAMPLES, ROWS, STRIP_BYTES, X_RES, Y_RES = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279, 282, 283
SOFTWARE, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SUB_PAGES = 305, 322, 323, 324, 325, 330


def pages(data: bytes) -> Iterator[dict[int, object]]:
    """Each full-resolution page's tags: numbers as tuples, text as str."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    big = struct.unpack_from(order + "H", data, 2)[0] == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)[0]
    width, head, entry = (8, "Q", 20) if big else (4, "H", 12)
    while at:
        (n,) = struct.unpack_from(order + head, data, at)
        at += struct.calcsize(head)
        tags: dict[int, object] = {}
        for k in range(n):
            here = at + k * entry
            tag, kind = struct.unpack_from(order + "HH", data, here)
            (count,) = struct.unpack_from(order + ("Q" if big else "I"), data, here + 4)
            code = KINDS.get(kind)
            if code is None:
                continue
            size = struct.calcsize("=" + code) * count
            place = here + (12 if big else 8)
            if size > width:
                (place,) = struct.unpack_from(order + ("Q" if big else "I"), data, place)
            tags[tag] = data[place : place + count].rstrip(b"\0").decode("utf-8", "replace") if kind == 2 else struct.unpack_from(f"{order}{count * len(code)}{code[0]}", data, place)
        tags[-1] = order  # type: ignore[assignment]
        yield tags
        (at,) = struct.unpack_from(order + ("Q" if big else "I"), data, at + n * entry)


def page_array(data: bytes, tags: dict[int, object]) -> np.ndarray:
    """One page's pixels. Raises ValueError for layouts other than the module's."""
    w, h, bits = tags[WIDTH][0], tags[HEIGHT][0], tags[BITS][0]
    packed = tags.get(COMPRESSION, (1,))[0]
    if bits not in (8, 16, 32) or packed not in (1, 8, 32946) or tags.get(SAMPLES, (1,))[0] != 1:
        raise ValueError("only grey pages of 8, 16 or 32 bits, plain or deflated, can be read")
    kind = np.dtype(f"{tags[-1]}u{bits // 8}")
    tiled = TILES in tags
    th, tw = (tags[TILE_HEIGHT][0], tags[TILE_WIDTH][0]) if tiled else (min(tags.get(ROWS, (h,))[0], h), w)
    out = np.zeros((h, w), kind.newbyteorder("="))
    across = -(-w // tw)
    for k, (at, n) in enumerate(zip(tags[TILES if tiled else STRIPS], tags[TILE_BYTES if tiled else STRIP_BYTES], strict=True)):
        raw = data[at : at + n]
        raw = zlib.decompress(raw) if packed != 1 else raw
        y, x = k // across * th, k % across * tw
        rows = th if tiled else min(th, h - y)
        block = np.frombuffer(raw, kind, rows * tw).reshape(rows, tw)
        out[y : y + th, x : x + tw] = block[: h - y, : w - x]
    return out


def metadata(data: bytes) -> dict[str, object]:
    """width, height, pixel sizes and unit, channel names, software; sizes are 1 where the file has none."""
    first = next(pages(data))
    text = first.get(DESCRIPTION, "") or ""
    out: dict[str, object] = {"width": first[WIDTH][0], "height": first[HEIGHT][0], "bits": first[BITS][0], "unit": "µm", "software": first.get(SOFTWARE, ""), "channel_names": re.findall(r'<Channel\b[^>]*\bName="([^"]*)"', text)}
    for name, key, tag in (("pixel_size_x", "PhysicalSizeX", X_RES), ("pixel_size_y", "PhysicalSizeY", Y_RES)):
        m = re.search(rf'\b{key}="([^"]+)"', text)
        ratio = first.get(tag)
        out[name] = float(m[1]) if m else ratio[0] / ratio[1] if "<OME" not in text and ratio and ratio[1] else 1.0
    return out


def encode(channels: np.ndarray, tile: int = 1024, pixel_sizes: tuple[float, float] = (1.0, 1.0), channel_names: list[str] | None = None, software: str = "", is_mask: bool = False) -> bytes:
    """A pyramidal OME BigTIFF of (C, Y, X) unsigned integers: deflated tiles, reduced levels as sub-pages."""
    from ..operators.frames import pyramid_plan

    levels = pyramid_plan(*channels.shape[1:])[0]
    names = channel_names or [f"Channel {i}" for i in range(len(channels))]
    xml = (
        f'<?xml version="1.0" encoding="UTF-8"?><OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06" Creator="{software}"><Image ID="Image:0"><Pixels ID="Pixels:0" DimensionOrder="XYCZT" Type="uint{8 * channels.dtype.itemsize}" '
        f'SizeX="{channels.shape[2]}" SizeY="{channels.shape[1]}" SizeC="{len(channels)}" SizeZ="1" SizeT="1" PhysicalSizeX="{pixel_sizes[1]}" PhysicalSizeY="{pixel_sizes[0]}" PhysicalSizeXUnit="µm" PhysicalSizeYUnit="µm">'
        + "".join(f'<Channel ID="Channel:0:{i}" Name="{n}" SamplesPerPixel="1"/>' for i, n in enumerate(names))
        + "<TiffData/></Pixels></Image></OME>"
    )
    out = bytearray(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0))
    link = 8

    def page(image: np.ndarray, text: str | None, sub: list[int] | None) -> tuple[int, int]:
        """Append a page; (its place, the place of its link to the next one)."""
        h, w = image.shape
        spots, sizes = [], []
        for y in range(0, h, tile):
            for x in range(0, w, tile):
                block = np.zeros((tile, tile), image.dtype.newbyteorder("<"))
                cut = image[y : y + tile, x : x + tile]
                block[: cut.shape[0], : cut.shape[1]] = cut
                raw = zlib.compress(block.tobytes())
                spots.append(len(out))
                sizes.append(len(raw))
                out.extend(raw)
        tags: list[tuple[int, int, list[int] | bytes]] = [(254, 4, [0 if text is not None or sub is not None else 1]), (WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [8 * image.dtype.itemsize]), (COMPRESSION, 3, [8]), (PHOTOMETRIC, 3, [1])]
        if text is not None:
            tags += [(DESCRIPTION, 2, text.encode() + b"\0")]
        tags += [(SAMPLES, 3, [1])]
        if text is not None and software:
            tags += [(SOFTWARE, 2, software.encode() + b"\0")]
        tags += [(TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]), (TILES, 16, spots), (TILE_BYTES, 16, sizes)]
        if sub:
            tags += [(SUB_PAGES, 16, sub)]
        tags.sort(key=lambda t: t[0])
        entries = b""
        for tag, kind, value in tags:
            raw = value if isinstance(value, bytes) else struct.pack(f"<{len(value)}{KINDS[kind]}", *value)
            count = len(value)
            if len(raw) > 8:
                out.extend(b"\0" * (-len(out) % 8))
                entries += struct.pack("<HHQQ", tag, kind, count, len(out))
                out.extend(raw)
            else:
                entries += struct.pack("<HHQ", tag, kind, count) + raw.ljust(8, b"\0")
        out.extend(b"\0" * (-len(out) % 8))
        at = len(out)
        out.extend(struct.pack("<Q", len(tags)) + entries + struct.pack("<Q", 0))
        return at, len(out) - 8

    for i, image in enumerate(channels):
        sub, small = [], image
        for _ in range(levels):
            if is_mask:
                small = small[::2, ::2]
            else:
                even = np.pad(small.astype(np.uint64), [(0, d % 2) for d in small.shape])
                small = (even.reshape(even.shape[0] // 2, 2, even.shape[1] // 2, 2).sum(axis=(1, 3)) // 4).astype(image.dtype)
            sub.append(page(small, None, None)[0])
        at, next_link = page(image, xml if i == 0 else None, sub)
        out[link if i else 8 : (link if i else 8) + 8] = struct.pack("<Q", at)
        link = next_link
    return bytes(out)


def read(spark: SparkSession, path: str, numbers: list[int] | None = None, rows: int = 64) -> DataFrame:
    """(image_id, c, y, x, v) of TIFF files, of all pages or those numbered from 1; undecoded pages cost nothing."""
    wanted = None if numbers is None else {n - 1 for n in numbers}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = content.as_py()
                for c, tags in enumerate(pages(data)):
                    if wanted is not None and c not in wanted:
                        continue
                    image = page_array(data, tags)
                    h, w = image.shape
                    for y in range(0, h, rows):
                        part = image[y : y + rows].astype(np.int64)
                        n = part.size
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * n), pa.array(np.full(n, c, np.int32)), pa.array(np.repeat(np.arange(y, y + len(part), dtype=np.int32), w)), pa.array(np.tile(np.arange(w, dtype=np.int32), len(part))), pa.array(part.ravel())],
                            names=["image_id", "c", "y", "x", "v"],
                        )

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files.mapInArrow(run, "image_id string, c int, y int, x int, v bigint")


def described(spark: SparkSession, path: str) -> dict[str, object]:
    """``metadata`` of the first file under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array([json.dumps(metadata(content.as_py()))])], names=["said"])

    return json.loads(spark.read.format("binaryFile").load(path).select("content").limit(1).mapInArrow(run, "said string").first()["said"])


def write(px: DataFrame, path: str, size: tuple[int, int], bits: int = 16, **options: object) -> None:
    """One image of ``(c, y, x, v)`` as a file under ``path``.

    An image is one file and so one task's work, bounded by its size; larger ones belong in the tile store. The
    text writer's line end after the file's bytes is beyond all of its offsets.
    """
    if "c" not in px.columns:
        px = px.withColumn("c", F.lit(0))
    kind = np.dtype(f"u{bits // 8}")

    def one(rows: pa.Table) -> pa.Table:
        image = np.zeros((int(max(rows["c"].to_pylist(), default=0)) + 1, *size), kind)
        c, y, x, v = (rows[k].to_numpy() for k in ("c", "y", "x", "v"))
        image[c, y, x] = v.astype(np.int64).astype(kind)
        return pa.table({"file": pa.array([encode(image, **options)], pa.binary())})

    whole = px.select(F.lit(0).alias("g"), F.col("c").cast("int").alias("c"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("v").cast("bigint").alias("v"))
    whole.groupBy("g").applyInArrow(one, "file binary").select(F.col("file").cast("string").alias("value")).coalesce(1).write.mode("overwrite").text(path)
