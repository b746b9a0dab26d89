"""TIFF by byte ranges: a data source whose partitions are runs of strips or tiles, found from a file's directories.

Only directories are read to plan, and only the segments of the wanted channels and rectangle are fetched, neighbouring ones in
one read. Both are options of the source: filters that Spark pushes into a Python source are kept with the relation, so that two
branches of a query with different ones would read the same segments. No task holds more than a run of segments, so files may have any size. Paths are those
that pyarrow opens: local ones, s3, gs, hdfs.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.frames import crop
from .tiff import BITS, COMPRESSION, DESCRIPTION, HEIGHT, KINDS, ROWS, SAMPLES, SOFTWARE, STRIP_BYTES, STRIPS, SUB_PAGES, TILE_BYTES, TILE_HEIGHT, TILE_WIDTH, TILES, WIDTH, X_RES, Y_RES

# Fixed values of the format: two further tags, and the codes of the codings.
PREDICTOR, FORMAT = 317, 339
PLAIN, LZW, DEFLATE, PACKBITS, DEFLATE_OLD = 1, 5, 8, 32773, 32946

#: Stored bytes of a partition's segments, and the gap up to which two are fetched in one read.
RUN, GAP = 16 << 20, 64 << 10


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path:
        return (pafs.LocalFileSystem(), path.removeprefix("file:"))
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def files(path: str) -> list[str]:
    """The file, or the files of a folder but for those that begin with a dot or an underscore."""
    fs, at = opened(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type != pafs.FileType.Directory:
        raise FileNotFoundError(path)
    names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(at)) if f.type == pafs.FileType.File and f.base_name[0] not in "._")
    return [f"{path.rstrip('/')}/{n}" for n in names]


class Reader:
    """Reads ranges of a file; ``fetched`` counts the bytes."""

    def __init__(self, path: str) -> None:
        fs, at = opened(path)
        self.file, self.fetched = fs.open_input_file(at), 0

    def __call__(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        self.fetched += len(data)
        return data


@dataclass
class Page:
    """One directory; values that don't stand in it are fetched when they are asked for."""

    read: Reader
    order: str
    big: bool
    entries: dict[int, tuple[int, int, bytes]] = field(default_factory=dict)
    following: int = 0

    def get(self, tag: int, default: object = None) -> object:
        if tag not in self.entries:
            return default
        kind, count, raw = self.entries[tag]
        size = struct.calcsize("=" + KINDS[kind]) * count
        if size > len(raw):
            (at,) = struct.unpack(self.order + ("Q" if self.big else "I"), raw)
            raw = self.read(at, size)
        if kind == 2:
            return raw[:size].rstrip(b"\0").decode("utf-8", "replace")
        return struct.unpack(f"{self.order}{count * len(KINDS[kind])}{KINDS[kind][0]}", raw[:size])

    def one(self, tag: int, default: int | None = None) -> int:
        value = self.get(tag)
        if value is None and default is None:
            raise ValueError(f"a page without tag {tag}")
        return value[0] if value is not None else default


def _page(read: Reader, order: str, big: bool, at: int) -> Page:
    head, entry, width = ("Q", 20, 8) if big else ("H", 12, 4)
    size = struct.calcsize("=" + head)
    (n,) = struct.unpack(order + head, read(at, size))
    raw = read(at + size, n * entry + width)
    page = Page(read, order, big)
    for k in range(n):
        tag, kind = struct.unpack_from(order + "HH", raw, k * entry)
        (count,) = struct.unpack_from(order + ("Q" if big else "I"), raw, k * entry + 4)
        if kind in KINDS:
            page.entries[tag] = (kind, count, raw[(k + 1) * entry - width : (k + 1) * entry])
    (page.following,) = struct.unpack_from(order + ("Q" if big else "I"), raw, n * entry)
    return page


def directories(read: Reader) -> Iterator[Page]:
    """The full-resolution pages in order."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8:
        raise ValueError("not a TIFF file")
    big = struct.unpack_from(order + "H", head, 2)[0] == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), head, 8 if big else 4)[0]
    while at:
        page = _page(read, order, big, at)
        yield page
        at = page.following


def reduced(page: Page, level: int) -> Page:
    """A page's sub-page of a pyramid level; 0 is the page itself."""
    if not level:
        return page
    subs = page.get(SUB_PAGES, ())
    if level > len(subs):
        raise ValueError(f"a page has no level {level}")
    return _page(page.read, page.order, page.big, subs[level - 1])


@dataclass(frozen=True)
class Layout:
    """What a task must know of a page."""

    height: int
    width: int
    kind: str
    coding: int
    predictor: int
    rows: int
    columns: int


def layout(page: Page) -> Layout:
    w, h, bits, coding = page.one(WIDTH), page.one(HEIGHT), page.one(BITS, 1), page.one(COMPRESSION, 1)
    form, predictor = page.one(FORMAT, 1), page.one(PREDICTOR, 1)
    if bits not in (8, 16, 32) or coding not in (PLAIN, LZW, DEFLATE, PACKBITS, DEFLATE_OLD) or page.one(SAMPLES, 1) != 1 or form not in (1, 2) or predictor not in (1, 2):
        raise ValueError("only grey pages of integers of 8, 16 or 32 bits, plain or by deflate, LZW or PackBits, can be read")
    tiled = TILES in page.entries
    rows, columns = (page.one(TILE_HEIGHT), page.one(TILE_WIDTH)) if tiled else (min(page.one(ROWS, h), h), w)
    return Layout(h, w, f"{page.order}{'u' if form == 1 else 'i'}{bits // 8}", coding, predictor, rows, columns)


def segments(page: Page, lay: Layout) -> Iterator[tuple[int, int, int, int]]:
    """(y, x, offset, bytes) of each strip or tile."""
    tiled = TILES in page.entries
    across = -(-lay.width // lay.columns)
    for k, (at, n) in enumerate(zip(page.get(TILES if tiled else STRIPS), page.get(TILE_BYTES if tiled else STRIP_BYTES), strict=True)):
        yield k // across * lay.rows, k % across * lay.columns, at, n


def unpackbits(data: bytes) -> bytes:
    out, k = bytearray(), 0
    while k < len(data):
        n = data[k]
        if n < 128:
            out += data[k + 1 : k + 2 + n]
            k += n + 2
        else:
            out += data[k + 1 : k + 2] * (257 - n) if n > 128 else b""
            k += 2 if n > 128 else 1
    return bytes(out)


def unlzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends; widths grow one code early."""
    table = [bytes([k]) for k in range(256)] + [b"", b""]
    out, last, width, held, bits = [], b"", 9, 0, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            del table[258:]
            last, width = b"", 9
            continue
        if code < len(table):
            now = table[code]
        elif code == len(table) and last:
            now = last + last[:1]
        else:
            raise ValueError("a broken LZW strip")
        if last:
            table.append(last + now[:1])
        out.append(now)
        last = now
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def decoded(raw: bytes, lay: Layout, y: int) -> np.ndarray:
    """A segment's pixels; one that isn't stored is zeros."""
    rows = min(lay.rows, lay.height - y) if lay.columns == lay.width and lay.rows != lay.height and y + lay.rows > lay.height else lay.rows
    kind = np.dtype(lay.kind)
    if not raw:
        return np.zeros((rows, lay.columns), kind)
    data = {PLAIN: bytes, LZW: unlzw, PACKBITS: unpackbits}.get(lay.coding, zlib.decompress)(raw)
    rows = min(rows, len(data) // (lay.columns * kind.itemsize))  # a last strip may be stored short
    block = np.frombuffer(data, kind, rows * lay.columns).reshape(rows, lay.columns)
    if lay.predictor == 2:  # differences along rows, which wrap
        block = np.add.accumulate(block.astype(kind.newbyteorder("=")), axis=1, dtype=kind.newbyteorder("="))
    return block


@dataclass
class Run(InputPartition):
    """Segments of one page that a task reads."""

    path: str
    name: str
    c: int
    lay: Layout
    parts: list[tuple[int, int, int, int]]


class TiffReader(DataSourceReader):
    """``channels`` are numbers from 0, None for all; ``box`` is (y0, y1, x0, x1), ends exclusive, None for all."""

    def __init__(self, path: str, level: int = 0, channels: set[int] | None = None, box: tuple[int, int, int, int] | None = None) -> None:
        self.path, self.level, self.channels, self.box = path, level, channels, box

    def partitions(self) -> list[Run]:
        runs = []
        for path in files(self.path):
            read = Reader(path)
            for c, page in enumerate(directories(read)):
                if self.channels is not None and c not in self.channels:
                    continue
                page = reduced(page, self.level)
                lay = layout(page)
                y0, y1, x0, x1 = self.box or (0, lay.height, 0, lay.width)
                parts, size = [], 0
                for y, x, at, n in segments(page, lay):
                    if y >= y1 or y + lay.rows <= y0 or x >= x1 or x + lay.columns <= x0:
                        continue
                    if parts and size + n > RUN:
                        runs.append(Run(path, path.rsplit("/", 1)[-1], c, lay, parts))
                        parts, size = [], 0
                    parts.append((y, x, at, n))
                    size += n
                if parts:
                    runs.append(Run(path, path.rsplit("/", 1)[-1], c, lay, parts))
        return runs or [Run("", "", 0, Layout(0, 0, "<u1", PLAIN, 1, 1, 1), [])]

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        read = Reader(run.path) if run.parts else None
        for y0, x0, raw in fetched(read, run.parts):
            block = decoded(raw, run.lay, y0)[: run.lay.height - y0, : run.lay.width - x0].astype(np.int64)
            step = max(1, (1 << 16) // block.shape[1])
            for k in range(0, len(block), step):
                part = block[k : k + step]
                y, x = np.indices(part.shape, np.int32)
                n = part.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run.name] * n), pa.array(np.full(n, run.c, np.int32)), pa.array(y.ravel() + np.int32(y0 + k)), pa.array(x.ravel() + np.int32(x0)), pa.array(part.ravel())],
                    names=["image_id", "c", "y", "x", "v"],
                )


def fetched(read: Reader | None, parts: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, bytes]]:
    """(y, x, stored bytes) of segments, in the order of the file; neighbours come in one read, of a sixteenth of a run at most."""
    waiting: list[tuple[int, int, int, int]] = []

    def take() -> Iterator[tuple[int, int, bytes]]:
        if waiting:
            first = waiting[0][2]
            data = read(first, waiting[-1][2] + waiting[-1][3] - first)
            for y, x, at, n in waiting:
                yield y, x, data[at - first : at - first + n]
            waiting.clear()

    for part in sorted(parts, key=lambda p: p[2]):
        y, x, at, n = part
        if not n or not at:
            yield y, x, b""
            continue
        if waiting and (at - (waiting[-1][2] + waiting[-1][3]) > GAP or at + n - waiting[0][2] > RUN // 16):
            yield from take()
        waiting.append(part)
    yield from take()


class TiffRanges(DataSource):
    """Options: ``path``, a file or a folder of files, ``level`` of the pyramid (0: full resolution), ``channels`` and ``box`` as numbers
    with commas between."""

    @classmethod
    def name(cls) -> str:
        return "tiff_ranges"

    def schema(self) -> str:
        return "image_id string, c int, y int, x int, v bigint"

    def reader(self, schema: object) -> TiffReader:
        channels, box = (tuple(map(int, self.options[k].split(","))) if self.options.get(k) else None for k in ("channels", "box"))
        return TiffReader(self.options["path"], int(self.options.get("level", "0")), channels and set(channels), box)


def read(spark: SparkSession, path: str, numbers: list[int] | None = None, level: int = 0, rectangle: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(image_id, c, y, x, v) of all pages or those numbered from 1, of a level of the pyramid, whole or within ``rectangle`` (y, x, height,
    width), for which only the segments that touch it are fetched."""
    spark.dataSource.register(TiffRanges)
    source = spark.read.format("tiff_ranges").option("path", path).option("level", level)
    if numbers is not None:
        if not numbers or min(numbers) < 1:
            raise ValueError("channels are numbered from 1")
        source = source.option("channels", ",".join(str(n - 1) for n in numbers))
    if rectangle is None:
        return source.load()
    y, x, height, width = rectangle
    return crop(source.option("box", f"{y},{y + height},{x},{x + width}").load(), y, x, height, width)


def metadata(path: str) -> dict[str, object]:
    """Of the first file: width, height, bits, pixel sizes, channel names, software, from its first directory alone."""
    page = next(directories(Reader(files(path)[0])))
    text = page.get(DESCRIPTION, "") or ""
    out: dict[str, object] = {"width": page.one(WIDTH), "height": page.one(HEIGHT), "bits": page.one(BITS, 1), "unit": "µm", "software": page.get(SOFTWARE, ""), "channel_names": re.findall(r'<Channel\b[^>]*\bName="([^"]*)"', text)}
    for name, key, tag in (("pixel_size_x", "PhysicalSizeX", X_RES), ("pixel_size_y", "PhysicalSizeY", Y_RES)):
        m, ratio = re.search(rf'\b{key}="([^"]+)"', text), page.get(tag)
        out[name] = float(m[1]) if m else ratio[0] / ratio[1] if "<OME" not in text and ratio and ratio[1] else 1.0
    return out
