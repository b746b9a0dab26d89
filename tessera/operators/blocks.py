"""Array tiles: a frame with a row for each tile, its pixels as compressed arrays, and strips for what neighbours must know.

A tile's row is ``(ty, tx, band, ...)``, each band a zstd-compressed array in rows, of the tile's core. Stencils get what
lies around a tile from its eight neighbours, which send the strips that it needs and no more. What has no bounded reach -
grey reconstruction, flooding - runs on each tile with what the neighbours' borders say so far, and tiles whose incoming
borders have changed run again, until none has: the result is that of the whole image, whatever the tile.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels, tiles

Box = tuple[int, int, int, int]

#: Side of a tile. A task holds a few arrays of it at once.
TILE = 2048
#: Bytes of a Parquet row group of tiles, and of an Arrow batch: a reader holds as many tiles as fit.
ROW_GROUP, BATCH = 16 << 20, "32m"
AROUND = tuple((dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx)
KEY = ["ty", "tx"]


@dataclass(frozen=True)
class Blocks:
    """Tiles of an image of ``size`` (height, width); ``bands`` are their names and numpy types."""

    frame: DataFrame | None
    size: tuple[int, int]
    tile: int
    bands: dict[str, str]

    def box(self, ty: int, tx: int, halo: int = 0) -> Box:
        return tiles.box(ty, tx, self.tile, halo, self.size)

    @property
    def plan(self) -> Blocks:
        """All but the frame, for tasks."""
        return replace(self, frame=None)

    @property
    def grid(self) -> tuple[int, int]:
        return -(-self.size[0] // self.tile), -(-self.size[1] // self.tile)

    def schema(self) -> str:
        return "ty int, tx int" + "".join(f", {b} binary" for b in self.bands)


def pack(array: np.ndarray, kind: str | np.dtype) -> bytes:
    return pa.compress(np.ascontiguousarray(array, kind), codec="zstd", asbytes=True)


def unpack(data: bytes, kind: str | np.dtype, shape: tuple[int, int]) -> np.ndarray:
    size = shape[0] * shape[1] * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), kind).reshape(shape)


def _shape(box: Box) -> tuple[int, int]:
    return box[1] - box[0], box[3] - box[2]


def _tune(blocks: DataFrame) -> None:
    """Few tiles in a batch, so that a worker's memory is that of some tiles."""
    blocks.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def held(blocks: Blocks, name: str = "blocks") -> Blocks:
    """Written to the shared folder and read again: what follows doesn't depend on what an executor keeps."""
    from ..sources.store import scratch

    path = scratch(blocks.frame.sparkSession, name)
    blocks.frame.write.option("parquet.block.size", ROW_GROUP).option("compression", "none").parquet(path)
    return replace(blocks, frame=blocks.frame.sparkSession.read.schema(blocks.frame.schema).parquet(path))


def from_pixels(px: DataFrame, size: tuple[int, int], bands: dict[str, str], tile: int = TILE, fill: dict[str, int] | None = None) -> Blocks:
    """Rows of pixels to tiles, in one shuffle; pixels that aren't there have ``fill`` (0). Every tile of the image has a row, and
    places beyond the image are left out. Of rows at the same place any one counts."""
    fill, out = fill or {}, Blocks(None, size, tile, dict(bands))
    _tune(px)
    placed = px.select(*(F.col(k).cast("int").alias(k) for k in ("y", "x")), *bands).where((F.col("y") >= 0) & (F.col("y") < size[0]) & (F.col("x") >= 0) & (F.col("x") < size[1]))
    placed = tiles.tile_of(placed, tile)

    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        ty, tx = (k.as_py() for k in key)
        box = out.box(ty, tx)
        rows = rows.filter(rows["y"].is_valid())
        y, x = (rows[k].to_numpy() for k in ("y", "x"))
        found = {}
        for name, kind in bands.items():
            array = np.full(_shape(box), fill.get(name, 0), kind)
            array[y - box[0], x - box[2]] = rows[name].to_numpy()
            found[name] = [pack(array, kind)]
        return pa.table({"ty": pa.array([ty], pa.int32()), "tx": pa.array([tx], pa.int32()), **{n: pa.array(v, pa.binary()) for n, v in found.items()}})

    return replace(out, frame=_by_tile(placed, out).applyInArrow(gather, out.schema()))


def _by_tile(placed: DataFrame, out: Blocks, halo: int = 0) -> GroupedData:
    """Rows with ty and tx by tile, with a row without a place for every tile of the image."""
    spark, (ny, nx) = placed.sparkSession, out.grid
    every = spark.range(ny * nx).select(F.floor(F.col("id") / nx).cast("int").alias("ty"), (F.col("id") % nx).cast("int").alias("tx"))
    return placed.unionByName(every, allowMissingColumns=True).repartition(tiles.tasks(spark, out.size, out.tile, halo), *KEY).groupBy(*KEY)


def near(px: DataFrame, reach: int, kernel: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]], size: tuple[int, int], bands: dict[str, str], tile: int) -> Blocks:
    """``kernel(label, on)`` of what each tile sees of ``px(y, x, label)``, as ``tiles.near`` has it, with its arrays as bands: no pixel has a
    row again. Every tile of the image has one."""
    out = Blocks(None, size, tile, dict(bands))
    _tune(px)

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        ty, tx = (int(k.as_py()) for k in key)
        return pa.Table.from_batches([_row(ty, tx, kernel(*tiles.seen(rows.filter(rows["y"].is_valid()), (ty * tile, tx * tile), reach, size, tile)), out)])

    return replace(out, frame=_by_tile(tiles.around(px, reach, size, tile), out, reach).applyInArrow(one, out.schema()))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def to_pixels(blocks: Blocks, sparse: str | None = None) -> DataFrame:
    """(y, x, band, ...): a row for each pixel, or for those where band ``sparse`` isn't 0."""
    kinds = {n: {"i": "long", "u": "long", "f": "double", "b": "boolean"}[np.dtype(k).kind] for n, k in blocks.bands.items()}
    plan = blocks.plan
    types = {"long": (pa.int64(), np.int64), "double": (pa.float64(), np.float64), "boolean": (pa.bool_(), bool)}

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            box = plan.box(row["ty"], row["tx"])
            arrays = {n: unpack(row[n], k, _shape(box)) for n, k in plan.bands.items()}
            step = max(1, (1 << 18) // max(1, _shape(box)[1]))
            for y0 in range(0, _shape(box)[0], step):
                part = {n: a[y0 : y0 + step] for n, a in arrays.items()}
                y, x = np.nonzero(part[sparse]) if sparse else (a.ravel() for a in np.indices(next(iter(part.values())).shape))
                values = [pa.array(a[y, x].astype(types[kinds[n]][1]), types[kinds[n]][0]) for n, a in part.items()]
                yield pa.RecordBatch.from_arrays([pa.array((y + y0 + box[0]).astype(np.int32)), pa.array((x + box[2]).astype(np.int32)), *values], ["y", "x", *part])

    _tune(blocks.frame)
    return blocks.frame.mapInArrow(spread, "y int, x int" + "".join(f", {n} {k}" for n, k in kinds.items()))


def mapped(blocks: Blocks, kernel: Callable[..., dict[str, np.ndarray]], bands: dict[str, str], told: DataFrame | None = None) -> Blocks:
    """``kernel(arrays, box)`` on each tile alone; with ``told(ty, tx, told)``, ``kernel(arrays, box, told)``, None where it has no row."""
    plan = blocks.plan
    out = replace(plan, bands=dict(bands))
    heard = told is not None
    frame = blocks.frame if told is None else blocks.frame.join(told.hint("merge"), KEY, "left")  # tiles hold whole images

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            box = plan.box(row["ty"], row["tx"])
            more = [row["told"]] if heard else []
            yield _row(row["ty"], row["tx"], kernel({n: unpack(row[n], k, _shape(box)) for n, k in plan.bands.items()}, box, *more), out)

    _tune(frame)
    return replace(out, frame=frame.mapInArrow(run, out.schema()))


def picked(blocks: Blocks, *names: str) -> Blocks:
    """Some of the bands."""
    return replace(blocks, frame=blocks.frame.select(*KEY, *names), bands={n: blocks.bands[n] for n in names})


def _row(ty: int, tx: int, arrays: dict[str, np.ndarray], like: Blocks) -> pa.RecordBatch:
    data = [pa.array([pack(arrays[n], k)], pa.binary()) for n, k in like.bands.items()]
    return pa.RecordBatch.from_arrays([pa.array([ty], pa.int32()), pa.array([tx], pa.int32()), *data], [*KEY, *like.bands])


# -- bounded reach ------------------------------------------------------------------------------------


def _strips(blocks: Blocks, reach: int) -> DataFrame:
    """(ty, tx, y0, x0, h, w, bands): each tile's own pixels, and those that it sends to neighbours, by receiver."""
    plan, (ny, nx) = blocks.plan, blocks.grid

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ty, tx = row["ty"], row["tx"]
            own = plan.box(ty, tx)
            places, data = [(ty, tx, own[0], own[2], *_shape(own))], {n: [row[n]] for n in plan.bands}
            arrays = {n: unpack(row[n], k, _shape(own)) for n, k in plan.bands.items()}
            for dy, dx in AROUND:
                to = (ty + dy, tx + dx)
                if not (0 <= to[0] < ny and 0 <= to[1] < nx):
                    continue
                seen = plan.box(*to, reach)
                y0, y1, x0, x1 = max(own[0], seen[0]), min(own[1], seen[1]), max(own[2], seen[2]), min(own[3], seen[3])
                if y0 < y1 and x0 < x1:
                    places.append((*to, y0, x0, y1 - y0, x1 - x0))
                    for n, k in plan.bands.items():
                        data[n].append(pack(arrays[n][y0 - own[0] : y1 - own[0], x0 - own[2] : x1 - own[2]], k))
            columns = [pa.array(c, pa.int32()) for c in zip(*places, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(d, pa.binary()) for d in data.values())], ["ty", "tx", "y0", "x0", "h", "w", *data])

    _tune(blocks.frame)
    return blocks.frame.mapInArrow(send, "ty int, tx int, y0 int, x0 int, h int, w int" + "".join(f", {b} binary" for b in blocks.bands))


def stencil(blocks: Blocks, reach: int, kernel: Callable[[dict[str, np.ndarray], Box, Box], dict[str, np.ndarray]], bands: dict[str, str]) -> Blocks:
    """``kernel(arrays, box, seen)`` on each tile with ``reach`` pixels around it: ``seen`` is the box of the arrays, clipped to the
    image, ``box`` the tile's own, whose results it returns. A reach beyond the next tile is an error."""
    if reach > blocks.tile:
        raise ValueError(f"a stencil of {reach} pixels reaches beyond the next tile")
    plan = blocks.plan
    out = replace(plan, bands=dict(bands))

    def one(key: tuple, parts: pa.Table) -> pa.Table:
        ty, tx = (k.as_py() for k in key)
        box, seen = plan.box(ty, tx), plan.box(ty, tx, reach)
        arrays = {n: np.empty(_shape(seen), k) for n, k in plan.bands.items()}
        for part in parts.to_pylist():
            y, x = part["y0"] - seen[0], part["x0"] - seen[2]
            for n, k in plan.bands.items():
                arrays[n][y : y + part["h"], x : x + part["w"]] = unpack(part[n], k, (part["h"], part["w"]))
        return pa.Table.from_batches([_row(ty, tx, kernel(arrays, box, seen), out)])

    return replace(out, frame=_strips(blocks, reach).groupBy(*KEY).applyInArrow(one, out.schema()))


def inner(array: np.ndarray, box: Box, seen: Box) -> np.ndarray:
    """The part of ``array``, which lies over ``seen``, within ``box``."""
    return array[box[0] - seen[0] : box[1] - seen[0], box[2] - seen[2] : box[3] - seen[2]]


def convolved(array: np.ndarray, wy: list[int], wx: list[int], edge: str, box: Box, seen: Box, size: tuple[int, int]) -> np.ndarray:
    """Weighted sums over ``box`` along both axes, in integers; beyond the image as ``edge`` says."""
    mode = {"reflect": "symmetric", "nearest": "edge", "constant": "constant"}[edge]
    out = array.astype(np.int64)
    for axis, w in ((0, wy), (1, wx)):
        r, n = len(w) // 2, box[2 * axis + 1] - box[2 * axis]
        if r > size[axis] and edge == "reflect":
            raise ValueError("the kernel reaches beyond the mirrored image")
        before = r - (box[2 * axis] - seen[2 * axis])
        after = r - (seen[2 * axis + 1] - box[2 * axis + 1])
        if before < 0 or after < 0:  # more is seen than this axis needs
            cut = slice(max(0, -before), out.shape[axis] - max(0, -after))
            out = out[cut] if axis == 0 else out[:, cut]
        padded = np.pad(out, [(max(0, before), max(0, after)) if k == axis else (0, 0) for k in (0, 1)], mode=mode)
        out = sum(int(k) * (padded[i : i + n] if axis == 0 else padded[:, i : i + n]) for i, k in enumerate(w) if k)
    return out


def gaussian(blocks: Blocks, sigma: float, edge: str = "reflect", truncate: float = 4.0) -> tuple[Blocks, int]:
    """Each band smoothed as integers, as ``neighbourhood.gaussian`` does by rows, and the number that divides them."""
    from .neighbourhood import gaussian_weights

    if sigma == 0:
        return blocks, 1
    w = gaussian_weights(sigma, truncate=truncate)
    size = blocks.size

    def kernel(arrays: dict[str, np.ndarray], box: Box, seen: Box) -> dict[str, np.ndarray]:
        return {n: convolved(a, w, w, edge, box, seen, size) for n, a in arrays.items()}

    return stencil(blocks, len(w) // 2, kernel, dict.fromkeys(blocks.bands, "<i8")), sum(w) ** 2


def eroded(blocks: Blocks, band: str, offsets: list[tuple[int, int]], beyond: bool = False) -> Blocks:
    """Pixels whose places at all ``offsets`` are in ``band`` too; ``beyond`` says whether places beyond the image are."""
    reach = max(max(abs(dy), abs(dx)) for dy, dx in offsets)

    def kernel(arrays: dict[str, np.ndarray], box: Box, seen: Box) -> dict[str, np.ndarray]:
        around = [(reach - abs(box[k] - seen[k]), reach - abs(box[k + 1] - seen[k + 1])) for k in (0, 2)]
        on = np.pad(arrays[band], around, constant_values=beyond)
        h, w = _shape(box)
        kept = np.ones((h, w), bool)
        for dy, dx in offsets:
            kept &= on[reach + dy : reach + dy + h, reach + dx : reach + dx + w]
        return {band: kept}

    return stencil(picked(blocks, band), reach, kernel, {band: "?"})


# -- unbounded reach ----------------------------------------------------------------------------------

Rim = dict[tuple[int, int], bytes]
#: A time: level and wave. Given one, a step leaves out what it hears of that time and later.
Time = tuple[float, int]
#: ``step(arrays, box, rim, until, before)``; ``before`` are the bands that it found when the tile ran last.
Step = Callable[[dict[str, np.ndarray], Box, Rim, Time | None, dict[str, np.ndarray] | None], tuple[dict[str, np.ndarray], Rim]]

#: Rounds that must lessen the news, or what is not settled yet is forgotten, see ``relaxed``.
PATIENCE = 8


def relaxed(blocks: Blocks, step: Step, bands: dict[str, str], earliest: Callable[[bytes, bytes], Time] | None = None, most_rounds: int = 10_000) -> Blocks:
    """The fixed point of a step, which returns a tile's result and what each neighbour must know of it.

    ``rim`` holds what the neighbours, by direction, said last; empty messages are as none. Each round runs the tiles to which a
    neighbour said something new. Messages of a tile are eight at most; blocks are read again only where a tile runs again.

    Where messages can be taken back, two tiles can go on telling each other, ever later, what both have from the other only.
    ``earliest(old, new)`` is the time of the first difference of two messages: what is before the earliest of a round is settled.
    If ``PATIENCE`` rounds don't lessen the news, all tiles run with what they heard before that time, and then as usual, so that nothing
    is left but what follows from what is settled.
    """
    plan, (ny, nx), own = blocks.plan, blocks.grid, list(blocks.bands)
    out = replace(plan, bands=dict(bands))
    rims = "array<struct<dy: int, dx: int, data: binary>>"
    schema = out.schema() + ", sent array<struct<ty: int, tx: int, dy: int, dx: int, data: binary>>"
    sent_type = T._parse_datatype_string(schema)["sent"].dataType
    arrow_sent = pa.list_(pa.struct([(f.name, pa.int32() if f.name != "data" else pa.binary()) for f in sent_type.elementType.fields]))

    def run(until: Time | None) -> Callable:
        def tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                ty, tx = row["ty"], row["tx"]
                box = plan.box(ty, tx)
                rim = {(m["dy"], m["dx"]): m["data"] for m in row["rim"] or () if m["data"]}
                before = {n: unpack(row[f"was_{n}"], k, _shape(box)) for n, k in out.bands.items()} if row["rim"] is not None and until is None else None
                found, said = step({n: unpack(row[n], k, _shape(box)) for n, k in plan.bands.items()}, box, rim, until, before)
                sent = [{"ty": ty + dy, "tx": tx + dx, "dy": -dy, "dx": -dx, "data": said.get((dy, dx), b"")} for dy, dx in AROUND if 0 <= ty + dy < ny and 0 <= tx + dx < nx]
                made = _row(ty, tx, found, out)
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array([sent], arrow_sent)], [*made.schema.names, "sent"])

        return tasks

    def first_change(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = [earliest(row["was"], row["data"]) for row in _rows(batches)]
        if times:
            level, wave = min(times)
            yield pa.RecordBatch.from_arrays([pa.array([level], pa.float64()), pa.array([wave], pa.int32())], ["level", "wave"])

    _tune(blocks.frame)
    way = [*KEY, "dy", "dx"]
    was = [F.lit(None).cast("binary").alias(f"was_{n}") for n in out.bands]
    source, said, latest, until = blocks.frame.select(*KEY, *own, *was, F.lit(None).cast(rims).alias("rim")), None, None, None
    fewest = float("inf")
    for k in range(1, most_rounds):
        made = held(Blocks(source.mapInArrow(run(until), schema), blocks.size, blocks.tile, bands), "relaxed").frame
        # each tile as it ran last
        results = made.drop("sent")
        latest = results if latest is None else latest.join(made.select(*KEY), KEY, "left_anti").unionByName(results)
        if k % PATIENCE == 0:
            latest = held(replace(out, frame=latest), "latest").frame
        now = made.select(F.explode("sent").alias("s")).select("s.*")
        if said is None:
            said = now.withColumns({"was": F.lit(b""), "new": F.length("data") > 0})
        else:  # a message for each pair of neighbours, with the one before and whether it is new
            both = said.drop("was", "new").withColumnRenamed("data", "was").join(now, way, "left")
            new = F.coalesce(F.col("data") != F.col("was"), F.lit(False))
            said = both.select(*way, F.coalesce("data", "was").alias("data"), "was", (new if until is None else F.length(F.coalesce("data", "was")) > 0).alias("new"))
            said = held(Blocks(said, blocks.size, blocks.tile, {}), "said").frame
        news = said.where("new")
        n = news.count()
        if not n:
            break
        due = news.select(*KEY).distinct()
        check = until is None and earliest and k % PATIENCE == 0
        stuck, fewest = check and n >= fewest, min(fewest, n) if check else fewest
        if stuck:
            fewest = float("inf")
            until = min((tuple(t) for t in news.select("was", "data").mapInArrow(first_change, "level double, wave int").groupBy().agg(F.min(F.struct("level", "wave")).alias("t")).select("t.*").collect()))
            due = said.where(F.length("data") > 0).select(*KEY).distinct()
        else:
            until = None
        again = said.join(due, KEY, "left_semi").groupBy(*KEY).agg(F.collect_list(F.struct("dy", "dx", "data")).alias("rim"))
        source = blocks.frame.join(again, KEY).join(latest.select(*KEY, *(F.col(n).alias(f"was_{n}") for n in out.bands)), KEY)
    else:
        raise RuntimeError(f"tiles did not settle in {most_rounds} rounds")
    return replace(out, frame=latest)


def rising(seed: Callable[[np.ndarray], np.ndarray], band: str, side: int = 3) -> Step:
    """The step of ``reconstructed``: what a neighbour sees of a tile's border is seed and limit at once."""
    r = side // 2
    least = np.iinfo(np.int64).min

    def strip(dy: int, dx: int, shape: tuple[int, int]) -> tuple[slice, slice]:
        """What a neighbour in a direction sees of a tile of ``shape``."""
        return tuple(slice(None) if not d else slice(0, min(r, n)) if d < 0 else slice(max(0, n - r), n) for d, n in zip((dy, dx), shape, strict=True))

    def around(dy: int, dx: int, shape: tuple[int, int], there: tuple[int, int]) -> tuple[slice, slice]:
        """Where a neighbour's strip of shape ``there`` lies around a tile of ``shape``, r pixels wide on every side."""
        return tuple(slice(r, r + n) if not d else slice(r - m, r) if d < 0 else slice(r + n, r + n + m) for d, n, m in zip((dy, dx), shape, there, strict=True))

    def step(arrays: dict[str, np.ndarray], box: Box, rim: Rim, until: Time | None = None, before: dict[str, np.ndarray] | None = None) -> tuple[dict[str, np.ndarray], Rim]:
        image = arrays[band].astype(np.int64)
        shape = image.shape
        # messages only rise, so that what was found holds, and more where they have
        low, limit = (np.pad(a, r, constant_values=least) for a in (seed(image) if before is None else before["low"], image))
        for (dy, dx), data in rim.items():
            n = np.frombuffer(data[:8], "<i4")
            said = unpack(data[8:], "<i8", tuple(n))
            at = around(dy, dx, shape, said.shape)
            low[at] = limit[at] = said
        rose = None
        if before is not None:
            rose = np.ones(low.shape, bool)
            rose[r : r + shape[0], r : r + shape[1]] = False
        now = kernels.reconstruct(low, limit, side, rose)[r : r + shape[0], r : r + shape[1]]
        said = {}
        for dy, dx in AROUND:
            cut = now[strip(dy, dx, shape)]
            said[dy, dx] = np.array(cut.shape, "<i4").tobytes() + pack(cut, "<i8")
        return {**arrays, "low": now}, said

    return step


def reconstructed(blocks: Blocks, seed: Callable[[np.ndarray], np.ndarray], band: str, side: int = 3) -> Blocks:
    """Grey reconstruction by dilation under ``band`` from ``seed(band)``, over square windows; band ``low`` beside the others.

    Integers. Equal to ``kernels.reconstruct`` of the whole image, for any tile not smaller than the window's reach.
    """
    r = side // 2
    if r > blocks.tile:
        raise ValueError("a window reaches beyond the next tile")
    return relaxed(blocks, rising(seed, band, side), {**blocks.bands, "low": "<i8"})


def _events(data: bytes) -> np.ndarray:
    """A border as it was said: the number of its pixels, then a record for each."""
    n = int.from_bytes(data[:4], "little")
    return unpack(data[4:], kernels.EVENT, (n, 1))[:, 0]


def first_difference(old: bytes, new: bytes) -> Time:
    """The time of the first event that one of two messages of a border has and the other hasn't."""
    both = [_events(m) for m in (old, new) if m]
    if len(both) == 2:
        differs = both[0] != both[1]
        both = [m[differs] for m in both]
    events = np.concatenate([m[m["label"] > 0] for m in both])
    # markers, of wave -1, are there before all
    return min((((-np.inf if w < 0 else v), w) for v, w in zip(events["level"].tolist(), events["wave"].tolist(), strict=True)), default=(np.inf, 0))


def flooding(surface: str = "v", markers: str = "label", mask: str | None = None, line: bool = True) -> Step:
    """The step of ``flooded``: borders say when each pixel was flooded, and with which label. Bands level and wave are kept for the
    next run."""
    sides = {(-1, 0): np.s_[0, :], (1, 0): np.s_[-1, :], (0, -1): np.s_[:, 0], (0, 1): np.s_[:, -1]}

    def step(arrays: dict[str, np.ndarray], box: Box, rim: Rim, until: Time | None = None, before: dict[str, np.ndarray] | None = None) -> tuple[dict[str, np.ndarray], Rim]:
        heard = {side: _events(data).copy() for side, data in rim.items()}
        if until is not None:
            for edge in heard.values():
                late = (edge["wave"] >= 0) & ((edge["level"] > until[0]) | ((edge["level"] == until[0]) & (edge["wave"] >= until[1])))
                edge[late] = 0
        last = None
        if before is not None:
            last = np.empty(_shape(box), kernels.EVENT)
            for name, band in (("level", "level"), ("wave", "wave"), ("label", markers)):
                last[name] = before[band]
        found = kernels.flood_open(arrays[surface], arrays[markers].astype(np.int64), heard, None if mask is None else arrays[mask].astype(bool), line, last)
        said = {}
        for side, at in sides.items():
            edge = found[at]
            said[side] = len(edge).to_bytes(4, "little") + pack(edge, kernels.EVENT) if edge["label"].any() else b""
        return {**{n: a for n, a in arrays.items() if n != markers}, markers: found["label"], "level": found["level"], "wave": found["wave"]}, said

    return step


def flooded(blocks: Blocks, surface: str = "v", markers: str = "label", mask: str | None = None, line: bool = True) -> Blocks:
    """Marker-controlled watershed of the whole image, as ``kernels.flood`` does it, for any tile; band ``markers`` becomes the basins,
    and surface and mask are left out.

    A tile's border pixels tell their neighbours when they were flooded, as level and wave, and with which label. As a pixel
    depends on what came before it only, tiles that run until no border says anything new have flooded in the one right order.
    """
    rest = {n: k for n, k in blocks.bands.items() if n not in (surface, markers, mask)}
    found = relaxed(blocks, flooding(surface, markers, mask, line), {**rest, markers: "<i8", "level": "<f8", "wave": "<i4"}, first_difference)
    return Blocks(found.frame.drop("level", "wave"), found.size, found.tile, {**rest, markers: "<i8"})


# -- distances ----------------------------------------------------------------------------------------

#: Pixels of the rows that one task takes across the image.
ACROSS = 1 << 21
NEVER = 10**8


def squared_distances(blocks: Blocks, band: str) -> Blocks:
    """Band d2: the exact squared distance of each pixel to the nearest one where ``band`` isn't 0, as ``kernels.squared_distances``.

    Columns first: a tile tells its first and last member of each column, and hears the last above it and the first below, so that no
    task has whole columns. Then rows, some at a time and as wide as the image, take the least of their columns' distances
    plus the squared step.
    """
    plan, (h, w) = picked(blocks, band).plan, blocks.size
    far = 4 * (h + w) ** 2

    def ends(arrays: dict[str, np.ndarray], box: Box) -> dict[str, np.ndarray]:
        on, y = arrays[band] != 0, np.arange(box[0], box[1])[:, None]
        return {"ends": np.stack([np.where(on, y, -NEVER).max(axis=0), np.where(on, y, NEVER).min(axis=0)])}

    def tell(key: tuple, parts: pa.Table) -> pa.Table:
        tx = key[0].as_py()
        rows = sorted((r["ty"], r["ends"]) for r in parts.to_pylist())
        found = np.stack([unpack(e, "<i8", (2, min(plan.tile, w - tx * plan.tile))) for _, e in rows])
        heard = np.empty_like(found)
        heard[0, 0], heard[-1, 1] = -NEVER, NEVER
        heard[1:, 0] = np.maximum.accumulate(found[:-1, 0], axis=0)
        heard[:-1, 1] = np.minimum.accumulate(found[:0:-1, 1], axis=0)[::-1]
        return pa.table({"ty": pa.array([ty for ty, _ in rows], pa.int32()), "tx": pa.array([tx] * len(rows), pa.int32()), "told": pa.array([pack(a, "<i8") for a in heard], pa.binary())})

    def down(arrays: dict[str, np.ndarray], box: Box, told: bytes) -> dict[str, np.ndarray]:
        on, y = arrays[band] != 0, np.arange(box[0], box[1])[:, None]
        above, below = unpack(told, "<i8", (2, box[3] - box[2]))
        last = np.maximum(np.maximum.accumulate(np.where(on, y, -NEVER), axis=0), above)
        following = np.minimum(np.minimum.accumulate(np.where(on, y, NEVER)[::-1], axis=0)[::-1], below)
        return {"g": np.minimum(np.minimum(y - last, following - y) ** 2, far)}

    told = mapped(picked(blocks, band), ends, {"ends": "<i8"}).frame.groupBy("tx").applyInArrow(tell, "ty int, tx int, told binary")
    columns = mapped(picked(blocks, band), down, {"g": "<i8"}, told)
    step = min(plan.tile, max(1, ACROSS // max(w, 1)))
    part = "ty int, tx int, part int, data binary"

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            g = unpack(row["g"], "<i8", _shape(plan.box(row["ty"], row["tx"])))
            data = [pack(g[k : k + step], "<i8") for k in range(0, len(g), step)]
            yield _parts([row["ty"]] * len(data), [row["tx"]] * len(data), range(len(data)), data)

    def _parts(ty: Iterable[int], tx: Iterable[int], part: Iterable[int], data: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32()) for c in (ty, tx, part)] + [pa.array(data, pa.binary())], ["ty", "tx", "part", "data"])

    def across(key: tuple, parts: pa.Table) -> pa.Table:
        ty, k = (v.as_py() for v in key)
        rows = parts.to_pylist()
        boxes = [plan.box(ty, r["tx"]) for r in rows]
        n = min(step, _shape(boxes[0])[0] - k * step)
        g = np.empty((n, w), np.int64)
        for r, b in zip(rows, boxes, strict=True):
            g[:, b[2] : b[3]] = unpack(r["data"], "<i8", (n, b[3] - b[2]))
        d2 = kernels.row_minima(g)
        return pa.Table.from_batches([_parts([ty] * len(rows), [r["tx"] for r in rows], [k] * len(rows), [pack(d2[:, b[2] : b[3]], "<i8") for b in boxes])])

    def whole(key: tuple, parts: pa.Table) -> pa.Table:
        ty, tx = (v.as_py() for v in key)
        width = min(plan.tile, w - tx * plan.tile)
        height = min(plan.tile, h - ty * plan.tile)
        rows = sorted((r["part"], r["data"]) for r in parts.to_pylist())
        d2 = np.concatenate([unpack(data, "<i8", (min(step, height - k * step), width)) for k, data in rows])
        return pa.Table.from_batches([_row(ty, tx, {"d2": d2}, out)])

    out = Blocks(None, blocks.size, blocks.tile, {"d2": "<i8"})
    n = tiles.tasks(blocks.frame.sparkSession, blocks.size, blocks.tile)
    strips = columns.frame.mapInArrow(cut, part).repartition(n, "ty", "part").groupBy("ty", "part").applyInArrow(across, part)
    return replace(out, frame=strips.repartition(n, *KEY).groupBy(*KEY).applyInArrow(whole, out.schema()))


# -- objects ------------------------------------------------------------------------------------------


def joined(one: Blocks, other: Blocks) -> Blocks:
    """The bands of two tilings of the same image in one. Tiles hold whole images, so that neither side is ever broadcast."""
    if (one.size, one.tile) != (other.size, other.tile):
        raise ValueError("the tiles differ")
    return Blocks(one.frame.join(other.frame.hint("merge"), KEY), one.size, one.tile, {**one.bands, **other.bands})


def measured(blocks: Blocks, label: str = "label", value: str | None = None) -> DataFrame:
    """(ty, tx, label, area, total, first): what each tile has of each object, ``first`` being its least linear index."""
    plan = blocks.plan

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            box = plan.box(row["ty"], row["tx"])
            at = np.flatnonzero(labels := unpack(row[label], plan.bands[label], _shape(box)))
            names, first, which = np.unique(labels.ravel()[at], return_index=True, return_inverse=True)
            y, x = np.divmod(at[first], _shape(box)[1])
            total = np.zeros(len(names), np.int64)
            if value:
                np.add.at(total, which, unpack(row[value], plan.bands[value], _shape(box)).ravel()[at].astype(np.int64))
            columns = [np.full(len(names), row["ty"], np.int32), np.full(len(names), row["tx"], np.int32), names.astype(np.int64), np.bincount(which, minlength=len(names)), total, (y + box[0]).astype(np.int64) * plan.size[1] + x + box[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*KEY, "label", "area", "total", "first"])

    return blocks.frame.select(*KEY, *filter(None, (label, value))).mapInArrow(run, "ty int, tx int, label long, area long, total long, first long")


def listed(blocks: Blocks, kernel: Callable[[dict[str, np.ndarray], Box], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """(ty, tx, ...): the rows that ``kernel(arrays, box)`` makes of each tile, as columns of equal length."""
    plan = blocks.plan

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            box = plan.box(row["ty"], row["tx"])
            columns = kernel({n: unpack(row[n], k, _shape(box)) for n, k in plan.bands.items()}, box)
            n = len(next(iter(columns.values())))
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in ({k: np.full(n, row[k], np.int32) for k in KEY} | columns).items()})

    _tune(blocks.frame)
    return blocks.frame.select(*KEY, *plan.bands).mapInArrow(run, f"ty int, tx int, {schema}")


def renamed(blocks: Blocks, parts: DataFrame, names: DataFrame, label: str = "label", also: str | None = None) -> DataFrame:
    """(y, x, label) with the labels that ``names(label, number)`` has, by their numbers; ``parts`` says which tiles have which labels.
    ``also`` is a band of booleans that becomes a column."""
    plan, more = blocks.plan, [also] if also else []
    theirs = parts.select(*KEY, "label").join(names, "label").groupBy(*KEY).agg(F.collect_list(F.struct("label", "number")).alias("names"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                box = plan.box(batch["ty"][i].as_py(), batch["tx"][i].as_py())
                labels = unpack(batch[label][i].as_py(), plan.bands[label], _shape(box))
                pairs = batch["names"][i].values
                old, new = (pairs.field(n).to_numpy() for n in ("label", "number"))
                order = np.argsort(old)
                old, new = old[order], new[order]
                y, x = np.nonzero(labels)
                at = np.minimum(np.searchsorted(old, labels[y, x]), len(old) - 1)
                on = old[at] == labels[y, x]
                rest = [unpack(batch[n][i].as_py(), plan.bands[n], _shape(box))[y, x][on] for n in more]
                y, x, number = (y + box[0]).astype(np.int32)[on], (x + box[2]).astype(np.int32)[on], new[at][on]
                for k in range(0, len(y), 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(a[k : k + (1 << 18)]) for a in (y, x, number, *rest)], ["y", "x", "label", *more])

    found = blocks.frame.select(*KEY, label, *more).join(theirs.hint("merge"), KEY)  # tiles hold whole images
    return found.mapInArrow(run, "y int, x int, label long" + "".join(f", {n} boolean" for n in more))
