"""Tiles with a halo: each pixel goes to every tile whose halo holds it, a kernel sees one tile, and only its core is kept."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import YX

#: Side of a tile's core and width of its halo, as the whole-slide settings have them.
TILE, HALO = 1500, 250
#: Side of a tile for operators that see a few pixels around.
NEAR = 512
#: Rows of pixels that a task sorts by tile.
ROWS = 1 << 21


def tile_of(px: DataFrame, tile: int = TILE) -> DataFrame:
    """Add the tile's place, ty and tx; the partition columns of a tile store."""
    return px.withColumns({"ty": F.floor(F.col("y") / tile).cast("int"), "tx": F.floor(F.col("x") / tile).cast("int")})


def rechunk(px: DataFrame, tile: int = 2048) -> DataFrame:
    """One tile's pixels in one partition."""
    return tile_of(px, tile).repartition("ty", "tx")


def with_halo(px: DataFrame, tile: int = TILE, halo: int = HALO, size: tuple[int, int] | None = None) -> DataFrame:
    """Copies of pixels for each tile that sees them, with ty, tx and is_core. ``size`` drops tiles beyond the image."""
    for axis, name, k in (("y", "ty", 0), ("x", "tx", 1)):
        first, last = F.floor((F.col(axis) - halo) / tile), F.floor((F.col(axis) + halo) / tile)
        first = F.greatest(first, F.lit(0))
        if size is not None:
            last = F.least(last, F.lit((size[k] - 1) // tile))
        px = px.withColumn(name, F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    core = (F.floor(F.col("y") / tile) == F.col("ty")) & (F.floor(F.col("x") / tile) == F.col("tx"))
    return px.withColumn("is_core", core)


def core(px: DataFrame) -> DataFrame:
    return px.where("is_core").drop("ty", "tx", "is_core")


def tasks(spark: SparkSession, size: tuple[int, int], tile: int = TILE, halo: int = 0) -> int:
    """Partitions for an image's pixels by tile, so that one has about ``ROWS`` however large the image is.

    Rows of pixels compress so well that partitions measured by their shuffled bytes hold tens of millions, to be sorted.
    """
    n = tuple(-(-max(d, 1) // tile) for d in size)
    rows = n[0] * n[1] * (tile + 2 * halo) ** 2
    return max(min(rows // ROWS + 1, n[0] * n[1]), min(n[0] * n[1], spark.sparkContext.defaultParallelism))


def window_plan(size: tuple[int, int], block: int, overlap: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """(padded shape, number of windows) of overlapping windows whose cores cover an image."""
    step = block - overlap
    n = tuple(max(0, -(-(d + overlap - block) // step)) for d in size)
    return tuple(block + k * step for k in n), tuple(k + 1 for k in n)


def box(ty: int, tx: int, tile: int, halo: int, size: tuple[int, int]) -> tuple[int, int, int, int]:
    """(y0, y1, x0, x1) of a tile with its halo, clipped to the image."""
    return max(0, ty * tile - halo), min(size[0], (ty + 1) * tile + halo), max(0, tx * tile - halo), min(size[1], (tx + 1) * tile + halo)


def run(px: DataFrame, kernel: Callable[[pd.DataFrame, tuple[int, int, int, int]], pd.DataFrame], schema: str, size: tuple[int, int], tile: int = TILE, halo: int = HALO) -> DataFrame:
    """Run ``kernel(rows, (y0, y1, x0, x1))`` on each tile with its halo, clipped to the image; rows outside the core are dropped.

    A group is a tile: its memory is bounded by (tile + 2 halo) squared.
    """

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ty, tx = (int(k) for k in key)
        out = kernel(rows, box(ty, tx, tile, halo, size))
        return out[(out.y // tile == ty) & (out.x // tile == tx)]

    placed = with_halo(px, tile, halo, size).drop("is_core")
    return placed.repartition(tasks(px.sparkSession, size, tile, halo), "ty", "tx").groupBy("ty", "tx").applyInPandas(one, schema)


def dense(rows: pd.DataFrame, box: tuple[int, int, int, int], column: str = "v", fill: float = 0, dtype=np.int64) -> np.ndarray:
    out = np.full((box[1] - box[0], box[3] - box[2]), fill, dtype)
    out[rows.y.to_numpy() - box[0], rows.x.to_numpy() - box[2]] = rows[column].to_numpy()
    return out


def sparse(array: np.ndarray, box: tuple[int, int, int, int], name: str = "label") -> pd.DataFrame:
    y, x = np.nonzero(array)
    return pd.DataFrame({"y": (y + box[0]).astype(np.int32), "x": (x + box[2]).astype(np.int32), name: array[y, x]})


def around(px: DataFrame, reach: int, size: tuple[int, int] | None, tile: int) -> DataFrame:
    """(y, x, label, ty, tx): each pixel for the tiles that have it or see it within ``reach``; with ``size`` tiles of the image only."""
    placed = px.select(*(F.col(k).cast("int").alias(k) for k in YX), F.col("label").cast("bigint").alias("label")).where("label is not null")
    for axis, name, k in (("y", "ty", 0), ("x", "tx", 1)):
        first, last = F.floor((F.col(axis) - reach) / tile), F.floor((F.col(axis) + reach) / tile)
        if size is not None:
            placed = placed.where((F.col(axis) >= -reach) & (F.col(axis) < size[k] + reach))
            first, last = F.greatest(first, F.lit(0)), F.least(last, F.lit((size[k] - 1) // tile))
        placed = placed.withColumn(name, F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    return placed


def seen(rows: pa.Table, place: tuple[int, int], reach: int, size: tuple[int, int] | None, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Label and where there are pixels, of a tile with ``reach`` around it; of labels at the same place the smallest counts."""
    shape = tuple(tile if size is None else min(tile, size[k] - place[k]) for k in (0, 1))
    label, on = np.zeros([n + 2 * reach for n in shape], np.int64), np.zeros([n + 2 * reach for n in shape], bool)
    y, x, v = (rows[k].to_numpy() for k in (*YX, "label"))
    y, x = y - (place[0] - reach), x - (place[1] - reach)
    label[y, x], on[y, x] = v, True
    if np.count_nonzero(on) < len(v):
        order = np.argsort(v, kind="stable")[::-1]
        label[y[order], x[order]] = v[order]
    return label, on


def near(px: DataFrame, reach: int, kernel: Callable[..., tuple[np.ndarray, dict[str, np.ndarray]]], schema: str, size: tuple[int, int] | None = None, tile: int = NEAR) -> DataFrame:
    """``kernel(label, on, place)`` on each tile that has a pixel of ``px(y, x, label)`` or one within ``reach`` of it.

    ``label`` and ``on``, which says where there are pixels, have ``reach`` places more on every side than the tile; ``place`` is its first
    place. The kernel returns which of the tile's places have a row, and arrays of the columns beside y and x. ``size`` cuts tiles
    to the image, though pixels beyond it are seen. Of labels at the same place the smallest counts.
    """

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        place = tuple(int(k.as_py()) * tile for k in key)
        label, on = seen(rows, place, reach, size, tile)
        kept, columns = kernel(label, on, place)
        y, x = np.nonzero(kept)
        return pa.table({"y": (y + place[0]).astype(np.int32), "x": (x + place[1]).astype(np.int32), **{n: a[y, x] for n, a in columns.items()}})

    return around(px, reach, size, tile).groupBy("ty", "tx").applyInArrow(one, schema)


def tiled_views(px: DataFrame, tile: int, halo: int, size: tuple[int, int]) -> DataFrame:
    """Split with halo and put together again from the cores: the image itself."""
    return core(with_halo(px, tile, halo, size)).select(*YX, "v")
