"""Rasters as rows: selection, stacking, cropping, extents, masks.

An image is a frame of ``(y, x, v)``, with a channel column ``c`` where it has several. A mask is the set of
its ``(y, x)``; a label image adds ``label`` and leaves the background out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pixel

YX = ["y", "x"]


#: Pixels of an image that a task sorts to join them.
ROWS = 1 << 20


def join_pixels(one: DataFrame, other: DataFrame, how: str = "inner", size: tuple[int, int] | None = None) -> DataFrame:
    """Join by place. Pixels have no bound, so neither side is ever broadcast, however small it is thought to be.

    Partitions of whole images, measured by their shuffled bytes, would hold tens of millions of rows; with the image's ``size``
    there are as many partitions as it takes.
    """
    if size and size[0] * size[1] > ROWS:
        n = max(one.sparkSession.sparkContext.defaultParallelism, -(-size[0] * size[1] // ROWS))
        one, other = one.repartition(n, *YX), other.repartition(n, *YX)
    return one.join(other.hint("merge"), YX, how)


def channel(px: DataFrame, number: int, column: str = "c") -> DataFrame:
    """One channel by its 1-based number; the filter reaches the scan, and prunes where ``c`` partitions the store."""
    if number < 1:
        raise ValueError("channels are numbered from 1")
    return px.where(F.col(column) == number - 1)


def channels(px: DataFrame, numbers: list[int], column: str = "c") -> DataFrame:
    return px.where(F.col(column).isin([n - 1 for n in dict.fromkeys(numbers)]))


def level(px: DataFrame, number: int = 0) -> DataFrame:
    return px.where(F.col("level") == number)


def stack(*layers: DataFrame) -> DataFrame:
    """Layers as channels 0, 1, ... of one image."""
    numbered = [layer.select(F.lit(i).alias("c"), "y", "x", "v") for i, layer in enumerate(layers)]
    return reduce(DataFrame.unionByName, numbered)


def pair(center: DataFrame, contour: DataFrame) -> DataFrame:
    """Two one-channel files to the wide form (y, x, center, contour)."""
    return join_pixels(center.select(*YX, F.col("v").alias("center")), contour.select(*YX, F.col("v").alias("contour")))


def extent(px: DataFrame) -> DataFrame:
    """One row: y0, y1, x0, x1, ends exclusive."""
    return px.agg(F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))


def shape(px: DataFrame) -> tuple[int, int]:
    """Height and width, from the largest coordinates; a one-row aggregate."""
    r = px.agg(F.max("y").alias("y"), F.max("x").alias("x")).first()
    return (0, 0) if r["y"] is None else (int(r["y"]) + 1, int(r["x"]) + 1)


def crop(px: DataFrame, y0: int, x0: int, height: int, width: int, tile: int | None = None) -> DataFrame:
    """Rows in the rectangle. With ``tile``, the tile columns ty and tx are filtered too, so that a partitioned store is pruned."""
    out = px.where((F.col("y") >= y0) & (F.col("y") < y0 + height) & (F.col("x") >= x0) & (F.col("x") < x0 + width))
    if tile:
        out = out.where(F.col("ty").between(y0 // tile, (y0 + height - 1) // tile) & F.col("tx").between(x0 // tile, (x0 + width - 1) // tile))
    return out


def auto_rectangle(height: int, width: int) -> tuple[int, int, int, int]:
    """The middle third: offset and size are both a third, halves rounded to even."""
    h, w = round(height / 3), round(width / 3)
    return h, w, h, w


def shift(px: DataFrame, dy: int, dx: int) -> DataFrame:
    return px.withColumns({"y": F.col("y") + dy, "x": F.col("x") + dx})


def max_projection(px: DataFrame) -> DataFrame:
    return px.groupBy(*YX).agg(F.max("v").alias("v"))


def mask(px: DataFrame, condition: Column) -> DataFrame:
    return px.where(condition).select(*YX)


def union(*masks: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [m.select(*YX) for m in masks]).distinct()


def intersect(px: DataFrame, other: DataFrame) -> DataFrame:
    return join_pixels(px, other.select(*YX), "left_semi")


def subtract(px: DataFrame, other: DataFrame) -> DataFrame:
    return join_pixels(px, other.select(*YX), "left_anti")


def intensity_complement(px: DataFrame, bits: int | None = 8) -> DataFrame:
    """max(center) - center - contour over wide rows, with the wrap of an unsigned store of ``bits``; None: no wrap."""
    top = px.agg(F.max("center").alias("top"))
    v = F.col("top") - F.col("center") - F.col("contour")
    return px.join(F.broadcast(top)).select(*YX, (pixel.wrap(v, bits) if bits else v).cast("int").alias("v"))  # one row


def core_mask(px: DataFrame, share: float = 0.8) -> DataFrame:
    """Pixels brighter than a share of the brightest."""
    top = px.agg(F.max("v").alias("top"))
    return px.join(F.broadcast(top)).where(F.col("v") > F.col("top") * share).select(*YX)  # one row


def percentile_rescale(px: DataFrame, low: float = 0.0, high: float = 100.0, top: int = 255) -> DataFrame:
    """Linear rescale between two exact percentiles, clipped to 0..top."""
    ends = px.agg(F.percentile("v", low / 100).alias("lo"), F.percentile("v", high / 100).alias("hi"))
    return px.join(F.broadcast(ends)).select(*YX, pixel.clip_scale(F.col("v").cast("double"), F.col("lo"), F.col("hi"), top).alias("v"))  # one row


def percentile_normalise(px: DataFrame, low: float = 10.0, high: float = 99.99) -> DataFrame:
    """(v - p_low) / (p_high - p_low), unclipped."""
    ends = px.agg(F.percentile("v", low / 100).alias("lo"), F.percentile("v", high / 100).alias("hi"))
    return px.join(F.broadcast(ends)).select(*YX, ((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("v"))  # one row


def stride_half(px: DataFrame, times: int = 1) -> DataFrame:
    """Masks and labels at half the resolution: every other row and column."""
    for _ in range(times):
        px = px.where((F.col("y") % 2 == 0) & (F.col("x") % 2 == 0)).withColumns({"y": (F.col("y") / 2).cast("int"), "x": (F.col("x") / 2).cast("int")})
    return px


def mean_half(px: DataFrame, times: int = 1) -> DataFrame:
    """Images at half the resolution: means of 2 x 2 blocks, cut to integers; blocks over an odd edge are filled with zeros."""
    keys = [c for c in px.columns if c not in ("y", "x", "v")]
    for _ in range(times):
        px = px.groupBy(*keys, F.floor(F.col("y") / 2).cast("int").alias("y"), F.floor(F.col("x") / 2).cast("int").alias("x")).agg(F.floor(F.sum("v") / 4).cast("int").alias("v"))
    return px


def pyramid_plan(height: int, width: int, base: int = 1024) -> tuple[int, int, int]:
    """(levels below the full one, tile height, tile width); tiles are multiples of 16."""
    longest, levels = max(height, width), 0
    while longest > base << levels:
        levels += 1
    tile = [16 * -(-d // (16 << levels)) for d in (height, width)]
    return levels, tile[0], tile[1]


def pyramid(px: DataFrame, levels: int, is_mask: bool = False) -> DataFrame:
    """All levels in one frame, with a ``level`` column."""
    out, now = [], px
    for k in range(levels + 1):
        out.append(now.withColumn("level", F.lit(k)))
        now = stride_half(now) if is_mask else mean_half(now)
    return reduce(DataFrame.unionByName, out)


def resize_nearest(px: DataFrame, size: tuple[int, int], to: tuple[int, int]) -> DataFrame:
    """Nearest-neighbour resize: target t shows source floor((2t + 1) * old / (2 * new))."""
    for axis, old, new in zip(YX, size, to, strict=True):
        if old != new:
            first = F.floor((F.col(axis) * 2 * new - old) / (2 * old)).cast("int")
            spread = px.withColumn("t", F.explode(F.sequence(F.greatest(first - 1, F.lit(0)), F.least(first + -(-new // old) + 1, F.lit(new - 1)))))
            px = spread.where(F.floor((2 * F.col("t") + 1) * old / (2 * new)) == F.col(axis)).withColumn(axis, F.col("t")).drop("t")
    return px


def resize_linear(px: DataFrame, size: tuple[int, int], to: tuple[int, int]) -> DataFrame:
    """Bilinear resize: target t lies at (t + 0.5) * old / new - 0.5 between its two neighbours, edges repeated.

    To shrink without aliasing, smooth first with a sigma of (old / new - 1) / 2.
    """
    for axis, old, new in zip(YX, size, to, strict=True):
        ratio = old / new
        keys = [c for c in px.columns if c not in (axis, "v")]
        first = F.floor((F.col(axis) - 0.5) / ratio - 0.5).cast("int") - 1
        spread = px.withColumn("t", F.explode(F.sequence(F.greatest(first, F.lit(0)), F.least(F.ceil((F.col(axis) + 1.5) / ratio - 0.5).cast("int") + 1, F.lit(new - 1)))))
        at = F.least(F.greatest((F.col("t") + 0.5) * ratio - 0.5, F.lit(0.0)), F.lit(float(old - 1)))
        spread = spread.withColumn("w", 1 - F.abs(at - F.col(axis))).where("w > 0")
        px = spread.groupBy(*keys, F.col("t").alias(axis)).agg(F.sum(F.col("v") * F.col("w")).alias("v"))
    return px
