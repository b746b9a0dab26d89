"""Neighbourhood operators as scatter and sum, or on tiles.

For sums each pixel sends its weighted value to the pixels that see it, and these add up what arrives. That is one
explode and one hash aggregate for each axis, whose map-side part already merges what neighbours in a
partition send; sparse images cost only what they hold. Kernels are integers in fixed point, so sums don't
depend on their order. Where a pixel sees a whole disk - erosion, the nearest label, boundaries - the pixels themselves go to
tiles, once and a few at the seams twice, as a row for each place of the disk would be many times the image.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, tiles
from .frames import YX, join_pixels

FIXED = 1 << 16


def gaussian_weights(sigma: float, order: int = 0, truncate: float = 4.0) -> list[int]:
    """Fixed-point weights, radius int(truncate * sigma + 0.5); order 2 is the second derivative's kernel."""
    r = int(truncate * sigma + 0.5)
    g = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    total = sum(g)
    if order == 2:
        return [round(w / total * (k * k / sigma**4 - 1 / sigma**2) * FIXED) for k, w in zip(range(-r, r + 1), g, strict=True)]
    return [round(w / total * FIXED) for w in g]


def convolve(px: DataFrame, weights: list[int], axis: str, length: int, edge: str = "reflect") -> DataFrame:
    """Weighted sums along an axis; beyond the image, ``reflect`` repeats it mirrored, ``nearest`` its last pixel,
    ``constant`` sees zeros. All columns but v are keys."""
    r = len(weights) // 2
    if r > length and edge == "reflect":
        raise ValueError("the kernel reaches beyond the mirrored image")
    keys = [c for c in px.columns if c not in (axis, "v")]
    at = F.col(axis).cast("int")
    places = [F.array(at)]
    if edge == "reflect":
        places += [F.when(at < r, F.array(-1 - at)), F.when(at >= length - r, F.array(2 * length - 1 - at))]
    elif edge == "nearest":
        places += [F.when(at == 0, F.sequence(F.lit(-r), F.lit(-1))), F.when(at == length - 1, F.sequence(F.lit(length), F.lit(length + r - 1)))]
    elif edge != "constant":
        raise ValueError(f"unknown edge {edge}")
    none = F.array().cast("array<int>")
    seen = px.withColumn("p", F.explode(F.concat(*[F.coalesce(p, none) for p in places]))) if r else px.withColumn("p", at)
    seen = seen.withColumn("t", F.explode(F.sequence(F.greatest(F.col("p") - r, F.lit(0)), F.least(F.col("p") + r, F.lit(length - 1)))))
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("p") - F.col("t") + r + 1).cast("int"))
    return seen.groupBy(*keys, F.col("t").alias(axis)).agg(F.sum(F.col("v") * weight).alias("v"))


def separable(px: DataFrame, wy: list[int], wx: list[int], size: tuple[int, int], edge: str = "reflect") -> DataFrame:
    return convolve(convolve(px, wx, "x", size[1], edge), wy, "y", size[0], edge)


def gaussian(px: DataFrame, sigma: float, size: tuple[int, int], edge: str = "reflect", truncate: float = 4.0) -> tuple[DataFrame, int]:
    """Smoothed image as integers, and the number that divides them; sigma 0 leaves the image as it is."""
    if sigma == 0:
        return px, 1
    w = gaussian_weights(sigma, truncate=truncate)
    return separable(px, w, w, size, edge), sum(w) ** 2


def laplacian_of_gaussian(px: DataFrame, sigma: float, size: tuple[int, int]) -> DataFrame:
    """The negated Laplacian of Gaussian as integers, in units of FIXED squared."""
    g, d = gaussian_weights(sigma), gaussian_weights(sigma, 2)
    both = separable(px, d, g, size).unionByName(separable(px, g, d, size))
    return both.groupBy(*[c for c in px.columns if c != "v"]).agg((-F.sum("v")).alias("v"))


def sum3(px: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Sums over 3 x 3 windows with mirrored edges: nine times the mean."""
    return separable(px, [1, 1, 1], [1, 1, 1], size)


def deviation3(px: DataFrame, size: tuple[int, int]) -> DataFrame:
    """(y, x, s1, s2, v): sums, sums of squares, and the unbiased standard deviation over 3 x 3 windows."""
    s1 = sum3(px, size).withColumnRenamed("v", "s1")
    s2 = sum3(px.withColumn("v", F.col("v") * F.col("v")), size).withColumnRenamed("v", "s2")
    spread = 9 * F.col("s2") - F.col("s1") * F.col("s1")
    return join_pixels(s1, s2).withColumn("v", F.sqrt(F.greatest(spread, F.lit(0)) / 72.0))


def _ball(offsets: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets]))


def disk(radius: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]


def square(side: int) -> list[tuple[int, int]]:
    r = side // 2
    return [(dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1)]


def scatter(px: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Every row sent to its place plus each offset; dy and dx stay as columns, y and x are the receiver's."""
    sent = px.withColumn("o", _ball(offsets))
    rest = [c for c in px.columns if c not in YX]
    return sent.select((F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), *rest, F.col("o.dy").alias("dy"), F.col("o.dx").alias("dx"))


def inside(px: DataFrame, size: tuple[int, int]) -> DataFrame:
    return px.where((F.col("y") >= 0) & (F.col("y") < size[0]) & (F.col("x") >= 0) & (F.col("x") < size[1]))


def local_maxima(px: DataFrame, size: tuple[int, int], side: int = 3, border: int = 1, above: float | None = None) -> DataFrame:
    """Pixels not below any in their window, plateaus whole, away from a border of ``border``, and above ``above``
    (None: above the least pixel)."""
    middle = (F.col("dy") == 0) & (F.col("dx") == 0)
    seen = scatter(px, square(side)).groupBy(*YX).agg(F.max("v").alias("top"), F.max(F.when(middle, F.col("v"))).alias("v"))
    peaks = seen.where(F.col("v") == F.col("top")).select(*YX, "v")
    peaks = peaks.where((F.col("y") >= border) & (F.col("y") < size[0] - border) & (F.col("x") >= border) & (F.col("x") < size[1] - border))
    if above is not None:
        return peaks.where(F.col("v") > above)
    least = px.agg(F.min("v").alias("least"))
    return peaks.join(F.broadcast(least)).where(F.col("v") > F.col("least")).drop("least")  # one row


def _seen(array: np.ndarray, dy: int, dx: int, reach: int) -> np.ndarray:
    """What each place of a tile sees at an offset, in an array with ``reach`` more on every side."""
    h, w = (n - 2 * reach for n in array.shape)
    return array[reach + dy : reach + dy + h, reach + dx : reach + dx + w]


def erode(mask: DataFrame, radius: int) -> DataFrame:
    """Members whose whole disk is in the mask; places beyond the image are not."""
    offsets = disk(radius)

    def kernel(label: np.ndarray, on: np.ndarray, place: tuple[int, int]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        kept = _seen(on, 0, 0, radius).copy()
        for dy, dx in offsets:
            kept &= _seen(on, dy, dx, radius)
        return kept, {}

    return tiles.near(mask.select(*YX, F.lit(0).alias("label")), radius, kernel, "y int, x int")


def dilate(mask: DataFrame, radius: int, size: tuple[int, int]) -> DataFrame:
    return inside(scatter(mask.select(*YX), disk(radius)).select(*YX).distinct(), size)


def outer_boundary(labels: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Background pixels beside an object, and object pixels that touch another object.

    Beside is across an edge; an object pixel needs an unlike pixel across an edge and another object's within
    its 3 x 3 window.
    """

    def kernel(label: np.ndarray, on: np.ndarray, place: tuple[int, int]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        own, mine = _seen(label, 0, 0, 1), _seen(on, 0, 0, 1)
        beside, unlike, touches = np.zeros(own.shape, np.int8), np.zeros(own.shape, bool), np.zeros(own.shape, bool)
        for dy, dx in square(3):
            other = _seen(on, dy, dx, 1) & (_seen(label, dy, dx, 1) != own)
            touches |= other
            if abs(dy) + abs(dx) == 1:
                beside += _seen(on, dy, dx, 1)
                unlike |= other
        y, x = (np.arange(n) + first for n, first in zip(own.shape, place, strict=True))
        places = 4 - ((y == 0) * 1 + (y == size[0] - 1))[:, None] - ((x == 0) * 1 + (x == size[1] - 1))
        return np.where(mine, (unlike | (beside < places)) & touches, beside > 0), {}

    return tiles.near(labels, 1, kernel, "y int, x int", size)


def _nearest(radius: int) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The kernel that finds a tile's places within ``radius`` of a pixel, the nearest label there, and its squared distance."""
    least = np.iinfo(np.int64).max
    steps: dict[int, list[tuple[int, int]]] = {}
    for dy, dx in disk(radius):
        steps.setdefault(dy * dy + dx * dx, []).append((dy, dx))

    def kernel(label: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        label = np.where(on, label, least)
        best, found = _seen(label, 0, 0, radius).copy(), _seen(on, 0, 0, radius).copy()
        near = np.zeros(best.shape, np.int32)
        for d2 in sorted(steps):
            low, any_ = np.full(best.shape, least), np.zeros(best.shape, bool)
            for dy, dx in steps[d2]:
                np.minimum(low, _seen(label, dy, dx, radius), out=low)
                any_ |= _seen(on, dy, dx, radius)
            any_ &= ~found
            best[any_], near[any_] = low[any_], d2
            found |= any_
        return found, best, near

    return kernel


def nearest_label(labels: DataFrame, radius: int, size: tuple[int, int]) -> DataFrame:
    """(y, x, label, d2) for every pixel within ``radius`` of a labelled one: the nearest label, the smaller of ties."""
    nearest = _nearest(radius)

    def kernel(label: np.ndarray, on: np.ndarray, place: tuple[int, int]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        found, best, near = nearest(label, on)
        return found, {"label": best, "d2": near}

    grown = tiles.near(labels, radius, kernel, "y int, x int, label bigint, d2 int", size)
    return grown.withColumn("label", F.col("label").cast(labels.schema["label"].dataType))


def expand_labels(labels: DataFrame, distance: int, size: tuple[int, int]) -> DataFrame:
    return nearest_label(labels, distance, size).select(*YX, "label")


def ring(labels: DataFrame, radius: int, size: tuple[int, int], tissue: DataFrame | None = None) -> DataFrame:
    """Labels with the background within ``radius`` given to the nearest; optionally only within a tissue mask."""
    grown = expand_labels(labels, radius, size)
    return grown if tissue is None else join_pixels(grown, tissue.select(*YX), "left_semi")


def ring_blocks(labels: DataFrame, radius: int, size: tuple[int, int], tile: int) -> blocks.Blocks:
    """``ring`` as array tiles: bands label, on (where there is one) and nucleus (where ``labels`` has a pixel)."""
    nearest = _nearest(radius)

    def kernel(label: np.ndarray, on: np.ndarray) -> dict[str, np.ndarray]:
        found, best, _ = nearest(label, on)
        return {"label": np.where(found, best, 0), "on": found, "nucleus": _seen(on, 0, 0, radius)}

    return blocks.near(labels, radius, kernel, size, {"label": "<i8", "on": "?", "nucleus": "?"}, tile)


def difference(one: DataFrame, other: DataFrame) -> DataFrame:
    """Pixels whose labels differ, with the label of the mask that has more pixels; equal counts: the first."""
    n = one.agg(F.count("*").alias("n1")).join(F.broadcast(other.agg(F.count("*").alias("n2"))))  # one row each
    both = join_pixels(one.select(*YX, F.col("label").alias("a")), other.select(*YX, F.col("label").alias("b")), "full_outer")
    label = F.when(F.col("n1") >= F.col("n2"), F.col("a")).otherwise(F.col("b"))
    return both.join(F.broadcast(n)).where(~F.col("a").eqNullSafe(F.col("b"))).select(*YX, label.alias("label")).where("label is not null")
