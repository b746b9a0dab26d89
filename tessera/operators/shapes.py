"""Distances over whole images and shape measures of objects."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .frames import YX


#: Columns that one task takes down the image, and rows that one task takes across.
STRIP, BAND = 64, 64


def squared_distance(mask: DataFrame, size: tuple[int, int]) -> DataFrame:
    """(y, x, d2) for all pixels of the image: the exact squared distance to the nearest member; no rows without a member.

    Columns first: a task takes the members of a strip and finds each pixel's distance within its column. The strips'
    arrays, a binary value for each band of rows, meet by band, and there each row takes the least of its columns' distances
    plus the squared step, in as many operations as it is wide times a logarithm.
    """
    h, w = size
    far = 4 * (h + w) ** 2

    def down(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        inside = np.zeros((h, STRIP), bool)
        inside[rows.y, rows.x - key[0] * STRIP] = True
        g = kernels.column_distances(inside, far)
        bands = range(-(-h // BAND))
        return pd.DataFrame({"band": pd.Series(bands, dtype="int32"), "strip": np.int32(key[0]), "g": [g[k * BAND : (k + 1) * BAND].tobytes() for k in bands]})

    def across(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        y0 = int(key[0]) * BAND
        n = min(BAND, h - y0)
        g = np.full((n, -(-w // STRIP) * STRIP), far, np.int64)
        for strip, data in zip(parts.strip, parts.g, strict=True):
            g[:, strip * STRIP : (strip + 1) * STRIP] = np.frombuffer(data, np.int64).reshape(n, STRIP)
        d2 = kernels.row_minima(g[:, :w])
        return pd.DataFrame({"y": np.repeat(np.arange(y0, y0 + n, dtype=np.int32), w), "x": np.tile(np.arange(w, dtype=np.int32), n), "d2": d2.ravel()})

    strips = mask.select(*(F.col(k).cast("int").alias(k) for k in YX)).withColumn("s", F.floor(F.col("x") / STRIP).cast("int"))
    columns = strips.groupBy("s").applyInPandas(down, "band int, strip int, g binary")
    return columns.groupBy("band").applyInPandas(across, "y int, x int, d2 bigint")


def solidity(labels: DataFrame) -> DataFrame:
    """(label, area, hull, solidity): the share of its convex hull that an object fills.

    Only each row's first and last pixel can be a corner, so an object shrinks to two rows a line before it is gathered.
    """
    lines = labels.groupBy("label", "y").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count("*").alias("n"))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        y = np.concatenate([rows.y, rows.y])
        hull = kernels.hull_area(y, np.concatenate([rows.a, rows.b]))
        area = int(rows.n.sum())
        return pd.DataFrame({"label": [key[0]], "area": [area], "hull": [hull], "solidity": [area / hull]})

    return lines.groupBy("label").applyInPandas(one, "label bigint, area bigint, hull double, solidity double")
