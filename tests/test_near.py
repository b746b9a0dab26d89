"""Operators that see a disk around each pixel, on tiles; held against brute force over seams."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import neighbourhood, tiles
from tessera.sources import fixtures


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(tiles.near, "__defaults__", (None, 7))


@pytest.fixture(scope="module")
def labels():
    rng = np.random.default_rng(3)
    return np.where(rng.random((23, 30)) > 0.93, rng.integers(1, 9, (23, 30)), 0)


def rows(spark, a, label=True):
    y, x = np.nonzero(a)
    return spark.createDataFrame(pd.DataFrame({"y": y.astype("int32"), "x": x.astype("int32")} | ({"label": a[y, x].astype("int64")} if label else {})))


def places(df):
    return {tuple(r) for r in df.collect()}


def rows_for_each_offset(df):
    """Whether the plan makes a row for each place of a disk."""
    return "dx" in df._jdf.queryExecution().toString()


def test_blobs_are_drawn_by_many_tasks(spark, tmp_path):
    n = 2 * fixtures.BLOBS + 1
    spark.range(n).selectExpr("id AS s_suppkey", "CAST(id % 25 AS INT) AS s_nationkey").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert fixtures.raster(spark, str(tmp_path), "blob_px").rdd.getNumPartitions() == 3


def test_nearest_label(spark, labels, small_tiles):
    px = rows(spark, labels)
    got = neighbourhood.nearest_label(px.union(px.limit(3)), 3, labels.shape)
    want = set()
    py, px_ = np.nonzero(labels)
    for y in range(labels.shape[0]):
        for x in range(labels.shape[1]):
            d2 = (py - y) ** 2 + (px_ - x) ** 2
            if d2.min() <= 9:
                want.add((y, x, min(labels[py, px_][d2 == d2.min()]), d2.min()))
    assert places(got) == want and got.count() == len(want)
    assert not rows_for_each_offset(got)


def test_boundary_with_repeated_pixels(spark, labels, small_tiles):
    px = rows(spark, labels)
    once = neighbourhood.outer_boundary(px, labels.shape)
    assert places(once) == places(neighbourhood.outer_boundary(px.union(px), labels.shape))
    p = np.pad(labels, 1, constant_values=-1)
    want = set()
    for y in range(labels.shape[0]):
        for x in range(labels.shape[1]):
            near = [v for v in (p[y, x + 1], p[y + 1, x], p[y + 1, x + 2], p[y + 2, x + 1]) if v >= 0]
            own, window = labels[y, x], p[y : y + 3, x : x + 3]
            if any(v != own for v in near) and (((window > 0) & (window != own)).any() if own else True):
                want.add((y, x))
    assert places(once) == want
    assert not rows_for_each_offset(once)


def test_erosion_with_repeated_pixels(spark, small_tiles):
    mask = np.random.default_rng(5).random((25, 25)) > 0.04
    want = {(y, x) for y in range(2, 23) for x in range(2, 23) if all(mask[y + a, x + b] for a, b in neighbourhood.disk(2))}
    px = rows(spark, mask, False)
    got = neighbourhood.erode(px.union(px), 2)
    assert places(got) == want and want
    assert not rows_for_each_offset(got)
    moved = neighbourhood.erode(px.selectExpr("y - 40 AS y", "x - 9 AS x"), 2)
    assert places(moved) == {(y - 40, x - 9) for y, x in want}
