"""Connected components of masks, over tiles.

Each tile labels its own pixels by its components' least linear index, so that a label says where it is. Pixels
on a tile's last row or column meet their neighbours across the seam; those meetings are edges between local
labels, far fewer than pixels. Edges contract round by round until none is left, and a look-up brings the
result back to the pixels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, kernels, regions, tiles
from .frames import YX, join_pixels

TILE = 1024


def _local(connectivity: int, width: int):
    def kernel(rows: pd.DataFrame) -> pd.DataFrame:
        y, x = rows.y.to_numpy(), rows.x.to_numpy()
        y0, x0 = int(y.min()), int(x.min())
        mask = np.zeros((int(y.max()) - y0 + 1, int(x.max()) - x0 + 1), bool)
        mask[y - y0, x - x0] = True
        label = kernels.components(mask, connectivity)[y - y0, x - x0]
        at = y.astype(np.int64) * width + x
        least = np.full(label.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, label, at)
        return pd.DataFrame({"y": y, "x": x, "local": least[label]})

    return kernel


def _written(df: DataFrame, path: str) -> DataFrame:
    """Written and read again. A checkpoint keeps what Spark has inferred of the columns, and from round to round that grows until
    planning hardly ends."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _kept(df: DataFrame) -> DataFrame:
    from ..sources.store import scratch

    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        return _written(df, scratch(df.sparkSession, "kept"))
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def contract(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``edges(a, b)`` to (node, root), root being the least of its component; nodes without edges don't appear."""
    keep = _kept

    def tidy(e: DataFrame) -> DataFrame:
        return keep(e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    edges, roots = tidy(edges), None
    for _ in range(most_rounds):
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("up"))
        up = keep(up)
        jump = keep(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "left").select("node", F.least("up", F.coalesce("top", "up")).alias("up")))
        edges = tidy(edges.join(jump.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(jump.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b").select(F.col("ua").alias("a"), F.col("ub").alias("b")))
        roots = jump.select("node", F.col("up").alias("root")) if roots is None else keep(roots.join(jump.select(F.col("node").alias("root"), F.col("up").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root")))
    else:
        raise RuntimeError("components did not settle")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _across(rim: DataFrame, connectivity: int) -> DataFrame:
    """(node, root) of the tiles' labels ``rim(y, x, local)`` that meet at seams."""
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if connectivity == 2 else [])
    sent = rim.withColumn("o", F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in steps])))
    sent = sent.select((F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), F.col("local").alias("a"))
    return contract(join_pixels(sent, rim.select(*YX, F.col("local").alias("b"))).select("a", "b"))


def label(mask: DataFrame, width: int, connectivity: int = 1, tile: int = TILE) -> DataFrame:
    """(y, x, label): each member's component, named by its least ``y * width + x``. ``width`` is the image's."""
    placed = tiles.tile_of(mask.select(*YX).distinct(), tile)
    local = placed.groupBy("ty", "tx").applyInPandas(_local(connectivity, width), "y int, x int, local bigint")
    local = _kept(local)
    spread = local.agg(*[f(F.floor(F.col(a) / tile)).alias(f"{n}_{a}") for a in YX for n, f in (("low", F.min), ("high", F.max))]).first()
    if all(spread[f"low_{a}"] == spread[f"high_{a}"] for a in YX):  # one tile or none: no seam
        return local.select(*YX, F.col("local").alias("label"))
    # pixels beside a seam, on both of its sides, meet by place
    rim = local.where((F.col("y") % tile == 0) | (F.col("y") % tile == tile - 1) | (F.col("x") % tile == 0) | (F.col("x") % tile == tile - 1))
    roots = _across(rim, connectivity)
    return local.join(roots.withColumnRenamed("node", "local").hint("shuffle_hash"), "local", "left").select(*YX, F.coalesce("root", "local").alias("label"))


def relabelled(mask: DataFrame, width: int, connectivity: int = 1, tile: int = TILE) -> DataFrame:
    """Components numbered 1, 2, ... in the order of their first pixel by rows; numbers are found on the objects."""
    found = label(mask, width, connectivity, tile)
    return regions.relabel(found, regions.numbered(found.select("label")))


def pieces(on: np.ndarray, box: blocks.Box, width: int, connectivity: int = 1) -> np.ndarray:
    """A tile's components, each named by its least ``y * width + x``, and one more so that 0 is none."""
    local = kernels.components(on, connectivity)
    at = np.flatnonzero(local)[::-1]
    first = np.zeros(local.max(initial=0) + 1, np.int64)
    first[local.ravel()[at]] = at  # the last that is written is the least
    y, x = np.divmod(first, max(on.shape[1], 1))
    return np.where(on, ((y + box[0]) * width + x + box[2] + 1)[local], 0)


def pieces_across(found: blocks.Blocks, band: str, connectivity: int = 1) -> DataFrame | None:
    """(node, root) of the ``pieces`` in a band of tiles: those that meet at seams; only the tiles' outermost pixels become rows."""
    if found.grid[0] * found.grid[1] <= 1:
        return None

    def rim(arrays: dict[str, np.ndarray], box: blocks.Box) -> dict[str, np.ndarray]:
        outer = np.zeros(arrays[band].shape, bool)
        outer[[0, -1]] = outer[:, [0, -1]] = True
        y, x = np.nonzero(outer & (arrays[band] != 0))
        return {"y": (y + box[0]).astype(np.int32), "x": (x + box[2]).astype(np.int32), "local": arrays[band][y, x]}

    # both sides of the join read the rim
    return _across(_kept(blocks.listed(found, rim, "y int, x int, local bigint")), connectivity)


def joined_up(found: blocks.Blocks, band: str, connectivity: int = 1) -> blocks.Blocks:
    """``pieces`` in a band of tiles, those that meet at seams with one name: the components of the whole image."""
    roots = pieces_across(found, band, connectivity)
    if roots is None:
        return found
    theirs = blocks.listed(blocks.picked(found, band), lambda arrays, box: {"node": np.unique(arrays[band][arrays[band] != 0])}, "node bigint")
    names = theirs.join(roots.where("node <> root"), "node").groupBy(*blocks.KEY).agg(F.collect_list(F.struct("node", "root")).alias("told"))

    def rename(arrays: dict[str, np.ndarray], box: blocks.Box, told: list[dict] | None) -> dict[str, np.ndarray]:
        if not told:
            return arrays
        old, new = np.array(sorted((r["node"], r["root"]) for r in told)).T
        at = np.minimum(np.searchsorted(old, arrays[band]), len(old) - 1)
        return {**arrays, band: np.where(old[at] == arrays[band], new[at], arrays[band])}

    return blocks.mapped(found, rename, found.bands, names)
