"""Segmentation pipelines: tissue, nuclei, cytoplasm, puncta, areas, quality control, and the tiled chain for large rasters.

Each returns frames. Flooding and h-maxima run as array kernels over tiles with a halo, as their reach has no
bound in rows; everything else is relational. Labels are dense numbers in the order of first pixels.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pixel
from ..operators import blocks, components, frames, kernels, neighbourhood, regions, shapes, threshold, tiles
from ..operators.frames import YX, join_pixels
from .config import FLOODING, LOCAL, History, LargeConfig, SegmentConfig


@dataclass
class Cells:
    """Label images, and ``parted(y, x, label, nucleus)``, which has all in one."""

    parted: DataFrame

    @property
    def cell(self) -> DataFrame:
        return self.parted.select(*YX, "label")

    @property
    def nuclei(self) -> DataFrame:
        return self.parted.where("nucleus").select(*YX, "label")

    @property
    def cyto(self) -> DataFrame:
        return self.parted.where("not nucleus").select(*YX, "label")


# -- tissue and areas ---------------------------------------------------------------------------------


def log_smoothed(px: DataFrame, size: tuple[int, int], sigma: float = 1.0, top: int = 255) -> DataFrame:
    """log2(1 + smoothed), the image scaled to 0..1 first; rounded so that engines agree on bins."""
    smooth, scale = neighbourhood.gaussian(px, sigma, size, edge="nearest")
    return smooth.withColumn("v", F.round(pixel.log2p1(F.col("v") / F.lit(float(scale) * top)), 9))


def tissue_mask(px: DataFrame, size: tuple[int, int], top: int = 255) -> DataFrame:
    """Pixels of ``(c, y, x, v)`` above their channel's Otsu threshold in any channel."""
    logs = log_smoothed(px, size, top=top)
    limits = threshold.otsu_bins(logs, ["c"])
    return logs.join(F.broadcast(limits), "c").where("v > threshold").select(*YX).distinct()  # a row for each channel


def plate_mask(size: tuple[int, int], like: DataFrame) -> DataFrame:
    spark = like.sparkSession
    rows = spark.range(0, size[0], 1, max(spark.sparkContext.defaultParallelism, size[0] * size[1] // tiles.ROWS)).select(F.col("id").cast("int").alias("y"))
    return rows.withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(size[1] - 1))))


def pixel_areas(center: DataFrame, images: DataFrame, mask: DataFrame, size: tuple[int, int], limit: float | None = None, reuse_first: bool = False) -> DataFrame:
    """(c, area): the bright core's pixels as channel -1, then those above each marker's threshold within it.

    Markers are smoothed at full resolution and, without ``limit``, thresholded by Otsu, one threshold each.
    """
    core = frames.intersect(frames.core_mask(center), mask)
    smooth, scale = neighbourhood.gaussian(images, 1.0, size, edge="nearest")
    smooth = smooth.withColumn("v", F.round(F.col("v") / F.lit(float(scale)), 9))
    if limit is None:
        limits = threshold.otsu_bins(smooth, ["c"])
        if reuse_first:
            limits = limits.select("c", F.first("threshold").over(Window.orderBy("c")).alias("threshold"))
        above = smooth.join(F.broadcast(limits), "c").where("v > threshold")  # a row for each channel
    else:
        above = smooth.where(F.col("v") > limit)
    found = join_pixels(above, core, "left_semi").groupBy("c").agg(F.count("*").alias("area"))
    channels = images.select("c").distinct()
    markers = channels.join(found, "c", "left").select("c", F.coalesce("area", F.lit(0)).alias("area"))
    return core.agg(F.count("*").alias("area")).select(F.lit(-1).alias("c"), "area").unionByName(markers)


# -- nuclei -------------------------------------------------------------------------------------------


def _stored_smooth(image: np.ndarray, sigma: float) -> np.ndarray:
    """Smoothed as a store of integers has it: each axis cuts what is behind the point. In integers, so that no float's last digit does."""
    if not sigma:
        return image
    w = neighbourhood.gaussian_weights(sigma)
    for _ in range(2):
        wide = np.pad(image, [(len(w) // 2, len(w) // 2), (0, 0)], mode="symmetric")
        image = (sum(k * wide[i : i + len(image)] for i, k in enumerate(w)) // sum(w)).T
    return image


def seed_kernel(size: tuple[int, int], sigma: float, h: float, line: bool = True, area: tuple[float, float] | None = None):
    """One window: smooth the complement, take h-maxima, number them, flood the contour map within the tissue; with ``area`` its components
    across edges stay whose size is between the two.

    A window comes cut to the image, which is what is left of one with padding once the padding is cut off.
    """

    def kernel(rows: pd.DataFrame, box: tuple[int, int, int, int]) -> pd.DataFrame:
        contour = tiles.dense(rows, box, "contour")
        tissue = tiles.dense(rows, box, "tissue", 0, bool)
        peaks = kernels.h_maxima(_stored_smooth(255 - contour, sigma), h)
        seeds = kernels.components(kernels.window_peaks(peaks.astype(np.int8)), 2)  # none on the border
        found = kernels.flood(contour, seeds, tissue, line) > 0
        if area is not None:
            parts = kernels.components(found)
            n = np.bincount(parts.ravel())
            found &= ((n > area[0]) & (n < area[1]))[parts]
        return tiles.sparse(found.astype(np.int64), box)[["y", "x"]]

    return kernel


def _wide(pmap: DataFrame, mask: DataFrame | None) -> DataFrame:
    if mask is None:
        return pmap.withColumn("tissue", F.lit(True))
    return join_pixels(pmap, mask.select(*YX, F.lit(True).alias("tissue")), "left").withColumn("tissue", F.coalesce("tissue", F.lit(False)))


def nuclei(pmap: DataFrame, image: DataFrame, mask: DataFrame | None, size: tuple[int, int], config: SegmentConfig = SegmentConfig(), tile: int = tiles.TILE, halo: int = tiles.HALO) -> DataFrame:
    """(y, x, label) of nuclei from ``pmap(y, x, center, contour)``, by the configured mode."""
    if config.nuclei_region in LOCAL:
        return nuclei_local(pmap, size, config, tile, halo)
    if config.nuclei_region not in FLOODING:
        raise ValueError("this mode takes other inputs: nuclei_bypass or pixel_areas")
    spread = config.log_sigma[1] / 30
    wide = _wide(pmap, mask).select(*YX, "contour", "tissue")
    pieces = tiles.run(wide, seed_kernel(size, spread, spread), "y int, x int", size, tile, halo)
    labels = components.label(pieces, size[1])
    level = {"IntPM": pmap.select(*YX, F.col("center").alias("v")), "Int": image, "none": None}[config.nuclei_filter]
    low, high = regions.area_limits(config.log_sigma)
    labels = _held(labels)
    objects = regions.measure(labels, level).where(regions.area_between(low, high) if level is None else F.lit(True))
    if level is not None:
        limit = threshold.otsu_bins(objects, column="mean_intensity")
        # the threshold is of all objects' means; sizes are judged beside it
        objects = objects.join(F.broadcast(limit)).where(regions.area_between(low, high) & (F.col("mean_intensity") > F.col("threshold")))  # one row
    round_ = shapes.solidity(regions.keep(labels, objects)).where("solidity > 0.8")
    return components.relabelled(regions.keep(labels, round_), size[1])


def _held(df: DataFrame) -> DataFrame:
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def nuclei_local(pmap: DataFrame, size: tuple[int, int], config: SegmentConfig, tile: int = tiles.TILE, halo: int = tiles.HALO) -> DataFrame:
    """Seeds from h-maxima of the complement, flooding everywhere; basins dim in max - center - contour stay.

    All steps are those of the whole image, whatever the tile; ``halo`` no longer changes the result. A basin is what one seed floods, and
    is measured as such; components are found and numbered in what is kept.
    """
    maps = blocks.held(blocks.from_pixels(pmap.select(*YX, "center", "contour"), size, {"center": "<i4", "contour": "<i4"}, tile), "maps")
    top = blocks.listed(blocks.picked(maps, "center"), lambda arrays, box: {"top": arrays["center"].max(keepdims=True).ravel()}, "top int").agg(F.max("top")).first()[0]  # one row
    ridge = blocks.mapped(blocks.picked(maps, "contour"), lambda arrays, box: {"v": 255 - arrays["contour"].astype(np.int64)}, {"v": "<i8"})
    seeds = _joined_seeds(_peaks(ridge, config.log_sigma[0]))
    # the complement as an unsigned store of 8 bits has it
    dim = blocks.mapped(maps, lambda arrays, box: {"contour": arrays["contour"], "value": (top - arrays["center"] - arrays["contour"]) & 255}, {"contour": "<i4", "value": "<i4"})
    basins = blocks.held(blocks.flooded(blocks.held(blocks.joined(dim, seeds), "marked"), "contour"), "basins")
    parts = _held(blocks.measured(basins, value="value"))
    objects = parts.groupBy("label").agg(F.sum("area").alias("area"), (F.sum("total") / F.sum("area")).alias("mean_intensity"))
    low, high = regions.area_limits(config.log_sigma)
    return _renumbered(basins, parts.join(objects.where(regions.area_between(low, high) & (F.col("mean_intensity") < 50)).select("label"), "label", "left_semi"))


def _peaks(ridge: blocks.Blocks, h: float) -> blocks.Blocks:
    """Band seed: h-maxima of band v, integers, off the image's border; none if all of the image is one."""
    size = ridge.size
    step = max(1, math.ceil(h))  # a difference of integers is h or more if it is the next integer or more
    low = blocks.reconstructed(blocks.held(ridge, "ridge"), lambda v: v - step, "v")
    peaks = blocks.held(blocks.mapped(low, lambda arrays, box: {"seed": arrays["v"] - arrays["low"] >= step}, {"seed": "?"}), "peaks")
    flat = blocks.listed(peaks, lambda arrays, box: {"all": arrays["seed"].all(keepdims=True).ravel()}, "all boolean").agg(F.min("all")).first()[0]  # one row

    def inner(arrays: dict[str, np.ndarray], box: blocks.Box) -> dict[str, np.ndarray]:
        y, x = np.arange(box[0], box[1])[:, None], np.arange(box[2], box[3])
        return {"seed": arrays["seed"] & (y > 0) & (y < size[0] - 1) & (x > 0) & (x < size[1] - 1) & (not flat)}

    return blocks.mapped(peaks, inner, {"seed": "?"})


def _joined_seeds(peaks: blocks.Blocks) -> blocks.Blocks:
    """Band label: components of band seed, across corners too."""
    width = peaks.size[1]
    found = blocks.mapped(peaks, lambda arrays, box: {"label": components.pieces(arrays["seed"], box, width, 2)}, {"label": "<i8"})
    return components.joined_up(blocks.held(found, "seeds"), "label", 2)


def _renumbered(basins: blocks.Blocks, kept: DataFrame) -> DataFrame:
    """(y, x, label): components of the basins that ``kept(ty, tx, label)`` has, numbered by first pixels."""
    width = basins.size[1]
    told = kept.groupBy(*blocks.KEY).agg(F.collect_list("label").alias("told"))

    def cut(arrays: dict[str, np.ndarray], box: blocks.Box, told: list[int] | None) -> dict[str, np.ndarray]:
        return {"label": components.pieces(np.isin(arrays["label"], told or []), box, width)}

    parts = components.joined_up(blocks.held(blocks.mapped(blocks.picked(basins, "label"), cut, {"label": "<i8"}, told), "kept"), "label")
    parts = blocks.held(parts, "components")
    names = blocks.listed(parts, lambda arrays, box: {"label": np.unique(arrays["label"][arrays["label"] != 0])}, "label bigint")
    return blocks.renamed(parts, names, regions.numbered(names.select("label")).withColumnRenamed("to", "number"))


def legacy_filter(labels: DataFrame, image: DataFrame, size: tuple[int, int], config: SegmentConfig) -> DataFrame:
    """The older order of tests: intensity above the objects' Otsu threshold first, numbers anew, then size and solidity."""
    objects = regions.measure(labels, image)
    limit = threshold.otsu_bins(objects, column="mean_intensity")
    bright = objects.join(F.broadcast(limit)).where("mean_intensity > threshold")  # one row
    first = _held(components.relabelled(regions.keep(labels, bright), size[1]))
    low, high = regions.area_limits(config.log_sigma)
    round_ = shapes.solidity(first).where(regions.area_between(low, high) & (F.col("solidity") > 0.8))
    return regions.relabel(first, regions.numbered(round_))


def nuclei_bypass(labels: DataFrame, size: tuple[int, int], config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Labels given: those of the right size, then numbered by components, so that touching ones merge."""
    low, high = regions.area_limits(config.log_sigma)
    kept = regions.measure(labels).where(regions.area_between(low, high))
    return components.relabelled(regions.keep(labels, kept), size[1])


# -- cytoplasm ----------------------------------------------------------------------------------------


def cell_assembly(basins: DataFrame | blocks.Blocks, nuclei_px: DataFrame, mask: DataFrame | None, size: tuple[int, int], tile: int = components.TILE) -> Cells:
    """Basins off the border, within the mask (None: anywhere), cut into components; those with a nucleus are cells, numbered."""
    if isinstance(basins, DataFrame):
        basins = blocks.from_pixels(basins.select(*YX, "label", F.lit(True).alias("on")).where("label is not null"), size, {"label": "<i8", "on": "?"}, tile)
    else:
        basins = blocks.mapped(basins, lambda arrays, box: {"label": arrays["label"], "on": arrays["label"] != 0}, {"label": "<i8", "on": "?"})
    for name, px in (("nucleus", nuclei_px), ("within", mask)):
        if px is not None:
            basins = blocks.joined(basins, blocks.from_pixels(px.select(*YX, F.lit(True).alias(name)), size, {name: "?"}, basins.tile))
    return _assembled(basins)


def ring_cells(labels: DataFrame, radius: int, size: tuple[int, int], tile: int = components.TILE) -> Cells:
    """``cell_assembly`` of the rings around ``labels``, their own pixels being the nuclei."""
    return _assembled(neighbourhood.ring_blocks(labels, radius, size, tile))


def _assembled(basins: blocks.Blocks) -> Cells:
    """Cells from the bands label, on, nucleus and, if it is there, within. Pixels stay in their tiles until they have their cell's
    number; labels, components and what meets at seams are rows."""
    held = replace(basins, frame=_held(basins.frame))  # read for the labels and for the components
    size = held.size

    def names(arrays: dict[str, np.ndarray], box: blocks.Box) -> dict[str, np.ndarray]:
        label, on = arrays["label"], arrays["on"]
        edge = np.zeros(on.shape, bool)
        for at, is_border in ((np.s_[0], box[0] == 0), (np.s_[-1], box[1] == size[0]), (np.s_[:, 0], box[2] == 0), (np.s_[:, -1], box[3] == size[1])):
            edge[at] |= is_border
        found = np.unique(label[on])
        return {"label": found, "edge": np.isin(found, label[on & edge])}

    theirs = blocks.listed(held, names, "label bigint, edge boolean")
    gone = theirs.join(theirs.where("edge").select("label").distinct(), "label", "left_semi").groupBy(*blocks.KEY).agg(F.collect_list("label").alias("told"))

    def cut(arrays: dict[str, np.ndarray], box: blocks.Box, gone: list[int] | None) -> dict[str, np.ndarray]:
        on = arrays["on"] & arrays.get("within", True)
        if gone:
            on &= ~np.isin(arrays["label"], gone)
        return {"part": components.pieces(on, box, size[1]), "nucleus": arrays["nucleus"]}

    parts = blocks.mapped(held, cut, {"part": "<i8", "nucleus": "?"}, gone)
    parts = replace(parts, frame=_held(parts.frame))

    def objects(arrays: dict[str, np.ndarray], box: blocks.Box) -> dict[str, np.ndarray]:
        found = np.unique(arrays["part"][arrays["part"] != 0])
        return {"label": found, "nucleus": np.isin(found, arrays["part"][arrays["nucleus"]])}

    pieces = blocks.listed(parts, objects, "label bigint, nucleus boolean")
    roots = components.pieces_across(parts, "part")
    rooted = pieces.withColumn("root", F.col("label")) if roots is None else pieces.join(roots.withColumnRenamed("node", "label"), "label", "left").withColumn("root", F.coalesce("root", "label"))
    rooted = _held(rooted)
    numbers = regions.numbered(rooted.where("nucleus").select(F.col("root").alias("label")))
    numbers = rooted.select("label", "root").distinct().join(numbers.withColumnRenamed("label", "root"), "root").select("label", F.col("to").alias("number"))
    return Cells(blocks.renamed(parts, pieces, numbers, "part", "nucleus"))


def _basins(surface: DataFrame | blocks.Blocks, markers: DataFrame, size: tuple[int, int], tile: int, halo: int) -> DataFrame:
    return blocks.to_pixels(_basin_blocks(surface, markers, size, tile, halo), "label")


def _basin_blocks(surface: DataFrame | blocks.Blocks, markers: DataFrame, size: tuple[int, int], tile: int, halo: int) -> blocks.Blocks:
    """Each tile with its halo flooded alone; surface and markers meet as array tiles."""
    if isinstance(surface, DataFrame):
        surface = blocks.from_pixels(surface, size, {"v": "<f8"}, tile)

    def kernel(arrays: dict[str, np.ndarray], box: blocks.Box, seen: blocks.Box) -> dict[str, np.ndarray]:
        return {"label": blocks.inner(kernels.flood(arrays["v"], arrays["label"]), box, seen)}

    both = blocks.joined(surface, blocks.from_pixels(markers.select(*YX, "label"), size, {"label": "<i8"}, tile))
    return blocks.stencil(both, halo, kernel, {"label": "<i8"})


def _gradient(image: DataFrame, size: tuple[int, int], tile: int) -> blocks.Blocks:
    """Band grad: the deviation over 3 x 3 windows of the smoothed image, in sixteenths; as ``neighbourhood.deviation3`` has it by rows."""
    smooth, scale = blocks.gaussian(blocks.from_pixels(image, size, {"v": "<i8"}, tile), 2.0, "nearest")

    def rough(arrays: dict[str, np.ndarray], box: blocks.Box) -> dict[str, np.ndarray]:
        v = arrays["v"] / float(scale) * 16
        low = np.floor(v)
        return {"v": low + (v - low >= 0.5)}  # halves up

    def deviation(arrays: dict[str, np.ndarray], box: blocks.Box, seen: blocks.Box) -> dict[str, np.ndarray]:
        s1, s2 = (blocks.convolved(a, [1, 1, 1], [1, 1, 1], "reflect", box, seen, size) for a in (arrays["v"], arrays["v"] ** 2))
        return {"grad": np.sqrt(np.maximum(9 * s2 - s1 * s1, 0) / 72.0) / 16}

    return blocks.stencil(blocks.mapped(smooth, rough, {"v": "<i8"}), 1, deviation, {"grad": "<f8"})


def cytoplasm(nuclei_px: DataFrame, image: DataFrame | None, tissue: DataFrame, size: tuple[int, int], config: SegmentConfig = SegmentConfig(), method: str | None = None, tile: int = tiles.TILE, halo: int = tiles.HALO) -> Cells:
    """Cells around nuclei by ``distanceTransform``, ``hybrid`` or ``ring``, flooded over the whole image whatever the tile; pixels that
    ``image`` hasn't are 0. ``halo`` no longer changes the result."""
    method = method or config.cyto_method
    if method not in ("ring", "distanceTransform", "hybrid"):
        raise ValueError(f"{method} has no defined result")
    own = blocks.from_pixels(nuclei_px.select(*YX, "label", F.lit(True).alias("nucleus")), size, {"label": "<i8", "nucleus": "?"}, tile)
    if method == "ring":
        tissue = neighbourhood.ring(nuclei_px, config.cyto_dilation, size, tissue if config.ring_in_tissue else None)
    scene = blocks.joined(own, blocks.from_pixels(tissue.select(*YX, F.lit(True).alias("within")), size, {"within": "?"}, tile))
    if method != "ring":  # the nuclei and the tissue
        scene = blocks.mapped(scene, lambda arrays, box: {**arrays, "within": arrays["within"] | arrays["nucleus"]}, scene.bands)
    scene = blocks.held(scene, "scene")
    d2 = blocks.squared_distances(scene, "nucleus")
    if method == "hybrid":
        both = blocks.held(blocks.joined(_gradient(image, size, tile), d2), "hybrid")
        ends = blocks.listed(both, lambda arrays, box: {"g": arrays["grad"].max(keepdims=True).ravel(), "d": arrays["d2"].max(keepdims=True).ravel()}, "g double, d bigint")
        ends = ends.agg(F.max("g").alias("g"), F.sqrt(F.max("d").cast("double")).alias("d")).first()  # one row
        share = 1e-6 * ends["g"] / ends["d"] if ends["d"] else 0.0
        surface = blocks.mapped(both, lambda arrays, box: {"v": np.sqrt(arrays["grad"] * arrays["grad"] + share * arrays["d2"])}, {"v": "<f8"})
        markers = _with_background(scene, config.cyto_dilation)
    else:
        surface = blocks.mapped(d2, lambda arrays, box: {"v": arrays["d2"]}, {"v": "<i8"})  # floods in the same order as its root
        markers = blocks.picked(scene, "label")
    basins = blocks.flooded(blocks.held(blocks.joined(surface, markers), "marked"))
    basins = blocks.mapped(basins, lambda arrays, box: {"label": arrays["label"], "on": arrays["label"] != 0}, {"label": "<i8", "on": "?"})
    return _assembled(blocks.joined(basins, blocks.picked(scene, "nucleus", *(() if method == "hybrid" else ("within",)))))


def _with_background(scene: blocks.Blocks, radius: int) -> blocks.Blocks:
    """Band label: components of the nuclei and of what is farther than a disk from the tissue; the image's border is no tissue."""
    outside = blocks.mapped(scene, lambda arrays, box: {"out": ~arrays["within"]}, {"out": "?"})
    both = blocks.joined(blocks.eroded(outside, "out", neighbourhood.disk(radius), beyond=True), blocks.picked(scene, "nucleus"))
    width = scene.size[1]
    found = blocks.mapped(both, lambda arrays, box: {"label": components.pieces(arrays["out"] | arrays["nucleus"], box, width)}, {"label": "<i8"})
    return components.joined_up(blocks.held(found, "markers"), "label")


# -- puncta -------------------------------------------------------------------------------------------


def puncta(spot: DataFrame, mask: DataFrame, sigma: float, sd: float, size: tuple[int, int], foreground: bool = True) -> DataFrame:
    """Spots (y, x): peaks of the negated Laplacian of Gaussian on lit pixels, above median + 1.4826 * SD * MAD of them,
    and within the mask."""
    response = neighbourhood.laplacian_of_gaussian(spot, sigma, size)
    peaks = neighbourhood.local_maxima(response, size)
    if foreground:
        peaks = join_pixels(peaks, spot.where("v > 0").select(*YX), "left_semi")
    peaks = _held(peaks)  # few rows, read by two medians and the filter
    stats = threshold.median_mad(peaks)
    bright = peaks.join(F.broadcast(stats)).where(F.col("v") > F.col("med") + F.lit(1.4826 * sd) * F.col("mad"))  # one row
    return frames.intersect(bright.select(*YX), mask)


def puncta_stack(image: DataFrame, labels: DataFrame, size: tuple[int, int], config: SegmentConfig) -> DataFrame:
    """(c, label, n_spots) for each configured channel."""
    out = None
    for number, sigma, sd in config.puncta():
        spots = puncta(frames.channel(image, number).drop("c"), labels, sigma, sd, size)
        one = regions.spots_by_object(labels, spots).select(F.lit(number).alias("c"), "label", "n_spots")
        out = one if out is None else out.unionByName(one)
    return out


# -- quality control ----------------------------------------------------------------------------------


def outlines(labels: DataFrame, image: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Two channels: the binary mask's outline at the image's brightest value, and the image."""
    edge = neighbourhood.outer_boundary(labels.select(*YX, F.lit(1).alias("label")), size)
    top = image.agg(F.max("v").alias("top"))
    line = join_pixels(image, edge.withColumn("on", F.lit(1)), "left").join(F.broadcast(top)).select(*YX, F.when(F.col("on") == 1, F.col("top")).otherwise(F.lit(0)).cast("int").alias("v"))  # one row
    return frames.stack(line, image)


def qc_stack(labels: DataFrame, contour: DataFrame, image: DataFrame, numbers: list[int], size: tuple[int, int]) -> DataFrame:
    """Outline as 0/255, contour map, and each image channel rescaled between its 0.1 and 99.9 percentiles."""
    edge = neighbourhood.outer_boundary(labels, size).withColumn("on", F.lit(True))
    line = join_pixels(contour, edge, "left").select(*YX, pixel.flag(F.coalesce("on", F.lit(False))).alias("v"))
    layers = [frames.percentile_rescale(frames.channel(image, n), 0.1, 99.9) for n in dict.fromkeys(numbers)]
    return frames.stack(line, contour, *layers)


# -- the tiled chain ----------------------------------------------------------------------------------


class LargeSegmentor:
    """Smooth, find seeds, flood, filter by area and intensity, number: a lazy chain over ``pmap(y, x, center, contour)``.

    Settings are kept by number; ``configure`` adds a number if they change, ``use`` goes back to one, ``trial`` runs
    steps of the chain, on another map if one is given, and notes what they gave under which settings.
    """

    def __init__(self, pmap: DataFrame, size: tuple[int, int], config: LargeConfig = LargeConfig(), tile: int = 2048, top: int = 255) -> None:
        self.pmap, self.size, self.history, self.tile, self.top = pmap, size, History(config), tile, top

    @property
    def config(self) -> LargeConfig:
        return self.history.current

    def configure(self, **changes: object) -> int:
        return self.history.update(**changes)

    def use(self, number: int) -> LargeConfig:
        return self.history.use(number)

    def trial(self, *steps: Callable[[], object], pmap: DataFrame | None = None) -> object:
        own = self.pmap

        def chain() -> object:
            out = None
            for step in steps:
                out = step()
            return out

        self.pmap = own if pmap is None else pmap
        try:
            with self.history.trial(chain) as out:
                return out
        finally:
            self.pmap = own

    def _maps(self) -> blocks.Blocks:
        """Both maps as array tiles, in one shuffle of the pixels."""
        px = self.pmap.select(*YX, "center", "contour")
        return blocks.held(blocks.from_pixels(px, self.size, {"center": "<i4", "contour": "<i4"}, self.tile, {"contour": self.top}), "maps")

    def _seeds(self, maps: blocks.Blocks) -> blocks.Blocks:
        """h-maxima of the smoothed complement, in integers, so that they are those of the whole image."""
        top = self.top
        contour = replace(maps, frame=maps.frame.select(*blocks.KEY, "contour"), bands={"contour": "<i4"})
        ridge = blocks.mapped(contour, lambda arrays, box: {"v": top - arrays["contour"].astype(np.int64)}, {"v": "<i8"})
        smooth, scale = blocks.gaussian(ridge, self.config.sigma)
        # a difference of integers is h or more if it is the next integer or more
        h = max(1, math.ceil(self.config.h * scale * top * (1 - 1e-12)))
        low = blocks.reconstructed(blocks.held(smooth, "smooth"), lambda v: v - h, "v", self.config.footprint_size)
        return blocks.mapped(low, lambda arrays, box: {"seed": arrays["v"] - arrays["low"] >= h}, {"seed": "|b1"})

    def seeds(self) -> DataFrame:
        return blocks.to_pixels(self._seeds(self._maps()), "seed").select(*YX)

    def _basins(self) -> blocks.Blocks:
        """Basins with the centre map; a basin is named by its seed's least linear index, plus one."""
        maps = self._maps()
        seeds = blocks.to_pixels(self._seeds(maps), "seed").select(*YX)
        names = components.label(seeds, self.size[1], tile=self.tile).withColumn("label", F.col("label") + 1)
        markers = blocks.from_pixels(names, self.size, {"label": "<i8"}, self.tile)
        return blocks.flooded(blocks.held(blocks.joined(maps, markers), "marked"), "contour")

    def segmented(self) -> DataFrame:
        return blocks.to_pixels(self._basins(), "label").select(*YX, "label")

    def _kept(self) -> tuple[blocks.Blocks, DataFrame, DataFrame]:
        """Basins, what each tile has of them, and those of the right size and brightness."""
        basins = blocks.held(self._basins(), "basins")
        parts = _held(blocks.measured(basins, value="center"))
        objects = parts.groupBy("label").agg(F.sum("area").alias("area"), (F.sum("total") / F.sum("area")).alias("mean_intensity"), F.min("first").alias("first"))
        return basins, parts, objects.where(regions.area_from(self.config.area_min, self.config.area_max) & (F.col("mean_intensity") >= self.config.mean_intensity_min))

    def filtered(self) -> DataFrame:
        basins, parts, kept = self._kept()
        return blocks.renamed(basins, parts, kept.select("label", F.col("label").alias("number")))

    def run(self) -> DataFrame:
        """Basins part by lines and hang together, so that each is a component of what is kept; they are numbered as such, by first pixels."""
        basins, parts, kept = self._kept()
        numbers = regions.numbered(kept.select("label", "first"), "first")
        return blocks.renamed(basins, parts, numbers.withColumnRenamed("to", "number"))

    def expanded(self, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(cells, cytoplasm): labels grown by the configured distance, and what growing added."""
        grown = neighbourhood.expand_labels(labels, self.config.expand_size, self.size)
        return grown, neighbourhood.difference(grown, labels)
