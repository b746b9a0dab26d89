"""Whole runs from files to files: ``python -m tessera.plans.run segment|large|wrapper ...``.

Images, probability maps and masks are TIFF files, Zarr groups or tile stores, by suffix; masks and quality control go to
tile stores under the output folder, or for the large chain to whatever the output's suffix names.
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frames
from ..operators.frames import YX
from ..sources import store
from . import config as settings
from . import segment
from .config import LargeConfig, SegmentConfig

log = logging.getLogger(__name__)


def _stem(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]


def _pixels(spark: SparkSession, path: str) -> DataFrame:
    return store.load(spark, path).select("c", *YX, "v")


def rectangle(config: SegmentConfig, size: tuple[int, int]) -> tuple[int, int, int, int]:
    """(y, x, height, width) of what a run sees of the image."""
    if config.crop == "interactiveCrop":
        return config.rectangle
    return frames.auto_rectangle(*size) if config.crop == "autoCrop" else (0, 0, *size)


def _cut(px: DataFrame, box: tuple[int, int, int, int]) -> DataFrame:
    return frames.shift(frames.crop(px, *box), -box[0], -box[1])


def whole_image(spark: SparkSession, image_path: str, map_paths: list[str], out: str, config: SegmentConfig = SegmentConfig(), mask_path: str | None = None) -> dict[str, DataFrame]:
    """Crop, tissue, nuclei, cytoplasm, puncta; writes masks, outlines and counts under ``out``, returns the masks.

    ``map_paths`` is a stack of two channels, centres and contours, or a file for each; for ``bypass`` a label image.
    """
    image = _pixels(spark, image_path)
    said = store.described(spark, image_path)
    size, top = said["size"], 2 ** said["bits"] - 1
    box = rectangle(config, size)
    image, size = _cut(image, box), box[2:]
    maps = [_cut(_pixels(spark, p), box) for p in map_paths]
    meta = {"pixel_sizes": said["pixel_sizes"]}
    center, contour = (maps[0].where("c = 0"), maps[1].where("c = 0")) if len(maps) == 2 else (maps[0].where("c = 0"), maps[0].where("c = 1"))
    nuclear = frames.channel(image, max(config.prob_map_chan, 1)).drop("c")
    target = f"{out.rstrip('/')}/{_stem(image_path)}"

    if config.crop == "dearray":
        tissue = _cut(_pixels(spark, mask_path), box).where("v > 0").select(*YX)
    elif config.crop == "plate":
        tissue = segment.plate_mask(size, image)
    else:
        tissue = segment.tissue_mask(frames.channels(image, list(config.tissue_chans)), size, top)
    tissue = segment._held(tissue)

    if config.nuclei_region == "pixellevel":
        areas = segment.pixel_areas(center.drop("c"), frames.channels(image, list(config.pixel_chans)), tissue, size, None if config.pixel_threshold == -1 else config.pixel_threshold, config.reuse_first_threshold)
        store.area_csv(areas, target, _stem(image_path))
        return {"areas": areas}
    if config.nuclei_region == "bypass":
        nuclei = segment.nuclei_bypass(center.where("v > 0").select(*YX, F.col("v").cast("bigint").alias("label")), size, config)
    else:
        nuclei = segment.nuclei(frames.pair(center, contour), nuclear, tissue, size, config)
    nuclei = segment._held(nuclei)

    masks = {"nuclei": (nuclei, nuclear), "cell": (nuclei, nuclear)}
    if config.segment_cytoplasm:
        around = frames.max_projection(frames.channels(image, list(config.cyto_chans)))
        for suffix, method in (("", config.cyto_method), ("Ring", "ring")):
            found = segment.cytoplasm(nuclei, around, tissue, size, config, method)
            masks |= {f"nuclei{suffix}": (found.nuclei, nuclear), f"cyto{suffix}": (found.cyto, around), f"cell{suffix}": (found.cell, around)}
    for name, (labels, over) in masks.items():
        store.export_masks(labels, over, target, name, size, config.save_mask, config.save_fig, **meta)

    cells = masks["cellRing" if config.segment_cytoplasm else "cell"][0]
    for number, sigma, sd in config.puncta():
        marker = frames.channel(image, number).drop("c")
        spots = segment._held(segment.puncta(marker, cells, sigma, sd, size))
        store.counts_csv(segment.regions.spots_by_object(nuclei, spots), out, number)
        store.puncta_images(spots, cells, marker, target, number, size)
    return {name: labels for name, (labels, _) in masks.items()}


def large_image(spark: SparkSession, source: str, out: str, config: LargeConfig = LargeConfig(), mcmicro: bool = False, tile: int = 2048) -> dict[str, str]:
    """Segment a two-channel probability map tile by tile and write the mask; with ``expand_size`` the grown mask and the
    difference as well. Returns where they went."""
    px = store.load(spark, source, numbers=[1, 2]).select("c", *YX, "v")
    said = store.described(spark, source)
    size, top = said["size"], 2 ** said["bits"] - 1
    pixel = settings.pixel_size(config.pixel_size, said["pixel_sizes"][0])
    chain = segment.LargeSegmentor(frames.pair(px.where("c = 0"), px.where("c = 1")), size, config, tile, top)
    labels = segment._held(chain.run())
    meta = {"pixel_sizes": (pixel, pixel)}
    store.save(labels.withColumnRenamed("label", "v"), out, size, True, **meta)
    paths = {"nuclei": out}
    if config.expand_size:
        cell, cyto = chain.expanded(labels)
        folder, _, name = out.rstrip("/").rpartition("/")
        stem, dot, suffix = name.partition(".")
        paths["cell"] = f"{folder}/cellRing{dot}{suffix}" if mcmicro else f"{folder}/{stem}-expanded_{config.expand_size}{dot}{suffix}"
        paths["cyto"] = f"{folder}/cytoRing{dot}{suffix}" if mcmicro else f"{folder}/{stem}-difference_{config.expand_size}{dot}{suffix}"
        cell = segment._held(cell)
        store.save(cell.withColumnRenamed("label", "v"), paths["cell"], size, True, **meta)
        store.save(cyto.withColumnRenamed("label", "v"), paths["cyto"], size, True, **meta)
    return paths


def _session() -> SparkSession:
    return SparkSession.builder.appName("tessera").getOrCreate()


def main_segment(argv: list[str]) -> None:
    a, config = settings.parse_segment(argv)
    maps = [a.stackProbPath] if a.stackProbPath else [a.nucleiClassProbPath, a.contoursClassProbPath]
    whole_image(_session(), a.imagePath, maps, a.outputPath, config, a.maskPath)


def main_large(argv: list[str]) -> None:
    parser = settings.large_parser()
    settings.accept_and_warn(parser)
    a = vars(parser.parse_args(argv))
    source, out, mcmicro = a.pop("input"), a.pop("output"), a.pop("mcmicro")
    large_image(_session(), source, out, LargeConfig(**a), mcmicro)


def main_wrapper(argv: list[str]) -> None:
    """The large chain and its quality control under names derived from the image's; further options go to the chain."""
    a, rest = settings.wrapper_parser().parse_known_args(argv)
    spark = _session()
    parser = settings.large_parser()
    settings.accept_and_warn(parser)
    paths = settings.output_paths(a.outputPath, a.imagePath)
    options = ["-i", a.stackProbPath, "-o", paths["nuclei"], "--mcmicro", *rest]
    given = vars(parser.parse_args(options + (["--pixel-size", str(a.pixelSize)] if a.pixelSize is not None else [])))
    source, out, mcmicro = given.pop("input"), given.pop("output"), given.pop("mcmicro")
    written = large_image(spark, source, out, LargeConfig(**given), mcmicro)
    labels = store.load(spark, written.get("cell", written["nuclei"])).where("v > 0").select(*YX, F.col("v").alias("label"))
    contour = store.load(spark, source, numbers=[2]).select(*YX, "v")
    size = store.described(spark, source)["size"]
    pixel = settings.pixel_size(a.pixelSize, store.described(spark, a.imagePath)["pixel_sizes"][0])
    qc = segment.qc_stack(labels, contour, _pixels(spark, a.imagePath), a.probMapChan, size)
    store.save(qc, paths["qc"], size, pixel_sizes=(pixel, pixel))


def main(argv: list[str]) -> None:
    commands = {"segment": main_segment, "large": main_large, "wrapper": main_wrapper}
    if not argv or argv[0] not in commands:
        raise SystemExit(f"usage: python -m tessera.plans.run {'|'.join(commands)} ...")
    commands[argv[0]](argv[1:])


if __name__ == "__main__":
    main(sys.argv[1:])
