"""The tile store, masks, tables of counts, image metadata.

The store is Parquet partitioned by pyramid level, channel and tile row, so that a channel, a level or a crop
reads its own folders only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frames, neighbourhood, tiles
from ..plans.config import UNITS

TILE = 1024


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``; a temporary folder only in a plain local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
    return f"{folder.rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def write_pyramid(px: DataFrame, path: str, size: tuple[int, int], is_mask: bool = False, pixel_sizes: tuple[float | None, float | None] = (1.0, 1.0), units: tuple[str, str] = ("µm", "µm"), channel_names: list[str] | None = None, software: str = "", bits: int = 16) -> None:
    """Write all levels and, beside them, a row of metadata. pixel_sizes and units are (y, x); sizes may be unknown; bits are those of the
    pixels' scale."""
    for u in units:
        if u not in UNITS:
            raise ValueError(f"{u} is no known unit")
    if "c" not in px.columns:
        px = px.withColumn("c", F.lit(0))
    levels, _, _ = frames.pyramid_plan(*size)
    px = px.select(*(F.col(k).cast("int").alias(k) for k in ("c", "y", "x")), "v")
    tiled = tiles.tile_of(frames.pyramid(px, levels, is_mask), TILE)
    tiled.repartition("level", "c", "ty", "tx").sortWithinPartitions("y", "x").write.mode("overwrite").partitionBy("level", "c", "ty").parquet(f"{path}/tiles")
    row = [(path.rstrip("/").rsplit("/", 1)[-1], size[1], size[0], *(None if p is None else float(p) for p in pixel_sizes[::-1]), units[1], channel_names, software, tiled.schema["v"].dataType.simpleString(), bits)]
    schema = "image_id string, width int, height int, pixel_size_x double, pixel_size_y double, unit string, channel_names array<string>, software string, kind string, bits int"
    px.sparkSession.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def read_pyramid(spark: SparkSession, path: str, level: int = 0, numbers: list[int] | None = None) -> DataFrame:
    """(c, y, x, v, tx, ty) of one level, of all channels or those numbered from 1; no rows if no pixel was written."""
    kind = read_meta(spark, path).first()["kind"]
    px = frames.level(spark.read.schema(f"y int, x int, v {kind}, tx int, level int, c int, ty int").parquet(f"{path}/tiles"), level).drop("level")
    return px if numbers is None else frames.channels(px, numbers)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Metadata; missing pixel sizes are 1."""
    return spark.read.parquet(f"{path}/meta").withColumns({k: F.coalesce(k, F.lit(1.0)) for k in ("pixel_size_x", "pixel_size_y")})


def append_channels(px: DataFrame, path: str, numbers: list[int], rectangle: tuple[int, int, int, int]) -> None:
    """Crop channels and append each to one store."""
    for k, n in enumerate(numbers):
        cut = frames.crop(frames.channel(px, n), *rectangle)
        tiles.tile_of(cut, TILE).write.mode("overwrite" if k == 0 else "append").partitionBy("c").parquet(path)


def export_masks(labels: DataFrame, image: DataFrame, path: str, name: str, size: tuple[int, int], save_masks: bool = True, save_fig: bool = True, **meta: object) -> None:
    """The mask, and its outlines over the image under ``qc``."""
    from ..plans import segment

    if save_masks:
        write_pyramid(labels.withColumnRenamed("label", "v"), f"{path}/{name}", size, True, channel_names=[name], **meta)
    if save_fig:
        write_pyramid(segment.outlines(labels, image, size), f"{path}/qc/{name}Outlines", size, channel_names=[f"{name} outlines", "Segmentation image"], **meta)


def counts_csv(counts: DataFrame, path: str, channel: int) -> str:
    """Spot counts of one channel in the order of labels, one a line, without the labels; returns the folder."""
    folder = f"{path}/numSpots_chan{channel}.csv"
    counts.repartitionByRange("label").sortWithinPartitions("label").select(F.format_string("%10.5f", F.col("n_spots").cast("double")).alias("n")).write.mode("overwrite").csv(folder, ignoreLeadingWhiteSpace=False)
    return folder


def area_csv(areas: DataFrame, path: str, name: str) -> str:
    folder = f"{path}/{name}_area.csv"
    areas.repartitionByRange("c").sortWithinPartitions("c").select(F.format_string("%10.5f", F.col("area").cast("double")).alias("area")).write.mode("overwrite").csv(folder, ignoreLeadingWhiteSpace=False)
    return folder


def puncta_images(spots: DataFrame, labels: DataFrame, image: DataFrame, path: str, channel: int, size: tuple[int, int]) -> None:
    """Spots and object edges together over the image, and the spot mask."""
    edges = neighbourhood.outer_boundary(labels.withColumn("label", F.lit(1)), size)
    line = frames.join_pixels(image, frames.union(spots, edges).withColumn("on", F.lit(1)), "left").select("y", "x", F.when(F.col("on") == 1, 255).otherwise(0).alias("v"))
    write_pyramid(frames.stack(line, image.select("y", "x", "v")), f"{path}/punctaChan{channel}Outlines", size)
    write_pyramid(spots.withColumn("v", F.lit(1)), f"{path}/spots{channel}", size, True)


def save(px: DataFrame, path: str, size: tuple[int, int], is_mask: bool = False, **meta: object) -> None:
    """Dispatch by suffix: a TIFF file, a Zarr group, or a tile store."""
    if path.endswith((".tif", ".tiff")):
        from . import tiff

        tiff.write(px, path, size, 32 if is_mask else 16, is_mask=is_mask, **meta)
    elif path.endswith(".zarr"):
        from . import zarr

        zarr.write(px, path, size, 32 if is_mask else 16, is_mask, **meta)
    elif "." in path.rstrip("/").rsplit("/", 1)[-1]:
        raise ValueError(f"{path}: no writer for this kind of file")
    else:
        write_pyramid(px, path, size, is_mask, **meta)


def load(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Dispatch by suffix: TIFF files (a folder that ``save`` wrote, too), a Zarr group, or a tile store. All are lazy."""
    if path.endswith((".tif", ".tiff")):
        from . import ranges, tiff

        return ranges.read(spark, path, **options) if _ranged(path) else tiff.read(spark, path, **options)
    if path.endswith(".zarr"):
        from . import zarr

        return zarr.read(spark, path, **options)
    return read_pyramid(spark, path, **options)


def _ranged(path: str) -> bool:
    """Whether the file can be read by ranges: file systems that only Spark knows, and patterns, are read whole."""
    from . import ranges

    try:
        return bool(ranges.files(path))
    except (OSError, ValueError):
        return False


def described(spark: SparkSession, path: str) -> dict:
    """Of what ``load`` reads, as the file says: pixel sizes (y, x), channel names (None where it says nothing), size (height, width)
    and bits of a pixel."""
    if path.endswith(".zarr"):
        from . import zarr

        return zarr.meta(spark, path)
    if path.endswith((".tif", ".tiff")):
        from . import ranges, tiff

        found = ranges.metadata(path) if _ranged(path) else tiff.described(spark, path)
        return {"pixel_sizes": (found["pixel_size_y"], found["pixel_size_x"]), "channel_names": found["channel_names"], "size": (found["height"], found["width"]), "bits": found["bits"]}
    row = read_meta(spark, path).first()
    return {"pixel_sizes": (row["pixel_size_y"], row["pixel_size_x"]), "channel_names": row["channel_names"], "size": (row["height"], row["width"]), "bits": row["bits"] if "bits" in row else 16}
