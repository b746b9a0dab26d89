"""Measurements of labelled objects, filters on them, renumbering.

Objects are measured with one hash aggregate; a filter is a semi-join of pixels with the objects that pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import YX, join_pixels


def measure(labels: DataFrame, intensity: DataFrame | None = None) -> DataFrame:
    """(label, area, y0, y1, x0, x1[, sum_intensity, mean_intensity, max_intensity]); pixels missing in the image are 0."""
    joined = labels.select(*YX, "label")
    size = [F.count("*").alias("area"), F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")]
    if intensity is not None:
        joined = join_pixels(joined, intensity.select(*YX, "v"), "left").withColumn("v", F.coalesce("v", F.lit(0)))
        size += [F.sum("v").alias("sum_intensity"), F.avg("v").alias("mean_intensity"), F.max("v").alias("max_intensity")]
    return joined.where("label <> 0").groupBy("label").agg(*size)


def counts(px: DataFrame, column: str = "label") -> DataFrame:
    return px.groupBy(column).agg(F.count("*").alias("n"))


def area_limits(log_sigma: tuple[float, float]) -> tuple[float, float]:
    """Object sizes from the two diameters."""
    return log_sigma[0] ** 2 * 3 / 4, log_sigma[1] ** 2 * 3 / 4


def area_between(low: float, high: float) -> Column:
    """Both ends excluded."""
    return (F.col("area") > low) & (F.col("area") < high)


def area_from(low: float, high: float = float("inf")) -> Column:
    """The low end included, the high end not."""
    return (F.col("area") >= low) & ((F.col("area") < high) if high != float("inf") else F.lit(True))


def keep(labels: DataFrame, objects: DataFrame) -> DataFrame:
    """Pixels of the objects; Spark broadcasts the objects by itself if they are few."""
    return labels.join(objects.select("label"), "label", "left_semi")


def drop(labels: DataFrame, objects: DataFrame) -> DataFrame:
    return labels.join(objects.select("label"), "label", "left_anti")


def relabel(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Look labels up in ``mapping(label, to)``; labels missing there become background.

    Of the two only the mapping is held in memory, a part at a time: Spark takes pixels that it made itself for few, and would
    gather them at the driver to broadcast them.
    """
    return labels.join(mapping.hint("shuffle_hash"), "label").select(*YX, F.col("to").alias("label")).where("label <> 0")


def touching_border(labels: DataFrame, size: tuple[int, int]) -> DataFrame:
    edge = (F.col("y") == 0) | (F.col("y") == size[0] - 1) | (F.col("x") == 0) | (F.col("x") == size[1] - 1)
    return labels.where(edge).select("label").distinct()


def clear_border(labels: DataFrame, size: tuple[int, int]) -> DataFrame:
    return drop(labels, touching_border(labels, size))


def numbered(objects: DataFrame, order: str = "label") -> DataFrame:
    """(label, to): dense numbers from 1 in the order of ``order``.

    Objects are ranged into parts by ``order``; numbers within a part follow from a window over it, and the parts'
    counts, a row each, give the offsets. No task sees all objects.
    """
    ranged = objects.select("label", order).distinct().repartitionByRange(order).withColumn("part", F.spark_partition_id()) if order != "label" else objects.select("label").distinct().repartitionByRange("label").withColumn("part", F.spark_partition_id())
    ranged = ranged.checkpoint() if ranged.sparkSession.sparkContext.getCheckpointDir() else ranged.persist()
    local = ranged.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(order)))
    sums = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return local.join(F.broadcast(before), "part").select("label", (F.col("k") + F.col("before")).cast("bigint").alias("to"))  # a row for each part


def spots_by_object(labels: DataFrame, spots: DataFrame, bits: int = 16) -> DataFrame:
    """(label, n_spots) for every object, those without a spot included; counts wrap as a store of ``bits`` does."""
    hits = join_pixels(labels.select(*YX, "label"), spots.select(*YX, F.lit(1).alias("hit")), "left")
    return hits.groupBy("label").agg(F.pmod(F.count("hit"), F.lit(1 << bits)).cast("int").alias("n_spots"))
