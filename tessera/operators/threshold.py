"""Thresholds from histograms and order statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best(histogram: DataFrame, value: Column, keys: list[str]) -> DataFrame:
    """The bin with the largest between-class variance, the smallest of ties; ``histogram``: keys, b, n, and value's columns."""
    up = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    s = histogram.withColumn("s", F.col("n") * value)
    s = s.withColumns({"n1": F.sum("n").over(up), "s1": F.sum("s").over(up), "nn": F.sum("n").over(whole), "ss": F.sum("s").over(whole)})
    n1, n2 = F.col("n1").cast("double"), (F.col("nn") - F.col("n1")).cast("double")
    gap = F.col("s1") * n2 - (F.col("ss") - F.col("s1")) * n1
    rated = s.where("n1 < nn").select(*keys, value.alias("t"), "b", (gap * gap / (n1 * n2)).alias("between"))
    return rated.groupBy(*keys).agg(F.max_by("t", F.struct("between", -F.col("b"))).alias("threshold")).where("threshold is not null")


def otsu_integers(px: DataFrame, keys: list[str] | None = None, column: str = "v") -> DataFrame:
    """Otsu's threshold of integer values, one bin each; rows of ``keys`` with it. Constant input has none.

    The pixels shrink to a histogram before anything is ordered, so the window sees distinct values only.
    """
    keys = keys or []
    h = px.groupBy(*keys, F.col(column).alias("b")).agg(F.count("*").alias("n"))
    return _best(h, F.col("b"), keys)


def otsu_bins(px: DataFrame, keys: list[str] | None = None, column: str = "v", bins: int = 256) -> DataFrame:
    """Otsu's threshold of real values over equal bins between their ends; the threshold is a bin's centre."""
    keys = keys or []
    ends = px.groupBy(*keys).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    joined = px.join(F.broadcast(ends), keys) if keys else px.join(F.broadcast(ends))  # a row for each key
    at = F.least(F.floor((F.col(column) - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)).cast("int")
    h = joined.where("hi > lo").groupBy(*keys, at.alias("b"), "lo", "hi").agg(F.count("*").alias("n"))
    centre = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("b") + 0.5) / bins
    return _best(h, centre, keys)


def exact_median(px: DataFrame, column: str = "v") -> DataFrame:
    """One row: the exact median, found by ranks.

    Values shrink to counts and are dealt by ranges; a part's counts, a row each, give its first rank, and only the parts'
    windows order anything. No task sees all distinct values, however many there are.
    """
    counts = px.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("b")).agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("b").withColumn("part", F.spark_partition_id())
    ranged = ranged.checkpoint() if ranged.sparkSession.sparkContext.getCheckpointDir() else ranged.persist()
    sums = ranged.groupBy("part").agg(F.sum("n").alias("sum"))
    ends = Window.orderBy("part")
    before = sums.select("part", (F.sum("sum").over(ends) - F.col("sum")).alias("before"), F.sum("sum").over(Window.partitionBy()).alias("all"))
    inside = Window.partitionBy("part").orderBy("b")
    placed = ranged.join(F.broadcast(before), "part")  # a row for each part
    placed = placed.withColumn("last", F.col("before") + F.sum("n").over(inside)).withColumn("first", F.col("last") - F.col("n"))
    low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    mine = lambda at: F.max(F.when((F.col("first") <= at) & (at < F.col("last")), F.col("b").cast("double")))
    return placed.agg(((mine(low) + mine(high)) / 2).alias("med"))


def median_mad(px: DataFrame, column: str = "v") -> DataFrame:
    """One row: the median, and the median absolute deviation from it."""
    med = exact_median(px, column)
    away = px.join(F.broadcast(med)).select(F.abs(F.col(column) - F.col("med")).alias("away"))  # one row
    return med.join(F.broadcast(exact_median(away, "away").withColumnRenamed("med", "mad")))  # one row


def percentiles(px: DataFrame, shares: list[float], column: str = "v", exact: bool = True) -> DataFrame:
    """One row, p0, p1, ...: exact and interpolated, or from a sketch.

    The exact ones keep a count for each distinct value in one task, which suits stored images of up to 16 bits.
    """
    f = (lambda s: F.percentile(column, s)) if exact else (lambda s: F.percentile_approx(column, s, 10_000).cast("double"))
    return px.agg(*[f(s).alias(f"p{i}") for i, s in enumerate(shares)])
