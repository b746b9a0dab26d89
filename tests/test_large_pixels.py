"""Pixels are neither broadcast nor gathered in few tasks, however few Spark takes them for."""

from tessera.operators import blocks, regions, tiles
from tessera.operators.frames import join_pixels


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_relabelling_broadcasts_no_pixels(spark):
    labels = spark.createDataFrame([(0, 0, 5), (0, 1, 7), (1, 1, 5)], "y int, x int, label bigint")
    got = regions.relabel(labels, spark.createDataFrame([(5, 1), (7, 0)], "label bigint, to bigint"))
    assert "Broadcast" not in plan(got)
    assert sorted(map(tuple, got.collect())) == [(0, 0, 1), (1, 1, 1)]


def test_tiles_are_not_broadcast(spark):
    px = spark.createDataFrame([(0, 0, 5)], "y int, x int, v bigint")
    one, other = (blocks.from_pixels(px.withColumnRenamed("v", n), (4, 4), {n: "<i8"}, 2) for n in "ab")
    assert "Broadcast" not in plan(blocks.joined(one, other).frame)
    assert blocks.to_pixels(blocks.joined(one, other)).where("a = 5 and b = 5").count() == 1


def test_partitions_grow_with_the_image(spark):
    assert tiles.tasks(spark, (100, 100), 50) == 4
    assert tiles.tasks(spark, (768, 270_000), 256, 64) > 6 * tiles.tasks(spark, (768, 40_000), 256, 64) > 100
    px = spark.createDataFrame([(0, 0), (1, 1)], "y int, x int")
    both = join_pixels(px, px, size=(1 << 12, 1 << 12))
    assert sorted(map(tuple, both.collect())) == [(0, 0), (1, 1)]
    assert "hashpartitioning(y" in plan(both) and ", 16)" in plan(both)
