"""The registered queries of the raster operators, each beside its SQL for DuckDB.

Rasters come from whole tables (``sources.fixtures``). Where SQL can't say an operator, the query has none and
the tests hold it against brute force or invariants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import pixel
from .operators import components, frames, neighbourhood, regions, shapes, threshold, tiles
from .operators.frames import YX, join_pixels
from .plans import segment
from .plans.config import LargeConfig, SegmentConfig
from .sources import store
from .sources.fixtures import DUCK, LI_SHAPE, raster

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- pieces of SQL ------------------------------------------------------------------------------------

EMB, LI, EV, BLOB = (f"({DUCK[k]})" for k in ("emb_px", "li_px", "ev_px", "blob_px"))
#: The blobs' image with a gap-free frame: labels and a companion image that overlaps them.
BLOB_WIDTH = 768


def _otsu_sql(source: str, value: str = "v", keys: str = "") -> str:
    part, head, group = (f"PARTITION BY {keys}", f"{keys}, ", f"{keys}, {value}") if keys else ("", "", value)
    pick = f"PARTITION BY {keys} " if keys else ""
    return f"""(SELECT {head}b AS threshold FROM (SELECT {head}b, row_number() OVER ({pick}ORDER BY g*g/(n1*n2) DESC, b) k FROM (
        SELECT {head}b, CAST(s1 AS DOUBLE)*(nn-n1) - CAST(ss-s1 AS DOUBLE)*n1 g, CAST(n1 AS DOUBLE) n1, CAST(nn-n1 AS DOUBLE) n2 FROM (
        SELECT {head}b, sum(n) OVER ({part} ORDER BY b) n1, sum(n*b) OVER ({part} ORDER BY b) s1, sum(n) OVER ({part}) nn, sum(n*b) OVER ({part}) ss FROM (
        SELECT {head}{value} b, count(*) n FROM {source} GROUP BY {group})) WHERE n1 < nn)) WHERE k = 1)"""


def _otsu_bins_sql(source: str, keys: str = "", value: str = "v") -> str:
    head, part, on = (f"{keys}, ", f"PARTITION BY {keys} ", f"USING ({keys})") if keys else ("", "", "ON true")
    return f"""(SELECT {head}t AS threshold FROM (SELECT {head}b, t, row_number() OVER ({part}ORDER BY g*g/(n1*n2) DESC, b) k FROM (
        SELECT {head}b, t, s1*(nn-n1) - (ss-s1)*n1 g, CAST(n1 AS DOUBLE) n1, CAST(nn-n1 AS DOUBLE) n2 FROM (
        SELECT {head}b, t, CAST(sum(n) OVER ({part}ORDER BY b) AS DOUBLE) n1, sum(n*t) OVER ({part}ORDER BY b) s1, CAST(sum(n) OVER ({part}) AS DOUBLE) nn, sum(n*t) OVER ({part}) ss FROM (
        SELECT {head}b, lo + (hi-lo)*(b+0.5::DOUBLE)/256 t, n FROM (SELECT {head}CAST(least(floor(({value}-lo)*256/(hi-lo)), 255) AS INT) b, lo, hi, count(*) n
        FROM {source} p JOIN (SELECT {head}min({value}) lo, max({value}) hi FROM {source} {"GROUP BY " + keys if keys else ""}) e {on} WHERE hi > lo GROUP BY ALL))) WHERE n1 < nn)) WHERE k = 1)"""


def _cc_sql(mask: str, width: int, eight: bool = False) -> str:
    """A parenthesised relation (y, x, label) with the least linear index as label."""
    steps = "(0,1),(1,0),(0,-1),(-1,0)" + (",(1,1),(1,-1),(-1,1),(-1,-1)" if eight else "")
    return f"""(WITH RECURSIVE f AS (SELECT y, x, CAST(y AS BIGINT)*{width}+x id FROM {mask}), o AS (SELECT * FROM (VALUES {steps}) v(dy, dx)),
        r AS (SELECT id root, y, x FROM f UNION SELECT r.root, f.y, f.x FROM r JOIN o ON true JOIN f ON f.y = r.y+o.dy AND f.x = r.x+o.dx)
        SELECT y, x, min(root) AS label FROM r GROUP BY y, x)"""


def _values(weights: list[int]) -> str:
    r = len(weights) // 2
    return "(SELECT * FROM (VALUES " + ",".join(f"({k - r},{w})" for k, w in enumerate(weights)) + ") w(k, w))"


def _conv_sql(source: str, weights: list[int], axis: str, length: str, edge: str, keys: str = "") -> str:
    """Weighted sums along an axis, target by target."""
    at = f"t.{axis} + k.k"
    place = {
        "reflect": f"CASE WHEN {at} < 0 THEN -1-({at}) WHEN {at} >= {length} THEN 2*{length}-1-({at}) ELSE {at} END",
        "nearest": f"least(greatest({at}, 0), {length}-1)",
        "constant": at,
    }[edge]
    other = "x" if axis == "y" else "y"
    k, on = (f"t.{keys}, ", f"AND p.{keys} = t.{keys}") if keys else ("", "")
    return f"(SELECT {k}t.y, t.x, sum(CAST(p.v AS HUGEINT)*k.w) AS v FROM {source} t CROSS JOIN {_values(weights)} k JOIN {source} p ON p.{other} = t.{other} AND p.{axis} = {place} {on} GROUP BY ALL)"


def _sep_sql(source: str, wy: list[int], wx: list[int], size: tuple[str, str], edge: str = "reflect", keys: str = "") -> str:
    return _conv_sql(_conv_sql(source, wx, "x", size[1], edge, keys), wy, "y", size[0], edge, keys)


EMB_SIZE = (f"(SELECT max(y)+1 FROM {EMB})", "64")
LI_SIZE = (str(LI_SHAPE[0]), str(LI_SHAPE[1]))
DISK3 = ",".join(f"({a},{b})" for a, b in neighbourhood.disk(3))
SQUARE = ",".join(f"({a},{b})" for a, b in neighbourhood.square(3))


def _emb(spark: SparkSession, d: str) -> tuple[DataFrame, tuple[int, int]]:
    px = raster(spark, d, "emb_px")
    return px, frames.shape(px)


def _blobs(spark: SparkSession, d: str) -> tuple[DataFrame, tuple[int, int]]:
    """Labels ``lab`` as label, with their own image v."""
    px = raster(spark, d, "blob_px").withColumnRenamed("lab", "label")
    return px, (frames.shape(px)[0], BLOB_WIDTH)


# -- scans, selection, element-wise -------------------------------------------------------------------


@query(f"SELECT y, x, v FROM {LI} WHERE c = 1")
def s1_channel_select(spark, d):
    return frames.channel(raster(spark, d, "li_px"), 2).select("y", "x", "v")


@query(f"SELECT c, y, x, v FROM {LI}")
def s2_stack_read(spark, d):
    return raster(spark, d, "li_px")


@query(f"SELECT y, x, v AS center, 255-v AS contour FROM {EMB}")
def s3_pair_read(spark, d):
    px = raster(spark, d, "emb_px")
    return frames.pair(px, px.withColumn("v", pixel.invert(F.col("v"))))


@query(f"SELECT c, y, x, v FROM {LI} WHERE c < 2")
def s4_level_channels(spark, d):
    path = store.scratch(spark, "image")
    store.write_pyramid(raster(spark, d, "li_px"), path, LI_SHAPE)
    return store.read_pyramid(spark, path, 0, [1, 2]).select("c", "y", "x", "v")


@query(f"SELECT CAST(floor(y/32) AS INT) ty, CAST(floor(x/32) AS INT) tx, count(*) n, CAST(sum(v) AS BIGINT) s FROM {EMB} GROUP BY 1, 2")
def s9_rechunk(spark, d):
    return tiles.rechunk(raster(spark, d, "emb_px"), 32).groupBy("ty", "tx").agg(F.count("*").alias("n"), F.sum("v").alias("s"))


@query(f"SELECT c, CAST(max(x)+1 AS INT) width, CAST(max(y)+1 AS INT) height, CAST(CASE WHEN c = 0 THEN 0.65 ELSE 1 END AS DOUBLE) pixel_size_x FROM {LI} GROUP BY c")
def s10_metadata(spark, d):
    """A store for each channel, of which only the first says how large its pixels are."""
    found = None
    for c in range(3):
        path = store.scratch(spark, "image")
        one = frames.channel(raster(spark, d, "li_px"), c + 1)
        store.write_pyramid(one, path, frames.shape(one), pixel_sizes=(0.65, 0.65) if c == 0 else (None, None))
        meta = store.read_meta(spark, path).select(F.lit(c).alias("c"), "width", "height", "pixel_size_x")
        found = meta if found is None else found.union(meta)
    return found


@query(f"SELECT y, x, 255-v AS v FROM {EMB}")
def p2_invert(spark, d):
    return raster(spark, d, "emb_px").select(*YX, pixel.invert(F.col("v")).alias("v"))


@query(f"SELECT y, x, CAST((m - v - (255-v) + 256) % 256 AS INT) AS v FROM {EMB}, (SELECT max(v) m FROM {EMB})")
def p3_intensity_complement(spark, d):
    return frames.intensity_complement(s3_pair_read(spark, d))


@query(f"SELECT c, y, x, round(log2(v + 1.0::DOUBLE), 6) AS v FROM {LI}")
def p4_log2(spark, d):
    return raster(spark, d, "li_px").select("c", *YX, F.round(pixel.log2p1(F.col("v")), 6).alias("v"))


@query(f"SELECT y, x, round(v/255.0::DOUBLE, 9) AS v FROM {EMB}")
def p5_unit_float(spark, d):
    return raster(spark, d, "emb_px").select(*YX, F.round(pixel.unit(F.col("v")), 9).alias("v"))


@query(f"SELECT y, x, round(sqrt(v*v*1.0::DOUBLE), 6) AS v FROM {EMB}")
def p6_square_root(spark, d):
    v = pixel.nan_to_zero(F.sqrt((F.col("v") * F.col("v")).cast("double")))
    return raster(spark, d, "emb_px").select(*YX, F.round(v, 6).alias("v"))


@query(f"SELECT a.y, a.x, a.v*b.v AS v FROM {LI} a JOIN {LI} b ON a.y = b.y AND a.x = b.x AND a.c = 0 AND b.c = 1 WHERE b.v > 0 AND a.v > 0")
def p7_mask_multiply(spark, d):
    px = raster(spark, d, "li_px")
    a, b = frames.channel(px, 1).where("v > 0"), frames.channel(px, 2).where("v > 0")
    return join_pixels(frames.intersect(a, b).select(*YX, F.col("v").alias("a")), b.select(*YX, F.col("v").alias("b"))).select(*YX, (F.col("a") * F.col("b")).alias("v"))


@query(f"SELECT y, x, max(v) AS v FROM {LI} GROUP BY y, x")
def p8_max_projection(spark, d):
    return frames.max_projection(raster(spark, d, "li_px"))


@query(f"SELECT y, x, CAST(v*1000 % 65536 AS BIGINT) AS u, CAST(CASE WHEN v*1000 % 65536 >= 32768 THEN v*1000 % 65536 - 65536 ELSE v*1000 % 65536 END AS BIGINT) AS s FROM {EMB}")
def p9_wrap(spark, d):
    v = F.col("v") * 1000
    return raster(spark, d, "emb_px").select(*YX, pixel.wrap(v).alias("u"), pixel.as_signed(v).alias("s"))


@query(f"SELECT y, x, round((v-lo)/(hi-lo), 6) AS v FROM {EMB}, (SELECT quantile_cont(v, 0.1::DOUBLE) lo, quantile_cont(v, 0.9999::DOUBLE) hi FROM {EMB})")
def p10_normalise(spark, d):
    return frames.percentile_normalise(raster(spark, d, "emb_px")).withColumn("v", F.round("v", 6))


RESCALE = "CAST(CASE WHEN hi > lo THEN floor(least(greatest((v-lo)/(hi-lo), 0.0::DOUBLE), 1.0::DOUBLE)*255) ELSE 0 END AS INT)"


@query(f"SELECT y, x, {RESCALE} AS v FROM (SELECT y, x, CAST(v AS DOUBLE) v, lo, hi FROM {EMB}, (SELECT quantile_cont(v, 0.001::DOUBLE) lo, quantile_cont(v, 0.999::DOUBLE) hi FROM {EMB}))")
def p11_rescale(spark, d):
    return frames.percentile_rescale(raster(spark, d, "emb_px"), 0.1, 99.9)


@query(f"SELECT y, x, CASE WHEN v > 127 THEN 255 ELSE 0 END AS v FROM {EMB}")
def p12_flag(spark, d):
    return raster(spark, d, "emb_px").select(*YX, pixel.flag(F.col("v") > 127).alias("v"))


@query(f"SELECT 0 AS c, y, x, v FROM {LI} WHERE c = 2 UNION ALL SELECT 1, y, x, v FROM {LI} WHERE c = 0")
def p13_stack(spark, d):
    px = raster(spark, d, "li_px")
    return frames.stack(frames.channel(px, 3).drop("c"), frames.channel(px, 1).drop("c"))


@query(f"""WITH a AS (SELECT y, x FROM {LI} WHERE c = 0 AND v > 60), b AS (SELECT y, x FROM {LI} WHERE c = 1 AND v > 60)
    SELECT 'union' AS kind, y, x FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'minus', y, x FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def p14_mask_algebra(spark, d):
    px = raster(spark, d, "li_px")
    a, b = (frames.mask(frames.channel(px, n), F.col("v") > 60) for n in (1, 2))
    return frames.union(a, b).select(F.lit("union").alias("kind"), *YX).union(frames.subtract(a, b).select(F.lit("minus").alias("kind"), *YX))


@query(f"SELECT y, x, CASE WHEN v < 100 THEN m+1 ELSE v END AS v FROM {EMB}, (SELECT max(v) m FROM {EMB})")
def p15_overwrite(spark, d):
    px = raster(spark, d, "emb_px")
    top = px.agg(F.max("v").alias("top"))
    return px.join(F.broadcast(top)).select(*YX, F.when(F.col("v") < 100, F.col("top") + 1).otherwise(F.col("v")).alias("v"))  # one row


# -- filters and crops --------------------------------------------------------------------------------


@query(f"SELECT y, x, v FROM {EMB} WHERE y >= 10 AND y < 210 AND x >= 5 AND x < 45")
def f1_crop(spark, d):
    return frames.crop(raster(spark, d, "emb_px"), 10, 5, 200, 40)


@query(f"SELECT y, x, v FROM {LI} WHERE c = 0 AND y >= 119 AND y < 238 AND x >= 17 AND x < 34")
def f2_autocrop(spark, d):
    px = frames.channel(raster(spark, d, "li_px"), 1).drop("c")
    return frames.crop(px, *frames.auto_rectangle(*frames.shape(px)))


@query(f"SELECT y, x, v FROM {EMB} WHERE v > (SELECT threshold FROM {_otsu_sql(EMB)})")
def f4_above_otsu(spark, d):
    px = raster(spark, d, "emb_px")
    return px.join(F.broadcast(threshold.otsu_integers(px))).where("v > threshold").select(*YX, "v")  # one row


@query(f"SELECT y, x FROM {EMB} WHERE v > (SELECT max(v)*0.8::DOUBLE FROM {EMB})")
def f5_core_mask(spark, d):
    return frames.core_mask(raster(spark, d, "emb_px"))


@query(f"SELECT y, x, v FROM {LI} WHERE c = 2 AND v > 0")
def f15_foreground(spark, d):
    return frames.channel(raster(spark, d, "li_px"), 3).where("v > 0").select(*YX, "v")


#: The blobs' companion image: brighter to the right.
COMPANION = f"(SELECT lab AS label, y, x, (v + x) % 256 AS v FROM {BLOB})"


def _companion(spark, d):
    labels, size = _blobs(spark, d)
    return labels.select(*YX, "label"), labels.select(*YX, ((F.col("v") + F.col("x")) % 256).alias("v")), size


OBJECTS = f"""(SELECT label, count(*) area, CAST(min(y) AS INT) y0, CAST(max(y)+1 AS INT) y1, CAST(min(x) AS INT) x0, CAST(max(x)+1 AS INT) x1, CAST(sum(v) AS BIGINT) sum_intensity, avg(v) mean_intensity, max(v) max_intensity
    FROM {COMPANION} GROUP BY label)"""


@query(f"SELECT label, area, y0, y1, x0, x1, sum_intensity, round(mean_intensity, 6) AS mean_intensity, max_intensity FROM {OBJECTS}")
def a1_region_props(spark, d):
    labels, image, _ = _companion(spark, d)
    return regions.measure(labels, image).withColumn("mean_intensity", F.round("mean_intensity", 6))


def _keep(condition):
    def f(spark, d):
        labels, image, _ = _companion(spark, d)
        return regions.keep(labels, regions.measure(labels, image).where(condition)).select(*YX, "label")

    return f


def _keep_sql(condition: str) -> str:
    return f"SELECT y, x, label FROM {COMPANION} WHERE label IN (SELECT label FROM {OBJECTS} WHERE {condition})"


@query(_keep_sql("area > 75 AND area < 149"))
def f6_area_exclusive(spark, d):
    return _keep(regions.area_between(75, 149))(spark, d)


@query(_keep_sql("area >= 69 AND area < 149"))
def f7_area_inclusive(spark, d):
    return _keep(regions.area_from(69, 149))(spark, d)


@query(_keep_sql(f"mean_intensity > (SELECT threshold FROM {_otsu_bins_sql(OBJECTS, value='mean_intensity')})"))
def f8_intensity_otsu(spark, d):
    labels, image, _ = _companion(spark, d)
    objects = regions.measure(labels, image)
    limit = threshold.otsu_bins(objects, column="mean_intensity")
    return regions.keep(labels, objects.join(F.broadcast(limit)).where("mean_intensity > threshold")).select(*YX, "label")  # one row


@query(_keep_sql("mean_intensity >= 120"))
def f9_intensity_min(spark, d):
    return _keep(F.col("mean_intensity") >= 120)(spark, d)


@query(_keep_sql("mean_intensity < 120 AND area > 75 AND area < 149"))
def f10_intensity_max(spark, d):
    return _keep((F.col("mean_intensity") < 120) & regions.area_between(75, 149))(spark, d)


@query(f"SELECT y, x, lab AS label FROM {BLOB} WHERE lab IN (SELECT lab FROM {BLOB} WHERE v > 250 AND x % 2 = 0)")
def f12_with_nucleus(spark, d):
    labels, _ = _blobs(spark, d)
    hits = labels.where("v > 250 and x % 2 = 0").select("label").distinct()
    return regions.keep(labels, hits).select(*YX, "label")


#: The blobs' image without a margin of ten pixels, which cuts the outermost blobs.
CROPPED = f"(SELECT y-10 AS y, x-10 AS x, lab AS label, h-21 AS bottom FROM {BLOB}, (SELECT max(y)+1 AS h FROM {BLOB}) WHERE y >= 10 AND y < h-10 AND x >= 10 AND x < {BLOB_WIDTH - 10})"


@query(f"SELECT y, x, label FROM {CROPPED} WHERE label NOT IN (SELECT label FROM {CROPPED} WHERE y IN (0, bottom) OR x IN (0, {BLOB_WIDTH - 21}))")
def f13_clear_border(spark, d):
    labels, (h, w) = _blobs(spark, d)
    cut = frames.shift(frames.crop(labels, 10, 10, h - 20, w - 20), -10, -10).select(*YX, "label")
    return regions.clear_border(cut, (h - 20, w - 20)).select(*YX, "label")


@query(f"SELECT y, x, label*10 AS label FROM {COMPANION} WHERE label % 3 = 1")
def j3_label_map(spark, d):
    labels, _, _ = _companion(spark, d)
    mapping = labels.select("label").distinct().select("label", F.when(F.col("label") % 3 == 1, F.col("label") * 10).otherwise(F.lit(0)).alias("to"))
    return regions.relabel(labels, mapping)


@query(f"SELECT a.y, a.x, a.label, b.v FROM {COMPANION} a JOIN {EMB} b ON a.y = b.y AND a.x = b.x")
def j1_aligned_join(spark, d):
    labels, _, _ = _companion(spark, d)
    return join_pixels(labels, raster(spark, d, "emb_px"))


# -- aggregates and thresholds ------------------------------------------------------------------------


@query(f"SELECT v, count(*) AS n FROM {EMB} GROUP BY v")
def a7_count_by_value(spark, d):
    return regions.counts(raster(spark, d, "emb_px"), "v")


@query(f"SELECT c, max(v) AS top, CAST(sum(v) AS BIGINT) AS total, bool_or(v > 200) AS any_bright, bool_and(v < 256) AS all_small FROM {LI} GROUP BY c")
def a8_global_aggregates(spark, d):
    return raster(spark, d, "li_px").groupBy("c").agg(F.max("v").alias("top"), F.sum("v").alias("total"), F.bool_or(F.col("v") > 200).alias("any_bright"), F.bool_and(F.col("v") < 256).alias("all_small"))


@query(f"SELECT threshold FROM {_otsu_sql(EMB)}")
def a9_otsu_integers(spark, d):
    return threshold.otsu_integers(raster(spark, d, "emb_px"))


@query(f"SELECT c, round(threshold, 9) AS threshold FROM {_otsu_bins_sql(LI, 'c')}")
def a9_otsu_bins(spark, d):
    return threshold.otsu_bins(raster(spark, d, "li_px"), ["c"]).withColumn("threshold", F.round("threshold", 9))


@query(f"SELECT med, median(abs(v - med)) AS mad FROM {EMB}, (SELECT median(v) AS med FROM {EMB}) GROUP BY med")
def a10_median_mad(spark, d):
    return threshold.median_mad(raster(spark, d, "emb_px"))


@query(f"SELECT quantile_cont(v, 0.001::DOUBLE) AS p0, quantile_cont(v, 0.5::DOUBLE) AS p1, quantile_cont(v, 0.999::DOUBLE) AS p2 FROM {EMB}")
def a11_percentiles(spark, d):
    return threshold.percentiles(raster(spark, d, "emb_px"), [0.001, 0.5, 0.999])


@query(f"SELECT quantile_disc(v, 0.5::DOUBLE)::DOUBLE AS p0 FROM {EMB}")
def a12_percentile_sketch(spark, d):
    return threshold.percentiles(raster(spark, d, "emb_px"), [0.5], exact=False)


@query(f"SELECT c, count(*) AS area FROM {LI} WHERE v > 60 GROUP BY c")
def a14_channel_area(spark, d):
    return raster(spark, d, "li_px").where("v > 60").groupBy("c").agg(F.count("*").alias("area"))


@query(f"SELECT CAST(min(y) AS INT) AS y0, CAST(max(y)+1 AS INT) AS y1, CAST(min(x) AS INT) AS x0, CAST(max(x)+1 AS INT) AS x1 FROM {BLOB}")
def a17_extent(spark, d):
    return frames.extent(_blobs(spark, d)[0])


#: Hulls in SQL: at each line of corners the hull reaches as far as any straight line between two lines' ends does, and
#: between lines of corners its sides are straight.
SOLIDITY = f"""(WITH l AS (SELECT lab, y, min(x) AS a, max(x)+1 AS b, count(*) AS n FROM {BLOB} GROUP BY lab, y),
    c AS MATERIALIZED (SELECT lab, t, min(a) AS a, max(b) AS b FROM (SELECT lab, y AS t, a, b FROM l UNION ALL SELECT lab, y+1, a, b FROM l) GROUP BY lab, t),
    e AS (SELECT c.lab, c.t, max(CASE WHEN q.t = p.t THEN p.b ELSE p.b + CAST((q.b-p.b)*(c.t-p.t) AS DOUBLE)/(q.t-p.t) END) - min(CASE WHEN q.t = p.t THEN p.a ELSE p.a + CAST((q.a-p.a)*(c.t-p.t) AS DOUBLE)/(q.t-p.t) END) AS w
        FROM c JOIN c p ON p.lab = c.lab AND p.t <= c.t JOIN c q ON q.lab = c.lab AND q.t >= c.t GROUP BY c.lab, c.t),
    h AS (SELECT lab, sum(w) - (arg_min(w, t) + arg_max(w, t))/2 AS hull FROM e GROUP BY lab)
    SELECT h.lab AS label, CAST(s.area AS BIGINT) AS area, hull, s.area/hull AS solidity FROM h JOIN (SELECT lab, sum(n) AS area FROM l GROUP BY lab) s ON s.lab = h.lab)"""


@query(f"SELECT label, area, round(hull, 6) AS hull, round(solidity, 9) AS solidity FROM {SOLIDITY}")
def a5_solidity(spark, d):
    return shapes.solidity(_blobs(spark, d)[0]).withColumns({"hull": F.round("hull", 6), "solidity": F.round("solidity", 9)})


# -- neighbourhoods -----------------------------------------------------------------------------------

G2, G1, D2 = neighbourhood.gaussian_weights(2.0), neighbourhood.gaussian_weights(1.0), neighbourhood.gaussian_weights(1.0, 2)


@query(f"SELECT y, x, CAST(v AS BIGINT) AS v FROM {_sep_sql(EMB, G2, G2, EMB_SIZE)}")
def w1_gauss_reflect(spark, d):
    px, size = _emb(spark, d)
    return neighbourhood.gaussian(px, 2.0, size)[0]


@query(f"SELECT c, y, x, CAST(v AS BIGINT) AS v FROM {_sep_sql(LI, G1, G1, LI_SIZE, 'nearest', 'c')}")
def w2_gauss_nearest(spark, d):
    return neighbourhood.gaussian(raster(spark, d, "li_px"), 1.0, LI_SHAPE, "nearest")[0]


@query(f"SELECT c, y, x, CAST(v AS BIGINT) AS v FROM {_sep_sql(LI, G1, G1, LI_SIZE, 'reflect', 'c')}")
def w3_gauss_stack(spark, d):
    return neighbourhood.gaussian(raster(spark, d, "li_px"), 1.0, LI_SHAPE)[0]


LOG_EMB = f"(SELECT y, x, CAST(-sum(v) AS BIGINT) AS v FROM (SELECT * FROM {_sep_sql(EMB, D2, G1, EMB_SIZE)} UNION ALL SELECT * FROM {_sep_sql(EMB, G1, D2, EMB_SIZE)}) GROUP BY y, x)"


@query(f"SELECT y, x, v FROM {LOG_EMB}")
def w4_laplacian(spark, d):
    px, size = _emb(spark, d)
    return neighbourhood.laplacian_of_gaussian(px, 1.0, size)


S3 = _sep_sql(EMB, [1, 1, 1], [1, 1, 1], EMB_SIZE)
S3Q = _sep_sql(f"(SELECT y, x, v*v AS v FROM {EMB})", [1, 1, 1], [1, 1, 1], EMB_SIZE)


@query(f"SELECT y, x, CAST(v AS BIGINT) AS v FROM {S3}")
def w5_mean3(spark, d):
    px, size = _emb(spark, d)
    return neighbourhood.sum3(px, size)


@query(f"SELECT y, x, CAST(a.v AS BIGINT) AS s1, CAST(b.v AS BIGINT) AS s2, round(sqrt(CAST(9*b.v - a.v*a.v AS DOUBLE)/72.0::DOUBLE), 6) AS v FROM {S3} a JOIN {S3Q} b USING (y, x)")
def w6_deviation3(spark, d):
    px, size = _emb(spark, d)
    return neighbourhood.deviation3(px, size).withColumn("v", F.round("v", 6))


def _peaks_sql(source: str, size: tuple[str, str]) -> str:
    return f"""(WITH s AS MATERIALIZED (SELECT CAST(y AS INT) y, CAST(x AS INT) x, v FROM {source}), z AS MATERIALIZED (SELECT {size[0]} h, {size[1]} w, min(v) least FROM s),
        t AS (SELECT s.y+o.dy y, s.x+o.dx x, max(s.v) top FROM s CROSS JOIN (SELECT * FROM (VALUES {SQUARE}) v(dy, dx)) o GROUP BY 1, 2)
        SELECT s.y, s.x, s.v FROM s JOIN t ON t.y = s.y AND t.x = s.x CROSS JOIN z WHERE s.v = t.top AND s.v > z.least AND s.y >= 1 AND s.y < z.h-1 AND s.x >= 1 AND s.x < z.w-1)"""


@query(f"SELECT y, x, v FROM {_peaks_sql(EMB, EMB_SIZE)}")
def w7_local_maxima(spark, d):
    px, size = _emb(spark, d)
    return neighbourhood.local_maxima(px, size)


@query(f"SELECT p.y, p.x FROM {BLOB} p CROSS JOIN (SELECT * FROM (VALUES {DISK3}) v(dy, dx)) o JOIN {BLOB} q ON q.y = p.y+o.dy AND q.x = p.x+o.dx GROUP BY ALL HAVING count(*) = {len(neighbourhood.disk(3))}")
def w10_erosion(spark, d):
    return neighbourhood.erode(_blobs(spark, d)[0], 3)


@query(f"""WITH b AS (SELECT y, x, lab FROM {BLOB}) SELECT DISTINCT CAST(b.y+o.dy AS INT) AS y, CAST(b.x+o.dx AS INT) AS x FROM b CROSS JOIN (SELECT * FROM (VALUES (0,1),(1,0),(0,-1),(-1,0)) v(dy, dx)) o
    WHERE NOT EXISTS (SELECT 1 FROM b c WHERE c.y = b.y+o.dy AND c.x = b.x+o.dx) AND b.y+o.dy < (SELECT max(y)+1 FROM b)""")
def w11_boundary(spark, d):
    labels, size = _blobs(spark, d)  # no blob touches another: the background beside them
    return neighbourhood.outer_boundary(labels, size)


DISK4 = ",".join(f"({a},{b})" for a, b in neighbourhood.disk(4))
GROWN = f"""(SELECT y, x, lab AS label, d2 FROM (SELECT b.y+o.dy AS y, b.x+o.dx AS x, b.lab, o.dy*o.dy+o.dx*o.dx AS d2, row_number() OVER (PARTITION BY b.y+o.dy, b.x+o.dx ORDER BY o.dy*o.dy+o.dx*o.dx, b.lab) k
    FROM {BLOB} b CROSS JOIN (SELECT * FROM (VALUES {DISK4}) v(dy, dx)) o) WHERE k = 1 AND y >= 0 AND x >= 0 AND x < {BLOB_WIDTH} AND y < (SELECT max(y)+1 FROM {BLOB}))"""


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, d2 FROM {GROWN}")
def w12_distance_near(spark, d):
    """The whole-image transform, read where a disk of radius 4 reaches, which SQL can state without a cross product."""
    labels, size = _blobs(spark, d)
    return shapes.squared_distance(labels, size).where("d2 <= 16").select(*YX, F.col("d2").cast("int").alias("d2"))


@query(f"""WITH b AS MATERIALIZED (SELECT y, x FROM {BLOB}), h AS (SELECT max(y)+1 h FROM b), g AS MATERIALIZED (SELECT t.y, b.x, min((t.y-b.y)*(t.y-b.y)) AS g FROM h, range(h.h) t(y), b GROUP BY 1, 2)
    SELECT CAST(g.y AS INT) AS y, CAST(u.x AS INT) AS x, CAST(min((u.x-g.x)*(u.x-g.x) + g.g) AS BIGINT) AS d2 FROM g, range({BLOB_WIDTH}) u(x) GROUP BY 1, 2""")
def w12_distance_transform(spark, d):
    labels, size = _blobs(spark, d)
    return shapes.squared_distance(labels, size)


@query(f"SELECT CAST(y/4 AS INT) AS y, CAST(x/4 AS INT) AS x, label FROM (SELECT y, x, lab AS label FROM {BLOB} WHERE y % 4 = 0 AND x % 4 = 0)")
def w13_pyramid_mask(spark, d):
    return frames.stride_half(_blobs(spark, d)[0], 2).select(*YX, "label")


@query(f"SELECT c, CAST(floor(y/2) AS INT) AS y, CAST(floor(x/2) AS INT) AS x, CAST(floor(sum(v)/4) AS INT) AS v FROM {LI} GROUP BY 1, 2, 3")
def w14_pyramid_mean(spark, d):
    return frames.mean_half(raster(spark, d, "li_px"))


HALF = "CAST(floor(y/2) AS INT) AS y, CAST(floor(x/2) AS INT) AS x, CAST(floor(sum(v)/4) AS INT) AS v"


@query(f"""WITH a AS (SELECT c, y, x, v FROM {LI}), b AS (SELECT c, {HALF} FROM a GROUP BY c, floor(a.y/2), floor(a.x/2), 2, 3), e AS (SELECT c, {HALF} FROM b GROUP BY c, floor(b.y/2), floor(b.x/2), 2, 3)
    SELECT 0 AS level, * FROM a UNION ALL SELECT 1, * FROM b UNION ALL SELECT 2, * FROM e""")
def w15_pyramid_levels(spark, d):
    return frames.pyramid(raster(spark, d, "li_px"), 2).select("level", "c", "y", "x", "v")


@query(f"SELECT CAST(t.y AS INT) AS y, CAST(u.x AS INT) AS x, p.v FROM {LI} p JOIN range(537) t(y) ON floor((2*t.y+1)*358/(2*537)) = p.y JOIN range(30) u(x) ON floor((2*u.x+1)*50/(2*30)) = p.x WHERE p.c = 0")
def w16_resize_nearest(spark, d):
    px = frames.channel(raster(spark, d, "li_px"), 1).drop("c")
    return frames.resize_nearest(px, LI_SHAPE, (537, 30)).select(*YX, "v")


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, label FROM {GROWN}")
def l22_expand(spark, d):
    labels, size = _blobs(spark, d)
    return neighbourhood.expand_labels(labels, 4, size)


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, label FROM {GROWN} WHERE d2 <= 16")
def j4_ring(spark, d):
    labels, size = _blobs(spark, d)
    return neighbourhood.ring(labels, 4, size)


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, label FROM {GROWN} WHERE d2 > 0")
def l23_difference(spark, d):
    labels, size = _blobs(spark, d)
    return neighbourhood.difference(neighbourhood.expand_labels(labels, 4, size), labels.select(*YX, "label"))


# -- components and compositions ----------------------------------------------------------------------


@query(f"SELECT y, x, label FROM {_cc_sql(f'(SELECT y, x FROM {EMB} WHERE v >= 140)', 64, True)}")
def l1_components8(spark, d):
    return components.label(raster(spark, d, "emb_px").where("v >= 140"), 64, 2, 128)


@query(f"SELECT y, x, label FROM {_cc_sql(f'(SELECT y, x FROM {EMB} WHERE v >= 140)', 64)}")
def l2_components4(spark, d):
    return components.label(raster(spark, d, "emb_px").where("v >= 140"), 64, 1, 128)


BRIGHT = f"(SELECT y, x, v FROM {BLOB} WHERE v > (SELECT threshold FROM {_otsu_sql(BLOB)}))"


@query(f"""WITH l AS (SELECT y, x, label FROM {_cc_sql(BRIGHT, BLOB_WIDTH)}), o AS (SELECT label, count(*) area, sum(v) total, CAST(min(y) AS INT) y0, CAST(max(y)+1 AS INT) y1, CAST(min(x) AS INT) x0, CAST(max(x)+1 AS INT) x1 FROM l JOIN {BLOB} b USING (y, x) GROUP BY label)
    SELECT dense_rank() OVER (ORDER BY label) AS label, area, CAST(total AS BIGINT) AS sum_intensity, y0, y1, x0, x1 FROM o WHERE area > 40 AND area < 95""")
def m0_blob_objects(spark, d):
    """Otsu threshold, components, measurement, size filter, dense numbers: the objects of an image."""
    px, size = _blobs(spark, d)
    limit = threshold.otsu_integers(px)
    bright = px.join(F.broadcast(limit)).where("v > threshold")  # one row
    objects = regions.measure(components.label(bright, size[1]), px).where(regions.area_between(40, 95))
    named = objects.join(regions.numbered(objects.select("label")), "label")
    return named.select(F.col("to").alias("label"), "area", "sum_intensity", "y0", "y1", "x0", "x1")


@query(f"""WITH k AS (SELECT y, x FROM {BLOB} WHERE lab IN (SELECT lab FROM {BLOB} GROUP BY lab HAVING count(*) > 75 AND count(*) < 150)), l AS (SELECT * FROM {_cc_sql('k', BLOB_WIDTH)})
    SELECT y, x, dense_rank() OVER (ORDER BY label) AS label FROM l""")
def l12_bypass(spark, d):
    labels, size = _blobs(spark, d)
    return segment.nuclei_bypass(labels.select(*YX, "label"), size, SegmentConfig(log_sigma=(10, 200**0.5)))


@query(f"""WITH g AS (SELECT y, x, label FROM {GROWN}), c AS (SELECT y, x, label FROM g WHERE label NOT IN (SELECT label FROM g WHERE y IN (0, (SELECT max(y) FROM {BLOB})) OR x IN (0, {BLOB_WIDTH - 1}))),
    l AS (SELECT * FROM {_cc_sql('(SELECT y, x FROM c)', BLOB_WIDTH)}), n AS (SELECT y, x, dense_rank() OVER (ORDER BY label) AS label FROM l)
    SELECT CAST(n.y AS INT) AS y, CAST(n.x AS INT) AS x, n.label, CASE WHEN b.v IS NULL THEN 'cyto' ELSE 'nucleus' END AS part FROM n LEFT JOIN {BLOB} b ON b.y = n.y AND b.x = n.x""")
def l17_cells_from_ring(spark, d):
    """Cell assembly from given basins: rings cleared of the border, numbered, parted into nucleus and cytoplasm."""
    labels, size = _blobs(spark, d)
    cells = segment.ring_cells(labels, 4, size).parted
    return cells.select(*YX, "label", F.when(F.col("nucleus"), "nucleus").otherwise("cyto").alias("part"))


EV_SIZE = (f"(SELECT max(y)+1 FROM {EV})", f"(SELECT max(x)+1 FROM {EV})")
SPOT_PEAKS = f"(SELECT p.y, p.x, p.v FROM {_peaks_sql(LOG_EMB, EMB_SIZE)} p JOIN {EMB} e ON e.y = p.y AND e.x = p.x WHERE e.v > 0)"
SPOTS = f"(WITH k AS MATERIALIZED (SELECT * FROM {SPOT_PEAKS}), m AS MATERIALIZED (SELECT median(v) AS med FROM k), a AS MATERIALIZED (SELECT median(abs(v - med)) AS mad FROM k, m) SELECT y, x FROM k, m, a WHERE v > med + 1.4826::DOUBLE*mad)"


def _spots(spark, d):
    px, size = _emb(spark, d)
    return segment.puncta(px, px, 1.0, 1.0, size)


@query(f"SELECT y, x FROM {SPOTS}")
def l18_puncta(spark, d):
    return _spots(spark, d)


@query(f"SELECT b.lab AS label, CAST(count(s.y) AS INT) AS n_spots FROM {BLOB} b LEFT JOIN {SPOTS} s ON s.y = b.y AND s.x = b.x GROUP BY b.lab")
def a13_spot_counts(spark, d):
    return regions.spots_by_object(_blobs(spark, d)[0], _spots(spark, d))


SMOOTH_LI = f"(SELECT c, y, x, round(log2(CAST(v AS DOUBLE)/({float(sum(G1) ** 2)}::DOUBLE*255) + 1.0::DOUBLE), 9) AS v FROM {_sep_sql(LI, G1, G1, LI_SIZE, 'nearest', 'c')})"


@query(f"SELECT DISTINCT p.y, p.x FROM {SMOOTH_LI} p JOIN {_otsu_bins_sql(SMOOTH_LI, 'c')} t ON t.c = p.c WHERE p.v > t.threshold")
def l19_tissue_mask(spark, d):
    return segment.tissue_mask(raster(spark, d, "li_px"), LI_SHAPE)


PLAIN_LI = f"(SELECT c, y, x, round(CAST(v AS DOUBLE)/{float(sum(G1) ** 2)}::DOUBLE, 9) AS v FROM {_sep_sql(LI, G1, G1, LI_SIZE, 'nearest', 'c')})"


@query(f"""WITH core AS (SELECT y, x FROM {LI} WHERE c = 0 AND v > (SELECT max(v)*0.8::DOUBLE FROM {LI} WHERE c = 0)), s AS MATERIALIZED (SELECT * FROM {PLAIN_LI}),
    f AS (SELECT s.c, count(*) area FROM s JOIN {_otsu_bins_sql('s', 'c')} t ON t.c = s.c JOIN core ON core.y = s.y AND core.x = s.x WHERE s.v > t.threshold GROUP BY s.c)
    SELECT -1 AS c, count(*) AS area FROM core UNION ALL SELECT a.c, coalesce(f.area, 0) FROM (SELECT DISTINCT c FROM s) a LEFT JOIN f ON f.c = a.c""")
def l13_pixel_areas(spark, d):
    px = raster(spark, d, "li_px")
    return segment.pixel_areas(frames.channel(px, 1).drop("c"), px, segment.plate_mask(LI_SHAPE, px), LI_SHAPE)


QC_EDGE = """SELECT DISTINCT CAST(b.y+o.dy AS INT) AS y, CAST(b.x+o.dx AS INT) AS x FROM b CROSS JOIN (SELECT * FROM (VALUES (0,1),(1,0),(0,-1),(-1,0)) v(dy, dx)) o
    WHERE NOT EXISTS (SELECT 1 FROM b e WHERE e.y = b.y+o.dy AND e.x = b.x+o.dx)"""


@query(f"""WITH b AS (SELECT y, x FROM {LI} WHERE c = 0 AND v > 120), e AS ({QC_EDGE}), i AS (SELECT * FROM {LI}),
    q AS (SELECT c, quantile_cont(v, 0.001::DOUBLE) lo, quantile_cont(v, 0.999::DOUBLE) hi FROM i GROUP BY c)
    SELECT 0 AS c, i.y, i.x, CASE WHEN e.y IS NULL THEN 0 ELSE 255 END AS v FROM i LEFT JOIN e ON e.y = i.y AND e.x = i.x WHERE i.c = 1
    UNION ALL SELECT 1, y, x, v FROM i WHERE c = 1
    UNION ALL SELECT CASE WHEN c = 0 THEN 3 ELSE 2 END, y, x, {RESCALE} FROM (SELECT i.c, y, x, CAST(v AS DOUBLE) v, lo, hi FROM i JOIN q ON q.c = i.c WHERE i.c IN (0, 2))""")
def k7_qc_stack(spark, d):
    px = raster(spark, d, "li_px")
    labels = frames.channel(px, 1).where("v > 120").select(*YX, F.lit(1).alias("label"))
    return segment.qc_stack(labels, frames.channel(px, 2).drop("c"), px, [3, 1], LI_SHAPE)


@query(f"SELECT y, x, v FROM {EMB}")
def t5_tile_roundtrip(spark, d):
    px, size = _emb(spark, d)
    return tiles.tiled_views(px, 48, 12, size)


@query(f"""SELECT CAST(a.ty AS INT) AS ty, CAST(b.tx AS INT) AS tx, count(*) AS n, CAST(sum(v) AS BIGINT) AS s FROM {EMB} p JOIN (SELECT DISTINCT CAST(y//48 AS INT) FROM {EMB}) a(ty) ON p.y >= a.ty*48-12 AND p.y < (a.ty+1)*48+12 JOIN range(4) b(tx) ON p.x >= b.tx*48-12 AND p.x < (b.tx+1)*48+12
    WHERE a.ty*48 < {EMB_SIZE[0]} AND b.tx*48 < 64 GROUP BY 1, 2""")
def t1_halo_tiles(spark, d):
    px, size = _emb(spark, d)
    return tiles.with_halo(px, 48, 12, size).groupBy("ty", "tx").agg(F.count("*").alias("n"), F.sum("v").alias("s"))


@query(f"SELECT format('{{:10.5f}}', CAST(n AS DOUBLE)) AS line, count(*) OVER () AS lines FROM (SELECT b.lab, count(s.y) AS n FROM {BLOB} b LEFT JOIN {SPOTS} s ON s.y = b.y AND s.x = b.x GROUP BY b.lab)")
def k5_count_lines(spark, d):
    counts = a13_spot_counts(spark, d)
    n = counts.agg(F.count("*").alias("lines"))
    return counts.select(F.format_string("%10.5f", F.col("n_spots").cast("double")).alias("line")).join(F.broadcast(n))  # one row


# -- floods -------------------------------------------------------------------------------------------

CONFIG = SegmentConfig(log_sigma=(3, 30))


def _pmap(spark, d):
    """Touching cells: the blobs grown by four, bright in their middle, the contour map dark there. What growing added has v 0."""
    blobs, size = _blobs(spark, d)
    grid = segment.plate_mask(size, blobs)
    v = F.coalesce("v", F.lit(0))
    pmap = join_pixels(grid, blobs.select(*YX, "v"), "left", size).select(*YX, v.alias("center"), (255 - v).alias("contour"))
    grown = neighbourhood.nearest_label(blobs, 4, size).where("d2 > 0").select(*YX, "label", F.lit(0).alias("v"))
    return pmap, blobs.select(*YX, "label", "v").unionByName(grown), size


#: A peak, higher than ``h``, stays if nothing higher can be reached from it over pixels less than ``h`` below it.
EIGHT = "(VALUES (0,1),(1,0),(0,-1),(-1,0),(1,1),(1,-1),(-1,1),(-1,-1))"


@query(f"""WITH RECURSIVE b AS MATERIALIZED (SELECT y, x, v FROM {BLOB} WHERE v > 0), o AS (SELECT * FROM {EIGHT} t(dy, dx)),
    lower AS (SELECT DISTINCT b.y, b.x FROM b JOIN o ON true JOIN b n ON n.y = b.y+o.dy AND n.x = b.x+o.dx WHERE n.v > b.v),
    s AS (SELECT b.* FROM b ANTI JOIN lower ON lower.y = b.y AND lower.x = b.x),
    r AS (SELECT y AS sy, x AS sx, v AS sv, y, x, v FROM s UNION SELECT r.sy, r.sx, r.sv, b.y, b.x, b.v FROM r JOIN o ON true JOIN b ON b.y = r.y+o.dy AND b.x = r.x+o.dx WHERE r.v <= r.sv AND b.v > r.sv-20)
    SELECT sy AS y, sx AS x FROM r GROUP BY sy, sx HAVING max(v) <= max(sv)""")
def w8_h_maxima(spark, d):
    pmap, _, size = _pmap(spark, d)
    from .operators import kernels

    def kernel(rows, box):
        return tiles.sparse(kernels.h_maxima(tiles.dense(rows, box, "center"), 20).astype("int64"), box)[["y", "x"]]

    return tiles.run(pmap, kernel, "y int, x int", size, 256, 32)


@query()
def l6_watershed(spark, d):
    pmap, labels, size = _pmap(spark, d)
    marks = labels.where("v > 200").select(*YX, "label")
    return segment._basins(pmap.select(*YX, F.col("contour").cast("double").alias("v")), marks, size, 256, 48)


@query()
def l10_nuclei(spark, d):
    pmap, labels, size = _pmap(spark, d)
    return segment.nuclei(pmap, labels.select(*YX, "v"), None, size, CONFIG, 256, 64)


@query()
def l11_nuclei_local(spark, d):
    pmap, _, size = _pmap(spark, d)
    return segment.nuclei_local(pmap, size, CONFIG, 256, 64)


def _cytoplasm(method):
    def f(spark, d):
        _, labels, size = _pmap(spark, d)
        image = labels.select(*YX, "v")  # the centre map, which is 0 elsewhere
        return segment.cytoplasm(labels.where("v > 100").select(*YX, "label"), image, labels, size, CONFIG, method, 256, 64).cell

    return f


@query()
def l14_cyto_distance(spark, d):
    return _cytoplasm("distanceTransform")(spark, d)


@query()
def l15_cyto_hybrid(spark, d):
    return _cytoplasm("hybrid")(spark, d)


@query()
def l16_cyto_ring(spark, d):
    return _cytoplasm("ring")(spark, d)


@query()
def l21_large_chain(spark, d):
    pmap, _, size = _pmap(spark, d)
    return segment.LargeSegmentor(pmap, size, LargeConfig(overlap_size=64, mean_intensity_min=10, area_max=5000), 256).run()


# -- the remaining scans, joins, sinks and older variants ---------------------------------------------


@query(f"SELECT y, x, v FROM {LI} WHERE c = 2")
def s5_one_channel(spark, d):
    path = store.scratch(spark, "image")
    store.write_pyramid(raster(spark, d, "li_px"), path, LI_SHAPE)
    return store.read_pyramid(spark, path, 0, [3]).select(*YX, "v")


@query(f"SELECT y, x, lab AS label FROM {BLOB}")
def s8_mask_read(spark, d):
    return _blobs(spark, d)[0].select(*YX, "label")


@query(_keep_sql("label % 4 = 0"))
def j2_semi_join(spark, d):
    labels, _, _ = _companion(spark, d)
    return regions.keep(labels, labels.select("label").distinct().where("label % 4 = 0")).select(*YX, "label")


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, label FROM {GROWN} WHERE d2 > 0 AND d2 <= 9")
def f14_background_ring(spark, d):
    labels, size = _blobs(spark, d)
    return neighbourhood.nearest_label(labels, 3, size).where("d2 > 0").select(*YX, "label")


@query(f"SELECT y, x, lab AS label FROM {BLOB} WHERE lab IN (SELECT label FROM {SOLIDITY} WHERE solidity > 0.8)")
def f11_solidity(spark, d):
    labels, _ = _blobs(spark, d)
    return regions.keep(labels, shapes.solidity(labels).where("solidity > 0.8")).select(*YX, "label")


@query(f"SELECT lab AS label, y, x FROM {BLOB} WHERE lab IN (SELECT lab FROM {BLOB} GROUP BY lab HAVING count(*) > 100)")
def a6_coordinates(spark, d):
    labels, _ = _blobs(spark, d)
    return regions.keep(labels, regions.measure(labels).where("area > 100")).select("label", *YX)


@query(f"SELECT y, x, v FROM {LI} WHERE c = 0 AND (SELECT bool_or(v > 0) FROM {LI} WHERE c = 0)")
def a16_guard(spark, d):
    px = frames.channel(raster(spark, d, "li_px"), 1).select(*YX, "v")
    return px.join(F.broadcast(px.agg(F.bool_or(F.col("v") > 0).alias("any")))).where("any").drop("any")  # one row


@query()
def w9_h_maxima_tiles(spark, d):
    pmap, _, size = _pmap(spark, d)
    return segment.LargeSegmentor(pmap, size, LargeConfig(overlap_size=32), 256).seeds()


def _linear_sql(axis: str, source: str, old: int, new: int) -> str:
    other = "x" if axis == "y" else "y"
    return f"""(SELECT t.t AS {axis}, p.{other}, sum(p.v*(1 - abs(t.at - p.{axis}))) AS v FROM (SELECT t, least(greatest((t+0.5::DOUBLE)*({old / new!r}::DOUBLE)-0.5::DOUBLE, 0), {old - 1}) AS at FROM range({new}) r(t)) t
        JOIN {source} p ON p.{axis} > t.at - 1 AND p.{axis} < t.at + 1 GROUP BY 1, 2)"""


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, round(v, 6) AS v FROM {_linear_sql('x', _linear_sql('y', f'(SELECT y, x, v FROM {LI} WHERE c = 0)', 358, 89), 50, 12)}")
def w17_resize_linear(spark, d):
    px = frames.channel(raster(spark, d, "li_px"), 1).drop("c")
    return frames.resize_linear(px, LI_SHAPE, (89, 12)).select(*YX, F.round("v", 6).alias("v"))


@query(f"SELECT y, x, label FROM {_cc_sql(f'(SELECT y, x FROM {EMB} WHERE v >= 145)', 64)}")
def l3_components_small_tiles(spark, d):
    return components.label(raster(spark, d, "emb_px").where("v >= 145"), 64, 1, 16)


@query()
def l9_window_kernel(spark, d):
    pmap, labels, size = _pmap(spark, d)
    wide = segment._wide(pmap, labels).select(*YX, "contour", "tissue")
    return tiles.run(wide, segment.seed_kernel(size, 1.0, 1.0, area=regions.area_limits(CONFIG.log_sigma)), "y int, x int", size, 256, 64)


@query(f"SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x FROM (SELECT unnest(range(max(y)+1)) AS y FROM {EMB}), (SELECT unnest(range(max(x)+1)) AS x FROM {EMB})")
def l20_plate_mask(spark, d):
    px, size = _emb(spark, d)
    return segment.plate_mask(size, px)


@query(f"""SELECT CAST(ty AS INT) AS ty, CAST(tx AS INT) AS tx, CAST((least((ty+1)*48+12, h) - greatest(ty*48-12, 0)) * (least((tx+1)*48+12, 64) - greatest(tx*48-12, 0)) AS BIGINT) AS inside
    FROM (SELECT max(y)+1 h FROM {EMB}), (SELECT DISTINCT CAST(y//48 AS INT) FROM {EMB}) a(ty), range(2) b(tx)""")
def t3_padding(spark, d):
    px, size = _emb(spark, d)
    return tiles.with_halo(px, 48, 12, size).groupBy("ty", "tx").agg(F.count("*").alias("inside"))


@query(f"""WITH k AS (SELECT label, row_number() OVER (ORDER BY min(CAST(y AS BIGINT)*{BLOB_WIDTH}+x)) AS n FROM {COMPANION}
        WHERE label IN (SELECT label FROM {OBJECTS} WHERE area > 18.75 AND area < 675 AND mean_intensity > (SELECT threshold FROM {_otsu_bins_sql(OBJECTS, value='mean_intensity')}))
        AND label IN (SELECT label FROM {SOLIDITY} WHERE solidity > 0.8) GROUP BY label)
    SELECT y, x, CAST(n AS BIGINT) AS label FROM {COMPANION} c JOIN k ON k.label = c.label""")
def o2_filter_order(spark, d):
    labels, image, size = _companion(spark, d)
    return segment.legacy_filter(labels, image, (size[0], BLOB_WIDTH), SegmentConfig(log_sigma=(5, 30)))


@query(SQL["l22_expand"].replace(f"FROM {GROWN}", f"FROM {GROWN} g WHERE EXISTS (SELECT 1 FROM {BLOB} t WHERE t.y = g.y AND t.x = g.x AND t.v > 50)"))
def o5_ring_in_tissue(spark, d):
    labels, size = _blobs(spark, d)
    return neighbourhood.ring(labels, 4, size, labels.where("v > 50"))


@query(f"""WITH b AS (SELECT y, x FROM {LI} WHERE c = 0 AND v > 120), e AS ({QC_EDGE}), i AS (SELECT y, x, v FROM {LI} WHERE c = 1)
    SELECT 0 AS c, i.y, i.x, CASE WHEN e.y IS NULL THEN 0 ELSE m END AS v FROM i CROSS JOIN (SELECT max(v) m FROM i) LEFT JOIN e ON e.y = i.y AND e.x = i.x UNION ALL SELECT 1, y, x, v FROM i""")
def k2_outlines(spark, d):
    px = raster(spark, d, "li_px")
    labels = frames.channel(px, 1).where("v > 120").select(*YX, F.lit(1).alias("label"))
    return segment.outlines(labels, frames.channel(px, 2).select(*YX, "v"), LI_SHAPE)


@query(f"SELECT c, format('{{:10.5f}}', CAST(count(*) AS DOUBLE)) AS line FROM {LI} WHERE v > 60 GROUP BY c")
def k4_area_lines(spark, d):
    return a14_channel_area(spark, d).select("c", F.format_string("%10.5f", F.col("area").cast("double")).alias("line"))


@query(f"""WITH s AS ({SQL['l18_puncta']}), b AS (SELECT y, x FROM {EMB} WHERE v > 150), e AS ({QC_EDGE}) SELECT y, x FROM s UNION SELECT y, x FROM e WHERE x >= 0 AND x < 64 AND y >= 0 AND y < {EMB_SIZE[0]}""")
def k6_spots_and_edges(spark, d):
    px, size = _emb(spark, d)
    edges = neighbourhood.outer_boundary(px.where("v > 150").select(*YX, F.lit(1).alias("label")), size)
    return frames.union(_spots(spark, d), edges)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m0_blob_objects(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
