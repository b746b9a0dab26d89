"""Settings, command lines, stores, files, and the driver's contract."""

import glob
import importlib
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import registry
from tessera.operators import frames
from tessera.plans import config, segment
from tessera.plans.config import LargeConfig
from tessera.sources import store, tiff

SF = "/root/testdata/sf0.001"


def test_config_rules():
    assert config.SegmentConfig().log_sigma == (3, 60)
    for bad in ({"crop": "x"}, {"log_sigma": (3,)}, {"crop": "interactiveCrop"}, {"nuclei_filter": "LoG"}, {"cyto_method": "bwdistanceTransform"}):
        with pytest.raises(ValueError):
            config.SegmentConfig(**bad)
    assert config.SegmentConfig().puncta() == []
    assert config.SegmentConfig(puncta_chans=(2, 3), puncta_sigma=(1,), puncta_sd=(4, 5)).puncta() == [(2, 1, 4), (3, 1, 5)]
    with pytest.raises(ValueError):
        config.SegmentConfig(puncta_chans=(2, 3, 4), puncta_sigma=(1, 2)).puncta()


def test_history():
    h = config.History(config.LargeConfig())
    assert h.update() == 0 and h.update(h=0.1) == 1 and h.update(h=0.1) == 1
    assert h.use(0).h == 0.01 and h.update() == 2 and len(h.entries) == 3
    with h.trial(lambda: 1 / 0) as out:
        assert out is None
    with h.trial(lambda: 5) as out:
        assert out == 5
    assert [o for _, o in h.trials] == [None, 5]


def test_command_lines():
    a, c = config.parse_segment(["--imagePath", "i", "--logSigma", "4", "50", "--detectPuncta", "2", "3", "--saveMask", "--segmentCytoplasm", "segmentCytoplasm"])
    assert a.imagePath == "i" and c.log_sigma == (4, 50) and c.puncta_chans == (2, 3) and not c.save_mask and c.save_fig and c.segment_cytoplasm
    p = config.large_parser()
    ignored = config.accept_and_warn(p)
    assert "--crop" in ignored and "--logSigma" in ignored
    a = p.parse_args(["-i", "x", "-o", "y", "--crop", "noCrop", "--area-max", "70"])
    assert a.area_max == 70 and a.h == 0.01 and a.overlap_size == 128 and not hasattr(a, "crop")
    assert config.pixel_size(None, 0.5) == 0.5 and config.pixel_size(2.0, 0.5) == 2.0
    with pytest.raises(ValueError):
        config.pixel_size(None, None, None)
    assert config.channel_from_name("a_ContoursPM_3.tif") == 3 and config.channel_from_name("a.tif") is None
    assert config.output_paths("/o/", "/d/img.ome.tif", 3)["cyto"] == "/o/img/cytoRing.ome.tif"


def test_tissue_channels():
    chans = lambda *a: config.parse_segment(list(a))[1].tissue_chans
    assert chans() == (2, 1) and chans("--CytoMaskChan", "3", "4") == (3, 4, 1)
    assert chans("--TissueMaskChan", "3", "--probMapChan", "2") == (3, 2)


def disc_image():
    """Twelve discs: centre map, contour map and two markers."""
    center = np.zeros((80, 100), int)
    for k in range(12):
        cy, cx = 13 + 25 * (k // 4), 13 + 24 * (k % 4)
        y, x = np.indices(center.shape)
        d = (y - cy) ** 2 + (x - cx) ** 2
        center[d < 49] = (250 - 4 * d - (60 if k == 5 else 0))[d < 49]
    return np.stack([center, 255 - center]).astype(np.uint8), np.stack([center // 2 + 9, (center > 0) * 80 + 5]).astype(np.uint8)


def test_whole_run_from_files(spark, tmp_path):
    from tessera.plans import run

    maps, image = disc_image()
    image[1, 38, 37] = 240
    (tmp_path / "maps.tif").write_bytes(tiff.encode(maps, tile=64))
    (tmp_path / "img.ome.tif").write_bytes(tiff.encode(image, tile=64, pixel_sizes=(0.5, 0.5)))
    out = f"file://{tmp_path}/out"
    run.main_segment(["--imagePath", f"file://{tmp_path}/img.ome.tif", "--stackProbPath", f"file://{tmp_path}/maps.tif", "--outputPath", out, "--logSigma", "3", "30", "--nucleiFilter", "none", "--segmentCytoplasm", "segmentCytoplasm", "--cytoDilation", "3", "--detectPuncta", "2", "--punctaSigma", "1"])
    masks = {n: store.read_pyramid(spark, f"{out}/img/{n}") for n in ("nuclei", "cyto", "cell", "nucleiRing", "cytoRing", "cellRing")}
    assert masks["nucleiRing"].select("v").distinct().count() == 2 == masks["cellRing"].select("v").distinct().count()  # the others' basins reach the border
    assert masks["cytoRing"].join(masks["nucleiRing"], ["y", "x"]).count() == 0
    assert store.read_meta(spark, f"{out}/img/nuclei").first()["pixel_size_x"] == 0.5
    lines = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/out/numSpots_chan2.csv/part-*")).split()
    assert len(lines) >= 11 and sum(float(x.strip('"')) for x in lines) >= 1
    assert store.read_pyramid(spark, f"{out}/img/punctaChan2Outlines").select("c").distinct().count() == 2
    cut = run.whole_image(spark, f"file://{tmp_path}/img.ome.tif", [f"file://{tmp_path}/maps.tif"], f"file://{tmp_path}/crop", config.SegmentConfig(crop="interactiveCrop", rectangle=(0, 0, 40, 100), log_sigma=(3, 30), nuclei_filter="none"))
    assert cut["nuclei"].agg(F.max("y")).first()[0] < 40


@pytest.mark.parametrize("suffix", [".zarr", ""])
def test_large_run_from_files(spark, tmp_path, suffix):
    from tessera.plans import run

    maps, image = disc_image()
    (tmp_path / "maps.tif").write_bytes(tiff.encode(maps, tile=64))
    out = f"file://{tmp_path}/r/nucleiRing{suffix}"
    run.main_large(["-i", f"file://{tmp_path}/maps.tif", "-o", out, "--overlap-size", "16", "--mean-intensity-min", "5", "--area-max", "5000", "--expand-size", "2", "--mcmicro", "--crop", "noCrop"])
    nuclei, cell, cyto = (store.load(spark, f"file://{tmp_path}/r/{n}Ring{suffix}").where("v > 0") for n in ("nuclei", "cell", "cyto"))
    assert nuclei.select("v").distinct().count() >= 12 and cell.count() == nuclei.count() + cyto.count()
    strict = LargeConfig(overlap_size=16, mean_intensity_min=5, area_max=5000)
    px = store.load(spark, f"file://{tmp_path}/maps.tif", numbers=[1, 2])
    chain = segment.LargeSegmentor(frames.pair(px.where("c = 0"), px.where("c = 1")), (80, 100), strict, 40)
    plain = chain.run().count()
    assert chain.configure(area_max=100) == 1 and chain.trial(chain.run, lambda: chain.run().count()) < plain
    assert chain.use(0).area_max == 5000 and chain.trial(lambda: 1 / 0) is None and len(chain.history.trials) == 2
    other = chain.pmap.where("x < 50")
    assert chain.trial(lambda: chain.pmap.count(), pmap=other) == other.count() and chain.pmap.count() == 8000


def test_wrapper_run(spark, tmp_path):
    from tessera.plans import run

    maps, image = disc_image()
    for name, a in (("maps.zarr", maps), ("img.zarr", image)):
        rows = [(c, y, x, int(a[c, y, x])) for c in range(2) for y in range(80) for x in range(100)]
        store.save(spark.createDataFrame(rows, "c int, y int, x int, v int"), f"file://{tmp_path}/{name}", (80, 100), pixel_sizes=(0.3, 0.3))
    run.main_wrapper(["--imagePath", f"file://{tmp_path}/img.zarr", "--stackProbPath", f"file://{tmp_path}/maps.zarr", "--probMapChan", "1", "2", "--outputPath", f"file://{tmp_path}/o", "--pixelSize", "0.7", "--overlap-size", "16", "--mean-intensity-min", "5", "--area-max", "5000"])
    qc = store.load(spark, f"file://{tmp_path}/o/img/qc/nucleiRing-qc.ome.tif")
    assert qc.select("c").distinct().count() == 4 and store.described(spark, f"file://{tmp_path}/o/img/qc/nucleiRing-qc.ome.tif")["pixel_sizes"] == (0.7, 0.7)


def test_zarr(spark, tmp_path):
    import json
    import zlib

    a = np.random.default_rng(0).integers(0, 60000, (2, 1100, 40))
    px = spark.createDataFrame([(c, int(y), int(x), int(a[c, y, x])) for c in range(2) for y in range(0, 1100, 7) for x in range(40)], "c int, y int, x int, v int")
    store.save(px, f"file://{tmp_path}/a.zarr", (1100, 40), pixel_sizes=(2.0, 3.0), channel_names=["p", "q"])
    back = store.load(spark, f"file://{tmp_path}/a.zarr", numbers=[2])
    want = np.zeros((1100, 40), int)
    want[::7] = a[1, ::7]
    got = np.zeros((1100, 40), int)
    for r in back.collect():
        assert r["c"] == 1
        got[r["y"], r["x"]] = r["v"]
    assert np.array_equal(got, want)
    assert store.described(spark, f"file://{tmp_path}/a.zarr") == {"pixel_sizes": (2.0, 3.0), "channel_names": ["p", "q"], "size": (1100, 40), "bits": 16}
    assert store.load(spark, f"file://{tmp_path}/a.zarr", level=1).count() == 2 * 550 * 20
    for compressor, pack in (({"id": "gzip"}, lambda b: __import__("gzip").compress(b)), (None, bytes), ({"id": "zlib"}, zlib.compress), ({"id": "zstd"}, lambda b: __import__("zstandard").compress(b))):
        other = tmp_path / f"b{(compressor or {}).get('id')}.zarr"
        other.mkdir()
        (other / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": [5, 7], "chunks": [4, 4], "dtype": ">f4", "order": "C", "fill_value": 0, "filters": None, "compressor": compressor}))
        whole = np.arange(64, dtype=">f4").reshape(8, 8)
        for i in (0, 1):
            for j in (0, 1):
                (other / f"{i}.{j}").write_bytes(pack(whole[4 * i : 4 * i + 4, 4 * j : 4 * j + 4].tobytes()))
        assert {(r["y"], r["x"]): r["v"] for r in store.load(spark, f"file://{other}").collect()} == {(y, x): float(8 * y + x) for y in range(5) for x in range(7)}
    with pytest.raises(ValueError):
        store.load(spark, f"file://{tmp_path}/none.zarr")


def test_tiff_file(spark, tmp_path):
    a = (np.arange(3 * 90 * 70).reshape(3, 90, 70) % 4001).astype(np.uint16)
    data = tiff.encode(a, tile=32, pixel_sizes=(0.5, 0.65), channel_names=["x", "y", "z"], software="s")
    assert all(np.array_equal(tiff.page_array(data, p), a[i]) for i, p in enumerate(tiff.pages(data)))
    assert tiff.metadata(data) == {"width": 70, "height": 90, "bits": 8 * a.itemsize, "unit": "µm", "software": "s", "channel_names": ["x", "y", "z"], "pixel_size_x": 0.65, "pixel_size_y": 0.5}
    (tmp_path / "a.tif").write_bytes(data)
    px = store.load(spark, f"file://{tmp_path}/a.tif", numbers=[2])
    assert px.count() == 90 * 70 and px.agg(F.sum("v")).first()[0] == int(a[1].sum()) and px.select("c").distinct().first()[0] == 1
    tiff.write(px.withColumn("c", F.lit(0)), f"file://{tmp_path}/out", (90, 70))
    back = tiff.read(spark, glob.glob(f"{tmp_path}/out/part-*")[0])
    assert back.exceptAll(px.withColumn("c", F.lit(0)).select(F.element_at(F.split(F.lit(glob.glob(f"{tmp_path}/out/part-*")[0]), "/"), -1).alias("image_id"), "c", "y", "x", "v")).count() == 0
    with pytest.raises(ValueError):
        next(tiff.pages(b"nothing"))


def test_tiff_strips_and_order():
    import struct

    a = np.arange(12, dtype=">u2").reshape(3, 4)
    tags = [(256, 3, 4), (257, 3, 3), (258, 3, 16), (259, 3, 1), (273, 4, 8), (277, 3, 1), (278, 3, 3), (279, 4, 24)]
    body = struct.pack(">2sHI", b"MM", 42, 32) + a.tobytes() + struct.pack(">H", len(tags))
    for tag, kind, value in tags:
        body += struct.pack(">HHI", tag, kind, 1) + (struct.pack(">HH", value, 0) if kind == 3 else struct.pack(">I", value))
    page = next(tiff.pages(body + struct.pack(">I", 0)))
    assert np.array_equal(tiff.page_array(body, page), a)


def test_store(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 99, (40, 50))
    px = spark.createDataFrame([(c, y, x, int(a[y, x]) + c) for c in (0, 1) for y in range(40) for x in range(50)], "c int, y int, x int, v int")
    path = f"file://{tmp_path}/img"
    store.write_pyramid(px, path, (40, 50), channel_names=["a", "b"], pixel_sizes=(2.0, 3.0))
    assert store.read_pyramid(spark, path, 0, [2]).select("c", "y", "x", "v").exceptAll(px).count() == 0
    plan = store.read_pyramid(spark, path, 0, [2])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "c#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    meta = store.read_meta(spark, path).first()
    assert (meta["width"], meta["pixel_size_x"], meta["channel_names"]) == (50, 3.0, ["a", "b"])
    with pytest.raises(ValueError):
        store.write_pyramid(px, path, (40, 50), units=("cubit", "µm"))
    store.append_channels(px, f"file://{tmp_path}/crop", [1, 2], (5, 5, 10, 10))
    assert spark.read.parquet(f"file://{tmp_path}/crop").count() == 200
    counts = spark.createDataFrame([(3, 7), (1, 0), (2, 5)], "label bigint, n_spots int")
    folder = store.counts_csv(counts, f"file://{tmp_path}", 2)
    lines = "".join(open(f).read() for f in sorted(glob.glob(folder.removeprefix("file://") + "/part-*")))
    assert [float(x.strip('"')) for x in lines.split()] == [0, 5, 7]
    labels = px.where("c = 0 and v > 60").select("y", "x", F.lit(1).cast("bigint").alias("label"))
    store.export_masks(labels, px.where("c = 0").select("y", "x", "v"), f"file://{tmp_path}/masks", "nuclei", (40, 50))
    assert store.read_pyramid(spark, f"file://{tmp_path}/masks/nuclei").count() == labels.count()
    assert store.read_pyramid(spark, f"file://{tmp_path}/masks/qc/nucleiOutlines").count() == 2 * 40 * 50


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_text_operators(monkeypatch):
    import __spark_entry__ as entry

    for name in [n for n in sys.modules if n.startswith("tessera.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tessera.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(entry)
    assert set(bare.queries()) == set(registry.queries())
    monkeypatch.undo()
    importlib.reload(entry)


FAST = ["m0_blob_objects", "a9_otsu_bins", "w6_deviation3", "l23_difference", "k7_qc_stack", "l2_components4", "f8_intensity_otsu", "w16_resize_nearest", "l19_tissue_mask", "t1_halo_tiles"]


@pytest.mark.parametrize("name", FAST)
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("supplier", "lineitem", "events", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    relation = con.execute(f"select {', '.join(got.columns)} from ({registry.oracle_sql()[name]})").fetchall()
    clean = lambda row: tuple(round(float(v), 6) if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio") else v for v in row)
    assert sorted(map(clean, got.collect())) == sorted(map(clean, relation))


@pytest.mark.parametrize("suffix", [".zarr", ""])
def test_overwriting_leaves_nothing_behind_and_sizes_are_those_of_the_image(spark, tmp_path, suffix):
    path, schema = f"file://{tmp_path}/mask{suffix}", "y int, x int, v bigint"
    store.save(spark.createDataFrame([(5, 5, 1), (1500, 1500, 2)], schema), path, (2000, 1900), True)
    assert store.load(spark, path).where("v > 0").count() == 2
    store.save(spark.createDataFrame([(5, 5, 1)], schema), path, (2000, 1900), True)
    assert [(r["y"], r["x"], r["v"]) for r in store.load(spark, path).where("v > 0").collect()] == [(5, 5, 1)]
    assert store.described(spark, path)["size"] == (2000, 1900)


def test_a_dark_image_is_on_the_scale_of_its_file(spark, tmp_path):
    from tessera.plans import run

    maps, _ = disc_image()
    dark = np.clip(maps.astype(np.int64), 0, 255) * [[[100]], [[200]]]
    found = []
    for name, top in (("a", 0), ("b", 65_535)):  # one bright pixel in a corner makes no difference
        dark[0, 0, 0] = top
        (tmp_path / f"{name}.tif").write_bytes(tiff.encode(dark.astype(np.uint16), tile=64))
        assert store.described(spark, f"file://{tmp_path}/{name}.tif")["bits"] == 16
        run.main_large(["-i", f"file://{tmp_path}/{name}.tif", "-o", f"file://{tmp_path}/{name}", "--mean-intensity-min", "5", "--area-max", "5000"])
        found.append({(r["y"], r["x"]) for r in store.load(spark, f"file://{tmp_path}/{name}").where("v > 0 and y > 20").collect()})
    assert found[0] == found[1] and found[0]
