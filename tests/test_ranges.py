"""TIFF by byte ranges: sparse files beyond 2 GB, crops, levels, codings."""

import struct
import zlib

import numpy as np
import pytest

from tessera.sources import ranges, tiff


def array(px, shape):
    out = np.zeros(shape, np.int64)
    for r in px.collect():
        out[r["y"], r["x"]] = r["v"]
    return out


def packed(data):
    """PackBits, all literal but for runs of one byte."""
    out = b""
    for k in range(0, len(data), 100):
        part = data[k : k + 100]
        out += bytes([257 - len(part)]) + part[:1] if len(set(part)) == 1 and len(part) > 1 else bytes([len(part) - 1]) + part
    return out


def lzw(data):
    """A plain LZW coder, for tests only."""
    out, bits, n = bytearray(), 0, 0

    def put(code, width):
        nonlocal bits, n
        bits, n = bits << width | code, n + width
        while n >= 8:
            n -= 8
            out.append(bits >> n & 255)
            bits &= (1 << n) - 1

    def fresh():
        return {bytes([k]): k for k in range(256)}

    table, width, word = fresh(), 9, b""
    count = 258
    put(256, 9)
    for k in range(len(data)):
        byte = data[k : k + 1]
        if word + byte in table:
            word += byte
            continue
        put(table[word], width)
        table[word + byte] = count
        count += 1
        width = 9 if count < 512 else 10 if count < 1024 else 11 if count < 2048 else 12
        if count >= 4094:
            put(256, width)
            table, count, width = fresh(), 258, 9
        word = byte
    put(table[word], width)
    count += 1
    put(257, 9 if count < 512 else 10 if count < 1024 else 11 if count < 2048 else 12)
    put(0, 7)
    return bytes(out)


def classic(image, coding, code, rows, predictor=1, order="<"):
    """A one-page file of strips."""
    kind = np.dtype(f"{order}u{image.dtype.itemsize}")
    body, spots, sizes = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0)), [], []
    for y in range(0, len(image), rows):
        part = image[y : y + rows]
        if predictor == 2:
            part = np.diff(part, axis=1, prepend=part[:, :1] * 0)
        raw = code(part.astype(kind).tobytes())
        spots.append(len(body))
        sizes.append(len(raw))
        body += raw
    lists = {}
    for name, values in (("spots", spots), ("sizes", sizes)):
        body += b"\0" * (-len(body) % 4)
        lists[name] = len(body) if len(values) > 1 else values[0]
        body += struct.pack(f"{order}{len(values)}I", *values)
    tags = [(256, image.shape[1], 1), (257, len(image), 1), (258, 8 * image.dtype.itemsize, 1), (259, coding, 1), (273, lists["spots"], len(spots)), (278, rows, 1), (279, lists["sizes"], len(sizes)), (317, predictor, 1)]
    struct.pack_into(order + "I", body, 4, len(body))
    body += struct.pack(order + "H", len(tags))
    for tag, value, count in tags:
        body += struct.pack(order + "HHII", tag, 4, count, value)
    return bytes(body + struct.pack(order + "I", 0))


@pytest.mark.parametrize(("coding", "code"), [(1, bytes), (5, lzw), (8, zlib.compress), (32773, packed), (32946, zlib.compress)])
@pytest.mark.parametrize(("kind", "predictor", "order"), [("u1", 1, "<"), ("u2", 2, "<"), ("u2", 1, ">"), ("u4", 2, ">")])
def test_codings(tmp_path, coding, code, kind, predictor, order):
    rng = np.random.default_rng(coding)
    image = (rng.integers(0, 7, (37, 90)) * rng.integers(0, 9000, (37, 1))).astype(kind)
    (tmp_path / "a.tif").write_bytes(classic(image, coding, code, 8, predictor, order))
    source = ranges.TiffReader(str(tmp_path / "a.tif"))
    got = np.zeros(image.shape, np.int64)
    for run in source.partitions():
        for b in source.read(run):
            got[b["y"].to_numpy(), b["x"].to_numpy()] = b["v"].to_numpy()
    assert np.array_equal(got, image)


def test_files_channels_crops_and_levels(spark, tmp_path):
    a = np.random.default_rng(1).integers(0, 60_000, (3, 1500, 1100)).astype(np.uint16)
    path = tmp_path / "a.ome.tif"
    path.write_bytes(tiff.encode(a, tile=256, pixel_sizes=(0.5, 0.65), channel_names=["x", "y", "z"], software="s"))
    px = ranges.read(spark, str(path), [2])
    cut = ranges.read(spark, str(path), [2], rectangle=(1000, 500, 10, 21))
    assert np.array_equal(array(cut, a[1].shape)[1000:1010, 500:521], a[1, 1000:1010, 500:521]) and cut.count() == 210
    assert [r["c"] for r in px.select("c").distinct().collect()] == [1]
    every = ranges.read(spark, str(path))
    both = every.where("c = 0 and y < 9").select("y", "x", "v").join(every.where("c = 2 and y < 9").selectExpr("y", "x", "v as w"), ["y", "x"])
    assert both.count() == 9 * 1100 and all(r["v"] == a[0, r["y"], r["x"]] and r["w"] == a[2, r["y"], r["x"]] for r in both.limit(500).collect())
    small = array(ranges.read(spark, f"file://{path}", [3], level=1), (750, 550))
    assert np.array_equal(small, a[2].astype(int).reshape(750, 2, 550, 2).sum(axis=(1, 3)) // 4)
    said = ranges.metadata(str(path))
    assert (said["width"], said["height"], said["bits"], said["pixel_size_y"], said["channel_names"]) == (1100, 1500, 16, 0.5, ["x", "y", "z"])
    assert said == tiff.metadata(path.read_bytes())
    with pytest.raises(ValueError):
        ranges.reduced(next(ranges.directories(ranges.Reader(str(path)))), 9)
    (tmp_path / "b.tif").write_bytes(b"nothing at all here")
    with pytest.raises(ValueError):
        ranges.metadata(str(tmp_path / "b.tif"))


def test_a_crop_of_a_file_of_six_gigabytes(spark, tmp_path):
    """Two channels of 40,000 x 40,000 16-bit pixels, in tiles of 1,000, of which two are stored, far apart."""
    path, side, tile = tmp_path / "huge.tif", 40_000, 1000
    block = np.arange(tile * tile, dtype="<u2").reshape(tile, tile)
    raw, n = block.tobytes(), (side // tile) ** 2
    with open(path, "wb") as f:
        f.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0))
        at = {}
        for c in (0, 1):
            spots, sizes = [0] * n, [0] * n
            for k, place in ((0, 3 << 30), (n - 1, 6 << 30)):
                if c == 1:
                    f.seek(place)
                    f.write(raw)
                    spots[k], sizes[k] = place, len(raw)
            f.seek(((6 << 30) + (16 << 20)) + (c << 20))
            lists = f.tell()
            f.write(struct.pack(f"<{n}Q", *spots) + struct.pack(f"<{n}Q", *sizes))
            at[c] = f.tell()
            tags = [(256, 4, 1, side), (257, 4, 1, side), (258, 3, 1, 16), (259, 3, 1, 1), (277, 3, 1, 1), (322, 4, 1, tile), (323, 4, 1, tile), (324, 16, n, lists), (325, 16, n, lists + 8 * n)]
            f.write(struct.pack("<Q", len(tags)) + b"".join(struct.pack("<HHQQ", *t) for t in tags))
            f.write(struct.pack("<Q", 0 if c else ((6 << 30) + (16 << 20)) + (1 << 20) + 16 * n))
        f.seek(8)
        f.write(struct.pack("<Q", at[0]))
    assert path.stat().st_size > 6 << 30
    crop = ranges.read(spark, str(path), [2], rectangle=(side - 5, side - 7, 5, 7))
    assert sorted(r["v"] for r in crop.collect()) == sorted(block[-5:, -7:].ravel().tolist())
    source = ranges.TiffReader(str(path), 0, {1}, (side - 5, side, side - 7, side))
    (run,) = source.partitions()
    read = ranges.Reader(str(path))
    assert sum(len(raw) for _, _, raw in ranges.fetched(read, run.parts)) == read.fetched == len(raw)
