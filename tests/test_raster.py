"""Round trips, foreign files and pruned partitions of strip images."""

import struct

import pytest

from silvagrid.sources import raster


def rows(df):
    return sorted(map(tuple, df.select("scene_id", "r", "c", "dn").collect()), key=str)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scans"))
    cells = [(s, r, c, None if (r * c + s) % 11 == 0 else (r * 700 + c * 13 + s) % 65535) for s, h, w in ((0, 37, 21), (3, 1, 1), (7, 64, 5)) for r in range(h) for c in range(w)]
    cells += [(9, r - 5, c - 8, r * c) for r in range(9) for c in range(20)]
    px = spark.createDataFrame(cells, "scene_id int, r int, c int, dn int")
    made = raster.write_strips(px, path, rows=16, columns=10, strip=4).collect()
    assert sum(r["n_px"] for r in made) == len(cells) and len({(r["scene_id"], r["r"], r["c"]) for r in made}) == len(made) > 10
    return path, px


def test_round_trip(spark, archive):
    path, px = archive
    assert [(r, c) for s, r, c, _ in rows(raster.read_strips(spark, path)) if s == 3] == [(0, 0)]
    # pieces are rectangles: all cells of these scenes are there
    assert rows(raster.read_strips(spark, path)) == rows(px)
    assert rows(raster.read_strips(spark, f"file://{path}", 200)) == rows(px)


def test_filter_prunes_partitions(spark, archive):
    path, px = archive
    every = raster.read_strips(spark, path)
    for where in ("scene_id = 7", "scene_id in (3, 9)", "scene_id = 7 and r > 3", "scene_id = 55"):
        one = raster.read_strips(spark, path).where(where)
        assert rows(one) == rows(px.where(where))
        assert one.rdd.getNumPartitions() < every.rdd.getNumPartitions()
    assert raster.read_strips(spark, path, 200).rdd.getNumPartitions() > every.rdd.getNumPartitions()


@pytest.mark.parametrize("order,bits", [("<", 8), (">", 8), (">", 16)])
def test_other_writers_files(spark, tmp_path, order, bits):
    """Both byte orders, 8 bits, one strip kept in the entry itself, no nodata tag, tags in short form."""
    w, h, kind = 3, 4, "B" if bits == 8 else "H"
    values = [i * 7 % 250 for i in range(w * h)]
    tags = [(256, 3, w), (257, 3, h), (258, 3, bits), (259, 3, 1), (262, 3, 1), (273, 4, 200), (277, 3, 1), (278, 3, h), (279, 4, w * h * bits // 8)]
    head = {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HIH", 42, 8, len(tags))
    for tag, field, v in tags:
        head += struct.pack(order + "HHI", tag, field, 1) + (struct.pack(order + "HH", v, 0) if field == 3 else struct.pack(order + "I", v))
    data = (head + struct.pack(order + "I", 0)).ljust(200, b"\0") + struct.pack(f"{order}{w * h}{kind}", *values)
    (tmp_path / "scene-4_r10_c-2.tif").write_bytes(data)
    (tmp_path / "notes.txt").write_text("not an image")
    want = [(4, 10 + i // w, i % w - 2, v) for i, v in enumerate(values)]
    assert rows(raster.read_strips(spark, str(tmp_path))) == sorted(want, key=str)


def test_what_is_not_read(spark, archive, tmp_path):
    path, px = archive
    assert raster.read_strips(spark, str(tmp_path)).count() == 0
    (tmp_path / "scene-1_r0_c0.tif").write_bytes(b"GIF89a and more")
    with pytest.raises(Exception, match="not a TIFF"):
        raster.read_strips(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="between 0 and"):
        raster.write_strips(spark.createDataFrame([(0, 0, 0, 65535)], raster.SCHEMA), str(tmp_path / "x")).collect()
