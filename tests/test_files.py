"""Map and raster files, written here byte by byte; polygons."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.functions import geometry
from terrace.operators import polygons
from terrace.sources import mapfile, rasterfile


def varint(v):
    out = b""
    while v > 127:
        out += bytes([v & 127 | 128])
        v >>= 7
    return out + bytes([v])


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def packed(values, signed=False, running=False):
    out, last = b"", 0
    for v in values:
        d = v - last if running else v
        last = v
        out += varint((d << 1) ^ (d >> 63) if signed else d)
    return out


def block(kind, payload, compressed):
    blob = field(2, len(payload)) + field(3, zlib.compress(payload)) if compressed else field(1, payload)
    header = field(1, kind) + field(3, len(blob))
    return struct.pack(">I", len(header)) + header + blob


def test_map_file(spark, tmp_path):
    strings = ["", "shop", "yes", "highway", "primary", "type", "multipolygon", "outer"]
    table = field(1, b"".join(field(1, s.encode()) for s in strings))
    dense = field(1, packed([5, 9, 7], True, True)) + field(8, packed([160_000_000, -50_000_000, 0], True, True)) + field(9, packed([1_080_000_000, 1, -1], True, True)) + field(10, packed([1, 2, 0, 0, 1, 2, 3, 4, 0]))
    way = field(1, 70) + field(2, packed([3])) + field(3, packed([4])) + field(8, packed([5, 9, 5], True, True))
    relation = field(1, 90) + field(2, packed([5])) + field(3, packed([6])) + field(8, packed([7, 0])) + field(9, packed([70, 5], True, True)) + field(10, packed([1, 0]))
    one = table + field(2, field(2, dense)) + field(2, field(3, way))
    two = table + field(2, field(4, relation))
    path = tmp_path / "m.pbf"
    path.write_bytes(block(b"OSMHeader", b"", False) + block(b"OSMData", one, True) + block(b"OSMData", two, False))
    got = {(r.kind, r.id): r for r in mapfile.read_map(spark, str(path)).collect()}
    assert set(got) == {("node", 5), ("node", 9), ("node", 7), ("way", 70), ("relation", 90)}
    assert got["node", 5].tags == {"shop": "yes"} and (round(got["node", 5].lon, 7), round(got["node", 5].lat, 7)) == (108.0, 16.0)
    assert got["node", 9].tags == {} and got["node", 7].tags == {"shop": "yes", "highway": "primary"} and round(got["node", 9].lat, 7) == -5.0
    assert got["way", 70].refs == [5, 9, 5] and got["way", 70].tags == {"highway": "primary"}
    assert [tuple(m) for m in got["relation", 90].members] == [("way", 70, "outer"), ("node", 5, "")]


def tiff(values, tile, deflate, predictor, order="<"):
    h, w = values.shape
    step = (tile, tile) if tile else (3, w)
    pieces = []
    for r in range(0, h, step[0]):
        for c in range(0, w, step[1]):
            part = values[r : r + step[0], c : c + step[1]]
            if tile:
                part = np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1])))
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=part[:, :1] * 0)
            data = part.astype(values.dtype.newbyteorder(order)).tobytes()
            pieces.append(zlib.compress(data) if deflate else data)
    body, at = b"", 8
    places = []
    for p in pieces:
        places.append(at + len(body))
        body += p
    sizes = [len(p) for p in pieces]
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [values.dtype.itemsize * 8]), (259, "H", [8 if deflate else 1])]
    tags += [(322, "I", [tile]), (323, "I", [tile]), (324, "I", places), (325, "I", sizes)] if tile else [(273, "I", places), (278, "I", [3]), (279, "I", sizes)]
    tags += [(317, "H", [predictor]), (339, "H", [kind]), (33550, "d", [10.0, 10.0, 0.0]), (33922, "d", [0, 0, 0, 500.0, 900.0, 0]), (42113, "s", [b"-9\0"])]
    tags.sort()
    ifd_at = 8 + len(body)
    extra_at = ifd_at + 2 + 12 * len(tags) + 4
    entries, extra = b"", b""
    for tag, code, v in tags:
        data = v[0] if code == "s" else struct.pack(f"{order}{len(v)}{code}", *v)
        n = len(data) if code == "s" else len(v)
        kind_no = {"H": 3, "I": 4, "d": 12, "s": 2}[code]
        if len(data) > 4:
            raw = struct.pack(f"{order}I", extra_at + len(extra))
            extra += data
        else:
            raw = data.ljust(4, b"\0")
        entries += struct.pack(f"{order}HHI", tag, kind_no, n) + raw
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, ifd_at)
    return head + body + struct.pack(f"{order}H", len(tags)) + entries + b"\0" * 4 + extra


@pytest.mark.parametrize(("dtype", "tile", "deflate", "predictor", "order"), [("i2", 0, False, 1, "<"), ("f4", 4, True, 1, ">"), ("i4", 4, True, 2, "<"), ("u1", 0, True, 1, "<")])
def test_raster_file(spark, tmp_path, dtype, tile, deflate, predictor, order):
    values = (np.arange(70).reshape(10, 7) % 50).astype(dtype)
    if dtype != "u1":
        values[2, 3] = -9
    path = tmp_path / "r.tif"
    path.write_bytes(tiff(values, tile, deflate, predictor, order))
    frame, band = rasterfile.read_band(spark, str(path), (7.0,))
    got = {(r.row, r.col): r.value for r in frame.collect()}
    want = {(r, c): None if values[r, c] in (-9, 7) else float(values[r, c]) for r in range(10) for c in range(7)}
    assert got == want and (band.origin, band.pixel, band.nodata) == ((500.0, 900.0), (10.0, 10.0), -9.0)


def shapes(spark):
    rows = [("tri", [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]), ("ell", [(0.0, 0.0), (20.0, 0.0), (20.0, 5.0), (5.0, 5.0), (5.0, 20.0), (0.0, 20.0)]), ("shut", [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)])]
    return spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in p]) for n, p in rows], "name string, ring array<struct<x:double,y:double>>")


def test_measures(spark):
    got = {r.name: tuple(r)[1:] for r in shapes(spark).select("name", geometry.area(F.col("ring")), geometry.length(F.col("ring"), True), *geometry.inner_point(F.col("ring"))).collect()}
    assert got["tri"][0] == 50.0 and got["ell"][0] == 175.0 and got["shut"][:2] == (4.0, 8.0) and got["shut"][2:] == (2.0, 2.0)
    assert got["tri"][1] == pytest.approx(20 + 200**0.5)


def test_points_inside_and_on_edges(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 6.0, 6.0), (4, 0.0, 0.0), (5, 4.0, 15.0), (6, -1.0, 3.0), (7, 19.0, 2.0)], "p long, x double, y double")
    got = {(r.p, r.name) for r in polygons.points_in(points, shapes(spark), "p", "name", 4.0).collect()}
    assert got == {(1, "tri"), (1, "ell"), (1, "shut"), (2, "tri"), (2, "ell"), (4, "tri"), (4, "ell"), (5, "ell"), (7, "ell")}


def test_overlaps_conserve_area(spark):
    got = polygons.cell_overlaps(shapes(spark), "name", 3.0).collect()
    total = {}
    for r in got:
        total[r.name] = total.get(r.name, 0) + r.area
        assert 0 < r.area <= 9.0 + 1e-9
    assert {k: round(v, 9) for k, v in total.items()} == {"tri": 50.0, "ell": 175.0, "shut": 4.0}
    assert {(r.col, r.row): round(r.area, 9) for r in got if r.name == "shut"} == {(0, 0): 4.0}
