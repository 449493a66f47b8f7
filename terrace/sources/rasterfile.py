"""Raster files in the tagged image format, as pixel tables: one band, strips or tiles, plain or deflated.

The driver reads the directory of tags; strips and tiles are decoded where they are needed, some in each task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from terrace.sources.mapfile import open_store

#: Sizes and codes of the format's field types, and of its compressions.
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
#: Strips or tiles of one task.
TASK = 16


@dataclass(frozen=True)
class Band:
    """What a file's tags say: shape, place of its pixels, and the pieces that hold them (row, column, offset, bytes)."""

    width: int
    height: int
    piece: tuple[int, int]
    dtype: str
    compression: int
    predictor: int
    nodata: float | None
    origin: tuple[float, float]
    pixel: tuple[float, float]
    pieces: list[tuple[int, int, int, int]]


def open_band(path: str) -> Band:
    files, name = open_store(path)
    with files.open_input_file(name) as f:
        order = {b"II": "<", b"MM": ">"}[f.read_at(2, 0)]
        magic, at = struct.unpack(f"{order}HI", f.read_at(6, 2))
        if magic != 42:
            raise ValueError(f"not a classic tagged image: {path}")
        (count,) = struct.unpack(f"{order}H", f.read_at(2, at))
        tags = {}
        for k in range(count):
            tag, kind, n, raw = struct.unpack(f"{order}HHI4s", f.read_at(12, at + 2 + 12 * k))
            form = f"{order}{n}s" if kind == 2 else f"{order}{n * len(TYPES[kind])}{TYPES[kind][0]}"
            size = struct.calcsize(form)
            data = raw[:size] if size <= 4 else f.read_at(size, struct.unpack(f"{order}I", raw)[0])
            tags[tag] = struct.unpack(form, data)
    width, height = tags[256][0], tags[257][0]
    if tags.get(277, (1,))[0] != 1:
        raise ValueError("more than one band")
    kind = {1: "u", 2: "i", 3: "f"}[tags.get(339, (1,))[0]]
    tiled = 324 in tags
    piece = (tags[323][0], tags[322][0]) if tiled else (min(height, tags.get(278, (height,))[0]), width)
    across = -(-width // piece[1])
    where, sizes = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    scale, tie = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0.0,) * 6)
    nodata = float(tags[42113][0].split(b"\0")[0]) if 42113 in tags else None
    places = [(k // across * piece[0], k % across * piece[1], a, n) for k, (a, n) in enumerate(zip(where, sizes))]
    return Band(width, height, piece, f"{order}{kind}{tags[258][0] // 8}", tags.get(259, (1,))[0], tags.get(317, (1,))[0], nodata, (tie[3], tie[4]), (scale[0], scale[1]), places)


def decode(band: Band, data: bytes) -> np.ndarray:
    """One piece as an array; a strip's last piece may be short."""
    if band.compression in (DEFLATE, OLD_DEFLATE):
        data = zlib.decompress(data)
    elif band.compression != PLAIN:
        raise ValueError(f"compression {band.compression} is not read")
    values = np.frombuffer(data, band.dtype).reshape(-1, band.piece[1])
    if band.predictor == 2:
        return np.cumsum(values, axis=1, dtype=values.dtype)
    if band.predictor != 1:
        raise ValueError(f"predictor {band.predictor} is not read")
    return values


def read_band(spark: SparkSession, path: str, extra_nodata: tuple[float, ...] = ()) -> tuple[DataFrame, Band]:
    """(row, col, value of every pixel, null where there is no data; the band's description)."""
    band = open_band(path)
    missing = {v for v in (band.nodata, *extra_nodata) if v is not None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name = open_store(path)
        with files.open_input_file(name) as f:
            for b in batches:
                for r0, c0, at, size in zip(*(b.column(k).to_pylist() for k in range(4))):
                    values = decode(band, f.read_at(size, at))[: band.height - r0, : band.width - c0]
                    rows, cols = np.indices(values.shape)
                    flat = values.astype(np.float64).ravel()
                    none = ~np.isfinite(flat) | np.isin(flat, list(missing))
                    yield pa.RecordBatch.from_arrays([pa.array((rows + r0).ravel(), pa.int64()), pa.array((cols + c0).ravel(), pa.int64()), pa.array(flat, mask=none)], ["row", "col", "value"])

    places = spark.createDataFrame(band.pieces, "r0 long, c0 long, at long, size long").repartition(max(1, -(-len(band.pieces) // TASK)))
    return places.mapInArrow(run, "row long, col long, value double"), band
