"""Map files of nodes, ways and relations in the block format of protocol buffers, as one table.

The driver reads the blocks' headers only; blocks are decoded where they lie, some in each task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "kind string, id long, tags map<string,string>, lon double, lat double, refs array<long>, members array<struct<type:string,ref:long,role:string>>"
_ARROW = pa.schema([
    ("kind", pa.string()), ("id", pa.int64()), ("tags", pa.map_(pa.string(), pa.string())), ("lon", pa.float64()), ("lat", pa.float64()),
    ("refs", pa.list_(pa.int64())), ("members", pa.list_(pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())]))),
])
#: Kinds of members by their number.
KINDS = ["node", "way", "relation"]
#: Blocks of one task, and rows of one batch.
TASK, ROWS = 16, 20_000


def open_store(path: str):
    """(file system, path in it) of a URI or a plain path."""
    return pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields; values are whole numbers or bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        elif key & 7 == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[key & 7]
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = _varint(data, at)
        out.append(v)
    return out


def _signed(values: list[int], running: bool = True) -> list[int]:
    out, total = [], 0
    for v in values:
        v = (v >> 1) ^ -(v & 1)
        total = total + v if running else v
        out.append(total)
    return out


def blocks(path: str) -> list[tuple[int, int]]:
    """Places and sizes of a file's data blocks; only headers are read."""
    files, name = open_store(path)
    out = []
    with files.open_input_file(name) as f:
        at, end = 0, f.size()
        while at < end:
            (size,) = struct.unpack(">I", f.read_at(4, at))
            header = dict(fields(f.read_at(size, at + 4)))
            if header[1] == b"OSMData":
                out.append((at + 4 + size, header[3]))
            at += 4 + size + header[3]
    return out


def decode(blob: bytes) -> Iterator[tuple]:
    """Rows of one block, as in ``SCHEMA``."""
    parts = dict(fields(blob))
    data = parts[1] if 1 in parts else zlib.decompress(parts[3])
    strings, groups, scale, lat0, lon0 = [], [], 100, 0, 0
    for number, value in fields(data):
        if number == 1:
            strings = [v.decode() for n, v in fields(value) if n == 1]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            scale = value
        elif number == 19:
            lat0 = (value ^ (1 << 63)) - (1 << 63)
        elif number == 20:
            lon0 = (value ^ (1 << 63)) - (1 << 63)
    place = lambda v, base: 1e-9 * (base + scale * v)
    tagged = lambda m: [(strings[k], strings[v]) for k, v in zip(_packed(m.get(2, b"")), _packed(m.get(3, b"")))]
    for group in groups:
        for number, value in fields(group):
            m = dict(fields(value))
            if number == 1:
                lat, lon, ident = (_signed([m[k]])[0] for k in (8, 9, 1))
                yield "node", ident, tagged(m), place(lon, lon0), place(lat, lat0), None, None
            elif number == 2:
                pairs, at = _packed(m.get(10, b"")), 0
                for ident, lat, lon in zip(*(_signed(_packed(m[k])) for k in (1, 8, 9))):
                    tags = []
                    while at < len(pairs) and pairs[at]:
                        tags.append((strings[pairs[at]], strings[pairs[at + 1]]))
                        at += 2
                    at += 1
                    yield "node", ident, tags, place(lon, lon0), place(lat, lat0), None, None
            elif number == 3:
                yield "way", m[1], tagged(m), None, None, _signed(_packed(m.get(8, b""))), None
            elif number == 4:
                joined = zip(_packed(m.get(10, b"")), _signed(_packed(m.get(9, b""))), _packed(m.get(8, b"")))
                yield "relation", m[1], tagged(m), None, None, None, [{"type": KINDS[t], "ref": r, "role": strings[s]} for t, r, s in joined]


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """All nodes, ways and relations of a map file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name = open_store(path)
        with files.open_input_file(name) as f:
            for b in batches:
                for at, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    rows = list(decode(f.read_at(size, at)))
                    for lo in range(0, len(rows), ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + ROWS]), _ARROW.types)], schema=_ARROW)

    found = blocks(path)
    return spark.createDataFrame(found, "at long, size long").repartition(max(1, -(-len(found) // TASK))).mapInArrow(run, SCHEMA)
