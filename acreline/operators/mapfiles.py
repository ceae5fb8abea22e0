"""Files for maps: FlatGeobuf, and vector tiles in one archive.

Both take shapes in degrees (``sinks.for_map``). Features and tiles are
encoded by tasks; a file is one stream of their bytes, so the driver copies
them through, one at a time.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import struct
import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreline.functions import geometry as g
from acreline.runtime import stored

# --- FlatGeobuf -----------------------------------------------------------

MAGIC = b"fgb\x03fgb\x00"
_SCALARS = {"u8": ("<B", 1), "u16": ("<H", 2), "i32": ("<i", 4), "u64": ("<Q", 8)}
#: Spark type -> (column type of the format, struct format of a value)
_COLUMNS = {T.BooleanType: (2, "<?"), T.ShortType: (3, "<h"), T.IntegerType: (5, "<i"), T.LongType: (7, "<q"), T.FloatType: (9, "<f"), T.DoubleType: (10, "<d"), T.StringType: (11, None)}
POLYGON, MULTIPOLYGON = 3, 6


def flat(root: dict) -> bytes:
    """A size-prefixed flatbuffer of a table ``{slot: (kind, value)}``.

    Kinds: u8, u16, i32, u64, text, table, tables, or a numpy type for a
    vector. Everything is written after what refers to it.
    """
    out = bytearray(8)

    def align(n: int, ahead: int = 0) -> None:
        out.extend(bytes(-(len(out) + ahead) % n))

    def refer(at: int) -> None:
        struct.pack_into("<I", out, at, len(out) - at)

    def table(fields: dict, at: int) -> None:
        slots = max(fields, default=-1) + 1
        align(8, 4 + 2 * slots)
        places, size = [0] * slots, 4
        for slot, (kind, _) in sorted(fields.items(), key=lambda f: -_SCALARS.get(f[1][0], ("", 4))[1]):
            width = _SCALARS.get(kind, ("", 4))[1]
            size += -size % width
            places[slot] = size
            size += width
        out.extend(struct.pack(f"<HH{slots}H", 4 + 2 * slots, size, *places))
        start = len(out)
        refer(at)
        out.extend(struct.pack("<i", 4 + 2 * slots) + bytes(size - 4))
        for slot, (kind, value) in fields.items():
            here = start + places[slot]
            if kind in _SCALARS:
                struct.pack_into(_SCALARS[kind][0], out, here, value)
            elif kind == "table":
                table(value, here)
            elif kind == "tables":
                align(4)
                refer(here)
                out.extend(struct.pack("<I", len(value)) + bytes(4 * len(value)))
                first = len(out) - 4 * len(value)
                for i, child in enumerate(value):
                    table(child, first + 4 * i)
            else:
                data = value.encode() if kind == "text" else np.ascontiguousarray(value, dtype=kind).tobytes()
                width = 1 if kind == "text" else np.dtype(kind).itemsize
                align(max(4, width), 4)
                refer(here)
                out.extend(struct.pack("<I", len(data) // width) + data + (b"\0" if kind == "text" else b""))

    table(root, 4)
    align(8)
    struct.pack_into("<I", out, 0, len(out) - 4)
    return bytes(out)


def _shape(polygons: list[g.Rings]) -> dict:
    def one(rings: g.Rings) -> dict:
        made: dict = {1: ("<f8", np.concatenate(rings).ravel()), 6: ("u8", POLYGON)}
        if len(rings) > 1:
            made[0] = ("<u4", np.cumsum([len(r) for r in rings]))
        return made

    return {6: ("u8", MULTIPOLYGON), 7: ("tables", [one(p) for p in polygons])}


def _properties(values: list, formats: list[str | None]) -> bytes:
    out = []
    for i, (v, f) in enumerate(zip(values, formats, strict=True)):
        if v is not None:
            raw = v.encode() if f is None else struct.pack(f, v)
            out.append(struct.pack("<H", i) + (struct.pack("<I", len(raw)) if f is None else b"") + raw)
    return b"".join(out)


def write_flatgeobuf(df: DataFrame, path: str, name: str = "fields") -> int:
    """One FlatGeobuf file of multipolygons without a spatial index; the number of features.

    Columns of other types than booleans, numbers and strings are written as
    strings. Rows without a geometry are left out.
    """
    kinds = [(f.name, *_COLUMNS.get(type(f.dataType), (11, None)), type(f.dataType) in _COLUMNS) for f in df.schema if f.name != "geometry"]
    flatrows = df.where("geometry is not null").select(*(F.col(n) if known else F.col(n).cast("string").alias(n) for n, _, _, known in kinds), "geometry")
    formats = [f for _, _, f, _ in kinds]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            *columns, shapes = (c.to_pylist() for c in batch.columns)
            for i, wkb in enumerate(shapes):
                made.append(flat({0: ("table", _shape(g.decode(wkb)[1])), 1: ("<u1", np.frombuffer(_properties([c[i] for c in columns], formats), dtype=np.uint8))}))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["feature"])

    features = stored(flatrows.mapInArrow(encode, "feature binary"), "features")
    n = features.count()
    columns = [{0: ("text", c), 1: ("u8", k)} for c, k, _, _ in kinds]
    header = {0: ("text", name), 2: ("u8", MULTIPOLYGON), 7: ("tables", columns), 8: ("u64", n), 9: ("u16", 0), 10: ("table", {0: ("text", "EPSG"), 1: ("i32", 4326)})}
    with open(path, "wb") as f:
        f.write(MAGIC + flat(header))
        for r in features.toLocalIterator(prefetchPartitions=True):
            f.write(r["feature"])
    return n


# --- vector tiles ---------------------------------------------------------

EXTENT, BUFFER = 4096, 64
MAX_LAT = 85.0511287798
ZOOMS = (4, 12)
#: Smallest box of a feature in an overview, in square units of a tile's extent. The last zoom has all features.
LEAST_UNITS = 16.0


def mercator(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position in the square world map, 0 to 1 from the upper left."""
    s = np.clip(lat, -MAX_LAT, MAX_LAT)
    return (lon + 180) / 360, (1 - np.arcsinh(np.tan(np.radians(s))) / np.pi) / 2


def tile_id(z: int, x: int, y: int) -> int:
    """Number of a tile: all smaller zooms first, then along the Hilbert curve."""
    d, s = (4**z - 1) // 3, 1 << z >> 1
    while s:
        rx, ry = int(x & s > 0), int(y & s > 0)
        d += s * s * ((3 * rx) ^ ry)
        x, y = x & (s - 1), y & (s - 1)
        if not ry:
            if rx:
                x, y = s - 1 - x, s - 1 - y
            x, y = y, x
        s >>= 1
    return d


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def clip_ring(ring: np.ndarray, low: float, high: float) -> np.ndarray:
    """A closed ring cut to the square low..high (Sutherland and Hodgman, 1974); empty if nothing is left."""
    p = ring[:-1]
    for axis in (0, 1):
        for sign, edge in ((1, low), (-1, -high)):
            if not len(p):
                return p
            d = sign * p[:, axis] - edge
            if (d >= 0).all():
                continue
            q, e = np.roll(p, -1, axis=0), np.roll(d, -1)
            inside, crosses = d >= 0, (d >= 0) != (e >= 0)
            t = np.divide(d, d - e, out=np.zeros_like(d), where=crosses)
            both = np.stack([p, p + t[:, None] * (q - p)], axis=1).reshape(-1, 2)
            p = both[np.stack([inside, crosses], axis=1).ravel()]
    return np.concatenate([p, p[:1]]) if len(p) > 2 else p[:0]


def _commands(polygons: list[g.Rings]) -> list[int]:
    """The tile format's geometry commands; outer rings clockwise on the screen."""
    out, at = [], np.zeros(2, dtype=np.int64)
    for rings in polygons:
        for k, ring in enumerate(rings):
            p = np.rint(clip_ring(ring, -BUFFER, EXTENT + BUFFER)).astype(np.int64)
            if len(p):
                p = p[np.concatenate([[True], (np.diff(p, axis=0) != 0).any(axis=1)])]
            a = g.signed_area(p.astype(float)) if len(p) > 3 else 0.0
            if a == 0:
                if k == 0:
                    break  # its holes go with it
                continue
            p = (p if (a > 0) == (k == 0) else p[::-1])[:-1]
            step = np.diff(np.concatenate([at[None], p]), axis=0)
            coded = ((step << 1) ^ (step >> 63)).tolist()
            out += [9, *coded[0], (len(p) - 1) << 3 | 2, *(v for c in coded[1:] for v in c), 15]
            at = p[-1]
    return out


def _tag_value(v: object) -> bytes:
    if isinstance(v, bool):
        return b"\x38" + _varint(int(v))
    if isinstance(v, int):
        return b"\x30" + _varint((v << 1) ^ (v >> 63))
    if isinstance(v, float):
        return b"\x19" + struct.pack("<d", v)
    return _field(1, str(v).encode())


def encode_tile(z: int, x: int, y: int, shapes: list[bytes], rows: list[dict], layer: str, dots: bool = False) -> bytes:
    """A vector tile of version 2 with one layer; empty if no shape is left in it.

    With ``dots`` a shape without area on the tile's grid is a unit square where its middle is.
    """
    keys: dict[str, int] = {}
    values: dict[bytes, int] = {}
    features = []
    for wkb, row in zip(shapes, rows, strict=True):
        placed = []
        for rings in g.decode(wkb)[1]:
            placed.append([np.stack([(u * 2**z - x) * EXTENT, (v * 2**z - y) * EXTENT], axis=1) for u, v in (mercator(r[:, 0], r[:, 1]) for r in rings)])
        geometry = _commands(placed)
        if dots and not geometry:
            low, high = np.split(np.array(g.bounds(placed)), 2)
            at = np.floor((low + high) / 2).astype(np.int64)
            if (at >= 0).all() and (at < EXTENT).all():
                geometry = [9, int(at[0]) << 1, int(at[1]) << 1, 26, 2, 0, 0, 2, 1, 0, 15]
        if geometry:
            tags = b"".join(_varint(keys.setdefault(k, len(keys))) + _varint(values.setdefault(_tag_value(v), len(values))) for k, v in row.items() if v is not None)
            features.append(_field(2, tags) + b"\x18\x03" + _field(4, b"".join(map(_varint, geometry))))
    if not features:
        return b""
    body = b"\x78\x02" + _field(1, layer.encode()) + b"".join(_field(2, f) for f in features)
    body += b"".join(_field(3, k.encode()) for k in keys) + b"".join(_field(4, v) for v in values) + b"\x28" + _varint(EXTENT)
    return _field(3, body)


def in_tiles(df: DataFrame, zooms: tuple[int, int] = ZOOMS, most: int | None = None, least_units: float = LEAST_UNITS) -> DataFrame:
    """``z, x, y`` beside the columns of shapes in degrees, a row for each tile that a shape's box touches.

    The last zoom has every shape. In overviews a shape smaller than
    ``least_units`` is left out and, with ``most``, a tile keeps its largest.
    ``_k`` is their order.
    """
    boxed = df.where("geometry is not null").withColumn("_b", g.wkb_bounds("geometry"))
    world = lambda lat: (1 - F.asinh(F.tan(F.radians(F.greatest(F.least(lat, F.lit(MAX_LAT)), F.lit(-MAX_LAT))))) / math.pi) / 2
    boxed = boxed.withColumns({"_x0": (F.col("_b.xmin") + 180) / 360, "_x1": (F.col("_b.xmax") + 180) / 360, "_y0": world(F.col("_b.ymax")), "_y1": world(F.col("_b.ymin"))})
    boxed = boxed.withColumn("_size", (F.col("_x1") - F.col("_x0")) * (F.col("_y1") - F.col("_y0"))).withColumn("z", F.explode(F.sequence(F.lit(zooms[0]), F.lit(zooms[1]))))
    side = F.pow(F.lit(2.0), F.col("z"))
    slack = BUFFER / EXTENT
    cells = lambda lo, hi: F.sequence(*(F.least(F.greatest(F.floor(F.col(c) * side + d), F.lit(0)), side - 1).cast("long") for c, d in ((lo, -slack), (hi, slack))))
    seen = boxed.where((F.col("_size") * side * side * EXTENT * EXTENT >= least_units) | (F.col("z") == zooms[1]))
    seen = seen.withColumn("x", F.explode(cells("_x0", "_x1"))).withColumn("y", F.explode(cells("_y0", "_y1")))
    order = F.row_number().over(Window.partitionBy("z", "x", "y").orderBy(F.desc("_size"), F.xxhash64("geometry")))
    seen = seen.withColumn("_k", order)
    seen = seen if most is None else seen.where((F.col("_k") <= most) | (F.col("z") == zooms[1]))
    return seen.select("z", "x", "y", "_k", *df.columns)


def tiles(df: DataFrame, attributes: list[str], zooms: tuple[int, int] = ZOOMS, layer: str = "fields", most: int | None = None, least_units: float = LEAST_UNITS) -> DataFrame:
    """``tile_id, z, x, y, data`` (gzipped) of all tiles that shapes in degrees touch.

    A shape that is too small to draw in the last zoom is a unit square there.
    """
    seen = in_tiles(df.select(*attributes, "geometry"), zooms, most, least_units)

    def encode(table: pa.Table) -> pa.Table:
        table = table.sort_by("_k")
        z, x, y = (table.column(c)[0].as_py() for c in ("z", "x", "y"))
        data = encode_tile(z, x, y, table.column("geometry").to_pylist(), table.select(attributes).to_pylist(), layer, z == zooms[1])
        some = [gzip.compress(data, 6, mtime=0)] if data else []
        k = len(some)
        return pa.table([pa.array([tile_id(z, x, y)] * k, pa.int64()), pa.array([z] * k, pa.int32()), pa.array([x] * k, pa.int64()), pa.array([y] * k, pa.int64()), pa.array(some, pa.binary())], ["tile_id", "z", "x", "y", "data"])

    return seen.groupBy("z", "x", "y").applyInArrow(encode, "tile_id long, z int, x long, y long, data binary")


ROOT_BYTES = 16_384 - 127
LEAF_ENTRIES = 4096


def _directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """Gzipped directory of (tile id, offset, length, run)."""
    out, last, end = [_varint(len(entries))], 0, None
    for t, *_ in entries:
        out.append(_varint(t - last))
        last = t
    out += [_varint(run) for *_, run in entries] + [_varint(n) for _, _, n, _ in entries]
    for _, at, n, _ in entries:
        out.append(_varint(0 if at == end else at + 1))
        end = at + n
    return gzip.compress(b"".join(out), 9, mtime=0)


def _directories(entries: list[tuple[int, int, int, int]]) -> tuple[bytes, bytes]:
    """(root, leaves)."""
    root, size = _directory(entries), LEAF_ENTRIES
    leaves = b""
    while len(root) > ROOT_BYTES:
        leaves, upper = b"", []
        for i in range(0, len(entries), size):
            leaf = _directory(entries[i : i + size])
            upper.append((entries[i][0], len(leaves), len(leaf), 0))
            leaves += leaf
        root, size = _directory(upper), size * 2
    return root, leaves


def _copy(source: BinaryIO, target: BinaryIO) -> None:
    source.seek(0)
    while block := source.read(1 << 20):
        target.write(block)


def write_archive(made: DataFrame, path: str, attributes: list[str], zooms: tuple[int, int] = ZOOMS, layer: str = "fields", box: tuple[float, float, float, float] = (-125.0, 24.0, -66.5, 50.0)) -> int:
    """A version 3 tile archive of ``tiles``; the number of tiles.

    Equal tiles are stored once. The driver keeps some 50 bytes per tile.
    """
    entries: list[tuple[int, int, int, int]] = []
    known: dict[bytes, tuple[int, int]] = {}
    n = end = 0
    with tempfile.TemporaryFile() as data, open(path, "wb") as out:
        for r in stored(made, "tiles").orderBy("tile_id").select("tile_id", "data").toLocalIterator(prefetchPartitions=True):
            n += 1
            key = hashlib.sha256(r["data"]).digest()[:16]
            if key not in known:
                known[key] = (end, len(r["data"]))
                end += data.write(r["data"])
            at, size = known[key]
            if entries and entries[-1][1] == at and entries[-1][0] + entries[-1][3] == r["tile_id"]:
                entries[-1] = (*entries[-1][:3], entries[-1][3] + 1)
            else:
                entries.append((r["tile_id"], at, size, 1))
        root, leaves = _directories(entries)
        about = gzip.compress(json.dumps({"vector_layers": [{"id": layer, "minzoom": zooms[0], "maxzoom": zooms[1], "fields": {a: "" for a in attributes}}]}).encode(), mtime=0)
        sections, begin = [], 127
        for size in (len(root), len(about), len(leaves), end):
            sections += [begin, size]
            begin += size
        e7 = [round(v * 1e7) for v in box]
        centre = [(e7[0] + e7[2]) // 2, (e7[1] + e7[3]) // 2]
        out.write(struct.pack("<7sB8Q3Q6B4iB2i", b"PMTiles", 3, *sections, n, len(entries), len(known), 1, 2, 2, 1, *zooms, *e7, zooms[0], *centre))
        out.write(root + about + leaves)
        _copy(data, out)
    return n
