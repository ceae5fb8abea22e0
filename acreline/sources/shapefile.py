"""Python data source of shapefiles: lines, polygons or points with their attributes.

    spark.dataSource.register(ShapefileSource)
    spark.read.format("shapes").option("path", "/data/lines/*.zip").load()

``path`` is a comma list of globs of ``.shp`` files, or of zip archives that
hold one, in a folder that all executors see. One partition per file, read
record by record. Attributes are strings (codes keep their zeros; blank is
null); the columns are those of the first file, and one that another file
lacks is null there. ``geometry`` is WKB, null for a null shape. Deleted
records are left out.
"""

from __future__ import annotations

import glob
import struct
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from acreline.functions import geometry as g

BATCH = 10_000


@contextmanager
def _member(path: str, ending: str) -> Iterator[BinaryIO]:
    if path.lower().endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            name = next(n for n in z.namelist() if n.lower().endswith(ending))
            with z.open(name) as f:
                yield f
    else:
        with open(path[: -len(ending)] + ending, "rb") as f:
            yield f


def _fields(dbf: BinaryIO) -> tuple[int, int, list[tuple[str, int, int]]]:
    """(number of records, size of a record, (name, start, length) of each field); dbf is left at its first record."""
    head = dbf.read(32)
    n, header, size = struct.unpack_from("<IHH", head, 4)
    rest, at, fields = dbf.read(header - 32), 1, []
    for i in range(0, len(rest), 32):
        if rest[i] == 0x0D:
            break
        width = rest[i + 16]
        fields.append((rest[i : i + 11].split(b"\0")[0].decode("ascii"), at, width))
        at += width
    return n, size, fields


def _value(raw: bytes) -> str | None:
    try:
        return raw.decode("utf-8").strip(" \0") or None
    except UnicodeDecodeError:
        return raw.decode("latin-1").strip(" \0") or None


def _polygons(rings: list[np.ndarray]) -> list[g.Rings]:
    """Clockwise rings are outer ones; a hole goes to the outer ring that holds its first point."""
    outer = [[r[::-1]] for r in rings if g.signed_area(r) < 0]
    for r in rings:
        if g.signed_area(r) >= 0:
            home = next((p for p in outer if g.contains([p[:1]], *r[:-1].mean(axis=0)) or g.contains([p[:1]], *r[0])), None)
            if home is None:
                outer.append([r])
            else:
                home.append(r[::-1])
    return outer


def geometry_of(content: bytes) -> bytes | None:
    """WKB of a record's content; z and m values are left out."""
    kind = struct.unpack_from("<i", content)[0] % 10
    if kind == 0:
        return None
    if kind == 1:
        return struct.pack("<BI", 1, 1) + content[4:20]
    if kind not in (3, 5):
        raise ValueError(f"shape type {kind} is not known")
    n_parts, n_points = struct.unpack_from("<ii", content, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", content, 44), n_points]
    points = np.frombuffer(content, dtype="<f8", count=2 * n_points, offset=44 + 4 * n_parts).reshape(-1, 2)
    parts = [points[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    if kind == 5:
        return g.encode(_polygons(parts))
    return g.encode_lines(parts)


def records(path: str) -> Iterator[tuple[dict[str, str | None], bytes | None]]:
    with _member(path, ".shp") as shp, _member(path, ".dbf") as dbf:
        if struct.unpack(">i", shp.read(100)[:4])[0] != 9994:
            raise ValueError(f"not a shapefile: {path}")
        n, size, fields = _fields(dbf)
        for _ in range(n):
            row, head = dbf.read(size), shp.read(8)
            content = shp.read(2 * struct.unpack(">ii", head)[1])
            if row[:1] != b"*":
                yield {k: _value(row[a : a + w]) for k, a, w in fields}, geometry_of(content)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _paths(options: dict) -> list[str]:
    found = sorted(p for pattern in options["path"].split(",") for p in glob.glob(pattern.strip()))
    if not found:
        raise FileNotFoundError(f"no shapefile at {options['path']}")
    return found


class ShapefileSource(DataSource):
    """Attributes as strings, and ``geometry binary``."""

    @classmethod
    def name(cls) -> str:
        return "shapes"

    def schema(self) -> str:
        with _member(_paths(self.options)[0], ".dbf") as dbf:
            return ", ".join([*(f"`{k}` string" for k, _, _ in _fields(dbf)[2]), "geometry binary"])

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options, [f.name for f in schema.fields])


class _Reader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.paths, self.names = _paths(options), names

    def partitions(self) -> list[_File]:
        return [_File(p) for p in self.paths]

    def read(self, part: _File) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if k == "geometry" else pa.string()) for i, k in enumerate(self.names)], self.names)

        for attributes, geometry in records(part.path):
            rows.append([geometry if k == "geometry" else attributes.get(k) for k in self.names])
            if len(rows) == BATCH:
                yield batch()
                rows = []
        if rows:
            yield batch()
