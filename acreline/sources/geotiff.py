"""Class rasters in GeoTIFF as a Spark data source.

    spark.dataSource.register(GeoTiffSource)
    spark.read.format("classraster").option("path", "/data/{year}.tif").option("years", "2018,2019").option("tile", 5000).load()

One partition per tile and year reads only the strips or blocks that the tile
needs. Single-band unsigned bytes, classic or BigTIFF; uncompressed, deflate,
LZW or PackBits, with or without the horizontal predictor.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 11: 4, 12: 8, 16: 8}
_KINDS = {1: "B", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
# Codes that empty the table and that end the data, and the widths of codes.
_CLEAR, _END, _LEAST, _MOST = 256, 257, 9, 12


def unlzw(raw: bytes) -> bytes:
    """LZW with the first bit highest and widths that grow one code early (TIFF 6.0, section 13)."""
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    out, before, width, bits, have = [], b"", _LEAST, 0, 0
    for byte in raw:
        bits, have = bits << 8 | byte, have + 8
        if have < width:  # a byte ends one code at most, as codes are longer
            continue
        have -= width
        code, bits = bits >> have, bits & ((1 << have) - 1)
        if code == _END:
            break
        if code == _CLEAR:
            del table[_END + 1 :]
            before, width = b"", _LEAST
            continue
        if code > len(table) or (code == len(table) and not before):
            raise ValueError("damaged LZW data")
        piece = table[code] if code < len(table) else before + before[:1]
        if before:
            table.append(before + piece[:1])
        out.append(piece)
        before = piece
        if len(table) + 1 >= 1 << width and width < _MOST:
            width += 1
    return b"".join(out)


def unpackbits(raw: bytes) -> bytes:
    """Runs and literal stretches behind a signed length (TIFF 6.0, section 9)."""
    out, at = bytearray(), 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out += raw[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            out += raw[at + 1 : at + 2] * (257 - n if n > 128 else 0)
            at += 2 if n > 128 else 1
    return bytes(out)


#: How blocks are read, by the file's compression.
_READ = {1: bytes, 5: unlzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: unpackbits}


class Tiff:
    """Tags of a file's first image, and windows of its pixels."""

    def __init__(self, path: str):
        import pyarrow.fs

        fs, at = (pyarrow.fs.FileSystem.from_uri(path)) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
        self.file = fs.open_input_file(at)
        head = self._read(0, 16)
        self.e = {b"II": "<", b"MM": ">"}[head[:2]]
        (version,) = struct.unpack(self.e + "H", head[2:4])
        if version not in (42, 43):
            raise ValueError(f"{path} is not a TIFF file")
        big = version == 43
        # a position, the number of entries, and the room for an entry's values
        word, entries, room = ("Q", "Q", 8) if big else ("I", "H", 4)
        (ifd,) = struct.unpack(self.e + word, head[8:16] if big else head[4:8])
        first = ifd + struct.calcsize("=" + entries)
        (n,) = struct.unpack(self.e + entries, self._read(ifd, first - ifd))
        length = 4 + 2 * room
        listed, self.tags = self._read(first, n * length), {}
        for raw in (listed[i * length : (i + 1) * length] for i in range(n)):
            tag, kind, count = struct.unpack(self.e + "HH" + word, raw[: 4 + room])
            size = _SIZES.get(kind, 0) * count
            data = raw[4 + room :][:size] if size <= room else self._read(struct.unpack(self.e + word, raw[4 + room :])[0], size)
            if kind in _KINDS:
                self.tags[tag] = struct.unpack(f"{self.e}{count}{_KINDS[kind]}", data)
        one = lambda tag, other: self.tags.get(tag, (other,))[0]
        self.width, self.height = one(256, 0), one(257, 0)
        self.compression, self.predictor = one(259, 1), one(317, 1)
        if one(258, 1) != 8 or one(277, 1) != 1 or self.compression not in _READ:
            raise ValueError(f"{path}: only single-band bytes, plain, deflate, LZW or PackBits, are read")
        tiled = 322 in self.tags
        self.block = (one(323, 0), one(322, 0)) if tiled else (min(one(278, self.height), self.height), self.width)
        self.offsets, self.counts = (self.tags[t] for t in ((324, 325) if tiled else (273, 279)))
        self.tiled = tiled
        self._held, self._held_row = {}, -1
        scale, tie = self.tags.get(33550, (1.0, 1.0, 0.0)), self.tags.get(33922, (0.0,) * 6)
        self.pixel, self.origin = scale[0], (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1])

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _block(self, i: int, k: int) -> np.ndarray:
        """Block k of block row i; those of the last row are kept, as windows go down."""
        if i != self._held_row:
            self._held, self._held_row = {}, i
        if k not in self._held:
            bh, bw = self.block
            have = bh if self.tiled else min(bh, self.height - i * bh)
            data = np.frombuffer(_READ[self.compression](self._read(self.offsets[k], self.counts[k])), dtype=np.uint8)
            block = data[: have * bw].reshape(have, bw)
            self._held[k] = np.cumsum(block, axis=1, dtype=np.uint8) if self.predictor == 2 else block
        return self._held[k]

    def window(self, row: int, col: int, height: int, width: int) -> np.ndarray:
        out = np.zeros((height, width), dtype=np.uint8)
        bh, bw = self.block
        across = -(-self.width // bw)
        for i in range(row // bh, -(-(row + height) // bh)):
            for j in range(col // bw, -(-(col + width) // bw)):
                k = i * across + j
                block = self._block(i, k)
                have = len(block)
                r0, c0 = max(row, i * bh), max(col, j * bw)
                r1, c1 = min(row + height, i * bh + have), min(col + width, (j + 1) * bw)
                out[r0 - row : r1 - row, c0 - col : c1 - col] = block[r0 - i * bh : r1 - i * bh, c0 - j * bw : c1 - j * bw]
        return out


class _Part(InputPartition):
    def __init__(self, tile: str, year: int, box: tuple[int, int, int, int]):
        self.tile, self.year, self.box = tile, year, box


def _letters(i: int) -> str:
    return chr(65 + i) if i < 26 else chr(64 + i // 26) + chr(65 + i % 26)


class GeoTiffSource(DataSource):
    """``tile, pix, r, c, yr, cdl``: one row per pixel and year; pix numbers the whole grid row by row."""

    @classmethod
    def name(cls) -> str:
        return "classraster"

    def schema(self) -> str:
        return "tile string, pix long, r long, c long, yr int, cdl int"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("tile", 5000))
        self.years = [int(y) for y in options["years"].split(",")]

    def _file(self, year: int) -> Tiff:
        return Tiff(self.path.replace("{year}", str(year)))

    def partitions(self) -> list[_Part]:
        first, s = self._file(self.years[0]), self.size
        return [
            _Part(f"{_letters(i)}{j}", y, (i * s, j * s, min(s, first.height - i * s), min(s, first.width - j * s)))
            for i in range(-(-first.height // s))
            for j in range(-(-first.width // s))
            for y in self.years
        ]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        tiff = self._file(part.year)
        row, col, height, width = part.box
        for at in range(0, height, max(1, 200_000 // width)):
            n = min(max(1, 200_000 // width), height - at)
            cdl = tiff.window(row + at, col, n, width).ravel().astype(np.int32)
            r = np.repeat(np.arange(row + at, row + at + n), width)
            c = np.tile(np.arange(col, col + width), n)
            yield pa.RecordBatch.from_arrays([pa.array([part.tile] * len(r)), pa.array(r * tiff.width + c), pa.array(r), pa.array(c), pa.array(np.full(len(r), part.year, dtype=np.int32)), pa.array(cdl)], ["tile", "pix", "r", "c", "yr", "cdl"])
