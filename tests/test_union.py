"""Unions of many shapes, against the pixels that they cover."""

import time

import numpy as np
import pytest

from acreline.functions import geometry as g
from acreline.operators import vector


def pixels(seed, height, width, holes=0.2):
    """A grid of classes, -1 where nothing is."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 3, (height, width))
    codes[rng.random(codes.shape) < holes] = -1
    return codes


def squares(codes):
    """A polygon for each pixel."""
    return [g.box_ring(30.0 * c, -30.0 * r - 30, 30.0 * c + 30, -30.0 * r) for r, c in zip(*np.nonzero(codes >= 0), strict=True)]


def measures(codes):
    there = np.pad(codes >= 0, 1).astype(int)
    return (codes >= 0).sum() * 900.0, 30.0 * sum(np.abs(np.diff(there, axis=k)).sum() for k in (0, 1))


@pytest.mark.parametrize("seed", range(6))
def test_union_covers_its_pixels(seed):
    codes = pixels(seed, 15, 20, holes=0.1 * seed)
    for turn in (0.0, 0.3):
        way = np.array([[np.cos(turn), -np.sin(turn)], [np.sin(turn), np.cos(turn)]])
        made = g.union_coverage([[[r @ way for r in p] for p in s] for s in squares(codes)])
        assert (g.area(made), g.length(made)) == pytest.approx(measures(codes))
        for r, c in np.ndindex(codes.shape):
            x, y = np.array([30.0 * c + 15, -30.0 * r - 15]) @ way
            assert sum(g.contains([p], x, y) for p in made) == (codes[r, c] >= 0)


def test_long_borders_meet_short_ones():
    wide = g.box_ring(0, 0, 3000, 30)
    many = [g.box_ring(30.0 * k, 30, 30.0 * k + 30, 60) for k in range(100)]
    made = g.union_coverage([wide, *many])
    assert len(made) == 1 and g.area(made) == 180_000 and g.length(made) == 6120


def test_shapes_that_overlap_keep_their_outer_border():
    made = g.union_coverage([g.box_ring(0, 0, 30, 30), g.box_ring(0, 0, 30, 30)])
    assert sum(abs(g.signed_area(r)) for p in made for r in p) == 1800


def test_many_shapes_are_united_in_time():
    codes = pixels(9, 250, 160)
    began = time.process_time()
    made = g.union_coverage(squares(codes))
    assert time.process_time() - began < 20
    assert (g.area(made), g.length(made)) == measures(codes)


def test_shapes_meet_by_place(spark, monkeypatch):
    monkeypatch.setattr(vector, "PIECE_M", 120.0)
    codes = pixels(4, 20, 30)
    rows = [("A0", bytearray(g.encode(s)), 900.0) for s in squares(codes)]
    got = vector.merge_shapes(spark.createDataFrame(rows, "tile string, geometry binary, area_sqm double"), ["tile"]).collect()
    made = g.decode(bytes(got[0]["geometry"]))[1]
    assert len(got) == 1 and (g.area(made), g.length(made)) == measures(codes) and got[0]["area_sqm"] == measures(codes)[0]
