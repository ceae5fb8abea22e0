"""Merging on shapes against merging on pixels."""

import numpy as np
import pytest

from acreline.functions import geometry as geo
from acreline.operators import polygons, regions, vector
from acreline.runtime import stored


def square(x, y, w, h):
    return geo.box_ring(x, y, x + w, y + h)


@pytest.mark.parametrize(
    ("b", "length"),
    [
        (square(2, 0, 2, 2), 2.0),  # a whole side
        (square(2, 1, 2, 5), 1.0),  # a part of one
        (square(2, 2, 2, 2), 0.0),  # a corner
        (square(3, 0, 2, 2), 0.0),  # on one line, apart
        (square(0.5, 2, 1, 1), 1.0),
    ],
)
def test_shared_length(b, length):
    a = square(0, 0, 2, 2)
    assert geo.shared_length(a, b) == geo.shared_length(b, a) == length


def test_hole_shares_its_border():
    hole = np.array([(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)], dtype=float)
    assert geo.shared_length([[square(0, 0, 4, 4)[0][0], hole]], square(1, 1, 1, 1)) == 4.0


@pytest.mark.parametrize("seed", [0, 1])
def test_same_as_pixels(spark, seed):
    rng = np.random.default_rng(seed)
    grid = np.kron(np.array([[1, 2], [3, 4]]), np.ones((20, 20), dtype=int))
    spots = rng.choice(grid.size, 15, replace=False)
    grid.flat[spots] = rng.integers(5, 12, 15)
    rows = [("A0", i * 40 + j, i, j, int(v), 2) for (i, j), v in np.ndenumerate(grid)]
    labels = stored(regions.components(spark.createDataFrame(rows, "tile string, pix long, r long, c long, seq long, effective int")), "labels")
    table, edges = stored(regions.region_table(labels), "regions"), stored(regions.adjacency(labels), "edges")
    merged, _, _ = regions.eliminate(table, edges, (1350.0, 3600.0))
    made = polygons.eliminate(vector.outlines(labels), (1350.0, 3600.0), cell=300.0)
    want = {r["label"]: r["n_pixels"] * 900.0 for r in merged.collect()}
    got = {r["label"]: geo.area(geo.decode(bytes(r["geometry"]))[1]) for r in made.collect()}
    assert got == want and sum(got.values()) == 1600 * 900.0


def test_no_shapes_and_nothing_large(spark):
    schema = "tile string, label long, geometry binary, area_sqm double"
    assert polygons.eliminate(spark.createDataFrame([], schema), (1.0,)).count() == 0
    alone = [("A", 1, geo.encode(square(0, 0, 1, 1)), 1.0), ("A", 2, geo.encode(square(1, 0, 1, 1)), 1.0)]
    assert polygons.eliminate(spark.createDataFrame(alone, schema), (1.0,)).count() == 2
