import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from acreline.functions import geometry as g


def ring(*points):
    return np.array([*points, points[0]], dtype=float)


SQUARE = ring((0, 0), (4, 0), (4, 4), (0, 4))

# shape, its even-odd area, polygons after repair, valid before
SHAPES = {
    "square": ([[SQUARE]], 16, 1, True),
    "four corners": ([[ring((0, 0), (4, 1), (3, 3), (1, 2))]], 6, 1, True),
    "four corners with a dent": ([[ring((0, 0), (4, 0), (1, 1), (0, 4))]], 4, 1, True),
    "bow tie": ([[ring((0, 0), (2, 2), (2, 0), (0, 2))]], 2, 2, False),
    "uneven figure eight": ([[ring((0, 0), (3, 3), (3, 0), (1, 2), (0, 2))]], 4, 2, False),
    "spike": ([[ring((0, 0), (4, 0), (4, 4), (2, 4), (2, 9), (2, 4), (0, 4))]], 16, 1, False),
    "hole": ([[SQUARE, ring((1, 1), (1, 2), (2, 2), (2, 1))]], 15, 1, True),
    "hole the other way round": ([[SQUARE, ring((1, 1), (2, 1), (2, 2), (1, 2))]], 15, 1, True),
    "hole that touches": ([[SQUARE, ring((2, 0), (1, 2), (3, 2))]], 14, 1, True),
    "hole outside": ([[SQUARE, ring((6, 0), (7, 0), (7, 1), (6, 1))]], 17, 2, False),
    "hole across the border": ([[SQUARE, ring((3, 1), (5, 1), (5, 2), (3, 2))]], 16, 2, False),
    "parts that overlap": ([[SQUARE], [ring((2, 2), (6, 2), (6, 6), (2, 6))]], 24, 2, False),
    "parts that share a side": ([[SQUARE], [ring((4, 0), (8, 0), (8, 4), (4, 4))]], 32, 1, False),
    "hole that cuts it in two": ([[SQUARE, ring((0, 2), (2, 1), (4, 2), (2, 3))]], 12, 2, True),
    "no area": ([[ring((0, 0), (4, 0), (2, 0))]], 0, 0, False),
}


@pytest.mark.parametrize("name", SHAPES)
def test_known_shapes(name):
    shape, area, parts, valid = SHAPES[name]
    assert g.is_valid(shape) is valid
    made = g.repaired(shape)
    assert len(made) == parts and g.area(made) == pytest.approx(area)
    assert not parts or g.is_valid(made)
    assert all(g.signed_area(p[0]) > 0 and all(g.signed_area(h) < 0 for h in p[1:]) for p in made)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=3, max_size=9))
def test_random_rings_are_even_odd(points):
    made = g.repaired([[ring(*points)]])
    assert not made or g.is_valid(made)
    x, y = np.meshgrid(np.arange(0, 9, 0.5) + 0.2637, np.arange(0, 9, 0.5) + 0.2411)
    for px, py in zip(x.ravel(), y.ravel(), strict=True):
        a, b = (g._edges([[r for p in shape for r in p]]) if shape else np.empty((0, 4)) for shape in ([[ring(*points)]], made))
        inside = [bool((g._crossings(e, py) < px).sum() % 2) for e in (a, b)]
        assert inside[0] == inside[1], (px, py)


def test_column_keeps_what_is_valid(spark):
    shapes = [SHAPES["square"][0], SHAPES["bow tie"][0], SHAPES["no area"][0]]
    rows = [(i, bytearray(g.encode(s))) for i, s in enumerate(shapes)] + [(9, None), (10, bytearray(g.encode_line(SQUARE)))]
    df = spark.createDataFrame(rows, "id int, geometry binary")
    got = {r["id"]: r["g"] for r in df.select("id", g.wkb_repaired("geometry").alias("g")).collect()}
    assert bytes(got[0]) == bytes(rows[0][1]) and bytes(got[10]) == bytes(rows[4][1])
    assert g.area(g.decode(bytes(got[1]))[1]) == pytest.approx(2) and got[2] is None and got[9] is None
