"""Connected parts of masks: runs against a flood fill, tiles against whole masks, components against union-find."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tessaria.functions import masks
from tessaria.operators.components import components


def flood(mask):
    seen, out = set(), []
    for start in zip(*np.nonzero(mask), strict=True):
        if start in seen:
            continue
        stack, size = [start], 0
        seen.add(start)
        while stack:
            y, x = stack.pop()
            size += 1
            for p in ((y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
                if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and p not in seen:
                    seen.add(p)
                    stack.append(p)
        out.append(size)
    return sorted(out)


def spiral(side):
    """One arm, a pixel wide, with a pixel between its turns."""
    mask = np.zeros((side, side), bool)
    y, x, dy, dx, steps = 0, 0, 0, 1, side - 1
    mask[0, 0] = True
    turn = 0
    while steps > 0:
        y1, x1 = y + dy * steps, x + dx * steps
        mask[min(y, y1) : max(y, y1) + 1, min(x, x1) : max(x, x1) + 1] = True
        y, x, dy, dx, turn = y1, x1, dx, -dy, turn + 1
        if turn >= 3 and turn % 2 == 1:
            steps -= 2
    return mask


def test_runs_against_flood_fill():
    rng = np.random.default_rng(0)
    for shape in ((8, 8), (1, 9), (9, 1), (1, 1), (5, 7), (30, 41)):
        for p in (0, 0.1, 0.3, 0.5, 0.7, 1):
            m = rng.random(shape) < p
            assert masks.component_sizes(m) == flood(m)
    assert masks.component_sizes(spiral(51)) == flood(spiral(51)) and len(flood(spiral(51))) == 1


def test_a_large_spiral():
    mask = spiral(4000)
    began = time.process_time()
    sizes = masks.component_sizes(mask)
    assert sizes == [int(mask.sum())] and mask.sum() > 7_900_000
    assert time.process_time() - began < 5
    checks = np.indices((1500, 1500)).sum(0) % 2 == 0  # all pixels of one colour touch at corners
    assert masks.component_sizes(checks) == [1_125_000]


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.default_rng(1)
    blank = np.zeros((23, 9), bool)
    corner = np.zeros((20, 20), bool)
    corner[7, 8] = corner[8, 7] = True  # touch across the corner of four tiles
    return {1: rng.random((40, 37)) < 0.3, 2: rng.random((33, 64)) < 0.5, 3: spiral(61), 4: blank, 5: np.ones((17, 30), bool), 6: corner, 7: rng.random((5, 3)) < 0.5}


@pytest.mark.parametrize("tile", [8, 16, 1000])
def test_tiles_give_the_same_as_whole_masks(spark, drawn, tile):
    rows = [(i, y, x, float(v) if v else None if (y + x) % 5 else 0.0) for i, m in drawn.items() for (y, x), v in np.ndenumerate(m)]
    pixels = spark.createDataFrame([*rows, rows[0]], "image long, y int, x int, v double").repartition(5)
    parts = masks.parts_of_pixels(pixels, tile)
    got = {i: sorted(r.area for r in parts.collect() if r.image == i and r.label is not None) for i in drawn}
    assert got == {i: flood(m) for i, m in drawn.items()}
    sizes = {r.image: (r.parts, r.largest, r.kept) for r in masks.part_sizes(parts, 3).collect()}
    assert sizes == {i: (len(s := flood(m)), max(s, default=0), sum(n for n in s if n >= 3)) for i, m in drawn.items()}
    labels = {(r.image, r.label) for r in parts.collect()}
    assert (3, 0) in labels and (4, None) in labels and (6, (7 << 32) + 8) in labels
    assert masks.parts_of_pixels(pixels.limit(0), tile).count() == 0


def test_components_of_edges(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, i) for i in range(5001, 5400)] + [(9, 9), (8000, 8000), (1000, 1001)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long").repartition(4)
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    text = components(df.selectExpr("concat('n', lpad(a, 6, '0')) as a", "concat('n', lpad(b, 6, '0')) as b"))
    assert {int(r.node[1:]): int(r.root[1:]) for r in text.collect()} == got
    assert components(df.limit(0)).count() == 0


def test_tables_that_grow_with_the_masks_are_not_broadcast(spark):
    """Small as they are here, joins of parts, borders and stars are merged: nothing of them goes through the driver."""
    from tessaria.operators import components as c

    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 1)], "a long, b long")
    pixels = spark.range(0, 64).selectExpr("id % 2 AS image", "CAST(id DIV 8 AS int) AS y", "CAST(id % 8 AS int) AS x", "1.0D AS v")
    parts = masks.parts_of_pixels(pixels, tile=4)
    for df in (parts, c._large_star(edges), c._small_star(edges)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text, text
    assert sorted((r.image, r.area) for r in parts.collect()) == [(0, 8)] * 4 + [(1, 8)] * 4  # columns two apart
