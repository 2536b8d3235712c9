"""Connected parts of masks: runs of pixels, joined row by row inside a tile; tiles are joined along their borders."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components

#: Pixels a side of a tile; a task holds one tile.
TILE = 1_024


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first column and column after the last of each run of set pixels, in reading order."""
    step = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    y, start = np.nonzero(step == 1)
    return y, start, np.nonzero(step == -1)[1]


def touching(y: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs of neighbouring rows that touch, corners included."""
    line = width + 2
    first = np.searchsorted(y * line + end, (y + 1) * line + start, side="left")
    last = np.searchsorted(y * line + start, (y + 1) * line + end, side="right")
    n = np.maximum(last - first, 0)
    upper = np.repeat(np.arange(len(y)), n)
    return upper, np.repeat(first, n) + np.arange(len(upper)) - np.repeat(np.cumsum(n) - n, n)


def least_of_set(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each number's set, after the sets of all pairs are united.

    All pairs at once: the greater root of each hangs itself below the least root that it meets, then all paths are
    shortened; so each turn at least halves the roots that have pairs left.
    """
    root = np.arange(n)
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(nearer := root[root], root):
            root = nearer


def labelled_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of a mask and, for each, the number of the first run of its part."""
    y, start, end = runs(mask)
    return y, start, end, least_of_set(len(y), *touching(y, start, end, mask.shape[1]))


def component_sizes(mask: np.ndarray) -> list[int]:
    """Areas of the parts of a mask, whose pixels touch at sides or corners; the smallest first."""
    y, start, end, part = labelled_runs(mask)
    return sorted(np.bincount(part, end - start)[np.unique(part)].astype(int).tolist()) if len(y) else []


def tile_parts(mask: np.ndarray, y0: int, x0: int) -> dict[str, pa.Array]:
    """The parts inside a tile that begins at (y0, x0), by label: the place of their first pixel.

    Rows with ``area`` are parts; rows with ``y`` and ``x`` are pixels along the tile's border. A tile without set pixels
    has one row without a label.
    """
    gap = lambda k: pa.nulls(k, pa.int64())
    y, start, end, part = labelled_runs(mask)
    if not len(y):
        return {"label": gap(1), "area": pa.array([0], pa.int64()), "y": gap(1), "x": gap(1)}
    label = ((y + y0) << 32) + start + x0
    own = np.unique(part)
    area = np.bincount(part, end - start)[own].astype(np.int64)
    run_of = np.full(mask.shape, -1, np.int32)
    for row in {0, mask.shape[0] - 1}:
        for i in np.flatnonzero(y == row):
            run_of[row, start[i] : end[i]] = i
    for column in {0, mask.shape[1] - 1}:
        some = np.flatnonzero((start <= column) & (end > column))
        run_of[y[some], column] = some
    by, bx = np.nonzero(run_of >= 0)
    both = lambda first, second: pa.concat_arrays([first, second])
    return {
        "label": pa.array(np.concatenate([label[own], label[part[run_of[by, bx]]]])),
        "area": both(pa.array(area), gap(len(by))),
        "y": both(gap(len(own)), pa.array(by + y0)),
        "x": both(gap(len(own)), pa.array(bx + x0)),
    }


def parts_of_pixels(pixels: DataFrame, tile: int = TILE, threshold: float = 0.0) -> DataFrame:
    """``image``, ``label``, ``area`` of the parts of masks that come as a row (image, y, x, v) for each pixel, in any order.

    Masks of any size: each is cut into tiles, whose parts a task finds; pixels on both sides of a border meet by an
    equal join of their places, and the parts of an image that so belong together by contraction of stars, as tables. A
    label is the place of the part's first pixel, row in the upper 32 bits. Images without set pixels have a row without
    a label. Null values are not set; repeated pixels count once; an empty table gives no rows.
    """

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        y0, x0 = key[1].as_py() * tile, key[2].as_py() * tile
        rows = rows.filter(pc.greater(rows["v"], threshold))  # nulls go too
        mask = np.zeros((tile, tile), bool)
        mask[rows["y"].to_numpy() - y0, rows["x"].to_numpy() - x0] = True
        found = tile_parts(mask, y0, x0)
        return pa.table({"image": pa.repeat(key[0], len(found["label"])), **found})

    kind = pixels.schema["image"].dataType.simpleString()
    places = pixels.select("image", "y", "x", "v", F.floor(F.col("y") / tile).cast("int").alias("ty"), F.floor(F.col("x") / tile).cast("int").alias("tx"))
    found = places.groupBy("image", "ty", "tx").applyInArrow(run, f"image {kind}, label long, area long, y long, x long")
    return merged(found, tile)


def merged(found: DataFrame, tile: int) -> DataFrame:
    """Parts of whole images from rows of ``tile_parts`` with their image."""
    from ..sources.files import stored

    found = stored(found, "parts")
    # sides of all joins grow with the masks, so they are merged: a broadcast would pass through the driver
    border = found.filter("y is not null").select("image", "label", "y", "x")
    # of two pixels that touch across a border, the one in the upper tile looks down, that in the left one to the right
    down, right = F.col("y") % tile == tile - 1, F.col("x") % tile == tile - 1
    below = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.struct((F.col("y") + 1).alias("y"), (F.col("x") + k).alias("x")))
    beside = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.struct((F.col("y") + k).alias("y"), (F.col("x") + 1).alias("x")))
    none = F.array().cast("array<struct<y:bigint,x:bigint>>")
    looks = border.select("image", F.col("label").alias("other"), F.explode(F.array_union(F.when(down, below).otherwise(none), F.when(right, beside).otherwise(none))).alias("at"))
    met = looks.select("image", "other", "at.*").join(border.hint("merge"), ["image", "y", "x"]).filter("label <> other")
    roots = components(met.select(F.struct("image", "label").alias("a"), F.struct("image", F.col("other").alias("label")).alias("b")))
    roots = roots.select(F.col("node.image").alias("image"), F.col("node.label").alias("label"), F.col("root.label").alias("root"))
    parts = found.filter("area is not null").join(roots.hint("merge"), ["image", "label"], "left")
    whole = parts.groupBy("image", F.coalesce("root", "label").alias("label")).agg(F.sum("area").alias("area"))
    # tiles without set pixels count only where an image has no others
    any_set = whole.groupBy("image").agg(F.max("label").isNotNull().alias("some"))
    return whole.join(any_set.hint("merge"), "image").filter("label is not null or not some").drop("some")


def part_sizes(parts: DataFrame, least: int) -> DataFrame:
    """By image: ``parts``, the area of the ``largest``, and how many pixels are ``kept`` without parts below ``least`` pixels."""
    kept = F.sum(F.when(F.col("area") >= least, F.col("area")).otherwise(0))
    return parts.groupBy("image").agg(F.count("label").alias("parts"), F.max("area").alias("largest"), kept.alias("kept"))
