"""Tiles, sizes and pixels: arithmetic on dimensions and on pixel tables (image, y, x, v)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def div(a: Column, b: Column | int) -> Column:
    """Floor division of whole numbers."""
    return F.floor(a / b).cast("long")


def pad_to(n: Column, divisor: int) -> Column:
    """The least multiple of ``divisor`` that is not below ``n``."""
    return F.ceil(n / divisor).cast("long") * divisor


def steps(size: Column, tile: int, overlap: float) -> Column:
    """Where overlapping tiles begin; the last one reaches the padded end."""
    stride = max(1, int(tile * (1 - overlap)))
    most = F.ceil(F.greatest(size - tile, F.lit(0)) / stride).cast("int")
    return F.transform(F.sequence(F.lit(0), most), lambda i: i * stride)


def grid_steps(size: Column, tile: int) -> Column:
    """Where grid tiles begin; one more at the edge if the grid does not end there."""
    return F.array_union(F.sequence(F.lit(0), F.greatest(size - tile, F.lit(0)).cast("int"), F.lit(tile)), F.array(F.greatest(size - tile, F.lit(0)).cast("int")))


def overlap_tiles(images: DataFrame, tile: int = 512, overlap: float = 0.25) -> DataFrame:
    """``images`` (with w, h) times their tiles: y0, y1, x0, x1."""
    rows = images.withColumn("y0", F.explode(steps(F.col("h"), tile, overlap))).withColumn("x0", F.explode(steps(F.col("w"), tile, overlap)))
    return rows.withColumns({"y1": F.col("y0") + tile, "x1": F.col("x0") + tile})


def grid_tiles(images: DataFrame, tile: int = 2048) -> DataFrame:
    """``images`` (with w, h, stem) times the tiles of a grid, by name."""
    rows = images.withColumn("y0", F.explode(grid_steps(F.col("h"), tile))).withColumn("x0", F.explode(grid_steps(F.col("w"), tile)))
    return rows.withColumn("tile", F.concat_ws("_", "stem", F.col("x0").cast("string"), F.col("y0").cast("string")))


def size_class(w: Column, h: Column, tile: int = 2048, threshold: float = 1.5) -> Column:
    """A side below the tile is padded; both far beyond it are cut into a grid; else the image is resized."""
    return F.when((w < tile) | (h < tile), "pad").when((w >= tile * threshold) & (h >= tile * threshold), "grid").otherwise("resize")


def fit(w: Column, h: Column, tw: int, th: int) -> tuple[Column, Column, Column, Column]:
    """Width, height and offsets of an image scaled into a frame and centred."""
    s = F.least(tw / w, th / h)
    nw, nh = F.greatest((w * s).cast("int"), F.lit(1)), F.greatest((h * s).cast("int"), F.lit(1))
    return nw, nh, div(tw - nw, 2), div(th - nh, 2)


def hann(i: Column, n: int) -> Column:
    return 0.5 - 0.5 * F.cos(2 * 3.141592653589793 * i / (n - 1))


def pixels(planes: DataFrame, image: str, plane: str | Column, width: int, *carried: Column) -> DataFrame:
    """A row for each pixel of flat planes: image, y, x, v, and what is carried along."""
    rows = planes.select(F.col(image).alias("image"), F.posexplode(plane).alias("i", "v"), *carried)
    return rows.select("image", div(F.col("i"), width).cast("int").alias("y"), (F.col("i") % width).cast("int").alias("x"), F.col("v").cast("double").alias("v"), *rows.columns[3:])


def picked(planes: DataFrame, image: str, plane: str, height: int, width: int, at) -> DataFrame:
    """Frames of ``height`` by ``width`` whose pixels lie at ``at(y, x)`` in flat planes; null where that is null. No join of pixels."""
    place = lambda i: at(F.floor(i / width).cast("int"), (i % width).cast("int"))
    frame = F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: F.get(F.col(plane), place(i)).cast("double"))
    return pixels(planes, image, frame, width)


def reflected(i: Column, n: int) -> Column:
    """The index a mirrored border shows; the edge itself isn't repeated."""
    return (n - 1) - F.abs((n - 1) - i)
