"""Queries on tiles, dimensions and pixels; eight by eight planes come from vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import raster as r
from ..functions.masks import component_sizes, part_sizes, parts_of_pixels
from .registry import query, table

DIM_SQL = "(SELECT p_partkey AS image, 's' || p_partkey AS stem, p_size * 100 AS w, p_partkey % 37 * 100 + 1 AS h FROM part)"
PIX_SQL = "(SELECT vec_id AS image, label, i // 8 AS y, i % 8 AS x, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(0, 64) t(i))"


def dims(spark, d) -> DataFrame:
    return table(spark, d, "part").selectExpr("p_partkey as image", "concat('s', p_partkey) as stem", "p_size * 100 as w", "p_partkey % 37 * 100 + 1 as h")


def pix(spark, d) -> DataFrame:
    return r.pixels(table(spark, d, "embeddings"), "vec_id", "embedding", 8)


@query("SELECT image, CAST(ceil(w / 32.0) AS BIGINT) * 32 AS pw, CAST(ceil(h / 32.0) AS BIGINT) * 32 AS ph, CAST(ceil(w / 32.0) AS BIGINT) * 32 - w AS right_pad, CAST(ceil(h / 32.0) AS BIGINT) * 32 - h AS bottom_pad FROM " + DIM_SQL)
def pad_dims(spark, d):
    pw, ph = r.pad_to(F.col("w"), 32), r.pad_to(F.col("h"), 32)
    return dims(spark, d).select("image", pw.alias("pw"), ph.alias("ph"), (pw - F.col("w")).alias("right_pad"), (ph - F.col("h")).alias("bottom_pad"))


@query("WITH s AS (SELECT *, least(2048::DOUBLE / w, 2048::DOUBLE / h) AS s FROM " + DIM_SQL + "), n AS (SELECT image, greatest(CAST(trunc(w * s) AS INT), 1) AS nw, greatest(CAST(trunc(h * s) AS INT), 1) AS nh FROM s) SELECT image, nw, nh, CAST(floor((2048 - nw) / 2.0) AS BIGINT) AS ox, CAST(floor((2048 - nh) / 2.0) AS BIGINT) AS oy FROM n")
def fit_dims(spark, d):
    nw, nh, ox, oy = r.fit(F.col("w"), F.col("h"), 2048, 2048)
    return dims(spark, d).select("image", nw.alias("nw"), nh.alias("nh"), ox.alias("ox"), oy.alias("oy"))


@query("SELECT image, CASE WHEN greatest(w, h) > 1024 THEN CAST(trunc(w * (1024::DOUBLE / greatest(w, h))) AS INT) ELSE w END AS nw, CASE WHEN greatest(w, h) > 1024 THEN CAST(trunc(h * (1024::DOUBLE / greatest(w, h))) AS INT) ELSE h END AS nh FROM " + DIM_SQL)
def max_side_dims(spark, d):
    most = F.greatest("w", "h")
    s = F.when(most > 1024, 1024 / most).otherwise(1.0)
    return dims(spark, d).select("image", (F.col("w") * s).cast("int").alias("nw"), (F.col("h") * s).cast("int").alias("nh"))


@query("SELECT image, CASE WHEN w < 2048 OR h < 2048 THEN 'pad' WHEN w >= 3072 AND h >= 3072 THEN 'grid' ELSE 'resize' END AS decision FROM " + DIM_SQL)
def size_decision(spark, d):
    return dims(spark, d).select("image", r.size_class(F.col("w"), F.col("h")).alias("decision"))


@query("SELECT vec_id, list_aggregate(list_transform(embedding, lambda x: round((CAST(x AS DOUBLE) / 255 - 0.485::DOUBLE) / 0.229::DOUBLE, 6)), 'sum') AS total FROM embeddings")
def pixel_normalise(spark, d):
    scaled = F.transform("embedding", lambda x: F.round((x.cast("double") / 255 - 0.485) / 0.229, 6))
    return table(spark, d, "embeddings").select("vec_id", F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("SELECT image, y, x, round((0.5 - 0.5 * cos(2 * pi() * y / 7)) * (0.5 - 0.5 * cos(2 * pi() * x / 7)) + 1e-6, 9) AS weight FROM " + PIX_SQL)
def hann_weight(spark, d):
    return pix(spark, d).select("image", "y", "x", F.round(r.hann(F.col("y"), 8) * r.hann(F.col("x"), 8) + 1e-6, 9).alias("weight"))


@query("""SELECT image, i * 384 AS y0, i * 384 + 512 AS y1, j * 384 AS x0, j * 384 + 512 AS x1 FROM (SELECT *, unnest(range(0, 1 + CAST(ceil(greatest(h - 512, 0) / 384.0) AS BIGINT))) AS i FROM %s) a,
LATERAL (SELECT unnest(range(0, 1 + CAST(ceil(greatest(w - 512, 0) / 384.0) AS BIGINT))) AS j)""" % DIM_SQL)
def tiles_overlap(spark, d):
    return r.overlap_tiles(dims(spark, d)).select("image", "y0", "y1", "x0", "x1")


GRID_SQL = """(SELECT image, stem || '_' || x0 || '_' || y0 AS tile FROM (SELECT *, unnest(list_distinct(list_append(range(0, greatest(h - 1024, 0) + 1, 1024), greatest(h - 1024, 0)))) AS y0 FROM %s WHERE w >= 1024 AND h >= 1024) a,
LATERAL (SELECT unnest(list_distinct(list_append(range(0, greatest(w - 1024, 0) + 1, 1024), greatest(w - 1024, 0)))) AS x0))""" % DIM_SQL


@query(f"SELECT * FROM {GRID_SQL}")
def tiles_gridcrop(spark, d):
    return r.grid_tiles(dims(spark, d).filter("w >= 1024 and h >= 1024"), 1024).select("image", "tile")


@query(f"SELECT * FROM {GRID_SQL} UNION ALL SELECT image, stem || '_full' FROM {DIM_SQL} WHERE w >= 1024 AND h >= 1024")
def tiles_with_full(spark, d):
    whole = dims(spark, d).filter("w >= 1024 and h >= 1024").select("image", F.concat("stem", F.lit("_full")).alias("tile"))
    return tiles_gridcrop(spark, d).unionByName(whole)


@query(f"SELECT image, y, x, v FROM {PIX_SQL}")
def pixel_explode(spark, d):
    return pix(spark, d)


@query(f"SELECT x AS channel, round(avg(v), 6) AS mean, round(sqrt(greatest(sum(v * v) / count(*) - avg(v) * avg(v), 0)), 6) AS std FROM {PIX_SQL} GROUP BY 1")
def channel_mean_std(spark, d):
    return moments(pix(spark, d), F.col("x").alias("channel"))


def moments(pixels: DataFrame, *by) -> DataFrame:
    """Mean and population deviation from three sums, which add up over partitions."""
    v, n = F.col("v"), F.count("*")
    var = F.sum(v * v) / n - F.avg(v) * F.avg(v)
    return pixels.groupBy(*by).agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.sqrt(F.greatest(var, F.lit(0.0))), 6).alias("std"))


@query(f"SELECT image, round(avg(v), 6) AS mean, round(sqrt(greatest(sum(v * v) / count(*) - avg(v) * avg(v), 0)), 6) AS std FROM {PIX_SQL} GROUP BY 1")
def image_mean_std(spark, d):
    return moments(pix(spark, d), "image")


EDGE_SQL = f"(SELECT image, round(count(*) FILTER (v > 0 AND (y IN (0, 7) OR x IN (0, 7))) / 28.0::DOUBLE, 6) AS occupancy FROM {PIX_SQL} GROUP BY 1)"


@query(f"SELECT * FROM {EDGE_SQL}")
def edge_occupancy(spark, d):
    return occupancy(pix(spark, d), 8, 8)


def occupancy(pixels: DataFrame, h: int, w: int) -> DataFrame:
    """Share of the border that the mask covers; corners count once, in a thin image all pixels are border."""
    border = h * w if min(h, w) <= 1 else 2 * (h + w) - 4
    at = F.col("y").isin(0, h - 1) | F.col("x").isin(0, w - 1)
    return pixels.groupBy("image").agg(F.round(F.count_if(at & (F.col("v") > 0)) / border, 6).alias("occupancy"))


@query(f"SELECT * FROM {EDGE_SQL} WHERE occupancy <= 0.5")
def filter_edge_occupancy(spark, d):
    return edge_occupancy(spark, d).filter(F.col("occupancy") <= 0.5)


@query(f"""SELECT image, coalesce(min(x) FILTER (v > 0.3), 0) AS x0, coalesce(min(y) FILTER (v > 0.3), 0) AS y0, CASE WHEN count(*) FILTER (v > 0.3) = 0 THEN 8 ELSE greatest(max(x) FILTER (v > 0.3), min(x) FILTER (v > 0.3) + 1) END AS x1,
CASE WHEN count(*) FILTER (v > 0.3) = 0 THEN 8 ELSE greatest(max(y) FILTER (v > 0.3), min(y) FILTER (v > 0.3) + 1) END AS y1 FROM {PIX_SQL} GROUP BY 1""")
def mask_bbox(spark, d):
    on = F.col("v") > 0.3
    lo, hi = (lambda c: F.min(F.when(on, F.col(c)))), (lambda c: F.max(F.when(on, F.col(c))))
    end = lambda c: F.coalesce(F.greatest(hi(c), lo(c) + 1), F.lit(8)).cast("long")
    start = lambda c: F.coalesce(lo(c), F.lit(0)).cast("long")
    return pix(spark, d).groupBy("image").agg(start("x").alias("x0"), start("y").alias("y0"), end("x").alias("x1"), end("y").alias("y1"))


@query(f"SELECT image FROM {PIX_SQL} GROUP BY 1 HAVING NOT (min(CASE WHEN v > 0.45 THEN 255 ELSE 0 END) = 0 AND max(CASE WHEN v > 0.45 THEN 255 ELSE 0 END) = 0)")
def drop_empty_masks(spark, d):
    mask = pix(spark, d).select("image", F.when(F.col("v") > 0.45, 255).otherwise(0).alias("m"))
    return mask.groupBy("image").agg(F.min("m").alias("lo"), F.max("m").alias("hi")).filter("not (lo = 0 and hi = 0)").select("image")


@query(f"""WITH p AS (SELECT image // 4 AS image, (image % 4 // 2) * 4 + y AS y, (image % 2) * 4 + x AS x, CASE WHEN v < -0.4 THEN NULL ELSE v END AS v, (0.5 - 0.5 * cos(2 * pi() * y / 7)) * (0.5 - 0.5 * cos(2 * pi() * x / 7)) + 1e-6 AS w FROM {PIX_SQL})
SELECT image, y, x, CASE WHEN round(sum(coalesce(v, 0) * w) / sum(w), 9) >= 0.02 THEN 255 ELSE 0 END AS m FROM p GROUP BY 1, 2, 3""")
def stitch_tiles(spark, d):
    """Four tiles of eight make a plane of twelve; where they overlap, centres weigh more."""
    p = pix(spark, d)
    tile = p.select(
        r.div(F.col("image"), 4).alias("image"),
        (r.div(F.col("image") % 4, 2) * 4 + F.col("y")).alias("y"),
        (F.col("image") % 2 * 4 + F.col("x")).alias("x"),
        F.when(F.col("v") < -0.4, float("nan")).otherwise(F.col("v")).alias("p"),
        (r.hann(F.col("y"), 8) * r.hann(F.col("x"), 8) + 1e-6).alias("w"),
    )
    mean = F.round(F.sum(F.nanvl("p", F.lit(0.0)) * F.col("w")) / F.sum("w"), 9)
    return tile.groupBy("image", "y", "x").agg(F.when(mean >= 0.02, 255).otherwise(0).alias("m"))


@query(f"SELECT image, y, x, v FROM {PIX_SQL} WHERE y < 5 AND x < 6")
def unpad_pixels(spark, d):
    return pix(spark, d).filter("y < 5 and x < 6")


@query(f"SELECT image, y, x, CASE WHEN v > 0 THEN CASE WHEN label = 0 THEN 27 ELSE label END ELSE 0 END AS m FROM {PIX_SQL}")
def remap_mask(spark, d):
    labelled = r.pixels(table(spark, d, "embeddings"), "vec_id", "embedding", 8, F.nullif("label", F.lit(0)).alias("class_id"))
    return labelled.select("image", "y", "x", F.when(F.col("v") > 0, F.coalesce("class_id", F.lit(27))).otherwise(0).alias("m"))


@query(f"SELECT image, y, x, CASE WHEN v > 0 THEN CAST(floor(0.4::DOUBLE * 200 + 0.6::DOUBLE * (y * 30)) AS BIGINT) ELSE y * 30 END AS g FROM {PIX_SQL}")
def overlay_blend(spark, d):
    base = F.col("y") * 30
    return pix(spark, d).select("image", "y", "x", F.when(F.col("v") > 0, F.floor(0.4 * F.lit(200) + 0.6 * base)).otherwise(base).cast("long").alias("g"))


@query(f"SELECT image, y, x, CASE WHEN v > 0 THEN least(255, CAST(trunc(label * 60 * 1.5::DOUBLE) AS INT)) ELSE 0 END AS red FROM {PIX_SQL}")
def colorize_mask(spark, d):
    red = F.least(F.lit(255), (F.col("label") * 60 * 1.5).cast("int"))
    return r.pixels(table(spark, d, "embeddings"), "vec_id", "embedding", 8, F.col("label")).select("image", "y", "x", F.when(F.col("v") > 0, red).otherwise(0).alias("red"))


@query(f"""WITH m AS (SELECT *, max(v) OVER (PARTITION BY image) AS top FROM (SELECT image, y, x, CASE WHEN v > 0 THEN round(v * (image % 3 * 50 + 1), 6) ELSE 0 END AS v FROM {PIX_SQL}))
SELECT image, y, x, CASE WHEN top <= 1 THEN CAST(trunc(v * 255) AS INT) WHEN top < 255 THEN CAST(trunc(v * 255 / top) AS INT) ELSE CAST(trunc(v) AS INT) END AS alpha FROM m""")
def cutout_alpha(spark, d):
    e = table(spark, d, "embeddings")
    scaled = F.transform("embedding", lambda v: F.when(v > 0, F.round(v.cast("double") * (F.col("vec_id") % 3 * 50 + 1), 6)).otherwise(0.0))
    planes = e.select("vec_id", scaled.alias("plane"))
    m = r.pixels(planes, "vec_id", "plane", 8, F.array_max("plane").alias("top"))
    alpha = F.when(F.col("top") <= 1, F.col("v") * 255).when(F.col("top") < 255, F.col("v") * 255 / F.col("top")).otherwise(F.col("v"))
    return m.select("image", "y", "x", alpha.cast("int").alias("alpha"))


@query(f"SELECT image, y, x, CASE WHEN abs(v) * 100 < 5 AND y < 5 AND x < 5 THEN 0 ELSE 255 END AS alpha FROM {PIX_SQL}")
def black_transparent(spark, d):
    dark = (F.abs("v") * 100 < 5) & (F.col("y") < 5) & (F.col("x") < 5)
    return pix(spark, d).select("image", "y", "x", F.when(dark, 0).otherwise(255).alias("alpha"))


@query(f"SELECT g.image, g.y, g.x, coalesce(p.v, -1) AS v FROM (SELECT vec_id AS image, i // 12 AS y, i % 12 AS x FROM embeddings, range(0, 120) t(i)) g LEFT JOIN {PIX_SQL} p ON p.image = g.image AND p.y = g.y - 1 AND p.x = g.x - 2")
def pad_pixels(spark, d):
    """Eight by eight into ten by twelve, centred."""
    inside = lambda y, x: F.when(y.between(1, 8) & x.between(2, 9), (y - 1) * 8 + x - 2)
    return r.picked(table(spark, d, "embeddings"), "vec_id", "embedding", 10, 12, inside).withColumn("v", F.coalesce("v", F.lit(-1.0)))


@query(f"SELECT g.image, g.y, g.x, p.v FROM (SELECT vec_id AS image, i // 11 AS y, i % 11 AS x FROM embeddings, range(0, 110) t(i)) g JOIN {PIX_SQL} p ON p.image = g.image AND p.y = 7 - abs(7 - g.y) AND p.x = 7 - abs(7 - g.x)")
def pad_reflect(spark, d):
    return r.picked(table(spark, d, "embeddings"), "vec_id", "embedding", 10, 11, lambda y, x: r.reflected(y, 8) * 8 + r.reflected(x, 8))


@query(f"SELECT image, oy, ox, y - oy AS y, x - ox AS x, v FROM {PIX_SQL} p JOIN (VALUES (0, 0), (0, 3), (3, 0), (3, 3)) t(oy, ox) ON y >= oy AND y < oy + 5 AND x >= ox AND x < ox + 5")
def crop_pixels(spark, d):
    """Each pixel names the tiles that hold it; no join of tiles and pixels."""
    of = lambda c: F.filter(F.array(F.lit(0), F.lit(3)), lambda o: (F.col(c) >= o) & (F.col(c) < o + 5))
    cut = pix(spark, d).withColumn("oy", F.explode(of("y"))).withColumn("ox", F.explode(of("x")))
    return cut.select("image", "oy", "ox", (F.col("y") - F.col("oy")).alias("y"), (F.col("x") - F.col("ox")).alias("x"), "v")


@query(f"SELECT g.image, g.y, g.x, p.v FROM (SELECT vec_id AS image, i // 5 AS y, i % 5 AS x FROM embeddings, range(0, 30) t(i)) g JOIN {PIX_SQL} p ON p.image = g.image AND p.y = CAST(floor((g.y + 0.5) * 8 / 6) AS INT) AND p.x = CAST(floor((g.x + 0.5) * 8 / 5) AS INT)")
def resize_nearest(spark, d):
    near = lambda c, n: F.floor((c + 0.5) * 8 / n).cast("int")
    return r.picked(table(spark, d, "embeddings"), "vec_id", "embedding", 6, 5, lambda y, x: near(y, 6) * 8 + near(x, 5))


@query(f"SELECT image, y, x, CASE WHEN v > 0 THEN 1 ELSE 0 END AS upload, CASE WHEN v > 0.1 THEN 1 ELSE 0 END AS train FROM {PIX_SQL}")
def binarise_mask(spark, d):
    return pix(spark, d).select("image", "y", "x", F.when(F.col("v") > 0, 1).otherwise(0).alias("upload"), F.when(F.col("v") > 0.1, 1).otherwise(0).alias("train"))


PARTS_SQL = f"""WITH RECURSIVE on_px AS (SELECT image, y, x, y * 8 + x AS i FROM {PIX_SQL} WHERE v > 0),
step AS (SELECT a.image, a.i, b.i AS j FROM on_px a JOIN on_px b ON a.image = b.image AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
reach AS (SELECT image, i, i AS least FROM on_px UNION SELECT s.image, s.j, r.least FROM reach r JOIN step s ON s.image = r.image AND s.i = r.i WHERE r.least < s.j),
part AS (SELECT image, i, min(least) AS part FROM reach GROUP BY 1, 2), sizes AS (SELECT image, part, count(*) AS n FROM part GROUP BY 1, 2)
SELECT vec_id AS image, count(n) AS parts, coalesce(max(n), 0) AS largest, CAST(coalesce(sum(n) FILTER (n >= 3), 0) AS BIGINT) AS kept FROM embeddings LEFT JOIN sizes ON image = vec_id GROUP BY 1"""


#: Parts below so many pixels go.
LEAST_PART = 3


@query(PARTS_SQL)
def connected_components(spark, d) -> DataFrame:
    """Parts of each mask: how many, the largest, and how much is left without those below three pixels; masks don't depend on each other."""

    def run(it):
        for rows in it:
            sizes = [component_sizes(np.array(v).reshape(-1, 8) > 0) for v in rows["embedding"]]
            yield pd.DataFrame({"image": rows["vec_id"], "parts": [len(s) for s in sizes], "largest": [max(s, default=0) for s in sizes], "kept": [sum(n for n in s if n >= LEAST_PART) for s in sizes]})

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "image long, parts long, largest long, kept long")


@query(PARTS_SQL)
def mask_parts(spark, d) -> DataFrame:
    """The same of masks of any size that come as a row for each pixel, cut into tiles; here each mask is four of them."""
    return part_sizes(parts_of_pixels(pix(spark, d), tile=4), LEAST_PART)


@query("SELECT vec_id, round(list_aggregate(list_transform(range(0, 64), lambda i: embedding[i + 1]::DOUBLE * (i + 1)), 'sum'), 4) AS score, 'ok' AS status FROM embeddings")
def score_batches(spark, d) -> DataFrame:
    weights = np.arange(1, 65, dtype=np.float64)
    scored = score(table(spark, d, "embeddings"), "vec_id", "embedding", lambda: lambda rows: np.stack(list(rows)).astype(np.float64) @ weights)
    return scored.select("vec_id", F.round("score", 4).alias("score"), "status")


def score(rows: DataFrame, key: str, value: str, make) -> DataFrame:
    """``make()`` gives a function of a batch of values; it is called once a task. A batch that fails is tried row by row, and a row that fails has its error as status."""

    def run(it):
        model = make()
        for part in it:
            try:
                got, status = list(model(part[value])), ["ok"] * len(part)
            except Exception:
                got, status = [], []
                for x in part[value]:
                    try:
                        got.append(float(model([x])[0]))
                        status.append("ok")
                    except Exception as e:
                        got.append(float("nan"))
                        status.append(f"failed: {type(e).__name__}")
            yield pd.DataFrame({key: part[key], "score": got, "status": status})

    return rows.select(key, value).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, score double, status string")
