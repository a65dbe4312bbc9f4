"""RGB-D audit: error summaries, masks, reprojection joins, descriptor matching, roll-ups.

Pixel tables have one row per (image, y, x); images stay whole under hash partitioning by image."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.quantiles import aggregate

def finite(c: str) -> Column:
    return F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c))


def summarize(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """Count, mean, median, 95th percentile and maximum of the finite values; 0 and nulls where there are none."""
    v = rows.select(*keys, finite(value).alias("v"))
    done = aggregate(v, list(keys), [F.count("v").alias("n"), F.avg("v").alias("mean"), F.max("v").alias("max")], {"median": ("v", 0.5), "p95": ("v", 0.95)})
    return done.select(*keys, "n", "mean", "median", "p95", "max")


def depth_frame_stats(pixels: DataFrame) -> DataFrame:
    """pixels(sequence, frame, depth) -> per sequence: least, greatest, median of the frames' medians over positive depth, and
    its bad frames: those with a depth that is null, NaN or infinite, and those without a positive one. A frame's pixels are
    one group; a sequence's frames may be any number."""
    pos = F.when(finite("depth") > 0, F.col("depth"))
    unfit = F.col("depth").isNull() | F.isnan("depth") | (F.abs("depth") == float("inf"))
    frames = pixels.withColumn("p", pos).groupBy("sequence", "frame").agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.percentile("p", F.lit(0.5)).alias("mid"), F.count_if(unfit).alias("bad"))
    bad = F.count_if(F.col("lo").isNull() | (F.col("bad") > 0)).alias("bad_frames")
    return aggregate(frames, ["sequence"], [F.min("lo").alias("least"), F.max("hi").alias("greatest"), bad], {"median": ("mid", 0.5)})


def rgb_frame_checks(images: DataFrame, width: int, height: int) -> DataFrame:
    """images(id, width, height, data array) -> empty, wrong_size (either side) or constant."""
    n = F.size("data")
    wrong = (F.col("width") != width) | (F.col("height") != height) | (n % (width * height) != 0)
    why = F.when(F.col("data").isNull() | (n == 0), "empty").when(wrong, "wrong_size").when(F.array_min("data") == F.array_max("data"), "constant")
    return images.select("id", why.alias("problem")).filter("problem is not null")


def depth_channel_checks(images: DataFrame) -> DataFrame:
    """images(id, r, g, b arrays) -> whether depth is finite and positive and the channels are the same."""
    same = lambda a, b: F.forall(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda ok: ok)
    good = F.forall("r", lambda v: v.isNotNull() & ~F.isnan(v) & (v > 0) & (v < float("inf")))
    return images.select("id", good.alias("positive"), (same("r", "g") & same("r", "b")).alias("same_channels"))


def tolerance(depth: Column) -> Column:
    return F.greatest(F.lit(0.08), 0.002 * depth)


def depth_stable_mask(pixels: DataFrame, *image: str) -> DataFrame:
    """Pixels with their 3 x 3 range and whether it is small: two windows, over rows and then over columns, edges clipped."""
    across = Window.partitionBy(*image, "y").orderBy("x").rowsBetween(-1, 1)
    down = Window.partitionBy(*image, "x").orderBy("y").rowsBetween(-1, 1)
    rows = pixels.withColumns({"_lo": F.min("depth").over(across), "_hi": F.max("depth").over(across)})
    rows = rows.withColumns({"lo": F.min("_lo").over(down), "hi": F.max("_hi").over(down)}).drop("_lo", "_hi")
    return rows.withColumn("stable", (F.col("hi") - F.col("lo") <= tolerance(F.col("depth"))) & (F.col("lo") > 0))


def project_pixels(pixels: DataFrame, f: str = "f", c: str = "c", radial: bool = False) -> DataFrame:
    """pixels(x, y, depth, f, c, r00..r22, t0..t2) -> u, v, z in the other camera: unproject at the pixel's centre, move,
    project. Behind the camera u and v are null."""
    a, b = (F.col("x") + 0.5 - F.col(c)) / F.col(f), (F.col("y") + 0.5 - F.col(c)) / F.col(f)
    z = F.col("depth") / F.sqrt(a * a + b * b + 1) if radial else F.col("depth")
    p = (a * z, b * z, z)
    q = [sum((F.col(f"r{i}{j}") * p[j] for j in range(3)), F.col(f"t{i}")) for i in range(3)]
    ahead = q[2] > 1e-9
    return pixels.withColumns({"u": F.when(ahead, q[0] / q[2] * F.col(f) + F.col(c)), "v": F.when(ahead, q[1] / q[2] * F.col(f) + F.col(c)), "z": q[2]})


def sample_image(points: DataFrame, image: DataFrame, keys: list[str], value: str = "depth", nearest: bool = False) -> DataFrame:
    """Bilinear or nearest sample of image(keys, x, y, value) at (u, v), pixel centres at +0.5, zero outside: each point is
    exploded to its four neighbours, joined on equal keys and summed back; a nearest sample has one neighbour."""
    x, y = F.col("u") - 0.5, F.col("v") - 0.5
    if nearest:
        at = points.withColumns({"x": F.floor("u").cast("int"), "y": F.floor("v").cast("int")})
        found = at.join(image.select(*keys, "x", "y", F.col(value).alias("_v")), [*keys, "x", "y"], "left")
        return found.select("point", *keys, F.coalesce("_v", F.lit(0.0)).alias("sample"))
    x0, y0 = F.floor(x), F.floor(y)
    corner = lambda i, j: F.struct((x0 + i).cast("int").alias("x"), (y0 + j).cast("int").alias("y"), ((x - x0 if i else 1 - x + x0) * (y - y0 if j else 1 - y + y0)).alias("w"))
    four = points.select("point", *keys, F.explode(F.array(*(corner(i, j) for i in (0, 1) for j in (0, 1)))).alias("n")).select("point", *keys, "n.*")
    found = four.join(image.select(*keys, "x", "y", F.col(value).alias("_v")), [*keys, "x", "y"], "left")
    return found.groupBy("point", *keys).agg(F.sum(F.col("w") * F.coalesce("_v", F.lit(0.0))).alias("sample"))


def descriptor_match(left: DataFrame, right: DataFrame, ratio: float = 0.75, least: int = 8) -> DataFrame:
    """left and right(pair, id, d array): mutual nearest neighbours whose distance is under ratio of the second's, both ways,
    inside an image pair. A pair with fewer than `least` features or matches has none. Features of one image are bounded by
    the detector; the join is on the pair."""
    features = left.groupBy("pair").agg(F.count("*").alias("na")).join(right.groupBy("pair").agg(F.count("*").alias("nb")), "pair").filter((F.col("na") >= least) & (F.col("nb") >= least)).select("pair")
    l = left.join(features, "pair", "left_semi").select("pair", F.col("id").alias("a"), F.col("d").alias("da"))  # noqa: E741
    r = right.select("pair", F.col("id").alias("b"), F.col("d").alias("db"))
    sq = F.aggregate(F.zip_with("da", "db", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    both = l.join(r, "pair").select("pair", "a", "b", F.sqrt(sq).alias("dist"))

    def best(side: str, other: str) -> DataFrame:
        near = Window.partitionBy("pair", side).orderBy("dist", other)
        two = both.withColumns({"rank": F.row_number().over(near), "d2": F.lead("dist").over(near)})
        return two.filter((F.col("rank") == 1) & (F.col("dist") < ratio * F.col("d2"))).withColumnRenamed("dist", "d1")

    found = best("a", "b").select("pair", "a", "b", "d1").join(best("b", "a").select("pair", "a", "b"), ["pair", "a", "b"])
    enough = found.groupBy("pair").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return found.join(enough.select("pair"), "pair", "left_semi").withColumnRenamed("d1", "dist")


def homography_from(four: np.ndarray) -> np.ndarray:
    """Homographies (n, 3, 3) through n times four matches (ax, ay, bx, by), all solved at once."""
    x, y, u, v = (four[:, :, k] for k in range(4))
    one, none = np.ones_like(x), np.zeros_like(x)
    top = np.stack([x, y, one, none, none, none, -u * x, -u * y, -u], axis=2)
    low = np.stack([none, none, none, x, y, one, -v * x, -v * y, -v], axis=2)
    return np.linalg.svd(np.concatenate([top, low], axis=1))[2][:, -1].reshape(-1, 3, 3)


def half_float_step(depth: Column) -> Column:
    """Spacing of 16-bit floats at a depth in the normal range."""
    return F.pow(F.lit(2.0), F.floor(F.log2(depth)) - 10)


def occlusion_fractions(pixels: DataFrame) -> DataFrame:
    """pixels(pair, suffix, y, x, depth): shares of a pair's pixels where both passes agree and where occ is farther."""
    pick = lambda s: F.max(F.when(F.col("suffix") == s, F.col("depth")))
    both = pixels.groupBy("pair", "y", "x").agg(pick("GT").alias("gt"), pick("occ").alias("occ")).filter("gt is not null and occ is not null")
    near = F.abs(F.col("gt") - F.col("occ")) <= tolerance(F.col("gt"))
    return both.groupBy("pair").agg(F.avg(near.cast("double")).alias("equal"), F.avg(((F.col("occ") > F.col("gt")) & ~near).cast("double")).alias("farther"))


def raw_intrinsic_delta(rows: DataFrame) -> DataFrame:
    """rows(id, focal_mm, film_mm, width, fx): fx from lens and film against the stored one."""
    return rows.withColumn("delta", F.col("focal_mm") / F.col("film_mm") * F.col("width") - F.col("fx"))


def depth_display_range(pixels: DataFrame, *image: str) -> DataFrame:
    """Pixels scaled to 0..255 between the image's 1st and 99th percentile, at least 0.05 apart."""
    ends = pixels.groupBy(*image).agg(F.expr("percentile(depth, array(0.01, 0.99))").alias("p"))
    ends = ends.select(*image, F.get("p", 0).alias("lo"), F.greatest(F.get("p", 1), F.get("p", 0) + 0.05).alias("hi"))
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(255.0), (F.col("depth") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 255))
    return pixels.join(ends, list(image)).withColumn("shade", scaled)
