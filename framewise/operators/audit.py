"""The RGB-D audit over real images and poses: relative poses under eight hypotheses, dense and feature reprojection, scale
fit and roll-ups.

An image is a set of rows (image, y, x, depth, red, green, blue); a pose is a camera-to-world matrix (sequence, frame,
r00..r22, t0..t2); a pair names two images and their frames. All joins are on pair or on (image, y, x), so that any number of
pairs spreads over the cluster; the tables of hypotheses have eight rows a pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from framewise.operators.quantiles import aggregate
from framewise.operators.rgbd import finite, homography_from
from framewise.sources.store import stash

# Frame pairs of the dense audit, those of the feature audit for each pass, the last frame.
DENSE_PAIRS = ((0, 1), (5, 6), (11, 12), (12, 13), (18, 19), (23, 24), (12, 14), (0, 12))
FEATURE_PAIRS = (("GT", 0, 1), ("GT", 12, 13), ("GT", 23, 24), ("occ", 12, 13))
LAST_FRAME = 24
# The hypotheses. The first is right; each other one is wrong in one way.
HYPOTHESES = ("correct", "depth_cm_as_m", "depth_divide_twice", "double_yz_flip", "c2w_as_w2c", "focal_x2", "radial_depth", "pose_frame_plus1")

R = [[f"r{i}{j}" for j in range(3)] for i in range(3)]
T = [f"t{i}" for i in range(3)]


def audit_pairs(sequences: DataFrame) -> DataFrame:
    """sequences x the dense pairs of both passes: frame_a, frame_b, suffix, kind 'dense'; and the feature pairs."""
    rows = [(a, b, s, "dense") for a, b in DENSE_PAIRS for s in ("GT", "occ")] + [(a, b, s, "feature") for s, a, b in FEATURE_PAIRS]
    return sequences.crossJoin(F.broadcast(sequences.sparkSession.createDataFrame(rows, "frame_a int, frame_b int, suffix string, kind string")))


def _mul(a: list[list[Column]], b: list[list[Column]]) -> list[list[Column]]:
    return [[sum((a[i][k] * b[k][j] for k in range(1, 3)), a[i][0] * b[0][j]) for j in range(len(b[0]))] for i in range(3)]


def _t(a: list[list[Column]]) -> list[list[Column]]:
    return [list(x) for x in zip(*a, strict=True)]


def relative_poses(pairs: DataFrame, poses: DataFrame, hypotheses=HYPOTHESES) -> DataFrame:
    """pairs(pair, sequence, frame_a, frame_b, ...) and poses(sequence, frame, r.., t..) -> for each hypothesis the move from
    camera a to camera b (r.., t..) and its depth_scale, focal_scale and radial."""
    modes = pairs.sparkSession.createDataFrame([(m,) for m in hypotheses], "mode string")
    rows = pairs.crossJoin(F.broadcast(modes))
    later = lambda c: F.when(F.col("mode") == "pose_frame_plus1", F.least(F.col(c) + 1, F.lit(LAST_FRAME))).otherwise(F.col(c))
    side = lambda s: poses.select("sequence", F.col("frame").alias(f"at_{s}"), F.struct(*T, *(c for r in R for c in r)).alias(s))
    rows = rows.withColumns({"at_a": later("frame_a"), "at_b": later("frame_b")})
    rows = rows.join(side("a"), ["sequence", "at_a"]).join(side("b"), ["sequence", "at_b"])

    def pose(s: str) -> tuple[list[list[Column]], list[list[Column]]]:
        r, t = [[F.col(f"{s}.{c}") for c in row] for row in R], [[F.col(f"{s}.{c}")] for c in T]
        back = [[-x[0]] for x in _mul(_t(r), t)]  # of the inverse: -R^T t
        inverse, flip = F.col("mode") == "c2w_as_w2c", F.col("mode") == "double_yz_flip"
        pick = lambda yes, no: F.when(inverse, yes).otherwise(no)
        turned = [[pick(r[j][i], r[i][j]) for j in range(3)] for i in range(3)]
        turned = [[row[0], *(F.when(flip, -x).otherwise(x) for x in row[1:])] for row in turned]  # both axes once more
        return turned, [[pick(back[i][0], t[i][0])] for i in range(3)]

    (ra, ta), (rb, tb) = pose("a"), pose("b")
    move, shift = _mul(_t(rb), ra), _mul(_t(rb), [[ta[i][0] - tb[i][0]] for i in range(3)])
    scale = F.when(F.col("mode") == "depth_cm_as_m", 100.0).when(F.col("mode") == "depth_divide_twice", 0.01).otherwise(1.0)
    out = {R[i][j]: move[i][j] for i in range(3) for j in range(3)} | {T[i]: shift[i][0] for i in range(3)}
    out |= {"depth_scale": scale, "focal_scale": F.when(F.col("mode") == "focal_x2", 2.0).otherwise(1.0), "radial": F.col("mode") == "radial_depth"}
    return rows.select(*pairs.columns, "mode", *(v.alias(k) for k, v in out.items()))


def projected(rows: DataFrame, x: str = "x", y: str = "y", depth: str = "depth", f: str = "f", c: str = "c") -> DataFrame:
    """rows with a move -> qx, qy (pixel index coordinates in the other image) and z. A pixel's centre is at +0.5; f is
    multiplied by focal_scale and depth by depth_scale; a radial depth is along the ray."""
    focal = F.col(f) * F.col("focal_scale")
    a, b = (F.col(x) + 0.5 - F.col(c)) / focal, (F.col(y) + 0.5 - F.col(c)) / focal
    d = F.col(depth) * F.col("depth_scale")
    d = F.when(F.col("radial"), d / F.sqrt(a * a + b * b + 1)).otherwise(d)
    p = [[a * d], [b * d], [d]]
    q = [m[0] + F.col(t) for m, t in zip(_mul([[F.col(c) for c in r] for r in R], p), T, strict=True)]
    safe = F.when(F.abs(q[2]) > 1e-12, q[2]).otherwise(1e-12)
    return rows.withColumns({"qx": focal * q[0] / safe + F.col(c) - 0.5, "qy": focal * q[1] / safe + F.col(c) - 0.5, "z": q[2]})


class Image:
    """Pixel rows (y, x, values) of one image as arrays; a pixel that has no row, or no value, is zero."""

    def __init__(self, rows: pa.Table, values: list[str], width: int | None = None, height: int | None = None):
        y, x = rows["y"].to_numpy().astype(np.int64), rows["x"].to_numpy().astype(np.int64)
        self.height = height or (int(y.max()) + 1 if len(y) else 0)
        self.width = width or (int(x.max()) + 1 if len(x) else 0)
        inside = (y >= 0) & (y < self.height) & (x >= 0) & (x < self.width)
        self.of: dict[str, np.ndarray] = {}
        for v in values:
            self.of[v] = np.zeros((self.height, self.width))
            self.of[v][y[inside], x[inside]] = pc.fill_null(rows[v].cast(pa.float64()), 0.0).to_numpy()[inside]

    def stable(self) -> np.ndarray:
        """Where the 3 x 3 depths, clipped at the edges, are positive and close together."""
        d = self.of["depth"]
        around = lambda edge: np.pad(d, 1, constant_values=edge)
        shifted = lambda p: np.stack([p[i : i + self.height, j : j + self.width] for i in range(3) for j in range(3)])
        low, high = shifted(around(np.inf)).min(0), shifted(around(-np.inf)).max(0)
        return (low > 0) & np.isfinite(d) & (high - low <= np.maximum(0.08, 0.002 * d))

    def _at(self, values: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        inside = (y >= 0) & (y < self.height) & (x >= 0) & (x < self.width)
        out = np.zeros(len(x))
        out[inside] = values[y[inside].astype(np.int64), x[inside].astype(np.int64)]
        return out

    def bilinear(self, values: np.ndarray, qx: np.ndarray, qy: np.ndarray) -> np.ndarray:
        x, y = np.floor(qx), np.floor(qy)
        fx, fy = qx - x, qy - y
        return sum(np.where(np.isfinite(w := (fx if i else 1 - fx) * (fy if j else 1 - fy)), w, 0.0) * self._at(values, y + j, x + i) for i in (0, 1) for j in (0, 1))

    def nearest(self, values: np.ndarray, qx: np.ndarray, qy: np.ndarray) -> np.ndarray:
        return self._at(values, np.floor(qy) + (qy - np.floor(qy) >= 0.5), np.floor(qx) + (qx - np.floor(qx) >= 0.5))


COLOURS = ("red", "green", "blue")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Dealt by key over all shuffle partitions: few bytes can be much work, so partitions are not to be joined by size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def sampled(points: DataFrame, images: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """points(keys, qx, qy, image_b) with the bilinear samples of `values` of image_b (v_b), zero outside, and whether the
    nearest pixel's depths are stable (stable_b). Points meet their image's pixels in one group of the image, which is an array there;
    no point is multiplied."""
    names = [*keys, "qx", "qy"]
    kinds = {f.name: f.dataType for f in points.schema}
    schema = T_.StructType([*(T_.StructField(k, kinds[k]) for k in keys), *(T_.StructField(f"{v}_b", T_.DoubleType()) for v in values), T_.StructField("stable_b", T_.BooleanType())])

    def run(points_: pa.Table, pixels: pa.Table) -> pa.Table:
        image = Image(pixels, list(dict.fromkeys(["depth", *values])))
        qx, qy = (points_[c].to_numpy().astype(float) for c in ("qx", "qy"))
        with np.errstate(invalid="ignore"):
            found = {f"{v}_b": pa.array(image.bilinear(image.of[v], qx, qy)) for v in values}
            stable = pa.array(image.nearest(image.stable(), qx, qy) > 0)
        return pa.table({k: points_[k] for k in keys} | found | {"stable_b": stable})

    here = images.select("image", "y", "x", *dict.fromkeys(["depth", *values]))
    return _dealt(points.select("image_b", *names), "image_b").groupBy("image_b").cogroup(_dealt(here, "image").groupBy("image")).applyInArrow(run, schema)


_SUMMARY = ("mean", "median", "p95", "max")
_DENSE = {
    "samples": "long", "in_bounds": "long", "stable": "long", "visible": "long", **{f"{k}_error": "double" for k in _SUMMARY}, "stable_p95": "double",
    **{f"{k}_error_all": "double" for k in _SUMMARY}, "rgb_support": "long", "rgb_sse": "double",
}


def _summary(e: np.ndarray) -> dict[str, float | None]:
    return dict(zip(_SUMMARY, (e.mean(), np.quantile(e, 0.5), np.quantile(e, 0.95), e.max()), strict=True)) if len(e) else dict.fromkeys(_SUMMARY)


def _hypothesis(m: dict, a: Image, b: Image, stable_a: np.ndarray, stable_b: np.ndarray, stride: int) -> dict[str, np.ndarray]:
    """Every stride-th pixel of image a under one move: the masks, the depth error and the squared colour difference."""
    y, x = (v.ravel() for v in np.mgrid[0 : a.height : stride, 0 : a.width : stride])
    focal, c, depth = m["f"] * m["focal_scale"], m["c"], a.of["depth"][y, x]
    u, v = (x + 0.5 - c) / focal, (y + 0.5 - c) / focal
    d = depth * m["depth_scale"]
    d = d / np.sqrt(u * u + v * v + 1) if m["radial"] else d
    q = np.array([[m[k] for k in row] for row in R]) @ np.stack([u * d, v * d, d]) + np.array([[m[k]] for k in T])
    z, safe = q[2], np.where(np.abs(q[2]) > 1e-12, q[2], 1e-12)
    qx, qy = focal * q[0] / safe + c - 0.5, focal * q[1] / safe + c - 0.5
    inside = (qx >= 1) & (qx < b.width - 2) & (qy >= 1) & (qy < b.height - 2) & (z > 0) & (depth > 0)
    target = b.bilinear(b.of["depth"], qx, qy) * m["depth_scale"]
    if m["radial"]:
        target = target / np.sqrt(((qx + 0.5 - c) / focal) ** 2 + ((qy + 0.5 - c) / focal) ** 2 + 1)
    error = np.abs(target - z)
    stable = inside & stable_a[y, x] & (b.nearest(stable_b, qx, qy) > 0)
    visible = stable & (target > 0) & (error <= np.maximum(0.1 * m["depth_scale"], 0.005 * np.abs(z)))
    squared = sum((b.bilinear(b.of[k], qx, qy) - a.of[k][y, x]) ** 2 for k in COLOURS) / len(COLOURS)
    return {"in_bounds": inside, "stable": stable, "visible": visible, "error": error, "squared": squared}


def dense_pairs(images: DataFrame, pairs: DataFrame, poses: DataFrame, width: int, height: int, stride: int = 4, hypotheses=HYPOTHESES) -> DataFrame:
    """One row for each pair and hypothesis: counts of pixels in bounds, stable and visible, summaries of the depth error over
    the visible ones and over all in bounds, and the colour error over the support. pairs(pair, sequence, frame_a, frame_b,
    image_a, image_b, f, c). Support is what is visible under the correct hypothesis, for all of them; it never looks at colour.

    A pixel row goes to its pairs as it is, and a pair's two images (and its moves) meet in one group, where all hypotheses are
    worked through on arrays: pixels are shuffled once for their image and once for their pairs, whatever the number of
    hypotheses, and a group is two images."""
    moves = relative_poses(pairs, poses, hypotheses)
    sides = pairs.select("pair", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"image_{s}").alias("image")) for s in "ab"))).alias("i")).select("pair", "i.*")
    here = images.select("image", "y", "x", "depth", *COLOURS).join(sides, "image").drop("image")
    move = moves.select(F.col("pair").alias("of"), "mode", "f", "c", *T, *(c for r in R for c in r), "depth_scale", "focal_scale", "radial")

    def run(key, pixels: pa.Table, moves_: pa.Table) -> pa.Table:
        side = lambda s: Image(pixels.filter(pc.equal(pixels["side"], s)), ["depth", *COLOURS], width, height)
        a, b = side("a"), side("b")
        stable_a, stable_b = a.stable(), b.stable()
        rows = {m["mode"]: m for m in moves_.to_pylist()}
        out: dict[str, list] = {"mode": []} | {k: [] for k in _DENSE}
        with np.errstate(invalid="ignore", over="ignore"):
            found = {k: _hypothesis(rows[k], a, b, stable_a, stable_b, stride) for k in hypotheses if k in rows}
        correct = found[hypotheses[0]]["visible"] if hypotheses[0] in found else False
        for mode, h in found.items():
            support = h["in_bounds"] & correct
            row = {"samples": len(h["error"]), "stable_p95": _summary(h["error"][h["stable"]])["p95"], "rgb_support": int(support.sum()), "rgb_sse": float(h["squared"][support].sum())}
            row |= {k: int(h[k].sum()) for k in ("in_bounds", "stable", "visible")}
            row |= {f"{k}_error": v for k, v in _summary(h["error"][h["visible"]]).items()} | {f"{k}_error_all": v for k, v in _summary(h["error"][h["in_bounds"]]).items()}
            for k, v in ({"mode": mode} | row).items():
                out[k].append(v)
        types = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
        columns = {k: pa.array(out[k], types[t]) for k, t in ({"mode": "string"} | _DENSE).items()}
        return pa.table({"pair": pa.array([key[0].as_py()] * len(out["mode"]), pa.int64())} | columns)

    schema = "pair long, mode string, " + ", ".join(f"{k} {t}" for k, t in _DENSE.items())
    out = _dealt(here, "pair").groupBy("pair").cogroup(_dealt(move, "of").groupBy("of")).applyInArrow(run, schema)
    out = out.withColumn("visible_fraction", F.col("visible") / F.greatest("in_bounds", F.lit(1)))
    return out.withColumn("rgb_psnr", rgb_psnr(F.col("rgb_sse"), F.col("rgb_support")))


def rgb_psnr(sse: Column, n: Column) -> Column:
    return F.when(n > 0, 10 * F.log10(255.0**2 / F.greatest(sse / n, F.lit(1e-12))))


def control_rollup(rows: DataFrame, keys: tuple[str, ...] = ("mode",)) -> DataFrame:
    """dense_pairs() -> for each hypothesis (or other keys) the mean of the pairs' PSNR and that of all pixels, support, median
    visibility."""
    sse, n = F.sum("rgb_sse"), F.sum("rgb_support")
    pooled = F.when((n > 0) & (sse > 0), 10 * F.log10(255.0**2 / (sse / n)))
    some = [F.count("*").alias("pairs"), F.avg("rgb_psnr").alias("mean_psnr"), pooled.alias("pooled_psnr"), n.alias("rgb_support")]
    rows = stash(rows.select(*keys, "rgb_psnr", "rgb_sse", "rgb_support", "visible_fraction"), "pairs")
    return aggregate(rows, list(keys), some, {"median_visible": ("visible_fraction", 0.5)})


def pass_evidence(rows: DataFrame) -> DataFrame:
    """dense_pairs() of the correct hypothesis with suffix -> for each pass: pairs, median visible fraction and a summary of
    the pairs' 95th percentiles over stable pixels."""
    p = F.when(F.col("stable") > 0, F.col("stable_p95"))
    rows = stash(rows.filter(F.col("mode") == HYPOTHESES[0]).select("suffix", "visible_fraction", p.alias("p")), "pairs")
    some = [F.count("*").alias("pairs"), F.count("p").alias("n"), F.avg("p").alias("mean"), F.max("p").alias("max")]
    return aggregate(rows, ["suffix"], some, {"median_visible": ("visible_fraction", 0.5), "median": ("p", 0.5), "p95": ("p", 0.95)})


def feature_depth(matches: DataFrame, images: DataFrame) -> DataFrame:
    """matches(pair, match, image_a, ax, ay, ...) with the depth sampled at (ax, ay), where it is positive and stable."""
    points = matches.select("pair", "match", F.col("image_a").alias("image_b"), F.col("ax").alias("qx"), F.col("ay").alias("qy"))
    got = sampled(points, images, ["pair", "match"], ["depth"])
    return matches.join(got.filter("depth_b > 0 and stable_b").select("pair", "match", F.col("depth_b").alias("depth")), ["pair", "match"])


def feature_errors(matches: DataFrame, moves: DataFrame, least: int = 12) -> DataFrame:
    """matches(pair, ax, ay, bx, by, depth) under each hypothesis of moves (relative_poses() with f and c): count, median, mean
    and maximum of the distance to the match; qualified with `least` matches or more."""
    rows = projected(matches.join(moves, "pair"), "ax", "ay").withColumn("e", F.hypot(F.col("qx") - F.col("bx"), F.col("qy") - F.col("by")))
    e = finite("e")
    return rows.groupBy("pair", "mode").agg(F.count("*").alias("matches"), F.percentile(e, F.lit(0.5)).alias("median"), F.avg(e).alias("mean"), F.max(e).alias("max"), (F.count("*") >= least).alias("qualified"))


def feature_error_by_family(errors: DataFrame, families: DataFrame) -> DataFrame:
    """feature_errors() and families(pair, family) -> the distribution of the right hypothesis' medians over the qualified pairs
    of a trajectory family: pairs, least, the quartiles and the greatest. Families without such a pair have no row."""
    rows = errors.filter((F.col("mode") == HYPOTHESES[0]) & F.col("qualified")).join(families.select("pair", "family"), "pair")
    some = [F.count("*").alias("pairs"), F.min("median").alias("least"), F.max("median").alias("greatest")]
    return aggregate(stash(rows.select("family", "median"), "medians"), ["family"], some, {f"q{k}": ("median", k / 4) for k in (1, 2, 3)})


# What the verdict asks for. Metres, degrees, pixels.
MOST_POSITION, MOST_ANGLE, MOST_INTRINSIC, MOST_FEATURE, MOST_DEPTH, MOST_STORED = 0.001, 0.01, 0.001, 1.0, 0.15, 1e-7


def assessment(scopes: DataFrame, poses: DataFrame, raw: DataFrame, stored: DataFrame, features: DataFrame, dense: DataFrame) -> DataFrame:
    """The verdict of each scope with its evidence, from the results of the audit's other steps:

    scopes(sequence, scope); poses(sequence, position_m, rotation_deg) by frame, of pose_error(); raw(sequence, delta) of
    raw_intrinsic_delta(); stored(sequence, pose_delta, k_delta, hash_matches, matched) of stored_payload_delta(), of those that
    have a stored document; features(sequence, mode, median, qualified) of feature_errors() and dense(sequence, mode, suffix,
    stable, stable_p95) of dense_pairs(), whose right hypothesis counts.

    Valid: the largest errors of poses and intrinsics, the median of the qualified feature medians and that of the GT pairs'
    95th percentiles are below the limits, and every stored document is as the fresh one. Evidence that a scope lacks is null
    and makes it invalid, but for stored documents, which it need not have. Frames and pairs are combined by sequence before
    they meet the scopes; medians are exact for any number of pairs."""
    not_nan = lambda c: F.when(~F.isnan(c), F.col(c)).otherwise(F.lit(float("inf")))
    as_is = (F.col("pose_delta") < MOST_STORED) & (F.col("k_delta") < MOST_STORED) & F.col("hash_matches") & F.col("matched")
    of = {
        "poses": poses.groupBy("sequence").agg(F.max(not_nan("position_m")).alias("position"), F.max(not_nan("rotation_deg")).alias("angle")),
        "raw": raw.groupBy("sequence").agg(F.max(F.abs(not_nan("delta"))).alias("intrinsic")),
        "stored": stored.groupBy("sequence").agg(F.bool_and(F.coalesce(as_is, F.lit(False))).alias("as_stored")),
    }
    rows = scopes.select("sequence", "scope")
    for part in of.values():
        rows = rows.join(part, "sequence", "left")
    out = rows.groupBy("scope").agg(
        F.count("*").alias("sequences"), F.max("position").alias("max_position_m"), F.max("angle").alias("max_rotation_deg"), F.max("intrinsic").alias("max_intrinsic_px"),
        F.coalesce(F.bool_and("as_stored"), F.lit(True)).alias("stored_matches"),
        F.count_if(F.col("position").isNull() | F.col("intrinsic").isNull()).alias("unchecked"),
    )
    right = F.col("mode") == HYPOTHESES[0]
    named = scopes.select("sequence", "scope")
    f = stash(features.filter(right & F.col("qualified")).join(named, "sequence").select("scope", "median"), "medians")
    p = stash(dense.filter(right & (F.col("stable") > 0)).join(named, "sequence").select("scope", "stable_p95", F.when(F.col("suffix") == "GT", F.col("stable_p95")).alias("gt")), "p95")
    out = out.join(aggregate(f, ["scope"], [], {"feature_median_px": ("median", 0.5)}), "scope", "left")
    out = out.join(aggregate(p, ["scope"], [], {"gt_depth_p95_m": ("gt", 0.5), "depth_p95_m": ("stable_p95", 0.5)}), "scope", "left")
    below = {"max_position_m": MOST_POSITION, "max_rotation_deg": MOST_ANGLE, "max_intrinsic_px": MOST_INTRINSIC, "feature_median_px": MOST_FEATURE, "gt_depth_p95_m": MOST_DEPTH}
    valid = F.col("stored_matches") & (F.col("unchecked") == 0)
    for c, most in below.items():
        valid = valid & F.coalesce(F.col(c) < most, F.lit(False))
    return out.withColumn("valid", valid)


def _residuals(rows: DataFrame, focal: float, depth: float, name: str) -> DataFrame:
    done = projected(rows.withColumns({"focal_scale": F.lit(focal), "depth_scale": F.lit(depth), "radial": F.lit(False)}), "ax", "ay")
    return done.withColumns({f"{name}x": F.col("qx") - F.col("bx"), f"{name}y": F.col("qy") - F.col("by")}).drop("qx", "qy", "z")


def fit_scales(matches: DataFrame, rounds: int = 40) -> tuple[float, float]:
    """matches with moves (r.., t.., f, c, ax, ay, bx, by, depth) -> the focal and depth scale of least soft-L1 cost, their
    logarithms within 1.5, by damped Gauss-Newton steps on those. A round is one aggregate of the normal equations, six sums,
    over all matches; it ends when a step gains nothing, after 40 rounds at most. No matches: (1, 1)."""
    p, step, cost, best = np.zeros(2), 1e-4, np.inf, np.zeros(2)
    damp = 1e-3
    for _ in range(rounds):
        rows = matches
        for name, d in (("r", (0.0, 0.0)), ("u", (step, 0.0)), ("v", (0.0, step))):
            rows = _residuals(rows, float(np.exp(p[0] + d[0])), float(np.exp(p[1] + d[1])), name)
        sums, total = [F.lit(0.0)] * 5, F.lit(0.0)
        for k in "xy":
            r, du, dv = F.col(f"r{k}"), (F.col(f"u{k}") - F.col(f"r{k}")) / step, (F.col(f"v{k}") - F.col(f"r{k}")) / step
            w = 1 / F.sqrt(1 + r * r)
            sums = [s + w * t for s, t in zip(sums, (du * du, du * dv, dv * dv, du * r, dv * r), strict=True)]
            total = total + 2 * (F.sqrt(1 + r * r) - 1)
        a, b, c, g, h, now = rows.agg(*(F.sum(s) for s in sums), F.sum(total)).first()
        if a is None:
            break
        if now < cost:
            gain, cost, best, damp = cost - now, now, p, damp / 3
            normal, slope = np.array([[a, b], [b, c]]), np.array([g, h])
            if gain < 1e-10 * now:
                break
        else:
            damp *= 10
            if damp > 1e7:
                break
        p = np.clip(best - np.linalg.solve(normal + damp * np.diag(np.diag(normal)) + 1e-12 * np.eye(2), slope), -1.5, 1.5)
    return float(np.exp(best[0])), float(np.exp(best[1]))


def scale_report(matches: DataFrame, focal: float, depth: float) -> DataFrame:
    """matches with `part` (training or holdout): summaries of the absolute coordinate residuals before and after the fit."""
    out = None
    for when, f, d in (("before", 1.0, 1.0), ("after", focal, depth)):
        e = _residuals(matches, f, d, "r").select("part", F.explode(F.array(F.abs("rx"), F.abs("ry"))).alias("e"))
        some = [F.count("e").alias("n"), F.avg("e").alias("mean"), F.max("e").alias("max")]
        s = aggregate(stash(e, "residuals"), ["part"], some, {"median": ("e", 0.5), "p95": ("e", 0.95)}).withColumn("fit", F.lit(when))
        out = s if out is None else out.unionByName(s)
    return out


def homographies(matches: DataFrame, tries: int = 128, seeds: int = 64) -> DataFrame:
    """matches(pair, ax, ay, bx, by) -> hypotheses (pair, h, h00..h22), each through four of the pair's `seeds` matches of the
    smallest hash. Rows are solved together, a batch at a time."""
    w = Window.partitionBy("pair").orderBy(F.xxhash64("ax", "ay", "bx", "by"), "ax", "ay", "bx", "by")
    few = matches.withColumn("k", F.row_number().over(w) - 1).filter(F.col("k") < seeds)
    few = few.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("k", "ax", "ay", "bx", "by"))).alias("m")).filter(F.size("m") >= 4)
    asked = few.select("pair", "m", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))).alias("h"))
    order = F.slice(F.array_sort(F.transform("m", lambda x: F.struct(F.xxhash64("h", x["k"]).alias("o"), x.alias("x")))), 1, 4)
    four = asked.select("pair", "h", F.transform(order, lambda x: x["x"]).alias("m"))
    flat = [F.col("m")[i][c].cast("double").alias(f"{c}{i}") for i in range(4) for c in ("ax", "ay", "bx", "by")]
    names = [f"h{i}{j}" for i in range(3) for j in range(3)]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = homography_from(b[[f"{c}{i}" for i in range(4) for c in ("ax", "ay", "bx", "by")]].to_numpy(float).reshape(-1, 4, 4))
            yield pd.concat([b[["pair", "h"]].reset_index(drop=True), pd.DataFrame(h.reshape(-1, 9), columns=names)], axis=1)

    kind = dict(matches.dtypes)["pair"]
    return four.select("pair", "h", *flat).mapInPandas(solve, f"pair {kind}, h int, " + ", ".join(f"{n} double" for n in names))


def homography_gate(matches: DataFrame, pixels: float = 3.0, tries: int = 128) -> DataFrame:
    """matches within `pixels` of the pair's best hypothesis: every match is scored against every hypothesis of its pair, the
    hypothesis with most matches wins, of equal ones the first. Pairs with under four matches have none. A match that a
    hypothesis moves to infinity is not near."""
    h = lambda i, j: F.col(f"h{i}{j}")
    near = {i: h(i, 0) * F.col("ax") + h(i, 1) * F.col("ay") + h(i, 2) for i in range(3)}
    ok = F.coalesce(F.hypot(F.try_divide(near[0], near[2]) - F.col("bx"), F.try_divide(near[1], near[2]) - F.col("by")) <= pixels, F.lit(False))
    made = homographies(matches, tries)
    votes = matches.join(made, "pair").groupBy("pair", "h").agg(F.count_if(ok).alias("n"))
    best = votes.groupBy("pair").agg(F.max_by("h", F.struct("n", -F.col("h"))).alias("h"))
    return matches.join(made.join(best, ["pair", "h"]), "pair").filter(ok).select(matches.columns)


def point_cloud(pixels: DataFrame, poses: DataFrame, stride: int = 16) -> DataFrame:
    """pixels(sequence, frame, x, y, depth, f, c, colours) and poses with target x, y, z -> wx, wy, wz relative to the target."""
    rows = pixels.filter((F.col("x") % stride == 0) & (F.col("y") % stride == 0)).filter(finite("depth") > 0).join(poses, ["sequence", "frame"])
    a, b = (F.col("x") + 0.5 - F.col("c")) / F.col("f"), (F.col("y") + 0.5 - F.col("c")) / F.col("f")
    d = F.col("depth")
    world = _mul([[F.col(c) for c in r] for r in R], [[a * d], [b * d], [d]])
    return rows.withColumns({f"w{k}": world[i][0] + F.col(T[i]) - F.col(f"target_{k}") for i, k in enumerate("xyz")})


def stored_payload_delta(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """stored and fresh (sequence, frame, pose array, k array, source_hash) -> per sequence the largest difference of a pose and
    of an intrinsic entry, whether the source hashes are equal, and whether all frames met."""
    other = fresh.select("sequence", "frame", F.col("pose").alias("_pose"), F.col("k").alias("_k"), F.col("source_hash").alias("_hash"))
    rows = stored.join(other, ["sequence", "frame"], "left")
    most = lambda a, b: F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    return rows.groupBy("sequence").agg(F.max(most("pose", "_pose")).alias("pose_delta"), F.max(most("k", "_k")).alias("k_delta"), F.bool_and(F.coalesce(F.col("source_hash") == F.col("_hash"), F.lit(False))).alias("hash_matches"), F.bool_and(F.col("_pose").isNotNull()).alias("matched"))


def coverage(sequences: DataFrame, files: DataFrame, pairs: DataFrame) -> DataFrame:
    """sequences(sequence, scope, existing), files(sequence, pass_name, suffix, frame), pairs(sequence) -> by scope: sequences,
    frames, rgb and depth files, pairs, sequences with a stored pose. Files and pairs are counted before they are joined."""
    f = files.groupBy("sequence").agg(F.count_distinct("suffix", "frame").alias("frames"), F.count_if(F.col("pass_name") == "rgb").alias("rgb"), F.count_if(F.col("pass_name") == "depth").alias("depth"))
    rows = sequences.join(f, "sequence", "left").join(pairs.groupBy("sequence").agg(F.count("*").alias("pairs")), "sequence", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rows.groupBy("scope").agg(F.count("*").alias("sequences"), total("frames").alias("frames"), total("rgb").alias("rgb_files"), total("depth").alias("depth_files"), total("pairs").alias("pairs"), F.count_if("existing").alias("existing_json_pairs"))


def render_report(sequences: DataFrame, files: DataFrame, rgb_problems: DataFrame, depth: DataFrame, bad_sources: DataFrame, expected: int = 25) -> DataFrame:
    """By map: sequences, rgb and depth files, problems of images, the range of depth, sources that fail, and success.
    sequences(map_path, trajectory, prefix), files(trajectory, prefix, suffix, pass_name, frame, size), rgb_problems(map_path,
    problem), depth(map_path, least, greatest, bad_frames: the rows of depth_frame_stats()), bad_sources(trajectory, prefix,
    reason). All is counted by sequence before it meets the maps."""
    key = ["trajectory", "prefix"]
    good = F.col("size") > 0
    f = files.groupBy(*key).agg(F.count_if(F.col("pass_name") == "rgb").alias("rgb"), F.count_if(F.col("pass_name") == "depth").alias("depth"), F.count_if(good).alias("good"))
    rows = sequences.select("map_path", *key).join(f, key, "left").join(bad_sources.groupBy(*key).agg(F.count("*").alias("bad")), key, "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    whole = F.count_if(F.coalesce("good", F.lit(0)) < 4 * expected)
    out = rows.groupBy("map_path").agg(F.count("*").alias("sequences"), total("rgb").alias("rgb_files"), total("depth").alias("depth_files"), whole.alias("incomplete"), total("bad").alias("bad_sources"))
    p = rgb_problems.groupBy("map_path").agg(F.count("*").alias("rgb_problems"))
    some = [F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.sum("bad_frames").alias("bad_frames")]
    d = aggregate(stash(depth.select("map_path", "least", "greatest", "median", "bad_frames"), "depth"), ["map_path"], some, {"median": ("median", 0.5)})
    out = out.join(p, "map_path", "left").join(d, "map_path", "left").fillna(0, ["rgb_problems", "bad_frames"])
    return out.withColumn("success", (F.col("incomplete") + F.col("bad_sources") + F.col("rgb_problems") + F.col("bad_frames") == 0) & F.col("least").isNotNull())
