"""Scene, mesh and ray-hit tables. Rays come from outside; a hit row is one actor met by one ray."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAR = 5.0
#: Parts of a map's targets in the visibility matrix.
SALTS = 64


def occlusion_rates(faces: DataFrame, hits: DataFrame) -> DataFrame:
    """By camera and actor: faces(camera_id, actor_id, face_id, cx, cy, cz, ray_id) and the first hit of each ray (ray_id, hit_actor, hx, hy, hz): shares of
    faces that are visible, hidden by their own actor or by another. A hit of the own actor within NEAR on every axis of the
    face's centre is that face."""
    close = (F.abs(F.col("hx") - F.col("cx")) <= NEAR) & (F.abs(F.col("hy") - F.col("cy")) <= NEAR) & (F.abs(F.col("hz") - F.col("cz")) <= NEAR)
    kind = F.when(F.col("hit_actor").isNull(), "visible").when(F.col("hit_actor") != F.col("actor_id"), "inter").when(close, "visible").otherwise("self")
    rows = faces.join(hits, "ray_id", "left").withColumn("kind", kind)
    share = lambda k: F.avg((F.col("kind") == k).cast("double"))
    return rows.groupBy("camera_id", "actor_id").agg(F.count("*").alias("faces"), share("visible").alias("visible"), share("self").alias("self_occlusion"), share("inter").alias("inter_occlusion"))


def first_hits(hits: DataFrame) -> DataFrame:
    """The nearest hit of each ray; ties go to the lower rank, actor and point."""
    return hits.groupBy("ray_id").agg(F.min(F.struct("dist", "hit_rank", "actor_id", "point_id")).alias("h")).select("ray_id", "h.actor_id", "h.point_id", "h.dist")


def facing_face_centres(faces: DataFrame, vertices: DataFrame, eye: tuple[float, float, float]) -> DataFrame:
    """Centres of triangles whose normal looks towards the eye."""
    rows = faces
    for k in "abc":
        rows = rows.join(vertices.select(F.col("vertex_id").alias(k), *(F.col(c).alias(f"{k}{c}") for c in "xyz")), k)
    u = [F.col(f"b{c}") - F.col(f"a{c}") for c in "xyz"]
    v = [F.col(f"c{c}") - F.col(f"a{c}") for c in "xyz"]
    n = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    centre = [(F.col(f"a{c}") + F.col(f"b{c}") + F.col(f"c{c}")) / 3 for c in "xyz"]
    towards = sum((n[i] * (F.lit(eye[i]) - centre[i]) for i in range(3)), F.lit(0.0))
    return rows.filter(towards > 0).select("face_id", *(centre[i].alias(c) for i, c in enumerate("xyz")))


def vertices_to_world(vertices: DataFrame, instances: DataFrame) -> DataFrame:
    """Every vertex of every instance (instance_id, sx, sy, sz, qx, qy, qz, qw, ix, iy, iz): scaled along each axis, turned by
    the unit quaternion, moved. The result is their product by definition."""
    rows = vertices.crossJoin(instances)
    v, q, w = [F.col(f"s{c}") * F.col(c) for c in "xyz"], [F.col(f"q{c}") for c in "xyz"], F.col("qw")
    cross = lambda a, b: [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    t = [2 * x for x in cross(q, v)]
    turned = [v[i] + w * t[i] + x for i, x in enumerate(cross(q, t))]
    return rows.select("instance_id", "vertex_id", *((turned[i] + F.col(f"i{c}")).alias(c) for i, c in enumerate("xyz")))


def inside_test(hits: DataFrame) -> DataFrame:
    """Points that have one actor both above and below: an aggregate of both directions, no self-join."""
    both = hits.groupBy("point_id", "actor_id").agg(F.bool_or(F.col("direction") == "up").alias("up"), F.bool_or(F.col("direction") == "down").alias("down"))
    return both.groupBy("point_id").agg(F.bool_or(F.expr("up and down")).alias("inside"))


def visibility_test(points: DataFrame, hits: DataFrame) -> DataFrame:
    """points(ray_id, distance) without a hit nearer than the point itself."""
    nearest = hits.groupBy("ray_id").agg(F.min("dist").alias("dist"))
    return points.join(nearest, (points["ray_id"] == nearest["ray_id"]) & (nearest["dist"] < points["distance"]), "left_anti")


def visual_centre(rays: DataFrame, hits: DataFrame, reach: float = 10_000.0) -> DataFrame:
    """The first hit of each ray within reach, else null with found = false."""
    near = hits.filter(F.col("dist") <= reach).groupBy("ray_id").agg(F.min(F.struct("dist", "hit_rank", "actor_id")).alias("h"))
    return rays.join(near, "ray_id", "left").select("ray_id", F.col("h.actor_id").alias("actor_id"), F.col("h.dist").alias("dist"), F.col("h").isNotNull().alias("found"))


def scene_visibility_matrix(targets: DataFrame, actors: DataFrame) -> DataFrame:
    """(target, actor, pass) -> visible: of targets the current one only; occluders in occ and not in GT. actors(actor,
    is_occluder) per map; targets(map_path, target). A map's targets are dealt over SALTS parts, each of which meets all its
    actors: few bytes make many rows, so tasks are not to follow the input's size or the number of maps."""
    spark = targets.sparkSession
    passes = spark.createDataFrame([("occ",), ("GT",)], "suffix string")
    dealt = lambda rows, salt: rows.withColumn("salt", salt).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "map_path", "salt")
    mine = dealt(targets, F.pmod(F.xxhash64("target"), F.lit(SALTS)).cast("int"))
    rows = mine.join(dealt(actors, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["map_path", "salt"]).drop("salt").crossJoin(F.broadcast(passes))
    visible = F.when(F.col("is_occluder"), F.col("suffix") == "occ").otherwise(F.col("actor") == F.col("target"))
    return rows.select("map_path", "target", "actor", "suffix", visible.alias("visible"))


def visibility_rules(actors: DataFrame) -> DataFrame:
    """actors(map_path, actor, is_occluder) -> one row an actor with its rule: `occ`, shown in that pass whatever the target, or
    `target`, shown in both passes when it is the target. An actor without is_occluder is no occluder."""
    return actors.select("map_path", "actor", F.when(F.col("is_occluder"), "occ").otherwise("target").alias("rule"))


def visible_actors(asked: DataFrame, rules: DataFrame) -> DataFrame:
    """asked(map_path, target, suffix) and visibility_rules() -> the actors that are visible then: the visible rows of
    scene_visibility_matrix() for what is asked, without the pairs of targets that hide each other. Occluders meet only what is
    asked of the occ pass, and a target only itself."""
    of = lambda rule: rules.filter(F.col("rule") == rule).drop("rule")
    asked = asked.select("map_path", "target", "suffix")
    own = asked.join(of("target").withColumn("target", F.col("actor")), ["map_path", "target"])
    return own.unionByName(asked.filter("suffix = 'occ'").join(of("occ"), "map_path"))


def select_actors(actors: DataFrame, prefix: str) -> DataFrame:
    """Actors by label prefix, with their place in label order."""
    return actors.filter(F.col("label").startswith(prefix)).withColumn("place", F.row_number().over(Window.partitionBy("map_path").orderBy("label")))


def missing_actors(actors: DataFrame, names: DataFrame) -> DataFrame:
    """Wanted names without an actor."""
    return names.join(actors, ["map_path", "label"], "left_anti")


def stencil_palette(objects: DataFrame, palette: DataFrame, separate: bool) -> DataFrame:
    """objects(scene, pos, name, value) up to the scene's first value of 255 or more, with palette colours (value, colour);
    in separate mode the looked-up value is 2 to the (value - 1). The cut tests the raw value."""
    stop = objects.filter("value >= 255").groupBy("scene").agg(F.min("pos").alias("stop"))
    rows = objects.join(stop, "scene", "left").filter("stop is null or pos < stop")
    key = F.pow(F.lit(2.0), F.col("value") - 1).cast("long") if separate else F.col("value").cast("long")
    return rows.withColumn("key", key).join(palette.select(F.col("value").cast("long").alias("key"), "colour"), "key", "left").select("scene", "pos", "name", "key", "colour")
