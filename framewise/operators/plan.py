"""Plan algebra: rules, deduplication, selection, shards, names and summaries of an approved sequence plan.

plan rows: sequence_id, seq_no (file order), map_path, source_scene, split, target_label, expected_views, trajectory,
height_m, yaw_deg. Rules return violations as rows; nothing raises on the first bad row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECIPE = ["map_path", "target_label", "trajectory", "height_m", "yaw_deg"]


def trajectory_product(kinds: DataFrame, heights_cm: DataFrame, yaws: DataFrame) -> DataFrame:
    """kind x height_cm x yaw_deg with its canonical name and whether another task has the same name."""
    name = F.format_string("%s_height_%03d_ang_%03d", "kind", (F.col("height_cm") / 100).cast("int"), F.col("yaw_deg").cast("int"))
    rows = kinds.crossJoin(F.broadcast(heights_cm)).crossJoin(F.broadcast(yaws)).withColumn("name", name)
    return rows.withColumn("collides", F.count("*").over(Window.partitionBy("name")) > 1)


def checked(plan: DataFrame, maps: DataFrame, targets: DataFrame, views: int = 25) -> DataFrame:
    """Every row of the plan with the codes of the rules that it violates, in rule order and comma-joined; none is ''."""
    m = maps.select("map_path", F.col("split").alias("m_split"), F.col("source_scene").alias("m_scene"), F.lit(True).alias("m_known"))
    t = targets.select("map_path", "target_label").distinct().withColumn("t_known", F.lit(True))
    rules = {
        "unknown_map": F.col("m_known").isNull(),
        "split": F.col("m_known") & ~F.col("split").eqNullSafe(F.col("m_split")),
        "source_scene": F.col("m_known") & ~F.col("source_scene").eqNullSafe(F.col("m_scene")),
        "unknown_target": F.col("m_known") & F.col("t_known").isNull(),
        "expected_views": ~F.col("expected_views").eqNullSafe(F.lit(views)),
    }
    codes = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))
    joined = plan.join(m, "map_path", "left").join(t, ["map_path", "target_label"], "left")
    return joined.select(*(plan[c] if c not in ("map_path", "target_label") else F.col(c) for c in plan.columns), F.array_join(codes, ",").alias("codes"))


def validate_plan(plan: DataFrame, maps: DataFrame, targets: DataFrame, views: int = 25) -> DataFrame:
    """Rows with at least one violated rule; codes in rule order, comma-joined."""
    return checked(plan, maps, targets, views).select("sequence_id", "seq_no", "codes").filter("codes <> ''")


def unsupported_recipe(plan: DataFrame, product: DataFrame) -> DataFrame:
    """Plan rows whose task is outside the product; heights match as the same double expression, height_m * 100."""
    p = product.select("kind", "height_cm", F.col("yaw_deg").alias("p_yaw")).distinct()
    return plan.join(p, (plan["trajectory"] == p["kind"]) & (plan["height_m"] * 100 == p["height_cm"]) & (plan["yaw_deg"] == p["p_yaw"]), "left_anti")


def duplicate_recipes(plan: DataFrame) -> DataFrame:
    """Every row after the first of its sequence_id or of its recipe, with the keeper's place in the file."""
    out = None
    for rule, keys in (("sequence_id", ["sequence_id"]), ("recipe", RECIPE)):
        w = Window.partitionBy(*keys).orderBy("seq_no")
        rows = plan.withColumn("rn", F.row_number().over(w)).withColumn("keeper", F.min("seq_no").over(Window.partitionBy(*keys)))
        rows = rows.filter("rn > 1").select("sequence_id", "seq_no", F.lit(rule).alias("rule"), "keeper")
        out = rows if out is None else out.unionByName(rows)
    return out


def first_of(plan: DataFrame, keys: list[str]) -> DataFrame:
    """The plan without later rows of the same keys: an aggregate with map-side combination, no window."""
    rest = [c for c in plan.columns if c not in keys]
    return plan.groupBy(*keys).agg(F.min_by(F.struct(*rest), "seq_no").alias("r")).select(*keys, "r.*").select(plan.columns)


def select_plan(plan: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plan rows of the wanted (map_path, target_label) pairs, wanted pairs without a row)."""
    keys = ["map_path", "target_label"]
    return plan.join(wanted, keys, "left_semi"), wanted.join(plan, keys, "left_anti")


def task_limit(plan: DataFrame, n: int) -> DataFrame:
    """The first n rows of each map and target, in file order."""
    w = Window.partitionBy("map_path", "target_label").orderBy("seq_no")
    return plan.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


def places(plan: DataFrame, keys: list[str], block: int = 1_000_000) -> DataFrame:
    """The plan with rn, a row's place from 0 among those of its keys in file order (equal seq_no: in any order; null first).
    Rows are ordered inside blocks of the file and blocks counted apart, so a group of any size is no single task."""
    rows = plan.withColumn("_block", F.coalesce(F.floor(F.col("seq_no") / block), F.lit(-1)))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    counts = rows.groupBy(*keys, "_block").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))
    counts = counts.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_block").alias("_at"), "_before")
    here = F.col("_block") == F.col("_at")
    for k in keys:
        here = here & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy("seq_no")) - 1
    return rows.withColumn("_in", inside).join(counts, here).select(*plan.columns, (F.col("_before") + F.col("_in")).alias("rn"))


def job_tasks(plan: DataFrame, shards: int, limit: int | None = None, block: int = 1_000_000) -> DataFrame:
    """A row per task: the rows of each map and target dealt in strides after the limit; its job and its place there."""
    rows = places(plan if limit is None else task_limit(plan, limit), ["map_path", "target_label"], block)
    short = F.element_at(F.split("map_path", "/"), -1)
    job = F.format_string("%s_%s_s%03d", short, "target_label", F.pmod("rn", F.lit(shards)))
    return rows.select(job.alias("job_id"), "map_path", "target_label", F.floor(F.col("rn") / shards).alias("place"), "sequence_id")


def assign_shards(plan: DataFrame, shards: int, limit: int | None = None) -> DataFrame:
    """Jobs with their tasks in order, each job's as one string; job_tasks is the form for jobs of any size."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "sequence_id")))
    rows = job_tasks(plan, shards, limit)
    return rows.groupBy("job_id", "map_path", "target_label").agg(F.count("*").alias("tasks"), F.array_join(F.transform(ordered, lambda x: x["sequence_id"]), ",").alias("sequence_ids"))


def plan_summary(plan: DataFrame, shards: int = 3) -> DataFrame:
    """Sequences, targets and jobs by split, by map and in total. A target's rows on a map make a job for each shard that has
    any; they belong to the least of their splits. Counted by split, map and target first, so little is left to regroup."""
    small = plan.groupBy("split", "map_path", "target_label").agg(F.count("*").alias("n"))
    sets = [["split"], ["map_path"], []]
    rows = small.groupingSets(sets, "split", "map_path").agg(F.sum("n").alias("sequences"), F.count_distinct("target_label").alias("targets"))
    jobs = small.groupBy("map_path", "target_label").agg(F.min("split").alias("split"), F.least(F.sum("n"), F.lit(shards)).alias("jobs"))
    jobs = jobs.groupingSets(sets, "split", "map_path").agg(F.sum("jobs").alias("jobs"))
    same = rows["split"].eqNullSafe(jobs["split"]) & rows["map_path"].eqNullSafe(jobs["map_path"])
    return rows.join(jobs, same, "left").select(rows["split"], rows["map_path"], "sequences", "targets", F.coalesce("jobs", F.lit(0)).alias("jobs"))


def canonical_prefix(short_map: Column, label: Column, height_m: Column, yaw: Column) -> Column:
    return F.format_string("%s_%s_height_%03d_ang_%03d", short_map, label, height_m.cast("int"), yaw.cast("int"))


def canonical_names(plan: DataFrame) -> DataFrame:
    """Directories and source path of each row; numbers are cut to whole ones and keep a fourth digit."""
    prefix = canonical_prefix(F.element_at(F.split("map_path", "/"), -1), F.col("target_label"), F.col("height_m"), F.col("yaw_deg"))
    rows = plan.withColumn("prefix", prefix)
    return rows.select(
        "sequence_id",
        "prefix",
        F.format_string("%s/%s_occ", "trajectory", "prefix").alias("occ_directory"),
        F.format_string("%s/%s_GT", "trajectory", "prefix").alias("gt_directory"),
        F.format_string("Exported_FBX/%s/%s.fbx", "trajectory", "prefix").alias("fbx_path"),
    )


def parse_names(names: DataFrame) -> DataFrame:
    """prefix -> map, target number, height and yaw; a name that doesn't fit, or a number that no long holds, is bad."""
    pattern = r"^(.+)_Target_(\d+)_height_(\d+)_ang_(\d+)$"
    part = lambda k: F.nullif(F.regexp_extract("prefix", pattern, k), F.lit(""))
    number = lambda k: part(k).try_cast("long")
    return names.select("prefix", part(1).alias("map_name"), number(2).alias("target_number"), number(3).alias("height"), number(4).alias("yaw"), (number(2).isNull() | number(3).isNull() | number(4).isNull()).alias("bad"))


def exact_task_subset(product: DataFrame, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tasks to do, requested tasks outside the product); nothing requested means all."""
    keys = ["kind", "height_cm", "yaw_deg"]
    missing = requested.join(product, keys, "left_anti")
    some = requested.limit(1).select(F.lit(True).alias("some"))
    chosen = product.join(requested.withColumn("asked", F.lit(True)).distinct(), keys, "left").join(F.broadcast(some), F.lit(True), "left")
    return chosen.filter("asked or some is null").select(*keys), missing


def target_shard_select(targets: DataFrame, named: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(map_path, target_label, shard) of the named targets, in strides over each map's ordered labels; and unknown names."""
    known = targets.select("map_path", "target_label").distinct()
    w = Window.partitionBy("map_path").orderBy("target_label")
    rows = known.join(named, ["map_path", "target_label"], "left_semi").withColumn("shard", F.pmod(F.row_number().over(w) - 1, F.lit(shards)))
    return rows, named.join(known, ["map_path", "target_label"], "left_anti")


def job_row_rules(jobs: DataFrame, tasks: DataFrame, targets: DataFrame, shards: int) -> DataFrame:
    """jobs(job_id, map_path, shard_index), tasks(job_id, kind, height, yaw), targets(job_id, target) -> violated rules of each
    job, comma-joined. Repeats are counted by value and then by job, so no job's tasks are gathered. A null path or shard index
    violates its rule."""
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    task = tasks.groupBy("job_id", "kind", "height", "yaw").agg(F.count("*").alias("n"))
    task = task.groupBy("job_id").agg((F.max("n") > 1).alias("again"), F.bool_or(~(finite("height") & finite("yaw"))).alias("odd"))
    target = targets.groupBy("job_id", "target").agg(F.count("*").alias("n")).groupBy("job_id").agg((F.max("n") > 1).alias("twice"))
    rules = {
        "duplicate_task": F.col("again"),
        "duplicate_target": F.col("twice"),
        "package_path": ~F.coalesce(F.col("map_path").rlike(r"^/Game/[A-Za-z0-9_/]+$"), F.lit(False)),
        "shard_index": ~F.coalesce(F.col("shard_index").between(0, shards - 1), F.lit(False)),
        "not_finite": F.col("odd"),
    }
    codes = F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))), ",")
    return jobs.join(task, "job_id", "left").join(target, "job_id", "left").select("job_id", codes.alias("codes"))


def map_resolution(names: DataFrame, packages: DataFrame) -> DataFrame:
    """Short names -> the one package of that basename, or why not: missing, ambiguous."""
    by_name = packages.distinct().withColumn("name", F.element_at(F.split("package", "/"), -1)).groupBy("name").agg(F.count("*").alias("n"), F.min("package").alias("package"))
    n = F.coalesce("n", F.lit(0))
    return names.distinct().join(by_name, "name", "left").select("name", n.alias("matches"), F.when(n == 1, F.col("package")).alias("package"), F.when(n == 0, "missing").when(n > 1, "ambiguous").otherwise("ok").alias("status"))


def split_audit(plan: DataFrame) -> DataFrame:
    """Each source scene: its splits, sequences per map (least and most), distinct view counts, and whether it is clean."""
    per_map = plan.groupBy("source_scene", "map_path").agg(F.count("*").alias("n"))
    ranges = per_map.groupBy("source_scene").agg(F.min("n").alias("least_per_map"), F.max("n").alias("most_per_map"))
    scenes = plan.groupBy("source_scene").agg(F.count_distinct("split").alias("splits"), F.count("*").alias("sequences"), F.count_distinct("expected_views").alias("view_counts"))
    return scenes.join(ranges, "source_scene").withColumn("clean", F.expr("splits = 1 and view_counts = 1 and least_per_map = most_per_map"))


def _number(c: Column) -> Column:
    """A whole double as Python prints it: one decimal, never an exponent."""
    return F.format_string("%.1f", c)


def trajectory_seed(plan: DataFrame, seed: int = 42) -> DataFrame:
    """An unsigned 64-bit seed for each recipe: the first eight bytes of SHA-256 over compact JSON."""
    text = F.concat(F.lit(f'[{seed},"'), "map_path", F.lit('","'), "target_label", F.lit('",["'), "trajectory", F.lit('",'), _number(F.col("height_m")), F.lit(","), _number(F.col("yaw_deg")), F.lit("]]"))
    return plan.select("sequence_id", F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)").alias("seed"))


def plan_fingerprint(plan: DataFrame) -> DataFrame:
    """One row per map: a hash that doesn't depend on row order or file paths. Row hashes are added up in four words, which is
    combined before the shuffle and gathers nothing."""
    row = F.sha2(F.concat_ws("|", "sequence_id", "map_path", "split", "target_label", F.col("expected_views").cast("string"), "trajectory", _number(F.col("height_m")), _number(F.col("yaw_deg"))), 256)
    words = [F.sum(F.conv(F.substring("h", 16 * k + 1, 16), 16, 10).cast("decimal(20,0)")).alias(f"w{k}") for k in range(4)]
    sums = plan.select("map_path", row.alias("h")).groupBy("map_path").agg(F.count("*").alias("rows"), *words)
    return sums.select("map_path", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), *(F.col(f"w{k}").cast("string") for k in range(4))), 256).alias("fingerprint"), "rows")


def same_plans(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets of rows."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def sequence_categories(selected: DataFrame, exported: DataFrame, names: list[str]) -> DataFrame:
    """Distinct paths, selected and exported, by the first category whose segment they hold, else other."""
    category = F.coalesce(*(F.when(F.col("path").contains(f"/{n}/"), F.lit(n)) for n in names), F.lit("other"))
    both = selected.select("path", F.lit(1).alias("s"), F.lit(0).alias("e")).unionByName(exported.select("path", F.lit(0).alias("s"), F.lit(1).alias("e")))
    once = both.groupBy("path").agg(F.max("s").alias("s"), F.max("e").alias("e")).withColumn("category", category)
    return once.groupBy("category").agg(F.sum("s").alias("selected"), F.sum("e").alias("exported"), F.sum(F.col("s") * F.col("e")).alias("both"))


def trajectory_work_items(targets: DataFrame, tasks: DataFrame, params: DataFrame) -> DataFrame:
    """target x task with the kind's parameters, the shell's bounds (least and greatest height) and the output path."""
    shell = tasks.agg(F.min("height_cm").alias("shell_low"), F.max("height_cm").alias("shell_high"))
    rows = targets.crossJoin(tasks).join(params, "kind").crossJoin(F.broadcast(shell))
    name = canonical_prefix(F.element_at(F.split("map_path", "/"), -1), F.col("target_label"), F.col("height_cm") / 100, F.col("yaw_deg"))
    return rows.withColumn("output_path", F.concat("map_path", F.lit("/"), "kind", F.lit("/"), name))
