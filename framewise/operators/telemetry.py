"""Device telemetry, process placement and step metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.quantiles import aggregate


#: Seconds of one block of a run: a block is ordered in one task.
BLOCK_SECONDS = 3600.0


def _run_blocks(samples: DataFrame, block_seconds: float) -> DataFrame:
    """A run's samples in two levels: its time is cut into blocks, of which each is ordered by itself and gives one row; the rows of
    a run, one for each block, are then ordered in turn to carry the last count from block to block. A block's row: its least time and
    counts at both ends, the first and last rise inside it, and for gauges sums and counts over the parts that the
    run's output window can cut it into."""
    key = ["run_label", "block"]
    rows = samples.withColumns({"block": F.floor(F.col("elapsed_seconds") / block_seconds), "files": F.coalesce("image_files", F.lit(0))})
    ordered, whole = Window.partitionBy(*key).orderBy("elapsed_seconds", "files"), Window.partitionBy(*key)
    t = F.col("elapsed_seconds")
    rows = rows.withColumn("rose", F.coalesce(F.col("files") > F.lag("files").over(ordered), F.lit(False)))
    rows = rows.withColumns({"head": F.min(t).over(whole), "up": F.min(F.when(F.col("rose"), t)).over(whole), "top": F.max(F.when(F.col("rose"), t)).over(whole)})
    parts = {"all": F.lit(True), "head": t == F.col("head"), "from": t >= F.col("up"), "to": t <= F.col("top"), "mid": t.between(F.col("up"), F.col("top"))}
    util = F.col("gpu_util_percent")
    sums = [f(F.when(c, util)).alias(f"{n}_{k}") for k, c in parts.items() for n, f in (("sum", F.sum), ("n", F.count))]
    at = F.struct(t, "files")
    ends = [F.min(at)["files"].alias("first_files"), F.max(at)["files"].alias("last_files"), F.min("head").alias("head"), F.min("up").alias("up"), F.max("top").alias("top")]
    rest = [F.max("gpu_memory_mb").alias("memory"), F.sum("power_w").alias("power"), F.count("power_w").alias("n_power"), F.count("*").alias("samples")]
    blocks = rows.groupBy(*key).agg(*ends, *sums, *rest)
    before = F.coalesce(F.lag("last_files").over(Window.partitionBy("run_label").orderBy("block")), F.lit(0))
    opens = F.col("first_files") > before  # whether the block's first sample is a rise
    return blocks.withColumns({"opens": opens, "first_rise": F.when(opens, F.col("head")).otherwise(F.col("up")), "last_rise": F.coalesce("top", F.when(opens, F.col("head")))})


def output_window(samples: DataFrame, block_seconds: float = BLOCK_SECONDS) -> DataFrame:
    """First and last sample time at which a run's cumulative file count rose; both ends belong to the window. A run of any
    length is spread over tasks by blocks of its time."""
    gauges = [F.lit(None).cast("double").alias(c) for c in ("gpu_util_percent", "gpu_memory_mb", "power_w")]
    blocks = _run_blocks(samples.select("run_label", "elapsed_seconds", "image_files", *gauges), block_seconds)
    ends = blocks.groupBy("run_label").agg(F.min("first_rise").alias("first_output"), F.max("last_rise").alias("last_output"))
    return ends.filter("first_output is not null")


def gpu_run_summary(samples: DataFrame, block_seconds: float = BLOCK_SECONDS) -> DataFrame:
    """Per run: mean utilisation, the same inside the output window, peak memory, mean power, samples; nulls are unmeasured.
    The samples are read and shuffled once, by blocks: the window holds whole blocks but for its first and last, of which the
    sums over the right part are taken."""
    blocks = _run_blocks(samples, block_seconds)
    run = Window.partitionBy("run_label")
    rises = F.col("first_rise").isNotNull()
    blocks = blocks.withColumns({"begin": F.min(F.when(rises, F.col("block"))).over(run), "end": F.max(F.when(rises, F.col("block"))).over(run)})
    is_begin, is_end = F.col("block") == F.col("begin"), F.col("block") == F.col("end")
    begins_late, ends_early = is_begin & ~F.col("opens"), is_end & F.col("top").isNotNull()
    part = (
        F.when(is_end & F.col("top").isNull(), F.lit("head"))  # its only rise is its first sample
        .when(begins_late & ends_early, F.lit("mid")).when(begins_late, F.lit("from")).when(ends_early, F.lit("to")).otherwise(F.lit("all"))
    )
    within = F.col("block").between(F.col("begin"), F.col("end"))
    pick = lambda n: F.coalesce(*(F.when(within & (F.col("part") == k), F.col(f"{n}_{k}")) for k in ("all", "head", "from", "to", "mid")))
    mean = lambda total, n: F.when(F.sum(n) > 0, F.sum(total) / F.sum(n))
    rows = blocks.withColumn("part", part).withColumns({"out_sum": pick("sum"), "out_n": pick("n")})
    return rows.groupBy("run_label").agg(mean("sum_all", "n_all").alias("mean_util"), mean("out_sum", "out_n").alias("output_util"), F.max("memory").alias("peak_memory_mb"), mean("power", "n_power").alias("mean_power_w"), F.sum("samples").alias("samples"))


def throughput(samples: DataFrame, bytes_per_file: float) -> DataFrame:
    """Images, frames and MiB a second over each run's wall time; 0 where no time passed."""
    runs = samples.groupBy("run_label").agg((F.max("elapsed_seconds") - F.min("elapsed_seconds")).alias("wall"), F.max("image_files").alias("images"))
    rate = lambda x: F.when(F.col("wall") > 0, x / F.col("wall")).otherwise(0.0)
    return runs.select("run_label", "images", rate(F.col("images")).alias("images_per_second"), rate(F.col("images") / 2).alias("frames_per_second"), rate(F.col("images") * bytes_per_file / 1048576).alias("mib_per_second"))


#: Fixed value: the largest display context, in MB, that a process may keep off its device.
DISPLAY_CONTEXT_MB = 128.0


def placement_reason(verified: Column, most_mb: float = DISPLAY_CONTEXT_MB) -> Column:
    """Why a process off the target device is a violation; null for a small idle graphics context of a verified process."""
    active, memory = F.coalesce(F.col("sm_util_percent") > 0, F.lit(False)), F.col("framebuffer_mb")
    small = F.coalesce(memory.between(0, most_mb), F.lit(False))
    allowed = F.coalesce(F.col("process_type") == "G", F.lit(False)) & verified & small & ~active
    why = F.when(F.col("process_type").contains("C"), "compute_context").when(active, "sm_activity").when(memory > most_mb, "framebuffer_allocation").otherwise("unverified_graphics_placement")
    return F.when(~allowed, why)


def placement_violations(samples: DataFrame, target: int, most_mb: float = DISPLAY_CONTEXT_MB, verified: DataFrame | None = None) -> DataFrame:
    """Processes off the target device with the reason. A process is verified if its pid is on the target in the same run, or
    is one of verified(run_label, pid), whose start times have been checked. Memory that is not known is no small context."""
    known = samples.filter(F.col("gpu_index") == target).select("run_label", "pid")
    known = (known if verified is None else known.unionByName(verified.select("run_label", "pid"))).distinct().withColumn("known", F.lit(True))
    off = samples.filter(F.col("gpu_index") != target).join(known, ["run_label", "pid"], "left")
    return off.withColumn("reason", placement_reason(F.coalesce("known", F.lit(False)), most_mb)).filter("reason is not null").drop("known")


def verified_history(samples: DataFrame) -> DataFrame:
    """A pid is verified while its start time is its first one: rows(run_label, pid, event_id, start_time)."""
    first = F.first("start_time").over(Window.partitionBy("run_label", "pid").orderBy("event_id"))
    return samples.select("run_label", "pid", "event_id", (F.col("start_time") == first).alias("verified"))


def step_metrics(steps: DataFrame, expected: int) -> DataFrame:
    """steps(step_id, files_present, wall_seconds, success) -> totals of each step against the expected files."""
    return steps.groupBy("step_id").agg(F.sum("wall_seconds").alias("wall_seconds"), F.sum("files_present").cast("long").alias("files_present"), (F.count("*") * expected).alias("files_expected"), F.bool_and("success").alias("success"), F.count("*").alias("events"))


def capacity_sample_stats(samples: DataFrame, total_mb: float, least_util: float = 50.0, least_mb: float = 20_000.0) -> DataFrame:
    """Peak and medians of the samples that show full load."""
    busy = samples.filter((F.col("gpu_util_percent") >= least_util) & (F.col("gpu_memory_mb") >= least_mb))
    some = [F.count("*").alias("samples"), F.max("gpu_memory_mb").alias("peak_mb"), (F.max("gpu_memory_mb") / total_mb).alias("peak_share")]
    return aggregate(busy, ["run_label"], some, {"median_mb": ("gpu_memory_mb", 0.5), "median_util": ("gpu_util_percent", 0.5)})
