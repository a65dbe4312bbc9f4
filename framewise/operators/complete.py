"""Completeness, resume and integrity: expected against found, what is left, what changed, what each attempt earned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.sources.store import stash

SEQUENCE = ["trajectory", "prefix"]
DIRECTORY = [*SEQUENCE, "suffix", "pass_name"]


def expected_artifacts(sequences: DataFrame, passes: DataFrame, suffixes: DataFrame, frames: int = 25, single: int | None = None) -> DataFrame:
    """Every file a sequence must have, with its pass's extension: frames 0..frames-1, or the one frame `single`. Passes and
    suffixes are configuration of a few rows; frames come from a generator."""
    rows = sequences.select(*SEQUENCE).crossJoin(suffixes).crossJoin(passes.select("pass_name", "ext"))
    frame = F.explode(F.sequence(F.lit(0), F.lit(frames - 1))) if single is None else F.lit(single)
    rows = rows.withColumn("frame", frame)
    name = F.format_string("%s/%s_%s/%s/%04d.%s", "trajectory", "prefix", "suffix", "pass_name", "frame", "ext")
    return rows.withColumn("rel_path", name)


def _bit(frame: Column) -> Column:
    """The frame's bit in its word of 64 frames."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(frame, F.lit(64)).cast("int"))


def directories(files: DataFrame, frames: int = 25) -> DataFrame:
    """Found files by directory: files, frames found, empty and unexpected ones, and whether it is complete. Distinct frames
    are bits of frames/64 words, so that files are combined before the one shuffle."""
    inside, frame = F.col("frame").between(0, frames - 1), F.col("frame")
    words = [F.bit_or(F.when(inside & (F.floor(frame / 64) == k), _bit(frame))) for k in range((frames + 63) // 64)]
    found = files.groupBy(*DIRECTORY).agg(
        F.count("*").alias("files"),
        sum((F.coalesce(F.bit_count(w), F.lit(0)) for w in words), F.lit(0)).cast("long").alias("frames_found"),
        F.count_if(F.col("size") <= 0).alias("empty"),
        F.count_if(~F.coalesce(inside, F.lit(False))).alias("unexpected"),
    )
    return found.withColumn("complete", (F.col("frames_found") == frames) & (F.col("files") == frames) & (F.col("empty") == 0))


def frame_completeness(sequences: DataFrame, files: DataFrame, passes: DataFrame, suffixes: DataFrame, frames: int = 25) -> DataFrame:
    """Each expected or found directory: frames found, files, empty and unexpected files, and whether it is complete.

    The expected frames of a directory are 0..frames-1, so found files are aggregated per directory first and outer-joined
    with expected directories: no file-level join, and nothing is multiplied by frames."""
    found = directories(files, frames)
    expected = sequences.select(*SEQUENCE).distinct().crossJoin(F.broadcast(suffixes)).crossJoin(F.broadcast(passes.select("pass_name"))).withColumn("expected", F.lit(True))
    rows = expected.join(found, DIRECTORY, "full_outer")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("files", "frames_found", "empty", "unexpected")}
    complete = F.col("expected").isNotNull() & F.coalesce("complete", F.lit(False))
    return rows.select(*DIRECTORY, F.coalesce("expected", F.lit(False)).alias("expected"), *(c.cast("long").alias(k) for k, c in n.items()), complete.alias("complete"))


def source_completeness(sequences: DataFrame, sources: DataFrame, least: int = 1024) -> DataFrame:
    """Sequences whose source file is missing, empty or shorter than `least` bytes, with the reason."""
    rows = sequences.select(*SEQUENCE).join(sources.select(*SEQUENCE, "size"), SEQUENCE, "left")
    why = F.when(F.col("size").isNull(), "missing").when(F.col("size") == 0, "empty").when(F.col("size") < least, "short")
    return rows.withColumn("reason", why).filter("reason is not null")


def incomplete_sequences(completeness: DataFrame) -> DataFrame:
    return completeness.filter("expected and not complete").select(*SEQUENCE).distinct()


def remaining_tasks(tasks: DataFrame, completeness: DataFrame, bad_sources: DataFrame) -> DataFrame:
    """Jobs' tasks that still need work, one row each: tasks(job_id, seq_no, trajectory, prefix)."""
    bad = incomplete_sequences(completeness).unionByName(bad_sources.select(*SEQUENCE)).distinct()
    return tasks.join(bad, SEQUENCE, "left_semi").select("job_id", "seq_no", *SEQUENCE)


def purge_list(files: DataFrame, bad: DataFrame) -> DataFrame:
    """All files of incomplete sequences."""
    return files.join(bad.select(*SEQUENCE).distinct(), SEQUENCE, "left_semi").select("rel_path", "size")


def pose_pair_valid(poses: DataFrame, sources: DataFrame) -> DataFrame:
    """poses(prefix, suffix, content, source_hash) and sources(prefix, hash): pairs with equal documents of a current
    source. One aggregate per prefix in place of a self-join."""
    pick = lambda s, c: F.max(F.when(F.col("suffix") == s, F.col(c)))
    h = poses.select("prefix", "suffix", F.sha2("content", 256).alias("h"), "source_hash")
    pair = h.groupBy("prefix").agg(pick("GT", "h").alias("gt"), pick("occ", "h").alias("occ"), pick("GT", "source_hash").alias("noted"))
    rows = pair.join(sources.select("prefix", "hash"), "prefix", "left")
    why = F.when(F.col("gt").isNull() | F.col("occ").isNull(), "missing").when(F.col("gt") != F.col("occ"), "differ").when(~F.col("noted").eqNullSafe(F.col("hash")), "source_changed").otherwise("ok")
    return rows.select("prefix", why.alias("status"))


def classify_jobs(jobs: DataFrame) -> DataFrame:
    """jobs(job_id, frames_ok, poses_ok, marker, fingerprint_ok, inventory_ok) -> render, camera or done, in this order of
    proof: frames, poses, marker with fingerprint and inventory."""
    state = F.when(~F.col("frames_ok"), "render").when(~F.col("poses_ok"), "camera").when(~(F.col("marker") & F.col("fingerprint_ok") & F.col("inventory_ok")), "render").otherwise("done")
    return jobs.select("job_id", state.alias("state"))


def output_inventory(files: DataFrame, jobs: DataFrame) -> DataFrame:
    """files(trajectory, prefix, suffix, stem, ext, size: as scan_output_tree() gives them) of jobs(job_id, trajectory, prefix): per job its image files, bytes,
    frame views (stems that are distinct in a sequence's folder, over all passes) and sorted folders. Stems of four digits are
    bits of words; any other stem is a row of its own, so that 0.png beside 0000.png counts. Files are combined before the
    first shuffle; a job's folders are those of its plan."""
    folder = [*SEQUENCE, "suffix"]
    image = files.filter(F.lower("ext").isin("png", "exr", "jpg", "jpeg")).select(*folder, "size", "stem")
    usual = F.when((F.length("stem") == 4) & F.col("stem").rlike("^[0-9]{4}$"), F.col("stem").cast("int"))
    words = image.groupBy(*folder, F.floor(usual / 64).alias("word"), F.when(usual.isNull(), F.col("stem")).alias("other"))
    words = words.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.bit_or(_bit(usual)).alias("bits"))
    views = F.sum(F.coalesce(F.bit_count("bits"), F.lit(0)) + F.col("other").isNotNull().cast("int"))
    folders = words.groupBy(*folder).agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), views.alias("views"))
    # Written, so that the planner knows its size and the jobs' keys change nothing in the plan of the files.
    mine = stash(folders, "folders").join(jobs.select("job_id", *SEQUENCE), SEQUENCE)
    name = F.array_sort(F.collect_list(F.concat_ws("_", "prefix", "suffix")))
    return mine.groupBy("job_id").agg(F.sum("files").alias("image_files"), F.sum("bytes").alias("bytes"), F.sum("views").alias("frame_views"), name.alias("directories"))


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files of after(rel_path, size, mtime_ns) that are new or changed, counted by kind."""
    old = before.select("rel_path", F.col("size").alias("old_size"), F.col("mtime_ns").alias("old_mtime"))
    changed = after.join(old, "rel_path", "left").filter(~(F.col("size").eqNullSafe(F.col("old_size")) & F.col("mtime_ns").eqNullSafe(F.col("old_mtime"))))
    kind = F.when(F.col("rel_path").endswith(".png"), "rgb").when(F.col("rel_path").endswith(".exr"), "depth").otherwise("other")
    return changed.withColumn("kind", kind).groupBy("kind").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def asset_integrity(manifest: DataFrame, actual: DataFrame) -> DataFrame:
    """manifest(path, sha256) against actual(path, sha256): missing, changed or unlisted."""
    rows = manifest.select("path", F.col("sha256").alias("want")).join(actual.select("path", F.col("sha256").alias("have")), "path", "full_outer")
    status = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "unlisted").when(F.col("want") != F.col("have"), "changed")
    return rows.select("path", status.alias("status")).filter("status is not null")


def tree_copy_verify(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Paths on which two trees differ: only_left, only_right or changed."""
    row = lambda side: F.struct(*columns).alias(side)
    rows = a.select("path", row("l")).join(b.select("path", row("r")), "path", "full_outer")
    change = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(~F.col("l").eqNullSafe(F.col("r")), "changed")
    return rows.select("path", change.alias("change")).filter("change is not null")


def discover_sequences(sources: DataFrame, trajectories: list[str], limit: int | None = None) -> DataFrame:
    """Source files of the wanted trajectories in (trajectory, prefix) order, the first `limit` if given (a top-k)."""
    rows = sources.filter(F.col("trajectory").isin(trajectories)).select(*SEQUENCE).orderBy(*SEQUENCE)
    return rows if limit is None else rows.limit(limit)


def manifest_pairs_check(pairs: DataFrame, trajectories: list[str], root: str) -> DataFrame:
    """pairs(trajectory, prefix, path) -> violated rules, comma-joined; rows without one are left out."""
    rules = {
        "duplicate": F.count("*").over(Window.partitionBy(*SEQUENCE)) > 1,
        "unsafe_name": ~F.col("prefix").rlike(r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"),
        "unknown_trajectory": ~F.col("trajectory").isin(trajectories),
        "path": ~F.col("path").eqNullSafe(F.concat(F.lit(f"{root}/"), "trajectory", F.lit("/"), "prefix", F.lit(".fbx"))),
    }
    codes = F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))), ",")
    return pairs.select(*SEQUENCE, "path", codes.alias("codes")).filter("codes <> ''")


def attempt_rollup(attempts: DataFrame, most_attempts: int) -> DataFrame:
    """Each job's last attempt, its attempts, whether it is exhausted, and the run's failure budget max(3, ceil(jobs/100))."""
    last = F.max_by(F.struct("returncode", "wall_seconds"), "attempt").alias("last")
    jobs = attempts.groupBy("job_id").agg(last, F.max("attempt").alias("attempts"), F.count_if(F.col("returncode") != 0).alias("failures"))
    jobs = jobs.select("job_id", F.col("last.returncode").alias("returncode"), "attempts", "failures").withColumn("exhausted", (F.col("returncode") != 0) & (F.col("attempts") >= most_attempts))
    run = jobs.agg(F.greatest(F.lit(3), F.ceil(F.count("*") / 100)).cast("long").alias("budget"), F.count_if("exhausted").alias("exhausted_jobs"))
    return jobs.crossJoin(F.broadcast(run)).withColumn("breach", F.col("exhausted_jobs") >= F.col("budget"))


def run_summary(planned: DataFrame, attempts: DataFrame) -> DataFrame:
    """Planned jobs by outcome: completed, failed, unscheduled, resumed; images, those rendered now, wall seconds, images a
    second and success. attempts(job_id, attempt, returncode, wall_seconds, resumed, image_files, rendered_image_files): a
    resumed attempt found its output and rendered nothing; a job's last attempt is its result."""
    result = F.max_by(F.struct("returncode", "resumed", "image_files"), "attempt").alias("r")
    last = attempts.groupBy("job_id").agg(result, F.sum("wall_seconds").alias("wall"), F.sum(F.when(~F.col("resumed"), F.col("rendered_image_files"))).alias("rendered"))
    rows = planned.select("job_id").distinct().join(last, "job_id", "left").select("job_id", "r.*", "wall", "rendered")
    n = lambda c, k: F.count_if(F.expr(c)).alias(k)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = rows.agg(n("returncode = 0", "completed"), n("returncode <> 0", "failed"), n("returncode is null", "unscheduled"), n("resumed", "resumed"), total("image_files").alias("image_files"), total("rendered").alias("rendered"), F.sum("wall").alias("wall"))
    rate = F.when(F.col("wall") > 0, F.col("rendered") / F.col("wall")).otherwise(0.0)
    return out.select("completed", "failed", "unscheduled", "resumed", "image_files", F.round("wall", 4).alias("wall_seconds"), F.round(rate, 4).alias("image_files_per_second"), F.expr("failed = 0 and unscheduled = 0").alias("success"))


def credited_throughput(attempts: DataFrame) -> DataFrame:
    """attempts(job_id, attempt, returncode, launched, remaining, tasks, images): an attempt that ends well is credited with all
    tasks it launched, another one with those that don't remain (none where they could not be counted). A job's credit is
    floor(images after its last attempt * credited tasks / tasks)."""
    fresh = F.when(F.col("returncode") == 0, F.col("launched")).otherwise(F.coalesce(F.col("launched") - F.col("remaining"), F.lit(0)))
    jobs = attempts.groupBy("job_id").agg(F.sum(F.greatest(fresh, F.lit(0))).alias("rendered_tasks"), F.max_by("images", "attempt").alias("images"), F.max_by("tasks", "attempt").alias("tasks"))
    return jobs.select("job_id", "rendered_tasks", F.expr("images * rendered_tasks div tasks").alias("credited"))


def storage_forecast(files: DataFrame, planned: DataFrame, reserve: float = 0.2) -> DataFrame:
    """Mean bytes per kind times planned(pass_name, planned) counts, with a reserve."""
    mean = files.groupBy("pass_name").agg(F.avg("size").alias("mean_bytes"), F.count("*").alias("measured"))
    rows = mean.join(F.broadcast(planned), "pass_name").withColumn("bytes", F.col("mean_bytes") * F.col("planned"))
    return rows.select("pass_name", "measured", "planned", F.round("mean_bytes", 4).alias("mean_bytes"), F.round("bytes", 2).alias("bytes"), F.round(F.col("bytes") * (1 + reserve), 2).alias("with_reserve"))


def worker_outcome(log: DataFrame) -> DataFrame:
    """log(worker, seq, message, returncode) -> one outcome: what the last terminal message and exit code say together."""
    last = F.max_by("message", F.when(F.col("message").isin("finished", "failed", "cancelled"), F.col("seq")))
    rows = log.groupBy("worker").agg(last.alias("last"), F.max_by("returncode", "seq").alias("rc"), F.max("seq").alias("seq"))
    state = F.when(F.col("last") == "cancelled", "cancelled").when(F.col("last") == "failed", "failed").when((F.col("last") == "finished") & F.col("rc").isNull(), "unreaped").when((F.col("last") == "finished") & (F.col("rc") != 0), "teardown_incomplete").when(F.col("last") == "finished", "finished").otherwise("crash")
    return rows.select("worker", state.alias("outcome"))
