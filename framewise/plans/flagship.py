"""The flagship plan: which sequences of each map still need work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.operators import complete, plan
from framewise.sources.store import stash


def remaining_by_map(rows: DataFrame, maps: DataFrame, targets: DataFrame, files: DataFrame, passes: DataFrame, suffixes: DataFrame, frames: int = 25) -> DataFrame:
    """Drop rows that violate the manifest, keep each id's first and then each recipe's, name them, compare with the files,
    count per map. A bad row takes no good one of its id along. Rows are named in place and files counted by directory, then by
    sequence, so each table is read once and met once."""
    good = plan.checked(rows, maps, targets).filter("codes = ''")
    good = plan.first_of(plan.first_of(good, ["sequence_id"]), plan.RECIPE)
    prefix = plan.canonical_prefix(F.element_at(F.split("map_path", "/"), -1), F.col("target_label"), F.col("height_m"), F.col("yaw_deg"))
    named = good.select("map_path", "trajectory", prefix.alias("prefix")).distinct()
    found = complete.directories(files, frames).filter("complete").select(*complete.DIRECTORY)
    asked = found.join(suffixes, "suffix", "left_semi").join(passes, "pass_name", "left_semi")
    whole = asked.groupBy(*complete.SEQUENCE).agg(F.count("*").alias("whole"))
    whole = stash(whole, "whole")  # one row a sequence; written, so that the planner knows its size for the join
    wanted = suffixes.count() * passes.count()
    joined = named.join(whole, complete.SEQUENCE, "left")
    return joined.groupBy("map_path").agg(F.count("*").alias("sequences"), F.count_if(F.coalesce("whole", F.lit(0)) < wanted).alias("remaining"))
