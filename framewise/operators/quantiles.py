"""Exact percentiles of groups of any size.

Spark's `percentile` keeps every distinct value of a group in one task. Here groups are refined: values are counted by bins
(first by sixteenths of an octave, then by 2**16 equal steps between a bin's smallest and largest value), which combines
before the shuffle; the bins that hold the wanted ranks are kept with the number of values before them, and refined again,
until a bin holds one value or few enough rows to number. Bins are value ranges that don't overlap, so a row's bin is found
by its value. The driver sees only figures of sizes. Where all groups are small, `percentile` is used as it is.

Null and NaN values are left out; a group without others has a null percentile; positions between two ranks are
interpolated as `percentile` does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.sources.store import stash

#: Rows of a group, or of a bin, that one task may hold.
MOST_ROWS = 1 << 20
STEPS = 1 << 16
#: Parts over which a hot group's rows are dealt where they have to be shuffled to meet their bins.
SALTS = 32


def _octave(v: Column) -> Column:
    """Sixteenths of an octave, for both signs; it never falls as v rises."""
    k = F.floor((F.least(F.log2(F.abs(v)), F.lit(2000.0)) + 1075) * 16) + 1
    return F.when(v > 0, k).when(v < 0, -k).otherwise(F.lit(0)).cast("long")


def _located(bins: DataFrame, ranks: DataFrame, group: list[str], kept: list[str]) -> DataFrame:
    """The bins that hold the wanted ranks. bins(group, bin, n, lo, hi), ranks(group, kept, rank): rank comes out as the rank
    inside the bin."""
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    placed = bins.withColumn("before", F.coalesce(before, F.lit(0)))
    wanted = ranks.select(*(F.col(g).alias(f"w_{g}") for g in group), *kept, "rank")
    on = F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"w_{g}"))
    met = placed.join(wanted, on & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
    return met.select(*group, *kept, (F.col("rank") - F.col("before")).alias("rank"), "n", "lo", "hi")


def exact_percentiles(rows: DataFrame, keys: list[str], wants: dict[str, tuple[str, float]]) -> DataFrame:
    """keys and one column for each want, a name: (value column, fraction), by refinement whatever the groups' sizes."""
    columns = sorted({c for c, _ in wants.values()})
    group = [f"k{i}" for i in range(len(keys))] + ["c"]
    stacked = rows.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.explode(F.array(*(F.struct(F.lit(j).alias("c"), F.col(c).cast("double").alias("v")) for j, c in enumerate(columns)))).alias("x"))
    values = stacked.select(*group[:-1], "x.c", (F.col("x.v") + 0.0).alias("v")).filter("v is not null and not isnan(v)")
    counted = [F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    bins = stash(values.groupBy(*group, _octave(F.col("v")).alias("bin")).agg(*counted), "bins")
    asked = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(columns.index(c)).alias("of"), F.lit(float(q)).alias("q")) for name, (c, q) in wants.items()))
    sizes = bins.groupBy(*group).agg(F.sum("n").alias("total")).withColumn("a", F.explode(asked)).filter("a.of = c")
    place = F.col("a.q") * (F.col("total") - 1)
    ends = F.array(F.struct(F.floor(place).alias("rank"), F.lit(0).alias("end")), F.struct(F.ceil(place).alias("rank"), F.lit(1).alias("end")))
    ranks = stash(sizes.select(*group, "a.name", place.alias("place"), F.explode(ends).alias("e")).select(*group, "name", "place", "e.end", "e.rank"), "ranks")
    kept = ["name", "place", "end"]
    state = stash(_located(bins, ranks, group, kept), "located")
    found = [state.filter("lo = hi").select(*group, *kept, F.col("lo").alias("v"))]
    while (most := state.filter("lo < hi").agg(F.max("n")).first()[0]) is not None:
        open_ = state.filter("lo < hi")
        ranges = open_.select(*group, "lo", "hi").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        ranges = ranges.select(*(F.col(g).alias(f"r_{g}") for g in group), "lo", "hi", F.col("salt").alias("r_salt"))
        salted = values.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        on = (F.col("salt") == F.col("r_salt")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
        for g in group:
            on = on & F.col(g).eqNullSafe(F.col(f"r_{g}"))
        inside = salted.join(ranges, on).select(*group, "lo", "hi", "v")
        if most <= MOST_ROWS:
            w = Window.partitionBy(*group, "lo", "hi").orderBy("v")
            numbered = inside.groupBy(*group, "lo", "hi", "v").agg(F.count("*").alias("n"))
            numbered = numbered.withColumn("upto", F.sum("n").over(w))
            wanted = open_.select(*(F.col(g).alias(f"w_{g}") for g in group), F.col("lo").alias("w_lo"), F.col("hi").alias("w_hi"), *kept, "rank")
            on = (F.col("lo") == F.col("w_lo")) & (F.col("hi") == F.col("w_hi")) & (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
            for g in group:
                on = on & F.col(g).eqNullSafe(F.col(f"w_{g}"))
            found.append(numbered.join(wanted, on).select(*group, *kept, "v"))
            break
        step = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * STEPS), F.lit(STEPS - 1)).cast("long")
        finer = inside.groupBy(*group, F.col("lo").alias("in_lo"), F.col("hi").alias("in_hi"), step.alias("bin")).agg(*counted)
        again = open_.withColumnsRenamed({"lo": "in_lo", "hi": "in_hi"}).select(*group, "in_lo", "in_hi", *kept, "rank")
        state = stash(_located(finer, again, [*group, "in_lo", "in_hi"], kept).select(*group, *kept, "rank", "n", "lo", "hi"), "located")
        found.append(state.filter("lo = hi").select(*group, *kept, F.col("lo").alias("v")))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    low, high = F.max(F.when(F.col("end") == 0, F.col("v"))), F.max(F.when(F.col("end") == 1, F.col("v")))
    both = every.groupBy(*group[:-1], "name", "place").agg(low.alias("low"), high.alias("high"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((F.ceil("place") - F.col("place")) * F.col("low") + (F.col("place") - F.floor("place")) * F.col("high"))
    wide = both.withColumn("value", value).groupBy(*group[:-1]).agg(*(F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in wants))
    return wide.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), *wants)


def aggregate(rows: DataFrame, keys: list[str], aggs: list[Column], wants: dict[str, tuple[str, float]], most_rows: int | None = None) -> DataFrame:
    """rows.groupBy(keys).agg(*aggs) with exact percentiles. rows are read once more to count the groups; write them first
    where that is dear."""
    limit = MOST_ROWS if most_rows is None else most_rows
    largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= limit:
        plain = {n: F.percentile(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(float(q))) for n, (c, q) in wants.items()}
        return rows.groupBy(*keys).agg(*aggs, *(v.alias(n) for n, v in plain.items()))
    first = rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()
    found = exact_percentiles(rows, keys, wants)
    on = F.lit(True)
    for k in keys:
        on = on & first[k].eqNullSafe(found[k])
    return first.join(found, on, "left").select(*(first[c] for c in first.columns), *(found[n] for n in wants))
