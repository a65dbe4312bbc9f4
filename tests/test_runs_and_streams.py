"""Long runs in two levels against one ordered window, and streams against sorted tables."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from framewise.operators import telemetry as T
from framewise.streaming import streams as S

SAMPLE = "run_label string, elapsed_seconds double, image_files long, gpu_util_percent double, gpu_memory_mb double, power_w double"


def samples(seed, n=400):
    r = random.Random(seed)
    out = []
    for run in ("a", "b", "c", "flat", "once"):
        files = 0
        for _ in range(n):
            if run in "abc" and r.random() < 0.1:
                files += r.randint(1, 5)
            if run == "c" and r.random() < 0.02:
                files = 0  # a counter that begins again
            when = r.uniform(0, 100) if run != "once" else 55.5
            out.append([run, when, None, r.choice([None, r.uniform(0, 100)]), r.uniform(1, 9), r.choice([None, 3.0])])
        mine = sorted((x for x in out if x[0] == run), key=lambda x: x[1])
        for k, x in enumerate(mine):
            x[2] = 0 if run == "flat" else 4 if run == "once" else files * k // n
    return out


def plain(df):
    w = Window.partitionBy("run_label").orderBy("elapsed_seconds", "image_files")
    rose = df.withColumn("rose", F.col("image_files") > F.coalesce(F.lag("image_files").over(w), F.lit(0)))
    o = rose.filter("rose").groupBy("run_label").agg(F.min("elapsed_seconds").alias("first_output"), F.max("elapsed_seconds").alias("last_output"))
    inside = F.col("elapsed_seconds").between(F.col("first_output"), F.col("last_output"))
    s = df.join(o, "run_label", "left").groupBy("run_label").agg(F.avg("gpu_util_percent").alias("mean_util"), F.avg(F.when(inside, F.col("gpu_util_percent"))).alias("output_util"), F.max("gpu_memory_mb").alias("peak_memory_mb"), F.avg("power_w").alias("mean_power_w"), F.count("*").alias("samples"))
    return o, s


@pytest.mark.parametrize("seed, block", [(1, 1000.0), (1, 10.0), (2, 0.5), (3, 3.0)])
def test_two_levels(spark, seed, block):
    df = spark.createDataFrame(samples(seed), SAMPLE).repartition(3).cache()
    o, s = plain(df)
    assert sorted(map(tuple, T.output_window(df, block).collect())) == sorted(map(tuple, o.collect()))
    got, want = ({r.run_label: r for r in x.collect()} for x in (T.gpu_run_summary(df, block), s))
    assert got.keys() == want.keys()
    for k, r in want.items():
        for x, y in zip(tuple(got[k])[1:], tuple(r)[1:], strict=True):
            assert x == y if y is None else x == pytest.approx(y, rel=1e-9), k


def test_one_run_uses_many_tasks(spark):
    """A single run is shuffled by (run, block): no window of samples is over the run alone."""
    df = spark.createDataFrame(samples(1), SAMPLE)
    plan = T.gpu_run_summary(df.filter("run_label = 'a'"), 10.0)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "elapsed_seconds" in line]
    assert windows and all("block" in line for line in windows)


def placed(n=300):
    r, start = random.Random(6), datetime(2024, 1, 1)
    out = []
    for k in range(n):
        run = f"run_{k % 3}"
        out.append((run, k, start + timedelta(minutes=7 * k, seconds=r.randint(0, 50)), 0 if r.random() < 0.6 else 1, r.randint(0, 3), "G", 10.0, 0.0, float(k // 200)))
    return out, start + timedelta(minutes=7 * n)


PLACED = "run_label string, event_id long, ts timestamp, gpu_index long, pid long, process_type string, framebuffer_mb double, sm_util_percent double, start_time double"


def first_violations(rows, keep):
    seen, out = {}, {}
    for run, k, ts, gpu, pid, *_, start in sorted(rows, key=lambda x: (x[2], x[1])):
        if gpu == 0:
            seen[run, pid] = (start, ts)
        elif run not in out:
            at = seen.get((run, pid))
            if at is None or at[0] != start or ts - at[1] > keep:
                out[run] = (run, k, pid, "unverified_graphics_placement")
    return sorted(out.values())


def shuffled(spark, folder, rows, schema, last):
    """Batches of one file each, in no order, and one row much later that drives the watermark on."""
    rows = list(rows)
    random.Random(2).shuffle(rows)
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).coalesce(1).write.mode("append").json(f"{folder}/in")
    spark.createDataFrame([last], schema).coalesce(1).write.mode("append").json(f"{folder}/in")
    return spark.readStream.schema(spark.createDataFrame([last], schema).schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in")


@pytest.mark.parametrize("keep", [timedelta(days=3), timedelta(minutes=20)])
def test_guard_on_shuffled_batches(spark, tmp_path, keep):
    rows, end = placed()
    last = ("late", 10**6, end + timedelta(days=20), 0, 1, "G", 1.0, 0.0, 0.0)
    stream = shuffled(spark, tmp_path, rows, PLACED, last)
    guard = S.placement_guard_stream(stream, 0, late="10 days", keep_ms=int(keep.total_seconds() * 1000))
    S.drain(guard, f"{tmp_path}/out", f"{tmp_path}/state", rocks=True)
    got = spark.read.schema(S.GUARD).parquet(f"{tmp_path}/out").collect()
    assert sorted(map(tuple, got)) == first_violations(rows, keep)
    state = spark.read.format("statestore").option("path", f"{tmp_path}/state").option("stateVarName", "held").load()
    # Of the rows nothing is held but the last one, which no watermark has passed.
    assert state.count() == 1


def test_throughput_on_shuffled_batches(spark, tmp_path):
    r, start, rows = random.Random(3), datetime(2024, 1, 1), []
    for run in ("a", "b"):
        total = 0
        for k in range(120):
            total = 0 if r.random() < 0.05 else total + r.randint(0, 6)
            rows.append((run, k, start + timedelta(minutes=11 * k), total))
    schema = "run_label string, event_id long, ts timestamp, total long"
    stream = shuffled(spark, tmp_path, rows, schema, ("late", 10**6, start + timedelta(days=30), 1))
    S.drain(S.live_throughput(stream, "10 days"), f"{tmp_path}/out", f"{tmp_path}/state", rocks=True)
    got = spark.read.schema("run_label string, start timestamp, samples long, files long, restarts long, files_per_second double").parquet(f"{tmp_path}/out").collect()
    want, last = {}, {}
    for run, _, ts, total in rows:
        w = want.setdefault((run, ts.replace(minute=0)), [0, 0, 0])
        before = last.get(run, 0)
        w[0] += 1
        w[1] += total if total < before else total - before
        w[2] += total < before
        last[run] = total
    assert {(x.run_label, x.start): [x.samples, x.files, x.restarts] for x in got} == want
    assert all(x.files_per_second == x.files / 3600 for x in got)


class _Kept(dict):
    """Stands for a state variable of any kind; calls that write are counted."""

    writes = 0

    def updateValue(self, k, v):  # noqa: N802
        self[k], self.writes = v, self.writes + 1

    def update(self, v):
        self[None], self.writes = v, self.writes + 1

    getValue = dict.__getitem__  # noqa: N815
    removeKey = dict.__delitem__  # noqa: N815
    exists = dict.__len__

    def get(self):
        return self[None]


class _Handle:
    def __init__(self):
        self.timers, self.state = set(), {}

    def getMapState(self, name, *_):  # noqa: N802
        return self.state.setdefault(name, _Kept())

    getValueState = getMapState  # noqa: N815

    def registerTimer(self, ms):  # noqa: N802
        self.timers.add(ms)


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


def test_waiting_rows_cost_few_state_calls():
    """A thousand minutes wait as a chunk and a timer; buckets come out whole, in order, up to the watermark."""

    class Seen(S.Ordered):
        def released(self, key, rows, until):
            yield rows.assign(until=until)

    handle, guard = _Handle(), Seen(S.MINUTE)
    guard.init(handle)
    rows = pd.DataFrame({"ts_ms": [k * S.MINUTE + 5 for k in range(1000)], "event_id": range(1000)})
    list(guard.handleInputRows(("r",), iter([rows.sample(frac=1, random_state=1)]), _At(0)))
    assert handle.timers == {S.MINUTE} and handle.state["held"].writes == 1
    out, mark = [], 700 * S.MINUTE + 9
    list(guard.handleInputRows(("r",), iter([rows[:0]]), _At(mark)))
    for now in (mark, 2000 * S.MINUTE):
        for t in sorted(t for t in handle.timers if t <= now):
            handle.timers.remove(t)
            clock = _At(t)
            out += guard.handleExpiredTimer(("r",), _At(now), clock)
        if now == mark:
            assert len(out) == 700
    got = pd.concat(out)
    assert got["event_id"].tolist() == list(range(1000)) and (got["until"] == (got["event_id"] + 1) * S.MINUTE).all()
    assert not handle.state["held"] and not handle.timers
