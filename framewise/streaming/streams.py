"""Structured Streaming forms of the telemetry operators. Event time is the sample's timestamp; later rows than the watermark
are dropped, which is a policy of this library."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framewise.operators.telemetry import DISPLAY_CONTEXT_MB

STEP = "event_id long, step_id string, ts timestamp, files_present int, wall_seconds double, success boolean"


def step_stream(spark: SparkSession, folder: str) -> DataFrame:
    """An append-only folder of JSON lines as a stream of steps."""
    return spark.readStream.schema(STEP).json(folder)


def progress_stream(attempts: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Running completed, failed and resumed attempts per run; a requeued copy of an attempt (job, attempt) counts once."""
    once = attempts.withWatermark("ts", late).dropDuplicatesWithinWatermark(["job_id", "attempt"])
    return once.groupBy("run").agg(F.count_if(F.col("returncode") == 0).alias("completed"), F.count_if(F.col("returncode") != 0).alias("failed"), F.count_if("resumed").alias("resumed"))


MINUTE = 60_000
HOUR = 60 * MINUTE


class Ordered(StatefulProcessor):
    """Rows of a key in the order of their time, whatever order they came in. Rows wait in state, in chunks of a day of event
    time, or of a bucket if that is longer; a timer stands for the first bucket (of `bucket` milliseconds) that waits. When the
    watermark passes it, all buckets that end by then are released, in order, sorted by ts_ms and event_id, and what is left of
    a chunk is put back. Rows of a bucket that is out already are late and dropped. State holds what the watermark has not
    passed; calls to it grow with the chunks, not with the buckets."""

    def __init__(self, bucket: int):
        self.bucket = bucket
        self.chunk = -(-24 * HOUR // bucket) * bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "chunk long, n long", "rows binary")
        self.chunks = handle.getValueState("chunks", "n long")
        self.next = handle.getValueState("next", "ms long")

    def wanted(self) -> bool:
        return True

    def released(self, key, rows: pd.DataFrame, until: int) -> Iterator[pd.DataFrame]:
        """What a bucket's rows give; until is its end."""
        raise NotImplementedError

    def all_released(self, key, rows: pd.DataFrame, until: int) -> Iterator[pd.DataFrame]:
        """What the rows of all buckets that are due give; until is the last one's end."""
        for bucket, part in rows.groupby(rows["ts_ms"] // self.bucket):
            yield from self.released(key, part, (int(bucket) + 1) * self.bucket)

    def _end(self, ms: int) -> int:
        return (int(ms) // self.bucket + 1) * self.bucket

    def _wake(self, ms: int) -> None:
        self.handle.registerTimer(ms)
        self.next.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.wanted():
            return
        n = self.chunks.get()[0] if self.chunks.exists() else 0
        first = self.next.get()[0] if self.next.exists() else None
        least, out = first, timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            frame = frame[(frame["ts_ms"] // self.bucket + 1) * self.bucket > out]
            for chunk, part in frame.groupby(frame["ts_ms"] // self.chunk):
                self.held.updateValue((int(chunk), n), (pickle.dumps(part.to_dict("list")),))
                end = self._end(part["ts_ms"].min())
                least, n = end if least is None else min(least, end), n + 1
        self.chunks.update((n,))
        if least != first:
            self._wake(least)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.wanted():
            return
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) // self.bucket * self.bucket
        parts, left = [], []
        for k in sorted(tuple(k) for k in self.held.keys()):
            first = k[0] * self.chunk + self.bucket  # no bucket of it ends before
            if first <= now:
                part = pd.DataFrame(pickle.loads(self.held.getValue(k)[0]))
                due = part["ts_ms"] < now
                if due.any():
                    parts.append(part[due])
                    part = part[~due]
                    if len(part):
                        self.held.updateValue(k, (pickle.dumps(part.to_dict("list")),))
                    else:
                        self.held.removeKey(k)
                        continue
                first = self._end(part["ts_ms"].min())
            left.append(first)
        if left:
            self._wake(min(left))
        else:
            self.next.clear()
        if parts:
            yield from self.all_released(key, pd.concat(parts).sort_values(["ts_ms", "event_id"]), now)

    def close(self) -> None:
        pass


THROUGHPUT = "run_label string, start_ms long, samples long, files long, restarts long, files_per_second double"


class Throughput(Ordered):
    """Per run and window: files that came in by differences of rescanned totals. A total below the one before is that of a
    counter that began again. The last total goes from window to window."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "total long")

    def released(self, key, rows: pd.DataFrame, until: int) -> Iterator[pd.DataFrame]:
        totals = rows["total"].to_numpy()
        before = np.concatenate([[self.last.get()[0] if self.last.exists() else 0], totals[:-1]])
        again = totals < before
        files = int(np.where(again, totals, totals - before).sum())
        self.last.update((int(totals[-1]),))
        out = {"run_label": [key[0]], "start_ms": [until - self.bucket], "samples": [len(totals)], "files": [files], "restarts": [int(again.sum())], "files_per_second": [files * 1000.0 / self.bucket]}
        yield pd.DataFrame(out)


def live_throughput(samples: DataFrame, late: str = "10 minutes", window_ms: int = HOUR) -> DataFrame:
    """samples(run_label, event_id, ts, total: files of the run so far) -> files and rate per run and tumbling window that the
    watermark has closed and that has samples. Start it by drain(..., rocks=True)."""
    rows = samples.withWatermark("ts", late).select("run_label", "event_id", "ts", F.unix_millis("ts").alias("ts_ms"), F.col("total").cast("long").alias("total"))
    out = rows.groupBy("run_label").transformWithStateInPandas(Throughput(window_ms), THROUGHPUT, "Append", "EventTime")
    return out.select("run_label", F.timestamp_millis("start_ms").alias("start"), "samples", "files", "restarts", "files_per_second")


GUARD = "run_label string, event_id long, pid long, reason string"


class PlacementGuard(Ordered):
    """Per run: the start time at which each pid was last seen on the target, and the first violation only. A process off the
    target is verified while its start time is that one and it was seen there within `keep` milliseconds; the rule itself is
    placement_reason()'s. Pids that were not seen for so long are forgotten."""

    def __init__(self, bucket: int, target: int, most_mb: float, keep: int):
        super().__init__(bucket)
        self.target, self.most_mb, self.keep = target, most_mb, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getMapState("seen", "pid long", "start double, ms long")
        self.swept = handle.getValueState("swept", "ms long")
        self.done = handle.getValueState("done", "done boolean")

    def wanted(self) -> bool:
        return not self.done.exists()

    def reason(self, r, verified: bool) -> str | None:
        active, memory = r.sm_util_percent is not None and r.sm_util_percent > 0, r.framebuffer_mb
        known = memory is not None and not pd.isna(memory)
        if r.process_type == "G" and verified and known and 0 <= memory <= self.most_mb and not active:
            return None
        big = known and memory > self.most_mb
        return "compute_context" if "C" in r.process_type else "sm_activity" if active else "framebuffer_allocation" if big else "unverified_graphics_placement"

    def all_released(self, key, rows: pd.DataFrame, until: int) -> Iterator[pd.DataFrame]:
        known: dict[int, tuple[float, int] | None] = {}  # of these rows' pids
        for r in rows.itertuples():
            if r.pid not in known:
                known[r.pid] = tuple(self.seen.getValue((r.pid,))) if self.seen.containsKey((r.pid,)) else None
            if r.gpu_index == self.target:
                known[r.pid] = (float(r.start_time), int(r.ts_ms))
                continue
            at = known[r.pid]
            if reason := self.reason(r, at is not None and at[0] == r.start_time and r.ts_ms - at[1] <= self.keep):
                self.done.update((True,))
                for state in (self.held, self.seen, self.next):
                    state.clear()
                yield pd.DataFrame({"run_label": [key[0]], "event_id": [r.event_id], "pid": [r.pid], "reason": [reason]})
                return
        for pid, value in known.items():
            if value is not None:
                self.seen.updateValue((pid,), value)
        if not self.swept.exists() or until - self.swept.get()[0] >= self.keep:
            self.swept.update((until,))
            for k, v in [(tuple(k), tuple(v)) for k, v in self.seen.iterator()]:
                if until - v[1] > self.keep:
                    self.seen.removeKey(k)


def placement_guard_stream(samples: DataFrame, target: int, most_mb: float = DISPLAY_CONTEXT_MB, late: str = "10 minutes", keep_ms: int = 24 * HOUR) -> DataFrame:
    """The first violation of each run among samples(run_label, event_id, ts, gpu_index, pid, process_type, framebuffer_mb,
    sm_util_percent, start_time) that the watermark has passed, in the order of ts. Start it by drain(..., rocks=True)."""
    rows = samples.withWatermark("ts", late).withColumn("ts_ms", F.unix_millis("ts"))
    return rows.groupBy("run_label").transformWithStateInPandas(PlacementGuard(MINUTE, target, most_mb, keep_ms), GUARD, "Append", "EventTime")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", rocks: bool = False) -> None:
    """Run a stream over what there is now into a Parquet folder (append) and stop. rocks: with the RocksDB state store, which
    several state variables need; the session's own setting is put back."""
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER)
    if rocks:
        conf.set(_PROVIDER, _ROCKS)
    try:
        stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(_PROVIDER, before)
