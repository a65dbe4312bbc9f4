"""Centroid clustering (Lloyd's rounds in whole numbers) over a vector-approximation file.

Vectors are written once, as records of fixed length in files of the shared folder, and beside them a much smaller table of
approximations: for each component the number of a cell, a byte or less, between quantiles of a bounded sample. A round reads
the approximations only. Lookup tables give each component's cell as a centre and half a width; from them comes an interval
of the distance to every centroid, counted from the distance to the centroids' mean, which is the same for all and makes the
intervals narrow. Where one interval lies below all others the vector is settled; only where intervals overlap is the full
vector fetched, by its place in the file, and measured exactly, so that the clusters are those of a plain pass.

A round adds up only the vectors that change their cluster: a task assigns its approximations under the previous and under
the present centroids and fetches those that moved. Nothing is kept from round to round but the centroids and the clusters'
sums, which the driver holds (k rows); a lost task is done again from the files. No vector is shuffled. The first round,
which needs the sums of all, and the last, which gives out distances, read every vector.

Defined results: vectors of another length, with a null or with a value that isn't finite are left out; a null vec_id has no
hash and starts no centroid while there are others, but is clustered; rows that repeat a vec_id are vectors of their own, and among equal hashes the smaller
vector starts; with fewer vectors than k every one starts a centroid; equal distances go to the smaller number; an empty
table gives an empty result; further columns are ignored. Components of 2**27 and more raise an error, as distances would
not fit a long.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import discard, new_path, stash, tidy_batches, tune

#: Vectors of one row of the approximation table.
BLOCK = 1024
#: Vectors, those of the smallest hashes, whose quantiles bound the cells. They change no result.
SAMPLE = 4096
#: Records between two wanted ones that are read rather than skipped.
GAP = 8
LIMIT = 1 << 27

APPROXIMATIONS = "file string, n int, cells binary, low binary, high binary, ids binary, known binary"


def whole_numbers(df: DataFrame, vector: str, dims: int) -> DataFrame:
    """vec_id and v, the components as floor(1024 * x), of the vectors that are kept."""
    sound = (F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return df.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * 1024)).alias("v"))


def _hash(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def _matrix(column, dims: int) -> np.ndarray:
    v = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    if len(v) and max(-int(v.min()), int(v.max())) >= LIMIT:
        raise OverflowError(f"a component is {LIMIT} or more after scaling")
    return v


class Grid:
    """Cells of each component: edges[d] are their first values but for the first cell's."""

    def __init__(self, sample: np.ndarray, bits: int):
        n = 1 << bits
        at = np.arange(1, n) * len(sample) // n
        self.edges = np.sort(sample, axis=0)[at].T + 1

    def cells(self, v: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, v[:, d], "right") for d, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def tables(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centre and half width of every component's cells, whose outer ones end at a block's smallest and largest value."""
        begin = np.concatenate([low[:, None], self.edges], axis=1)
        end = np.concatenate([self.edges - 1, high[:, None]], axis=1)
        begin, end = np.maximum(begin, low[:, None]), np.minimum(end, high[:, None])
        return (begin + end) / 2.0, np.maximum(end - begin, 0) / 2.0


def intervals(centre: np.ndarray, half: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance of each approximated vector to each centroid, less its distance to the centroids' mean."""
    c = centroids.astype(np.float64)
    mean = c.mean(0)
    slope = 2 * (mean - c).T
    middle = centre @ slope + ((c * c).sum(1) - (mean * mean).sum())
    reach = half @ np.abs(slope)
    # Rounding of sums of products, far below a unit for components of ordinary size.
    reach += 1e-12 * (np.abs(centre) @ np.abs(slope) + (c * c).sum(1) + (mean * mean).sum()) + 1e-6
    return middle - reach, middle + reach


def measured(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number among equals) and squared distance of full vectors."""
    d = np.stack([((v - c) ** 2).sum(1) for c in centroids], axis=1)
    near = d.argmin(1)
    return near, d[np.arange(len(v)), near]


class Records:
    """Full vectors of one file; take() reads single ones by their number."""

    def __init__(self, uri: str, dims: int):
        where, path = fs.FileSystem.from_uri(uri)
        self.file, self.dims = where.open_input_file(path), dims

    def take(self, which: np.ndarray) -> np.ndarray:
        """Vectors of the given numbers, which ascend."""
        size, out = 4 * self.dims, []
        for run in np.split(which, np.flatnonzero(np.diff(which) > GAP) + 1) if len(which) else ():
            first, last = int(run[0]), int(run[-1])
            some = np.frombuffer(self.file.read_at(size * (last - first + 1), size * first), "<i4").reshape(-1, self.dims)
            out.append(some[run - first])
        return np.concatenate(out).astype(np.int64) if out else np.zeros((0, self.dims), np.int64)


def approximate(vectors: DataFrame, grid: Grid, dims: int, folder: str) -> DataFrame:
    """Write the vectors of each task as records of one file for each block and give the table of approximations."""

    def run(batches):
        held_ids, held, n = [], [], 0

        def block(ids, v):
            uri = f"{folder}/{uuid.uuid4().hex}"
            where, path = fs.FileSystem.from_uri(uri)
            where.create_dir(path.rpartition("/")[0], recursive=True)
            with where.open_output_stream(path, compression=None) as out:
                out.write(v.astype("<i4").tobytes())
            low, high = v.min(0), v.max(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            columns = ([uri], [len(v)], [grid.cells(v).tobytes()], [low.tobytes()], [high.tobytes()], [ids.fill_null(0).to_numpy().tobytes()], [known.tobytes()])
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), *[pa.binary()] * 5), strict=True)], names=["file", "n", "cells", "low", "high", "ids", "known"])

        for b in batches:
            for a in range(0, b.num_rows, BLOCK):
                part = b.slice(a, BLOCK)
                held_ids.append(part["vec_id"])
                held.append(_matrix(part["v"], dims))
                n += part.num_rows
                if n >= BLOCK:
                    yield block(pa.concat_arrays(held_ids), np.concatenate(held))
                    held_ids, held, n = [], [], 0
        if n:
            yield block(pa.concat_arrays(held_ids), np.concatenate(held))

    return vectors.mapInArrow(tidy_batches(run), APPROXIMATIONS)


def _blocks(batches, dims: int):
    """(records, cells, low, high, row) of each block."""
    for b in batches:
        for k in range(b.num_rows):
            row = b.slice(k, 1)
            read = lambda name, kind: np.frombuffer(row[name][0].as_buffer(), kind)  # noqa: B023, E731
            yield row, Records(row["file"][0].as_py(), dims), read("cells", np.uint8).reshape(-1, dims), read("low", np.int64), read("high", np.int64)


def _gathered(grid: Grid, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    centre, half = grid.tables(low, high)
    d = np.arange(cells.shape[1])
    return centre[d, cells], half[d, cells]


def _settled(centre: np.ndarray, half: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid, or -1 where intervals overlap."""
    low, high = intervals(centre, half, centroids)
    near = high.argmin(1)
    rivals = (low <= high[np.arange(len(near)), near][:, None]).sum(1)
    return np.where(rivals == 1, near, -1)


def moved_sums(approx: DataFrame, grid: Grid, dims: int, before: np.ndarray | None, now: np.ndarray) -> DataFrame:
    """cluster, d, total: what each cluster's count (d = dims) and component sums change by from the centroids before to those
    of now; without those before, the sums of all vectors. fetched: records that were read."""
    k = len(now)

    def run(batches):
        total, fetched = np.zeros((k, dims + 1), np.int64), 0
        for _, records, cells, low, high in _blocks(batches, dims):
            n = len(cells)
            if before is None:
                v = records.take(np.arange(n))
                new, old = measured(v, now)[0], np.full(n, -1)
                want = np.arange(n)
            else:
                centre, half = _gathered(grid, cells, low, high)
                old, new = _settled(centre, half, before), _settled(centre, half, now)
                want = np.flatnonzero((old < 0) | (new < 0) | (old != new))
                v = records.take(want)
                for label, centroids in ((old, before), (new, now)):
                    open_ = label[want] < 0
                    label[want[open_]] = measured(v[open_], centroids)[0]
            fetched += len(want)
            moved = old[want] != new[want]
            v, old, new = v[moved], old[want][moved], new[want][moved]
            ones = np.concatenate([v, np.ones((len(v), 1), np.int64)], axis=1)
            for c in range(k):
                total[c] += ones[new == c].sum(0) - ones[old == c].sum(0)
        c, d = np.divmod(np.arange(total.size), dims + 1)
        columns = [pa.array(np.append(c, -1), pa.int32()), pa.array(np.append(d, 0), pa.int32()), pa.array(np.append(total.ravel(), fetched), pa.int64())]
        yield pa.record_batch(columns, names=["cluster", "d", "total"])

    rows = approx.select("file", "n", "cells", "low", "high").mapInArrow(tidy_batches(run), "cluster int, d int, total long")
    return rows.groupBy("cluster", "d").agg(F.sum("total").alias("total"))


def assigned(approx: DataFrame, dims: int, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1)
                near, distance = measured(Records(row["file"][0].as_py(), dims).take(np.arange(row["n"][0].as_py())), centroids)
                ids, known = np.frombuffer(row["ids"][0].as_buffer(), np.int64), np.frombuffer(row["known"][0].as_buffer(), bool)
                yield pa.record_batch([pa.array(ids, pa.int64(), mask=~known), pa.array(near, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return approx.select("file", "n", "ids", "known").mapInArrow(tidy_batches(run), "vec_id long, cluster int, distance long")


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(df: DataFrame, vector: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10, seed: int = 3, bits: int = 8, stats: list | None = None) -> DataFrame:
    """embeddings -> vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256. bits: of a cell's number. stats, if
    given, gets the number of vectors that each round fetched."""
    if not 1 <= bits <= 8:
        raise ValueError("cells have 1 to 8 bits")
    spark = tune(df.sparkSession)
    vectors = whole_numbers(df, vector, dims)
    sample = vectors.withColumn("h", _hash(seed)).orderBy(F.col("h").asc_nulls_last(), "v").select("v").limit(max(SAMPLE, k)).collect()
    if not sample:
        return spark.createDataFrame([], RESULT)
    sample = np.array([r.v for r in sample], np.int64)
    grid, now, before = Grid(sample, bits), sample[:k].copy(), None
    folder = new_path(spark, "vectors")
    approx = stash(approximate(vectors, grid, dims, folder), "approximations")
    sums = np.zeros((len(now), dims + 1), np.int64)
    for _ in range(rounds):
        for r in moved_sums(approx, grid, dims, before, now).collect():  # (dims + 1) * k rows
            if r.cluster >= 0:
                sums[r.cluster, r.d] += r.total
            elif stats is not None:
                stats.append(r.total)
        before, count = now, sums[:, dims:]
        now = np.where(count > 0, sums[:, :dims] // np.maximum(count, 1), before)
        if (now == before).all():
            break  # further rounds change nothing
    done = stash(assigned(approx, dims, now), "assigned")
    discard(spark, folder, approx)
    by_cluster = {r.cluster: r.s for r in done.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    per = of([by_cluster.get(c, 0) for c in range(len(now))])
    return done.withColumns({"cluster_inertia": per.cast("long"), "inertia": F.lit(sum(by_cluster.values())).cast("long"), "centroid_sha256": of(digest)})
