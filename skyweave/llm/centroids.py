"""Centroid clustering with a VA-file: vectors compressed to few-bit cells, full vectors fetched only where the cells can't decide.

A kept vector is written once, as integers, to a table bucketed by row, and once more as cells of a few bits a dimension, cut evenly over the
middle of each dimension and open at its ends. A round reads the cells alone: tables for each centroid, dimension and cell give the least and
the greatest that the cell's values can add to the distance (but for the vector's own squared length, which is the same for all centroids), and
their sums an interval a centroid. Where one interval lies below all others the vector's cluster is known. Sums of clusters are carried from
round to round: a row whose cells prove that it stayed in its cluster changes nothing, and only the others, whose intervals overlap or whose
cluster changes, are fetched from the vectors' bucket by their row number, to be moved from one sum to another. Only those numbers are
shuffled. The first round and the last distances need every vector, and take an exact distance to the centroids whose intervals overlap.

Vectors that are null, of another length, or with null or non-finite components are left out. Components from 2**31 as integers count as 2**31 - 1:
their squared distances are too long for a long anyway, and distances and inertias beyond a long are the largest long. Rows that repeat a vec_id
are rows of their own, and candidates for the start like any other (ties: by components); rows of null vec_id start no centroid. Fewer vectors than
centroids: all start one; identical vectors start equal centroids, of which the first takes all. An empty table, or one in which only null ids are
kept, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import intermediates, materialize

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Bits of a cell, and standard deviations around a dimension's mean over which cells are cut.
BITS, SPREAD = 7, 3.0
#: Vectors that are compared with the centroids at once.
AT_ONCE = 2048
#: Rows of a bucket of the table of vectors, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 1 << 20, 20_000
#: Components up to which sums of squares fit into 64 bits.
_PLAIN = 1 << 27
_CLIP, _LONG = (1 << 31) - 1, (1 << 63) - 1


class Grid(NamedTuple):
    """least and greatest value of each dimension's cells, in arrays of dimensions x cells, the last being the cells' lower ends."""

    least: np.ndarray
    greatest: np.ndarray


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are kept, and floor(SCALE * x) of their components."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(lengths == DIMENSIONS)
    values = column.take(pa.array(kept)).flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
    finite = np.isfinite(values).all(1)
    with np.errstate(over="ignore"):
        whole = np.floor(SCALE * values[finite])
    return kept[finite], np.clip(whole, -_CLIP, _CLIP).astype(np.int32)


def grid(stats: list, bits: int = BITS) -> Grid:
    """Cells over the mean and SPREAD deviations of each dimension, given its (n, sum, sum of squares, least, greatest); the outer cells reach to
    the dimension's ends."""
    least, greatest = np.zeros((2, len(stats), 1 << bits), np.int64)
    for d, (n, total, squares, low, high) in enumerate(stats):
        mean = total / n
        wide = max(1.0, SPREAD * max(0.0, squares / n - mean * mean) ** 0.5)
        cuts = np.floor(np.linspace(mean - wide, mean + wide, (1 << bits) - 1)).astype(np.int64)
        least[d] = np.concatenate([[low], np.maximum(cuts, low)])
        greatest[d] = np.minimum(np.concatenate([cuts - 1, [high]]), high)
    return Grid(least, np.maximum(greatest, least))


def cells(x: np.ndarray, cut: Grid) -> np.ndarray:
    """The cell of each component."""
    found = np.empty(x.shape, np.uint8)
    for d in range(x.shape[1]):
        found[:, d] = np.searchsorted(cut.least[d, 1:], x[:, d], "right")
    return found


def packed(codes: np.ndarray, bits: int = BITS) -> list[bytes]:
    return [r.tobytes() for r in np.packbits(np.unpackbits(codes[:, :, None], axis=2, count=bits, bitorder="little").reshape(len(codes), -1), axis=1)]


def unpacked(column: pa.Array, bits: int = BITS) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    planes = np.unpackbits(flat, axis=1, count=DIMENSIONS * bits).reshape(len(column), DIMENSIONS, bits)
    return np.packbits(planes, axis=2, bitorder="little")[:, :, 0]


def _square(centroids: np.ndarray) -> np.ndarray:
    return (centroids * centroids).sum(1)


class Tables:
    """For each dimension and cell the least and greatest part of every centroid's distance, without the vector's own squared length."""

    def __init__(self, cut: Grid, centroids: np.ndarray):
        # as distances of different centroids are compared, whatever all have in common may be left out: their middle, too
        self.exact = max(np.abs(centroids).max(), np.abs(cut.least).max(), np.abs(cut.greatest).max()) <= _PLAIN
        self.centroids = centroids if self.exact else centroids.astype(object)
        kind = np.float64 if not self.exact else np.int64
        pull = -2 * (centroids - centroids.sum(0) // len(centroids)).astype(kind)  # centroids x dimensions
        one, other = (pull.T[:, None, :] * ends.astype(kind)[:, :, None] for ends in cut)  # dimensions x cells x centroids
        self.least, self.width = np.minimum(one, other), np.abs(other - one)
        self.own = _square(self.centroids).astype(kind)
        self.slack = 0 if self.exact else 1e-9 * (np.abs(self.least) + self.width).max(1).sum(0).max() + 1e-9 * np.abs(self.own).max()

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """Which centroids may be the nearest of each vector: those whose intervals reach below the least upper end."""
        low = np.tile(self.own, (len(codes), 1))
        wide = np.zeros_like(low)
        for d in range(codes.shape[1]):
            low += self.least[d][codes[:, d]]
            wide += self.width[d][codes[:, d]]
        return low <= (low + wide).min(1, keepdims=True) + self.slack

    def distances(self, x: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Exact squared distances of vectors to one centroid each."""
        exact = self.exact and (not len(x) or np.abs(x).max() <= _PLAIN)
        gap = (x if exact else x.astype(object)) - (self.centroids if exact else self.centroids.astype(object))[k]
        return (gap * gap).sum(1)

    def nearest(self, x: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of each vector's candidates (ties: the first), and its exact distance; a vector with one candidate is compared with that
        only."""
        row, k = np.nonzero(maybe)
        away = self.distances(x[row], k)
        first = np.concatenate([[0], np.cumsum(maybe.sum(1))[:-1]]).astype(np.int64)
        least = np.minimum.reduceat(away, first) if len(first) else away
        hit = np.flatnonzero(away == least[row])
        chosen = hit[np.unique(row[hit], return_index=True)[1]]
        return k[chosen], away[chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, DIMENSIONS)


def _slices(batch: pa.RecordBatch):
    return (batch.slice(i, AT_ONCE) for i in range(0, batch.num_rows, AT_ONCE))


def _stats(batches):
    """(d, n, total, squares, least, greatest) of each dimension in a partition."""
    n, total, squares, low, high = 0, 0.0, 0.0, None, None
    for batch in batches:
        x = _matrix(batch.column("x"))
        if len(x):
            n, total, squares = n + len(x), total + x.sum(0, dtype=float), squares + (x.astype(float) ** 2).sum(0)
            low, high = (x.min(0) if low is None else np.minimum(low, x.min(0))), (x.max(0) if high is None else np.maximum(high, x.max(0)))
    if n:
        yield pa.RecordBatch.from_pydict({"d": np.arange(DIMENSIONS, dtype=np.int32), "n": np.full(DIMENSIONS, n), "total": total, "squares": squares, "least": low, "greatest": high})


def _coded(cut: Grid):
    def over(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "cells": pa.array(packed(cells(_matrix(batch.column("x")), cut)), pa.binary())})

    return over


def _sums(moves) -> pa.RecordBatch:
    """(k, x, n): for each centroid the sum and number of the vectors that came to it, less those that left; x as decimals."""
    total: dict[int, list[int]] = {}
    n: dict[int, int] = {}
    for k, x, sign in moves:
        for c in np.unique(k).tolist():
            own = x[k == c]
            part = own.sum(0) * sign  # under 2**31 * AT_ONCE: fits
            total[c] = [a + b for a, b in zip(total.get(c, [0] * DIMENSIONS), part.tolist(), strict=True)]
            n[c] = n.get(c, 0) + sign * len(own)
    rows = [(c, d, v, n[c]) for c, own in total.items() for d, v in enumerate(own)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.decimal128(38, 0)), pa.array([r[3] for r in rows], pa.int64())], ["k", "d", "total", "n"])


_SUMS = "k int, d int, total decimal(38,0), n bigint"


def _first(cut: Grid, centroids: np.ndarray):
    """Sums of the clusters of all vectors."""

    def over(batches):
        tables = Tables(cut, centroids)

        def moves():
            for batch in batches:
                for part in _slices(batch):
                    x = _matrix(part.column("x"))
                    yield tables.nearest(x, tables.candidates(cells(x, cut)))[0], x, 1

        yield _sums(moves())

    return over


def _overlapping(cut: Grid, before: np.ndarray, after: np.ndarray):
    """The rows whose cells don't prove that they stay in their cluster."""

    def over(batches):
        old, new = Tables(cut, before), Tables(cut, after)
        for batch in batches:
            for part in _slices(batch):
                codes = unpacked(part.column("cells"))
                was, now = old.candidates(codes), new.candidates(codes)
                stay = (was.sum(1) == 1) & (was == now).all(1)
                yield pa.RecordBatch.from_arrays([part.column("row").filter(pa.array(~stay))], ["row"])

    return over


def _moved(cut: Grid, before: np.ndarray, after: np.ndarray):
    """What the fetched vectors change in the sums."""

    def over(batches):
        old, new = Tables(cut, before), Tables(cut, after)

        def moves():
            for batch in batches:
                for part in _slices(batch):
                    x = _matrix(part.column("x"))
                    codes = cells(x, cut)
                    was, now = old.nearest(x, old.candidates(codes))[0], new.nearest(x, new.candidates(codes))[0]
                    gone = was != now
                    yield was[gone], x[gone], -1
                    yield now[gone], x[gone], 1

        yield _sums(moves())

    return over


def _assigned(cut: Grid, centroids: np.ndarray):
    def over(batches):
        tables = Tables(cut, centroids)
        for batch in batches:
            for part in _slices(batch):
                x = _matrix(part.column("x"))
                k, away = tables.nearest(x, tables.candidates(cells(x, cut)))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(k, pa.int32()), pa.array(np.minimum(away, _LONG).astype(np.int64))], ["vec_id", "cluster", "distance"])

    return over


def _added(totals: np.ndarray, counts: np.ndarray, sums: DataFrame) -> None:
    """Adds a round's sums, centroids x dimensions of them, to the totals kept on the driver."""
    for r in sums.groupBy("k", "d").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        totals[r.k, r.d] += int(r.total)
        if r.d == 0:
            counts[r.k] += r.n


def vectors(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(row, vec_id, x): the kept vectors as integers, a number for each row, in a table bucketed by it."""
    spark = embeddings.sparkSession

    def kept(batches):
        for batch in batches:
            at, x = integers(batch.column("embedding"))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(at)), pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, DIMENSIONS), pa.int32()), pa.array(x.ravel()))], ["vec_id", "x"])

    named = embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding"))
    numbered = materialize(named.mapInArrow(kept, "vec_id bigint, x array<int>").withColumn("row", F.monotonically_increasing_id()))
    buckets = min(MOST_BUCKETS, max(8, numbered.count() // BUCKET_ROWS + 1))
    name = f"vectors_{uuid.uuid4().hex}"
    numbered.select("row", "vec_id", "x").repartition(buckets, "row").write.bucketBy(buckets, "row").option("path", f"{intermediates(spark)}/{name}").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")  # the catalogue's entry; the files stay as long as the other intermediate tables
    return table


def start(rows: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    first = rows.where("vec_id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "x").orderBy("h", "x").limit(count)
    return np.array([r.x for r in first.collect()], np.int64).reshape(-1, DIMENSIONS)


def fit(rows: DataFrame, rounds: int = ROUNDS, count: int = CENTROIDS, seed: int = SEED) -> tuple[Grid, np.ndarray]:
    """The cells' grid and the centroids after the rounds; none without vectors."""
    centroids = start(rows, count, seed)
    if not len(centroids):
        return Grid(*np.zeros((2, DIMENSIONS, 1 << BITS), np.int64)), centroids
    stats = rows.select("x").mapInArrow(_stats, "d int, n bigint, total double, squares double, least bigint, greatest bigint")
    stats = stats.groupBy("d").agg(F.sum("n"), F.sum("total"), F.sum("squares"), F.min("least"), F.max("greatest")).orderBy("d").collect()
    cut = grid([tuple(r)[1:] for r in stats])
    approximate = materialize(rows.select("row", "x").mapInArrow(_coded(cut), "row bigint, cells binary"))
    totals, counts, before = np.zeros((len(centroids), DIMENSIONS), object), [0] * len(centroids), None
    for _ in range(rounds):
        if before is None:
            sums = rows.select("x").mapInArrow(_first(cut, centroids), _SUMS)
        else:
            wanted = approximate.mapInArrow(_overlapping(cut, before, centroids), "row bigint")
            sums = rows.select("row", "x").join(wanted.hint("shuffle_hash"), "row").select("x").mapInArrow(_moved(cut, before, centroids), _SUMS)
        _added(totals, counts, sums)
        before, centroids = centroids, np.array([totals[k] // counts[k] if counts[k] else c for k, c in enumerate(centroids)]).astype(np.int64)
        if (before == centroids).all():
            break
    return cut, centroids


def cluster(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: its id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = embeddings.sparkSession
    rows = vectors(embeddings, vec_id, embedding)
    cut, centroids = fit(rows, rounds)
    if not len(centroids):
        return spark.createDataFrame([], f"`{vec_id}` bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    assigned = materialize(rows.select("vec_id", "x").mapInArrow(_assigned(cut, centroids), "vec_id bigint, cluster int, distance bigint"))
    own = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    named = spark.createDataFrame([(k, min(s, _LONG), min(sum(own.values()), _LONG), ",".join(map(str, centroids[k].tolist()))) for k, s in sorted(own.items())], "cluster int, cluster_inertia bigint, inertia bigint, components string")
    named = F.broadcast(named.select("cluster", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256")))  # a row a centroid
    return assigned.join(named, "cluster").select(F.col("vec_id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
