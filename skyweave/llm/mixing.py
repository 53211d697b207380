"""Mixing sources to target weights by the cube method: balanced sampling of documents inside each source.

A source's target is a weighted share of all sizes, at most CAP times its own size; what is above is shared again by weight.
With f = target / size of the source, every document gets floor(f) copies and one more with inclusion probability
f - floor(f). In the flight phase these probabilities move through the null space of the two constraints, number of documents and
number of words, until none can move: a step moves the largest undecided document, and all others of its block against it in
proportion to the room they have, until one of them is at 0 or 1. So large documents are decided while there are others to
balance them. Every document flies, in blocks of about BLOCK_DOCS dealt by hash; what the blocks leave, two documents each at most,
flies again in blocks of the next level, until a source is one block. There the flight ends with a small landing problem, of at most
LANDING documents and a quarter of the block, or of two: all its roundings are compared, and the one whose two totals come nearest to
those expected is taken.

Null text: size 0. Null source: a source of its own, last in order. Null doc_id: a document like others. Rows that repeat a doc_id
and size in a source are counted first and dealt out one by one, so they don't meet in one block. Ties are broken by hash, so that
reruns agree. A source without words has target 0. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyweave.llm.common import materialize

SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
#: Documents of a block, and blocks whose leftovers make one block of the next level.
BLOCK_DOCS, BLOCK_LEFT = 512, 256
#: Repeated rows that are dealt out at once.
REPEATS = 1 << 16
#: Documents left to the landing at most, and how much an error of a mean document's words counts against one of a document.
LANDING, WORDS_FIRST = 12, 100.0
_UNIT = "source_no bigint, block bigint, doc_id bigint, size bigint, copies bigint, part double, h bigint, mean double"
_NAMES = [x.split()[0] for x in _UNIT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64()]
_EPS = 1e-9


def source_targets(counted: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: source, source_no, n_docs, source_size, target, from rows (source, size, times). The windows run over rows of
    sources only."""
    by_source = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.sum("times").alias("n_docs"))
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(listed) - 1) % len(weights) + 1).cast("int"))
    numbered = by_source.select("*", F.row_number().over(listed).cast("bigint").alias("source_no"), weight.alias("weight"))
    every = Window.partitionBy()
    before = Window.orderBy((F.col("source_size") / F.col("weight")), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    own = cap * F.col("source_size")
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(own).over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levelled = numbered.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return levelled.select("source", "source_no", "n_docs", "source_size", F.least(own.cast("double"), F.col("weight") * F.col("level")).alias("target"))


def fly(size: np.ndarray, part: np.ndarray, seed: int, left: int = 0) -> np.ndarray:
    """Inclusion probabilities after the flight phase over documents in order of size, largest first; no more than `left`, or two, are
    neither 0 nor 1."""
    size, part, rng = size.astype(float), part.copy(), np.random.default_rng(seed)
    held = np.zeros(len(part), bool)  # that no vector of the null space moves
    live = np.flatnonzero((part > 0) & (part < 1))
    while len(live) > left and len(movable := live[~held[live]]):
        i = movable[0]
        rest = live[live != i]
        p, s = part[rest], size[rest]
        if not len(rest) or (s.min() == s.max()) and s[0] != size[i]:
            held[i] = True
            continue
        room = np.minimum(p, 1 - p)
        mean = (room @ s) / room.sum()
        off = s - mean
        tilt = off * (size[i] - mean) / ((room * off) @ off) if s.min() < s.max() else 0.0
        move = -room * (1 / room.sum() + tilt)
        up, down = move > 0, move < 0
        with np.errstate(divide="ignore", invalid="ignore"):
            ahead = np.where(up, (1 - p) / move, np.where(down, -p / move, np.inf))
            behind = np.where(up, p / move, np.where(down, (p - 1) / move, np.inf))
        forth, back = min(1 - part[i], ahead.min()), min(part[i], behind.min())
        onward = rng.random() * (forth + back) < back
        by = forth if onward else -back
        moved, ends = p + by * move, (ahead if onward else behind) <= abs(by)
        moved[ends] = np.round(moved[ends])
        part[rest], part[i] = moved, part[i] + by
        part[live] = np.where(part[live] < _EPS, 0.0, np.where(part[live] > 1 - _EPS, 1.0, part[live]))
        live = live[(part[live] > 0) & (part[live] < 1)]
    return part


def land(size: np.ndarray, part: np.ndarray, mean: float) -> np.ndarray:
    """The rounding of what the flight left whose words, in documents of mean size, and number of documents are nearest to those expected."""
    left = np.flatnonzero((part > 0) & (part < 1))
    ways = np.array(list(product((0.0, 1.0), repeat=len(left))))
    off = ways - part[left]
    out = part.copy()
    out[left] = ways[np.argmin(WORDS_FIRST * (off @ size[left] / max(mean, 1.0)) ** 2 + off.sum(1) ** 2)]
    return out


def _flown(last: bool):
    """Over documents sorted by source and block, of which one block is held at a time."""

    def over(batches):
        at, held = None, []

        def finish():
            size, part, h = (np.array([u[i] for u in held]) for i in (3, 5, 6))
            part = fly(size, part, int(h.view(np.uint64).sum()) & ((1 << 63) - 1), min(LANDING, len(part) // 4) if last else 0)
            part = land(size, part, held[0][7]) if last else part
            return [(*u[:5], float(p), *u[6:]) for u, p in zip(held, part, strict=True)]

        table = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], _NAMES)
        for batch in batches:
            rows = []
            for unit in zip(*(batch.column(i).to_pylist() for i in range(len(_KINDS))), strict=True):
                if unit[:2] != at:
                    rows += finish() if held else []
                    at, held = unit[:2], []
                held.append(unit)
            yield table(rows)
        yield table(finish() if held else [])

    return over


def _level(units: DataFrame, last: bool) -> DataFrame:
    dealt = units.select(*_NAMES).repartition("source_no", "block")
    return dealt.sortWithinPartitions("source_no", "block", F.col("size").desc(), "h", "doc_id").mapInArrow(_flown(last), _UNIT)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    words = F.array_remove(F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " "), " "), "")
    size = F.size(words).cast("bigint")
    sized = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"))
    counted = materialize(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times")))
    targets = materialize(source_targets(counted, weights, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = counted.join(targets, counted["source"].eqNullSafe(targets["source"])).drop("source")
    many = F.lit(REPEATS).cast("bigint")
    each = joined.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / REPEATS))))
    each = each.withColumn("time", F.explode(F.sequence(F.col("part") * many, F.least((F.col("part") + 1) * many, F.col("times")) - 1))).drop("part")
    copies = F.floor(rate + _EPS)
    part = rate - copies
    h = F.xxhash64(F.lit(20240611), "doc_id", "size", "time")
    block = F.pmod(F.xxhash64("doc_id", "size", "time"), F.ceil(F.col("n_docs") / BLOCK_DOCS).cast("bigint"))
    units = each.select("source_no", block.alias("block"), "doc_id", "size", copies.cast("bigint").alias("copies"), F.when(part < _EPS, 0.0).when(part > 1 - _EPS, 1.0).otherwise(part).alias("part"), h.alias("h"), (F.col("source_size") / F.col("n_docs")).alias("mean"))
    whole = F.col("part").isin(0.0, 1.0)
    taken, flying = units.where(whole), units.where(~whole)
    blocks = -(-(targets.agg(F.max("n_docs")).first()[0] or 0) // BLOCK_DOCS)
    while True:
        last = blocks <= 1
        flown = materialize(_level(flying, last))
        taken, flying = taken.unionByName(flown.where(whole)), flown.where(~whole).withColumn("block", F.floor(F.col("block") / BLOCK_LEFT))
        if last:
            break
        blocks = -(-blocks // BLOCK_LEFT)
    placed = taken.withColumn("copies", F.col("copies") + F.col("part").cast("bigint")).join(targets, "source_no")
    return placed.select(F.col("doc_id").alias(doc_id), F.col("source").alias(source), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
