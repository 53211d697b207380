"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

A fingerprint has a bit for each bit of XXH64 (seed 42): set where more than half of the text's shingles set it. Two fingerprints within
the distance meet in a variant that is within half of it of both, so every distinct fingerprint stands for all its variants of up to
two flipped bits (2,081 for 64 bits), and those that share a variant are linked.

The shuffle is on the variants' leading bits, a cell: a fingerprint is sent once to each cell that a variant of it falls into, and the
variants of a cell are written out only in the task that compares them. A cell of too many variants is cut by further leading bits, level by
level, so that no task holds a hot group of near copies; a cell of all 64 bits is a single variant, which at most 2,081 fingerprints have.
Fingerprints that share a variant are chained, not paired with one another, and each cell returns a forest.

Null or empty text, or text without words: fingerprint zero, linked like any other. Fewer words than a shingle: the whole sequence is the only
shingle. Null doc_id: a row of its own, whose component_id is the least doc_id it reaches, or null. Rows that repeat a doc_id are one
document: their texts' links add up, and each row is returned. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.common import materialize
from skyweave.llm.minhash import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Variants that one cell may hold; 60 bytes each while they are compared.
CELL_VARIANTS = 1 << 21
#: Leading bits by which a cell of too many variants is cut further.
CUT_BITS = 8
#: Shingles whose bits are counted at once, 64 bytes each.
COUNTED = 1 << 16

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of `size` lower-cased words, joined by spaces; of the whole sequence where there are fewer; none without words."""
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()  # of bytes: splits at \x20 and \x09-\x0D only
    if not words:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(words), max(len(words) - size + 1, 1)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    return np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[len(words) - n :], strict=True)), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """The fingerprint of a text's shingle hashes, unsigned."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNTED):
        bits = np.unpackbits(hashes[i : i + COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(text: pa.Array, size: int) -> pa.Array:
    found = [simhash(shingle_hashes(t.as_py() or b"", size)) for t in text.cast(pa.large_binary())]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The 64-bit fingerprint of each text, as a long of the same bits."""
    return F.arrow_udf(lambda t: _fingerprints(t, size), "bigint")(text)


def _flips(low: int, width: int, most: int) -> list[int]:
    """Masks of up to `most` (2 at most) of the bits low, low + 1, ..; fewer flips come first."""
    one = [1 << (low + i) for i in range(width)]
    two = [one[i] | one[j] for j in range(width) for i in range(j)]
    return ([0] + one + two)[: (1, 1 + width, 1 + width + len(two))[most]]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cut(cells: DataFrame, used: int, width: int, radius: int) -> DataFrame:
    """(key, f): each fingerprint f of cells by `used` leading bits, in all cells of `width` more bits that its variants fall into."""
    low = 64 - used - width
    window, prefix = ((1 << width) - 1) << low, ((1 << used) - 1) << (64 - used)
    flipped = F.bit_count(F.col("f").bitwiseXOR(F.col("key")).bitwiseAND(F.lit(_long(prefix))))
    masks = [F.array(*(F.lit(_long(m)).cast("bigint") for m in _flips(low, width, left))) for left in range(radius + 1)]
    choice = masks[0]
    for left in range(1, radius + 1):
        choice = F.when(radius - flipped == left, masks[left]).otherwise(choice)
    spread = cells.select("key", "f", F.explode(choice).alias("mask"))
    return spread.select(F.col("key").bitwiseOR(F.col("f").bitwiseXOR(F.col("mask")).bitwiseAND(F.lit(_long(window)))).alias("key"), "f")


def _trees(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of n nodes reaches by the edges a - b."""
    top = np.arange(n)
    while True:
        least = np.minimum(top[a], top[b])
        new = top.copy()
        for ends in (a, b, top[a], top[b]):
            np.minimum.at(new, ends, least)
        while (jumped := new[new]).tobytes() != new.tobytes():
            new = jumped
        if (new == top).all():
            return top
        top = new


def _meeting(used: int, radius: int, distance: int):
    """For applyInArrow over cells of `used` leading bits: a forest (a, b) of the fingerprints that share a variant there."""
    rest = 64 - used
    masks = [np.array(_flips(0, rest, left), np.uint64) for left in range(radius + 1)]
    inside, prefix = np.uint64((1 << rest) - 1), np.uint64(((1 << used) - 1) << rest)

    def links(cell: pa.Table) -> pa.Table:
        f = np.unique(cell.column("f").to_numpy().view(np.uint64))
        key = cell.column("key").to_numpy().view(np.uint64)[:1]
        left = radius - np.bitwise_count((f ^ key) & prefix)
        who = [np.flatnonzero(left == r) for r in range(radius + 1)]
        variants = np.concatenate([((f[w] & inside)[:, None] ^ masks[r]).ravel() for r, w in enumerate(who)])
        owner = np.concatenate([np.repeat(w, len(masks[r])) for r, w in enumerate(who)])
        ordered = np.sort(variants)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        a = b = np.zeros(0, np.int64)
        if len(twice):
            met = np.flatnonzero(np.isin(variants, twice))
            met = met[np.argsort(variants[met], kind="stable")]
            same = variants[met[1:]] == variants[met[:-1]]
            a, b = owner[met[:-1][same]], owner[met[1:][same]]
            near = np.bitwise_count(f[a] ^ f[b]) <= distance
            a, b = a[near], b[near]
        top = _trees(len(f), a, b)
        moved = np.flatnonzero(top != np.arange(len(f)))
        return pa.table({"a": f[moved].view(np.int64), "b": f[top[moved]].view(np.int64)})

    return links


def ball_links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that join all fingerprints (column f, distinct) that differ in `distance` (4 or fewer, even) bits at most."""
    radius = distance // 2
    if distance not in (0, 2, 4):
        raise ValueError("the distance has to be 0, 2 or 4")
    variants = F.lit(1)
    n = points.count()
    used = min(40, max(0, math.ceil(math.log2(max(1, 8 * n * len(_flips(0, 64, radius)) / CELL_VARIANTS)))))
    cells, links = _cut(points.select(F.lit(0).cast("bigint").alias("key"), "f"), 0, used, radius), None
    while True:
        cells = materialize(cells)
        prefix = _long(((1 << used) - 1) << (64 - used))
        left = radius - F.bit_count(F.col("f").bitwiseXOR(F.col("key")).bitwiseAND(F.lit(prefix)))
        variants = F.lit(1)
        for r in range(1, radius + 1):
            variants = F.when(left == r, len(_flips(0, 64 - used, r))).otherwise(variants)
        large = materialize(cells.groupBy("key").agg(F.sum(variants).alias("n")).where(F.col("n") > CELL_VARIANTS).select("key")) if used < 64 else None
        done = large is None or large.isEmpty()
        small = cells if done else cells.join(large, "key", "left_anti")
        found = small.groupBy("key").applyInArrow(_meeting(used, radius, distance), "a bigint, b bigint")
        links = found if links is None else links.unionByName(found)
        if done:
            return links
        width = min(CUT_BITS, 64 - used)
        cells, used = _cut(cells.join(large, "key", "left_semi"), used, width, radius), used + width


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    signed = materialize(docs.select(F.col(doc_id).cast("bigint").alias("id"), fingerprint(F.col(text), size).alias("f")))
    points = materialize(signed.groupBy("f").agg(F.min("id").alias("least")))
    repeated = signed.where("id is not null").groupBy("id").agg(F.min("f").alias("b"), F.max("f").alias("m")).where("b <> m")
    together = signed.join(repeated, "id").where("f <> b").select(F.col("f").alias("a"), "b")
    stars = components(ball_links(points.select("f"), distance).unionByName(together))
    part = points.join(stars.withColumnRenamed("node", "f"), "f", "left").select("f", "least", F.coalesce("component", "f").alias("part"))
    least = part.groupBy("part").agg(F.min("least").alias("component_id"))
    named = part.join(least, "part").select("f", "component_id")
    return signed.join(named, "f").select(F.col("id").alias(doc_id), F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")
