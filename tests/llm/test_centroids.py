"""Centroid clustering against plain loops."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from skyweave.llm import centroids


def _want(rows, rounds=5, count=40):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    top = (1 << 31) - 1
    kept = [(i, [max(-top, min(top, x)) for x in e]) for i, e in kept]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), e) for i, e in kept if i is not None)
    middle = [e for _, e in first[:count]]

    def nearest(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c, strict=True)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        parts = {}
        for _, e in kept:
            parts.setdefault(nearest(e)[1], []).append(e)
        middle = [[sum(x) // len(parts[k]) for x in zip(*parts[k], strict=True)] if k in parts else c for k, c in enumerate(middle)]
    found = [(i, *nearest(e)[::-1]) for i, e in kept]
    own = {}
    for _, k, away in found:
        own[k] = own.get(k, 0) + away
    top = (1 << 63) - 1
    return sorted(((i, k, min(away, top), min(own[k], top), min(sum(own.values()), top), hashlib.sha256(",".join(map(str, middle[k])).encode()).hexdigest()) for i, k, away in found), key=repr)


def _got(spark, rows):
    frame = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, cluster string, row int").repartition(3)
    return sorted(map(tuple, centroids.cluster(frame).collect()), key=repr)


def test_clusters_against_loops(spark):
    rng = random.Random(2)
    middle = [[rng.gauss(0, 0.2) for _ in range(64)] for _ in range(12)]
    rows = [(i, [m + rng.gauss(0, 0.06) for m in rng.choice(middle)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(5, rows[9][1]), (5, rows[5][1]), (None, rows[3][1])]
    odd = [None, [], [0.5] * 63, [0.5] * 65, [0.5] * 63 + [None], [0.5] * 63 + [math.nan], [math.inf] + [0.5] * 63]
    rows += [(2000 + i, e) for i, e in enumerate(odd)]
    assert _got(spark, rows) == _want(rows)


@pytest.mark.parametrize("large", [1e4, 6e6, 1e30])
def test_large_components(spark, large):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) * (large if i % 9 == 0 else 1) for _ in range(64)]) for i in range(120)]
    assert _got(spark, rows) == _want(rows)


def test_few_vectors_and_empty_tables(spark):
    same = [(i, [0.25] * 64) for i in range(5)]
    assert _got(spark, same) == _want(same)
    assert _got(spark, [(1, [0.25] * 3), (2, None)]) == []


def test_cells_hold_their_values_and_intervals_hold_the_nearest():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 30, (3000, 64))).astype(np.int64)
    x[0] = 10**6
    stats = [(len(x), float(c.sum()), float((c.astype(float) ** 2).sum()), int(c.min()), int(c.max())) for c in x.T]
    for bits in (2, 4, 7):
        cut = centroids.grid(stats, bits)
        codes = centroids.cells(x, cut)
        d = np.arange(64)
        assert (cut.least[d, codes] <= x).all() and (x <= cut.greatest[d, codes]).all()
        assert (centroids.unpacked(pa.array(centroids.packed(codes, bits), pa.binary()), bits) == codes).all()
        tables = centroids.Tables(cut, x[1:41])
        maybe = tables.candidates(codes)
        away = ((x[:, None, :] - x[None, 1:41, :]) ** 2).sum(2)
        assert maybe[np.arange(len(x)), away.argmin(1)].all()
        k, least = tables.nearest(x, maybe)
        assert (k == away.argmin(1)).all() and (least == away.min(1)).all()
