"""SimHash and ball hashing against plain loops."""

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from skyweave.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    k = min(4, len(words))
    hashes = [xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)] if words else []
    return sum((2 * sum(h >> i & 1 for h in hashes) > len(hashes)) << i for i in range(64))


def _least(links, nodes):
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def test_documents_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    odd = [None, "", " \n\t", "one", "One two three", "É Ü x y z Z", "word " * 3000, "z" * 70000, "a b c d", "A\tb\x0bc  d"]
    rows += [(1000 + i, t) for i, t in enumerate(odd)] + [(1000, "never seen before by any other text here"), (1001, None), (7, rows[7][1])]
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    rows += [(2000 + i, " ".join(base[: 380 + rng.randint(0, 20)])) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, component_id int").repartition(3)
    prints = [_fingerprint(t) for _, t in rows]
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    least = _least(links, {i for i, _ in rows})
    want = sorted((i, f"{p:016x}", least[i]) for (i, _), p in zip(rows, prints, strict=True))
    assert len({least[2000 + i] for i in range(60)}) < 30
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == want


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "A B C D E"), (None, "quite another text than that"), (3, None), (None, "")], "doc_id long, text string")
    found = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=repr) == sorted([(None, 5), (5, 5), (None, None), (3, 3), (None, 3)], key=repr)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize(("distance", "variants"), [(4, 1 << 21), (4, 5000), (4, 40), (2, 300), (0, 100)])
def test_ball_links_against_all_pairs(spark, monkeypatch, distance, variants):
    """Small cells are cut until they are single variants."""
    monkeypatch.setattr(simhash, "CELL_VARIANTS", variants)
    rng = random.Random(distance)
    points = {rng.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1, 1 << 63}
    for f in sorted(points):
        for _ in range(3):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
            points.add(f)
    points |= {points_ball ^ (1 << i) for points_ball in (12345,) for i in range(40)}
    points = sorted(points)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in points], "f long")
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.ball_links(frame, distance).collect()]
    want = [(a, b) for a in points for b in points if a < b and (a ^ b).bit_count() <= distance]
    assert _least(found, points) == _least(want, points)


def test_bits_of_long_texts():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**64, 200_001, dtype=np.uint64)
    want = sum(int(2 * int((hashes >> np.uint64(i) & np.uint64(1)).sum()) > len(hashes)) << i for i in range(64))
    assert simhash.simhash(hashes) == want
