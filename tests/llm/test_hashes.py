"""Hashes of spans against plain arithmetic, and on words that collide under every polynomial modulo a power of two."""

import random

import numpy as np
import pytest

from skyweave.llm import common, decontamination, minhash, quality_rules

FLIP = str.maketrans("ab", "ba")


def _thue_morse(length):
    word = "a"
    while len(word) < length:
        word += word.translate(FLIP)
    return word


def test_span_hashes_are_a_polynomial_modulo_a_prime():
    rng, prime = random.Random(1), (1 << 61) - 1
    data = np.frombuffer(bytes(rng.choices(b"abcAB \n\xff\x00", k=3000)), np.uint8)
    starts = np.array(sorted(rng.randrange(2900) for _ in range(1000)))
    ends = starts + np.array([rng.randrange(100) for _ in starts])
    base = common._BASE % prime
    want = [sum((int(x) + 1) * pow(base, i, prime) for i, x in enumerate(data[a:b])) % prime for a, b in zip(starts, ends, strict=True)]
    assert (common.span_hashes(data, starts, ends) == common.mix(np.array(want, np.uint64))).all()
    lower = common.span_hashes(np.frombuffer(b"ABC abc", np.uint8), np.array([0, 4]), np.array([3, 7]), lower=True)
    assert lower[0] == lower[1]


@pytest.mark.parametrize("length", [1024, 4096, 65536])
def test_thue_morse_words_differ(spark, length):
    x = _thue_morse(length)
    y = x.translate(FLIP)
    docs = spark.createDataFrame([(1, x), (2, y), (3, f"{x}\n{y}"), (4, f"a {x} b a {y} b")], "doc_id long, text string")
    near = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert all(r.component_id == i and r.kept for i, r in near.items())
    rules = {r.doc_id: r for r in quality_rules.measure(docs).collect()}
    assert rules[3].n_dup_lines == 0 and rules[4].n_repeat_words == 0


def test_items_of_letters_above_the_basic_planes_are_found(spark):
    item = "".join(chr(0x30000 + i % 4000) for i in range(60))
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "nothing here")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert [r.doc_id for r in decontamination.keep_clean(docs, benchmark).collect()] == [2]
