"""The field of the personal-data operator: its weights decide, and its messages find the best labels."""

import itertools
import json
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from skyweave.llm import pii


@pytest.fixture(scope="module")
def weights():
    texts = pa.array(pq.read_table("/root/testdata/sf0.1/documents.parquet")["text"].to_pylist()[:3000], pa.string())
    return pii.fit([json.loads(g) for g in pii._graphs(texts).to_pylist() if g])


def _found(text, weights):
    return [(k, text[a:b]) for k, a, b in pii.find_spans(text, weights)[1]]


def test_skip_weights_are_learned(weights):
    skip = weights["skip"]
    assert np.allclose(skip, skip.T) and all(skip[k, k] > max(np.delete(skip[k], k)) + 1 for k in range(1, 5))
    assert np.abs(skip).max() < 20


def test_weights_decide(weights):
    """Without weights, or with those of another draw, other spans are added."""
    text = "tel +1 (487) 555-7209, again 14875557209 or 487.555.7209; j.doe@host and j.doe@host.com, 2019-01-02"
    zero = {k: np.zeros((5, 5)) for k in ("evidence", "chain", "skip")} | {"word": {}}
    assert _found(text, weights) == [("phone", "+1 (487) 555-7209"), ("phone", "14875557209"), ("phone", "487.555.7209"), ("email", "j.doe@host"), ("email", "j.doe@host.com")]
    assert [s for s in _found(text, zero)] == [("phone", "+1 (487) 555-7209"), ("email", "j.doe@host.com")]
    apart = weights | {"skip": np.zeros((5, 5)), "known": {}}
    assert _found(text, apart) == _found(text, zero)


@pytest.mark.parametrize(("text", "want"), [
    ("call 487-555-7209 or else 487-555-7209 now", 2), ("call 487-555-7209 now", 0), ("on 2024-05-17 and on 2024-05-17", 0), ("1,000,000 and 1,000,000, at 12:30 and 12:30", 0), ("see j.doe@host", 0),
])
def test_labels_without_a_base_span(weights, text, want):
    base, spans = pii.find_spans(text, weights)
    assert base == [] and len(spans) == want


def test_messages_equal_exhaustive_search():
    """On forests always, and on small graphs with cycles in nearly all cases."""
    rng = np.random.default_rng(4)
    exact = {"forest": 0, "graph": 0}
    for turn in range(120):
        kind = ("forest", "graph")[turn % 2]
        n = int(rng.integers(2, 6))
        unary = rng.normal(0, 1.5, (n, 5))
        pairs = [(int(rng.integers(0, i)), i) for i in range(1, n)] if kind == "forest" else [e for e in itertools.combinations(range(n), 2) if rng.random() < 0.6]
        chain = [e for e in pairs if rng.random() < 0.5]
        skip = [e for e in pairs if e not in chain]
        tables = {"chain": rng.normal(0, 1, (5, 5)), "skip": (lambda x: (x + x.T) / 2)(rng.normal(0, 1, (5, 5)))}

        def points(labels):
            own = sum(unary[i, k] for i, k in enumerate(labels))
            return own + sum(tables[name][labels[i], labels[j]] for name, edges in (("chain", chain), ("skip", skip)) for i, j in edges)

        best = max(map(points, itertools.product(range(5), repeat=n)))
        exact[kind] += points(pii._decode(unary, chain, skip, tables)) > best - 1e-9
    assert exact["forest"] == 60 and exact["graph"] >= 54


def test_given_labels_only_add_to_a_nodes_points(weights):
    """decide() equals messages over the whole graph with the spans' labels fixed, by exhaustive search over the free nodes."""
    rng = random.Random(3)
    words = ["+1 487 555 7209", "14875557209", "487-555-7209", "x@y", "a@b.com", "a@b", "2019"]
    for _ in range(40):
        some = [rng.choice(words) for _ in range(6)]
        labels = np.array([{"+1 487 555 7209": 4, "a@b.com": 1}.get(w, 0) for w in some])
        edges = [(i, j) for j in range(6) for i in range(j) if rng.random() < 0.3 and (j == i + 1 or labels[i] or labels[j])]
        chain, skip = [e for e in edges if e[1] == e[0] + 1], [e for e in edges if e[1] != e[0] + 1]
        unary = pii._unary(some, weights)

        def points(found):
            own = sum(unary[i, k] for i, k in enumerate(found) if not labels[i])
            return own + sum(weights[name][found[i], found[j]] for name, e in (("chain", chain), ("skip", skip)) for i, j in e)

        choices = [[k] if k else range(5) for k in labels]
        best = max(map(points, itertools.product(*choices)))
        assert points(pii.decide(some, labels, chain, skip, weights)) > best - 1e-9


def test_clean_documents_are_left_alone(weights):
    """Spans added to 10,000 documents: few, and only where numbers repeat."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet")["text"].to_pylist()
    added = 0
    for t in texts:
        base, spans = pii.find_spans(t or "", weights)
        assert set(base) <= set(spans)
        added += len(spans) - len(base)
    assert added <= 20
