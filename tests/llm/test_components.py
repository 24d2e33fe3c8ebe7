import random

import numpy as np
import pytest

from skyledger.llm import simhash
from skyledger.llm.cap_filters import near_duplicate_vectors
from skyledger.llm.common import components

N = 2000


def expected_labels(edges):
    label = {}
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for start in sorted(near):
        todo = [] if start in label else [start]
        while todo:
            node = todo.pop()
            if node not in label:
                label[node] = start
                todo.extend(near[node])
    return label


def shuffled_chain(n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    return list(zip(ids, ids[1:]))


def worst_chain(n):
    """High and low ids in turn, so that every second node is a local minimum."""
    ids = [i // 2 if i % 2 else n + i for i in range(n)]
    return list(zip(ids, ids[1:]))


@pytest.mark.parametrize("edges", [
    [], [(3, 3), (None, 1)], [(1, 2), (2, 1), (1, 2), (2, 2)], [(i, 0) for i in range(1, 300)], [(i, 999) for i in range(300)],
    shuffled_chain(N, 1), worst_chain(300), [(i, i + 1) for i in range(300)],
    [(r.randrange(600), r.randrange(600)) for r in [random.Random(5)] for _ in range(400)],
], ids=["none", "loops", "repeated", "low hub", "high hub", "chain", "turns", "rising", "random"])
def test_like_search(spark, edges):
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert found.columns == ["node", "label"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected_labels(edges).items())


def test_chain_of_fingerprints(spark):
    r = random.Random(3)
    prints = [r.getrandbits(64)]
    while len(prints) < N:
        prints.append(prints[-1] ^ sum(1 << b for b in r.sample(range(64), 3)))
    rows = spark.createDataFrame([(i, p - (1 << 64 if p >> 63 else 0)) for i, p in enumerate(prints)], "doc_id long, fp long")
    found = simhash._components(rows, 3, 5).collect()
    assert len(found) == len(set(prints)) and {r.component_id for r in found} == {0}


def test_chain_of_vectors(spark):
    random = np.random.default_rng(4)
    v = [x / np.linalg.norm(x) for x in random.standard_normal((1, 64))]
    while len(v) < N:
        x = random.standard_normal(64)
        x -= (x @ v[-1]) * v[-1]
        v.append(0.93 * v[-1] + (1 - 0.93**2) ** 0.5 * x / np.linalg.norm(x))
    ids = random.permutation(N).tolist()
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<float>")
    found = near_duplicate_vectors(rows).collect()
    assert {r.component_id for r in found} == {0} and sum(r.n_links for r in found) >= 2 * (N - 1)
