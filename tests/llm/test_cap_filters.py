from collections import Counter

import numpy as np
import pytest

from skyledger.llm import cap_filters as module
from skyledger.llm.cap_filters import decode, near_duplicate_vectors, product_code

SCHEMA = "vec_id long, embedding array<float>, label string, uid string, n_links string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "a", "b", "c") for i, v in rows], SCHEMA)


def fine(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(np.float32(x) != 0 for x in v)


def brute_force(rows, cosine=0.9):
    n = len(rows)
    vectors = [np.array(v, dtype=np.float32).astype(float) if fine(v) else None for _, v in rows]
    linked = [[False] * n for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b):
                linked[i][j] = linked[j][i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in (j for j, x in enumerate(linked[todo.pop()]) if x and j not in seen):
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], sum(linked[i]), least, rows[i][0] == least))
    return Counter(out)


def clusters(seed, n, dims, spread):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((max(1, n // 12), dims))
    x = centres[random.integers(0, len(centres), n)] / np.sqrt(dims) * np.linalg.norm(centres[0])
    noise = random.standard_normal((n, dims)) * np.linalg.norm(x, axis=1, keepdims=True) / np.sqrt(dims)
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x + noise * spread * random.random((n, 1)))]


@pytest.mark.parametrize("dims, spread, tile", [(64, 0.6, 4096), (64, 0.4, 8), (33, 0.5, 4096)])
def test_like_brute_force(spark, monkeypatch, dims, spread, tile):
    monkeypatch.setattr(module, "TILE", tile)
    monkeypatch.setattr(module, "COUNT_TILE", tile)
    rows = clusters(dims, 300, dims, spread)
    expected = brute_force(rows)
    assert sum(r[1] for r in expected) > 300
    assert Counter(tuple(r) for r in near_duplicate_vectors(frame(spark, rows).repartition(3)).collect()) == expected


def test_awkward(spark):
    v = np.random.default_rng(1).standard_normal(64)
    near = v + 0.01
    rows = [
        (1, v), (2, v), (3, 2 * v), (4, near), (5, -v), (None, v), (None, None), (7, None), (8, []), (9, np.zeros(64)),
        (10, [None, *v[1:]]), (11, [float("nan"), *v[1:]]), (12, [float("inf"), *v[1:]]), (13, v[:10]), (14, v[:10]),
        (15, [1e30] * 64), (16, [1e-30] * 64), (17, [3.0]), (18, [4.0]), (19, [-4.0]), (20, v[::-1]), (20, v[::-1]),
    ]
    found = Counter(tuple(r) for r in near_duplicate_vectors(frame(spark, [(i, None if x is None else list(x)) for i, x in rows])).collect())
    expected = brute_force(rows)
    assert Counter({(i, n, c): k for (i, n, c, _), k in found.items()}) == Counter({(i, n, c): k for (i, n, c, _), k in expected.items()})
    assert all(kept == (i == c) for i, _, c, kept in found)


def test_recall_at_the_threshold():
    """Of pairs with cosine 0.9 exactly, hardly any share no filter."""
    random = np.random.default_rng(5)
    x = random.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = random.standard_normal(x.shape)
    other -= (other * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * other / np.linalg.norm(other, axis=1, keepdims=True)
    options = (1024, 3, 3.6, 7)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(decode(x, *options), decode(y, *options), strict=True)]
    assert np.mean(met) >= 0.999


@pytest.mark.parametrize("dims, vectors", [(8, 50_000), (64, 50_000), (768, 50_000), (8, 2_000_000), (64, 2_000_000), (768, 2_000_000)])
def test_recall_in_other_dimensions_and_larger_tables(dims, vectors):
    """Pairs with cosine 0.9 share a filter also in short and long vectors and among the narrower filters of a larger table."""
    random = np.random.default_rng(dims)
    x = random.standard_normal((400, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = random.standard_normal(x.shape)
    other -= (other * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * other / np.linalg.norm(other, axis=1, keepdims=True)
    words, height = module.filters_for(vectors, 0.9, dims)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(decode(x, words, 3, height, 7), decode(y, words, 3, height, 7), strict=True)]
    assert np.mean(met) >= 0.99


def test_comparisons_a_vector_do_not_grow_with_the_table():
    """Expected pairs for random vectors: the filters of one vector, each times what a filter holds of all the others."""
    random = np.random.default_rng(11)
    x = random.standard_normal((200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    compared = {}
    for vectors in (2_000, 50_000, 400_000, 3_200_000):
        words, height = module.filters_for(vectors, 0.9, 64)
        passed = np.mean([len(f) for f in decode(x, words, 3, height, 7)])
        compared[vectors] = passed * vectors * passed / (3 * words**2)
    assert compared[2_000] < compared[50_000] < 2000
    assert compared[3_200_000] < 1.5 * compared[50_000] and compared[400_000] < 1.5 * compared[50_000]


def test_unusable_vectors_do_not_meet_in_one_task(spark):
    rows = spark.range(4000).selectExpr("id vec_id", "cast(null as array<float>) embedding", "'a' label", "'b' uid", "'c' n_links")
    found = near_duplicate_vectors(rows.repartition(8))
    assert found.rdd.glom().map(len).collect().count(4000) == 0 and found.where("kept AND n_links = 0").count() == 4000


def test_decode_lists_exactly_the_filters_above_the_threshold():
    x = np.random.default_rng(2).standard_normal((5, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for row, found in zip(x, decode(x, 40, 2, 2.0, 7), strict=True):
        expected = set()
        for r, (turn, first, second) in enumerate(product_code(16, 40, 2, 7)):
            for p in range(40):
                for q in range(40):
                    if row @ turn @ np.concatenate([first[p], second[q]]) >= 0.5:
                        expected.add(((16 * 2 + r) * 40 + p) * 40 + q)
        assert set(found.tolist()) == expected and len(found) == len(expected)


def test_nothing(spark):
    assert near_duplicate_vectors(frame(spark, [])).collect() == []
