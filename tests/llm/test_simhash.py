from collections import Counter

import numpy as np
import pytest
import xxhash

from conftest import awkward_rows, prose
from skyledger.llm import simhash as module
from skyledger.llm.simhash import drop_near_duplicates, forest, near_duplicates, sliced_links


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=3):
    """(doc_id, fingerprint, component) of each row by comparing all pairs."""
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {x: min((r[0] for r, y in zip(rows, label, strict=True) if x == y and r[0] is not None), default=None) for x in label}
    return [(r[0], f"{p:016x}", least[x]) for r, p, x in zip(rows, prints, label, strict=True)]


def near_copies(seed, copies, words=120):
    """A text and copies of it with a word or two changed."""
    base = prose(seed, words).split()
    out = [" ".join(base)]
    for i in range(copies):
        changed = list(base)
        for j in range(1 + i % 2):
            changed[(7 * i + 31 * j) % len(base)] = f"new{i}"
        out.append(" ".join(changed))
    return out


@pytest.fixture(scope="module")
def families():
    return [(i, t) for i, t in enumerate(t for seed in range(8) for t in near_copies(seed, 12, 400))]


def test_awkward(awkward):
    rows = [r[:2] for r in awkward_rows()]
    assert Counter(tuple(r) for r in near_duplicates(awkward).collect()) == Counter(components(rows))


@pytest.mark.parametrize("tile", [4096, 4])
def test_near_copies(spark, families, monkeypatch, tile):
    monkeypatch.setattr(module, "TILE", tile)
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(5)
    expected = components(families)
    assert 8 <= len({c for *_, c in expected}) < len(families)
    assert Counter(tuple(r) for r in near_duplicates(docs).collect()) == Counter(expected)


@pytest.mark.parametrize("radius, blocks", [(0, 3), (1, 4), (3, 5), (7, 9)])
def test_links(radius, blocks):
    random = np.random.default_rng(radius)
    n = 700
    fp = random.integers(0, 2**64, 30, dtype=np.uint64)[random.integers(0, 30, n)]
    for _ in range(radius + 2):
        flips = np.uint64(1) << random.integers(0, 64, n).astype(np.uint64)
        fp = fp ^ np.where(random.random(n) < 0.6, flips, np.uint64(0)).astype(np.uint64)
    group = np.sort(random.integers(0, 5, n))
    start, end = np.searchsorted(group, group), np.searchsorted(group, group, side="right")
    found = {(int(a), int(b)) for x, y in sliced_links(fp, start, end, radius) for a, b in zip(x, y, strict=True)}
    assert found == {(i, j) for i in range(n) for j in range(i + 1, end[i]) if int(fp[i] ^ fp[j]).bit_count() <= radius}
    a, b = forest(fp, group, radius)
    assert len(a) <= n and all(int(x ^ y).bit_count() >= 0 for x, y in zip(a, b, strict=True))


def test_one_row_of_each_component_is_left(awkward):
    expected = components([r[:2] for r in awkward_rows()])
    out = drop_near_duplicates(awkward)
    assert out.columns == awkward.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert kept == Counter({c for *_, c in expected if c is not None} | {i for i, _, c in expected if c is None})


def test_nothing(nothing):
    assert near_duplicates(nothing).collect() == []
    assert drop_near_duplicates(nothing).collect() == []
