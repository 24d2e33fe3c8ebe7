import itertools
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import awkward_rows
from skyledger.llm import sharding
from skyledger.llm.sharding import differencing, shard_by_bytes


def sums(sizes, shards, k):
    out = [0] * k
    for size, shard in zip(sizes, shards, strict=True):
        out[shard] += size
    return out


def by_the_book(sizes, k):
    """Karmarkar-Karp with a plain sorted list."""
    parts = [([0] * (k - 1) + [s]) for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b, *rest = parts
        parts = [*rest, sorted(x + y for x, y in zip(a, reversed(b), strict=True))]
    return parts[0][-1] - parts[0][0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=40, unique=True), st.integers(2, 8))
def test_balance(sizes, k):
    found = sums(sorted(sizes, reverse=True), differencing(sorted(sizes, reverse=True), k), k)
    assert sum(found) == sum(sizes)
    assert max(found) - min(found) <= max(sizes)


@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=30, unique=True), st.integers(2, 5))
def test_like_a_plain_sorted_list(sizes, k):
    items = sorted(sizes, reverse=True)
    found = sums(items, differencing(items, k), k)
    assert max(found) - min(found) == by_the_book(items, k)


def test_known_example():
    assert sorted(sums([8, 7, 6, 5, 4], differencing([8, 7, 6, 5, 4], 2), 2)) == [14, 16]


@given(st.lists(st.integers(1, 60), min_size=1, max_size=7))
def test_two_way_difference_is_the_classic_one(sizes):
    items = sorted(sizes, reverse=True)
    left = list(items)
    while len(left) > 1:
        left.sort(reverse=True)
        left = [left[0] - left[1], *left[2:]]
    a, b = sums(items, differencing(items, 2), 2)
    assert abs(a - b) == left[0]
    best = min(abs(sum(items) - 2 * sum(c)) for n in range(len(items) + 1) for c in itertools.combinations(items, n))
    assert abs(a - b) >= best


def check(rows, found, shards=8):
    expected = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in found) == expected
    slots, groups = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for (_, size), v in groups.items() if size > 1)


def test_prose(some_prose):
    found = shard_by_bytes(some_prose).collect()
    check([(r.doc_id, r.text) for r in some_prose.collect()], found)
    totals = defaultdict(int)
    for r in found:
        totals[r.shard] += r.size
    assert max(totals.values()) - min(totals.values()) <= 16


def test_awkward(awkward):
    check([r[:2] for r in awkward_rows()], shard_by_bytes(awkward).collect())


def test_small_groups_share_units(spark, monkeypatch):
    monkeypatch.setattr(sharding, "UNITS", 8)
    rows = [(i, "x" * (i % 50)) for i in range(500)] + [(i, "hot" * 40) for i in range(1000, 1400)]
    found = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), shards=3).collect()
    check(rows, found, 3)


@pytest.mark.parametrize("shards", [1, 8])
def test_nothing(nothing, shards):
    assert shard_by_bytes(nothing, shards).collect() == []
