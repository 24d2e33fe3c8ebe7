import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import awkward_rows
from skyledger.llm.packing import best_fit_runs, pack_documents, sequences
from skyledger.llm.tokens import Encoder, tokenizer_path


def one_by_one(lengths, capacity):
    """Best fit decreasing, piece by piece; the fill of each bin."""
    rooms: list[int] = []  # sorted remaining capacities
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    return Counter(capacity - r for r in rooms)


def placed(counts, capacity):
    """Bins filled by the runs, each piece checked to follow the one before it."""
    runs = sorted(best_fit_runs(counts, capacity))
    bins = defaultdict(list)
    for n, (length, item, per_bin, first, offset) in enumerate(runs):
        stop = runs[n + 1][1] if n + 1 < len(runs) and runs[n + 1][0] == length else counts[length]
        for j in range(stop - item):
            bins[first + j // per_bin].append((offset + j % per_bin * length, length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return Counter(sum(length for _, length in p) for p in bins.values())


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 64).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=200))))
def test_runs_are_best_fit_decreasing(case):
    capacity, lengths = case
    assert placed(Counter(lengths), capacity) == one_by_one(lengths, capacity)


def test_many_pieces_few_runs():
    counts = {n: 10_000_000 + n for n in range(1, 2049)}
    runs = best_fit_runs(counts, 2048)
    assert len(runs) < 50_000


def test_large_counts_are_best_fit_decreasing():
    lengths = np.random.default_rng(3).integers(1, 2049, 30_000).tolist()
    assert placed(Counter(lengths), 2048) == one_by_one(lengths, 2048)


def check(rows, packed, capacity):
    encode = Encoder.of(tokenizer_path("byte_bpe_50k.json"))
    expected = Counter()
    for doc_id, text in rows:
        ids = np.frombuffer(encode([text])[0] + bytes(4), "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if first < len(ids) else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            expected[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in packed) == expected
    by = defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
    fills = Counter(sum(n for _, n in p) for p in by.values())
    assert fills == one_by_one([n for p in by.values() for _, n in p], capacity)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_awkward(awkward, capacity):
    check([r[:2] for r in awkward_rows()], pack_documents(awkward, capacity=capacity).collect(), capacity)


def test_prose(some_prose):
    check([(r.doc_id, r.text) for r in some_prose.collect()], pack_documents(some_prose.repartition(9), capacity=256).collect(), 256)


def test_sequences_hold_the_pieces(some_prose):
    packed = pack_documents(some_prose, capacity=256, with_ids=True)
    rows = packed.collect()
    found = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    assert sum(map(len, found.values())) == sum(r.length for r in rows)
    for r in rows:
        assert found[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_nothing(nothing):
    assert pack_documents(nothing).collect() == []
