import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

import skyledger.llm.vector_codes as vector_codes
from skyledger.llm.common import with_key_total

SCHEMA = "vec_id long, embedding array<double>, label string, x string, salt string, position int, codes string, error string, _key string"
CLASH = ("x", "s", 1, "c", "e", "k")


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Lloyd part by part in Python integers. ``rows`` are (vec_id, vector, label)."""
    sound = [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])]
    length = max((len(r[1]) for r in sound), default=0)
    kept = [(i, [math.floor(v * scale) for v in x], label) for i, x, label in sound if len(x) == length]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    at = [p * length // parts for p in range(parts + 1)]
    books = [[x[a:b] for _, x, _ in kept[:entries]] for a, b in zip(at, at[1:])]

    def assign(p, x):
        return min((sum((u - v) ** 2 for u, v in zip(x[at[p] : at[p + 1]], c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x, _ in kept:
            for p in range(parts):
                members[p, assign(p, x)[1]].append(x[at[p] : at[p + 1]])
        for (p, e), own in members.items():
            books[p][e] = [sum(v) // len(own) for v in zip(*own)]
    coded = [[assign(p, x) for p in range(parts)] for _, x, _ in kept]
    totals = Counter()
    for (_, _, label), found in zip(kept, coded):
        totals[label] += sum(d for d, _ in found)
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    return Counter(
        (i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), totals[label], digest) for (i, _, label), found in zip(kept, coded)
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


def found(spark, rows):
    return Counter(tuple(r) for r in vector_codes.vector_code_digests(frame(spark, rows).repartition(5)).collect())


@pytest.mark.parametrize("length, owned", [(16, 4096), (13, 20), (3, 7)])
def test_against_plain_rounds(spark, monkeypatch, length, owned):
    """Clustered vectors of which a third are one vector, with lengths that eight doesn't divide and several salts."""
    monkeypatch.setattr(vector_codes, "OWNED", owned)
    r = np.random.default_rng(length)
    centres = r.normal(size=(9, length)).round(3)
    rows = [(i, (centres[i % 9] + r.normal(scale=0.2, size=length)).tolist(), f"l{i % 4}") for i in range(160)]
    rows += [(1000 + i, centres[0].tolist(), None) for i in range(80)]
    assert found(spark, rows) == plain(rows)


def test_awkward(spark):
    nan, inf = math.nan, math.inf
    good = [(7 - i, [float(i), -0.5 * i, 0.25, 1e-5, -1e-5, 3.0, float(i % 3), 9.0], "a") for i in range(6)]
    rows = [*good, good[2], good[2], (None, good[1][1], "b"), (None, [0.0] * 8, None), (3, [4.0] * 8, None)]
    odd = [(50, None, "a"), (51, [], "a"), (52, [None] * 8, "a"), (53, [nan] + [0.0] * 7, "a"), (54, [inf] * 8, "a"), (55, [1.0] * 7, "a")]
    assert found(spark, rows + odd) == plain(rows)
    assert found(spark, odd[:5]) == found(spark, []) == Counter()


def test_large_values_are_exact(spark):
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(size=16) * 20_000).tolist(), "a") for i in range(60)]
    assert found(spark, rows) == plain(rows)
    with pytest.raises(Exception, match="exact results don't fit"):
        found(spark, [(1, [1e30] * 8, "a")])


def test_codes_do_not_depend_on_order_and_stayers_are_not_shuffled(spark, monkeypatch):
    moved = []
    written = vector_codes._written

    def spied(df, label, *by):
        table, path = written(df, label, *by)
        moved.append((label, table.count(), "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()))
        return table, path

    monkeypatch.setattr(vector_codes, "_written", spied)
    r = np.random.default_rng(3)
    rows = [(i, x.tolist(), "a") for i, x in enumerate(r.normal(size=(300, 16)))]
    assert found(spark, rows) == found(spark, rows[::-1])
    once = moved[: len(moved) // 2]
    assert once[0] == ("members", 2400, True)
    assert [label for label, _, _ in once[1:]] == ["compared", "arrived"] * 5
    assert all(not shuffled and n == 2400 for label, n, shuffled in once if label == "compared")
    arrived = [n for label, n, shuffled in once if label == "arrived" and shuffled]
    assert len(arrived) == 5 and all(0 < n < 1200 for n in arrived) and arrived[-1] < arrived[0]


def test_key_totals(spark):
    """A hot key, a null key and many light ones."""
    rows = [("hot", 2)] * 300 + [(None, 5)] * 20 + [(f"k{i}", i) for i in range(60)] * 2
    df = spark.createDataFrame(rows, "label string, error long").repartition(4)
    expected = Counter()
    for label, error in rows:
        expected[label] += error
    got = Counter(tuple(r) for r in with_key_total(df, "label", "error", "total", most=30).collect())
    assert got == Counter((label, error, expected[label]) for label, error in rows)
