import hashlib
import re
from collections import Counter, defaultdict

import pytest

from conftest import awkward_rows
from skyledger.llm.mixing import mix_sources, mixed_documents, source_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, weights=(3, 1, 2), share=1.5, epochs=2.0, seed=1):
    """``rows`` of (doc_id, text, source) -> sorted (doc_id, size, source_size, target, taken)."""
    by = defaultdict(list)
    for doc_id, text, source in rows:
        raw = f"{seed}:{'' if doc_id is None else doc_id}:{text or ''}"
        by[source].append((hashlib.md5(raw.encode()).hexdigest()[:15], doc_id, len(WORD.findall(text or ""))))
    sizes = {s: sum(d[2] for d in docs) for s, docs in by.items()}
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(epochs * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and left * weight[s] / total >= epochs * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: epochs * sizes[s] if s in full else left * weight[s] / total for s in order}
    out = []
    for s, docs in by.items():
        goal, before = int(target[s] + 0.5), 0
        whole, rest = divmod(goal, sizes[s]) if sizes[s] else (0, 0)
        for _, doc_id, size in sorted(docs, key=lambda d: (d[0], d[1] is not None, d[1] or 0)):
            out.append((doc_id, size, sizes[s], target[s], whole * size + max(0, min(size, rest - before))))
            before += size
    return out


def compare(found, expected):
    key = lambda r: tuple((v is not None, v) for v in r)
    found, expected = sorted((tuple(r) for r in found), key=key), sorted(expected, key=key)
    assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected])


def test_like_brute_force(some_prose):
    rows = [(r.doc_id, r.text, r.source) for r in some_prose.collect()]
    found = mix_sources(some_prose).collect()
    compare(found, brute_force(rows))
    by = defaultdict(lambda: [0, 0])
    source = {r[0]: r[2] for r in rows}
    for r in found:
        by[source[r.doc_id]][0] += r.taken
        by[source[r.doc_id]][1] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken - target) <= 0.5 for taken, target in by.values())


@pytest.mark.parametrize("options", [{"share": 2.0}, {"share": 0.2, "weights": (1,)}, {"epochs": 3.0, "share": 2.9}])
def test_options(some_prose, options):
    rows = [(r.doc_id, r.text, r.source) for r in some_prose.collect()]
    compare(mix_sources(some_prose, **options).collect(), brute_force(rows, **options))


def test_awkward(awkward):
    compare(mix_sources(awkward).collect(), brute_force([(r[0], r[1], r[3]) for r in awkward_rows()]))


def test_nothing(nothing):
    assert mix_sources(nothing).collect() == []
    assert mixed_documents(nothing).collect() == []


def test_all_texts_empty(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert sorted(map(tuple, mix_sources(docs).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_hot_source(spark):
    rows = [(i, f"w{i} " * (i % 7), "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(13)
    compare(mix_sources(docs).collect(), brute_force(rows))


def test_more_sources_than_weights_and_order(spark):
    sources = spark.createDataFrame([("b", 10), ("a", 1), (None, 5), ("é", 8), ("z", 100)], "source string, source_size long")
    found = {r.source: (r.sid, r.target) for r in source_targets(sources).collect()}
    assert {s: v[0] for s, v in found.items()} == {"a": 0, "b": 1, "z": 2, "é": 3, None: 4}
    assert sum(v[1] for v in found.values()) == pytest.approx(1.5 * 124)


def test_documents_of_the_mix(awkward):
    taken = Counter()
    for r in mix_sources(awkward).collect():
        taken[r.doc_id] += r.taken
    out = mixed_documents(awkward)
    assert out.columns == awkward.columns
    words, whole = Counter(), {r[0]: r for r in awkward_rows() if r[1]}
    for r in out.collect():
        assert whole[r.doc_id][1].startswith(r.text) and tuple(r)[5:] == whole[r.doc_id][5:]
        assert r.n_chars == (whole[r.doc_id][4] if r.text == whole[r.doc_id][1] else len(r.text))
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == +taken
