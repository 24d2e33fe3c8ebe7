import re
from collections import Counter

import numpy as np
import pytest

from conftest import awkward_rows, prose
from skyledger.llm.decision_list import STATISTICS, keep_good, learn_list, quality_verdicts, text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(lines), len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)), len(set(words)),
    )


ODD = ["a a a a a", "a b c a b c\na b c a b c\n\n  \na b c a b c", "x\x0by\x0cz\r\nx\x0by\x0cz", "é| é| é| É!?", "　a　", "#" * 70]


def test_statistics(spark, awkward):
    rows = [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(tuple(r) for r in text_statistics(docs).collect())
    assert found == Counter((i, *brute_force(t)) for i, t in rows)
    assert text_statistics(awkward).columns == ["doc_id", *STATISTICS]


def marked(text):
    return " ".join(w + "***" for w in text.split(" "))


@pytest.fixture(scope="module")
def corpus(spark):
    """Good prose and prose with marks, a few labels turned round."""
    rows = [(i, marked(prose(i, 90 + i % 40)) if i % 3 == 0 else prose(i, 90 + i % 40)) for i in range(600)]
    labels = [(i, int(i % 3 != 0) ^ int(i % 41 == 0), 0) for i in range(600) if i % 5]
    return rows, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_verdicts(corpus):
    rows, docs, labels = corpus
    found = {r.doc_id: r for r in quality_verdicts(docs, labels).collect()}
    for i, text in rows:
        stats = brute_force(text)
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert tuple(found[i])[1:7] == (*stats[:5], failed)
        assert found[i].kept == (not failed and i % 3 != 0)


def test_kept_rows(corpus):
    _, docs, labels = corpus
    kept = {r.doc_id for r in quality_verdicts(docs, labels).collect() if r.kept}
    out = keep_good(docs.selectExpr("*", "'x' AS row", "1 AS n_words"), labels)
    assert out.columns == ["doc_id", "text", "row", "n_words"]
    assert {r.doc_id for r in out.collect()} == kept


def test_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 0, 0), (5, 1, 1), (5, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality_verdicts(awkward, labels).collect()
    assert len(found) == len(awkward_rows())
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)
    assert all(not r.kept for r in found if r.base_failed)
    assert quality_verdicts(nothing, labels).collect() == []
    assert keep_good(nothing, labels).collect() == []
    bare = quality_verdicts(awkward, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in bare)


def test_rules_are_ordered_conjunctions():
    random = np.random.default_rng(0)
    x = {"a": random.random(3000), "b": random.random(3000)}
    bad = ((x["a"] > 0.7) & (x["b"] <= 0.4)) | (x["a"] < 0.1)
    rules = learn_list(x, bad)
    found = np.zeros(3000, dtype=bool)
    for rule in rules:
        hold = np.ones(3000, dtype=bool)
        for test in rule:
            hold &= test.holds(x)
        found |= hold
    assert (found == bad).mean() > 0.97 and max(map(len, rules)) >= 2


def test_noise_gives_no_rules():
    random = np.random.default_rng(1)
    x = {"a": random.random(2000), "b": random.random(2000)}
    assert learn_list(x, random.random(2000) < 0.05) == []
    assert learn_list(x, np.zeros(2000, dtype=bool)) == [] == learn_list(x, np.ones(2000, dtype=bool))
