import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import awkward_rows
from skyledger.llm import katz as module
from skyledger.llm.katz import CUT, TAIL, Discount, katz_scores

TRAIN = "coalesce(doc_id, 0) % 4 != 0"


class Model:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs, self.contexts = Counter(), Counter(), Counter()
        for tokens in texts:
            self.words.update(tokens)
            self.pairs.update(zip([None, *tokens[:-1]], tokens, strict=True))
            self.contexts.update([None, *tokens[:-1]])
        self.total = sum(self.words.values())
        self.by_word, self.by_pair = (self.discount(c) for c in (self.words, self.pairs))
        sums = defaultdict(lambda: [0.0, 0.0])
        for (h, w), c in self.pairs.items():
            sums[h][0] += self.kept(self.by_pair, c) / self.contexts[h]
            sums[h][1] += self.word(w)
        self.weight = {h: (1 - a) / (1 - b) for h, (a, b) in sums.items()}

    @staticmethod
    def discount(counts):
        seen = Counter(counts.values())
        return Discount([seen[r] for r in range(1, CUT + 2)], len(counts), sum(counts.values()))

    @staticmethod
    def kept(discount, c):
        return c - TAIL if c > CUT else c * discount.share[c]

    def word(self, w):
        return self.kept(self.by_word, self.words[w]) / self.total if self.words[w] else self.by_word.freed

    def probability(self, h, w):
        if self.pairs[h, w]:
            return self.kept(self.by_pair, self.pairs[h, w]) / self.contexts[h]
        return self.weight.get(h, 1.0) * self.word(w)

    def score(self, tokens):
        return sum(math.log10(self.probability(h, w)) for h, w in zip([None, *tokens[:-1]], tokens, strict=True))


def tokens(text):
    return [*(text or "").encode().lower().split(), "end"]


def check(rows, found):
    learnt = [(i or 0) % 4 != 0 for i, _ in rows]
    model = Model([tokens(t) for (_, t), flag in zip(rows, learnt, strict=True) if flag])
    n, v = model.total, len(model.words)
    expected = []
    for (doc_id, text), flag in zip(rows, learnt, strict=True):
        own = tokens(text)
        base = sum(math.log10((model.words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        expected.append((doc_id, flag, len(own), sum(model.words[w] > 0 for w in own), n, base, model.score(own)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for i in (5, 6):
        assert [r[i] for r in found] == pytest.approx([r[i] for r in expected], rel=1e-9)
    return model


def test_prose(spark, some_prose):
    rows = [(r.doc_id, r.text) for r in some_prose.collect()]
    model = check(rows, katz_scores(some_prose.repartition(6), F.expr(TRAIN)).collect())
    for context in [None, *list(model.contexts)[:40], "unknown"]:
        total = sum(model.probability(context, w) for w in model.words) + model.probability(context, "unknown")
        assert total == pytest.approx(1, abs=1e-9)


def test_awkward(awkward):
    check([r[:2] for r in awkward_rows()], katz_scores(awkward, F.expr(TRAIN)).collect())


def test_small_blocks_and_parts(spark, some_prose, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 700)
    monkeypatch.setattr(module, "PART_KEYS", 300)
    check([(r.doc_id, r.text) for r in some_prose.collect()], katz_scores(some_prose, F.expr(TRAIN)).collect())


def test_held_out_text_is_likelier_than_single_words(some_prose):
    rows = [r for r in katz_scores(some_prose, F.expr(TRAIN)).collect() if not r.train]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_nothing_to_learn_from(some_prose, nothing):
    rows = katz_scores(some_prose, F.lit(False)).collect()
    assert len(rows) == 120 and all((r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in rows)
    assert katz_scores(nothing, F.expr(TRAIN)).collect() == []


@pytest.mark.parametrize("counts", [[1], [1, 1, 1], [9, 9], [1, 2, 3, 4, 5, 6, 7], [1] * 500 + [2] * 120 + [3] * 50 + [4] * 25 + [5] * 12 + [6] * 7 + [80]])
def test_discounts_free_what_they_take(counts):
    seen = Counter(counts)
    found = Discount([seen[r] for r in range(1, CUT + 2)], len(counts), sum(counts))
    kept = sum(Model.kept(found, c) for c in counts)
    assert all(0 < s < 1 for s in found.share[1:]) and found.freed > 0
    assert kept / sum(counts) + found.freed == pytest.approx(1)
