"""Quality rules: a decision list learnt by sequential covering from labelled text statistics.

A rule is a conjunction of thresholds on statistics. Rules are grown on two thirds of the
examples, pruned on the other third, and kept while they are precise there; the examples a rule covers are
set aside before the next one is grown. The list becomes one ordered CASE expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map, hash_key
from skyledger.llm.tokens import small_batches
from skyledger.session import write_and_reread

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\v\f"
STATISTICS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_marks", "n_distinct",
]
#: What rules may test, in SQL over the statistics. Texts without words don't reach the rules.
FEATURES = {
    "words": "double(n_words)",
    "mean_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "marks_per_word": "n_marks / n_words",
    "upper_share": "n_upper / word_chars",
    "distinct_share": "n_distinct / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def repeat_words(words: list[bytes], number: dict[bytes, int]) -> int:
    """Words in windows of three that occur at least twice. ``number`` gets a number for each distinct word."""
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(words) < 4:
        return 0
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]  # so that the product below fits
    window = pair[:-1] * len(number) + ids[2:]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(window, twice)
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The values of ``STATISTICS``; a null text has no words, lines or characters."""
    text = text or ""
    data = text.encode()
    words, number = data.split(), {}
    repeats = repeat_words(words, number)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
        text.count("!") + text.count("?"),
        len(number),
    )


def text_statistics(docs: DataFrame, with_rows: bool = False) -> DataFrame:
    """``doc_id``, the ``STATISTICS`` of ``text`` as longs, and on request the whole ``row``, of each row of ``docs``."""
    wanted = docs.select("doc_id", "text", *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if with_rows else []))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = list(zip(*map(statistics, batch["text"].to_pylist()), strict=True))
            columns = [batch["doc_id"], *[pa.array(v, pa.int64()) for v in found], *([batch["row"]] if with_rows else [])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *STATISTICS, "row"][: len(columns)])

    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    schema = ", ".join([f"doc_id {kinds['doc_id']}", *[f"{s} long" for s in STATISTICS]])
    return arrow_map(wanted, measure, schema + (f", row {kinds['row']}" if with_rows else ""))


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def sql(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold!r}D"


def covers(rule: list[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    found = np.ones(n, dtype=bool)
    for test in rule:
        found &= test.holds(x)
    return found


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, near: float = 0.97) -> Test | None:
    """The test of greatest FOIL gain, of all cuts between neighbouring values of all features, both ways.

    Of the cuts that gain ``near`` as much, the one through the widest gap is taken, so that a few
    wrong labels don't move it to where the values are dense.
    """
    p0, n0 = bad.sum(), (~bad).sum()
    before = math.log2(p0 / (p0 + n0))
    found: list[tuple[float, float, Test]] = []
    for feature, values in x.items():
        order = np.argsort(values, kind="stable")
        ordered = values[order]
        cuts = np.flatnonzero(ordered[1:] > ordered[:-1]) + 1
        if not len(cuts):
            continue
        gaps = (ordered[cuts] - ordered[cuts - 1]) / (ordered[-1] - ordered[0])
        below = np.concatenate([[0], np.cumsum(bad[order])])[cuts]
        for above in (False, True):
            p = p0 - below if above else below
            covered = len(values) - cuts if above else cuts
            gain = p * (np.log2(np.maximum(p, 1) / covered) - before)
            for i in np.flatnonzero((gain >= near * gain.max()) & (gain > 1e-9)):
                at = cuts[i]
                found.append((float(gain[i]), float(gaps[i]), Test(feature, above, float((ordered[at - 1] + ordered[at]) / 2))))
    if not found:
        return None
    most = max(gain for gain, _, _ in found)
    return max((f for f in found if f[0] >= near * most), key=lambda f: f[1])[2]


def lower_bound(hits: int, n: int, z: float = 1.64) -> float:
    """Wilson's lower bound of a share."""
    if not n:
        return 0.0
    share = hits / n
    spread = z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def learn_list(
    x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.7, most_rules: int = 16
) -> list[list[Test]]:
    """Rules for ``bad`` examples, in order.

    A rule must have a lower bound of precision above ``precision`` on the examples that earlier
    rules leave; growing stops at the first that hasn't. With one class only there are no rules.
    """
    n = len(bad)
    pruning = np.arange(n) % 3 == 2
    open_rows, rules = np.ones(n, dtype=bool), []
    while len(rules) < most_rules and (open_rows & bad).any() and (open_rows & ~bad).any():
        rule: list[Test] = []
        rows = open_rows & ~pruning
        while (bad & rows).any() and (~bad & rows).any():
            test = _best_test({f: v[rows] for f, v in x.items()}, bad[rows])
            if test is None:
                break
            rule.append(test)
            rows &= test.holds(x)
        held = open_rows & pruning

        def worth(length: int, rule: list[Test] = rule, held: np.ndarray = held) -> int:
            """Examples set aside that the shortened rule decides rightly, less a constant."""
            found = covers(rule[:length], x, n) & held
            return int((found & bad).sum()) - int((found & ~bad).sum())

        lengths = range(1, len(rule) + 1)
        rule = rule[: max(lengths, key=lambda k: (worth(k), -k))] if rule else []
        found = covers(rule, x, n) & open_rows
        if not rule or lower_bound(int((found & bad).sum()), int(found.sum())) <= precision:
            break
        rules.append(rule)
        open_rows &= ~found
    return rules


def list_expression(rules: list[list[Test]]) -> Column:
    """False where the first rule that holds rejects, true where none holds."""
    if not rules:
        return F.lit(True)
    cases = " ".join(f"WHEN {' AND '.join(t.sql() for t in rule)} THEN false" for rule in rules)
    return F.expr(f"CASE {cases} ELSE true END")


def learn_quality(measured: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> list[list[Test]]:
    """Learn the list from ``measured`` (statistics by ``doc_id``) and ``labels(doc_id, quality)``.

    Fits on at most ``sample`` labelled documents, those first in hash order, that pass the base
    rules. A document labelled twice counts as bad if it is so once; null labels and ids are not used.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = measured.filter(~base_failed()).join(known, "doc_id")
    values = joined.select(
        hash_key(F.lit("quality"), F.col("doc_id")).alias("key"), "doc_id", "quality", *[F.expr(e).alias(f) for f, e in FEATURES.items()]
    )
    rows = values.orderBy("key", "doc_id", *FEATURES).limit(sample).toArrow()
    return learn_list({f: rows[f].to_numpy().astype(float) for f in FEATURES}, rows["quality"].to_numpy() == 0, **options)


def quality_verdicts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed`` and ``kept`` of each row of ``docs(doc_id, text)``.

    A null or empty text has no words, so it fails the base. Null and repeated ids are kept as
    rows; without labels of both classes nothing but the base rejects. An empty table gives an empty result.
    """
    measured = write_and_reread(text_statistics(docs), "statistics")
    verdict = list_expression(learn_quality(measured, labels, **options))
    return measured.withColumn("base_failed", base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` keeps."""
    measured = write_and_reread(text_statistics(docs, with_rows=True), "statistics")
    verdict = list_expression(learn_quality(measured.drop("row"), labels, **options))
    return measured.filter(~base_failed()).filter(verdict).select("row.*")
