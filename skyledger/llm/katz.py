"""Scoring of texts by a Katz backoff bigram model with Good-Turing discounts.

A word after another has the discounted share of the pair's count; if training never saw the
pair, the context's backoff weight times the word's own probability. Words are discounted in the same
way, and what that frees is the probability of any unknown word. Each backoff weight is what the
context's seen pairs leave over, divided by the probability of the words not seen there, so every
context's probabilities add up to one.

Work goes by blocks of documents of some megabytes. A block keeps its texts as numbers into its own
vocabulary. It sends its distinct words, and then its distinct pairs, as sorted 64-bit hashes
with its counts, cut by ranges of the hash; each range is summed in one task, which stores its part of
the model's table and answers the block with the totals. A block also asks for each context's backoff weight once, naming the documents that
need it. Since a block sends each key once, a
frequent word or pair is no heavier than a rare one. Two of n keys share a hash with a
chance of n * n / 2**65.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map
from skyledger.llm.tokens import small_batches
from skyledger.session import scratch_folder, write_and_reread

#: Counts up to this are discounted by Good-Turing, larger ones lose TAIL of a count.
CUT = 5
TAIL = 0.5
BLOCK_BYTES = 8_000_000
#: Keys that one task sums at a time.
PART_KEYS = 1_000_000
#: Neither is a word: the end of a text, and the context before its first word.
END, START = b"", b"\n"


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 2)


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Compressed byte planes of unsigned numbers, or of the steps of a rising list."""
    if rising and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type, rising: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    values = np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


@dataclass
class Block:
    """Tokens of some documents as positions in the sorted vocabulary, and their distinct pairs."""

    vocabulary: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    train: np.ndarray

    def __post_init__(self) -> None:
        self.document = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.learnt = self.train[self.document]
        first = np.cumsum(self.sizes) - self.sizes
        self.context = np.empty_like(self.tokens)  # at most 2**32 words in a block
        self.context[1:] = self.tokens[:-1]
        self.context[first] = np.searchsorted(self.vocabulary, np.uint64(word_hash(START)))

    def word_counts(self) -> np.ndarray:
        """Of each vocabulary entry in training texts; the start counts texts."""
        counts = np.bincount(self.tokens[self.learnt], minlength=len(self.vocabulary))
        counts[self.context[0]] = self.train.sum()
        return counts.astype(np.uint32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the distinct pairs, their training counts, one place of each, and each token's pair."""
        pair = self.context.astype(np.int64) * len(self.vocabulary) + self.tokens
        _, place, of = np.unique(pair, return_index=True, return_inverse=True)
        del pair
        key = pair_hash(self.vocabulary[self.context[place]], self.vocabulary[self.tokens[place]])
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        of = rank[of]
        return key[order], np.bincount(of[self.learnt], minlength=len(order)).astype(np.uint32), place[order], of


BLOCK = "block long, doc_id array<{}>, train binary, sizes binary, tokens binary, vocabulary binary, n_words long, n_pairs long"


def make_blocks(docs: DataFrame, train: Column) -> DataFrame:
    """Blocks of ``docs(doc_id, text)``; ``train`` tells which documents are learnt from."""
    wanted = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(small_batches(batches, "text", BLOCK_BYTES)):
            local = {END: 0, START: 1}
            texts = []
            for text in batch["text"].to_pylist():
                words = text.encode().lower().split() if text else []
                texts.append(np.array([*[local.setdefault(w, len(local)) for w in words], 0], dtype=np.uint32))
            vocabulary, rank = np.unique(np.array([word_hash(w) for w in local], dtype=np.uint64), return_inverse=True)
            flags = np.array(batch["train"].to_pylist(), dtype=bool)
            sizes = np.array([len(t) for t in texts], dtype=np.uint32)
            block = Block(vocabulary, rank[np.concatenate(texts)].astype(np.uint32), sizes, flags)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([part << 32 | number], pa.int64()),
                    "doc_id": pa.array([batch["doc_id"].to_pylist()], pa.list_(batch["doc_id"].type)),
                    "train": [pack(flags.astype(np.uint8))],
                    "sizes": [pack(sizes)],
                    "tokens": [pack(block.tokens)],
                    "vocabulary": [pack(vocabulary, rising=True)],
                    "n_words": pa.array([len(vocabulary)], pa.int64()),
                    "n_pairs": pa.array([len(block.pairs()[0])], pa.int64()),
                }
            )

    return arrow_map(wanted, build, BLOCK.format(wanted.schema["doc_id"].dataType.simpleString()))


def read_block(batch: pa.RecordBatch, i: int) -> Block:
    kinds = {"vocabulary": np.uint64, "tokens": np.uint32, "sizes": np.uint32, "train": np.uint8}
    found = {name: unpack(batch[name][i].as_py(), kind, name == "vocabulary") for name, kind in kinds.items()}
    return Block(**(found | {"train": found["train"].astype(bool)}))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


TOTALS = "part int, block long, totals binary, own binary, keys binary, counts binary, seen array<long>, distinct long, total long"


def sum_counts(blocks: DataFrame, pairs: bool) -> DataFrame:
    """Totals of the blocks' words or pairs: the model's table and the answers to the blocks.

    A row with no ``block`` is a part of the model: the keys of a range with counts, how many keys have count 1 to
    ``CUT + 1``, the number of keys and of tokens. The other rows tell each block the totals of its
    keys, in their order, and which of them it is the first to know.
    """
    size = blocks.agg(F.coalesce(F.sum("n_pairs" if pairs else "n_words"), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_KEYS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = read_block(batch, i)
                keys, counts = block.pairs()[:2] if pairs else (block.vocabulary, block.word_counts())
                part = part_of(keys, parts)
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                cuts = list(zip(starts, [*starts[1:], len(keys)], strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(part[starts], pa.int32()),
                        "block": pa.array([batch["block"][i].as_py()] * len(starts), pa.int64()),
                        "keys": pa.array([pack(keys[a:b], rising=True) for a, b in cuts], pa.binary()),
                        "counts": pa.array([pack(counts[a:b]) for a, b in cuts], pa.binary()),
                    }
                )

    def add(part: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        lists = [unpack(k, np.uint64, rising=True) for _, k, _ in rows]
        keys, first, of = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
        counts = np.concatenate([unpack(c, np.uint32) for _, _, c in rows])
        totals = np.bincount(of, counts, minlength=len(keys)).astype(np.uint64)
        own = np.zeros(len(of), dtype=np.uint8)
        own[first] = 1
        own &= totals[of] > 0
        ends = np.cumsum([len(x) for x in lists])
        answers = [(b, of[e - len(x) : e], own[e - len(x) : e]) for (b, _, _), x, e in zip(rows, lists, ends, strict=True)]
        known = totals > 0
        if not pairs:
            known &= keys != np.uint64(word_hash(START))
        seen = np.bincount(np.minimum(totals[known], CUT + 2).astype(np.int64), minlength=CUT + 3)[1 : CUT + 2]
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part] * (len(rows) + 1), pa.int32()),
                "block": pa.array([*[b for b, _, _ in answers], None], pa.int64()),
                "totals": pa.array([*[pack(totals[o]) for _, o, _ in answers], None], pa.binary()),
                "own": pa.array([*[pack(o) for _, _, o in answers], None], pa.binary()),
                "keys": pa.array([*[None] * len(rows), pack(keys[totals > 0], rising=True)], pa.binary()),
                "counts": pa.array([*[None] * len(rows), pack(totals[totals > 0])], pa.binary()),
                "seen": pa.array([*[None] * len(rows), seen.tolist()], pa.list_(pa.int64())),
                "distinct": pa.array([*[None] * len(rows), int(known.sum())], pa.int64()),
                "total": pa.array([*[None] * len(rows), int(totals[known].sum())], pa.int64()),
            }
        )

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:
            for p, *row in zip(*(batch[c].to_pylist() for c in ("part", "block", "keys", "counts")), strict=True):
                if p != part and rows:
                    yield add(part, rows)
                    rows = []
                part = p
                rows.append(tuple(row))
        if rows:
            yield add(part, rows)

    sent = arrow_map(blocks, send, "part int, block long, keys binary, counts binary")
    dealt = sent.repartition(parts, "part").sortWithinPartitions("part", "block")
    return write_and_reread(arrow_map(dealt, receive, TOTALS), "pair-totals" if pairs else "word-totals")


class Discount:
    """Good-Turing discounts from the numbers of keys seen once, twice, and so on.

    Where the numbers don't give a share between 0 and 1 for every count up to ``CUT``, a constant is taken off counts
    instead (absolute discounting). Either way every seen key gives something up.
    """

    def __init__(self, seen: list[int], distinct: int, total: int) -> None:
        self.total, self.distinct = total, distinct
        n = [0, *seen]
        share = [1.0] * (CUT + 1)
        usual = all(n[1:]) and (CUT + 1) * n[CUT + 1] < n[1]
        if usual:
            rest = (CUT + 1) * n[CUT + 1] / n[1]
            share[1:] = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, CUT + 1)]
        if not usual or not all(0 < d < 1 for d in share[1:]):
            off = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else TAIL
            share[1:] = [1 - off / r for r in range(1, CUT + 1)]
        self.share = np.array(share)
        small = sum(n[r] * r * (1 - share[r]) for r in range(1, CUT + 1))
        self.freed = (small + TAIL * (distinct - sum(n[1 : CUT + 1]))) / total if total else 1.0

    def counts(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        counts = counts.astype(np.float64)
        return np.where(counts > CUT, counts - TAIL, counts * self.share[np.minimum(counts, CUT).astype(np.int64)])


def _discount(totals: DataFrame) -> Discount:
    """From the model's rows, whose counts of counts are summed."""
    sums = [F.coalesce(F.sum(F.get("seen", F.lit(r))), F.lit(0)) for r in range(CUT + 1)]
    *seen, distinct, total = totals.filter("block IS NULL").agg(
        *sums, F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))
    ).first()
    return Discount(seen, distinct, total)


class Scorer:
    """Word probabilities and the seen pairs of a block, from the totals that came back."""

    def __init__(self, batch: pa.RecordBatch, i: int, words: Discount, pairs: Discount) -> None:
        self.block = block = read_block(batch, i)

        def answer(column: str, name: str, kind: type) -> np.ndarray:
            return np.concatenate([unpack(r[name], kind) for r in batch[column][i].as_py()])

        self.count = answer("words", "totals", np.uint64).astype(np.float64)
        total = answer("pairs", "totals", np.uint64)
        self.own = answer("pairs", "own", np.uint8).astype(bool)
        _, _, self.place, self.pair_of = block.pairs()
        self.pair_total = total.astype(np.float64)
        self.pair_kept = pairs.counts(total)
        known = self.count > 0
        self.word = np.where(known, words.counts(self.count) / max(1, words.total), words.freed)


def katz_scores(docs: DataFrame, train: Column) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs(doc_id, text)``.

    The model learns from the rows for which ``train`` is true (null counts as false) and scores all.
    Texts are lower-cased (A-Z), words end at ASCII white space, and each text has an end token. ``score`` is the model's
    log10 probability of the text; ``base_score`` that of single words with a tenth added to counts.

    A null or empty text is an end only. Repeated rows count as often as they come. If there is nothing to learn from, every token is
    unknown and has probability 1. An empty table gives an empty result. The model stays in the shared folder: counts of
    words and pairs by ranges of their hashes, and the backoff weight of each context.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "katz-blocks")
    name = f"katz_blocks_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Bucketed, so that only the answers move when they are joined with their blocks.
    try:
        make_blocks(docs, train).write.format("parquet").bucketBy(buckets, "block").option("path", folder).saveAsTable(name)
        return _scores(spark.table(name))
    finally:  # only its name goes; the files stay, which the result is read from
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _scores(blocks: DataFrame) -> DataFrame:
    """See ``katz_scores``."""
    kind = dict(blocks.dtypes)["doc_id"].removeprefix("array<")[:-1]
    word_totals, pair_totals = sum_counts(blocks, pairs=False), sum_counts(blocks, pairs=True)
    words, pairs = _discount(word_totals), _discount(pair_totals)

    def answers(totals: DataFrame, column: str) -> DataFrame:
        one = F.struct("part", "totals", "own")
        return totals.filter("block IS NOT NULL").groupBy("block").agg(F.array_sort(F.collect_list(one)).alias(column))

    told = blocks.join(answers(word_totals, "words"), "block").join(answers(pair_totals, "pairs"), "block")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = Scorer(batch, i, words, pairs)
                place = s.place[s.own]
                context, word = s.block.context[place], s.block.tokens[place]
                size = len(s.block.vocabulary)
                some = np.unique(context)
                sums = [np.bincount(context, v, minlength=size)[some].astype(np.float64) for v in (s.pair_total[s.own], s.pair_kept[s.own], s.word[word])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.block.vocabulary[some].view(np.int64)), *map(pa.array, sums)], ["context", "n", "kept", "seen"]
                )

    parts = arrow_map(told, contexts, "context long, n double, kept double, seen double").groupBy("context")
    weights = parts.agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.sum("seen").alias("seen"))
    weight = (1 - F.col("kept") / F.col("n")) / (1 - F.col("seen"))
    weights = write_and_reread(weights.select("context", F.log10(weight).alias("weight")), "backoff-weights")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_total = words.total + 0.1 * (words.distinct + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                s = Scorer(batch, i, words, pairs)
                b = s.block
                n_docs = len(b.sizes)
                seen = s.pair_total[s.pair_of] > 0
                context_count = np.maximum(1, s.count[b.context])
                token = np.where(seen, s.pair_kept[s.pair_of] / context_count, s.word[b.tokens])
                values = {
                    "n_known": np.bincount(b.document, s.count[b.tokens] > 0, minlength=n_docs),
                    "base": np.bincount(b.document, np.log10((s.count[b.tokens] + 0.1) / base_total), minlength=n_docs),
                    "part": np.bincount(b.document, np.log10(token), minlength=n_docs),
                }
                number = batch["block"][i].as_py()
                ids = batch["doc_id"][i].values
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array(np.full(n_docs, number)),
                        "rows": pa.ListArray.from_arrays(np.arange(n_docs + 1, dtype=np.int32), pa.array(np.arange(n_docs))),
                        "times": pa.ListArray.from_arrays(np.arange(n_docs + 1, dtype=np.int32), pa.array(np.zeros(n_docs, dtype=np.int64))),
                        "context": pa.array(np.arange(n_docs) * 1_000_003 + number),
                        "asks": pa.array(np.zeros(n_docs, dtype=bool)),
                        "doc_id": ids,
                        "train": pa.array(b.train),
                        "n_tokens": pa.array(b.sizes.astype(np.int64)),
                        **{k: pa.array(v.astype(np.int64 if k == "n_known" else np.float64)) for k, v in values.items()},
                    }
                )
                # contexts that must back off, each with its documents; a context that training lacks has weight 1
                open_tokens = np.flatnonzero(~seen & (s.count[b.context] > 0))
                asked = b.context[open_tokens].astype(np.int64) * n_docs + b.document[open_tokens]
                asked, times = np.unique(asked, return_counts=True)
                context, first = np.unique(asked // n_docs, return_index=True)
                cuts, n = np.append(first, len(asked)).astype(np.int32), len(context)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array(np.full(n, number)),
                        "rows": pa.ListArray.from_arrays(cuts, pa.array(asked % n_docs)),
                        "times": pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64))),
                        "context": pa.array(b.vocabulary[context].view(np.int64)),
                        "asks": pa.array(np.ones(n, dtype=bool)),
                        "doc_id": pa.nulls(n, ids.type),
                        "train": pa.nulls(n, pa.bool_()),
                        "n_tokens": pa.nulls(n, pa.int64()),
                        "n_known": pa.nulls(n, pa.int64()),
                        "base": pa.nulls(n, pa.float64()),
                        "part": pa.nulls(n, pa.float64()),
                    }
                )

    schema = f"block long, rows array<long>, times array<long>, context long, asks boolean, doc_id {kind}, train boolean, n_tokens long, n_known long, base double, part double"
    scored = arrow_map(told, score, schema).join(weights.withColumn("asks", F.lit(True)), ["context", "asks"], "left")
    each = F.explode(F.arrays_zip(F.col("rows").alias("row"), F.col("times").alias("times"))).alias("each")
    scored = scored.drop("context", "asks").withColumn("each", each).withColumns({"row": F.col("each.row"), "times": F.col("each.times")})
    sums = scored.groupBy("block", "row").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "train", "n_tokens", "n_known")],
        F.max("base").alias("base_score"),
        (F.max("part") + F.coalesce(F.sum(F.col("times") * F.col("weight")), F.lit(0.0))).alias("score"),
    )
    return sums.select("doc_id", "train", "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score")
