"""Best-fit-decreasing packing of tokenized documents into sequences of fixed length.

Best fit decreasing looks at lengths only, and there are at most ``capacity`` lengths. So the
whole corpus is packed exactly, item by item in effect, from a count of pieces per length: all
pieces of a length go into the tightest open sequences in runs. The runs, whose number depends
on the capacity and not on the corpus, say where the i-th piece of each length goes; the
pieces are numbered and placed by distributed jobs.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map, buckets_for, running_total
from skyledger.llm.tokens import TEXT_AT_ONCE, Encoder, small_batches, tokenizer_path
from skyledger.session import write_and_reread

PIECES = "doc_id {}, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Segment tree over remaining capacities: which of them have an open bin."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)
        self.bins: dict[int, deque[tuple[int, int]]] = defaultdict(deque)

    def _mark(self, room: int, there: bool) -> None:
        at = room + self.size
        self.any[at] = there
        while at > 1:
            at //= 2
            there = self.any[2 * at] or self.any[2 * at + 1]
            if self.any[at] == there:
                break
            self.any[at] = there

    def add(self, room: int, first: int, count: int) -> None:
        """Open ``count`` bins from number ``first`` on, each with ``room`` left."""
        if room and count:
            self.bins[room].append((first, count))
            if len(self.bins[room]) == 1:
                self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        """The oldest interval of bins with exactly ``room`` left, closed."""
        interval = self.bins[room].popleft()
        if not self.bins[room]:
            self._mark(room, False)
        return interval

    def tightest(self, length: int) -> int | None:
        """Least remaining capacity of at least ``length`` that an open bin has, in logarithmic time."""
        at = length + self.size
        if self.any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over ``counts`` pieces of each length.

    Returns runs ``(length, first_item, per_bin, first_bin, offset)``: from the item of that
    number on, items of the length fill bins from ``first_bin`` on, ``per_bin`` to a bin from
    ``offset`` on, until the next run of the length begins. A bin that has taken a piece
    stays the tightest for the next one of that length while there is room, so whole
    intervals of bins are filled at once.
    """
    tree, runs, bins = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        item, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, open_bins = capacity, bins, -(-left // (capacity // length))
                bins += open_bins
            else:
                first, open_bins = tree.take(room)
            per_bin = room // length
            full = min(open_bins, left // per_bin)
            if full:
                runs.append((length, item, per_bin, first, capacity - room))
                tree.add(room - per_bin * length, first, full)
                item, left = item + full * per_bin, left - full * per_bin
            rest = first + full
            if full < open_bins and left:
                runs.append((length, item, per_bin, rest, capacity - room))
                tree.add(room - left * length, rest, 1)
                item, left, rest = item + left, 0, rest + 1
            tree.add(room, rest, first + open_bins - rest)
    return runs


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids`` of each piece of each document.

    A document is the ids of its text and ``end_id``. One longer than ``capacity`` is cut into
    pieces of ``capacity``, the first of which takes what is over. A null or empty text is one piece of length 1.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = Encoder.of(tokenizer), end_id.to_bytes(4, "little")
        for batch in small_batches(batches, "text", TEXT_AT_ONCE):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(encode(batch["text"])):
                data += end
                n = len(data) // 4
                at, number = 0, 0
                while at < n:
                    size = min(n, (n - 1) % capacity + 1 if not at else capacity)
                    part = data[4 * at : 4 * (at + size)]
                    row.append(i)
                    piece.append(number)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
                    at, number = at + size, number + 1
            columns = {
                "doc_id": batch["doc_id"].take(pa.array(row, pa.int32())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = PIECES.format(docs.schema["doc_id"].dataType.simpleString()) + ", ids array<int>" * with_ids
    return arrow_map(docs.select("doc_id", "text"), cut, schema)


def pack_best_fit(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces``, which need ``doc_id, piece, length, ids_crc32``.

    Lengths must lie in 1 to ``capacity``. Pieces of one length are numbered in hash order;
    repeated rows get places of their own. An empty table gives an empty result. ``pieces`` is read twice: pass a
    written table.
    """
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in histogram}
    runs = sorted(best_fit_runs(counts, capacity))
    where = np.array(runs or [(0, 0, 1, 0, 0)], dtype=np.int64)
    places = pieces.sparkSession.sparkContext.broadcast((where[:, 0] << 44 | where[:, 1], where))  # bounded by ``capacity``

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = places.value
        for batch in batches:
            length, item = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "item"))
            run = table[np.searchsorted(keys, length << 44 | item, side="right") - 1]
            j = item - run[:, 1]
            names = [n for n in batch.schema.names if n != "item"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in names], pa.array(run[:, 3] + j // run[:, 2]), pa.array(run[:, 4] + j % run[:, 2] * length)],
                [*names, "sequence_id", "offset"],
            )

    keyed = pieces.withColumn("key", F.expr("xxhash64(doc_id, piece, ids_crc32) & 1152921504606846975L"))
    items = running_total(
        keyed, ["length"], "key", ["doc_id", "piece", "ids_crc32"], F.lit(1), buckets_for(sum(counts.values())), "item"
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return arrow_map(items.select(*pieces.columns, "item"), place, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, capacity: int = 2048, with_ids: bool = False
) -> DataFrame:
    """Pack ``docs(doc_id, text)``: one row per piece with its place.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``). Null and
    empty texts are a piece that holds the end id only; null and repeated ids are kept.
    """
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")
    return pack_best_fit(write_and_reread(token_pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the training sequences, from :func:`pack_documents` with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
