"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints within ``radius`` bits of each other agree on all but ``radius`` of any ``blocks``
blocks of bits. So they meet in one of the groups of fingerprints that agree on ``blocks - radius``
blocks. Inside a group the fingerprints are stored vertically, one plane per bit and 64
fingerprints per word; a fingerprint is compared with 64 others at a time by adding the
differing bits into carry-save counters, and words all of whose distances exceed
the radius are abandoned on the way.

Only distinct fingerprints are grouped, so copies cost nothing. A group larger than a tile is
dealt out as pairs of tiles to several tasks. A group gives a spanning forest of its links
and not all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map, components
from skyledger.llm.tokens import small_batches
from skyledger.session import write_and_reread

#: Fingerprints of a group that one task holds at a time; twice that of larger groups.
TILE = 4096
ALL = np.uint64(2**64 - 1)


def shingle_hashes(text: str | None, size: int) -> list[int]:
    """XXH64 (seed 42) of each run of ``size`` lower-cased words, joined by a space; of all words if there are fewer."""
    words = text.encode().lower().split() if text else []
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    runs = zip(*[words[i:] for i in range(size)], strict=False)
    return [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]


def simhash(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list of hashes: a bit is 1 if it is set in over half of them; 0 for none."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    some = [i for i, h in enumerate(hashes) if h]
    at = 0
    while at < len(some):
        stop, total = at, 0
        while stop < len(some) and (total < 50_000 or stop == at):
            total += len(hashes[some[stop]])
            stop += 1
        rows = some[at:stop]
        sizes = np.array([len(hashes[i]) for i in rows])
        flat = np.concatenate([np.array(hashes[i], dtype=np.uint64) for i in rows]).astype(">u8")
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1)
        counts = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
        out[rows] = np.packbits(2 * counts > sizes[:, None], axis=1).view(">u8").ravel()
        at = stop
    return out


def fingerprinted(docs: DataFrame, shingle: int = 3, with_rows: bool = False) -> DataFrame:
    """``doc_id, fp`` (as a signed long) and on request the whole ``row`` of each row of ``docs(doc_id, text)``."""
    wanted = docs.select("doc_id", "text", *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if with_rows else []))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            fp = simhash([shingle_hashes(t, shingle) for t in batch["text"].to_pylist()])
            rows = [batch["row"]] if with_rows else []
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fp.view(np.int64)), *rows], ["doc_id", "fp", "row"][: 2 + with_rows])

    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    return arrow_map(wanted, add, f"doc_id {kinds['doc_id']}, fp long" + (f", row {kinds['row']}" if with_rows else ""))


def connect(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the trees of ``a`` and ``b`` pairwise; returns roots, each the least of its tree."""
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(parent, up := parent[parent]):
            parent = up


def sliced_links(fp: np.ndarray, start: np.ndarray, end: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions ``i < j < end[i]`` whose fingerprints differ in at most ``radius`` bits.

    ``start`` and ``end`` bound the group of each position.
    """
    n = len(fp)
    words = -(-n // 64)
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    padded = np.zeros((64, words * 64), dtype=np.uint8)
    padded[:, :n] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    position = np.arange(n)
    first, last = position // 64, (end - 1) // 64
    counts = last - first + 1
    ends = np.cumsum(counts)
    step = 1 << 16
    counters = max(1, radius.bit_length())
    spare = (1 << counters) - 1 - radius  # a counter starts here, so that it overflows beyond the radius
    for at in range(0, int(ends[-1]), step):
        entry = np.arange(at, min(at + step, int(ends[-1])))
        q = np.searchsorted(ends, entry, side="right")
        w = first[q] + entry - (ends[q] - counts[q])
        own = fp[q]
        low = np.where(w == first[q], (np.uint64(2) << (q % 64).astype(np.uint64)) - np.uint64(1), np.uint64(0))
        high = np.where(w == last[q], ~((np.uint64(2) << ((end[q] - 1) % 64).astype(np.uint64)) - np.uint64(1)), np.uint64(0))
        over = low | high
        counter = [np.full(len(q), ALL if spare >> k & 1 else 0, dtype=np.uint64) for k in range(counters)]
        for p in range(64):
            carry = planes[p][w] ^ (np.uint64(0) - (own >> np.uint64(63 - p) & np.uint64(1)))
            for k in range(counters):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
            if p >= 7 and p % 4 == 3:
                alive = over != ALL
                if not alive.any():
                    break
                if alive.mean() < 0.7:
                    q, w, own, over = q[alive], w[alive], own[alive], over[alive]
                    counter = [c[alive] for c in counter]
        entry, lane = np.nonzero(np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        if len(entry):
            yield q[entry], w[entry] * 64 + lane


def forest(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is linked inside each group; ``group`` is sorted."""
    cut = np.flatnonzero(np.diff(group)) + 1
    bounds = np.concatenate([[0], cut, [len(group)]])
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    parent = np.arange(len(fp))
    for a, b in sliced_links(fp, bounds[of], bounds[of + 1], radius):
        parent = connect(parent, a, b)
    child = np.flatnonzero(parent != np.arange(len(fp)))
    return fp[child], fp[parent[child]]


def fingerprint_links(fps: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Spanning links ``a, b`` between distinct fingerprints ``fp`` at most ``radius`` bits apart; read twice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for kept in combinations(range(blocks), blocks - radius):
        mask = sum((1 << edges[b + 1]) - (1 << edges[b]) for b in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("v")) for i, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    sizes = keyed.groupBy("k", "v").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.expr(f"cast(ceil(n / {TILE}) as int)")
    met = keyed.join(sizes, ["k", "v"]).withColumn("tiles", tiles)
    met = met.withColumn("t", F.expr("cast(pmod(xxhash64(fp, k), tiles) as int)"))
    other = F.explode(F.expr("case when tiles = 1 then array(0) else filter(sequence(0, tiles - 1), u -> u <> t) end"))
    met = met.withColumn("u", other).select("fp", F.xxhash64("k", "v", F.least("t", "u"), F.greatest("t", "u")).alias("group"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, group = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

        def found(stop: int) -> pa.RecordBatch:
            a, b = forest(fp[:stop].view(np.uint64), group[:stop], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            fp = np.concatenate([fp, batch["fp"].to_numpy()])
            group = np.concatenate([group, batch["group"].to_numpy()])
            if len(group) >= 2 * TILE:  # the last group may go on in the next batch
                stop = int(np.searchsorted(group, group[-1]))
                if stop:
                    yield found(stop)
                    fp, group = fp[stop:], group[stop:]
        if len(group):
            yield found(len(group))

    return arrow_map(met.repartition("group").sortWithinPartitions("group"), link, "a long, b long")


def _components(rows: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``fp, label, component_id`` of each distinct fingerprint of ``rows(doc_id, fp)``."""
    fps = write_and_reread(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    labels = components(fingerprint_links(fps, radius, blocks)).withColumnRenamed("node", "fp")
    labelled = fps.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    labelled = write_and_reread(labelled, "fingerprint-labels")
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return labelled.select("fp", "label").join(least, "label")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 5) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row of ``docs(doc_id, text)``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is
    the least ``doc_id`` that links lead to. A null or empty text has fingerprint zero and is linked
    like any other. Null ids are kept and take part, but are not the least unless a component
    has no other; repeated rows share a component. An empty table gives an empty result.
    """
    rows = write_and_reread(fingerprinted(docs, shingle), "simhash-rows")
    found = _components(rows, radius, blocks).select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, blocks: int = 5) -> DataFrame:
    """``docs`` with one row of each component left: the one of least ``doc_id``, any one of repeated rows."""
    rows = write_and_reread(fingerprinted(docs, shingle, with_rows=True), "simhash-rows")
    ids = rows.select("doc_id", "fp")
    found = _components(ids, radius, blocks)
    # One fingerprint of each component's least id, found without the texts. They meet it by id and fingerprint, so
    # copies of one text spread over many tasks; what is left, one text of each component and repeated rows, moves once more.
    chosen = ids.join(found, "fp").filter("doc_id <=> component_id").groupBy("label", "component_id").agg(F.min("fp").alias("fp"))
    chosen = write_and_reread(chosen.select("fp", "component_id"), "kept-fingerprints")
    kept = rows.join(chosen, "fp").filter("doc_id <=> component_id").dropDuplicates(["fp"])
    return kept.select("row.*")
