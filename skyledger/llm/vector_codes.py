"""Codes of a few bytes for vectors: one codebook per part of the vector, fitted by Lloyd's rounds in integers.

The parts of all vectors are members of their codebook entries. A member's owner is (position, entry, salt); its salt is random
and fixed, and there is one salt per ``OWNED`` vectors, so that an entry that nearly all parts belong to still has
many owners. Members live in files written owner by owner. In each round

* tasks read the members where they lie and compare them with the codebooks. Those whose entry stays go
  back beside their owner's files without a shuffle; only those whose entry changes are shuffled to their new owner,
* the owners add up their resident members. One row of sums per task and entry meets the others, and
  the floors of the means, ``entries`` x length numbers, are the next codebooks.

All sums and distances are exact integers, so the codebooks don't depend on partitions or retried tasks. Members are
written in the shared folder in each round and the last round's files are removed after that, so a lost executor costs its tasks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map, drop_table, with_key_total
from skyledger.llm.vectors import block, floored, whole_vectors
from skyledger.session import scratch_folder, write_and_reread

#: Vectors to a salt.
OWNED = 4096
#: Numbers held while distances are worked out.
AT_ONCE = 1 << 22
MEMBERS = "position int, entry int, salt int, part array<int>"
CODES = "codes array<int>, error long"


def bounds(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; equal parts if ``parts`` divides the length, else one apart."""
    return [p * length // parts for p in range(parts + 1)]


def nearest(rows: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest codebook row by squared distance (the lower of equal ones), and that distance, exactly."""
    n, width = rows.shape
    found, error = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int64)
    if not width:
        return found, error
    reach = max(int(np.abs(rows).max(initial=0)), int(np.abs(codebook).max(initial=0)))
    exact = 4 * reach * reach * width < 1 << 53  # doubles then hold every sum on the way, and their products are faster
    for start in range(0, n, max(1, AT_ONCE // codebook.size)):
        some = rows[start : start + max(1, AT_ONCE // codebook.size)]
        if exact:
            x, c = some.astype(np.float64), codebook.astype(np.float64)
            distance = ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
        else:
            distance = ((some[:, None, :] - codebook[None, :, :]) ** 2).sum(2)
        at = distance.argmin(1)
        found[start : start + len(some)] = at
        error[start : start + len(some)] = distance[np.arange(len(some)), at]
    return found, error


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, rows.shape[1] or 1, dtype=np.int32) if rows.shape[1] else np.zeros(len(rows) + 1, np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.int32).ravel()))


def _members(at: list[int], codebooks: list[np.ndarray]):
    """Each vector's parts with their nearest entries."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, salt = block(batch["x"], at[-1]), batch["salt"]
            for p, codebook in enumerate(codebooks):
                rows = vectors[:, at[p] : at[p + 1]]
                columns = [np.full(len(rows), p, np.int32), nearest(rows, codebook)[0], salt, _lists(rows)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["position", "entry", "salt", "part"])

    return place


def _compared(at: list[int], codebooks: list[np.ndarray]):
    """Members with the entry now nearest, and whether that is another."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch["position"].to_numpy()
            for p in np.unique(position):
                own = batch.take(pa.array(np.flatnonzero(position == p)))
                entry = nearest(block(own["part"], at[p + 1] - at[p]), codebooks[p])[0]
                moved = pa.array(entry != own["entry"].to_numpy())
                yield pa.RecordBatch.from_arrays([own["position"], pa.array(entry), own["salt"], own["part"], moved], ["position", "entry", "salt", "part", "moved"])

    return compare


def _sums(at: list[int], entries: int):
    """Sum of each component of the members of each entry that a task holds, and at component -1 their number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((entries, b - a + 1), dtype=np.int64) for a, b in zip(at, at[1:])]
        for batch in batches:
            position, entry = batch["position"].to_numpy(), batch["entry"].to_numpy()
            for p in np.unique(position):
                own = np.flatnonzero(position == p)
                rows = block(batch["part"].take(pa.array(own)), at[p + 1] - at[p])
                order = np.argsort(entry[own], kind="stable")
                present, first, count = np.unique(entry[own][order], return_index=True, return_counts=True)
                totals[p][present, 0] += count
                if rows.shape[1]:
                    totals[p][present, 1:] += np.add.reduceat(rows[order], first, axis=0)
        rows = [(p, e, i - 1, int(v)) for p, one in enumerate(totals) for e, row in enumerate(one) if row[0] for i, v in enumerate(row)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64() if c == 3 else pa.int32()) for c in range(4)], ["position", "entry", "component", "total"]
        )

    return add


def _updated(members: DataFrame, at: list[int], codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The owners' update: floors of the means of the resident members; an entry without any stays."""
    found = arrow_map(members, _sums(at, len(codebooks[0])), "position int, entry int, component int, total long")
    totals = {(r.position, r.entry, r.component): r.total for r in found.groupBy("position", "entry", "component").agg(F.sum("total").alias("total")).collect()}
    return [
        np.array(
            [
                [totals[p, e, i] // totals[p, e, -1] if (p, e, -1) in totals else int(old) for i, old in enumerate(entry)]
                for e, entry in enumerate(codebook)
            ],
            dtype=np.int64,
        ).reshape(codebook.shape)
        for p, codebook in enumerate(codebooks)
    ]


def _written(df: DataFrame, label: str, *by: str) -> tuple[DataFrame, str]:
    path = scratch_folder(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def fit_codebooks(kept: DataFrame, at: list[int], entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks, one array of entries a part, for ``kept(vec_id, x, salt)``; see the module.

    They start as the parts of the ``entries`` least vec_ids, nulls last and equal ones by their components; with
    fewer vectors there are fewer entries.
    """
    spark, owner = kept.sparkSession, ["position", "entry", "salt"]
    first = [r.x for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()]
    start = np.array(first, dtype=np.int64).reshape(len(first), at[-1])
    codebooks = [start[:, a:b] for a, b in zip(at, at[1:])]
    members, paths = None, []
    for _ in range(rounds):
        if members is None:
            placed = arrow_map(kept.select("x", "salt"), _members(at, codebooks), MEMBERS)
            members, path = _written(placed.repartition(*owner), "members")
            paths = [path]
        else:
            compared, path = _written(arrow_map(members, _compared(at, codebooks), f"{MEMBERS}, moved boolean"), "compared", "moved")
            arrived, arrivals = _written(compared.filter("moved").drop("moved").repartition(*owner), "arrived")
            for old in paths:
                drop_table(spark, old)
            paths = [path, arrivals]
            members = compared.filter("NOT moved").drop("moved").unionByName(arrived)
        codebooks = _updated(members, at, codebooks)
    for path in paths:
        drop_table(spark, path)
    return codebooks


def _final(at: list[int], codebooks: list[np.ndarray], others: list[str]):
    """The codes and the error of each vector."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = block(batch["x"], at[-1])
            found = [nearest(vectors[:, at[p] : at[p + 1]], codebook) for p, codebook in enumerate(codebooks)]
            codes = _lists(np.stack([entry for entry, _ in found], axis=1))
            columns = [*(batch[c] for c in others), codes, pa.array(sum(error for _, error in found))]
            yield pa.RecordBatch.from_arrays(columns, [*others, "codes", "error"])

    return encode


def vector_codes(
    vectors: DataFrame, vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, codes, error`` of each whole vector, and the codebooks by part.

    ``codes`` are the indexes of the nearest entries, ``error`` the sum of their squared distances, in units of 1 / ``scale``.
    Rows whose vector is null, empty, shorter than the longest or holds null or non-finite components are dropped. Rows with a null or
    repeated vec_id, equal rows and null labels stay, each on its own. An empty table gives no rows and codebooks without entries. A
    vector so large that its error might not fit in a long ends the job. Only ``vec_id``, ``label`` and the vector are read.
    """
    whole, length = whole_vectors(vectors.select("vec_id", "label", F.col(vector).alias("x")), "x")
    if not length:
        empty = vectors.select("vec_id", "label").limit(0)
        return empty.withColumns({"codes": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("long")}), [np.zeros((0, 0), np.int64)] * parts
    limit = (2.0**61 / length) ** 0.5
    numbers = whole.withColumn("x", F.transform(floored("x", scale, min(limit, 2.0**30)), lambda x: x.cast("int")))
    kept = write_and_reread(numbers.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "vectors")
    salts = kept.count() // OWNED + 1
    at = bounds(length, parts)
    codebooks = fit_codebooks(kept.withColumn("salt", F.pmod("salt", F.lit(salts)).cast("int")), at, entries, rounds)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select("vec_id", "label").schema)
    return arrow_map(kept.select("vec_id", "label", "x"), _final(at, codebooks, ["vec_id", "label"]), f"{schema}, {CODES}"), codebooks


def vector_code_digests(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` with eight parts of 16 entries after six rounds."""
    codes, codebooks = vector_codes(vectors, parts=8, entries=16, rounds=6)
    text = ",".join(str(x) for codebook in codebooks for entry in codebook.tolist() for x in entry)
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = write_and_reread(codes.select("vec_id", "label", code.alias("code"), "error"), "codes")
    digest = F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")
    return with_key_total(rows, "label", "error", "label_error").select("vec_id", "code", "error", "label_error", digest)
