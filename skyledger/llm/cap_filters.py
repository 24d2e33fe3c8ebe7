"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector passes it if it leans towards it by at least a threshold.
Two vectors of high cosine pass many filters in common, others hardly any. The directions form a
random product code: a vector is rotated and cut into two blocks, each block has
``words`` random code words, and every pair of code words is a direction. So a vector's filters, out of ``words`` squared, are
listed from two short lists of products, by those whose sums exceed the threshold.

Vectors meet by filter and are compared as 8-bit copies with known rounding error. A pair that must be
linked whatever the error joins a spanning forest, a doubtful one is looked up and computed in
double precision. Links lie inside connected components, so the number of links of each vector is
counted there, in double precision, in tiles.

Up to ``FEW`` vectors two of cosine 0.9 in 64 dimensions meet in about 90 of some 270 filters
each. Of 15,000 random pairs of that cosine all met (with two rotations instead of three, all but 5 of 10,000). Of more vectors
the filters become narrower, so that one holds as many as before, and more, so that near vectors meet in as many as
before (``filters_for``). So a random vector of 64 dimensions is compared with 41 others of 2,000, 1,040 of 50,000, 1,030 of 400,000 and 1,180 of
3,200,000; one of 768 dimensions with 3,500 of 50,000 and 2,800 of 3,200,000. At most 1 of 100 pairs of cosine 0.9 shares no filter in 8, 64 or
768 dimensions (tested for 50,000 and 2,000,000 vectors). What grows is listing a vector's filters, with the root of the table's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map, components
from skyledger.llm.simhash import connect
from skyledger.session import write_and_reread

#: Vectors of a filter or component that one task compares with each other at a time.
TILE = 4096
COUNT_TILE = 2048
#: Buckets up to this size are compared together, by distance in the sorted list.
SMALL = 24
#: Vectors up to which the filters are those of ``WORDS`` and ``HEIGHT``.
FEW = 50_000
WORDS, HEIGHT = 1024, 3.6
LEAST_DIMS = 16
#: Products with code words held at once.
PRODUCTS = 1 << 20


def filters_for(vectors: int, cosine: float, dims: int) -> tuple[int, float]:
    """Code words and height for a table of so many vectors; the threshold of a filter is ``height / sqrt(dims)``.

    With up to ``FEW`` vectors the threshold is that of ``HEIGHT``, but 0.75 at the most, as in few dimensions hardly any direction is
    nearer. A random vector passes a threshold ``t`` about ``(1 - t^2)^(dims / 2)`` times; with more vectors it is such that a filter holds
    as many of them as with ``FEW``. Two vectors of the given cosine both pass it ``(1 - 2 t^2 / (1 + cosine))^(dims / 2)`` times;
    the words make up for that becoming rarer.
    """
    d = max(dims, LEAST_DIMS)
    base = min(0.75**2, HEIGHT**2 / d)
    now = 1 - (1 - base) * min(1.0, FEW / max(vectors, 1)) ** (2 / d)
    both = math.log1p(-2 * base / (1 + cosine)) - math.log1p(-2 * now / (1 + cosine))
    return math.ceil(WORDS * math.exp(d / 4 * both)), math.sqrt(now * d)


@lru_cache(maxsize=8)
def product_code(dims: int, words: int, rotations: int, seed: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each rotation its matrix and the code words of both blocks."""
    random = np.random.default_rng([seed, dims])
    half = dims // 2
    out = []
    for _ in range(rotations):
        turn, _ = np.linalg.qr(random.standard_normal((dims, dims)))
        codes = []
        for size in (half, dims - half):
            code = random.standard_normal((words, size))
            codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) / np.sqrt(2))
        out.append((turn, *codes))
    return out


def decode(x: np.ndarray, words: int, rotations: int, height: float, seed: int) -> list[np.ndarray]:
    """Numbers of the filters that each unit vector (a row) passes.

    The threshold is ``height / sqrt(dims)``. Shorter vectors than 16 are filled up with zeros, which changes no cosine.
    """
    own = x.shape[1]
    if own < LEAST_DIMS:
        x = np.hstack([x, np.zeros((len(x), LEAST_DIMS - own))])
    dims = x.shape[1]
    least = height / math.sqrt(dims)
    found: list[list[np.ndarray]] = [[] for _ in x]
    for number, (turn, first, second) in enumerate(product_code(dims, words, rotations, seed)):
        half = first.shape[1]
        for start in range(0, len(x), max(1, PRODUCTS // words)):
            turned = x[start : start + max(1, PRODUCTS // words)] @ turn
            a = turned[:, :half] @ first.T
            b = turned[:, half:] @ second.T
            most, likely = b.max(axis=1), a.max(axis=1)
            for i in range(len(turned)):
                some = np.flatnonzero(a[i] >= least - most[i])
                other = np.flatnonzero(b[i] >= least - likely[i])  # the second list is cut short like the first
                p, q = np.nonzero(a[i, some][:, None] + b[i, other][None, :] >= least)
                found[start + i].append(((own * rotations + number) * words + some[p]) * words + other[q])
    return [np.concatenate(f) for f in found]


def unit_rows(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and unit vectors in double precision, for each length of vector in the batch."""
    values = batch[column]
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = values.offsets.to_numpy()[:-1]
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = flat[starts[at][:, None] + np.arange(size)[None, :]]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares stay finite
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def is_vector(embedding: Column) -> Column:
    """Neither null, empty nor zero, and without null or infinite components."""
    fine = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(embedding, lambda v: v != 0)


def grouped(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """The rows in pieces of at least ``least``, never cutting a run of equal ``key``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table[key].to_numpy()
            stop = int(np.searchsorted(keys, keys[-1]))
            if stop:
                yield table.slice(0, stop)
            rest = table.slice(stop)
            held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def near_pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions in equal groups of the sorted ``group``, in bounded portions."""
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    sizes = np.diff(bounds)
    small = np.repeat(sizes <= SMALL, sizes)
    at = np.flatnonzero(small)
    for shift in range(1, SMALL):
        i = at[at + shift < len(group)]
        i = i[group[i] == group[i + shift]]
        if not len(i):
            break
        yield i, i + shift
    for start, size in zip(bounds[:-1][sizes > SMALL], sizes[sizes > SMALL], strict=True):
        for row in range(0, size - 1, 256):
            rows = np.arange(row, min(row + 256, size - 1))
            i, j = np.nonzero(np.arange(size)[None, :] > rows[:, None])
            yield start + rows[i], start + j


def filter_links(vectors: DataFrame, cosine: float, words: int | None, rotations: int, height: float | None, seed: int) -> DataFrame:
    """Spanning links ``a, b`` between the ``uid`` of written ``vectors(uid, embedding)`` that meet in a filter."""
    number = vectors.count()

    def options(x: np.ndarray) -> tuple[int, int, float, int]:
        by_size = filters_for(number, cosine, x.shape[1])
        return words or by_size[0], rotations, height or by_size[1], seed

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in unit_rows(batch, "embedding"):
                found, n = np.unique(np.concatenate(decode(x, *options(x))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["filter", "n"])

    def pass_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch["uid"].to_numpy()
            for start, x in ((at[i : i + 500], x[i : i + 500]) for at, x in unit_rows(batch, "embedding") for i in range(0, len(at), 500)):
                found = decode(x, *options(x))
                scale = np.abs(x).max(axis=1) / 127
                small = np.rint(x / scale[:, None]).astype(np.int8)
                error = np.linalg.norm(x - small * scale[:, None], axis=1)
                times = np.array([len(f) for f in found])
                repeat = np.repeat(np.arange(len(x)), times)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found)),
                        pa.array(uid[start][repeat]),
                        pa.array([small[i].tobytes() for i in repeat], pa.binary()),
                        pa.array(scale[repeat].astype(np.float32)),
                        pa.array(np.nextafter(error, 1)[repeat].astype(np.float32)),
                    ],
                    ["filter", "uid", "small", "scale", "error"],
                )

    hot = arrow_map(vectors.select("uid", "embedding"), sizes, "filter long, n long").groupBy("filter").agg(F.sum("n").alias("n"))
    hot = write_and_reread(hot.filter(f"n > {TILE}"), "hot-filters")
    passed = arrow_map(vectors.select("uid", "embedding"), pass_filters, "filter long, uid long, small binary, scale float, error float")
    if hot.isEmpty():
        met = passed.withColumn("group", F.col("filter"))
    else:  # vectors of a large filter meet in pairs of tiles
        tiles = passed.join(hot, "filter", "left").withColumn("tiles", F.expr(f"cast(coalesce(ceil(n / {TILE}), 1) as int)"))
        tiles = tiles.withColumn("t", F.expr("cast(pmod(xxhash64(uid, filter), tiles) as int)"))
        other = F.explode(F.expr("case when tiles = 1 then array(0) else filter(sequence(0, tiles - 1), u -> u <> t) end"))
        tiles = tiles.withColumn("u", other)
        met = tiles.withColumn(
            "group", F.when(F.col("tiles") == 1, F.col("filter")).otherwise(F.xxhash64("filter", F.least("t", "u"), F.greatest("t", "u")))
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "group", 20_000):
            group, uid = rows["group"].to_numpy(), rows["uid"].to_numpy()
            scale, error = rows["scale"].to_numpy(), rows["error"].to_numpy().astype(np.float64)
            sized = pc.binary_length(rows["small"]).to_numpy()
            parent = np.arange(len(uid))
            doubt: list[np.ndarray] = []
            for size in np.unique(sized):
                own = np.flatnonzero(sized == size)
                data = b"".join(rows["small"].take(pa.array(own)).to_pylist())
                x = np.frombuffer(data, dtype=np.int8).reshape(-1, size).astype(np.float32) * scale[own][:, None]
                for i, j in near_pairs(group[own]):
                    for s in range(0, len(i), 200_000):
                        p, q = i[s : s + 200_000], j[s : s + 200_000]
                        close = np.einsum("ij,ij->i", x[p], x[q]).astype(np.float64)
                        slack = error[own[p]] + (1 + error[own[p]]) * error[own[q]] + 1e-5
                        p, q, close = own[p], own[q], close - cosine
                        sure, unsure = close >= slack, np.abs(close) < slack
                        parent = connect(parent, p[sure], q[sure])
                        if unsure.any():
                            a, b = uid[p[unsure]], uid[q[unsure]]
                            pairs = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
                            doubt.append(np.unique(pairs[pairs[:, 0] < pairs[:, 1]], axis=0))
            child = np.flatnonzero(parent != np.arange(len(uid)))
            pairs = np.unique(np.concatenate(doubt), axis=0) if doubt else np.empty((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([uid[child], pairs[:, 0]])),
                    pa.array(np.concatenate([uid[parent[child]], pairs[:, 1]])),
                    pa.array(np.arange(len(child) + len(pairs)) < len(child)),
                ],
                ["a", "b", "sure"],
            )

    found = arrow_map(met.select("group", "uid", "small", "scale", "error").repartition("group").sortWithinPartitions("group"), meet, "a long, b long, sure boolean")
    found = write_and_reread(found.groupBy("a", "b").agg(F.max("sure").alias("sure")), "filter-links")
    one = vectors.select(F.col("uid").alias("a"), F.col("embedding").alias("x"))
    two = vectors.select(F.col("uid").alias("b"), F.col("embedding").alias("y"))
    checked = found.filter("NOT sure").join(one, "a").join(two, "b").filter(cosine_of(F.col("x"), F.col("y")) >= cosine)
    return found.filter("sure AND a <> b").select("a", "b").union(checked.select("a", "b"))


def cosine_of(x: Column, y: Column) -> Column:
    """Cosine in double precision; of vectors of different length it is null."""

    def total(v: Column) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda s, p: s + p)

    def doubles(v: Column) -> Column:
        return F.transform(v, lambda p: p.cast("double"))

    products = F.zip_with(doubles(x), doubles(y), lambda p, q: p * q)
    norms = F.sqrt(total(F.transform(doubles(x), lambda p: p * p))) * F.sqrt(total(F.transform(doubles(y), lambda p: p * p)))
    return total(products) / norms


def count_links(members: DataFrame, cosine: float) -> DataFrame:
    """``uid, links`` from ``members(label, uid, copies, embedding)``: copies of the other vectors linked to each.

    All vectors of a component are compared, a large component as pairs of tiles.
    """
    sizes = members.groupBy("label").count()
    tiled = members.join(sizes, "label").withColumn("tiles", F.expr(f"cast(ceil(count / {COUNT_TILE}) as int)"))
    tiled = tiled.withColumn("t", F.expr("cast(pmod(xxhash64(uid), tiles) as int)"))
    tiled = tiled.withColumn("u", F.explode(F.expr("sequence(0, tiles - 1)")))
    met = tiled.select(
        F.xxhash64("label", F.least("t", "u"), F.greatest("t", "u")).alias("group"),
        "label", F.least("t", "u").alias("lo"), F.greatest("t", "u").alias("hi"), "t", "uid", "copies", "embedding",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "group", 2 * COUNT_TILE):
            group, copies = rows["group"].to_numpy(), rows["copies"].to_numpy()
            apart = [rows[c].to_numpy() for c in ("label", "lo", "hi", "t")]
            links = np.zeros(len(group), dtype=np.int64)
            for at, x in unit_rows(rows.combine_chunks().to_batches()[0], "embedding"):
                own = group[at]
                bounds = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
                for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                    mine = at[start:stop]
                    label, lo, hi, t = (v[mine] for v in apart)
                    for s in range(0, len(mine), 512):
                        part = slice(s, s + 512)
                        near = x[start:stop][part] @ x[start:stop].T >= cosine
                        same = (label[part][:, None] == label[None, :]) & (lo[part][:, None] == lo[None, :]) & (hi[part][:, None] == hi[None, :])
                        near &= same & ((t[part][:, None] != t[None, :]) | (lo == hi)[None, :])
                        near[np.arange(near.shape[0]), s + np.arange(near.shape[0])] = False
                        links[mine[part]] += near @ copies[mine]
            yield pa.RecordBatch.from_arrays([rows["uid"].combine_chunks(), pa.array(links)], ["uid", "links"])

    spread = met.repartition("group").sortWithinPartitions("group")
    return arrow_map(spread, count, "uid long, links long").groupBy("uid").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(
    rows: DataFrame, cosine: float = 0.9, words: int | None = None, rotations: int = 3, height: float | None = None, seed: int = 7
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``rows(vec_id, embedding)``.

    Rows whose cosine is at least ``cosine`` are linked; equal vectors are compared once and linked
    with each other. ``n_links`` counts other rows, ``component_id`` is the least ``vec_id`` that links lead
    to, ``kept`` tells whether that is the row's own. Null, empty and zero vectors, vectors with null or
    non-finite components, and vectors of different length are linked with nothing. Null ids are kept and are the
    least only of each other; repeated rows are copies. An empty table gives an empty result.
    """
    plain = rows.select("vec_id", F.when(is_vector(F.col("embedding")), F.col("embedding")).alias("embedding"))
    groups = plain.filter("embedding IS NOT NULL").groupBy("embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    vectors = write_and_reread(groups.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    links = filter_links(vectors, cosine, words, rotations, height, seed)
    labels = components(links).withColumnRenamed("node", "uid")
    members = write_and_reread(vectors.join(labels, "uid"), "components")
    least = members.groupBy("label").agg(F.min("least").alias("component_id"))
    counted = count_links(members, cosine).join(members.select("uid", "label"), "uid").join(least, "label").select("uid", "links", "component_id")
    found = vectors.join(counted, "uid", "left").select(
        "embedding",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # Rows without a usable vector have nothing to look up, and as nulls they would all meet in one task.
    usable = F.col("embedding").isNotNull()
    without = plain.filter(~usable).select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast(dict(plain.dtypes)["vec_id"]).alias("component_id"))
    out = plain.filter(usable).join(found, "embedding").select("vec_id", "n_links", "component_id").unionByName(without)
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
