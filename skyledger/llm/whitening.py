"""Whitened principal components of vectors by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred rows, the process alternates products ``u = X v`` and ``X' u`` and keeps both families of
vectors orthonormal, so that ``X V = U B`` with a small bidiagonal B; the singular values and right vectors of B are those of X.

X is never collected and u never leaves its tasks. Each left vector is ``X z`` for a short z, so a pass over the rows gets z,
forms ``X z`` row by row and adds up its square and ``X' (X z)``. The inner products of a new left vector with all earlier ones are
those of their short vectors with ``X' u``, so reorthogonalising the left family in full costs no pass of its own; the right family is
short itself. What the driver holds is a few vectors as long as a row for each step, and there are at most as many steps as components in a row.

Components are integers and so are their sums; ``n x - S`` is exact and divided once, so centring loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map
from skyledger.llm.vectors import block, floored, whole_vectors
from skyledger.session import write_and_reread

#: Steps taken at the least before convergence can end the process early.
LEAST_STEPS = 64
#: A vector this small beside the largest singular value counts as zero: its square is lost beside the largest eigenvalue in double precision.
TINY = 1e-8


def _sums(length: int):
    """Number of rows at component -1, sum of each component after it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length + 1, dtype=np.int64)
        for batch in batches:
            rows = block(batch["x"], length)
            total[0] += len(rows)
            total[1:] += rows.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, length, dtype=np.int32)), pa.array(total)], ["component", "total"])

    return add


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * rows - sums) / n


def _products(n: int, sums: np.ndarray, z: np.ndarray):
    """Square of ``u = X z`` at component -1, ``X' u`` after it."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(z) + 1)
        for batch in batches:
            x = _centred(block(batch["x"], len(z)), n, sums)
            u = x @ z
            total[0] += u @ u
            total[1:] += u @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(z), dtype=np.int32)), pa.array(total)], ["component", "total"])

    return multiply


def _added(kept: DataFrame, function, kind: str) -> np.ndarray:
    found = arrow_map(kept.select("x"), function, f"component int, total {kind}").groupBy("component").agg(F.sum("total").alias("total"))
    return np.array([r.total for r in sorted(found.collect())])


def bidiagonalise(product, length: int, wanted: int, least_steps: int = LEAST_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Largest singular values, falling, and right singular vectors (as columns) of the X that ``product`` stands for.

    ``product(z)`` returns the square of ``X z`` and ``X' X z``. Values that are zero beside the largest are left out.
    Where a family can't be continued, a new direction orthogonal to all so far is taken, so repeated singular values are found too.
    All directions lie in the row space, as those outside it would grow in the short vectors.
    """
    random = np.random.default_rng(7)
    right, short, image = (np.zeros((length, 0)) for _ in range(3))  # V, Z with U = X Z, and X' U
    diagonal, above = [], []
    largest = 0.0

    def free() -> np.ndarray | None:
        """A new direction among those that X doesn't send to zero; None if there is none left."""
        v = random.normal(size=length)
        v -= right @ (right.T @ v)
        v = product(v / np.linalg.norm(v))[1]
        before = max(np.linalg.norm(v), largest**2)
        for _ in range(2):
            v -= right @ (right.T @ v)
        size = np.linalg.norm(v)
        return v / size if size > TINY * before else None

    v, beta = free(), 0.0
    if v is None:
        return np.zeros(0), np.zeros((length, 0))
    while True:
        right = np.column_stack([right, v])
        z = v - beta * short[:, -1] if beta else v.copy()
        square, g = product(z)
        for _ in range(2):
            h = short.T @ g
            if square > 0 and np.abs(h).max(initial=0) > 1e-8 * square**0.5:  # not round-off: multiply again
                z = z - short @ h
                square, g = product(z)
            else:
                z, g = z - short @ h, g - image @ h
        alpha = square**0.5
        largest = max(largest, alpha, beta)
        if alpha <= TINY * largest or not alpha:
            alpha, z, g = 0.0, np.zeros(length), np.zeros(length)
        else:
            z, g = z / alpha, g / alpha
        short, image = np.column_stack([short, z]), np.column_stack([image, g])
        diagonal.append(alpha)
        steps = len(diagonal)
        small = np.diag(diagonal) + np.diag(above, 1)
        left, values, turned = np.linalg.svd(small)
        if steps == length:
            break
        w = g - alpha * v
        for _ in range(2):
            w -= right @ (right.T @ w)
        beta = float(np.linalg.norm(w))
        # What a step more can change of a wanted triple is beta times its last left entry.
        if steps >= max(least_steps, wanted) and (beta * np.abs(left[-1, :wanted]) <= 1e-15 * values[0]).all():
            break
        if not alpha or beta <= TINY * largest:
            v, beta = free(), 0.0
            if v is None:
                break
        else:
            v = w / beta
        above.append(beta)
    kept = values[:wanted] > TINY * max(largest, 1e-300)
    return values[:wanted][kept], (right @ turned.T)[:, :wanted][:, kept]


def _squares(rows: np.ndarray) -> pa.Array:
    """Exact sum of squares of each row, however large."""
    reach = int(np.abs(rows).max(initial=0))
    if reach * reach * rows.shape[1] < 1 << 63:
        return pa.array((rows * rows).sum(1)).cast(pa.decimal128(38, 0))
    parts = [np.abs(rows) & 0xFFFFF, np.abs(rows) >> 20 & 0xFFFFF, np.abs(rows) >> 40]  # 20 bits each, so that sums of products fit
    total = np.zeros(len(rows), dtype=object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a * b).sum(1).astype(object) << 20 * (i + j)
    return pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))


def _whitened(n: int, sums: np.ndarray, project: np.ndarray):
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = n * block(batch["x"], len(sums)) - sums
            made = rows / n @ project
            lists = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], _squares(rows), lists], ["vec_id", "deviation", "whitened"])

    return whiten


def whiten_vectors(
    vectors: DataFrame, vector: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000
) -> tuple[DataFrame, dict]:
    """``vec_id, deviation, whitened`` of each whole vector, and the model.

    The rows are ``floor(scale * x) + shift``. ``whitened`` has a row's centred projections on the first ``components`` eigenvectors of
    the covariance, each over the root of its eigenvalue; ``deviation`` is the exact sum of ``(n x - S)^2``, a decimal. The model has ``n``, ``sums``,
    ``eigenvalues`` (falling), ``eigenvectors`` (columns), ``explained`` (shares of the trace) and ``identity_error``, the largest
    difference between the covariance of ``whitened`` and the identity.

    Rows whose vector is null, empty, shorter than the longest or holds null or non-finite components are dropped. Null and repeated vec_ids and
    equal rows stay, each on its own. Eigenvectors whose eigenvalue is zero are left out, as nothing can be whitened by them: equal vectors, a single one or none at
    all give no components. Too large a component ends the job. Only ``vec_id`` and the vector are read.
    """
    whole, length = whole_vectors(vectors.select("vec_id", F.col(vector).alias("x")), "x")
    numbers = whole.withColumn("x", F.transform(floored("x", scale, 2.0**40), lambda x: x + shift))
    kept = write_and_reread(numbers, "vectors")
    nothing = kept.select("vec_id").limit(0)
    none = nothing.withColumns({"deviation": F.lit(None).cast("decimal(38,0)"), "whitened": F.lit(None).cast("array<double>")})
    model = {"n": 0, "sums": [], "eigenvalues": [], "eigenvectors": np.zeros((length, 0)), "explained": [], "identity_error": 0.0}
    if not length:
        return none, model
    n, *totals = (int(t) for t in _added(kept, _sums(length), "long"))
    reach = kept.agg(F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()[0]
    if n * reach >= 1 << 59:
        raise OverflowError(f"{n} vectors with components up to {reach}: n x - S doesn't fit")
    sums = np.array(totals, dtype=np.int64)

    def product(z: np.ndarray) -> tuple[float, np.ndarray]:
        found = _added(kept, _products(n, sums, z), "double")
        return float(found[0]), found[1:]

    values, basis = bidiagonalise(product, length, min(components, length))
    if not len(values):
        return none, model | {"n": n, "sums": totals}
    eigenvalues = values**2 / n
    project = basis / np.sqrt(eigenvalues)
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>"
    made = write_and_reread(arrow_map(kept, _whitened(n, sums, project), schema), "whitened")
    trace = int(made.agg(F.sum("deviation")).first()[0]) / n**3
    model |= {"n": n, "sums": totals, "eigenvalues": eigenvalues, "eigenvectors": basis, "explained": eigenvalues / trace}
    return made, model | {"identity_error": _identity_error(made, len(values))}


def _identity_error(made: DataFrame, components: int) -> float:
    """Largest difference between the covariance of ``whitened``, centred first, and the identity."""
    w = [F.col("whitened")[i] for i in range(components)]
    means = made.agg(*[F.avg(x) for x in w]).first()
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    found = made.agg(*[F.avg((w[i] - means[i]) * (w[j] - means[j])) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def whitened_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each vector and component up to 8."""
    made, model = whiten_vectors(vectors, components=8)
    explained = F.array(*[F.lit(float(x)) for x in model["explained"]]).cast("array<double>")
    rows = made.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model["n"]).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(model["identity_error"])).alias("identity_error"),
    )
