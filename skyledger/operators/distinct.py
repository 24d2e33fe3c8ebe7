"""Distinct rows by way of their digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import write_and_reread

DIGEST = "_digest"
#: Digests that repeat up to which they are sent to every task: 8 MB of them.
MOST_REPEATED = 1_000_000


def distinct_by_digest(df: DataFrame, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """One of each set of equal rows, over all columns, shuffling eight bytes for a row that has no equal.

    A row whose 64-bit digest no other row has is certainly distinct, so it goes on from where it was read. Only rows that share a
    digest, which are those with copies and hardly any others, are shuffled and compared whole; their copies meet inside the
    tasks first, as do equal digests. Two different rows of one digest are both kept.

    The rows are written once with their digests. Counting reads the digests only, and what follows reads of the distinct rows
    the columns that it needs. If more than ``most_repeated`` digests repeat, as in a table where everything stands twice, the rows
    are compared whole at once, as ``dropDuplicates`` does: telling them apart first would save nothing.
    """
    columns = df.columns
    marked = write_and_reread(df.withColumn(DIGEST, F.xxhash64(*columns)), "digests")
    repeated = marked.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(DIGEST)
    repeated = write_and_reread(repeated, "repeated")
    if repeated.count() > most_repeated:
        return marked.select(*columns).dropDuplicates()
    few = F.broadcast(repeated)
    alone = marked.join(few, DIGEST, "left_anti").select(*columns)
    copies = marked.join(few, DIGEST, "left_semi").select(*columns).dropDuplicates()
    return alone.union(copies)
