"""Distinct months as a bit set.

``collect_set`` on millions of rows runs in the object aggregate, which sorts its input
once a task sees more than 128 groups. A bit per month keeps the large aggregation in the
hash aggregate; the set is unpacked afterwards, on one row per group. A long holds the
months of one block of 32 numbers; calendar months all fall into block 0, and a month
number outside it is kept in a block of its own rather than lost.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLOCK_BITS = 5
BLOCK = 1 << BLOCK_BITS


def month_block(month: Column) -> Column:
    """Number of the block a month belongs to (0 for NULL, which sets no bit)."""
    return F.coalesce(F.shiftright(month, BLOCK_BITS), F.lit(0))


def month_bits(month: Column) -> Column:
    """Aggregate: one bit for every month of the block that occurs."""
    one = F.lit(1).cast("bigint")
    return F.bit_or(F.call_function("shiftleft", one, month.bitwiseAND(F.lit(BLOCK - 1))))


def months_from_bits(block: Column, bits: Column) -> Column:
    """The months of one block as an ascending int array."""
    known = F.coalesce(bits, F.lit(0).cast("bigint"))
    slots = F.sequence(F.lit(0), F.lit(BLOCK - 1))
    present = F.filter(slots, lambda slot: F.call_function("getbit", known, slot) == 1)
    return F.transform(present, lambda slot: (block * F.lit(BLOCK) + slot).cast("int"))


def months_text(months: Column) -> Column:
    """Months as text in text order: ``1,10,2``."""
    return F.array_join(F.array_sort(F.transform(months, lambda month: month.cast("string"))), ",")
