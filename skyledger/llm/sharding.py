"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes, groups of equal texts kept whole."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import buckets_for, hash_key, running_total
from skyledger.session import write_and_reread

#: Texts whose copies together hold at least 1/UNITS of all bytes are units of their own; the
#: others are hashed into as many units. So there are at most 2 * UNITS units, at any corpus size.
UNITS = 16384


def differencing(sizes: list[int], shards: int) -> list[int]:
    """Shard of each size, by Karmarkar-Karp differencing.

    A partial partition has ``shards`` subsets. The two of largest spread (greatest minus least
    sum) are merged, the heaviest subset of one with the lightest of the other, until one is
    left. Ties go by position, so the result is a function of the list.
    """
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [(0, [])] * (shards - 1) + [(size, [i])]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, first, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = sorted(
            ((x + y, [p, q]) for (x, p), (y, q) in zip(a, reversed(b), strict=True)), key=lambda subset: subset[0]
        )
        least = merged[0][0]
        heapq.heappush(heap, (least - merged[-1][0], first, merged))
    shard = [0] * len(sizes)
    if heap:
        for number, (_, members) in enumerate(heap[0][2]):
            stack = [members]
            while stack:
                for x in stack.pop():
                    if isinstance(x, list):
                        stack.append(x)
                    else:
                        shard[x] = number
    return shard


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs(doc_id, text)``.

    ``size`` is the text's UTF-8 bytes plus 1. Rows of equal text form a group, which stays in
    one shard. Groups are the things that differencing deals out; groups smaller than 1/16384
    of all bytes are first hashed into that many units, so that the driver sees at most 32768
    sizes. ``slot`` numbers each shard's rows from 0 without a gap, in hash order. ``law`` is
    ``bytes``; ``grown_shard`` is null.

    A null text has size 1 and is a group apart from the empty text; a null ``doc_id`` is kept;
    repeated rows get slots of their own; an empty table gives an empty result.
    """
    text = F.col("text")
    rows = write_and_reread(
        docs.select(
            "doc_id",
            text_bytes(text).alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.when(text.isNull(), F.lit("null")).otherwise(F.md5(text.cast("binary"))).alias("group"),
            hash_key(F.col("doc_id"), F.octet_length(text)).alias("key"),
        ),
        "shard-rows",
    )
    groups = write_and_reread(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    pooled = F.concat(F.lit("unit"), F.pmod(F.xxhash64("group"), F.lit(UNITS)))
    named = groups.withColumn("unit", F.when(F.col("bytes") * UNITS >= total, F.col("group")).otherwise(pooled))
    units = named.groupBy("unit").agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), "unit").collect()
    dealt = differencing([u.bytes for u in units], shards)
    map_rows = [(u.unit, s) for u, s in zip(units, dealt, strict=True)]
    shard_of_unit = docs.sparkSession.createDataFrame(map_rows, "unit string, shard int")
    shard_of = named.join(F.broadcast(shard_of_unit), "unit").select("group", "shard")  # at most 2 * UNITS rows
    placed = write_and_reread(rows.join(shard_of, "group").drop("group"), "shard-placed")
    slots = running_total(placed, ["shard"], "key", ["doc_id", "text_crc32"], F.lit(1), buckets_for(count), "slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
