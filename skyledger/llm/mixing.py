"""Mixing sources to target weights.

Each source gets a token budget. Its documents are put in hash-random order, distributed
running totals of their sizes are taken along that order, and the source is cut exactly at
its budget; a source whose budget exceeds its size starts over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import buckets_for, hash_key, numbered, running_total, word_count
from skyledger.session import write_and_reread


def source_targets(
    sources: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0
) -> DataFrame:
    """Add ``sid`` and ``target`` to ``sources(source, source_size)``, one row per source.

    Sources in code-point order, null last, take the weights in turn and share
    ``share`` x the total size in proportion. No target exceeds ``epochs`` x its source's size:
    what is cut off goes to the others by weight, until none is above. A source of size 0 gets 0.
    """
    ranked = numbered(sources.select("source", "source_size"), F.col("source").asc_nulls_last(), "sid")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = write_and_reread(
        ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(epochs))), "sources"
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, 0.0
    while True:  # each turn caps at least one more source; two sums come to the driver
        over = F.col("cap") <= F.col("weight") * level
        capped, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not open_weight:
            break
        raised = (budget - capped) / open_weight
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return ranked.select("sid", "source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 1,
    with_rows: bool = False,
) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs`` needs ``doc_id``, ``text``, ``source``. Returns one row per row of ``docs``:
    ``doc_id, size, source_size, target, taken``, and with ``with_rows`` the whole row of ``docs``
    as the struct ``row``. ``taken`` is the size times the whole epochs of the source, plus what the
    last, partial epoch takes of the document; only the document at the cut is taken in part. So
    the words taken of a source are its target, rounded to a whole word.

    The order is a hash of ``seed``, ``doc_id`` and text, so reruns agree. Repeated rows share
    a place in the order and are counted one after the other. Null or empty texts have size 0
    and are never taken; a null source is a source of its own; a null ``doc_id`` is kept; an
    empty table gives an empty result.
    """
    rows = write_and_reread(
        docs.select(
            "doc_id",
            F.col("source").alias("from"),
            word_count(F.col("text")).alias("size"),
            hash_key(F.lit(seed), F.col("doc_id"), F.col("text")).alias("key"),
            *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if with_rows else []),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy(F.col("from").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = write_and_reread(sizes, "mix-sizes")
    count = sizes.agg(F.sum("n")).first()[0] or 0
    targets = write_and_reread(source_targets(sizes, weights, share, epochs), "mix-targets")
    matched = rows.join(targets, F.col("from").eqNullSafe(F.col("source"))).drop("from", "source")
    placed = running_total(matched, ["sid"], "key", ["doc_id"], F.col("size"), buckets_for(count), "before")
    goal = F.least(F.round("target").cast("long"), (F.col("source_size") * F.lit(float(epochs))).cast("long"))
    whole = F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0))
    rest = F.col("goal") - F.col("whole") * F.col("source_size") - F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return (
        placed.withColumn("goal", goal)
        .withColumn("whole", whole)
        .withColumn("taken", (F.col("whole") * F.col("size") + part).cast("long"))
        .select("doc_id", "size", "source_size", "target", "taken", *(["row"] if with_rows else []))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per epoch that takes something of a document.

    A document at a cut keeps only the words that the mix takes, with the white space between
    them; ``n_chars``, if there is one, is counted anew for it.
    """
    taken = mix_sources(docs, **options, with_rows=True).filter("taken > 0")
    epochs = taken.withColumn("epoch", F.explode(F.expr("sequence(0L, (taken - 1) div size)")))
    epochs = epochs.withColumn("words", F.least("size", F.col("taken") - F.col("epoch") * F.col("size")))
    whole = F.col("words") == F.col("size")
    epochs = epochs.withColumn("cut", F.when(~whole, first_words(F.col("row.text"), F.col("words"))))
    value = {c: F.col("row").getField(c) for c in docs.columns}
    value["text"] = F.when(whole, value["text"]).otherwise(F.col("cut"))
    if "n_chars" in value:
        value["n_chars"] = F.when(whole, value["n_chars"]).otherwise(F.length("cut").cast(docs.schema["n_chars"].dataType))
    return epochs.select(*[value[c].alias(c) for c in docs.columns])


def first_words(text: Column, count: Column) -> Column:
    """The text's first ``count`` words as they stand."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")
