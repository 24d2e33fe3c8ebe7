"""Helpers shared by the operators: words, distributed running totals, connected components."""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import write_and_reread

#: A word is a run of anything but ASCII white space. ``bytes.split()`` splits at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the workers, which need not have it installed."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_skyledger_sent", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="run-")) / "skyledger.zip"  # on the driver, which serves it
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._skyledger_sent = True
    return df.mapInArrow(function, schema)


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(*parts: Column) -> Column:
    """A hash-random order: the first 60 bits of an MD5 as a long. Nulls count as empty text.

    Engines agree on MD5, so the order can be checked outside Spark.
    """
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def buckets_for(rows: int) -> int:
    """Square root of the rows: neither a bucket nor a list of buckets grows faster than that."""
    return max(1, math.isqrt(rows))


def running_total(
    df: DataFrame, groups: list[str], key: str, ties: list[str], value: Column, buckets: int, out: str
) -> DataFrame:
    """Sum of ``value`` over the rows before each row in its group, ordered by ``key`` and ``ties``.

    The range of the hash keys is cut into equal buckets. Bucket totals give each bucket's
    start, and a window inside the bucket the rest, so no task holds a whole group however
    many rows it has. ``groups`` must hold no nulls. ``df`` is read twice: pass a written table.
    """
    width = 2**KEY_BITS // buckets + 1
    df = df.withColumn("_bucket", F.expr(f"{key} div {width}L")).withColumn("_value", value)
    at = [*groups, "_bucket"]
    totals = df.groupBy(*at).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*at, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*at).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, at)
        .withColumn(out, (F.col("_start") + F.coalesce(F.sum("_value").over(inside), F.lit(0))).cast("long"))
        .drop("_bucket", "_value", "_start")
    )


def with_key_total(df: DataFrame, key: str, value: str, out: str, most: int = 1024) -> DataFrame:
    """Each row with the sum of ``value`` over the rows of equal ``key``, nulls together.

    Keys with more than one in ``most`` of all rows, of which there are fewer than ``most``, are looked up in a small
    table; the rows of the others meet their sum by a shuffle, in which no key is heavy. ``df`` is read several times: pass a written table.
    """
    totals = write_and_reread(df.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(out), F.count(F.lit(1)).alias("_rows")), "totals")
    rows = totals.agg(F.sum("_rows")).first()[0] or 0
    heavy = totals.filter(F.col("_rows") * most > rows)
    light = totals.filter(F.col("_rows") * most <= rows)
    by_key = F.col(key).eqNullSafe(F.col("_key"))
    looked_up = df.join(F.broadcast(heavy), by_key, "left")
    others = looked_up.filter(F.col("_rows").isNull()).select(*df.columns)
    met = others.join(light, by_key).drop("_key", "_rows")
    return looked_up.filter(F.col("_rows").isNotNull()).drop("_key", "_rows").unionByName(met)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table that ``scratch_folder`` gave the path of and that nothing will read again."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def numbered(df: DataFrame, order: Column, out: str) -> DataFrame:
    """Position from 0 along ``order`` over all rows, without one task that sees them all.

    The rows are range-sorted into a written table; the sizes of its partitions give
    each partition's first position.
    """
    sorted_rows = write_and_reread(df.orderBy(order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = sorted_rows.groupBy("_part").count()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return (
        sorted_rows.withColumn("_inside", inside)
        .join(starts, "_part")
        .withColumn(out, (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_part", "_inside", "_start")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: ``(node, label)``, label the least node.

    Each round hangs every node below the least of itself and its neighbours, jumps to the roots of the trees
    that this makes, and goes on with the links between roots until none is left. A root that has won no node is next
    to a lower one in the next round, so two rounds at least halve the nodes, and a tree's depth is halved by
    each jump: rounds grow with the logarithm of a component's size, whatever its shape.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = write_and_reread(links, "edges")
    levels: list[DataFrame] = []
    while not levels or not links.isEmpty():
        both = links.union(links.select("b", "a"))
        roots = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
        roots = _to_roots(write_and_reread(roots, "labels"))
        levels.append(roots)
        for end in ("a", "b"):
            links = links.join(roots.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("label", end)
        links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        links = write_and_reread(links, "edges")
    labels = levels.pop()
    while levels:
        labels = write_and_reread(_follow(levels.pop(), labels).drop("old"), "labels")
    return labels


def _follow(labels: DataFrame, further: DataFrame) -> DataFrame:
    """``node, label, old``: each label replaced by its own in ``further``, if it has one there."""
    step = further.select(F.col("node").alias("old"), F.col("label").alias("far"))
    return labels.withColumnRenamed("label", "old").join(step, "old", "left").select("node", F.coalesce("far", "old").alias("label"), "old")


def _to_roots(labels: DataFrame) -> DataFrame:
    """Labels of labels until nothing changes."""
    while True:
        found = write_and_reread(_follow(labels, labels), "labels")
        labels = found.select("node", "label")
        if found.filter("label <> old").isEmpty():
            return labels
