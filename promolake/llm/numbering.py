"""Positions within groups without a task that sees a whole group.

Rows are dealt by ranges of (group, order), so a large group takes many partitions; each partition numbers its own rows, and a
table of one row a partition and group carries the counts that stand before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shelf


def numbered(shelf: Shelf, df: DataFrame, group: str, *order: str) -> DataFrame:
    """df with pos (0, 1, ... within the group by `order`, nulls first) and n (rows of the group), both long.

    `df` should be a written table, as dealing by ranges reads it twice.  `group` is never null.  Rows that are equal in `order`
    get positions in the order in which they were read; such rows, however many, are dealt over several partitions as well."""
    keys = [F.col(group), *[F.col(c).asc_nulls_first() for c in order], F.col("n_read")]
    own = df.withColumn("n_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("n_read")
    t = shelf.put(own.withColumns({"n_part": F.spark_partition_id(), "n_row": F.monotonically_increasing_id()}), "dealt")
    before = Window.partitionBy(group).orderBy("n_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = t.groupBy(group, "n_part").agg(F.count("*").alias("n_here"), F.min("n_row").alias("n_first"))
    counts = shelf.put(counts.withColumns({"n_before": F.coalesce(F.sum("n_here").over(before), F.lit(0)), "n": F.sum("n_here").over(Window.partitionBy(group))}), "counts")
    out = t.join(counts, [group, "n_part"])
    return out.withColumn("pos", F.col("n_row") - F.col("n_first") + F.col("n_before")).select(*df.columns, "pos", "n")
