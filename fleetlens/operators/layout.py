"""Partition layout: hash layouts by a key, rows per partition, key skew reports.

A hash layout on a key puts every row of one key value into one task; when
one value holds a large share of the rows that task runs for the whole stage.
:func:`key_skew` measures that from the key's row counts (a partial
aggregate, so the measurement itself is not skewed) before anyone commits to
the layout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_layout(df: DataFrame, n: int, key: str, sort_by: list[str] | None = None) -> DataFrame:
    """``df`` hash-partitioned into ``n`` partitions by ``key``, optionally sorted inside each."""
    out = df.repartition(n, key)
    return out.sortWithinPartitions(*sort_by) if sort_by else out


def rows_per_partition(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows in each of the ``n`` partitions of ``df`` (``partition``, ``rows``), empty ones as 0.

    Pass ``n`` when it is known (e.g. the count given to :func:`hash_layout`);
    otherwise it is read from the DataFrame's current partitioning.
    """
    spark = df.sparkSession
    n = n if n is not None else df.rdd.getNumPartitions()
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
    every = spark.range(n).select(F.col("id").cast("int").alias("partition"))
    return (
        every.join(counts, "partition", "left")
        .select("partition", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))
        .orderBy("partition")
    )


def partitions_per_key(df: DataFrame, key: str) -> DataFrame:
    """Per value of ``key``: its rows and the number of partitions of ``df`` that hold any (1 in a layout by that key)."""
    held = df.groupBy(key, F.spark_partition_id().alias("__partition")).agg(F.count("*").alias("__n"))
    return held.groupBy(key).agg(F.sum("__n").alias("rows"), F.count("*").alias("partitions"))


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """One-row skew report of ``key``: distinct values (NULL counts), rows, largest, median, shares."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.lit(key).alias("key_name"),
        F.count("*").alias("keys"),
        F.sum("n").cast("bigint").alias("rows"),
        F.max("n").alias("max_rows"),
        F.median("n").alias("median_rows"),
    ).withColumns(
        {
            "max_share": F.col("max_rows") / F.col("rows"),
            "max_to_median": F.col("max_rows") / F.col("median_rows"),
        }
    )


def layout_skew(df: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`key_skew` for each candidate layout key, one row per key."""
    return reduce(DataFrame.unionByName, [key_skew(df, k) for k in keys])
