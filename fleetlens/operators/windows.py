"""Window operators: top-n per group, rolling means and running totals.

A window with no PARTITION BY sends every row to one task.  The ``*_single``
functions keep that plain form only as the equality oracle of the tests;
registered queries use the distributed forms:

1. range-partition the rows on the full (tie-broken) order, sort inside each
   partition and stamp each row with ``monotonically_increasing_id`` (partition
   id in the high bits, position in the low 33 bits); a reliable checkpoint pins
   the sampled range bounds and the ids, so a lost executor recomputes nothing
   inconsistent;
2. per-partition totals (one row per partition, at most ``partitions`` rows)
   give each partition its offset through a small window, broadcast back;
3. the per-row work is then a window partitioned by range partition (running
   total) or by fixed-size row blocks carrying a halo of the previous block's
   last rows (rolling frame).

No step sees more than one range partition or block of rows, whatever the
input size, and the order must be total (tie-break columns) for the result
to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.session import ensure_checkpoint_dir

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def top_n_per_group(df: DataFrame, group: str, order_col: str, n: int = 3, rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``<= n`` by ``order_col`` descending within ``group``.

    ``rank`` gives ties the same rank, so more than ``n`` rows can come back.
    Spark inserts a partial ``WindowGroupLimit`` before the shuffle, so a hot
    group ships at most its top rows per input partition.
    """
    w = Window.partitionBy(group).orderBy(F.desc(order_col))
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= n)


def rolling_mean_single(df: DataFrame, order: list, value: str, out: str, rows: int = 7, digits: int = 0) -> DataFrame:
    """Mean of ``value`` over the current and previous ``rows - 1`` rows (plain global window)."""
    w = Window.orderBy(*order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.round(F.avg(value).over(w), digits))


def running_total_single(df: DataFrame, order: list, value: str, out: str = "running_total") -> DataFrame:
    """Cumulative sum of ``value`` in ``order`` (plain global window)."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def _sort_key(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_indexed(df: DataFrame, order: list, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``order``, with ``_part`` and ``_pos`` columns.

    ``_part`` is the range partition, ``_pos`` the 0-based position inside it.
    Without ``partitions`` the count comes from AQE (the shuffle-partition
    setting, coalesced to the advisory size by merging adjacent, so still
    contiguous, ranges).  The result is checkpointed to the shared checkpoint
    directory.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [_sort_key(c) for c in order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    stamped = (
        ranged
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    return stamped.withColumns(
        {
            "_part": F.shiftright(F.col("_mid"), _POS_BITS).cast("int"),
            "_pos": F.col("_mid").bitwiseAND(F.lit(_POS_MASK)),
        }
    ).drop("_mid")


def _partition_offsets(indexed: DataFrame, value: str | None) -> DataFrame:
    """Per range partition: rows and sum before it (a table of at most ``partitions`` rows)."""
    aggs = [F.count("*").alias("_rows")]
    if value is not None:
        aggs.append(F.sum(value).alias("_sum"))
    totals = indexed.groupBy("_part").agg(*aggs)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cols = {"_row_offset": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
    if value is not None:
        cols["_sum_offset"] = F.sum("_sum").over(before)  # NULL while no value came before
    cols["_all_rows"] = F.sum("_rows").over(Window.partitionBy())
    cols["_parts"] = F.count("*").over(Window.partitionBy())
    return totals.withColumns(cols).drop("_rows", "_sum")


def running_total(
    df: DataFrame, order: list, value: str, out: str = "running_total", partitions: int | None = None
) -> DataFrame:
    """Cumulative sum of ``value`` in ``order``, computed without a single-task window."""
    indexed = range_indexed(df, order, partitions)
    offsets = F.broadcast(_partition_offsets(indexed, value).select("_part", "_sum_offset"))
    local = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        indexed.join(offsets, "_part")
        .withColumn("_local", F.sum(value).over(local))
        # either side is NULL while it has seen no value, as in one window over everything
        .withColumn(out, F.coalesce(F.col("_local") + F.col("_sum_offset"), "_local", "_sum_offset"))
        .drop("_part", "_pos", "_sum_offset", "_local")
    )


def rolling_mean(
    df: DataFrame,
    order: list,
    value: str,
    out: str,
    rows: int = 7,
    digits: int = 0,
    partitions: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Mean over the current and previous ``rows - 1`` rows in ``order``, distributed.

    Rows get a global 1-based number ``rn`` from the partition offsets and
    fall into blocks of ``block_rows`` consecutive numbers (default: the input
    spread evenly over the range partitions, at least ``rows``).  The last
    ``rows - 1`` rows of each block are copied into the next block as a halo,
    so every frame lies inside one block; halo copies are dropped afterwards.
    """
    k = rows - 1
    if block_rows is not None and block_rows < max(k, 1):
        raise ValueError(f"block_rows must be at least rows - 1 = {k}: a frame may only reach one block back")
    indexed = range_indexed(df, order, partitions)
    offsets = _partition_offsets(indexed, None)
    if block_rows:
        block = F.lit(int(block_rows)).cast("bigint")
    else:
        block = F.greatest(F.lit(max(k, 1)).cast("bigint"), F.ceil(F.col("_all_rows") / F.col("_parts")))
    offsets = F.broadcast(offsets.withColumn("_block_rows", block).select("_part", "_row_offset", "_block_rows"))
    numbered = (
        indexed.join(offsets, "_part")
        .withColumn("_rn", F.col("_pos") + F.col("_row_offset") + 1)
        .withColumn("_block", F.floor((F.col("_rn") - 1) / F.col("_block_rows")))
    )
    in_tail = F.pmod(F.col("_rn") - 1, F.col("_block_rows")) >= F.col("_block_rows") - k
    shifted = numbered.withColumn(
        "_shift", F.explode(F.when(in_tail & F.lit(k > 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).withColumn("_block", F.col("_block") + F.col("_shift"))
    frame = Window.partitionBy("_block").orderBy("_rn").rowsBetween(-k, 0)
    return (
        shifted.withColumn(out, F.round(F.avg(value).over(frame), digits))
        .filter(F.col("_shift") == 0)
        .drop("_part", "_pos", "_row_offset", "_block_rows", "_rn", "_block", "_shift")
    )
