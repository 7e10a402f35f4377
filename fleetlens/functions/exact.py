"""Sums and rounded means whose digits do not depend on the order rows are added in.

A double column is summed as exact decimals: every value is taken as the decimal
number its text shows (``1.005`` is 1.005, not the binary number just below), cut
into three limbs, and each limb is summed as a decimal with room for 10^10 times
more rows than any table has.  Adding decimals is associative, so partial sums of
any partitioning, retry or row order end in the same bits.

* ``whole``: the part before the decimal point of values below 10^18;
* ``part``: decimals 1 to 18;
* ``fine``: decimals 19 to 36, of values below 0.1 (a larger double has none);
  digits beyond the 36th are rounded away value by value;
* ``wild``: values of 10^18 and more, NaN and infinities, added as doubles.

Integer and decimal columns are exact already and are summed as they are.
``partial_sum`` and ``merged_sum`` are aggregates for two-level sums (per id, then
per group of ids); ``sum_of`` and ``mean_of`` turn their result into numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMBS = ["whole", "part", "fine", "wild"]
WILD = 1e18  # from here on a double is added as a double
FINE = 0.1  # below, a double's text may have more than 18 decimals


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def partial_sum(df: DataFrame, name: str) -> Column:
    """Aggregate: the exact sum of column ``name`` (NULLs skipped), to be merged or read by the functions below."""
    x = F.col(name)
    if not isinstance(_kind(df, name), (T.FloatType, T.DoubleType)):
        return F.sum(x)
    if isinstance(_kind(df, name), T.FloatType):
        x = x.cast("string").cast("double")  # the decimal a float shows, not its binary value widened
    tame = F.abs(x) < WILD
    value = F.when(tame, x)
    integer = value.cast("bigint")
    rounded = value.cast("decimal(37,18)")
    small = F.when(F.abs(x) < FINE, x)
    fine = small.cast("decimal(37,36)") - small.cast("decimal(37,18)").cast("decimal(37,36)")
    return F.struct(
        F.sum(integer.cast("decimal(28,0)")).alias("whole"),
        F.sum(rounded - integer.cast("decimal(37,18)")).alias("part"),
        F.sum(fine).alias("fine"),
        F.sum(F.when(~tame, x)).alias("wild"),
    )


def merged_sum(df: DataFrame, name: str) -> Column:
    """Aggregate: the sum of partial sums held in column ``name``."""
    if not isinstance(_kind(df, name), T.StructType):
        return F.sum(name)
    return F.struct(*(F.sum(F.col(name)[limb]).alias(limb) for limb in LIMBS))


def _number(total: Column, limbs: bool) -> tuple[Column, Column]:
    """(the sum as a decimal, NULL where it is none; the sum as a double)."""
    if not limbs:
        return total.try_cast("decimal(38,18)"), total.cast("double")
    fine = F.coalesce(total["fine"], F.lit(0)).cast("decimal(38,36)")
    # NULL where the whole part needs more than 19 digits
    exact = (total["whole"].try_cast("decimal(37,18)") + total["part"]).cast("decimal(38,18)")
    as_double = F.coalesce(exact.cast("double"), total["whole"].cast("double") + total["part"].cast("double"))
    as_double = as_double + fine.cast("double")
    double = F.when(total["wild"].isNull(), as_double).otherwise(total["wild"] + F.coalesce(as_double, F.lit(0.0)))
    return F.when(total["wild"].isNull(), exact + fine.cast("decimal(37,18)")), double


def sum_of(df: DataFrame, name: str) -> Column:
    """The number of a sum held in column ``name`` of ``df``, as double."""
    return _number(F.col(name), isinstance(_kind(df, name), T.StructType))[1]


def mean_of(df: DataFrame, name: str, count: str | Column, digits: int) -> Column:
    """Sum in column ``name`` of ``df`` over ``count``, rounded half away from zero at ``digits`` decimals, as double.

    The quotient is a decimal of at least 16 places, so a mean of 1.005 rounds to 1.01 at two digits.
    """
    exact, double = _number(F.col(name), isinstance(_kind(df, name), T.StructType))
    n = F.col(count) if isinstance(count, str) else count
    quotient = F.try_divide(exact, n.cast("decimal(20,0)"))
    return F.coalesce(F.round(quotient, digits).cast("double"), F.round(F.try_divide(double, n), digits))


def means_by(df: DataFrame, keys: list[str], means: dict[str, tuple[str, int]], **other: Column) -> DataFrame:
    """Per group of ``keys``: the aggregates ``other``, then the rounded means ``{out: (column, digits)}``."""
    sums = {f"__{out}_sum": partial_sum(df, c) for out, (c, _) in means.items()}
    counts = {f"__{out}_n": F.count(c) for out, (c, _) in means.items()}
    grouped = df.groupBy(*keys).agg(*(c.alias(n) for n, c in (other | sums | counts).items()))
    return grouped.select(
        *keys, *other, *(mean_of(grouped, f"__{out}_sum", f"__{out}_n", d).alias(out) for out, (_, d) in means.items())
    )
