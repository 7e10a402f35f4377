"""Data-quality rules: fail fast, count, or quarantine.

A rule is a named boolean Column that is TRUE for a bad row.  Counting and
quarantining are one narrow pass each (``count_if`` per rule in a single
aggregate; a filter), so they cost one scan however many rules there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trip_rules(max_fare: float = 900) -> dict[str, Column]:
    """Default rules for trips; ``max_fare`` is the fare above which a row looks wrong."""
    return {
        "fare_over_limit": F.col("fare_amount") > max_fare,
        "non_positive_fare": F.col("fare_amount") <= 0,
        "non_positive_total": F.col("total_amount") <= 0,
        "non_positive_distance": F.col("trip_distance") <= 0,
        "dropoff_before_pickup": F.col("dropoff_ts") < F.col("pickup_ts"),
        "missing_payment": F.col("payment_type").isNull(),
    }


def quality_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Per rule: bad rows (rule TRUE) and all rows, from one aggregate pass."""
    wide = df.agg(F.count("*").alias("rows"), *[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return wide.unpivot("rows", list(rules), "rule", "bad_rows").select("rule", "bad_rows", "rows")


def violations(rules: dict[str, Column]) -> Column:
    """Comma-joined names of the rules a row breaks, in rule order ('' when none)."""
    return F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in rules.items()])


def quality_quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking at least one rule, with a ``violations`` column naming the rules."""
    return df.withColumn("violations", violations(rules)).filter(F.col("violations") != "")


def quality_split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows); both share one definition of a violation."""
    tagged = df.withColumn("violations", violations(rules))
    return tagged.filter(F.col("violations") == "").drop("violations"), tagged.filter(F.col("violations") != "")


def fail_on(df: DataFrame, bad: Column, message: str, check_col: str = "check") -> DataFrame:
    """Add ``check_col`` = 'ok', failing the job with ``message`` on the first bad row.

    The check is a column of the result: a query that prunes the column away
    also prunes the check, so keep it in what is written or collected.
    """
    return df.withColumn(check_col, F.when(bad, F.raise_error(F.lit(message))).otherwise(F.lit("ok")))
