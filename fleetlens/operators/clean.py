"""Ingest and clean: raw trips → standard columns → filtered, enriched trips.

All steps are narrow (no shuffle): the plan is one scan → filter → project
stage, and the filters on source columns reach the Parquet reader as pushed
filters.  Derived columns are built in the order the semantics need: the
speed uses the *rounded* duration, exactly as it is stored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetlens import functions as fx


@dataclass(frozen=True)
class CleanRules:
    """Bounds of the cleaning filter.

    ``pickup_range`` is inclusive at both ends (``between``); the duration,
    distance and money bounds are open.  ``unit_seconds`` is the unit of the
    duration column (60 → minutes, 86400 → days) and ``duration_col`` its name.
    """

    pickup_range: tuple[str, str] = ("2024-01-01", "2024-04-01")
    unit_seconds: int = 60
    duration_col: str = "trip_minutes"
    duration_bounds: tuple[float, float] = (1, 180)
    distance_bounds: tuple[float, float] = (0, 100)


TAXI_RULES = CleanRules()
# Star-schema fixtures: trips last days, not minutes.
FIXTURE_RULES = CleanRules(
    pickup_range=("1995-01-01", "2000-01-01"),
    unit_seconds=86400,
    duration_col="trip_days",
)


def standardize(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Project, rename and cast the 11 raw columns to the standard trip names.

    ``carry`` names extra columns (e.g. a row id) passed through unchanged.
    """
    return raw.select(
        *carry,
        F.col("VendorID").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").alias("dropoff_ts"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        "trip_distance",
        F.col("PULocationID").alias("pu_location_id"),
        F.col("DOLocationID").alias("do_location_id"),
        F.col("payment_type").cast("int").alias("payment_type"),
        "fare_amount",
        "tip_amount",
        "total_amount",
    )


def with_duration(trips: DataFrame, rules: CleanRules = TAXI_RULES) -> DataFrame:
    """Add the rounded duration (2 decimals) in the unit of ``rules``."""
    return trips.withColumn(
        rules.duration_col, F.round(fx.duration("pickup_ts", "dropoff_ts", rules.unit_seconds), 2)
    )


def keep_rule(rules: CleanRules = TAXI_RULES) -> F.Column:
    """The cleaning predicate; NULL in any tested column drops the row."""
    lo, hi = rules.pickup_range
    dlo, dhi = rules.duration_bounds
    xlo, xhi = rules.distance_bounds
    dur = F.col(rules.duration_col)
    return (
        F.col("pickup_ts").between(lo, hi)
        & (dur > dlo) & (dur < dhi)
        & (F.col("trip_distance") > xlo) & (F.col("trip_distance") < xhi)
        & (F.col("fare_amount") > 0) & (F.col("total_amount") > 0)
    )


def enrich(trips: DataFrame, rules: CleanRules = TAXI_RULES) -> DataFrame:
    """Calendar, speed, tip and payment columns (expects the duration column)."""
    per_hour = 3600 / rules.unit_seconds
    return trips.withColumns(
        {
            "pickup_date": F.to_date("pickup_ts"),
            "pickup_month": F.date_format("pickup_ts", "yyyy-MM"),
            "pickup_hour": F.hour("pickup_ts"),
            "day_of_week": F.date_format("pickup_ts", "E"),
            # NULL, not an error, for a zero duration (possible before cleaning).
            "avg_mph": F.round(F.try_divide(F.col("trip_distance"), F.col(rules.duration_col) / F.lit(per_hour)), 2),
            "tip_pct": fx.tip_pct("payment_type", "tip_amount", "fare_amount").cast("double"),
            "payment_method": fx.payment_method("payment_type"),
        }
    )


def enriched_trips(raw: DataFrame, rules: CleanRules = TAXI_RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every raw trip, standardised and enriched, without the cleaning filter."""
    return enrich(with_duration(standardize(raw, carry), rules), rules)


def clean_trips(raw: DataFrame, rules: CleanRules = TAXI_RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw trips → standard, filtered, enriched trips (the cleaned table)."""
    return enrich(with_duration(standardize(raw, carry), rules).filter(keep_rule(rules)), rules)


def clean_reconcile(
    raw: DataFrame, rules: CleanRules = TAXI_RULES, bad: dict[str, Column] | None = None
) -> DataFrame:
    """Rows in, kept and dropped (and bad per rule of ``bad``), in one pass over the input (one row)."""
    keep = F.coalesce(keep_rule(rules), F.lit(False))
    broken = [F.count_if(F.coalesce(rule, F.lit(False))).alias(f"bad_{name}") for name, rule in (bad or {}).items()]
    counted = with_duration(standardize(raw), rules).agg(
        F.count("*").alias("rows_in"), F.count_if(keep).alias("rows_kept"), *broken
    )
    dropped = (F.col("rows_in") - F.col("rows_kept")).alias("rows_dropped")
    return counted.select("rows_in", "rows_kept", dropped, *(f"bad_{name}" for name in bad or {}))


def observed_clean(
    raw: DataFrame, rules: CleanRules = TAXI_RULES, bad: dict[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """:func:`clean_trips`, with counts of all its input rows taken as it runs.

    The observation holds ``rows_in``, ``rows_kept`` and one count per rule of
    ``bad`` (a Column over the standardised trip, TRUE for a bad row).  Counting
    every row means that the cleaning filter is not pushed into the scan.

    Spark adds an observed count again when it computes a lost shuffle partition
    anew; ``parts`` and ``parts_seen`` (distinct partitions, and partitions as
    counted) tell whether that happened, see :func:`counts_of`.
    """
    counts = Observation(f"clean-{uuid.uuid4().hex}")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0
    std = with_duration(standardize(raw), rules).withColumns({"_first": first, "_part": F.spark_partition_id()})
    observed = std.observe(
        counts,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.coalesce(keep_rule(rules), F.lit(False))).alias("rows_kept"),
        F.count_if("_first").alias("parts_seen"),
        F.size(F.collect_set(F.when(F.col("_first"), F.col("_part")))).alias("parts"),
        *(F.count_if(F.coalesce(rule, F.lit(False))).alias(f"bad_{name}") for name, rule in (bad or {}).items()),
    )
    return enrich(observed.drop("_first", "_part").filter(keep_rule(rules)), rules), counts


def counts_of(observation: Observation) -> dict[str, int] | None:
    """The observed counts with ``rows_dropped``; None where they are to be counted anew.

    That is after a lost executor, when a partition was counted twice, and
    where Spark dropped the counting node from a plan it found to be empty.
    """
    try:
        counts = dict(observation.get)
    except Py4JJavaError:  # no counts arrived
        return None
    if not counted_once(counts):
        return None
    return counts | {"rows_dropped": counts["rows_in"] - counts["rows_kept"]}


def counted_once(counts: dict[str, int]) -> bool:
    """Whether every partition's rows entered the observed counts exactly once."""
    return bool(counts) and counts["parts_seen"] == counts["parts"]


def write_clean(clean: DataFrame, path: str) -> None:
    """Overwrite ``path`` with the cleaned trips, one directory per pickup month (see
    :func:`fleetlens.sources.trips.write_partitioned`)."""
    from fleetlens.sources.trips import write_partitioned

    write_partitioned(clean, path, "pickup_month")
