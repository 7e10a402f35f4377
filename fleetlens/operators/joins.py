"""Trips joined to a zone dimension, in one or two roles.

How the dimension travels is left to Spark (its byte statistics, and adaptive
execution once the real size is known); no plan depends on a probe of the data.
Counts and sums are taken per location id before the zones are joined, so the
join moves one row per id (or pair of ids) and task, and a busy zone is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import functions as fx


def zone_role(zones: DataFrame, prefix: str) -> DataFrame:
    """Zones renamed for one role: ``{prefix}_location_id``, ``{prefix}_borough``, ``{prefix}_zone``."""
    return zones.select(
        F.col("LocationID").alias(f"{prefix}_location_id"),
        F.col("Borough").alias(f"{prefix}_borough"),
        F.col("Zone").alias(f"{prefix}_zone"),
    )


def _dim(dim: DataFrame, strategy: str) -> DataFrame:
    if strategy == "auto":
        return dim
    if strategy == "merge":
        return dim.hint("merge")
    raise ValueError(f"unknown join strategy {strategy!r}")


def with_zones(trips: DataFrame, zones: DataFrame, roles=("pu", "do"), strategy: str = "auto") -> DataFrame:
    """Inner-join ``trips`` to ``zones`` once per role; trips with unknown ids drop out."""
    out = trips
    for role in roles:
        out = out.join(_dim(zone_role(zones, role), strategy), f"{role}_location_id")
    return out


def zone_counts(trips: DataFrame, zones: DataFrame, strategy: str = "auto") -> DataFrame:
    """Trips per pickup (borough, zone)."""
    per_id = trips.groupBy("pu_location_id").agg(F.count("*").alias("n"))
    named = with_zones(per_id, zones, ("pu",), strategy)
    return named.groupBy("pu_borough", "pu_zone").agg(F.sum("n").alias("count"))


def borough_flows(
    trips: DataFrame,
    zones: DataFrame,
    strategy: str = "auto",
    amount_col: str = "total_amount",
) -> DataFrame:
    """Trips and mean total per (pickup borough, dropoff borough), most trips first.

    ``strategy`` is ``auto`` (Spark chooses) or ``merge`` (sort-merge via a
    join hint, no session-wide setting touched).
    """
    per_pair = trips.groupBy("pu_location_id", "do_location_id").agg(
        F.count("*").alias("n"), fx.partial_sum(trips, amount_col).alias("amount"), F.count(amount_col).alias("amounts")
    )
    flows = (
        with_zones(per_pair, zones, ("pu", "do"), strategy)
        .groupBy("pu_borough", "do_borough")
        .agg(F.sum("n").alias("trips"), fx.merged_sum(per_pair, "amount").alias("amount"), F.sum("amounts").alias("amounts"))
    )
    mean = fx.mean_of(flows, "amount", "amounts", 2)
    return flows.select("pu_borough", "do_borough", "trips", mean.alias("avg_total")).orderBy(
        F.desc("trips"), "pu_borough", "do_borough"
    )


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows in the given total order (a bounded preview as a DataFrame)."""
    return df.orderBy(*order).limit(n)
