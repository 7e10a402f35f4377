"""Route statistics: per (route, day) and rolled up to (pickup borough, day).

The route key is a built-in ``concat`` (no Python worker) and the pickup id
is kept as a column instead of being parsed back out of the key.  The
distinct shuffles on all six columns, so one hot route still spreads over
many tasks; the group-by then moves only map-side partial aggregates, one row
per (route, day) and input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import functions as fx
from fleetlens.operators.aggregates import ROUTE_COLUMNS, with_route


def route_stats(trips: DataFrame) -> DataFrame:
    """Distinct trips grouped by (route, pickup id, day): trips, exact distance sum, rounded mean.

    ``trips`` counts *distinct* trips (equal-looking trips collapse first).
    ``pu_location_id`` is implied by the route, so grouping by it too changes no group.
    """
    # The route is a function of the two ids, so the distinct runs on the five base columns
    # (a narrower shuffle) and the key is built after it; both ids stay in the distinct, so
    # rows with a NULL id collapse exactly as they would with the key included.
    base = [c for c in ROUTE_COLUMNS if c != "route"]
    distinct = with_route(trips.select(*base).distinct())
    stats = distinct.groupBy("route", "pu_location_id", "pickup_date").agg(
        F.count("*").alias("trips"),
        fx.partial_sum(distinct, "trip_distance").alias("distance_sum"),
        F.count("trip_distance").alias("measured"),
    )
    return stats.withColumn("avg_miles", fx.mean_of(stats, "distance_sum", "measured", 2))


def route_daily(trips: DataFrame) -> DataFrame:
    """Per (route, pickup_date): distinct trips and their rounded mean distance."""
    return route_stats(trips).select("route", "pickup_date", "trips", "avg_miles")


def route_rollup(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Per (pickup borough, pickup_date): summed trips and two mean distances.

    ``avg_miles`` is the reference's unweighted mean of the already rounded
    per-route means (each route-day weighs the same); ``avg_miles_weighted`` is
    the mean over trips, from distance sums and counts carried up.
    """
    pu_zones = zones.select(F.col("LocationID").alias("pu_location_id"), F.col("Borough").alias("pu_borough"))
    # a rounded mean is a number of hundredths, so its sum is exact as a decimal
    stats = route_stats(trips).withColumn("avg_miles", F.col("avg_miles").cast("decimal(18,2)"))
    rolled = (
        stats.join(pu_zones, "pu_location_id")
        .groupBy("pu_borough", "pickup_date")
        .agg(
            F.sum("trips").alias("trips"),
            F.sum("avg_miles").alias("miles"),
            F.count("avg_miles").alias("routes"),
            fx.merged_sum(stats, "distance_sum").alias("distance_sum"),
        )
    )
    return rolled.select(
        "pu_borough",
        "pickup_date",
        "trips",
        fx.mean_of(rolled, "miles", "routes", 2).alias("avg_miles"),
        fx.mean_of(rolled, "distance_sum", "trips", 2).alias("avg_miles_weighted"),
    )
