"""Grouped summaries of trips.

Every summary is a single ``groupBy().agg()`` so Spark plans a partial
(map-side) aggregate, one exchange on the grouping keys, and a final
aggregate; hot keys are collapsed before the shuffle, so a key holding a third
of the rows costs one partial row per input partition, not a third of the data.
Sums and rounded means of daily totals and vendors are exact whatever the column
type (:mod:`fleetlens.functions.exact`).  Final ``orderBy`` is kept only where the reference
reports ordered output; ties get an explicit tie-break.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import functions as fx
from fleetlens.session import cached


def scan_count(df: DataFrame) -> DataFrame:
    """Global row count as a one-row DataFrame (``rows``)."""
    return df.agg(F.count("*").alias("rows"))


def daily_totals(
    trips: DataFrame,
    date_col: str = "pickup_date",
    amount_col: str = "total_amount",
    distance_col: str = "trip_distance",
) -> DataFrame:
    """Per day: trips, revenue rounded to whole units, mean distance (2 decimals)."""
    totals = trips.groupBy(date_col).agg(
        F.count("*").alias("trips"),
        fx.partial_sum(trips, amount_col).alias("revenue"),
        fx.partial_sum(trips, distance_col).alias("miles"),
        F.count(distance_col).alias("measured"),
    )
    return totals.select(
        date_col,
        "trips",
        fx.mean_of(totals, "revenue", F.lit(1), 0).alias("revenue"),
        fx.mean_of(totals, "miles", "measured", 2).alias("avg_miles"),
    ).orderBy(date_col)


def hourly_stats(
    trips: DataFrame,
    day_col: str = "day_of_week",
    hour_col: str = "pickup_hour",
    speed_col: str = "avg_mph",
    tip_col: str = "tip_pct",
    duration_col: str = "trip_minutes",
    accuracy: int = 10000,
) -> DataFrame:
    """Per (weekday, hour): trips, mean speed and tip (1 decimal), approximate median duration.

    Written as SQL over a temporary view, as the reference does; the view name
    is unique per call.  ``accuracy`` is ``percentile_approx``'s (Spark's
    default 10,000): its sketch is bounded in size per group whatever the
    group's row count, and is exact for groups below roughly 1/accuracy·n rows.
    """
    view = f"trips_{uuid.uuid4().hex[:12]}"
    trips.createOrReplaceTempView(view)
    rounded_mean = "CAST(ROUND(TRY_DIVIDE(SUM({c}), COUNT({c})), 1) AS DOUBLE)"
    out = trips.sparkSession.sql(
        f"""
        SELECT {day_col} AS day_of_week,
               {hour_col} AS pickup_hour,
               COUNT(*) AS trips,
               {rounded_mean.format(c=speed_col)} AS avg_mph,
               {rounded_mean.format(c=tip_col)} AS avg_tip_pct,
               PERCENTILE_APPROX({duration_col}, 0.5, {int(accuracy)}) AS median_minutes
        FROM {view}
        GROUP BY {day_col}, {hour_col}
        ORDER BY day_of_week, pickup_hour
        """
    )
    # the analysed plan already holds the view's plan; the name is not needed any more
    trips.sparkSession.catalog.dropTempView(view)
    return out


def payment_mix(
    trips: DataFrame,
    period_col: str = "pickup_month",
    method_col: str = "payment_method",
    methods: list[str] | None = None,
) -> DataFrame:
    """Trips per period and payment method, one column per method in a fixed list.

    The explicit value list keeps the column set fixed (a method with no trips
    is a NULL column, not a missing one) and spares Spark the extra job that
    discovers pivot values.
    """
    return (
        trips.groupBy(period_col)
        .pivot(method_col, methods or fx.PAYMENT_ORDER)
        .count()
        .orderBy(period_col)
    )


def mean_by_key(trips: DataFrame, key: str, value: str, out: str, digits: int = 2) -> DataFrame:
    """Rounded mean of ``value`` per ``key`` (e.g. mean fare per vendor)."""
    return fx.means_by(trips, [key], {out: (value, digits)})


def avg_fare_by_vendor(trips: DataFrame) -> DataFrame:
    return mean_by_key(trips, "vendor_id", "fare_amount", "avg_fare")


def count_where_by(trips: DataFrame, predicate: str, key: str) -> DataFrame:
    """Rows matching a SQL predicate, counted per ``key``, ordered by key."""
    return trips.filter(predicate).groupBy(key).count().orderBy(key)


def long_trips_by_month(trips: DataFrame, duration_col: str = "trip_minutes", threshold: float = 60) -> DataFrame:
    return count_where_by(trips, f"{duration_col} > {threshold}", "pickup_month")


def distance_buckets(trips: DataFrame, distance_col: str = "trip_distance") -> DataFrame:
    """Trips per distance bucket, grouping by the CASE expression itself."""
    return trips.groupBy(fx.distance_bucket(distance_col).alias("bucket")).count()


ROUTE_COLUMNS = ["route", "pu_location_id", "do_location_id", "pickup_date", "payment_method", "trip_distance"]


def with_route(trips: DataFrame) -> DataFrame:
    return trips.withColumn("route", fx.route_key("pu_location_id", "do_location_id"))


def distinct_trips(trips: DataFrame) -> DataFrame:
    """Distinct trips on (route, pickup, dropoff, date, payment, distance).

    The route is a function of the pickup and dropoff ids, so the distinct
    shuffles the five base columns and the key is added afterwards.
    """
    base = [c for c in ROUTE_COLUMNS if c != "route"]
    return with_route(trips.select(*base).distinct()).select(*ROUTE_COLUMNS)


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key (NULL is a key of its own)."""
    return df.groupBy(key).count()


def top_keys(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The ``n`` keys with the most rows; ties broken by key ascending."""
    return key_counts(df, key).orderBy(F.desc("count"), F.asc_nulls_first(key)).limit(n)


def distinct_key_count(df: DataFrame, key: str, out: str = "keys") -> DataFrame:
    """Number of distinct keys, NULL counted as one (unlike ``count(distinct)``)."""
    return key_counts(df, key).agg(F.count("*").alias(out))


@contextlib.contextmanager
def key_count_report(df: DataFrame, key: str, n: int = 5) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(number of distinct keys, top ``n`` keys) answered from one shuffled aggregate.

    The per-key counts are computed once and persisted for the block, so the
    second answer reads the cached aggregate instead of re-scanning and
    re-shuffling the input; the cache is released when the block ends.
    """
    with cached(key_counts(df, key)) as counts:
        yield (
            counts.agg(F.count("*").alias("keys")),
            counts.orderBy(F.desc("count"), F.asc_nulls_first(key)).limit(n),
        )
