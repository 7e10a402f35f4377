from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions import distance_bucket
from fleetlens.operators import aggregates as agg
from fleetlens.operators import clean, joins
from fleetlens.plans import catalog
from fleetlens.plans.inspect import plan_text


def _trips(raw):
    return clean.clean_trips(raw.drop("label"))


def test_borough_flows_auto_equals_merge(raw_trips, zones):
    t = _trips(raw_trips)
    b = joins.borough_flows(t, zones, "auto")
    m = joins.borough_flows(t, zones, "merge")
    assert b.collect() == m.collect()
    assert "BroadcastHashJoin" in plan_text(b, "simple")
    mt = plan_text(m, "simple")
    assert "SortMergeJoin" in mt and "BroadcastHashJoin" not in mt


def test_unknown_location_drops_out_of_inner_join(raw_trips, zones):
    t = _trips(raw_trips)
    flows = joins.borough_flows(t, zones)
    # big_fare goes to location 9 (known); every kept trip has known ids here
    assert sum(r.trips for r in flows.collect()) == t.count()
    lost = joins.borough_flows(t, zones.filter(F.col("LocationID") != 3))
    assert sum(r.trips for r in lost.collect()) == t.filter((F.col("pu_location_id") != 3) & (F.col("do_location_id") != 3)).count()


def test_pivot_has_fixed_columns_and_null_cells(raw_trips):
    mix = agg.payment_mix(_trips(raw_trips))
    assert mix.columns == ["pickup_month", "card", "cash", "no charge", "dispute", "other"]
    rows = {r.pickup_month: r for r in mix.collect()}
    assert rows["2024-04"].card == 1 and rows["2024-04"].cash is None


def test_distinct_key_count_counts_null_as_a_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert agg.distinct_key_count(df, "k").first().keys == 3
    assert df.select(F.count_distinct("k")).first()[0] == 2


def test_top_keys_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in [3, 3, 1, 1, 2, 2, 5]], "k int")
    assert [(r.k, r["count"]) for r in agg.top_keys(df, "k", 2).collect()] == [(1, 2), (2, 2)]


def test_sql_and_dataframe_forms_agree(spark, raw_trips):
    t = _trips(raw_trips)
    via_sql = agg.hourly_stats(t).select("day_of_week", "pickup_hour", "trips")
    via_df = t.groupBy("day_of_week", "pickup_hour").agg(F.count("*").alias("trips"))
    assert sorted(via_sql.collect()) == sorted(via_df.collect())


def test_distinct_collapses_equal_trips(raw_trips):
    t = _trips(raw_trips)
    # dup_a / dup_b are one trip; null_payment / zero_payment look equal too (both "other")
    assert agg.distinct_trips(t).count() == t.count() - 2


def test_key_count_report_reuses_one_aggregate(spark, raw_trips):
    from fleetlens.plans.inspect import plan_text

    t = _trips(raw_trips)
    with agg.key_count_report(t, "pu_location_id", 2) as (distinct, top):
        assert distinct.first().keys == agg.distinct_key_count(t, "pu_location_id").first().keys
        assert top.collect() == agg.top_keys(t, "pu_location_id", 2).collect()
        assert "InMemoryTableScan" in plan_text(top, "simple")


def test_distinct_trips_with_null_ids_matches_distinct_on_all_six_columns(spark):
    import datetime as dt

    d = dt.date(2024, 1, 1)
    rows = [(None, 5, d, "card", 1.0), (None, 5, d, "card", 1.0), (None, 6, d, "card", 1.0), (4, None, d, "cash", 2.0)]
    df = spark.createDataFrame(
        rows, "pu_location_id int, do_location_id int, pickup_date date, payment_method string, trip_distance double"
    )
    got = sorted(map(tuple, agg.distinct_trips(df).collect()), key=repr)
    want = sorted(map(tuple, agg.with_route(df).select(*agg.ROUTE_COLUMNS).distinct().collect()), key=repr)
    assert got == want and len(got) == 3


def _star_tables(spark, root):
    """Twelve order lines of four orders, two customers and three suppliers; one nation has no region."""
    def save(name, schema, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    save("region", "r_regionkey int, r_name string", [(0, "NORTH"), (1, "SOUTH")])
    save("nation", "n_nationkey int, n_name string, n_regionkey int", [(0, "a", 0), (1, "b", 1), (2, "c", 9)])
    save("customer", "c_custkey bigint, c_nationkey int", [(1, 0), (2, 1)])
    save("supplier", "s_suppkey bigint, s_nationkey int", [(1, 0), (2, 1), (3, 2)])
    days = "timestamp '2020-01-01 00:00:00' + make_interval(0, 0, 0, id)"
    orders = spark.range(1, 5).selectExpr("id as o_orderkey", "id % 2 + 1 as o_custkey", "'F' as o_orderstatus", f"{days} as o_orderdate")
    orders.write.parquet(f"{root}/orders.parquet")
    lines = spark.range(12).selectExpr(
        "id % 4 + 1 as l_orderkey", "id % 3 + 1 as l_suppkey", "cast(id as int) as l_linenumber", "cast(2 as double) as l_quantity",
        "cast(100 + id as double) as l_extendedprice", "0.1D as l_discount", "0.0D as l_tax", "'R' as l_returnflag",
        f"{days} as l_shipdate",
    )
    lines.write.parquet(f"{root}/lineitem.parquet")


def test_flows_and_zone_counts_read_only_their_columns(spark, scratch):
    """Not staged, they compute no column they do not need; once staged they read the table; the rows are the same."""
    root = f"{scratch}/tables"
    _star_tables(spark, root)
    queries = catalog.trip_queries()
    names = ("borough_flows_merge", "borough_flows", "zone_counts")
    before = {name: queries[name](spark, root) for name in names}
    for df in before.values():
        text = plan_text(df, "simple")
        assert "staged" not in text and "l_shipdate" not in text and "l_quantity" not in text
    rows = {name: sorted(df.collect()) for name, df in before.items()}
    assert sum(r.trips for r in rows["borough_flows_merge"]) == 8 and rows["borough_flows_merge"] == rows["borough_flows"]
    catalog.trips(spark, root)
    for name in names:
        df = queries[name](spark, root)
        assert "l_orderkey" not in plan_text(df, "simple") and sorted(df.collect()) == rows[name]
    assert spark.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold") in ("0", "0b")
