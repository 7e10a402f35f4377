from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.operators import windows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(min_value=-1000, max_value=1000)), min_size=1, max_size=120),
    partitions=st.one_of(st.none(), st.integers(min_value=1, max_value=12)),
    frame=st.integers(min_value=1, max_value=9),
    block=st.one_of(st.none(), st.integers(min_value=1, max_value=40)),
    dup=st.integers(min_value=1, max_value=5),
)
def test_distributed_windows_equal_plain_windows(spark, values, partitions, frame, block, dup):
    rows = [(i // dup, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, tie int, v bigint")
    order = [F.desc("k"), F.asc("tie")]
    got = sorted(
        (r.tie, r.running_total)
        for r in windows.running_total(df, order, "v", partitions=partitions).collect()
    )
    want = sorted((r.tie, r.running_total) for r in windows.running_total_single(df, order, "v").collect())
    assert got == want
    block_rows = None if block is None else max(block, frame - 1)
    got = sorted(
        (r.tie, r.m)
        for r in windows.rolling_mean(df, order, "v", "m", frame, 3, partitions=partitions, block_rows=block_rows).collect()
    )
    want = sorted((r.tie, r.m) for r in windows.rolling_mean_single(df, order, "v", "m", frame, 3).collect())
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    groups=st.lists(
        st.lists(st.one_of(st.none(), st.integers(min_value=-10**9, max_value=10**9)), min_size=1, max_size=40),
        min_size=1,
        max_size=6,
    ),
    q=st.sampled_from([0.0, 0.1, 0.5, 0.75, 1.0]),
    dup=st.integers(min_value=1, max_value=3),
)
def test_group_quantile_equals_sorted_index(spark, groups, q, dup):
    from fleetlens.operators.runmetrics import group_quantile

    rows = [(g, v) for g, vals in enumerate(groups) for v in vals for _ in range(dup)]
    df = spark.createDataFrame(rows, "g int, v bigint")
    got = {r.g: (r.x, r.n, r.mx) for r in group_quantile(df, ["g"], "v", q, "x", "n", "mx").collect()}
    want = {}
    for g, vals in enumerate(groups):
        vs = sorted(v for v in vals if v is not None for _ in range(dup))
        if not vs:
            continue
        want[g] = (vs[min(int(q * len(vs)), len(vs) - 1)], len(vs), vs[-1])
    assert got == want
