"""Property tests: Spark operators against plain-Python/numpy rules on
generated inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kestrel.functions import bands
from kestrel.operators import aggregate as agg
from kestrel.operators.histogram import histogram

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_time_of_day(h):
    if h is None:
        return "Night"
    if 5 <= h <= 11:
        return "Morning"
    if 12 <= h <= 16:
        return "Afternoon"
    if 17 <= h <= 21:
        return "Evening"
    return "Night"


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-2, 26)), min_size=1, max_size=40))
def test_time_of_day_rule(spark, hours):
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(bands.time_of_day("h")).collect()]
    assert got == [py_time_of_day(h) for h in hours]


@SETTINGS
@given(st.lists(st.floats(-20, 120, allow_nan=False, allow_infinity=False), min_size=1, max_size=200))
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["count"] for r in histogram(df, "v", 0, 100, 50).orderBy("bin").collect()]
    want, _edges = np.histogram(np.array(values), bins=50, range=(0, 100))
    assert got == want.tolist()


@SETTINGS
@given(st.lists(st.sampled_from("abcdefg"), min_size=1, max_size=60))
def test_shares_sum_to_100_and_busy_groups(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    grouped = agg.group_count(df, "k")
    rows = agg.with_share_of_total(grouped).collect()
    assert abs(sum(r.percentage for r in rows) - 100.0) < 1e-9
    counts = {k: keys.count(k) for k in set(keys)}
    mean = sum(counts.values()) / len(counts)
    busy = {r.k for r in agg.above_mean(grouped).collect()}
    assert busy == {k for k, c in counts.items() if c > mean}
