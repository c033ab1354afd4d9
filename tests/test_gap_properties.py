"""Random groups: the gap operator equals the plain-Python rules."""

from brute import gap_flags
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gapscan.operators.gap import gap_outliers

values = st.one_of(st.integers(-1000, 1000).map(float),
                   st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False).map(lambda v: round(v, 2)))
groups = st.lists(st.tuples(st.integers(0, 5), values), min_size=0, max_size=150)


@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=groups, spikes=st.lists(st.tuples(st.integers(0, 5), st.sampled_from([1e7, -1e7, 5e6])),
                                    max_size=3))
def test_random_groups_match_brute_force(spark, rows, spikes):
    data = rows + [(g, v) for g, v in spikes]
    by_key = {}
    for g, v in data:
        by_key.setdefault(g, []).append(v)
    want = {(g, v): t for g, vs in by_key.items() for v, t in (gap_flags(vs, min_n=5) or {}).items()}
    df = spark.createDataFrame(data or [(0, None)], "g long, v double")
    for kw in ({"partitions": 3}, {"partitions": 1}):
        got = {(r.g, r.xx): r.outlier_type for r in gap_outliers(df, ["g"], "v", min_n=5, **kw).collect()}
        assert got == want, kw
