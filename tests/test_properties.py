"""Property tests: row windows and interpolation equal plain-Python references
on random null patterns (one Spark job per example, few examples)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ashgrid.operators import timeseries as TS

from .test_timeseries import _interp_ref

values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4)), min_size=1, max_size=25)


def _close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, n=st.integers(1, 8))
def test_rolling_and_interpolate_match_reference(spark, vals, n):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=2 * i) for i in range(len(vals))]
    df = spark.createDataFrame([("s", d, v) for d, v in zip(days, vals)], "st string, d date, v double")
    out = TS.add_rolling(df, "st", "d", {"s": ("v", n, "sum"), "m": ("v", n, "mean")})
    out = TS.interpolate(out, "st", "d", ["v"]).orderBy("d").collect()
    for i, r in enumerate(out):
        win = [x for x in vals[max(0, i - n + 1): i + 1] if x is not None]
        assert _close(r.s, sum(win) if win else None)
        assert _close(r.m, sum(win) / len(win) if win else None)
    ref = _interp_ref(vals)
    assert all(_close(r.v, e) for r, e in zip(out, ref))
