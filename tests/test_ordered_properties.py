"""Property test: distributed running totals / quantiles equal a single-process computation."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.functions.ordered import exact_quantiles, running_totals

values = st.lists(st.tuples(st.integers(0, 5), st.integers(-3, 3)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=values, parts=st.integers(1, 5))
def test_running_totals_property(spark, rows, parts):
    data = [(i, k, w) for i, (k, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, w long")
    got = {r.id: r.c for r in running_totals(df, [F.col("k").desc(), F.col("id").asc()], {"c": F.col("w")},
                                             num_partitions=parts).collect()}
    cum, want = 0, {}
    for i, k, w in sorted(data, key=lambda r: (-r[1], r[0])):
        cum += w
        want[i] = cum
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=st.lists(st.integers(-20, 20), min_size=1, max_size=50))
def test_exact_quantiles_property(spark, xs):
    df = spark.createDataFrame([(float(x), "g") for x in xs], "v double, g string")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.q: r.quantile for r in exact_quantiles(df, "v", qs, by=["g"]).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(np.array(xs, dtype=float), q)), abs=1e-9)
