"""Property checks: exact quantiles equal NumPy on random data with ties; results do not
depend on the number of input partitions (SURVEY 5 (d))."""

import numpy as np
import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from cribble.functions.quantiles import exact_quantiles
from cribble.operators import drift as D


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_quantiles_with_ties(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [p], fetch_limit=3, bins=4)[((), "x", p)]
    assert got == pytest.approx(float(np.quantile(np.array(values, dtype=float), p)), abs=1e-12)


def test_ks_partition_independent(spark):
    rng = np.random.default_rng(11)
    rows = [("ref", float(v)) for v in rng.normal(0, 1, 500)] + [("cur", float(v)) for v in rng.normal(0.2, 1, 400)]
    df = spark.createDataFrame(rows, "side string, x double")
    a = D.ks_two_sample(df.repartition(1), "side", "ref", ["x"], rows_per_bucket=100).collect()
    b = D.ks_two_sample(df.repartition(8), "side", "ref", ["x"], rows_per_bucket=100).collect()
    assert a == b
