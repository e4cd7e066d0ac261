"""Driver contract: entry runs, every query has a name, SQL keys are a subset."""

import importlib.util
import os


def _entry():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and {r["split"] for r in rows} == {"train", "val", "test"}


def test_oracle_keys_subset():
    mod = _entry()
    q, s = mod.queries(), mod.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 100
