"""Driver-contract smoke test: entry() and every registered query run at sf0.001
with a stable schema, and every oracle key has a query."""
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
#: No block of readings is long enough there for a window of 24 hours: these raise, as they say.
NEEDS_WINDOWS = {"sequence_forecast", "training_history", "tree_attribution", "top_drivers_text"}


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["hour", "avg_traffic_volume", "hours_observed"]


def test_oracle_keys_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_every_query_runs_at_smallest_scale(spark):
    failed = {}
    for name, fn in E.queries().items():
        if name in NEEDS_WINDOWS:
            with pytest.raises(ValueError, match="no train row"):
                fn(spark, SMOKE)
            continue
        try:
            df = fn(spark, SMOKE)
            df.write.format("noop").mode("overwrite").save()
            assert len(df.columns) == len(set(df.columns)), name
        except Exception as ex:  # noqa: BLE001
            failed[name] = f"{type(ex).__name__}: {str(ex)[:300]}"
    assert not failed, failed
