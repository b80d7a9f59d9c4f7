"""Aliases: the champion is the best version, the baseline always the first one, a missing alias raises."""
import pytest

from hourwise.operators import tracking as TR


@pytest.mark.parametrize("f1,champion", [((0.5, 0.7), "v2_candidate"), ((0.7, 0.5), "v1_baseline"), ((0.6, 0.6), "v1_baseline")])
def test_aliases(spark, f1, champion):
    v = spark.createDataFrame([("v1_baseline", f1[0]), ("v2_candidate", f1[1])], "version string, f1_score double")
    aliases = TR.alias_table(v)
    assert TR.version_of(aliases, "champion") == champion and TR.version_of(aliases, "baseline") == "v1_baseline"
    with pytest.raises(LookupError):
        TR.version_of(aliases, "canary")
    scored = spark.createDataFrame([(1,), (2,)], "row_id int")
    rows = TR.alias_join(scored, TR.register_versions(v), aliases, "champion").collect()
    assert [r.model_version for r in rows] == [1 if champion == "v1_baseline" else 2] * 2


def test_small_values_keep_their_digits(spark):
    from hourwise.plans.registry import rnd, rounded
    import duckdb
    data = [1e-9, 1.23456789012e-300, -4.7e-7, 0.0, 1.0, 0.1 + 0.2, 0.3, 2.0 ** -30, 123456789.123456, -1e15, 1e300, None, float("inf")]
    got = [r.x for r in rounded(spark.createDataFrame([(v,) for v in data], "x double")).collect()]
    values = ", ".join("(NULL)" if v is None else f"('{v!r}'::DOUBLE)" for v in data)
    assert [r[0] for r in duckdb.sql(rnd(f"SELECT * FROM (VALUES {values}) t(x)", "x")).fetchall()] == got
    assert got[5] == got[6] and got[3] == 0 and got[4] == 1 and got[11] is None
    assert all(a == pytest.approx(b, rel=1e-7) for a, b in zip(got, data) if b)
