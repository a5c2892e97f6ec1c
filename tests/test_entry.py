"""The driver contract."""

import __spark_entry__ as entry_mod
from daygrain.catalog import registry


def test_registry_keys_have_sql_or_are_documented():
    q, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(q)
    own = set(registry())
    assert own <= set(q)
    assert own - set(sql) == {"m06_feature_importances"}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert len(df.columns) == 68
    assert df.count() > 0
