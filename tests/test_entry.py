"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as entry_mod


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_queries_and_oracles_align():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    assert "report_mart" in q and "report_mart" in o
