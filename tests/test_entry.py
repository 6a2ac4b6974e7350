import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["metric", "threshold", "passed", "message"] and len(rows) == 1


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
