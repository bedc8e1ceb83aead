import __spark_entry__ as e


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_registry():
    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q)
    assert all(map(callable, q.values()))
