"""Driver contract."""
import __spark_entry__ as entry


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert {r.label for r in rows} == {0, 1}
    assert sum(r["count"] for r in rows) == 1500


def test_oracles_only_for_registered_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
