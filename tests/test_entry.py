import importlib
import sys


def test_entry_contract(spark):
    sys.path.insert(0, "/root/repo")
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert set(df.columns) >= {"max_len", "seen", "kept", "dropped", "truncated", "tokens"}
    assert df.count() == 2
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 50
