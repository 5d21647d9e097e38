import __spark_entry__ as E


def test_entry_and_names(spark):
    assert E.entry(spark).count() == 70
    names = set(E.queries())
    assert set(E.oracle_sql()) <= names
    assert "onset_consecutive_dry" in names
