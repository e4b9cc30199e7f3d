import pytest
from tests.oracle import duck_rows, spark_rows

from tidelog.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def log_dir(tmp_path_factory, spark):
    """Events enough for several segments a log."""
    folder = str(tmp_path_factory.mktemp("sf"))
    import duckdb

    duckdb.execute(f"copy (select event_id, ts, user_id % 2 + 4 * (user_id % 2) + user_id % 4 as user_id, case when event_id % 3 = 0 then 'view' else 'click' end as event_type, value, props from '/root/testdata/sf0.01/events.parquet' where event_id < 2600) to '{folder}/events.parquet'")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, log_dir, name):
    assert spark_rows(QUERIES[name](spark, log_dir)) == duck_rows(ORACLE_SQL[name], log_dir)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
