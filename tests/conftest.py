import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paths import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from kerbside.session import checkpoint_dir, get_spark
    s = get_spark("kerbside-tests", master="local[4]", shuffle_partitions=8, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from kerbside.sources.tables import TABLES
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con
