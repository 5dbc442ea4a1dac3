"""Every registered query against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as entry
from paths import SMALL
from kerbside.plans.catalog import QUERIES as BASE

QUERIES = {k: v for k, v in entry.queries().items() if k in BASE}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in BASE}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def test_entry_registers_every_base_query():
    assert set(BASE) <= set(entry.queries())
    assert set(BASE) == set(ORACLE)  # each has an oracle


def test_contract_keys():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 60


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "fraud_rule" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SMALL)
    srows = sorted([tuple(_norm(x) for x in r) for r in sdf.collect()], key=_key)
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(sdf.columns)
    order = [dcols.index(c) for c in sdf.columns]
    drows = sorted([tuple(_norm(r[i]) for i in order) for r in cur.fetchall()], key=_key)
    assert len(srows) == len(drows)
    assert srows == drows


def test_query_names_follow_survey_ids():
    import re
    for name in QUERIES:
        assert re.match(r"^[a-z]+\d+[a-z]?_[a-z0-9_]+$", name), name
        assert "pipeline" not in name and not re.match(r"^op\d+_", name)


def test_results_pinned_to_utc_under_other_session_zone(spark, duck):
    """Queries pin the session zone to UTC, so a session started in another zone gives
    the oracle's UTC wall-clock windows."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = QUERIES["a3_window_stats"](spark, SMALL)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        got = sorted(tuple(_norm(x) for x in r) for r in sdf.collect())
        cur = duck.execute(ORACLE["a3_window_stats"])
        cols = [d[0] for d in cur.description]
        want = sorted(tuple(_norm(r[cols.index(c)]) for c in sdf.columns) for r in cur.fetchall())
        assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
