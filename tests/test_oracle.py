"""Layer 1: every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["mmsi", "step", "window_start", "n_points", "first_ts", "lat", "lon", "seq_len"]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, E.queries()[name], ORACLE[name], SF, con)
    assert res["status"] == "OK", res


@pytest.mark.parametrize("name", ["parse_timestamp", "sequence_stats", "scan_csv_schema",
                                  "scan_csv_inferred", "trajectories_from_csv", "hourly_trajectories"])
def test_time_queries_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, name, E.queries()[name], ORACLE[name], SF, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["status"] == "OK", res
