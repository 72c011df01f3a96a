"""Every registered query against its SQL twin (DuckDB) on sf0.001; queries
without a twin must at least run."""

import pytest

import __spark_entry__ as E
from tessera.plans.compare import compare, family

from conftest import SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "model_code" in df.columns


def test_every_query_has_name_and_most_have_sql():
    assert len(QUERIES) >= 100
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 0.85 * len(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    sdf = QUERIES[name](spark, SMALL)
    srows = sdf.collect()
    if name not in ORACLE:
        assert len(sdf.columns) > 0
        return
    rel = duck.execute(ORACLE[name])
    drows = rel.fetchall()
    dcols = [d[0] for d in rel.description]
    msgs = compare(sdf.columns, {f.name: family(f.dataType.simpleString()) for f in sdf.schema.fields},
                   srows, dcols, {d[0]: family(str(d[1])) for d in rel.description}, drows)
    assert not msgs, msgs


@pytest.mark.parametrize("name", ["D07_D08_date_text", "D14_elapsed", "A11_run_summary", "S11_E14_run_tables",
                                  "S09_A01_streaming_daily_counts", "Z09_problem_reports"])
def test_zone_independent(spark, duck, name):
    """Time-sensitive queries give the same rows under a non-UTC session."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
