"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from orderloom.catalogue import oracle  # noqa: E402
from orderloom.catalogue import queries as known  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_every_query_has_sql():
    assert set(known.queries()) == set(oracle.oracle_sql())
    assert set(known.queries()) <= set(entry.queries()) and set(oracle.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(known.queries()))
def test_query_equals_its_sql(spark, con, name):
    assert check.compare(known.queries()[name](spark, SF), con, oracle.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["invoice_refresh_rows", "invoice_refresh_night", "control_overlap", "daily_run_state"])
def test_runs_equal_their_sql_where_day_and_night_differ(spark, name):
    folder = "/root/testdata/sf0.01"
    assert check.compare(known.queries()[name](spark, folder), check.connect(folder), oracle.oracle_sql()[name]) == ""


def test_invoice_run_takes_every_month_touched(spark):
    folder = "/root/testdata/sf0.01"
    rows, night = (known.queries()[f"invoice_refresh_{n}"](spark, folder).drop("atm_update_dt") for n in ("rows", "night"))
    assert rows.exceptAll(night).isEmpty() and night.exceptAll(rows).isEmpty()
    day = known.queries()["invoice_refresh_day"](spark, folder)
    assert 0 < day.count() < rows.count()
    assert check.compare(day, check.connect(folder), oracle.oracle_sql()["invoice_refresh_day"]) == ""


def test_entry_gives_mart_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "oper_aff_id" and len(df.columns) == 46 and df.limit(1).count() == 1
