"""What the plans do at scale: pushed filters, split hot keys, no pairwise joins, no group in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom.catalogue import queries as catalogue
from orderloom.catalogue.standins import RUN_TS, Standins
from orderloom.operators import groups, ranks
from orderloom.plans.refresh import CONFORM, conform_all
from orderloom.sources.schemas import SOURCES

from .helpers import source

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Every source table as empty parquet files, so that plans show what reaches a scan."""
    folder = tmp_path_factory.mktemp("stored")
    tables = {}
    for name in SOURCES:
        path = str(folder / name)
        source(spark, name, []).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables


@pytest.fixture
def settings(spark):
    """Change run-time settings for one test."""
    old = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            old[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_month_ranges_reach_the_scans(stored, settings):
    settings(maxMetadataStringLength="2000")
    plan = physical(conform_all(stored, (202104, 202105), RUN_TS))
    assert "GreaterThanOrEqual(ord_dt,20210401)" in plan and "LessThanOrEqual(ord_dt,20210531)" in plan
    for column, first, after in (("ord_dt", "2021-04-01", "2021-06-01"), ("order_date_time", "2021-04-01", "2021-06-01"), ("ord_dt", "2021-03-31", "2021-06-02")):
        assert f"GreaterThanOrEqual({column},{first}T00:00)" in plan and f"LessThan({column},{after}T00:00)" in plan


@pytest.mark.parametrize("plan", CONFORM)
def test_plans_have_equi_joins_only(stored, settings, plan):
    settings(autoBroadcastJoinThreshold="-1")
    text = physical(plan(stored, (202104,), RUN_TS))
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "BroadcastExchange" not in text
    assert "Python" not in text
    # Windows appear only in source 2's line numbers, and there over counted blocks.
    windows = [line for line in text.splitlines() if " Window [" in line]
    assert all("__n" in w or "__m" in w for w in windows)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the rows share one key, half of those one value."""
    path = str(tmp_path_factory.mktemp("skewed") / "t")
    spark.range(0, 120_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "CASE WHEN id % 2 = 0 THEN 7 ELSE id % 1000 END AS w", "id AS x",
    ).write.parquet(path)
    return spark.read.parquet(path)


SMALL = dict(
    autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
    adaptive__maxShuffledHashJoinLocalMapThreshold="0", adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    adaptive__skewJoin__skewedPartitionFactor="2", adaptive__advisoryPartitionSizeInBytes="20KB", shuffle__partitions="16",
)


def executed(df):
    df.collect()
    return physical(df)


def test_a_hot_key_is_split_when_its_group_value_is_attached(skewed, settings):
    settings(**SMALL)
    got = groups.with_group(skewed, ["k"], total=F.sum("w"), n=F.count(F.lit(1)))
    assert "skew=true" in executed(got)
    assert got.filter("k = -1").select("n").distinct().collect()[0][0] == 40_000
    assert got.count() == 120_000


def test_a_hot_key_is_split_also_when_an_operator_follows(skewed, settings):
    settings(**SMALL)
    first = groups.first_of_group(skewed, ["k"], "x", "w", "kept")
    assert "skew=true" in executed(first.groupBy("k").agg(F.sum("kept").alias("s")))


def test_rank_holds_no_hot_group_in_one_task(skewed, settings):
    settings(**SMALL)
    ranked = ranks.rank_in_group(skewed, ["k"], ["w", "x"], "r", block=500)
    text = executed(ranked)
    assert all("__n" in line or "__m" in line for line in text.splitlines() if " Window [" in line)
    hot = [r["r"] for r in ranked.filter("k = -1").select("r").collect()]
    assert sorted(hot) == list(range(1, 40_001))


def test_rank_of_sparse_values_sorts_no_long_list_of_blocks(spark):
    sparse = spark.range(20_000).selectExpr("id % 2 AS k", "(id - 9000) * 1000000 AS x")
    ranked = ranks.rank_in_group(sparse, ["k"], ["x"], "r", block=1024, span=2**36)
    assert physical(ranked).count(" Window [") >= 4
    assert ranked.filter("r <> (x / 1000000 + 9000 - k) / 2 + 1").count() == 0 and ranked.count() == 20_000


def test_every_month_at_once_gives_what_single_months_give(spark):
    tables = catalogue._WithInvoices(Standins(spark, SF))
    months = (202104, 202105)
    for plan in (CONFORM[1], CONFORM[3]):
        everything = plan(tables, None, RUN_TS).filter(F.col("ord_mo_yr_id").isin(*months))
        chosen = plan(tables, months, RUN_TS)
        assert sorted(map(str, everything.collect())) == sorted(map(str, chosen.collect()))


def test_state_survives_without_local_checkpoints(spark):
    from orderloom.session import cut_lineage, shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(3))
    assert df.count() == 3 and "FileScan parquet" in physical(df) and "Range" not in physical(df)
    assert RUN_TS == dt.datetime(2022, 7, 29, 21, 30)
