"""Joins that count, filter by keys, resolve roles at once and look back in time."""

import datetime as dt
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.text import cut_bytes
from orderloom.operators import joins
from orderloom.plans import refresh, source3, source4
from orderloom.sources import publish, state
from orderloom.sources.schemas import PENDING, SOURCES

from .helpers import frame, one, records, source
from .test_publish import _sources
from .test_sources import head4, line4


# --- roles -----------------------------------------------------------------

ROLES = {"a": {"name": "a_name", "size": "a_size"}, "b": {"name": "b_name"}, "c": {"size": "c_size"}}


def role_frames(spark):
    rows = [(i, i % 7, None if i % 5 == 0 else i % 4, 90 + i % 2) for i in range(60)] + [(1, 1, 1, 91)] * 2 + [(None, None, None, None)]
    dim = [(i, f"n{i}", i * 10) for i in range(6)] + [(91, None, 5), (None, "none", 1)]
    return frame(spark, "i int, a long, b long, c long", rows), frame(spark, "k long, name string, size int", dim)


def test_roles_in_one_pass_equal_a_join_per_role(spark):
    df, dim = role_frames(spark)
    plain = joins.role_join(df, dim, "k", ROLES, one_pass=False)
    at_once = joins.role_join(df, dim, "k", ROLES, one_pass=True)
    assert at_once.columns == plain.columns and records(at_once) == records(plain)
    assert records(joins.role_join(df.limit(0), dim, "k", ROLES, one_pass=True)) == []


def test_roles_in_one_pass_join_the_dimension_once(spark, tmp_path):
    df, dim = role_frames(spark)
    # A table of unknown size counts as large.
    assert not joins.small_enough(dim)
    dim.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.schema(dim.schema).parquet(str(tmp_path / "dim"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert joins.small_enough(dim)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not joins.small_enough(dim)
        plan = joins.role_join(df, dim, "k", ROLES)._jdf.queryExecution().optimizedPlan().toString()
        per_role = joins.role_join(df, dim, "k", ROLES, one_pass=False)._jdf.queryExecution().optimizedPlan().toString()
        # One join with the dimension, one that gives the rows what was found.
        assert per_role.count("Join LeftOuter") == 3 and plan.count("Join LeftOuter") == 1 and plan.count("Join Inner") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_roles_in_one_pass_refuse_a_key_with_two_rows(spark):
    df, dim = role_frames(spark)
    with pytest.raises(Exception, match="k is not unique"):
        joins.role_join(df, dim.unionByName(dim), "k", ROLES, one_pass=True).collect()


# --- as of -----------------------------------------------------------------

def plain_as_of(points, starts):
    out = []
    for key, at in points:
        found = [(t, v is not None, v) for k, t, v in starts if k == key and t is not None and at is not None and t <= at]
        out.append((key, at, max(found)[2] if key is not None and found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,span", [(65536, None), (4, 10_000), (3, None)])
def test_as_of_equals_plain_lookups(spark, block, span):
    rng = random.Random(block)
    starts = [(rng.choice("ab"), rng.randint(-60, 60), rng.choice([None, 1, 2, 3])) for _ in range(150)]
    starts += [("c", 5, 7), ("d", None, 8), (None, 1, 9), ("e", 3, None)]
    points = [(rng.choice("abcdef"), rng.randint(-70, 70)) for _ in range(300)] + [("a", None), (None, 3), ("a", 0), ("a", 0)]
    got = joins.as_of(frame(spark, "k string, at int", points), frame(spark, "k2 string, t long, v int", starts),
                      {"k": "k2"}, "at", "t", "v", "out", block, span)
    assert got.columns == ["k", "at", "out"] and sorted((tuple(r) for r in got.collect()), key=str) == plain_as_of(points, starts)


def test_as_of_with_a_million_starts_of_one_key(spark):
    starts = spark.range(1_000_000).select(F.lit("k").alias("k"), (F.col("id") * 3).alias("t"), F.col("id").alias("v"))
    points = spark.range(1_000).select(F.lit("k").alias("k"), (F.col("id") * 2_999 + 1).alias("at"))
    got = joins.as_of(points, starts, ["k"], "at", "t", "v", "out", block=1024)
    wrong = got.filter(F.col("out") != F.least(F.floor(F.col("at") / 3), F.lit(999_999))).count()
    assert wrong == 0 and got.filter("out IS NULL").count() == 0
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_as_of_takes_days_and_refuses_texts(spark):
    points = frame(spark, "k int, at date", [(1, dt.date(2021, 5, 3)), (1, dt.date(1960, 1, 1))])
    starts = frame(spark, "k int, t date, v string", [(1, dt.date(2021, 5, 1), "x"), (1, dt.date(1950, 1, 1), "y")])
    assert [r[2] for r in joins.as_of(points, starts, ["k"], "at", "t", "v", "out").orderBy(F.desc("at")).collect()] == ["x", "y"]
    with pytest.raises(ValueError, match="whole number or a day"):
        joins.as_of(points.withColumn("at", F.lit("a")), starts, ["k"], "at", "t", "v", "out")


# --- fan-out ---------------------------------------------------------------

def test_fan_out_is_counted_while_the_join_runs(spark):
    df = frame(spark, "k int, v int", [(1, 1), (1, 2), (2, 3), (None, 4)])
    side = frame(spark, "k int, w int", [(1, 10), (1, 11), (1, 12), (None, 13), (5, 14), (5, 15)])
    seen = Observation()
    got = joins.attach_observed(df, side, ["k"], seen)
    assert records(got) == records(joins.attach(df, side, ["k"]))
    assert joins.fan_out(seen) == {"rows_before": 4, "rows_after": 8, "greatest_fan_out": 3}


def test_fan_out_of_nothing(spark):
    seen = Observation()
    joins.attach_observed(frame(spark, "k int", []), frame(spark, "k int, w int", []), ["k"], seen).collect()
    assert joins.fan_out(seen) == {"rows_before": 0, "rows_after": 0, "greatest_fan_out": 0}


# --- key filter ------------------------------------------------------------

@pytest.mark.parametrize("bits", [joins.KEY_BITS, 1 << 16, 64])
def test_key_filter_loses_no_key(spark, bits):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("c"), F.lit("x").alias("__bits2"))
    keys = spark.range(0, 20_000, 40).select(F.col("id").alias("q"), (F.col("id") % 3).cast("string").alias("d"))
    kept = joins.among_keys(df, keys, {"k": "q", "c": "d"}, bits)
    assert kept.columns == df.columns
    assert keys.join(kept, (keys.q == kept.k) & (keys.d == kept.c), "left_anti").count() == 0
    n = kept.count()
    assert n >= 500 and (n < 510 if bits == joins.KEY_BITS else n < 800 if bits == 1 << 16 else n <= 20_000)
    assert joins.among_keys(df, keys.limit(0), {"k": "q", "c": "d"}, bits).count() == 0


def test_children_of_other_months_are_left_out_before_they_are_grouped(spark, tmp_path):
    src = {name: source(spark, name, []) for name in SOURCES}
    months = range(1, 9)
    src["src4_header"] = source(spark, "src4_header", [head4(str(m), ord_dt=dt.datetime(2021, m, 5)) for m in months])
    src["src4_line"] = source(spark, "src4_line", [line4(str(m)) for m in months])
    rows = [dict(intgrt_cntry_cd="160", ord_no=str(m), shp_dt=dt.datetime(2021, m, 9)) for m in months]
    source(spark, "src4_consignment", rows).write.parquet(str(tmp_path / "c"))
    src["src4_consignment"] = spark.read.schema(SOURCES["src4_consignment"]).parquet(str(tmp_path / "c"))
    some = source4.conform_source4(src, (202103,), dt.datetime(2021, 9, 1))
    whole = source4.conform_source4(src, None, dt.datetime(2021, 9, 1)).filter("ord_mo_yr_id = 202103")
    assert records(some) == records(whole) and some.count() == 1
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and "bitmap_construct_agg" not in whole._jdf.queryExecution().optimizedPlan().toString()


def test_source_3_children_meet_the_months_orders_only(spark):
    src = {name: source(spark, name, []) for name in SOURCES}
    plan = source3.conform_source3(src, (202103,), dt.datetime(2021, 9, 1))
    assert plan.count() == 0


def test_key_filter_keeps_all_where_broadcasts_are_off(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.range(10).withColumnRenamed("id", "k")
        assert joins.among_keys(df, spark.range(1), {"k": "id"}).count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# --- texts cut by bytes ----------------------------------------------------

@pytest.mark.parametrize("text,n,wanted", [
    ("abc", 5, "abc"), ("abcdef", 4, "abcd"), ("aéé", 3, "aé"), ("aéé", 4, "aé"), ("aéé", 5, "aéé"), ("日本語", 7, "日本"), ("日本語", 5, "日"),
    ("🙂🙂", 7, "🙂"), ("🙂🙂", 4, "🙂"), ("a🙂", 3, "a"), ("", 3, ""), (None, 3, None)])
def test_cut_bytes_keeps_whole_characters(spark, text, n, wanted):
    assert one(spark, cut_bytes("t", n), t=(text, T.StringType())) == wanted


# --- control state shared by runs ------------------------------------------

def test_overlapping_daily_runs_keep_each_others_marks(spark, tmp_path, monkeypatch):
    run, path, control_path = dt.datetime(2021, 5, 20, 10), str(tmp_path / "mart"), str(tmp_path / "control")
    src = _sources(spark, run)
    other = frame(spark, "src string, ord_mo_yr_id int, updt_on_last_run_flg int", [("EU_ATLAS", 202104, 1)])
    publish_, seen = refresh.publish, []

    def publish_meanwhile(*args, **kw):
        done = publish_(*args, **kw)
        # Another run finishes a month of another source before this one marks its own.
        state.change_state(spark, control_path, PENDING, lambda held: held.unionByName(other))
        seen.append(done.version)
        return done

    monkeypatch.setattr(refresh, "publish", publish_meanwhile)
    done = refresh.daily_run(src, control_path, path, run)
    assert seen == [1] and done.months == (202103, 202104, 202105) and done.fan_out["rows_before"] == 0
    assert records(done.state) == [("EU_ATLAS", 202104, 1), *[("EU_HYBR_NON_EOM", m, 1) for m in (202103, 202104, 202105)]]
    assert publish.read_table(spark, path).count() == 3
