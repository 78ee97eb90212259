import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.plans import refresh
from orderloom.plans.invoices import extract_invoices
from orderloom.sources import publish, state, versions, views
from orderloom.sources.catalog import Sources
from orderloom.sources.schemas import INVOICES, MART, SOURCES

from .helpers import frame, records, source
from .test_sources import head4, line4, txn

ROWS = "ord_mo_yr_id int, cntry_grp string, v int"


def read(spark, path, version=None):
    return records(publish.read_table(spark, path, version).select("ord_mo_yr_id", "cntry_grp", "v"))


def test_publish_replaces_whole_months_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(202101, "A", 1), (202101, "B", 2), (202102, "A", 3), (202103, "A", 4)]
    counts = publish.publish(frame(spark, ROWS, first), path, (202101, 202102, 202103))
    assert records(counts.counts) == [(202101, 2), (202102, 1), (202103, 1)] and counts.version == 1
    # The group B lost its rows, month 202102 lost all of them, 202103 is not published.
    again = frame(spark, ROWS, [(202101, "A", 9), (202103, "A", 8)])
    for version in (2, 3):
        done = publish.publish(again, path, (202101, 202102))
        assert records(done.counts) == [(202101, 1), (202102, 0)] and (done.version, done.aside) == (version, 1)
        assert read(spark, path) == [(202101, "A", 9), (202103, "A", 4)]
        assert records(publish.kept_aside(spark, path)) == [(202103, "A", 8, "another month")]
    # Versions stay as they were, and so do their counts.
    assert read(spark, path, 1) == sorted(first) and records(publish.month_counts(spark, path, 1)) == records(counts.counts)
    assert publish.changed_since(spark, path, 2) == (3, (202101,)) and publish.changed_since(spark, path, 0) == (3, (202101, 202103))


def test_publish_an_empty_month_into_a_new_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert records(publish.publish(frame(spark, ROWS, []), path, (202101,)).counts) == [(202101, 0)]
    assert read(spark, path) == [] and records(publish.kept_aside(spark, path)) == []


class Stopped(Exception):
    pass


def test_a_run_that_stops_or_is_overtaken_leaves_whole_months(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.publish(frame(spark, ROWS, [(202101, "A", 1), (202102, "A", 2)]), path, (202101, 202102))
    commit, seen = versions.Versions.commit, []

    def stop(self, after, facts):
        seen.append(read(spark, path))
        raise Stopped

    monkeypatch.setattr(versions.Versions, "commit", stop)
    with pytest.raises(Stopped):
        publish.publish(frame(spark, ROWS, [(202101, "A", 7)]), path, (202101,))
    assert seen == [[(202101, "A", 1), (202102, "A", 2)]] == [read(spark, path)]

    def overtaken(self, after, facts):
        monkeypatch.setattr(versions.Versions, "commit", commit)
        publish.publish(frame(spark, ROWS, [(202102, "B", 5)]), path, (202102,))
        return commit(self, after, facts)

    monkeypatch.setattr(versions.Versions, "commit", overtaken)
    assert publish.publish(frame(spark, ROWS, [(202101, "A", 9)]), path, (202101,)).version == 3
    assert read(spark, path) == [(202101, "A", 9), (202102, "B", 5)]


def test_versions_are_made_once(spark, tmp_path):
    store = versions.Versions(spark, str(tmp_path / "t"))
    assert store.newest() == 0 and store.read() == {} and store.commit(0, {"a": 1}) == 1
    with pytest.raises(versions.Taken):
        store.commit(0, {"a": 2})
    assert store.read() == {"a": 1} and store.numbers() == [1]


def test_rows_that_break_a_rule_are_kept_aside(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, "ord_mo_yr_id int, cntry_grp string, v int, c int", [
        (202101, "AFF_10", 1, 20), (202101, "AFF_480", 2, 20), (None, "OTHR", 3, 999), (202102, "AFF_10", 4, 480), (202101, "OTHR", 5, None)])
    done = publish.publish(rows, path, (202101,), reason=publish.in_its_group("c"))
    assert records(done.counts) == [(202101, 2)] and done.aside == 3
    assert records(publish.kept_aside(spark, path), "v", "reject_reason") == [
        (2, "another country group"), (3, "another month"), (4, "another month; another country group")]


def test_clean_forgets_old_versions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(4):
        publish.publish(frame(spark, ROWS, [(202101, "A", v), (202102, "A", v)]), path, (202101,) if v else (202101, 202102))
    assert publish.clean(spark, path, keep=2) == 2 and publish.clean(spark, path, keep=2) == 0
    assert read(spark, path) == [(202101, "A", 3), (202102, "A", 0)] and read(spark, path, 3) == [(202101, "A", 2), (202102, "A", 0)]
    assert publish.changed_since(spark, path, 1) == (4, (202101, 202102))


def test_months_are_read_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(frame(spark, ROWS, [(202101, "A", 1), (202102, "A", 2)]), path, (202101, 202102))
    some = publish.read_table(spark, path, months=(202102, 202105))
    assert records(some) == [(202102, "A", 2)] and all("ord_mo_yr_id=202102" in f for f in some.inputFiles())
    assert publish.read_table(spark, path, months=(202105,)).count() == 0
    with pytest.raises(ValueError, match="nothing is published"):
        publish.read_table(spark, str(tmp_path / "none"))


def test_a_view_is_refreshed_from_changed_months(spark, tmp_path):
    path, view, read_months = str(tmp_path / "t"), str(tmp_path / "v"), []

    def build(rows):
        read_months.append(sorted({r[0] for r in rows.select("ord_mo_yr_id").distinct().collect()}))
        return rows.groupBy("ord_mo_yr_id").agg(F.sum("v").alias("total"))

    def refresh_and_compare():
        done = views.refresh_view(spark, path, view, build)
        whole = publish.read_table(spark, path).groupBy("ord_mo_yr_id").agg(F.sum("v").alias("total"))
        assert records(publish.read_table(spark, view)) == records(whole)
        return done

    publish.publish(frame(spark, ROWS, [(202101, "A", 1), (202101, "B", 2), (202102, "A", 3), (202103, "A", 4)]), path, (202101, 202102, 202103))
    assert refresh_and_compare().version == 1 and refresh_and_compare() is None
    publish.publish(frame(spark, ROWS, [(202101, "A", 7)]), path, (202101, 202103))
    publish.publish(frame(spark, ROWS, [(202104, "A", 8)]), path, (202104,))
    assert refresh_and_compare().version == 2
    assert read_months == [[202101, 202102, 202103], [202101, 202104]]


def test_a_catalog_table_follows_what_is_published(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(frame(spark, ROWS, [(202101, "A", 1), (202101, "B", 2), (202102, "A", 3)]), path, (202101, 202102))
    assert views.register_table(spark, "followed", path, ("v",)) == (202101, 202102)
    assert records(views.partition_rows(spark, "followed")) == [
        ("ord_mo_yr_id=202101/cntry_grp=A", 1), ("ord_mo_yr_id=202101/cntry_grp=B", 1), ("ord_mo_yr_id=202102/cntry_grp=A", 1)]
    assert records(views.column_bounds(spark, "followed", ["v"])) == [("v", "1", "3", 0)]
    publish.publish(frame(spark, ROWS, [(202101, "A", 5), (202101, "A", 6)]), path, (202101, 202102))
    assert records(spark.table("followed").select("v")) == [(1,), (2,), (3,)]
    assert views.register_table(spark, "followed", path, ("v",)) == (202101, 202102) and views.register_table(spark, "followed", path) == ()
    assert records(spark.table("followed").select("v", "cntry_grp")) == [(5, "A"), (6, "A")]
    assert records(views.partition_rows(spark, "followed")) == [("ord_mo_yr_id=202101/cntry_grp=A", 2)]
    assert records(views.column_bounds(spark, "followed", ["v"])) == [("v", "5", "6", 0)]
    publish.publish(frame(spark, ROWS, [(202101, "A", 5)]), path, (202101,), add=True)
    with pytest.raises(ValueError, match="2 runs"):
        views.register_table(spark, "followed", path)
    spark.sql("DROP TABLE followed")


STATE = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])


def test_overlapping_changes_of_a_state(spark, tmp_path):
    path = str(tmp_path / "s")
    assert state.read_state(spark, path, STATE)[1].count() == 0
    version, rows = state.change_state(spark, path, STATE, lambda held: held.unionByName(frame(spark, "k string, n int", [("a", 0)])))
    assert version == 1 and records(rows) == [("a", 0)]
    # Two runs start from version 1.
    first, second = (state.read_state(spark, path, STATE)[1].withColumn("n", F.col("n") + d) for d in (1, 10))
    assert state.write_state(first, path, 1) == 2
    with pytest.raises(versions.Taken):
        state.write_state(second, path, 1)
    assert records(state.read_state(spark, path, STATE)[1]) == [("a", 1)]
    others = [5, 6]

    def step(held):
        made = held.withColumn("n", F.col("n") + 10)
        if others:
            # Another run is faster, twice.
            d = others.pop()
            state.write_state(held.withColumn("n", F.col("n") + d), path, state.read_state(spark, path, STATE)[0])
        return made

    version, rows = state.change_state(spark, path, STATE, step)
    assert version == 5 and records(rows) == [("a", 22)]
    assert records(state.read_state(spark, path, STATE, 2)[1]) == [("a", 1)]
    state.forget_states(spark, path, keep=1)
    assert versions.Versions(spark, path).numbers() == [5] and records(state.read_state(spark, path, STATE)[1]) == [("a", 22)]


def test_country_groups(spark):
    df = frame(spark, "c int", [(20,), (480,), (820,), (999,), (None,)])
    assert [r[0] for r in df.select(publish.country_group("c")).collect()] == ["AFF_10", "AFF_480", "AFF_150", "OTHR", "OTHR"]


def test_tolerant_load_counts_both_sides(spark, tmp_path):
    df = frame(spark, "id int, code string", [(1, "5"), (2, "x"), (3, None)])
    assert publish.tolerant_load(df, {"code": "int"}, str(tmp_path / "good"), str(tmp_path / "bad")) == (2, 1)
    assert records(spark.read.parquet(str(tmp_path / "bad")), "id", "code_given", "reject_reason") == [(2, "x", "code is not int")]
    assert records(spark.read.parquet(str(tmp_path / "good")), "id", "code") == [(1, 5), (3, None)]
    # Both sides are replaced, an empty one too; nothing else stays behind.
    again = frame(spark, "id int, code string", [(7, "8")])
    assert publish.tolerant_load(again, {"code": "int"}, str(tmp_path / "good"), str(tmp_path / "bad")) == (1, 0)
    assert records(spark.read.parquet(str(tmp_path / "good")), "id", "code") == [(7, 8)]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 0 and sorted(p.name for p in tmp_path.iterdir()) == ["bad", "good"]
    nothing = publish.tolerant_load(again.limit(0), {"code": "int"}, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert nothing == (0, 0) and spark.read.parquet(str(tmp_path / "good")).count() == 0


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_table(frame(spark, "a int", [(1,), (2,)]), path)
    publish.replace_table(frame(spark, "a int", [(3,)]), path)
    assert records(spark.read.parquet(path)) == [(3,)]


def test_statistics_of_a_table(spark):
    frame(spark, "a int, m int", [(1, 1), (2, 1)]).write.mode("overwrite").partitionBy("m").saveAsTable("stats_t")
    publish.gather_statistics(spark, "stats_t")
    facts = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED stats_t").collect()}
    assert "2 rows" in facts["Statistics"]
    spark.sql("DROP TABLE stats_t")


def test_sources_read_files_with_declared_columns_only(spark, tmp_path):
    path = str(tmp_path / "lines")
    source(spark, "src4_line", [line4()]).withColumn("extra", F.lit(1)).write.parquet(path)
    src = Sources(spark, {"src4_line": {"path": path}, "frame": frame(spark, "a int", [(1,)])})
    assert src["src4_line"].columns == SOURCES["src4_line"].names and "extra" in src.raw("src4_line").columns
    assert src["frame"].count() == 1 and len(src) == 2


def _sources(spark, run):
    src = {name: source(spark, name, []) for name in SOURCES}
    months = (3, 4, 5)
    src["src4_header"] = source(spark, "src4_header", [head4(str(m), ord_dt=dt.datetime(2021, m, 5), updt_dt=run) for m in months])
    src["src4_line"] = source(spark, "src4_line", [line4(str(m)) for m in months])
    return src


def test_daily_rebuild_end_to_end(spark, tmp_path):
    run, path = dt.datetime(2021, 5, 20, 22, 0), str(tmp_path / "mart")
    src = _sources(spark, run)
    empty = frame(spark, "src string, ord_mo_yr_id int, updt_on_last_run_flg int", [])
    done = refresh.daily_rebuild(src, empty, path, run)
    assert done.months == (202103, 202104, 202105)
    assert records(done.counts) == [(202103, 1), (202104, 1), (202105, 1)] and done.published.aside == 0
    assert records(done.report) == [("EU_HYBR_NON_EOM", "202105, 202104, 202103", "-")]
    # At night the done month that is not among the two newest is forgotten.
    assert records(done.state) == [("EU_HYBR_NON_EOM", 202104, 1), ("EU_HYBR_NON_EOM", 202105, 1)]
    stored = publish.read_published(spark, path, MART)
    assert stored.columns == [*MART.names, "cntry_grp"]
    assert records(stored, "ord_mo_yr_id", "cntry_grp") == [(202103, "AFF_160"), (202104, "AFF_160"), (202105, "AFF_160")]
    # The next run ages what was done and rebuilds the two newest months to the same rows.
    before = records(stored.drop("update_dt"))
    later = refresh.daily_rebuild(_sources(spark, run), done.state, path, run + dt.timedelta(hours=12))
    assert later.months == (202104, 202105)
    assert records(publish.read_published(spark, path, MART).drop("update_dt")) == before
    assert records(later.state) == [("EU_HYBR_NON_EOM", 202104, 1), ("EU_HYBR_NON_EOM", 202105, 1)]


def test_daily_rebuild_with_nothing_pending(spark, tmp_path):
    empty = frame(spark, "src string, ord_mo_yr_id int, updt_on_last_run_flg int", [])
    src = {name: source(spark, name, []) for name in SOURCES}
    run = refresh.daily_rebuild(src, empty, str(tmp_path / "mart"), dt.datetime(2021, 5, 20, 10))
    assert run.months == () and run.counts is None and run.state.count() == 0


def test_invoice_refresh(spark, tmp_path):
    run, path = dt.datetime(2021, 4, 20, 10), str(tmp_path / "inv")
    stamps = dict(trx_creat_dtm=run, audit_creat_dtm=run, audit_chng_dtm=run)
    src = {name: source(spark, name, []) for name in SOURCES}
    assert refresh.invoice_refresh(src, path, run) is None
    src["invoice_txn"] = source(spark, "invoice_txn", [txn(**stamps), txn(ref="Q", ord_dt=dt.datetime(2021, 3, 2), **stamps), txn(ref="P", ord_dt=dt.datetime(2021, 1, 2), **stamps)])
    assert records(refresh.invoice_refresh(src, path, run).counts) == [(202103, 1), (202104, 1)]
    assert records(publish.read_published(spark, path, INVOICES), "invoice_cd") == [("Q",), ("R",)]


def test_invoice_refresh_by_day_takes_old_months_if_asked(spark, tmp_path):
    run, path = dt.datetime(2021, 4, 20, 10), str(tmp_path / "inv")
    stamps = dict(trx_creat_dtm=run, audit_creat_dtm=run, audit_chng_dtm=run)
    src = {name: source(spark, name, []) for name in SOURCES}
    src["invoice_txn"] = source(spark, "invoice_txn", [txn(**stamps), txn(ref="P", ord_dt=dt.datetime(2021, 1, 2), **stamps)])
    assert records(refresh.invoice_refresh(src, path, run, every_month=True).counts) == [(202101, 1), (202104, 1)]


def test_invoice_refresh_keeps_too_wide_rows_aside(spark, tmp_path):
    run, path, rejects = dt.datetime(2021, 4, 20, 10), str(tmp_path / "inv"), str(tmp_path / "rejects")
    stamps = dict(trx_creat_dtm=run, audit_creat_dtm=run, audit_chng_dtm=run)
    src = {name: source(spark, name, []) for name in SOURCES}
    src["invoice_txn"] = source(spark, "invoice_txn", [txn(trx_sourc_cd="003", **stamps), txn(ref="Q", **stamps)])
    done = refresh.invoice_refresh(src, path, run, rejects)
    assert records(done.counts) == [(202104, 1)] and done.aside == 1
    assert records(spark.read.parquet(rejects), "invoice_cd", "reject_reason") == [("Q", "trx_sourc_cd is longer than 3")]


def test_history_load_appends(spark, tmp_path):
    path = str(tmp_path / "mart")
    src = {name: source(spark, name, []) for name in SOURCES}
    src["hist_demand"] = source(spark, "hist_demand", [dict(ord_mo_yr_key_no=m, oper_cntry_key_no=5, ord_no=1, ord_ln_no=1, ibo_price_lc_amt=Decimal(1)) for m in (200708, 200709, 202002, 202003)])
    refresh.history_load(src, path, dt.datetime(2021, 1, 1))
    assert sorted(r[0] for r in publish.read_table(spark, path).select("ord_mo_yr_id").collect()) == [200709, 202002]


def test_month_offsets(spark, tmp_path):
    path, asked = str(tmp_path / "dm"), []

    def build(months):
        asked.append(months)
        return frame(spark, "ord_mo_yr_id int, v int", [(m, 1) for m in months])

    done = refresh.refresh_offsets(build, path, dt.datetime(2021, 1, 4))
    assert asked == [(202011, 202012)] and records(done.published.counts) == [(202011, 1), (202012, 1)]
    totals = str(tmp_path / "totals"), lambda rows: rows.groupBy("ord_mo_yr_id").agg(F.sum("v").alias("total"))
    done = refresh.refresh_offsets(build, path, dt.datetime(2021, 2, 4), table="offsets", columns=["v"], view=totals)
    assert done.registered == (202011, 202012, 202101) and records(done.view.counts) == [(202011, 1), (202012, 1), (202101, 1)]
    assert records(views.partition_rows(spark, "offsets")) == [(f"ord_mo_yr_id={m}", 1) for m in (202011, 202012, 202101)]
    spark.sql("DROP TABLE offsets")


def test_long_invoice_texts_are_cut_before_they_are_grouped(spark):
    run = dt.datetime(2021, 4, 20, 10)
    src = {name: source(spark, name, []) for name in SOURCES}
    src["invoice_txn"] = source(spark, "invoice_txn", [txn(ref="x" * 240 + "a"), txn(ref="x" * 240 + "b"), txn(ref="y")])
    assert records(extract_invoices(src, (202104,), run), "invoice_cd") == [("x" * 240,), ("y",)]


def test_history_load_again_leaves_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "mart")
    src = {name: source(spark, name, []) for name in SOURCES}
    src["hist_demand"] = source(spark, "hist_demand", [dict(ord_mo_yr_key_no=m, oper_cntry_key_no=5, ord_no=1, ord_ln_no=1, ibo_price_lc_amt=Decimal(1)) for m in (200709, 202002)])
    for _ in range(2):
        refresh.history_load(src, path, dt.datetime(2021, 1, 1))
    assert publish.read_table(spark, path).count() == 2
    refresh.history_load(src, path, dt.datetime(2021, 1, 1), append=True)
    assert publish.read_table(spark, path).count() == 4
