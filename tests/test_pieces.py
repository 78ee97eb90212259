"""Jobs done in pieces: the rows of the whole job, without its shuffle files all at once."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.catalogue import queries as catalogue
from orderloom.catalogue.standins import RUN_TS, Standins
from orderloom.operators import pieces
from orderloom.plans import refresh
from orderloom.session import release, shared_folder
from orderloom.sources import publish
from orderloom.sources.schemas import SOURCES

from .helpers import frame, records, source

SF = "/root/testdata/sf0.001"
ROWS = "ord_mo_yr_id int, cntry_grp string, v int"


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(pieces, "LINES", 1600)


@pytest.fixture(scope="module")
def tables(spark):
    return catalogue._WithInvoices(Standins(spark, SF))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("plan", refresh.CONFORM)
def test_pieces_give_the_rows_of_the_whole(tables, small_pieces, plan):
    assert len(pieces.pieces_of(tables[refresh.LINE_TABLES[plan]])) > 2
    for months in (None, (202104, 202105)):
        assert rows(refresh.conform_stored(tables, months, RUN_TS, (plan,))) == rows(plan(tables, months, RUN_TS))


def test_a_small_table_is_one_piece_and_stays_a_plan(tables):
    plan = refresh.conform_stored(tables, None, RUN_TS, refresh.CONFORM[3:])._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "mart_rows" not in plan


def shuffled(spark):
    """Bytes of the shuffle files on disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f"{top}/{f}") for d in folders for top, _, files in os.walk(d) for f in files if f.startswith("shuffle"))


def test_shuffle_files_of_a_piece_go_before_the_next(spark, tables, small_pieces):
    def most(frames):
        release(spark)
        seen = []
        for df in frames:
            df.write.format("noop").mode("overwrite").save()
            seen.append(shuffled(spark))
        return max(seen)

    plan = refresh.conform_source2
    whole = most([plan(tables, None, RUN_TS)])
    assert 0 < most(refresh.conform_pieces(tables, None, RUN_TS, plans=(plan,))) < 0.7 * whole


def test_nothing_of_the_pieces_is_left(spark, tables, small_pieces):
    before = set(os.listdir(shared_folder(spark)))
    for df in refresh.conform_pieces(tables, None, RUN_TS, plans=refresh.CONFORM[2:3]):
        assert df.limit(1).count() == 1
    left = [n for n in os.listdir(shared_folder(spark)) if n not in before]
    assert not [n for n in left if n.startswith("orders3")]
    assert [os.listdir(f"{shared_folder(spark)}/{n}") for n in left if "_pieces-" in n and any(
        f.startswith(pieces.PIECE) for f in os.listdir(f"{shared_folder(spark)}/{n}"))] == []


def test_numbers_written_otherwise_and_missing_ones(spark, monkeypatch):
    src = {name: source(spark, name, []) for name in SOURCES}
    heads = [dict(intgrt_cntry_cd="160", intgrt_aff_cd="160", ord_dt=dt.datetime(2021, 5, 5), ord_no=n) for n in ("7", "08", "9")]
    lines = [dict(intgrt_cntry_cd="160", intgrt_aff_cd="160", ord_no=n, ord_ln_no=str(i), item_id="A", item_qty_amt=1.0)
             for i, n in enumerate(("007", "7", "8", " 9", None, "x"))]
    src["src4_header"], src["src4_line"] = source(spark, "src4_header", heads), source(spark, "src4_line", lines)
    src["src4_consignment"] = source(spark, "src4_consignment", [dict(intgrt_cntry_cd="160", ord_no=n, shp_dt=dt.datetime(2021, 5, 6)) for n in ("0007", None)])
    plan, run = refresh.conform_source4, dt.datetime(2021, 9, 1)
    whole = rows(plan(src, None, run))
    assert len(whole) == 4
    monkeypatch.setattr(pieces, "LINES", 1)
    assert rows(refresh.conform_stored(src, None, run, (plan,))) == whole


def test_frames_are_published_in_one_step(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(frame(spark, ROWS, [(202101, "A", 9), (202103, "A", 9)]), path, (202101, 202103))
    given = [[(202101, "A", 1), (202102, "B", 2)], [(202101, "A", 3), (202109, "A", 4)], []]
    done = publish.publish((frame(spark, ROWS, g) for g in given), path, (202101, 202102))
    assert done.version == 2 and done.aside == 1 and records(done.counts) == [(202101, 2), (202102, 1)]
    assert records(publish.read_table(spark, path)) == [(202101, "A", 1), (202101, "A", 3), (202102, "B", 2), (202103, "A", 9)]
    assert records(publish.kept_aside(spark, path), "v") == [(4,)]


@pytest.mark.parametrize("name", ["invoice_fan_out", "daily_rebuild_state", "daily_run_state", "history_load_twice"])
def test_runs_in_pieces_give_the_same(spark, monkeypatch, name):
    whole = rows(catalogue.queries()[name](spark, SF))
    monkeypatch.setattr(pieces, "LINES", 3000)
    assert rows(catalogue.queries()[name](spark, SF)) == whole


def test_history_in_pieces_is_added_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "LINES", 1)
    path = str(tmp_path / "mart")
    src = {name: source(spark, name, []) for name in SOURCES}
    src["hist_demand"] = source(spark, "hist_demand", [
        dict(ord_mo_yr_key_no=201501, oper_cntry_key_no=5, ord_no=n, ord_ln_no=1, ibo_price_lc_amt=Decimal(n)) for n in range(6)])
    assert records(refresh.history_load(src, path, RUN_TS, (201501,)).counts) == [(201501, 6)]
    assert publish.read_table(spark, path).agg(F.sum("adj_ln_lc_net")).first()[0] == 15
