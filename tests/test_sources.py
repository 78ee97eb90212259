"""Hand-made cases of the four source plans, history and invoices."""

import datetime as dt
from decimal import Decimal

import pytest

from orderloom.plans.history import conform_history
from orderloom.plans.invoices import extract_invoices, months_to_reload
from orderloom.plans.source1 import conform_source1
from orderloom.plans.source2 import conform_source2
from orderloom.plans.source3 import conform_source3
from orderloom.plans.source4 import conform_source4
from orderloom.plans.source_map import sources_by_month
from orderloom.sources.schemas import INVOICES, MART, SOURCES

from .helpers import records, source

RUN = dt.datetime(2021, 10, 5, 10, 0)


def tables(spark, **rows):
    """Source frames by name; those not given are empty."""
    return {name: source(spark, name, rows.get(name, [])) for name in SOURCES}


def day(y, m, d, *t):
    return dt.datetime(y, m, d, *t)


# --- source 1

def head1(ord=1, **kw):
    return dict(ord=ord, comb_ord=ord, ctl_aff="040", cntry="300", ord_dt=20210405, ord_tm=93005, shp_distb=9, ord_distb=8,
                vol_distb=8, comb_ord_flg="N", dlvr_dt=20210410, ord_type="STD", **{k: v for k, v in kw.items()})


def line1(ord=1, ord_ln=1, **kw):
    base = dict(ord=ord, ord_ln=ord_ln, ref_ln=ord_ln, ln_type="O", item_type="I", item_disp=" ", item="1234EN ", item_qty=Decimal(2), cntry="300")
    return {**base, **kw}


def run1(spark, heads, lines, months=202104, **more):
    return conform_source1(tables(spark, src1_header=heads, src1_line=lines, **more), months, RUN)


def test_source1_row(spark):
    df = run1(spark, [{**head1(), "ctl_aff": "   ", "intgrt_ctl_aff": "040", "ord_src": " ", "ord_curcy": "CIP"}], [line1()],
              src1_channel=[dict(cntry_cd="300", ord_type_cd="STD", ord_src_cd="*", glbl_sales_chnl_cd="WEB")])
    assert df.schema.names == MART.names
    row = df.first()
    assert (row["oper_aff_id"], row["ord_channel"], row["curcy_cd"]) == (40, "WEB", "GBP")
    assert (row["ord_dt"], row["shp_mo_yr_id"], row["ord_item_base_cd"]) == (day(2021, 4, 5, 9, 30, 5), 202104, "1234")


def test_source1_shipped_quantity_rules(spark):
    lines = [
        line1(ord_ln=1, item_disp="E"),                                 # head of a bundle with a product below
        line1(ord_ln=2, ref_ln=1, ln_type=None, item="PART1"),          # the component, without a line type
        line1(ord_ln=3, item_disp="S"),                                 # replaced
        line1(ord_ln=4),                                                # plain
        line1(ord_ln=5, item_type="P"),                                 # no product
        line1(ord_ln=6, item_disp="E"),                                 # E with nothing below
        line1(ord_ln=7, item_disp="E"),                                 # E with only a promotion below
        line1(ord_ln=8, ref_ln=7, ln_type="P", item="PROMO"),
    ]
    got = records(run1(spark, [head1()], lines), "ord_ln_id", "ord_qty", "shp_qty", "ord_item_cd")
    assert [(n, int(o), int(s), c) for n, o, s, c in got] == [
        (1, 2, 0, "1234EN"), (2, 0, 2, "1234EN"), (3, 2, 0, "1234EN"), (4, 2, 2, "1234EN"), (5, 2, 0, "1234EN"),
        (6, 2, 0, "1234EN"), (7, 2, 2, "1234EN"), (8, 0, 2, "1234EN")]


def test_source1_takes_the_country_of_the_first_order(spark):
    heads = [head1(1), {**head1(2), "comb_ord": 1, "cntry": "620"}]
    got = records(run1(spark, heads, [line1(1), line1(2, cntry="620")]), "ord_id", "oper_cntry_id")
    assert got == [(1, 300), (2, 300)]


def test_source1_customer_orders(spark):
    def kind(**kw):
        row = run1(spark, [{**head1(), **kw}], [line1()]).first()
        return row["account_type_ord"], row["account_id"]

    assert kind(distb_ord_nbr="X", vol_distb=7) == ("Member", 8)
    assert kind(distb_ord_nbr="BBB", vol_distb=7) == ("ABO", 7)
    assert kind(distb_ord_nbr="MBR") == ("Member", 8)
    assert kind(distb_ord_nbr=None, vol_distb=7) == ("ABO", 7)
    assert kind(distb_ord_nbr="X", vol_distb=7, comb_ord_flg="Y", shp_distb=8) == ("ABO", 7)
    assert kind(distb_ord_nbr="X", vol_distb=7, ord_type="EMP") == ("Employee", 8)


@pytest.mark.parametrize("month, old, new", [(202108, 1, 0), (202109, 0, 1)])
def test_moving_affiliates_change_source(spark, month, old, new):
    key = month * 100 + 5
    one = run1(spark, [{**head1(), "ctl_aff": "150", "ord_dt": key}], [line1()], months=month)
    four = run4(spark, [{**head4(), "aff_cd": "150", "ord_dt": day(month // 100, month % 100, 5)}], [{**line4(), "aff_cd": "150"}], months=month)
    assert (one.count(), four.count()) == (old, new)
    both = [{**head1(), "ctl_aff": "150", "ord_dt": 20210805}, {**head1(2), "ctl_aff": "150", "ord_dt": 20210905}]
    assert records(run1(spark, both, [line1(), line1(2)], months=None), "ord_id") == [(1,)]


def test_order_numbers_used_again_in_another_month_stay_apart(spark):
    heads = [head1(), {**head1(), "ord_dt": 20210505, "inv_nbr": "second"}]
    got = run1(spark, heads, [line1(), line1(ord_ln=2, ref_ln=1)], months=None)
    per_month = run1(spark, heads, [line1(), line1(ord_ln=2, ref_ln=1)], months=202104).unionByName(
        run1(spark, heads, [line1(), line1(ord_ln=2, ref_ln=1)], months=202105))
    assert records(got) == records(per_month) and got.count() == 4


# --- source 2

def head2(ord_no=1, **kw):
    return {**dict(intgrt_aff_cd="570", ord_no=ord_no, shp_cntry="NA", ord_dt=day(2021, 1, 31, 23, 30), ord_type="STD",
                   shp_imc_no="5701", vol_imc_no="5701", ord_imc_no="5701", shp_adr_ln_1="x"), **kw}


def line2(ord_no=1, ord_ln_no=1, oracle_line_id=1, **kw):
    return {**dict(ord_no=ord_no, intgrt_aff_cd="570", ord_ln_no=ord_ln_no, oracle_line_id=oracle_line_id, item_type="STD",
                   ord_item="1234EN", unit_sell_price=Decimal(3), ord_qty=Decimal(2), shp_qty=Decimal(1), item_disp_cd=" "), **kw}


def run2(spark, heads, lines, months=202102, invoices=()):
    return conform_source2(tables(spark, src2_header=heads, src2_line=lines, invoices=list(invoices)), months, RUN)


def invoice2(nature, code="1", account=1):
    return dict(aff_id=570, invoice_cd=code, vol_account_id=account, ord_bus_natr_cd=nature, ord_mo_yr_id=202102)


def test_source2_shifts_into_the_next_month(spark):
    row = run2(spark, [head2()], [line2(ord_imc_no="5707")]).first()
    assert (row["ord_dt"], row["ord_mo_yr_id"], row["shp_cntry_id"]) == (day(2021, 2, 1, 6, 30), 202102, 740)
    assert (row["vol_account_id"], row["ord_account_id"], row["account_type_ord"]) == (1, 7, "ABO")
    assert (row["ord_ln_disp_cd"], float(row["adj_ln_lc_net"])) == ("*", 6.0)
    assert run2(spark, [head2()], [line2()], months=202101).count() == 0


def test_source2_invoice_decides_the_account_and_multiplies_lines(spark):
    lines = [line2(ord_imc_no="5707"), line2(ord_ln_no=2, oracle_line_id=5)]
    got = records(run2(spark, [head2()], lines, invoices=[invoice2("3"), invoice2("1"), invoice2("1", code="dirty")]),
                  "ref_ln_id", "ord_ln_id", "account_type_ord", "account_id")
    assert got == [(1, 1, "ABO", 1), (1, 1, "Member", 7), (2, 3, "ABO", 1), (2, 3, "Member", 1)]


def test_source2_bundle_item(spark):
    lines = [line2(item_type="MODEL", ord_item="BUNDLE"), line2(oracle_line_id=2, item_type="OPTION", ord_item="PART")]
    got = records(run2(spark, [head2()], lines), "ord_ln_id", "ord_item_cd", "shp_item_cd", "ord_qty", "shp_qty")
    assert [(a, b, c, int(d), int(e)) for a, b, c, d, e in got] == [(1, "BUNDLE", "BUNDLE", 2, 0), (2, "BUNDLE", "PART", 0, 1)]


def test_source2_combined_orders_share_a_number(spark):
    heads = [head2(5, ord_type="ZA_COMBINED_ORDER"), head2(7, ord_type="ZA_COMBINED_ORDER", vol_imc_no="5702"), head2(9)]
    got = records(run2(spark, heads, [line2(5), line2(7), line2(9)]), "ord_id", "comb_ord_id", "comb_ord_flag")
    assert got == [(5, 5, "true"), (7, 5, "true"), (9, 9, "false")]


def test_source2_stored_twice_counts_twice(spark):
    got = records(run2(spark, [head2(), head2(shp_cntry="BW")], [line2(), line2(ord_ln_no=2)]), "ref_ln_id", "ord_ln_id", "shp_cntry_id")
    assert got == [(1, 1, 740), (1, 1, 750), (2, 3, 740), (2, 3, 750)]


# --- source 3

def head3(sales_order_id="1", **kw):
    return {**dict(iso_country_code="AU", sales_order_id=sales_order_id, affiliate_code="030", amway_sales_entity="030",
                   order_date_time=day(2021, 4, 5), total_order_value="120", total_tax_amount="20"), **kw}


def line3(sales_order_id="1", order_line_id="1", price="30", **kw):
    return {**dict(sale_country_code="AU", sales_order_id=sales_order_id, order_line_id=order_line_id, base_item_id="1234EN",
                   line_price=price, affiliate_code="030"), **kw}


def fee3(code="delivery", amount="10", tax=None, sales_order_id="1"):
    return dict(sales_order_id=sales_order_id, sale_country_code="AU", fee_code=code, fee_amount=amount, fee_tax_total_amount=tax, affiliate_code="030")


def place3(warehouse="W1", **kw):
    return {**dict(sales_order_id="1", amway_sales_entity="030", warehouse_code=warehouse, delivery_iso_country_code="SG",
                   order_date_time=day(2021, 4, 6), affiliate_code="030"), **kw}


def run3(spark, months=202104, **rows):
    return conform_source3(tables(spark, **{f"src3_{k}": v for k, v in rows.items()}), months, RUN)


def test_amounts_keep_the_decimals_of_their_source(spark):
    row = run2(spark, [head2()], [line2(unit_sell_price=Decimal("0.1234"), ord_qty=Decimal("2.5"), extend_pv_amt=Decimal("12.345"))]).first()
    assert (row["adj_ln_lc_net"], row["adj_ln_pv"]) == (Decimal("0.3085"), Decimal("12.345"))
    row = run4(spark, [head4()], [line4(adj_item_price_amt="0.004", item_pv_amt=12.345)]).first()
    assert (row["adj_ln_lc_net"], row["adj_ln_pv"]) == (Decimal("0.004"), Decimal("12.345"))
    thirds = [line3(line_price="0.004"), line3(order_line_id="2", line_price="0.006")]
    got = run3(spark, header=[head3()], line=thirds, fees=[fee3()])
    assert records(got, "ord_ln_id", "adj_ln_lc_net") == [(1, Decimal("36.00")), (2, Decimal("54.00"))]


def test_source3_prorates_the_net_value(spark):
    two = [line3(), line3(order_line_id="2", price="70")]
    got = run3(spark, header=[head3()], line=two, fees=[fee3()])
    assert records(got, "ord_ln_id", "adj_ln_lc_net") == [(1, Decimal("27.00")), (2, Decimal("63.00"))]
    assert [r[1] for r in records(run3(spark, header=[head3()], line=two), "ord_ln_id", "adj_ln_lc_net")] == [None, None]
    zero = [line3(price="5"), line3(order_line_id="2", price="-5")]
    assert [r[1] for r in records(run3(spark, header=[head3()], line=zero, fees=[fee3()]), "ord_ln_id", "adj_ln_lc_net")] == [None, None]


def test_source3_rounding_fees_are_no_delivery_fees(spark):
    fees = [fee3("netRoundOff_increase", "1"), fee3("other", "5")]
    row = run3(spark, header=[head3()], line=[line3()], fees=fees, consignment=[place3()]).first()
    assert row["delivery_fee_net"] == Decimal("5.00") and row["adj_ln_lc_net"] == Decimal("94.00")
    unplaced = run3(spark, header=[head3()], line=[line3()], fees=fees).first()
    assert unplaced["delivery_fee_net"] == 0 and unplaced["shp_cntry_id"] == 30


def test_source3_two_places_make_two_rows_and_a_combined_order(spark):
    got = run3(spark, header=[head3()], line=[line3()], consignment=[place3("W1"), place3("W1"), place3("W2")])
    assert records(got, "whse_cd", "comb_ord_flag", "shp_cntry_id") == [("W1", "true", 530), ("W2", "true", 530)]
    other_month = run3(spark, header=[head3()], line=[line3()], consignment=[place3(order_date_time=day(2021, 5, 6))])
    assert records(other_month, "whse_cd", "comb_ord_flag") == [(None, "false")]


def test_source3_orders_of_one_group_are_combined_within_a_month(spark):
    heads = [head3("1", group_order_id=7), head3("2", group_order_id=7), head3("3", group_order_id=7, order_date_time=day(2021, 5, 1))]
    got = run3(spark, months=None, header=heads, line=[line3("1"), line3("2"), line3("3")])
    assert records(got, "ord_id", "comb_ord_flag", "comb_ord_id") == [(1, "true", 7), (2, "true", 7), (3, "false", 7)]


def test_source3_shipping_and_quantities(spark):
    row = run3(
        spark, header=[head3(order_price_list=" AmwayDefaultABOPriceGroup ", volume_sales_account_id="5", ordering_sales_account_id="6")],
        line=[line3(shipped_quantity=Decimal(3), ordered_quantity=Decimal(9), cancelled_quantity=Decimal(2))],
        fulfilment=[dict(sales_order_id="1", sale_country_code="AU", order_line_id=1, fulfilled_date=day(2021, 4, d)) for d in (7, 9, 8)],
    ).first()
    assert (row["shp_dt"], row["ord_shp_flag"], int(row["ord_qty"]), int(row["shp_qty"])) == (day(2021, 4, 9), "true", 3, 7)
    assert (row["account_type_ord"], row["account_id"]) == ("ABO", 5)


def test_source3_invoices_multiply_lines(spark):
    inv = [dict(sale_country_code="AU", sales_order_id="1", order_line_id=n, invoice_number=v) for n, v in (("1", "a"), ("1", "b"), ("2", "c"))]
    assert records(run3(spark, header=[head3()], line=[line3()], invoice=inv), "inv_cd") == [("a",), ("b",)]


# --- source 4

def head4(ord_no="1", **kw):
    return {**dict(cntry_cd="160", aff_cd="160", ord_dt=day(2021, 4, 5), ord_no=ord_no, vol_imc_no="5", bill_imc_no="77"), **kw}


def line4(ord_no="1", ord_ln_no="1", **kw):
    return {**dict(cntry_cd="160", aff_cd="160", ord_no=ord_no, ord_ln_no=ord_ln_no, item_id="1234EN", item_qty_amt=4.0), **kw}


def run4(spark, heads, lines, months=202104, ships=()):
    return conform_source4(tables(spark, src4_header=heads, src4_line=lines, src4_consignment=list(ships)), months, RUN)


def test_source4_quantity_on_the_first_line_of_an_item(spark):
    lines = [line4(ord_cd="X"), line4(ord_ln_no="2", ord_cd="X"), line4(ord_ln_no="3", compnt_qty="9")]
    got = records(run4(spark, [head4()], lines), "ord_ln_id", "ord_qty", "shp_qty")
    assert [tuple(map(int, r)) for r in got] == [(1, 4, 4), (2, 0, 4), (3, 9, 4)]


def test_source4_drops_lines_without_an_order_in_the_month(spark):
    assert records(run4(spark, [head4(), head4("2", ord_dt=day(2021, 5, 1))], [line4(), line4("2"), line4("3")]), "ord_id") == [(1,)]


def test_source4_placeholder_accounts(spark):
    def account(**kw):
        row = run4(spark, [head4(**kw)], [line4(cntry_cd=kw.get("cntry_cd", "160"))]).first()
        return row["account_type_ord"], row["account_id"]

    kind, number = account(vol_imc_no="3000001", dlvry_addr_fam_nm="Ann")
    assert kind == "FOA" and number > 77
    assert account(vol_imc_no="3000001", dlvry_addr_fam_nm=" ")[1] is None
    assert account(cntry_cd="620", vol_imc_no="620", dlvry_addr_fam_nm="Ann") == ("FOA", number)
    assert account(bill_imc_type_cd=" E ") == ("Employee", 77)
    assert account(bill_imc_type_cd="VIP Customer") == ("ABO", 77)
    assert account() == ("Customer", 77)


def test_source4_last_shipment(spark):
    ships = [dict(intgrt_cntry_cd="160", ord_no="01", shp_dt=day(2021, 4, d)) for d in (6, 8, 7)]
    intgrt = dict(intgrt_cntry_cd="160")
    assert run4(spark, [head4(**intgrt)], [line4(**intgrt)], ships=ships).first()["shp_dt"] == day(2021, 4, 8)
    assert run4(spark, [head4()], [line4()], ships=ships).first()["shp_dt"] is None


# --- invoices, history, source map

def txn(ref="R", cust=1, d=1, **kw):
    return {**dict(aff_no=570, trx_sourc_cd=" 003", bus_entty_no=570, ord_dt=day(2021, 4, d), orgnl_ref_txt=ref, bns_cust_id=cust), **kw}


def test_invoices_keep_the_earliest_and_fold(spark):
    rows = [txn(orgnl_ord_no="9", ord_bus_natr_cd=" 3 "), txn(orgnl_ord_no="8"), txn(d=2, orgnl_ord_no="1"), txn(ref=None), txn(trx_sourc_cd="004", ref="Z")]
    got = extract_invoices(tables(spark, invoice_txn=rows, invoice_customer=[dict(bns_cust_id=1, aff_no=30, ibo_no=" 55 ")]), None, RUN)
    assert got.schema.names == INVOICES.names
    assert records(got, "invoice_cd", "org_ord_id", "ord_bus_natr_cd", "vol_account_id", "ord_mo_yr_id") == [("R", 8, "3", 55, 202104)]


def test_months_to_reload_needs_all_stamps_and_rolls_over_january(spark):
    run = dt.datetime(2021, 1, 10, 10)
    def touched(month_day, **kw):
        stamps = dict(trx_creat_dtm=day(2020, 11, 1), audit_creat_dtm=day(2021, 1, 10, 3), audit_chng_dtm=day(2020, 12, 1))
        return txn(ord_dt=month_day, **{**stamps, **kw})
    rows = [touched(day(2020, 12, 5)), touched(day(2020, 11, 5)), touched(day(2021, 1, 2), audit_chng_dtm=None)]
    frame = source(spark, "invoice_txn", rows)
    assert [r[0] for r in months_to_reload(frame, run).collect()] == [202012]
    assert [r[0] for r in months_to_reload(frame, run.replace(hour=22)).collect()] == [202012, 202011]


def test_history_roles_and_gaps(spark):
    demand = dict(ord_mo_yr_key_no=201501, oper_cntry_key_no=5, ord_no=1, ord_ln_no=1, ord_dt_key_no=20150110, shp_dt_key_no=0,
                  vol_imc_key_no=1, ord_imc_key_no=2, shp_imc_key_no=3, imc_key_no=1, ord_item_key_no=1)
    src = tables(
        spark, hist_demand=[demand, {**demand, "ord_ln_no": 2}, {**demand, "oper_cntry_key_no": 999}],
        hist_detail=[dict(ord_mo_yr_key_no=201501, oper_cntry_key_no=5, ord_no=1, ord_ln_no=1, whse_key_no=1, ord_whse_key_no=2)],
        hist_warehouse=[dict(whse_key_no=1, whse_cd="A"), dict(whse_key_no=2, whse_cd="B")],
        hist_account=[dict(imc_key_no=1, imc_no=11, imc_cntry_key_no=5), dict(imc_key_no=2, imc_no=22, imc_cntry_key_no=999)],
        hist_item=[dict(item_key_no=1, cntry_key_no=5, item_no=" 123A")],
    )
    got = records(conform_history(src, [201501], RUN), "ord_ln_id", "whse_cd", "ord_whse_cd", "account_id", "vol_account_id",
                  "ord_account_id", "ord_item_base_cd", "ord_canc_flag", "shp_dt")
    assert got == [(1, "A", "B", 11, 11, None, "123", "false", None), (2, None, None, 11, 11, None, "123", None, None)]


def test_sources_by_month(spark):
    rows = [dict(cntry_id=c, aff_id=a, launch_mo_yr_id=m, new_system_nm=s) for c, a, m, s in
            [(10, 1, 202001, "OLD"), (10, 1, 202104, "NEW"), (20, 1, 202001, "OLD"), (30, 2, 202105, "NEW"), (30, 2, 202001, "OLD")]]
    got = records(sources_by_month(source(spark, "source_map", rows), 202104), "src", "cntry_list", "aff_list")
    assert got == [("NEW", "10", "1"), ("OLD", "20, 30", "2")]
