"""Source tables made from the given tables, as SQL that both Spark and the checking engine read.

The order systems' own tables are not available, so each is derived from orders, lineitem,
customer, nation, part, supplier or events, whole: one order per order, one line per
(order, line number). Dates move 21 years ahead, so that the months around the affiliates'
move lie inside the range.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .. import fixed
from ..session import working_path

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
RUN_TS = dt.datetime(2022, 7, 29, 21, 30)
# Neighbours and a gap.
SOME_MONTHS = (202105, 202106, 202109)


def _case(column: str, values, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in values)
    return f"CASE {column} {arms} ELSE {default} END"


def _by_position(column: str, values, default: str = "NULL") -> str:
    return _case(column, enumerate(values), default)


_SRC4_CODES = ("'160'", "'090'", "'470'", "'250'", "'430'", "'420'", "'060'", "'110'", "'210'", "'620'", "'480'", "'999'")
_CC4 = _by_position("nat % 12", _SRC4_CODES)
_AFF4 = "CASE WHEN nat % 12 = 9 THEN '150' ELSE " + _CC4 + " END"
_AFF1 = _by_position("nat % 5", ("'040'", "'040'", "'150'", "'480'", "'999'"))
_CC1 = "lpad(cast(40 + nat as string), 3, '0')"
_AFF3 = "CASE WHEN reg < 4 THEN '030' ELSE '100' END"
_ISO3 = "CASE WHEN nat % 2 = 0 THEN 'AU' ELSE 'NZ' END"
_ENTITY3 = "CASE WHEN nat % 2 = 0 THEN '030' ELSE '240' END"
_VOL2 = ("CASE WHEN cust % 11 = 0 THEN '570' WHEN cust % 2 = 0 THEN '570' || cast(reg as string) "
         "ELSE cast(cust as string) END")
_DAY = "year({0}) * 10000 + month({0}) * 100 + day({0})"
_YM = "cast(year({0}) * 100 + month({0}) as int)"
_CODE = "lpad(cast(part as string), 5, '0') || CASE rf WHEN 'R' THEN 'RU' WHEN 'A' THEN 'A1' ELSE '' END"
# Amounts of four decimals, as the source tables declare no scale.
_FINE = "cast({0} * cast(1.25 as decimal(3,2)) as decimal(18,4))"
_HIST_KEY = _by_position("{0}", fixed.HISTORY_COUNTRY_KEYS[:24])

SQL = {
    # --- the two shapes everything else comes from
    "hd": """
        SELECT o.o_orderkey AS ord, o.o_custkey AS cust, o.o_orderstatus AS status,
               cast(o.o_totalprice as decimal(18,2)) AS total,
               o.o_orderdate + INTERVAL '252' MONTH AS dt,
               u.last_dt + INTERVAL '252' MONTH AS upd,
               o.o_orderpriority AS prio, c.c_nationkey AS nat, c.c_mktsegment AS seg, n.n_regionkey AS reg, g.comb
        FROM {orders} o
        JOIN {customer} c ON o.o_custkey = c.c_custkey
        JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        JOIN (SELECT o_custkey AS k, max(o_orderdate) AS last_dt FROM {orders} GROUP BY o_custkey) u ON o.o_custkey = u.k
        JOIN (SELECT cn.n_regionkey AS g_reg, oo.o_orderdate AS g_dt, min(oo.o_orderkey) AS comb
              FROM {orders} oo JOIN {customer} cc ON oo.o_custkey = cc.c_custkey JOIN {nation} cn ON cc.c_nationkey = cn.n_nationkey
              GROUP BY cn.n_regionkey, oo.o_orderdate) g ON n.n_regionkey = g.g_reg AND o.o_orderdate = g.g_dt
    """,
    "li": """
        SELECT l_orderkey AS ord, l_linenumber AS ln,
               min(l_partkey) AS part, min(l_suppkey) AS supp,
               cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) AS qty,
               cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) AS price,
               cast(sum(cast(l_tax as decimal(18,2))) as decimal(18,2)) AS tax,
               max(l_returnflag) AS rf, max(l_linestatus) AS ls,
               max(l_shipdate) + INTERVAL '252' MONTH AS shp
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber
    """,
    "lh": """
        SELECT l.*, h.cust, h.status, h.dt, h.prio, h.nat, h.seg, h.reg FROM {li} l JOIN {hd} h ON l.ord = h.ord
    """,
    # --- source 1
    "h1": """
        SELECT *, """ + _AFF1 + """ AS aff, """ + _CC1 + """ AS cc FROM {hd}
    """,
    "src1_header": """
        SELECT ord, comb AS comb_ord,
               CASE WHEN status = 'P' THEN 'CIP' ELSE 'EURO' END AS ord_curcy,
               CASE WHEN prio = '1-URGENT' THEN 'Y' WHEN prio = '5-LOW' THEN NULL ELSE 'N' END AS comb_ord_flg,
               'I' || cast(ord as string) AS inv_nbr,
               CASE WHEN status = 'F' THEN 'EMP' ELSE status END AS ord_type,
               CASE WHEN cust % 31 = 0 THEN repeat(seg, 40) ELSE seg END AS drop_cd, 'W' || cast(cust % 7 as string) AS whse, 'V' || cast(cust % 5 as string) AS ord_whse,
               cast(""" + _DAY.format("dt") + """ as int) AS ord_dt,
               cast((ord % 24) * 10000 + (ord % 60) * 100 + cust % 60 as int) AS ord_tm,
               CASE WHEN status = 'P' THEN 0 ELSE cast(""" + _DAY.format("(dt + INTERVAL '5' DAY)") + """ as int) END AS dlvr_dt,
               CASE WHEN prio = '5-LOW' THEN '  ' ELSE prio END AS ord_src,
               cast(cust % 20 as decimal(18,2)) AS ord_hndlg_price,
               CASE WHEN prio = '2-HIGH' THEN 'P' ELSE 'U' END AS ord_pay_stat,
               CASE WHEN nat = 7 THEN '   ' ELSE aff END AS ctl_aff, aff AS intgrt_ctl_aff,
               CASE WHEN nat = 6 THEN ' ' ELSE cc END AS cntry, cc AS intgrt_cntry_cd,
               cust AS vol_distb, cust + ord % 2 AS ord_distb, cast(reg as bigint) AS shp_distb, cust % 3 AS shp_adr,
               CASE WHEN seg = 'BUILDING' THEN 'Y' ELSE 'N' END AS ord_canc,
               CASE status WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE 'X' END AS ord_shp,
               CASE WHEN seg = 'MACHINERY' THEN 'N' ELSE 'Y' END AS pay_req,
               ord - 1 AS orgnl_ord,
               CASE prio WHEN '1-URGENT' THEN 'X' WHEN '2-HIGH' THEN 'BBB' WHEN '3-MEDIUM' THEN 'MBR' WHEN '4-NOT SPECIFIED' THEN 'Y' END AS distb_ord_nbr,
               upd AS last_updt_dt_key_no
        FROM {h1}
    """,
    "src1_line": """
        SELECT ord, ln AS ord_ln,
               CASE rf WHEN 'R' THEN 'O' WHEN 'A' THEN 'P' ELSE NULL END AS ln_type,
               ln - (ln - 1) % 3 AS ref_ln,
               CASE WHEN ls = 'F' AND rf = 'N' THEN 'G' ELSE 'I' END AS item_type,
               CASE WHEN qty < 10 THEN 'S' WHEN qty < 25 THEN 'E' ELSE ' ' END AS item_disp,
               ' ' || """ + _CODE + """ || ' ' AS item,
               qty AS item_qty, price AS item_price, tax AS item_pv, qty AS item_bv,
               '  ' AS cntry, """ + _CC1 + """ AS intgrt_cntry_cd
        FROM {lh}
    """,
    "src1_channel": """
        SELECT cc AS cntry_cd, CASE WHEN status = 'F' THEN 'EMP' ELSE status END AS ord_type_cd,
               CASE WHEN prio = '5-LOW' THEN '*' ELSE prio END AS ord_src_cd,
               'CH-' || max(seg) AS glbl_sales_chnl_cd
        FROM {h1} WHERE nat < 20 GROUP BY cc, status, prio
    """,
    "src1_address": """
        SELECT CASE WHEN aff = '150' THEN ' ' ELSE aff END AS intgrt_aff_cd, aff AS ctl_aff,
               cast(reg as bigint) AS distb_nbr, cust % 3 AS adr_seq,
               CASE WHEN max(prio) = '5-LOW' AND min(cust) % 2 = 0 THEN '  ' ELSE ' P' || cast(min(cust) as string) END AS post
        FROM {h1} GROUP BY aff, reg, cust % 3
    """,
    # --- source 2: evening orders, so the clock shift always crosses a day
    "src2_header": """
        SELECT CASE WHEN reg < 4 THEN '570' ELSE '999' END AS intgrt_aff_cd, ord AS ord_no,
               """ + _by_position("nat % 4", ("'ZA'", "'NA'", "'BW'", "'XX'")) + """ AS shp_cntry,
               dt + INTERVAL '1' HOUR * cast(18 + ord % 6 as int) AS ord_dt,
               CASE WHEN status = 'F' THEN 'ZA_COMBINED_ORDER' ELSE status END AS ord_type,
               '570' || cast(reg as string) AS shp_imc_no,
               """ + _VOL2 + """ AS vol_imc_no,
               CASE WHEN cust % 4 = 0 THEN '570' || cast(reg as string) ELSE '570' || cast(cust as string) END AS ord_imc_no,
               prio AS shp_adr_ln_1, 'ZARX' AS curcy_cd, seg AS sale_chnl, 'P' || cast(cust as string) AS shp_postl_cd,
               CASE prio WHEN '1-URGENT' THEN 'Y' WHEN '2-HIGH' THEN NULL ELSE 'N' END AS cancelled_flg,
               CASE prio WHEN '1-URGENT' THEN 'N' WHEN '2-HIGH' THEN NULL ELSE 'Y' END AS open_flg,
               upd AS updt_dt
        FROM {hd}
    """,
    "src2_line": """
        SELECT ord AS ord_no, CASE WHEN reg < 4 THEN '570' ELSE '999' END AS intgrt_aff_cd, 'W' || cast(supp % 9 as string) AS whse_cd,
               shp + INTERVAL '20' HOUR AS act_shp_dt,
               CASE WHEN rf = 'N' THEN NULL ELSE """ + _VOL2 + """ END AS vol_imc_no,
               CASE WHEN rf = 'N' THEN NULL ELSE cast(supp as string) END AS ord_imc_no,
               CASE WHEN ls = 'F' THEN NULL ELSE '570' || cast(part as string) END AS shp_imc_no,
               tax AS dlvry_fee, cast(floor((ln - 1) / 3) as int) + 1 AS ord_ln_no, cast(ln as bigint) AS oracle_line_id,
               CASE WHEN ls = 'O' THEN ' ' ELSE 'F' END AS item_disp_cd,
               CASE (ln - 1) % 3 WHEN 0 THEN 'MODEL' WHEN 1 THEN 'OPTION' ELSE 'STD' END AS item_type,
               """ + _CODE + """ AS ord_item,
               """ + _FINE.format("price") + """ AS unit_sell_price, qty AS ord_qty, tax AS extend_pv_amt, price AS extend_bv_amt,
               cast(qty - 1 as decimal(18,2)) AS shp_qty, CASE WHEN part % 29 = 0 THEN repeat(prio, 40) ELSE prio END AS shp_priority
        FROM {lh}
    """,
    "invoices2": """
        SELECT cast(570 as bigint) AS aff_id, '003' AS trx_sourc_cd, cast(570 as bigint) AS cntry_id, cast(0 as bigint) AS org_ord_id,
               dt AS ord_dt, dt AS atm_update_dt,
               CASE prio WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN '3' WHEN '3-MEDIUM' THEN '6' WHEN '4-NOT SPECIFIED' THEN '9' END AS ord_bus_natr_cd,
               CASE WHEN cust % 2 = 0 THEN cast(reg as bigint) ELSE cust END AS vol_account_id,
               cast(ord as string) AS invoice_cd, """ + _YM.format("(dt + INTERVAL '1' DAY)") + """ AS ord_mo_yr_id
        FROM {hd} WHERE seg <> 'FURNITURE'
        UNION ALL
        SELECT cast(570 as bigint), '003', cast(570 as bigint), cast(0 as bigint), dt, dt, '3',
               CASE WHEN cust % 2 = 0 THEN cast(reg as bigint) ELSE cust END,
               cast(ord as string), """ + _YM.format("(dt + INTERVAL '1' DAY)") + """
        FROM {hd} WHERE prio = '1-URGENT'
    """,
    # --- source 3
    "h3": """
        SELECT *, """ + _AFF3 + """ AS aff, """ + _ISO3 + """ AS iso, """ + _ENTITY3 + """ AS entity FROM {hd}
    """,
    "l3": """
        SELECT *, """ + _AFF3 + """ AS aff, """ + _ISO3 + """ AS iso, """ + _ENTITY3 + """ AS entity FROM {lh}
    """,
    "src3_header": """
        SELECT iso AS iso_country_code, cast(ord as string) AS sales_order_id, aff AS affiliate_code,
               entity AS amway_sales_entity, dt AS order_date_time,
               CASE WHEN prio = '1-URGENT' THEN cust ELSE NULL END AS group_order_id,
               'AUDX' AS iso_currency_code, seg AS sales_channel_code,
               cast(cust as string) AS volume_sales_account_id, cast(cust + 1 as string) AS ordering_sales_account_id,
               CASE WHEN cust % 3 = 0 THEN NULL ELSE cast(cust + 2 as string) END AS ship_to_sales_account_id,
               CASE WHEN status = 'P' THEN 'CANCELLED' ELSE 'OPEN' END AS order_status,
               CASE WHEN seg = 'MACHINERY' THEN 'false' ELSE 'true' END AS payment_required,
               CASE WHEN seg = 'BUILDING' THEN NULL ELSE 'PAID' END AS payment_status,
               CASE WHEN status = 'F' THEN 'none' WHEN status = 'O' THEN 'R-' || cast(ord - 1 as string) END AS original_order_id,
               cast(""" + _FINE.format("total") + """ as string) AS total_order_value,
               cast(cast(cust % 100 as decimal(18,2)) as string) AS total_tax_amount,
               CASE prio WHEN '1-URGENT' THEN ' AmwayDefaultRetailPriceGroup' WHEN '2-HIGH' THEN 'AmwayDefaultEmployeePriceGroup'
                         WHEN '3-MEDIUM' THEN 'AmwayDefaultABOPriceGroup' WHEN '4-NOT SPECIFIED' THEN 'other' END AS order_price_list,
               upd AS updt_dt
        FROM {h3}
    """,
    "src3_consignment": """
        SELECT cast(ord as string) AS sales_order_id, 'P' || cast(cust % 50 as string) AS delivery_postal_code,
               """ + _by_position("nat % 8", ("'MY'", "'PH'", "'SG'", "'BN'", "'VN'", "'AU'", "'NZ'", "'US'")) + """ AS delivery_iso_country_code,
               entity AS amway_sales_entity, 'W' || cast(supp % 2 as string) AS warehouse_code,
               CASE WHEN reg = 1 AND status = 'P' THEN dt + INTERVAL '40' DAY ELSE dt END AS order_date_time,
               aff AS affiliate_code
        FROM {l3} WHERE rf = 'N'
    """,
    "src3_line": """
        SELECT iso AS sale_country_code, cast(ord as string) AS sales_order_id, cast(ln as string) AS order_line_id,
               CASE WHEN ls <> 'O' THEN NULL WHEN part % 53 = 0 THEN 'B' || repeat('é', 700)
                    ELSE 'B' || lpad(cast(supp % 7 as string), 4, '0') || 'EN' END AS bundle_item_id,
               ' ' || """ + _CODE + """ AS base_item_id, cast(""" + _FINE.format("price") + """ as string) AS line_price,
               qty AS line_pv_amount, tax AS line_bv_amount,
               CASE WHEN rf = 'N' THEN NULL ELSE qty END AS shipped_quantity, CASE WHEN rf = 'A' THEN NULL ELSE tax END AS pending_quantity,
               qty AS ordered_quantity, CASE WHEN rf = 'R' THEN NULL ELSE tax END AS cancelled_quantity,
               'D' || cast(supp % 4 as string) AS demand_location, seg AS fulfillment_type, aff AS affiliate_code
        FROM {l3}
    """,
    "src3_fulfilment": """
        SELECT cast(l.l_orderkey as string) AS sales_order_id, h.iso AS sale_country_code,
               cast(l.l_linenumber as bigint) AS order_line_id, l.l_shipdate + INTERVAL '252' MONTH AS fulfilled_date
        FROM {lineitem} l JOIN {h3} h ON l.l_orderkey = h.ord WHERE l.l_linestatus = 'F'
    """,
    "src3_fees": """
        SELECT cast(ord as string) AS sales_order_id, iso AS sale_country_code,
               CASE rf WHEN 'A' THEN 'netRoundOff_increase' WHEN 'R' THEN 'delivery' ELSE 'handling' END AS fee_code,
               cast(""" + _FINE.format("qty") + """ as string) AS fee_amount, CASE WHEN rf = 'R' THEN NULL ELSE cast(tax as string) END AS fee_tax_total_amount,
               aff AS affiliate_code
        FROM {l3} WHERE ls = 'F'
    """,
    "src3_invoice": """
        SELECT h.iso AS sale_country_code, cast(l.l_orderkey as string) AS sales_order_id,
               cast(l.l_linenumber as string) AS order_line_id, CASE WHEN l.l_partkey % 23 = 0 THEN 'N' || repeat('é', 300) ELSE 'N' || cast(l.l_partkey as string) END AS invoice_number
        FROM {lineitem} l JOIN {h3} h ON l.l_orderkey = h.ord WHERE l.l_returnflag = 'A'
    """,
    # --- source 4
    "h4": """
        SELECT *, """ + _CC4 + """ AS cc, """ + _AFF4 + """ AS aff FROM {hd}
    """,
    "l4": """
        SELECT *, """ + _CC4 + """ AS cc, """ + _AFF4 + """ AS aff FROM {lh}
    """,
    "src4_header": """
        SELECT CASE WHEN nat = 13 THEN NULL ELSE cc END AS intgrt_cntry_cd, cc AS cntry_cd,
               CASE WHEN nat = 14 THEN NULL ELSE aff END AS intgrt_aff_cd, aff AS aff_cd, cc AS dlvry_addr_amway_cntry_cd,
               dt AS ord_dt, CASE prio WHEN '1-URGENT' THEN 'Y' WHEN '5-LOW' THEN NULL ELSE 'N' END AS comb_ord_flg,
               cast(ord - ord % 10 as string) AS comb_ord_no, cast(ord as string) AS ord_no, 'I' || cast(ord as string) AS inv_no,
               'EUR' AS ord_curcy_cd, seg AS ord_chnl_cd, 'W' || cast(cust % 7 as string) AS whse_nm,
               CASE WHEN status = 'P' THEN NULL ELSE 'V' || cast(cust % 5 as string) END AS ord_whse_nm,
               CASE WHEN cust % 9 = 0 THEN '  ' ELSE ' P' || cast(cust as string) || ' ' END AS dlvry_addr_post_cd,
               CASE WHEN cust % 5 = 0 THEN
                    CASE cc WHEN '160' THEN '3000001' WHEN '060' THEN '8' WHEN '480' THEN '5' WHEN '620' THEN '620' ELSE '3' END
                    ELSE cast(cust as string) END AS vol_imc_no,
               CASE WHEN cust % 10 = 0 THEN seg ELSE ' ' END AS dlvry_addr_fam_nm,
               CASE WHEN cust % 15 = 0 THEN NULL ELSE 'N' || cast(cust % 100 as string) END AS dlvry_addr_given_nm,
               cast(cust as string) AS bill_imc_no,
               CASE prio WHEN '1-URGENT' THEN ' E ' WHEN '2-HIGH' THEN 'I' WHEN '3-MEDIUM' THEN 'VIP Customer' WHEN '4-NOT SPECIFIED' THEN 'C' END AS bill_imc_type_cd,
               cast(cust + 1 as string) AS ord_imc_no, cast(cust + 2 as string) AS shp_imc_no,
               CASE WHEN status = 'P' THEN 'Y' ELSE 'N' END AS ord_canc_flg, CASE WHEN status = 'F' THEN 'Y' END AS ord_shp_flg,
               'Y' AS pay_req_flg, CASE WHEN seg = 'BUILDING' THEN 'PAID' ELSE 'OPEN' END AS ord_pay_stat_cd,
               cast(ord - 1 as string) AS orgnl_ord_no, status AS ord_type_cd, prio AS drop_cd,
               cast(cust % 20 as decimal(18,2)) AS dlvry_actual_cost_curcy_amt, seg AS dlvry_mode_cd, upd AS updt_dt
        FROM {h4}
    """,
    "src4_line": """
        SELECT CASE WHEN nat = 13 THEN NULL ELSE cc END AS intgrt_cntry_cd, cc AS cntry_cd,
               CASE WHEN nat = 14 THEN NULL ELSE aff END AS intgrt_aff_cd, aff AS aff_cd, cast(ord as string) AS ord_no,
               cast(ln as string) AS ord_ln_no, cast(ln - (ln - 1) % 3 as string) AS ref_ln_no, ls AS item_disp_desc,
               CASE WHEN ls = 'O' THEN 'B' || lpad(cast(supp % 3 as string), 4, '0') || 'EN' ELSE NULL END AS ord_cd,
               """ + _CODE + """ || ' ' AS item_id,
               CASE WHEN rf = 'N' THEN NULL ELSE cast(""" + _FINE.format("price") + """ as string) END AS adj_item_price_amt, cast(""" + _FINE.format("price") + """ as double) AS tot_pv_amt,
               CASE WHEN rf = 'N' THEN NULL ELSE cast(qty as string) END AS adj_item_price_pv_amt, cast(qty as double) AS item_pv_amt,
               CASE WHEN rf = 'A' THEN NULL ELSE cast(qty as string) END AS adj_item_price_bv_amt, cast(tax as double) AS item_bv_amt,
               CASE WHEN rf = 'A' THEN '2' ELSE NULL END AS compnt_qty, cast(qty as double) AS item_qty_amt,
               'K' || cast(supp as string) AS pos_consltnt_id
        FROM {l4}
    """,
    "src4_consignment": """
        SELECT CASE WHEN nat = 13 THEN NULL ELSE cc END AS intgrt_cntry_cd, cast(ord as string) AS ord_no, shp AS shp_dt
        FROM {l4} WHERE ls = 'F'
    """,
    # --- invoice transactions
    "invoice_txn": """
        SELECT """ + _by_position("reg", ("cast(570 as bigint)", "cast(30 as bigint)", "cast(570 as bigint)", "cast(30 as bigint)"), "cast(40 as bigint)") + """ AS aff_no,
               CASE WHEN prio = '5-LOW' THEN '004' ELSE ' 003' END AS trx_sourc_cd, cast(nat as bigint) AS bus_entty_no,
               CASE WHEN status = 'P' THEN NULL ELSE cast(ord as string) END AS orgnl_ord_no, dt AS ord_dt,
               CASE prio WHEN '1-URGENT' THEN ' 3 ' WHEN '2-HIGH' THEN '  ' WHEN '3-MEDIUM' THEN '6' END AS ord_bus_natr_cd,
               CASE WHEN seg = 'FURNITURE' THEN NULL ELSE seg END AS orgnl_ref_txt, cust AS bns_cust_id,
               dt AS trx_creat_dtm, upd AS audit_creat_dtm, CASE WHEN status = 'P' THEN NULL ELSE dt END AS audit_chng_dtm
        FROM {hd}
    """,
    "invoice_customer": """
        SELECT c_custkey AS bns_cust_id, CASE WHEN c_mktsegment = 'BUILDING' THEN cast(40 as bigint) ELSE cast(30 as bigint) END AS aff_no,
               cast(c_custkey % 700 as string) AS ibo_no
        FROM {customer}
    """,
    # --- source map: a system starts in a country with its first order there
    "source_map": """
        SELECT cast(nat as bigint) AS cntry_id, cast(reg as bigint) AS aff_id,
               min(""" + _YM.format("dt") + """) AS launch_mo_yr_id, status || '-' || seg AS new_system_nm
        FROM {hd} GROUP BY nat, reg, status, seg
    """,
    # --- history star
    "hist_demand": """
        SELECT """ + _YM.format("dt") + """ AS ord_mo_yr_key_no, cast(""" + _HIST_KEY.format("nat") + """ as bigint) AS oper_cntry_key_no,
               ord AS ord_no, cast(ln as bigint) AS ord_ln_no, cast(""" + _DAY.format("dt") + """ as int) AS ord_dt_key_no,
               CASE WHEN ls = 'O' THEN 0 ELSE cast(""" + _DAY.format("shp") + """ as int) END AS shp_dt_key_no,
               CASE prio WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 0 END AS comb_ord_flg, ord - ord % 10 AS comb_ord_no,
               cast(reg as bigint) AS curcy_key_no, cust AS imc_key_no, cust + 1 AS vol_imc_key_no,
               cast(supp as bigint) AS ord_imc_key_no, cust AS shp_imc_key_no, part AS ord_item_key_no, part + 1 AS shp_item_key_no,
               price AS ibo_price_lc_amt, tax AS pv_lc_amt, qty AS bv_lc_amt, qty AS ord_qty, qty AS shp_qty,
               seg AS deliverymode, 'K' || cast(supp as string) AS consultant_id
        FROM {lh}
    """,
    "hist_detail": """
        SELECT """ + _YM.format("dt") + """ AS ord_mo_yr_key_no, cast(""" + _HIST_KEY.format("nat") + """ as bigint) AS oper_cntry_key_no,
               ord AS ord_no, cast(ln as bigint) AS ord_ln_no, cast(ln - (ln - 1) % 3 as bigint) AS ref_ord_ln_no,
               cast(ascii(status) * 10 + cast(substr(prio, 1, 1) as int) as bigint) AS ord_cd_key_no,
               cast(ascii(rf) * 100 + ascii(ls) as bigint) AS ord_ln_key_no,
               cast(nat as bigint) AS shp_cntry_key_no, cust AS shp_postl_cd_key_no, supp AS whse_key_no,
               CASE WHEN ls = 'F' THEN NULL ELSE supp + 1 END AS ord_whse_key_no, ord AS ord_key_no,
               cast(reg as bigint) AS glbl_sales_chnl_key_no
        FROM {lh} WHERE rf <> 'N'
    """,
    "hist_order_code": """
        SELECT DISTINCT cast(ascii(status) * 10 + cast(substr(prio, 1, 1) as int) as bigint) AS ord_cd_key_no, status AS ord_type_cd,
               prio AS drop_cd, CASE WHEN status = 'P' THEN 'Y' ELSE 'N' END AS canc_flg,
               CASE WHEN status = 'F' THEN 'Y' END AS shp_flg, CASE WHEN prio = '5-LOW' THEN 'N' ELSE 'Y' END AS pay_req_flg
        FROM {hd}
    """,
    "hist_line_code": """
        SELECT DISTINCT cast(ascii(rf) * 100 + ascii(ls) as bigint) AS ord_ln_key_no, rf || ls AS ord_ln_disp_cd FROM {li}
    """,
    "hist_country": """
        SELECT cast(""" + _HIST_KEY.format("n_nationkey") + """ as bigint) AS cntry_key_no, cast(n_regionkey * 10 as bigint) AS aff_id,
               lpad(cast(n_nationkey * 10 as string), 3, '0') AS amway_cntry_cd
        FROM {nation}
    """,
    "hist_postal": "SELECT c_custkey AS postl_cd_key_no, 'P' || cast(c_custkey as string) AS postl_cd FROM {customer}",
    "hist_warehouse": "SELECT s_suppkey AS whse_key_no, s_name AS whse_cd FROM {supplier}",
    "hist_order": """
        SELECT ord AS ord_key_no, cast(""" + _HIST_KEY.format("nat") + """ as bigint) AS cntry_key_no, ord - 1 AS orgnl_ord_no,
               'I' || cast(ord as string) AS inv_no
        FROM {hd}
    """,
    "hist_channel": "SELECT cast(r_regionkey as bigint) AS glbl_sales_chnl_key_no, r_name AS glbl_sales_chnl_cd FROM {region}",
    "hist_currency": "SELECT cast(reg as bigint) AS curcy_key_no, 'C' || cast(reg as string) AS curcy_cd FROM {hd}",
    "hist_account": """
        SELECT c_custkey AS imc_key_no, c_custkey + 100000 AS imc_no, cast(""" + _HIST_KEY.format("c_nationkey") + """ as bigint) AS imc_cntry_key_no
        FROM {customer}
    """,
    "hist_item": """
        SELECT p_partkey AS item_key_no, cast(CASE WHEN p_size < 5 THEN 999 ELSE 5 END as bigint) AS cntry_key_no,
               ' ' || lpad(cast(p_partkey % 1000 as string), 3, '0') || CASE WHEN p_size > 25 THEN 'A' ELSE '7' END || p_brand AS item_no
        FROM {part}
    """,
    # --- control state
    "pend_state": """
        SELECT CASE prio WHEN '1-URGENT' THEN 'EU_AS400' ELSE 'EU_HYBR_EOM' END AS src, """ + _YM.format("dt") + """ AS ord_mo_yr_id,
               cast(count(*) % 3 as int) AS updt_on_last_run_flg
        FROM {hd} WHERE prio IN ('1-URGENT', '2-HIGH') GROUP BY prio, """ + _YM.format("dt") + """
    """,
    "event_state": """
        SELECT event_type AS src, cast(""" + _DAY.format("ts") + """ as int) AS ord_mo_yr_id, cast(count(*) % 4 as int) AS updt_on_last_run_flg
        FROM {events} GROUP BY event_type, cast(""" + _DAY.format("ts") + """ as int)
    """,
}


def _needs(name: str) -> list[str]:
    """Tables that a stand-in reads."""
    text = SQL[name]
    return [t for t in (*BASE_TABLES, *SQL) if "{" + t + "}" in text]


# Shapes written once per session and folder, so that the plans start from stored tables as
# they do on the order systems' own; the other stand-ins only rename and recode their columns.
LANDED = ("hd", "li", "lh")
_landed: dict[tuple[str, str, str], str] = {}


class Standins(dict):
    """Given tables and stand-ins as frames, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        if name in LANDED:
            frame = self.spark.read.parquet(self._land(name))
        elif name in SQL:
            frame = self.spark.sql(SQL[name], **{t: self[t] for t in _needs(name)})
        elif name in BASE_TABLES:
            frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        else:
            raise KeyError(name)
        self[name] = frame
        return frame


    def _land(self, name: str) -> str:
        """Path of a landed shape in the shared folder, written on first use."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _landed:
            path = working_path(self.spark, name)
            made = self.spark.sql(SQL[name], **{t: self[t] for t in _needs(name)})
            made.write.mode("overwrite").parquet(path)
            _landed[key] = path
        return _landed[key]


def ctes(*names: str) -> str:
    """The stand-ins, and those they need, as the opening of a WITH query."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done or name in BASE_TABLES:
            return
        for t in _needs(name):
            add(t)
        done[name] = SQL[name].format(**{t: t for t in (*BASE_TABLES, *SQL)})

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in done.items())
