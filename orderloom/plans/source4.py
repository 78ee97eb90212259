"""Order lines of source 4: placeholder accounts and first-of-item quantities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import Months, day_key, in_months, month_key, sql_ts
from ..functions.text import (
    base_item_code, blank_to_null, join_text, pad_name, sql_list, text_number, to_long, try_to_long,
)
from ..operators.groups import first_of_group
from ..operators.joins import among_keys, attach, match
from ..operators.pieces import Piece, in_piece
from ..operators.shape import conform
from ..sources.schemas import MART

_SCOPE = (*fixed.SRC4_AFFILIATES, *fixed.MOVING_AFFILIATES)


def _open_month(affiliate: Column, ym: Column) -> Column:
    """The affiliate belongs to this source in the month."""
    return affiliate.isin(*fixed.SRC4_AFFILIATES) | (
        affiliate.isin(*fixed.MOVING_AFFILIATES) & (ym >= fixed.FIRST_MONTH_NEW)
    )


def placeholder_account(country: str, account: str) -> Column:
    """The volume account is one of the numbers that stand for no account. Takes column names."""
    pairs = " OR ".join(f"({country} = '{c}' AND {account} = '{a}')" for c, a in fixed.PLACEHOLDER_ACCOUNTS.items())
    own_code = f"({country} IN ({sql_list(fixed.PLACEHOLDER_IS_COUNTRY)}) AND {account} = {country})"
    return F.expr(f"coalesce({pairs} OR {own_code}, false)")


def _orders(header: DataFrame, months: Months) -> DataFrame:
    """Orders in scope; the moving affiliates only since they moved."""
    headers = (
        header.filter(in_months("ord_dt", months))
        .withColumns({
            "aff": F.coalesce("intgrt_aff_cd", "aff_cd"),
            "cntry": F.coalesce("intgrt_cntry_cd", "cntry_cd"),
            "ym": month_key("ord_dt"),
        })
        .withColumn("placeholder", placeholder_account("cntry", "vol_imc_no"))
        .filter(_open_month(F.col("aff"), F.col("ym")))
    )
    return headers.withColumns({
        "h_ord": to_long("ord_no"),
        "oper_cntry_id": to_long("cntry"),
        "oper_aff_id": to_long("aff"),
        "shp_cntry_id": to_long("dlvry_addr_amway_cntry_cd"),
        "ord_dt_key_no": day_key("ord_dt"),
        "comb_ord_id": to_long("comb_ord_no"),
        "recipient_id": text_number(pad_name(join_text("dlvry_addr_fam_nm", "dlvry_addr_given_nm"), 7)),
        "billed_id": to_long("bill_imc_no"),
        "billing": blank_to_null("bill_imc_type_cd"),
        "vol_account_id": to_long("vol_imc_no"),
        "ord_account_id": to_long("ord_imc_no"),
        "shp_account_id": to_long("shp_imc_no"),
        "org_ord_id": to_long("orgnl_ord_no"),
    }).selectExpr(
        "h_ord", "oper_cntry_id", "oper_aff_id", "shp_cntry_id", "ord_dt", "ord_dt_key_no", "ym AS ord_mo_yr_id",
        "CASE comb_ord_flg WHEN 'Y' THEN 'true' WHEN 'N' THEN 'false' END AS comb_ord_flag",
        "comb_ord_id", "inv_no AS inv_cd", "ord_curcy_cd AS curcy_cd", "ord_chnl_cd AS ord_channel",
        "whse_nm AS whse_cd", "coalesce(ord_whse_nm, whse_nm) AS ord_whse_cd",
        "nullif(trim(dlvry_addr_post_cd), '') AS shp_postal_cd",
        "CASE WHEN placeholder THEN recipient_id ELSE billed_id END AS account_id",
        f"""CASE WHEN placeholder THEN 'FOA' WHEN billing = 'E' THEN 'Employee'
                 WHEN billing IN ({sql_list(fixed.OWNER_BILLING_TYPES)}) THEN 'ABO' ELSE 'Customer' END AS account_type_ord""",
        "vol_account_id", "ord_account_id", "shp_account_id",
        "CASE WHEN ord_canc_flg = 'Y' THEN 'true' ELSE 'false' END AS ord_canc_flag",
        "CASE WHEN ord_shp_flg = 'Y' THEN 'true' ELSE 'false' END AS ord_shp_flag",
        "pay_req_flg AS pay_req_flag",
        "CASE WHEN ord_pay_stat_cd = 'PAID' THEN 'true' ELSE 'false' END AS ord_paid_flag",
        "org_ord_id", "ord_type_cd", "drop_cd",
        "dlvry_actual_cost_curcy_amt AS delivery_fee_net", "dlvry_mode_cd AS delivery_mode_cd",
    )


def _last_shipments(consignment: DataFrame) -> DataFrame:
    countries = (*fixed.SRC4_CONSIGNMENT_COUNTRIES, *fixed.SRC4_MOVING_CONSIGNMENT_COUNTRIES)
    return (
        consignment.filter(F.col("intgrt_cntry_cd").isin(*countries))
        .groupBy("intgrt_cntry_cd", to_long("ord_no").alias("ord_id"))
        .agg(F.max("shp_dt").alias("last_shp"))
        .dropna(subset=["ord_id"])
    )


def conform_source4(
    src: Mapping[str, DataFrame], months: Months, run_ts: dt.datetime, piece: Piece | None = None
) -> DataFrame:
    """Mart rows of source 4, all or those of a piece. Reads src4_header, src4_line, src4_consignment."""
    orders = in_piece(_orders(src["src4_header"], months), "h_ord", piece)
    number = try_to_long("ord_no")
    line = in_piece(src["src4_line"], number, piece).withColumns({
        "l_aff": F.coalesce("intgrt_aff_cd", "aff_cd"),
        "cntry": F.coalesce("intgrt_cntry_cd", "cntry_cd"),
        "item": F.coalesce("ord_cd", "item_id"),
        "ord_id": number,
    }).filter(F.col("l_aff").isin(*_SCOPE))
    lines = line.withColumn("l_cntry_id", to_long("cntry"))
    lines = match(
        lines,
        orders.selectExpr("h_ord", "oper_cntry_id AS h_cntry", "ord_mo_yr_id AS ym").distinct(),
        {"ord_id": "h_ord", "l_cntry_id": "h_cntry"}, "inner",
    ).filter(_open_month(F.col("l_aff"), F.col("ym")))

    # The ordered quantity stands on the first line of each item of an order only.
    quantity = F.expr("coalesce(CAST(compnt_qty AS DOUBLE), item_qty_amt)")
    lines = first_of_group(lines, ["ym", "cntry", "ord_no", "item"], "ord_ln_no", quantity, "ordered")

    # The narrow lines meet the shipments first, the many order columns come in last.
    consignment = in_piece(src["src4_consignment"], number, piece)
    if months is not None:
        numbered = consignment.withColumn("__ord", number)
        consignment = among_keys(numbered, orders.select("h_ord"), {"__ord": "h_ord"}).drop("__ord")
    shipped = attach(lines, _last_shipments(consignment), ["intgrt_cntry_cd", "ord_id"])
    full = match(shipped, orders, {"ord_id": "h_ord", "l_cntry_id": "oper_cntry_id", "ym": "ord_mo_yr_id"}, "inner")
    shp_dt = F.expr(f"""
        CASE WHEN intgrt_cntry_cd IN ({sql_list(fixed.SRC4_CONSIGNMENT_COUNTRIES)}) OR ym >= {fixed.FIRST_MONTH_NEW}
             THEN last_shp END
    """)
    coded = full.withColumns({
        "shp_dt": shp_dt,
        "ord_item_cd": F.expr("nullif(trim(item), '')"),
        "shp_item_cd": F.expr("nullif(trim(item_id), '')"),
    })
    return conform(
        coded.withColumns({
            "shp_dt_key_no": day_key("shp_dt"), "shp_mo_yr_id": month_key("shp_dt"),
            "ord_ln_id": to_long("ord_ln_no"), "ref_ln_id": to_long("ref_ln_no"),
            "ord_item_base_cd": base_item_code("ord_item_cd", width=15),
            "shp_item_base_cd": base_item_code("shp_item_cd", width=15),
        }).selectExpr(
            *[c for c in orders.columns if c not in ("h_ord", "oper_cntry_id", "ord_mo_yr_id")],
            "l_cntry_id AS oper_cntry_id", "ym AS ord_mo_yr_id", "shp_dt", "shp_dt_key_no", "shp_mo_yr_id",
            "ord_id", "ord_ln_id", "ref_ln_id", "item_disp_desc AS ord_ln_disp_cd",
            "ord_item_cd", "shp_item_cd", "ord_item_base_cd", "shp_item_base_cd",
            "coalesce(CAST(adj_item_price_amt AS DOUBLE), 0) AS adj_ln_lc_net",
            f"""CASE WHEN cntry = '{fixed.TOTAL_POINTS_COUNTRY}' THEN tot_pv_amt
                     ELSE coalesce(CAST(adj_item_price_pv_amt AS DOUBLE), item_pv_amt) END AS adj_ln_pv""",
            "coalesce(CAST(adj_item_price_bv_amt AS DOUBLE), item_bv_amt) AS adj_ln_bv",
            "ordered AS ord_qty", "item_qty_amt AS shp_qty", "pos_consltnt_id AS consultant_cd",
            f"{sql_ts(run_ts)} AS update_dt",
        ),
        MART,
    )
