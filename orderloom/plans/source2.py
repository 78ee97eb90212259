"""Order lines of source 2: another clock, prefixed accounts, invoice enrichment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import Months, day_key, in_months, month_in, month_key, shift_zone, sql_ts
from ..functions.text import base_item_code, drop_prefix, recode, to_long, try_to_long
from ..operators.groups import value_from_row
from ..operators.joins import attach, match
from ..operators.pieces import Piece, in_piece
from ..operators.ranks import rank_in_group
from ..operators.shape import conform
from ..sources.schemas import MART, MART_WIDTHS


def to_mart_clock(ts: Column | str) -> Column:
    return shift_zone(ts, fixed.SRC2_ZONE, fixed.MART_ZONE_SRC2)


def _account(c: str) -> Column:
    return to_long(drop_prefix(c, fixed.SRC2_ACCOUNT_PREFIX))


def _orders(header: DataFrame, months: Months) -> DataFrame:
    """Orders whose shifted date lies in the months; the unshifted range reaches the scan."""
    return (
        header.filter(F.col("intgrt_aff_cd").isin(*fixed.SRC2_AFFILIATES))
        .filter(in_months("ord_dt", months, slack_days=1))
        .withColumn("at", to_mart_clock("ord_dt"))
        .withColumns({"ym": month_key("at"), "h_vol": _account("vol_imc_no")})
        .filter(month_in("ym", months))
    )


def _order_columns(orders: DataFrame) -> DataFrame:
    """Mart columns that come from the order, under the keys h_aff, h_ord, ym, h_vol."""
    shp, vol, ordering = F.col("shp_imc_no"), F.col("vol_imc_no"), F.col("ord_imc_no")
    # Orders of one address on one source day share the number of their own-account order.
    combined = value_from_row(
        orders.withColumn("source_day", day_key("ord_dt")), ["ym", "source_day", "ord_type", "shp_imc_no", "shp_adr_ln_1"],
        cond=(shp == vol) & (shp == ordering) & (F.col("ord_type") == fixed.SRC2_COMBINED_TYPE),
        value="ord_no", out="comb_ord_id", fallback="ord_no",
    )
    return combined.withColumns({
        "shp_cntry_id": recode("shp_cntry", fixed.SRC2_SHIP_COUNTRIES, F.lit(fixed.SRC2_SHIP_DEFAULT)),
        "h_ordering": _account("ord_imc_no"), "h_shp": _account("shp_imc_no"), "ord_dt_key_no": day_key("at"),
    }).selectExpr(
        "intgrt_aff_cd AS h_aff", "ord_no AS h_ord", "ym", "h_vol", "h_ordering", "h_shp",
        "CAST(intgrt_aff_cd AS BIGINT) AS oper_aff_id", "CAST(intgrt_aff_cd AS BIGINT) AS oper_cntry_id", "shp_cntry_id",
        "at AS ord_dt", "ord_dt_key_no", "ym AS ord_mo_yr_id",
        f"CASE WHEN ord_type = '{fixed.SRC2_COMBINED_TYPE}' THEN 'true' ELSE 'false' END AS comb_ord_flag",
        "comb_ord_id", "ord_no AS ord_id", "ord_no AS inv_cd", "substring(curcy_cd, 1, 3) AS curcy_cd",
        "sale_chnl AS ord_channel", "shp_postl_cd AS shp_postal_cd",
        "CASE WHEN cancelled_flg = 'Y' THEN 'true' ELSE 'false' END AS ord_canc_flag",
        "CASE WHEN open_flg = 'Y' THEN 'false' ELSE 'true' END AS ord_shp_flag",
        "ord_type AS ord_type_cd",
    )


def _invoices(invoices: DataFrame, months: Months) -> DataFrame:
    return (
        invoices
        .filter(F.col("aff_id").isin(*[int(a) for a in fixed.SRC2_AFFILIATES]))
        .filter(month_in("ord_mo_yr_id", months))
        .withColumns({"i_ord": try_to_long("invoice_cd"), "nature": to_long("ord_bus_natr_cd")})
        .selectExpr("ord_mo_yr_id AS i_ym", "CAST(aff_id AS STRING) AS i_aff", "i_ord", "vol_account_id AS i_vol", "nature")
    )


def conform_source2(
    src: Mapping[str, DataFrame], months: Months, run_ts: dt.datetime, piece: Piece | None = None
) -> DataFrame:
    """Mart rows of source 2, all or those of a piece. Reads src2_header, src2_line, invoices."""
    orders = _orders(src["src2_header"], months)
    # An order stored several times counts as often in the line numbers, but is joined once here.
    heads = in_piece(orders, "ord_no", piece).groupBy("intgrt_aff_cd", "ord_no", "ym", "h_vol").agg(F.count(F.lit(1)).alias("copies"))
    heads = heads.withColumnsRenamed({"intgrt_aff_cd": "h_aff", "ord_no": "h_ord"})
    keys = {"intgrt_aff_cd": "h_aff", "ord_no": "h_ord"}
    line = in_piece(src["src2_line"], "ord_no", piece).filter(F.col("intgrt_aff_cd").isin(*fixed.SRC2_AFFILIATES))

    # The narrow lines go through every step first; the many order columns come in last.
    lines = match(line, heads, keys, "inner").withColumn("vol_account_id", F.coalesce(_account("vol_imc_no"), "h_vol"))
    invoiced = match(
        lines, _invoices(in_piece(src["invoices"], try_to_long("invoice_cd"), piece), months),
        {"ym": "i_ym", "intgrt_aff_cd": "i_aff", "ord_no": "i_ord", "vol_account_id": "i_vol"}, "left",
    )
    # The line number counts the rows of the order after the joins, several per line or not.
    ranked = rank_in_group(invoiced, ["ym", "ord_no"], ["ord_ln_no", "oracle_line_id"], "ord_ln_id", weight="copies")
    # Every line of a bundle carries the bundle's item.
    bundled = value_from_row(
        ranked, ["ord_no", "ord_ln_no"],
        cond=F.col("item_type") == "MODEL", value="ord_item", out="ordered_item", fallback="ord_item",
        among=line if months is None else match(line, heads, keys, "left_semi"),
    )
    shipped = bundled.withColumns({
        "shp_dt": to_mart_clock("act_shp_dt"), "l_ordering": _account("ord_imc_no"), "l_shp": _account("shp_imc_no"),
    }).selectExpr(
        "intgrt_aff_cd AS h_aff", "ord_no AS h_ord", "ym", "h_vol", "nature", "ord_ln_id", "ord_ln_no AS ref_ln_id",
        "whse_cd", "shp_dt", "vol_account_id", "l_ordering", "l_shp", "dlvry_fee AS delivery_fee_net",
        "CASE WHEN item_disp_cd = ' ' THEN '*' ELSE item_disp_cd END AS ord_ln_disp_cd",
        "nullif(trim(ordered_item), '') AS ord_item_cd", "nullif(trim(ord_item), '') AS shp_item_cd",
        "unit_sell_price * ord_qty AS adj_ln_lc_net", "extend_pv_amt AS adj_ln_pv", "extend_bv_amt AS adj_ln_bv",
        "CASE WHEN item_type <> 'OPTION' THEN ord_qty ELSE 0 END AS ord_qty",
        "CASE WHEN item_type <> 'MODEL' THEN shp_qty ELSE 0 END AS shp_qty",
        "shp_priority AS delivery_mode_cd",
    )
    full = attach(shipped, in_piece(_order_columns(orders), "h_ord", piece), ["h_aff", "h_ord", "ym", "h_vol"], "inner")
    ordering = ", ".join(str(n) for n in fixed.ORDERING_NATURES)
    return conform(
        full.withColumns({
            "shp_dt_key_no": day_key("shp_dt"), "shp_mo_yr_id": month_key("shp_dt"),
            "account_type_ord": recode("nature", fixed.NATURE_TYPES, F.lit("ABO")),
            "ord_item_base_cd": base_item_code("ord_item_cd"), "shp_item_base_cd": base_item_code("shp_item_cd"),
            "ord_account_id": F.coalesce("l_ordering", "h_ordering"),
        }).selectExpr(
            "oper_aff_id", "oper_cntry_id", "shp_cntry_id", "ord_dt", "ord_dt_key_no", "ord_mo_yr_id",
            "shp_dt", "shp_dt_key_no", "shp_mo_yr_id", "comb_ord_flag", "comb_ord_id", "ord_id", "inv_cd",
            "curcy_cd", "ord_channel", "whse_cd", "whse_cd AS ord_whse_cd", "shp_postal_cd",
            f"CASE WHEN nature IN ({ordering}) THEN ord_account_id ELSE vol_account_id END AS account_id",
            "account_type_ord", "vol_account_id", "ord_account_id", "coalesce(l_shp, h_shp) AS shp_account_id",
            "ord_canc_flag", "ord_shp_flag", "'Y' AS pay_req_flag", "ord_type_cd", "delivery_fee_net", "ord_ln_id",
            "ref_ln_id", "ord_ln_disp_cd", "ord_item_cd", "shp_item_cd", "ord_item_base_cd", "shp_item_base_cd",
            "adj_ln_lc_net", "adj_ln_pv", "adj_ln_bv", "ord_qty", "shp_qty", "delivery_mode_cd",
            f"{sql_ts(run_ts)} AS update_dt",
        ),
        MART,
        MART_WIDTHS["source2"],
    )
