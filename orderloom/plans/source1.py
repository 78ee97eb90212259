"""Order lines of source 1: bundle rules and a country shared by combined orders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import Months, clock_from_key, day_from_key, key_in_months, month_of_day_key, sql_ts
from ..functions.text import base_item_code, cut, first_filled, to_long
from ..operators.groups import value_from_row
from ..operators.joins import attach, lookup, match
from ..operators.pieces import Piece, in_piece
from ..operators.shape import conform
from ..sources.schemas import ITEM_BYTES, MART, MART_WIDTHS


def _headers(header: DataFrame, months: Months) -> DataFrame:
    """Orders in scope with their country; the moving affiliates only before they moved."""
    placed = header.filter(key_in_months("ord_dt", months)).withColumns({
        "ym": month_of_day_key("ord_dt"),
        "aff": first_filled("ctl_aff", "intgrt_ctl_aff"),
        "init_cntry": first_filled("cntry", "intgrt_cntry_cd"),
        "src_cd": F.coalesce(F.nullif(F.trim("ord_src"), F.lit("")), F.lit("*")),
    })
    return placed.filter(
        F.col("aff").isin(*fixed.SRC1_AFFILIATES)
        | (F.col("aff").isin(*fixed.MOVING_AFFILIATES) & (F.col("ym") <= fixed.LAST_MONTH_OLD))
    )


def _order_columns(headers: DataFrame, channel: DataFrame, address: DataFrame) -> DataFrame:
    """Mart columns that come from the order."""
    # An order takes the country of the first order of its combination.
    headers = value_from_row(
        headers, ["aff", "comb_ord", "shp_distb", "ord_dt"],
        cond=F.col("ord") == F.col("comb_ord"), value=cut("init_cntry", 3),
        out="oper_cntry", fallback="init_cntry",
    )
    # An order placed for someone else than the account its volume goes to.
    for_customer = F.expr("""
        (distb_ord_nbr <> 'BBB' AND vol_distb <> ord_distb
           AND (comb_ord_flg = 'N' OR (comb_ord_flg = 'Y' AND ord_distb <> shp_distb)))
        OR distb_ord_nbr = 'MBR'
    """)
    keyed = headers.withColumns({
        "aff_id": to_long("aff"),
        "cntry_id": to_long("init_cntry"),
        "is_customer": F.coalesce(for_customer, F.lit(False)),
    })
    channels = channel.withColumn("ch_cntry", to_long("cntry_cd")).selectExpr(
        "ch_cntry", "ord_type_cd", "ord_src_cd", "glbl_sales_chnl_cd AS channel"
    )
    keyed = lookup(keyed, channels, {"cntry_id": "ch_cntry", "ord_type": "ord_type_cd", "src_cd": "ord_src_cd"})
    scope = [int(a) for a in (*fixed.SRC1_AFFILIATES, *fixed.MOVING_AFFILIATES)]
    addresses = address.select(
        to_long(first_filled("intgrt_aff_cd", "ctl_aff")).alias("ad_aff"),
        "distb_nbr", "adr_seq", F.nullif(F.trim("post"), F.lit("")).alias("postal"),
    ).filter(F.col("ad_aff").isin(*scope))
    keyed = lookup(keyed, addresses, {"shp_distb": "distb_nbr", "aff_id": "ad_aff", "shp_adr": "adr_seq"})

    return keyed.withColumns({
        "oper_cntry_id": to_long("oper_cntry"),
        "clock": clock_from_key("ord_dt", "ord_tm"),
        "shp_dt": day_from_key("dlvr_dt"),
    }).selectExpr(
        "ym AS h_ym", "ord AS h_ord", "cntry_id AS h_cntry",
        "aff_id AS oper_aff_id", "oper_cntry_id", "oper_cntry_id AS shp_cntry_id",
        "clock AS ord_dt", "ord_dt AS ord_dt_key_no", "ym AS ord_mo_yr_id",
        "shp_dt", "dlvr_dt AS shp_dt_key_no", "CAST(floor(dlvr_dt / 100) AS INT) AS shp_mo_yr_id",
        "CASE WHEN comb_ord_flg = 'Y' THEN 'true' ELSE 'false' END AS comb_ord_flag",
        "comb_ord AS comb_ord_id", "inv_nbr AS inv_cd",
        "CASE WHEN ord_curcy = 'CIP' THEN 'GBP' ELSE substring(ord_curcy, 1, 3) END AS curcy_cd",
        "channel AS ord_channel", "whse AS whse_cd", "ord_whse AS ord_whse_cd", "postal AS shp_postal_cd",
        "CASE WHEN is_customer THEN ord_distb ELSE vol_distb END AS account_id",
        "CASE WHEN ord_type = 'EMP' THEN 'Employee' WHEN is_customer THEN 'Member' ELSE 'ABO' END AS account_type_ord",
        "vol_distb AS vol_account_id", "ord_distb AS ord_account_id", "shp_distb AS shp_account_id",
        "CASE WHEN ord_canc = 'N' THEN 'false' ELSE 'true' END AS ord_canc_flag",
        "CASE WHEN ord_shp = 'N' THEN 'false' WHEN ord_shp = 'Y' THEN 'true' END AS ord_shp_flag",
        "pay_req AS pay_req_flag",
        "CASE WHEN ord_pay_stat = 'P' THEN 'true' ELSE 'false' END AS ord_paid_flag",
        "orgnl_ord AS org_ord_id", "ord_type AS ord_type_cd", "drop_cd", "ord_hndlg_price AS delivery_fee_net",
    )


def _month_lines(line: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines of the orders in scope, with the month and country of their order."""
    keys = headers.selectExpr("ym", "ord AS h_ord", "init_cntry AS h_cntry")
    lines = line.withColumn("cntry_cd", first_filled("cntry", "intgrt_cntry_cd"))
    joined = match(lines, keys, {"ord": "h_ord", "cntry_cd": "h_cntry"}, "inner")
    return joined.withColumn("cntry_id", to_long("cntry_cd")).drop("cntry", "intgrt_cntry_cd", "cntry_cd")


def line_quantities(lines: DataFrame) -> DataFrame:
    """Ordered item and the ordered and shipped quantity of each line.

    Needs ym, ord, cntry_id and the line columns. A line's reference is the line it was
    ordered under; a line with other lines under it is a bundle or a replaced item.
    """
    ordered = lines.selectExpr("ym", "ord AS o_ord", "ord_ln AS o_ln", "cntry_id AS o_cntry", "item AS ordered_item")
    found = match(
        lines, ordered, {"ym": "ym", "ord": "o_ord", "ref_ln": "o_ln", "cntry_id": "o_cntry"}, "left"
    )
    # A component without a line type counts as a product.
    below = (
        lines.filter(F.col("ord_ln") != F.col("ref_ln"))
        .groupBy("ym", "ord", "cntry_id", F.col("ref_ln").alias("ord_ln"))
        .agg(
            F.count(F.when(F.col("ln_type") == "P", None).otherwise(F.col("ord_ln"))).alias("products_below"),
            F.count("ord_ln").alias("lines_below"),
        )
    )
    keys = ["ym", "ord", "cntry_id", "ord_ln"]
    counted = attach(found, below.dropna(subset=keys), keys)

    # Not shipped as such: no product, replaced, or the head of a bundle or of a replacement.
    not_shipped = """
        item_type <> 'I' OR item_disp = 'S'
        OR (ord_ln = ref_ln AND (products_below > 0 OR coalesce(lines_below, 0) = 0) AND item_disp IN ('E', 'S'))
    """
    return counted.withColumns({
        "ord_item_cd": F.expr("nullif(trim(coalesce(ordered_item, item)), '')"),
        "shp_item_cd": F.expr("nullif(trim(item), '')"),
        "ord_qty": F.expr("CASE WHEN ln_type IN ('O', 'A', 'R') THEN item_qty ELSE 0 END"),
        "shp_qty": F.expr(f"CASE WHEN {not_shipped} THEN 0 ELSE item_qty END"),
    })


def conform_source1(
    src: Mapping[str, DataFrame], months: Months, run_ts: dt.datetime, piece: Piece | None = None
) -> DataFrame:
    """Mart rows of source 1, all or those of a piece. Reads src1_header, src1_line, src1_channel, src1_address."""
    headers = _headers(src["src1_header"], months)
    orders = in_piece(_order_columns(headers, src["src1_channel"], src["src1_address"]), "h_ord", piece)
    lines = line_quantities(_month_lines(in_piece(src["src1_line"], "ord", piece), in_piece(headers, "ord", piece)))
    full = match(lines, orders, {"ym": "h_ym", "ord": "h_ord", "cntry_id": "h_cntry"}, "left")
    return conform(
        full.withColumns({
            "ord_item_base_cd": base_item_code("ord_item_cd", width=15),
            "shp_item_base_cd": base_item_code("shp_item_cd", width=15),
        }).selectExpr(
            *[c for c in orders.columns if not c.startswith("h_")],
            "ord AS ord_id", "ord_ln AS ord_ln_id", "ref_ln AS ref_ln_id", "item_disp AS ord_ln_disp_cd",
            "ord_item_cd", "shp_item_cd", "ord_item_base_cd", "shp_item_base_cd",
            "item_price AS adj_ln_lc_net", "item_pv AS adj_ln_pv", "item_bv AS adj_ln_bv", "ord_qty", "shp_qty",
            f"{sql_ts(run_ts)} AS update_dt",
        ),
        MART,
        MART_WIDTHS["source1"], ITEM_BYTES,
    )
