"""Order lines of source 3: fees, proration of the order's net value, consignments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import Months, day_key, in_months, month_key, sql_ts
from ..functions.text import NUMBER, base_item_code, digits_to_long, recode, share_of, to_long, try_to_long
from ..operators.groups import with_group
from ..operators.joins import among_keys, attach, attach_observed, match
from ..operators.pieces import Piece, in_piece
from ..operators.shape import conform
from ..sources.schemas import ITEM_BYTES, MART, MART_WIDTHS


def _in_scope(df: DataFrame) -> DataFrame:
    return df.filter(F.col("affiliate_code").isin(*fixed.SRC3_AFFILIATES))


def _headers(header: DataFrame, months: Months) -> DataFrame:
    return (
        _in_scope(header)
        .filter(in_months("order_date_time", months))
        .withColumns({"ym": month_key("order_date_time"), "ord_id": to_long("sales_order_id")})
    )


def _orders(header: DataFrame, consignment: DataFrame, months: Months) -> DataFrame:
    """Orders, one row per place they are delivered to; several rows make a combined order."""
    places = (
        _in_scope(consignment)
        .filter(in_months("order_date_time", months))
        .withColumn("c_ym", month_key("order_date_time"))
        .selectExpr(
            "c_ym", "sales_order_id AS c_ord", "amway_sales_entity AS c_entity",
            "delivery_postal_code", "delivery_iso_country_code", "warehouse_code",
        )
        .distinct()
        .withColumn("has_place", F.lit(True))
    )
    headers = _headers(header, months).withColumn("comb_id", F.coalesce("group_order_id", "ord_id"))
    placed = match(headers, places, {"ym": "c_ym", "sales_order_id": "c_ord", "amway_sales_entity": "c_entity"}, "left")
    counted = with_group(placed, ["ym", "amway_sales_entity", "comb_id"], rows_in_comb=F.count("sales_order_id"))
    entity = to_long("amway_sales_entity")
    return counted.withColumns({
        "oper_aff_id": to_long("affiliate_code"),
        "oper_cntry_id": entity,
        "shp_cntry_id": recode("delivery_iso_country_code", fixed.SRC3_SHIP_COUNTRIES, entity),
        "ord_dt_key_no": day_key("order_date_time"),
        "vol_account_id": to_long("volume_sales_account_id"),
        "ord_account_id": to_long("ordering_sales_account_id"),
        "shp_account_id": to_long("ship_to_sales_account_id"),
        "org_ord_id": digits_to_long("original_order_id"),
    }).selectExpr(
        "iso_country_code AS h_cntry", "ord_id AS h_ord", "oper_aff_id", "oper_cntry_id", "shp_cntry_id",
        "order_date_time AS ord_dt", "ord_dt_key_no", "ym AS ord_mo_yr_id",
        "CASE WHEN rows_in_comb > 1 THEN 'true' ELSE 'false' END AS comb_ord_flag", "comb_id AS comb_ord_id",
        "substring(iso_currency_code, 1, 3) AS curcy_cd", "sales_channel_code AS ord_channel",
        "warehouse_code AS whse_cd", "delivery_postal_code AS shp_postal_cd",
        "vol_account_id", "ord_account_id", "shp_account_id",
        "CASE WHEN order_status = 'CANCELLED' THEN 'true' ELSE 'false' END AS ord_canc_flag",
        "CASE WHEN payment_required = 'true' THEN 'Y' ELSE 'N' END AS pay_req_flag",
        "CASE WHEN payment_status = 'PAID' THEN 'true' ELSE 'false' END AS ord_paid_flag",
        "org_ord_id", "has_place",
        f"CAST(total_order_value AS {NUMBER}) - CAST(total_tax_amount AS {NUMBER}) AS net_value",
        "trim(order_price_list) AS price_list",
    )


def order_fees(fees: DataFrame) -> DataFrame:
    """Net fees of each order: all of them, and those that are not rounding differences."""
    amounts = fees.selectExpr(
        "sale_country_code", "sales_order_id", "fee_code",
        f"coalesce(CAST(fee_amount AS {NUMBER}), 0) AS amount",
        f"coalesce(CAST(fee_tax_total_amount AS {NUMBER}), 0) AS tax",
    ).withColumn("is_charge", F.coalesce(~F.col("fee_code").isin(*fixed.ROUNDING_FEES), F.lit(True)))
    return amounts.groupBy("sale_country_code", "sales_order_id").agg(
        F.expr("sum(amount) - sum(tax) AS fee_total"),
        F.expr("sum(CASE WHEN is_charge THEN amount ELSE 0 END) - sum(CASE WHEN is_charge THEN tax ELSE 0 END) AS delivery_fee"),
    )


def order_rows(src: Mapping[str, DataFrame], months: Months) -> DataFrame:
    """What ``conform_source3`` knows of the orders of the months, which no piece of them gives: orders share a combination."""
    return _orders(src["src3_header"], src["src3_consignment"], months)


def conform_source3(
    src: Mapping[str, DataFrame], months: Months, run_ts: dt.datetime, seen: Observation | None = None, piece: Piece | None = None,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Mart rows of source 3. ``seen`` observes how far the invoices, several of which may belong to a line, multiply the lines.

    Of a ``piece`` only its rows are made; ``orders`` may then be the stored ``order_rows``, so that no other piece makes them again.
    Reads src3_header, src3_consignment, src3_line, src3_fulfilment, src3_fees, src3_invoice.
    """
    order = ["sale_country_code", "sales_order_id"]
    orders = in_piece(order_rows(src, months) if orders is None else orders, "h_ord", piece)
    number = try_to_long("sales_order_id")
    line = in_piece(_in_scope(src["src3_line"]), number, piece).withColumns({
        "ord_id": to_long("sales_order_id"),
        "ln_id": to_long("order_line_id"),
        "price": F.col("line_price").cast(NUMBER),
    })
    # Lines have no date: of a choice of months, keep their orders' lines before all else.
    heads = in_piece(_headers(src["src3_header"], months).select("ord_id", "iso_country_code"), "ord_id", piece)
    ours = {"ord_id": "ord_id", "sale_country_code": "iso_country_code"}
    lines = line if months is None else match(line, heads, ours, "left_semi")

    def of_ours(child: DataFrame) -> DataFrame:
        """Rows of a child table that may belong to an order of the months and the piece, before anything is grouped."""
        child = in_piece(child, number, piece)
        if months is None:
            return child
        numbered = child.withColumn("__ord", number)
        return among_keys(numbered, heads, {"__ord": "ord_id", "sale_country_code": "iso_country_code"}).drop("__ord")

    shipped = (
        of_ours(src["src3_fulfilment"])
        .filter(F.col("sale_country_code").isin(*fixed.SRC3_FULFILMENT_COUNTRIES))
        .groupBy(*order, F.col("order_line_id").alias("ln_id"))
        .agg(F.max("fulfilled_date").alias("shp_dt"))
    )
    line_key = [*order, "ln_id"]
    full = attach(lines, shipped.dropna(subset=line_key), line_key)
    invoices = of_ours(src["src3_invoice"]).withColumn("ln_id", try_to_long("order_line_id")).selectExpr(
        *order, "ln_id", "invoice_number AS inv_cd"
    )
    invoices = invoices.dropna(subset=line_key)
    full = attach(full, invoices, line_key) if seen is None else attach_observed(full, invoices, line_key, seen)

    # Everything known per order meets at order grain; the lines are joined to it once, last.
    per_order = lines.groupBy(*order, "ord_id").agg(F.sum("price").alias("price_total"))
    per_order = attach(per_order, order_fees(of_ours(_in_scope(src["src3_fees"]))).dropna(subset=order), order)
    per_order = match(per_order, orders, {"ord_id": "h_ord", "sale_country_code": "h_cntry"}, "inner")
    full = attach(full.drop("ord_id"), per_order, order, "inner")

    net_of_fees = F.expr("nullif(net_value, 0) - fee_total")
    coded = full.withColumns({
        "ord_item_cd": F.expr("nullif(trim(coalesce(bundle_item_id, base_item_id)), '')"),
        "shp_item_cd": F.expr("nullif(trim(base_item_id), '')"),
    })
    return conform(
        coded.withColumns({
            "shp_dt_key_no": day_key("shp_dt"), "shp_mo_yr_id": month_key("shp_dt"),
            "account_type_ord": recode("price_list", fixed.PRICE_LIST_TYPES),
            "ord_item_base_cd": base_item_code("ord_item_cd", width=15),
            "shp_item_base_cd": base_item_code("shp_item_cd", width=15),
            "adj_ln_lc_net": share_of(F.col("price"), net_of_fees, F.col("price_total")),
        }).selectExpr(
            "oper_aff_id", "oper_cntry_id", "shp_cntry_id", "ord_dt", "ord_dt_key_no", "ord_mo_yr_id",
            "shp_dt", "shp_dt_key_no", "shp_mo_yr_id", "comb_ord_flag", "comb_ord_id", "ord_id", "inv_cd",
            "curcy_cd", "ord_channel", "whse_cd", "demand_location AS ord_whse_cd", "shp_postal_cd",
            f"CASE WHEN price_list = '{fixed.OWNER_PRICE_LIST}' THEN vol_account_id ELSE ord_account_id END AS account_id",
            "account_type_ord", "vol_account_id", "ord_account_id", "shp_account_id", "ord_canc_flag",
            "CASE WHEN shp_dt IS NULL THEN 'false' ELSE 'true' END AS ord_shp_flag",
            "pay_req_flag", "ord_paid_flag", "org_ord_id",
            "CASE WHEN has_place IS NULL THEN 0 ELSE delivery_fee END AS delivery_fee_net",
            "ln_id AS ord_ln_id", "'*' AS ord_ln_disp_cd",
            "ord_item_cd", "shp_item_cd", "ord_item_base_cd", "shp_item_base_cd", "adj_ln_lc_net",
            "line_pv_amount AS adj_ln_pv", "line_bv_amount AS adj_ln_bv",
            # The mart's ordered quantity is what has shipped or will, and the other way round.
            "coalesce(shipped_quantity, 0) + coalesce(pending_quantity, 0) AS ord_qty",
            "coalesce(ordered_quantity, 0) - coalesce(cancelled_quantity, 0) AS shp_qty",
            "fulfillment_type AS delivery_mode_cd",
            f"{sql_ts(run_ts)} AS update_dt",
        ),
        MART,
        MART_WIDTHS["source3"], ITEM_BYTES,
    )
