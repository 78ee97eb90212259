"""History load: a demand fact enriched from a star schema, many months in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import Months, day_from_key, month_from_counter, month_in, month_range, sql_ts
from ..functions.text import base_item_code
from ..operators.joins import match, role_join
from ..operators.pieces import Piece, in_piece
from ..operators.shape import conform
from ..sources.schemas import MART, MART_WIDTHS

HISTORY_RANGE = tuple(month_from_counter(n) for n in fixed.HISTORY_MONTHS)


def history_months() -> tuple[int, ...]:
    """The months the history load covers."""
    return month_range(*HISTORY_RANGE)


def _fact(fact: DataFrame, months: Months, countries) -> DataFrame:
    return fact.filter(F.col("oper_cntry_key_no").isin(*countries) & month_in("ord_mo_yr_key_no", months))


def _detail(src: Mapping[str, DataFrame], months: Months, countries, piece: Piece | None) -> DataFrame:
    """Codes of each order line, read through their dimensions."""
    fact = in_piece(_fact(src["hist_detail"], months, countries), "ord_no", piece)
    fact = match(fact, src["hist_order_code"], {"ord_cd_key_no": "ord_cd_key_no"})
    fact = match(fact, src["hist_line_code"], {"ord_ln_key_no": "ord_ln_key_no"})
    fact = role_join(fact, src["hist_country"], "cntry_key_no", {"shp_cntry_key_no": {"amway_cntry_cd": "shp_cntry"}})
    fact = role_join(fact, src["hist_postal"], "postl_cd_key_no", {"shp_postl_cd_key_no": {"postl_cd": "shp_postal_cd"}})
    fact = role_join(fact, src["hist_warehouse"], "whse_key_no", {
        "whse_key_no": {"whse_cd": "whse_cd"},
        "ord_whse_key_no": {"whse_cd": "ord_whse_cd"},
    })
    orders = src["hist_order"].filter(F.col("cntry_key_no").isin(*countries)).drop("cntry_key_no")
    fact = match(fact, orders, {"ord_key_no": "ord_key_no"})
    fact = match(fact, src["hist_channel"], {"glbl_sales_chnl_key_no": "glbl_sales_chnl_key_no"})
    return fact.selectExpr(
        "oper_cntry_key_no AS d_cntry", "ord_mo_yr_key_no AS d_ym", "ord_no AS d_ord", "ord_ln_no AS d_ln",
        "CAST(shp_cntry AS BIGINT) AS shp_cntry_id", "inv_no AS inv_cd", "orgnl_ord_no AS org_ord_id",
        "glbl_sales_chnl_cd AS ord_channel", "whse_cd", "ord_whse_cd", "shp_postal_cd",
        "CASE WHEN canc_flg = 'Y' THEN 'true' ELSE 'false' END AS ord_canc_flag",
        "CASE WHEN shp_flg = 'Y' THEN 'true' ELSE 'false' END AS ord_shp_flag",
        "pay_req_flg AS pay_req_flag", "ord_type_cd", "drop_cd", "ref_ord_ln_no AS ref_ln_id", "ord_ln_disp_cd",
    )


def conform_history(
    src: Mapping[str, DataFrame], months: Months, run_ts: dt.datetime, countries=fixed.HISTORY_COUNTRY_KEYS,
    piece: Piece | None = None,
) -> DataFrame:
    """Mart rows of the history load, all or those of a piece. Reads the hist_* tables.

    Every dimension is joined by its surrogate key. None is forced to be broadcast: Spark
    does that for those it measures as small, and shuffles the large ones.
    """
    demand = in_piece(_fact(src["hist_demand"], months, countries), "ord_no", piece)
    demand = role_join(demand, src["hist_country"], "cntry_key_no", {
        "oper_cntry_key_no": {"aff_id": "oper_aff_id", "amway_cntry_cd": "oper_cntry"},
    })
    demand = match(demand, src["hist_currency"].select("curcy_cd", "curcy_key_no").distinct(), ["curcy_key_no"])
    accounts = src["hist_account"].filter(F.col("imc_cntry_key_no").isin(*countries))
    demand = role_join(demand, accounts, "imc_key_no", {
        "vol_imc_key_no": {"imc_no": "vol_account_id"},
        "ord_imc_key_no": {"imc_no": "ord_account_id"},
        "shp_imc_key_no": {"imc_no": "shp_account_id"},
        "imc_key_no": {"imc_no": "account_id"},
    })
    items = src["hist_item"].filter(F.col("cntry_key_no").isin(*countries)).select(
        "item_key_no",
        F.nullif(F.trim("item_no"), F.lit("")).alias("item_cd"),
        base_item_code("item_no", test_from=4).alias("item_base_cd"),
    )
    demand = role_join(demand, items, "item_key_no", {
        "ord_item_key_no": {"item_cd": "ord_item_cd", "item_base_cd": "ord_item_base_cd"},
        "shp_item_key_no": {"item_cd": "shp_item_cd", "item_base_cd": "shp_item_base_cd"},
    })
    detail = _detail(src, months, countries, piece)
    full = match(demand, detail, {
        "oper_cntry_key_no": "d_cntry", "ord_mo_yr_key_no": "d_ym", "ord_no": "d_ord", "ord_ln_no": "d_ln",
    })
    return conform(
        full.withColumns({"ord_dt": day_from_key("ord_dt_key_no"), "shp_dt": day_from_key("shp_dt_key_no")}).selectExpr(
            *[c for c in detail.columns if not c.startswith("d_")],
            "oper_aff_id", "CAST(oper_cntry AS BIGINT) AS oper_cntry_id",
            "ord_dt", "ord_dt_key_no", "ord_mo_yr_key_no AS ord_mo_yr_id",
            "shp_dt", "shp_dt_key_no", "CAST(floor(shp_dt_key_no / 100) AS INT) AS shp_mo_yr_id",
            "CASE comb_ord_flg WHEN 1 THEN 'true' WHEN 0 THEN 'false' END AS comb_ord_flag",
            "comb_ord_no AS comb_ord_id", "ord_no AS ord_id", "curcy_cd",
            "account_id", "vol_account_id", "ord_account_id", "shp_account_id", "ord_ln_no AS ord_ln_id",
            "ord_item_cd", "shp_item_cd", "ord_item_base_cd", "shp_item_base_cd",
            "ibo_price_lc_amt AS adj_ln_lc_net", "pv_lc_amt AS adj_ln_pv", "bv_lc_amt AS adj_ln_bv",
            "ord_qty", "shp_qty", "deliverymode AS delivery_mode_cd", "consultant_id AS consultant_cd",
            f"{sql_ts(run_ts)} AS update_dt",
        ),
        MART,
        MART_WIDTHS["history"],
    )
