"""Column names and types of the mart, its control table and the source tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(38,6)": T.DecimalType(38, 6),  # numbers of undeclared scale
}


def _schema(columns: str) -> T.StructType:
    """Schema from "name type, ..." (a DDL string would need a running session)."""
    pairs = [c.split() for c in " ".join(columns.split()).split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


MART = _schema("""
    oper_aff_id bigint, oper_cntry_id bigint, shp_cntry_id bigint,
    ord_dt timestamp_ntz, ord_dt_key_no int, ord_mo_yr_id int,
    shp_dt timestamp_ntz, shp_dt_key_no int, shp_mo_yr_id int,
    comb_ord_flag string, comb_ord_id bigint, ord_id bigint, inv_cd string, curcy_cd string,
    ord_channel string, whse_cd string, ord_whse_cd string, shp_postal_cd string,
    account_id bigint, account_type_ord string,
    vol_account_id bigint, ord_account_id bigint, shp_account_id bigint,
    ord_canc_flag string, ord_shp_flag string, pay_req_flag string, ord_paid_flag string,
    org_ord_id bigint, ord_type_cd string, drop_cd string, delivery_fee_net decimal(38,6),
    ord_ln_id bigint, ref_ln_id bigint, ord_ln_disp_cd string,
    ord_item_cd string, shp_item_cd string, ord_item_base_cd string, shp_item_base_cd string,
    adj_ln_lc_net decimal(38,6), adj_ln_pv decimal(38,6), adj_ln_bv decimal(38,6),
    ord_qty decimal(38,6), shp_qty decimal(38,6),
    delivery_mode_cd string, consultant_cd string, update_dt timestamp_ntz
""")

INVOICES = _schema("""
    aff_id bigint, trx_sourc_cd string, cntry_id bigint, org_ord_id bigint,
    ord_dt timestamp_ntz, atm_update_dt timestamp_ntz, ord_bus_natr_cd string,
    vol_account_id bigint, invoice_cd string, ord_mo_yr_id int
""")

# Declared widths of the invoice table's texts.
INVOICE_WIDTHS = {"trx_sourc_cd": 3, "ord_bus_natr_cd": 3, "invoice_cd": 240}

# Widths the plans cut the mart's texts to, by source: in characters, and for the ordered item in bytes.
_WIDE = 240
MART_WIDTHS = {
    "source1": dict.fromkeys(("inv_cd", "ord_channel", "whse_cd", "ord_whse_cd", "shp_postal_cd", "ord_type_cd", "drop_cd",
                              "ord_ln_disp_cd", "shp_item_cd"), _WIDE),
    "source2": dict.fromkeys(("ord_channel", "whse_cd", "shp_postal_cd", "ord_type_cd", "ord_ln_disp_cd", "delivery_mode_cd",
                              "ord_item_cd", "shp_item_cd", "ord_item_base_cd", "shp_item_base_cd"), _WIDE),
    "source3": dict.fromkeys(("inv_cd", "ord_channel", "whse_cd", "ord_whse_cd", "shp_postal_cd", "delivery_mode_cd", "shp_item_cd"), _WIDE),
    "history": {"inv_cd": _WIDE},
}
ITEM_BYTES = {"ord_item_cd": 960}

PENDING = _schema("src string, ord_mo_yr_id int, updt_on_last_run_flg int")

# Columns the plans read from each source table.
SOURCES = {
    "src1_header": _schema("""
        ord bigint, comb_ord bigint, ord_curcy string, comb_ord_flg string, inv_nbr string,
        ord_type string, drop_cd string, whse string, ord_whse string, ord_dt int, ord_tm int,
        dlvr_dt int, ord_src string, ord_hndlg_price decimal(38,6), ord_pay_stat string,
        ctl_aff string, intgrt_ctl_aff string, cntry string, intgrt_cntry_cd string,
        vol_distb bigint, ord_distb bigint, shp_distb bigint, shp_adr bigint, ord_canc string,
        ord_shp string, pay_req string, orgnl_ord bigint, distb_ord_nbr string,
        last_updt_dt_key_no timestamp_ntz
    """),
    "src1_line": _schema("""
        ord bigint, ord_ln int, ln_type string, ref_ln int, item_type string, item_disp string,
        item string, item_qty decimal(38,6), item_price decimal(38,6), item_pv decimal(38,6),
        item_bv decimal(38,6), cntry string, intgrt_cntry_cd string
    """),
    "src1_channel": _schema("cntry_cd string, ord_type_cd string, ord_src_cd string, glbl_sales_chnl_cd string"),
    "src1_address": _schema("intgrt_aff_cd string, ctl_aff string, distb_nbr bigint, adr_seq bigint, post string"),
    "src2_header": _schema("""
        intgrt_aff_cd string, ord_no bigint, shp_cntry string, ord_dt timestamp_ntz, ord_type string,
        shp_imc_no string, vol_imc_no string, ord_imc_no string, shp_adr_ln_1 string, curcy_cd string,
        sale_chnl string, shp_postl_cd string, cancelled_flg string, open_flg string,
        updt_dt timestamp_ntz
    """),
    "src2_line": _schema("""
        ord_no bigint, intgrt_aff_cd string, whse_cd string, act_shp_dt timestamp_ntz, vol_imc_no string,
        ord_imc_no string, shp_imc_no string, dlvry_fee decimal(38,6), ord_ln_no int,
        oracle_line_id bigint, item_disp_cd string, item_type string, ord_item string,
        unit_sell_price decimal(38,6), ord_qty decimal(38,6), extend_pv_amt decimal(38,6),
        extend_bv_amt decimal(38,6), shp_qty decimal(38,6), shp_priority string
    """),
    "src3_header": _schema("""
        iso_country_code string, sales_order_id string, affiliate_code string, amway_sales_entity string,
        order_date_time timestamp_ntz, group_order_id bigint, iso_currency_code string,
        sales_channel_code string, volume_sales_account_id string, ordering_sales_account_id string,
        ship_to_sales_account_id string, order_status string, payment_required string,
        payment_status string, original_order_id string, total_order_value string,
        total_tax_amount string, order_price_list string, updt_dt timestamp_ntz
    """),
    "src3_consignment": _schema("""
        sales_order_id string, delivery_postal_code string, delivery_iso_country_code string,
        amway_sales_entity string, warehouse_code string, order_date_time timestamp_ntz, affiliate_code string
    """),
    "src3_line": _schema("""
        sale_country_code string, sales_order_id string, order_line_id string, bundle_item_id string,
        base_item_id string, line_price string, line_pv_amount decimal(38,6), line_bv_amount decimal(38,6),
        shipped_quantity decimal(38,6), pending_quantity decimal(38,6), ordered_quantity decimal(38,6),
        cancelled_quantity decimal(38,6), demand_location string, fulfillment_type string, affiliate_code string
    """),
    "src3_fulfilment": _schema(
        "sales_order_id string, sale_country_code string, order_line_id bigint, fulfilled_date timestamp_ntz"
    ),
    "src3_fees": _schema("""
        sales_order_id string, sale_country_code string, fee_code string, fee_amount string,
        fee_tax_total_amount string, affiliate_code string
    """),
    "src3_invoice": _schema(
        "sale_country_code string, sales_order_id string, order_line_id string, invoice_number string"
    ),
    "src4_header": _schema("""
        intgrt_cntry_cd string, cntry_cd string, intgrt_aff_cd string, aff_cd string,
        dlvry_addr_amway_cntry_cd string, ord_dt timestamp_ntz, comb_ord_flg string, comb_ord_no string,
        ord_no string, inv_no string, ord_curcy_cd string, ord_chnl_cd string, whse_nm string,
        ord_whse_nm string, dlvry_addr_post_cd string, vol_imc_no string, dlvry_addr_fam_nm string,
        dlvry_addr_given_nm string, bill_imc_no string, bill_imc_type_cd string, ord_imc_no string,
        shp_imc_no string, ord_canc_flg string, ord_shp_flg string, pay_req_flg string,
        ord_pay_stat_cd string, orgnl_ord_no string, ord_type_cd string, drop_cd string,
        dlvry_actual_cost_curcy_amt decimal(38,6), dlvry_mode_cd string,
        updt_dt timestamp_ntz
    """),
    "src4_line": _schema("""
        intgrt_cntry_cd string, cntry_cd string, intgrt_aff_cd string, aff_cd string, ord_no string,
        ord_ln_no string, ref_ln_no string, item_disp_desc string, ord_cd string, item_id string,
        adj_item_price_amt string, tot_pv_amt double, adj_item_price_pv_amt string, item_pv_amt double,
        adj_item_price_bv_amt string, item_bv_amt double, compnt_qty string, item_qty_amt double,
        pos_consltnt_id string
    """),
    "src4_consignment": _schema("intgrt_cntry_cd string, ord_no string, shp_dt timestamp_ntz"),
    "invoices": INVOICES,
    "invoice_txn": _schema("""
        aff_no bigint, trx_sourc_cd string, bus_entty_no bigint, orgnl_ord_no string, ord_dt timestamp_ntz,
        ord_bus_natr_cd string, orgnl_ref_txt string, bns_cust_id bigint, trx_creat_dtm timestamp_ntz,
        audit_creat_dtm timestamp_ntz, audit_chng_dtm timestamp_ntz
    """),
    "invoice_customer": _schema("bns_cust_id bigint, aff_no bigint, ibo_no string"),
    "source_map": _schema("cntry_id bigint, aff_id bigint, launch_mo_yr_id int, new_system_nm string"),
    "hist_detail": _schema("""
        ord_mo_yr_key_no int, oper_cntry_key_no bigint, ord_no bigint, ord_ln_no bigint, ref_ord_ln_no bigint,
        ord_cd_key_no bigint, ord_ln_key_no bigint, shp_cntry_key_no bigint, shp_postl_cd_key_no bigint,
        whse_key_no bigint, ord_whse_key_no bigint, ord_key_no bigint, glbl_sales_chnl_key_no bigint
    """),
    "hist_demand": _schema("""
        ord_mo_yr_key_no int, oper_cntry_key_no bigint, ord_no bigint, ord_ln_no bigint, ord_dt_key_no int,
        shp_dt_key_no int, comb_ord_flg int, comb_ord_no bigint, curcy_key_no bigint, imc_key_no bigint,
        vol_imc_key_no bigint, ord_imc_key_no bigint, shp_imc_key_no bigint, ord_item_key_no bigint,
        shp_item_key_no bigint, ibo_price_lc_amt decimal(38,6), pv_lc_amt decimal(38,6),
        bv_lc_amt decimal(38,6), ord_qty decimal(38,6), shp_qty decimal(38,6), deliverymode string,
        consultant_id string
    """),
    "hist_order_code": _schema(
        "ord_cd_key_no bigint, ord_type_cd string, drop_cd string, canc_flg string, shp_flg string, pay_req_flg string"
    ),
    "hist_line_code": _schema("ord_ln_key_no bigint, ord_ln_disp_cd string"),
    "hist_country": _schema("cntry_key_no bigint, aff_id bigint, amway_cntry_cd string"),
    "hist_postal": _schema("postl_cd_key_no bigint, postl_cd string"),
    "hist_warehouse": _schema("whse_key_no bigint, whse_cd string"),
    "hist_order": _schema("ord_key_no bigint, cntry_key_no bigint, orgnl_ord_no bigint, inv_no string"),
    "hist_channel": _schema("glbl_sales_chnl_key_no bigint, glbl_sales_chnl_cd string"),
    "hist_currency": _schema("curcy_key_no bigint, curcy_cd string"),
    "hist_account": _schema("imc_key_no bigint, imc_no bigint, imc_cntry_key_no bigint"),
    "hist_item": _schema("item_key_no bigint, cntry_key_no bigint, item_no string"),
}
