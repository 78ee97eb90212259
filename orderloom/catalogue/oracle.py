"""The registered queries as plain SQL for the checking engine, written apart from the plans."""

from __future__ import annotations

from .. import fixed
from ..plans.history import HISTORY_RANGE
from ..sources.schemas import INVOICES, ITEM_BYTES, MART, MART_WIDTHS
from .standins import RUN_TS, SOME_MONTHS, ctes

_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
_RUN = f"TIMESTAMP '{RUN_TS:%Y-%m-%d %H:%M:%S}'"


def _within(value: str, size: int) -> str:
    """The whole characters within the first so many bytes."""
    longest = f"list_max(list_filter(range(1, {size + 1}), lambda k: strlen(substr({value}, 1, CAST(k AS BIGINT))) <= {size}))"
    return f"CASE WHEN strlen({value}) <= {size} THEN {value} ELSE substr({value}, 1, {longest}) END"


def _typed(schema, given: dict[str, str], source: str | None = None, item_bytes: bool = False) -> str:
    """Select list of a schema; numbers as decimal first, then as double; absent columns NULL; texts cut to the source's widths."""
    given = given | {c: f"substr({given[c]}, 1, {n})" for c, n in MART_WIDTHS.get(source, {}).items() if c in given}
    if item_bytes:
        given["ord_item_cd"] = _within(given["ord_item_cd"], ITEM_BYTES["ord_item_cd"])
    unknown = set(given) - set(schema.names)
    assert not unknown, unknown
    parts = []
    for f in schema:
        value = given.get(f.name, "NULL")
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            parts.append(f"CAST(CAST({value} AS DECIMAL(38,6)) AS DOUBLE) AS {f.name}")
        else:
            parts.append(f"CAST({value} AS {_SQL_TYPES[kind]}) AS {f.name}")
    return ",\n  ".join(parts)


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _cases(column: str, mapping: dict, default: str) -> str:
    arms = " ".join(
        f"WHEN {column} = {_list([k])} THEN {_list([v])}" for k, v in mapping.items()
    )
    return f"CASE {arms} ELSE {default} END"


def _ym(ts: str) -> str:
    return f"CAST(year({ts}) * 100 + month({ts}) AS INTEGER)"


def _day(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INTEGER)"


def _day_ts(key: str, seconds: str = "0") -> str:
    """Midnight of a day key plus seconds; NULL for 0."""
    return f"(strptime(nullif(CAST({key} AS VARCHAR), '0'), '%Y%m%d') + to_seconds(CAST({seconds} AS BIGINT)))"


def _code(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _base(c: str, test_from: int = 5, width: int | None = None) -> str:
    """Cut before the first capital letter from position 4, if there is one from test_from."""
    code = f"nullif(trim(substr({c}, 1, {width})), '')" if width else c
    until = f"3 + length(regexp_extract(substr({code}, 4), '^[^A-Z]*'))"
    return f"CASE WHEN regexp_matches(substr({code}, {test_from}), '[A-Z]') THEN substr({code}, 1, {until}) ELSE {code} END"


def _zone(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE '{fixed.SRC2_ZONE}' AT TIME ZONE '{fixed.MART_ZONE_SRC2}')"


# --- the four sources ------------------------------------------------------

def _source1() -> tuple[list[str], str]:
    body = f""",
s1_hdr AS (
  SELECT *, CAST(floor(ord_dt / 100) AS INTEGER) AS ym,
         coalesce(nullif(trim(ctl_aff), ''), nullif(trim(intgrt_ctl_aff), '')) AS aff,
         coalesce(nullif(trim(cntry), ''), nullif(trim(intgrt_cntry_cd), '')) AS cc,
         coalesce(nullif(trim(ord_src), ''), '*') AS source_cd
  FROM src1_header),
s1_scope AS (
  SELECT * FROM s1_hdr WHERE aff IN ({_list(fixed.SRC1_AFFILIATES)})
     OR (aff IN ({_list(fixed.MOVING_AFFILIATES)}) AND ym <= {fixed.LAST_MONTH_OLD})),
s1_ord AS (
  SELECT s.*, CAST(cc AS BIGINT) AS cid,
         coalesce(max(CASE WHEN ord = comb_ord THEN substr(cc, 1, 3) END)
                  OVER (PARTITION BY aff, comb_ord, shp_distb, ord_dt), cc) AS oper_cc,
         CASE WHEN (distb_ord_nbr <> 'BBB' AND ((comb_ord_flg = 'N' AND vol_distb <> ord_distb)
                     OR (comb_ord_flg = 'Y' AND vol_distb <> ord_distb AND ord_distb <> shp_distb)))
                OR distb_ord_nbr = 'MBR' THEN 'Y' ELSE 'N' END AS for_cust
  FROM s1_scope s),
s1_full AS (
  SELECT o.*, ch.glbl_sales_chnl_cd AS channel, ad.postal
  FROM s1_ord o
  LEFT JOIN src1_channel ch ON o.cid = CAST(ch.cntry_cd AS BIGINT) AND o.ord_type = ch.ord_type_cd AND o.source_cd = ch.ord_src_cd
  LEFT JOIN (SELECT CAST(coalesce(nullif(trim(intgrt_aff_cd), ''), nullif(trim(ctl_aff), '')) AS BIGINT) AS aid,
                    distb_nbr, adr_seq, nullif(trim(post), '') AS postal FROM src1_address) ad
    ON o.shp_distb = ad.distb_nbr AND CAST(o.aff AS BIGINT) = ad.aid AND o.shp_adr = ad.adr_seq
   AND ad.aid IN (40, 150, 480)),
s1_ln AS (
  SELECT l.*, h.ym, CAST(h.cc AS BIGINT) AS cid
  FROM src1_line l JOIN s1_scope h
    ON l.ord = h.ord AND coalesce(nullif(trim(l.cntry), ''), nullif(trim(l.intgrt_cntry_cd), '')) = h.cc),
s1_stat AS (
  SELECT ym, cid, ord, ref_ln, count(CASE WHEN ln_type = 'P' THEN NULL ELSE ord_ln END) AS products, count(ord_ln) AS n_lines
  FROM s1_ln WHERE ord_ln <> ref_ln GROUP BY ym, cid, ord, ref_ln),
s1_qty AS (
  SELECT m.*, {_code("coalesce(r.item, m.item)")} AS o_item, {_code("m.item")} AS s_item,
         CASE WHEN m.ln_type IN ('O', 'A', 'R') THEN m.item_qty ELSE 0 END AS o_qty,
         CASE WHEN m.item_type <> 'I' OR m.item_disp = 'S' OR (m.ord_ln <> m.ref_ln AND m.item_type <> 'I')
                OR (m.ord_ln = m.ref_ln AND (s.products > 0 OR coalesce(s.n_lines, 0) = 0) AND m.item_disp IN ('E', 'S'))
              THEN 0 ELSE m.item_qty END AS s_qty
  FROM s1_ln m
  LEFT JOIN s1_ln r ON m.ym = r.ym AND m.ord = r.ord AND m.ref_ln = r.ord_ln AND m.cid = r.cid
  LEFT JOIN s1_stat s ON m.ym = s.ym AND m.ord = s.ord AND m.ord_ln = s.ref_ln AND m.cid = s.cid)"""
    cols = {
        "oper_aff_id": "o.aff", "oper_cntry_id": "o.oper_cc", "shp_cntry_id": "o.oper_cc",
        "ord_dt": _day_ts("o.ord_dt", "(o.ord_tm // 10000) * 3600 + (o.ord_tm // 100 % 100) * 60 + o.ord_tm % 100"),
        "ord_dt_key_no": "o.ord_dt", "ord_mo_yr_id": "o.ym", "shp_dt": _day_ts("o.dlvr_dt"), "shp_dt_key_no": "o.dlvr_dt",
        "shp_mo_yr_id": "o.dlvr_dt // 100", "comb_ord_flag": "CASE WHEN o.comb_ord_flg = 'Y' THEN 'true' ELSE 'false' END",
        "comb_ord_id": "o.comb_ord", "ord_id": "q.ord", "inv_cd": "o.inv_nbr",
        "curcy_cd": "CASE WHEN o.ord_curcy = 'CIP' THEN 'GBP' ELSE substr(o.ord_curcy, 1, 3) END",
        "ord_channel": "o.channel", "whse_cd": "o.whse", "ord_whse_cd": "o.ord_whse", "shp_postal_cd": "o.postal",
        "account_id": "CASE WHEN o.for_cust = 'Y' THEN o.ord_distb ELSE o.vol_distb END",
        "account_type_ord": "CASE WHEN o.ord_type = 'EMP' THEN 'Employee' WHEN o.for_cust = 'Y' THEN 'Member' ELSE 'ABO' END",
        "vol_account_id": "o.vol_distb", "ord_account_id": "o.ord_distb", "shp_account_id": "o.shp_distb",
        "ord_canc_flag": "CASE WHEN o.ord_canc = 'N' THEN 'false' ELSE 'true' END",
        "ord_shp_flag": "CASE WHEN o.ord_shp = 'N' THEN 'false' WHEN o.ord_shp = 'Y' THEN 'true' END",
        "pay_req_flag": "o.pay_req", "ord_paid_flag": "CASE WHEN o.ord_pay_stat = 'P' THEN 'true' ELSE 'false' END",
        "org_ord_id": "o.orgnl_ord", "ord_type_cd": "o.ord_type", "drop_cd": "o.drop_cd", "delivery_fee_net": "o.ord_hndlg_price",
        "ord_ln_id": "q.ord_ln", "ref_ln_id": "q.ref_ln", "ord_ln_disp_cd": "q.item_disp",
        "ord_item_cd": "q.o_item", "shp_item_cd": "q.s_item",
        "ord_item_base_cd": _base("q.o_item", width=15), "shp_item_base_cd": _base("q.s_item", width=15),
        "adj_ln_lc_net": "q.item_price", "adj_ln_pv": "q.item_pv", "adj_ln_bv": "q.item_bv",
        "ord_qty": "q.o_qty", "shp_qty": "q.s_qty", "update_dt": _RUN,
    }
    select = f"SELECT {_typed(MART, cols, 'source1', True)}\nFROM s1_qty q LEFT JOIN s1_full o ON q.ord = o.ord AND q.cid = o.cid AND q.ym = o.ym"
    return ["src1_header", "src1_line", "src1_channel", "src1_address"], body + f",\nout1 AS ({select})"


def _source2() -> tuple[list[str], str]:
    def account(c: str) -> str:
        return f"CAST(nullif(CASE WHEN substr({c}, 1, 3) = '570' THEN substr({c}, 4) ELSE {c} END, '') AS BIGINT)"

    body = f""",
s2_shift AS (SELECT *, {_zone("ord_dt")} AS local_dt FROM src2_header WHERE intgrt_aff_cd = '570'),
s2_ord AS (
  SELECT *, {_ym("local_dt")} AS ym, {account("vol_imc_no")} AS h_vol, {account("ord_imc_no")} AS h_ord, {account("shp_imc_no")} AS h_shp,
         coalesce(max(CASE WHEN shp_imc_no = vol_imc_no AND shp_imc_no = ord_imc_no AND ord_type = 'ZA_COMBINED_ORDER' THEN ord_no END)
                  OVER (PARTITION BY {_ym("local_dt")}, {_day("ord_dt")}, ord_type, shp_imc_no, shp_adr_ln_1), ord_no) AS comb
  FROM s2_shift),
s2_ln AS (
  SELECT *, {account("vol_imc_no")} AS l_vol, {account("ord_imc_no")} AS l_ord, {account("shp_imc_no")} AS l_shp,
         {_code("coalesce(max(CASE WHEN item_type = 'MODEL' THEN ord_item END) OVER (PARTITION BY ord_no, ord_ln_no), ord_item)")} AS o_item,
         {_code("ord_item")} AS s_item
  FROM src2_line WHERE intgrt_aff_cd = '570'),
s2_all AS (
  SELECT o.*, l.* EXCLUDE (ord_no, intgrt_aff_cd, vol_imc_no, ord_imc_no, shp_imc_no),
         CAST(i.ord_bus_natr_cd AS INTEGER) AS nature, coalesce(l.l_vol, o.h_vol) AS vol, coalesce(l.l_ord, o.h_ord) AS ordering,
         rank() OVER (PARTITION BY o.ym, o.ord_no ORDER BY l.ord_ln_no, l.oracle_line_id) AS rnk,
         {_zone("l.act_shp_dt")} AS shipped
  FROM s2_ln l JOIN s2_ord o ON o.intgrt_aff_cd = l.intgrt_aff_cd AND o.ord_no = l.ord_no
  LEFT JOIN invoices2 i ON i.aff_id = 570 AND i.ord_mo_yr_id = o.ym AND CAST(i.invoice_cd AS BIGINT) = o.ord_no
   AND coalesce(l.l_vol, o.h_vol) = i.vol_account_id)"""
    cols = {
        "oper_aff_id": "intgrt_aff_cd", "oper_cntry_id": "intgrt_aff_cd",
        "shp_cntry_id": _cases("shp_cntry", fixed.SRC2_SHIP_COUNTRIES, "570"),
        "ord_dt": "local_dt", "ord_dt_key_no": _day("local_dt"), "ord_mo_yr_id": "ym",
        "shp_dt": "shipped", "shp_dt_key_no": _day("shipped"), "shp_mo_yr_id": _ym("shipped"),
        "comb_ord_flag": "CASE WHEN ord_type = 'ZA_COMBINED_ORDER' THEN 'true' ELSE 'false' END",
        "comb_ord_id": "comb", "ord_id": "ord_no", "inv_cd": "ord_no", "curcy_cd": "substr(curcy_cd, 1, 3)",
        "ord_channel": "sale_chnl", "whse_cd": "whse_cd", "ord_whse_cd": "whse_cd", "shp_postal_cd": "shp_postl_cd",
        "account_id": "CASE WHEN nature IN (3, 6) THEN ordering ELSE vol END",
        "account_type_ord": "CASE nature WHEN 3 THEN 'Member' WHEN 6 THEN 'Employee' ELSE 'ABO' END",
        "vol_account_id": "vol", "ord_account_id": "ordering", "shp_account_id": "coalesce(l_shp, h_shp)",
        "ord_canc_flag": "CASE WHEN cancelled_flg = 'Y' THEN 'true' ELSE 'false' END",
        "ord_shp_flag": "CASE WHEN open_flg = 'Y' THEN 'false' ELSE 'true' END",
        "pay_req_flag": "'Y'", "ord_type_cd": "ord_type", "delivery_fee_net": "dlvry_fee",
        "ord_ln_id": "rnk", "ref_ln_id": "ord_ln_no", "ord_ln_disp_cd": "CASE WHEN item_disp_cd = ' ' THEN '*' ELSE item_disp_cd END",
        "ord_item_cd": "o_item", "shp_item_cd": "s_item", "ord_item_base_cd": _base("o_item"), "shp_item_base_cd": _base("s_item"),
        "adj_ln_lc_net": "unit_sell_price * ord_qty", "adj_ln_pv": "extend_pv_amt", "adj_ln_bv": "extend_bv_amt",
        "ord_qty": "CASE WHEN item_type <> 'OPTION' THEN ord_qty ELSE 0 END",
        "shp_qty": "CASE WHEN item_type <> 'MODEL' THEN shp_qty ELSE 0 END",
        "delivery_mode_cd": "shp_priority", "update_dt": _RUN,
    }
    return ["src2_header", "src2_line", "invoices2"], body + f",\nout2 AS (SELECT {_typed(MART, cols, 'source2')} FROM s2_all)"


def _millionths(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"


def _share(amount: str, part: str, whole: str) -> str:
    """amount * part / whole to the cent, half away from zero, in whole millionths."""
    product = f"({_millionths(amount)} * {_millionths(part)})"
    bottom = _millionths(whole)
    return (
        f"CASE WHEN {bottom} <> 0 THEN CAST((abs({product}) * 2 + abs({bottom}) * 10000) // (abs({bottom}) * 20000) AS BIGINT)"
        f" * sign({product}) * sign({bottom}) / 100.0 END"
    )


def _source3() -> tuple[list[str], str]:
    rounding = f"fee_code IN ({_list(fixed.ROUNDING_FEES)})"
    amount, tax = ("coalesce(CAST({} AS DECIMAL(38,6)), 0)".format(c) for c in ("fee_amount", "fee_tax_total_amount"))
    body = f""",
s3_place AS (
  SELECT DISTINCT {_ym("order_date_time")} AS ym, sales_order_id, delivery_postal_code, delivery_iso_country_code,
         amway_sales_entity, warehouse_code
  FROM src3_consignment WHERE affiliate_code = '030'),
s3_ord AS (
  SELECT h.*, {_ym("h.order_date_time")} AS ym, p.delivery_postal_code, p.delivery_iso_country_code, p.warehouse_code,
         p.amway_sales_entity AS place_entity,
         coalesce(h.group_order_id, CAST(h.sales_order_id AS BIGINT)) AS comb,
         count(h.sales_order_id) OVER (PARTITION BY {_ym("h.order_date_time")}, h.amway_sales_entity,
               coalesce(h.group_order_id, CAST(h.sales_order_id AS BIGINT))) AS n_comb,
         CAST(h.total_order_value AS DECIMAL(38,6)) - CAST(h.total_tax_amount AS DECIMAL(38,6)) AS net_value
  FROM src3_header h LEFT JOIN s3_place p
    ON h.sales_order_id = p.sales_order_id AND h.amway_sales_entity = p.amway_sales_entity AND p.ym = {_ym("h.order_date_time")}
  WHERE h.affiliate_code = '030'),
s3_ln AS (
  SELECT *, CAST(line_price AS DECIMAL(38,6)) AS price,
         sum(CAST(line_price AS DECIMAL(38,6))) OVER (PARTITION BY sales_order_id, sale_country_code) AS price_total
  FROM src3_line WHERE affiliate_code = '030'),
s3_ship AS (
  SELECT sales_order_id, sale_country_code, order_line_id, max(fulfilled_date) AS shipped
  FROM src3_fulfilment WHERE sale_country_code IN ('AU', 'NZ') GROUP BY ALL),
s3_fee AS (
  SELECT sales_order_id, sale_country_code, sum({amount}) - sum({tax}) AS fee_total,
         sum(CASE WHEN {rounding} THEN 0 ELSE {amount} END) - sum(CASE WHEN {rounding} THEN 0 ELSE {tax} END) AS fee_net
  FROM src3_fees WHERE affiliate_code = '030' GROUP BY ALL),
s3_all AS (
  SELECT o.*, l.* EXCLUDE (sales_order_id, affiliate_code), s.shipped, f.fee_total, f.fee_net, i.invoice_number,
         {_code("coalesce(l.bundle_item_id, l.base_item_id)")} AS o_item, {_code("l.base_item_id")} AS s_item
  FROM s3_ln l
  JOIN s3_ord o ON CAST(l.sales_order_id AS BIGINT) = CAST(o.sales_order_id AS BIGINT) AND l.sale_country_code = o.iso_country_code
  LEFT JOIN src3_invoice i ON l.sale_country_code = i.sale_country_code AND l.sales_order_id = i.sales_order_id
   AND CAST(l.order_line_id AS BIGINT) = CAST(i.order_line_id AS BIGINT)
  LEFT JOIN s3_ship s ON l.sale_country_code = s.sale_country_code AND l.sales_order_id = s.sales_order_id
   AND CAST(l.order_line_id AS BIGINT) = s.order_line_id
  LEFT JOIN s3_fee f ON l.sale_country_code = f.sale_country_code AND l.sales_order_id = f.sales_order_id)"""
    cols = {
        "oper_aff_id": "affiliate_code", "oper_cntry_id": "amway_sales_entity",
        "shp_cntry_id": _cases("delivery_iso_country_code", fixed.SRC3_SHIP_COUNTRIES, "CAST(amway_sales_entity AS BIGINT)"),
        "ord_dt": "order_date_time", "ord_dt_key_no": _day("order_date_time"), "ord_mo_yr_id": "ym",
        "shp_dt": "shipped", "shp_dt_key_no": _day("shipped"), "shp_mo_yr_id": _ym("shipped"),
        "comb_ord_flag": "CASE WHEN n_comb > 1 THEN 'true' ELSE 'false' END", "comb_ord_id": "comb", "ord_id": "sales_order_id",
        "inv_cd": "invoice_number", "curcy_cd": "substr(iso_currency_code, 1, 3)", "ord_channel": "sales_channel_code",
        "whse_cd": "warehouse_code", "ord_whse_cd": "demand_location", "shp_postal_cd": "delivery_postal_code",
        "account_id": f"CASE WHEN trim(order_price_list) = '{fixed.OWNER_PRICE_LIST}' THEN volume_sales_account_id ELSE ordering_sales_account_id END",
        "account_type_ord": _cases("trim(order_price_list)", fixed.PRICE_LIST_TYPES, "NULL"),
        "vol_account_id": "volume_sales_account_id", "ord_account_id": "ordering_sales_account_id", "shp_account_id": "ship_to_sales_account_id",
        "ord_canc_flag": "CASE WHEN order_status = 'CANCELLED' THEN 'true' ELSE 'false' END",
        "ord_shp_flag": "CASE WHEN shipped IS NULL THEN 'false' ELSE 'true' END",
        "pay_req_flag": "CASE WHEN payment_required = 'true' THEN 'Y' ELSE 'N' END",
        "ord_paid_flag": "CASE WHEN payment_status = 'PAID' THEN 'true' ELSE 'false' END",
        "org_ord_id": "nullif(regexp_replace(original_order_id, '[^0-9]', '', 'g'), '')",
        "delivery_fee_net": "CASE WHEN place_entity IS NULL THEN 0 ELSE fee_net END",
        "ord_ln_id": "order_line_id", "ord_ln_disp_cd": "'*'", "ord_item_cd": "o_item", "shp_item_cd": "s_item",
        "ord_item_base_cd": _base("o_item", width=15), "shp_item_base_cd": _base("s_item", width=15),
        "adj_ln_lc_net": _share("price", "(nullif(net_value, 0) - fee_total)", "price_total"),
        "adj_ln_pv": "line_pv_amount", "adj_ln_bv": "line_bv_amount",
        "ord_qty": "coalesce(shipped_quantity, 0) + coalesce(pending_quantity, 0)",
        "shp_qty": "coalesce(ordered_quantity, 0) - coalesce(cancelled_quantity, 0)",
        "delivery_mode_cd": "fulfillment_type", "update_dt": _RUN,
    }
    tables = ["src3_header", "src3_consignment", "src3_line", "src3_fulfilment", "src3_fees", "src3_invoice"]
    return tables, body + f",\nout3 AS (SELECT {_typed(MART, cols, 'source3', True)} FROM s3_all)"


def _source4() -> tuple[list[str], str]:
    pairs = " OR ".join(f"(cc = '{c}' AND vol_imc_no = '{a}')" for c, a in fixed.PLACEHOLDER_ACCOUNTS.items())
    dummy = f"({pairs} OR (cc IN ({_list(fixed.PLACEHOLDER_IS_COUNTRY)}) AND vol_imc_no = cc))"
    base, moving = _list(fixed.SRC4_AFFILIATES), _list(fixed.MOVING_AFFILIATES)
    name = "nullif(trim(concat(dlvry_addr_fam_nm, dlvry_addr_given_nm)), '')"
    number = f"CAST(('0x' || substr(md5(rpad({name}, 7, 'X')), 1, 15)) AS BIGINT)"
    body = f""",
s4_hdr AS (
  SELECT *, coalesce(intgrt_cntry_cd, cntry_cd) AS cc, coalesce(intgrt_aff_cd, aff_cd) AS aff, {_ym("ord_dt")} AS ym FROM src4_header),
s4_ord AS (
  SELECT * FROM s4_hdr WHERE aff IN ({base}) OR (aff IN ({moving}) AND ym >= {fixed.FIRST_MONTH_NEW})),
s4_ln AS (
  SELECT *, coalesce(intgrt_cntry_cd, cntry_cd) AS lcc, coalesce(intgrt_aff_cd, aff_cd) AS laff FROM src4_line),
s4_ship AS (
  SELECT intgrt_cntry_cd, CAST(ord_no AS BIGINT) AS ord_no, max(shp_dt) AS shipped FROM src4_consignment GROUP BY ALL),
s4_all AS (
  SELECT o.*, l.intgrt_cntry_cd AS l_intgrt, l.lcc, l.ord_ln_no, l.ref_ln_no, l.item_disp_desc, l.adj_item_price_amt, l.tot_pv_amt,
         l.adj_item_price_pv_amt, l.item_pv_amt, l.adj_item_price_bv_amt, l.item_bv_amt, l.item_qty_amt, l.pos_consltnt_id,
         {_code("coalesce(l.ord_cd, l.item_id)")} AS o_item, {_code("l.item_id")} AS s_item,
         CASE WHEN min(l.ord_ln_no) OVER (PARTITION BY o.ym, l.lcc, l.ord_no, coalesce(l.ord_cd, l.item_id)) = l.ord_ln_no
              THEN coalesce(CAST(l.compnt_qty AS DOUBLE), l.item_qty_amt) ELSE 0 END AS o_qty,
         CASE WHEN l.intgrt_cntry_cd IN ({_list(fixed.SRC4_CONSIGNMENT_COUNTRIES)})
                OR (l.intgrt_cntry_cd IN ({_list(fixed.SRC4_MOVING_CONSIGNMENT_COUNTRIES)}) AND o.ym >= {fixed.FIRST_MONTH_NEW})
              THEN s.shipped END AS shipped
  FROM s4_ln l
  JOIN s4_ord o ON CAST(l.ord_no AS BIGINT) = CAST(o.ord_no AS BIGINT) AND CAST(l.lcc AS BIGINT) = CAST(o.cc AS BIGINT)
  LEFT JOIN s4_ship s ON CAST(l.ord_no AS BIGINT) = s.ord_no AND l.intgrt_cntry_cd = s.intgrt_cntry_cd
  WHERE l.laff IN ({base}) OR (l.laff IN ({moving}) AND o.ym >= {fixed.FIRST_MONTH_NEW}))"""
    cols = {
        "oper_aff_id": "aff", "oper_cntry_id": "cc", "shp_cntry_id": "dlvry_addr_amway_cntry_cd", "ord_dt": "ord_dt",
        "ord_dt_key_no": _day("ord_dt"), "ord_mo_yr_id": "ym", "shp_dt": "shipped", "shp_dt_key_no": _day("shipped"),
        "shp_mo_yr_id": _ym("shipped"), "comb_ord_flag": "CASE comb_ord_flg WHEN 'Y' THEN 'true' WHEN 'N' THEN 'false' END",
        "comb_ord_id": "comb_ord_no", "ord_id": "ord_no", "inv_cd": "inv_no", "curcy_cd": "ord_curcy_cd", "ord_channel": "ord_chnl_cd",
        "whse_cd": "whse_nm", "ord_whse_cd": "coalesce(ord_whse_nm, whse_nm)", "shp_postal_cd": "nullif(trim(dlvry_addr_post_cd), '')",
        "account_id": f"CASE WHEN {dummy} THEN {number} ELSE CAST(bill_imc_no AS BIGINT) END",
        "account_type_ord": f"CASE WHEN {dummy} THEN 'FOA' WHEN trim(bill_imc_type_cd) = 'E' THEN 'Employee'"
        f" WHEN trim(bill_imc_type_cd) IN ({_list(fixed.OWNER_BILLING_TYPES)}) THEN 'ABO' ELSE 'Customer' END",
        "vol_account_id": "vol_imc_no", "ord_account_id": "ord_imc_no", "shp_account_id": "shp_imc_no",
        "ord_canc_flag": "CASE WHEN ord_canc_flg = 'Y' THEN 'true' ELSE 'false' END",
        "ord_shp_flag": "CASE WHEN ord_shp_flg = 'Y' THEN 'true' ELSE 'false' END", "pay_req_flag": "pay_req_flg",
        "ord_paid_flag": "CASE WHEN ord_pay_stat_cd = 'PAID' THEN 'true' ELSE 'false' END", "org_ord_id": "orgnl_ord_no",
        "ord_type_cd": "ord_type_cd", "drop_cd": "drop_cd", "delivery_fee_net": "dlvry_actual_cost_curcy_amt",
        "ord_ln_id": "ord_ln_no", "ref_ln_id": "ref_ln_no", "ord_ln_disp_cd": "item_disp_desc", "ord_item_cd": "o_item",
        "shp_item_cd": "s_item", "ord_item_base_cd": _base("o_item", width=15), "shp_item_base_cd": _base("s_item", width=15),
        "adj_ln_lc_net": "coalesce(CAST(adj_item_price_amt AS DOUBLE), 0)",
        "adj_ln_pv": f"CASE WHEN lcc = '{fixed.TOTAL_POINTS_COUNTRY}' THEN tot_pv_amt ELSE coalesce(CAST(adj_item_price_pv_amt AS DOUBLE), item_pv_amt) END",
        "adj_ln_bv": "coalesce(CAST(adj_item_price_bv_amt AS DOUBLE), item_bv_amt)", "ord_qty": "o_qty", "shp_qty": "item_qty_amt",
        "delivery_mode_cd": "dlvry_mode_cd", "consultant_cd": "pos_consltnt_id", "update_dt": _RUN,
    }
    return ["src4_header", "src4_line", "src4_consignment"], body + f",\nout4 AS (SELECT {_typed(MART, cols)} FROM s4_all)"


def _history() -> str:
    keys = _list(fixed.HISTORY_COUNTRY_KEYS)
    tables = ["hist_demand", "hist_detail", "hist_order_code", "hist_line_code", "hist_country", "hist_postal",
              "hist_warehouse", "hist_order", "hist_channel", "hist_currency", "hist_account", "hist_item"]
    body = f""",
acc AS (SELECT imc_key_no, imc_no FROM hist_account WHERE imc_cntry_key_no IN ({keys})),
itm AS (SELECT item_key_no, {_code("item_no")} AS cd FROM hist_item WHERE cntry_key_no IN ({keys})),
det AS (
  SELECT f.*, oc.ord_type_cd, oc.drop_cd, oc.canc_flg, oc.shp_flg, oc.pay_req_flg, lc.ord_ln_disp_cd, co.amway_cntry_cd AS shp_cc,
         po.postl_cd, w1.whse_cd AS w1, w2.whse_cd AS w2, od.orgnl_ord_no, od.inv_no, ch.glbl_sales_chnl_cd
  FROM hist_detail f
  LEFT JOIN hist_order_code oc ON f.ord_cd_key_no = oc.ord_cd_key_no
  LEFT JOIN hist_line_code lc ON f.ord_ln_key_no = lc.ord_ln_key_no
  LEFT JOIN hist_country co ON f.shp_cntry_key_no = co.cntry_key_no
  LEFT JOIN hist_postal po ON f.shp_postl_cd_key_no = po.postl_cd_key_no
  LEFT JOIN hist_warehouse w1 ON f.whse_key_no = w1.whse_key_no
  LEFT JOIN hist_warehouse w2 ON f.ord_whse_key_no = w2.whse_key_no
  LEFT JOIN (SELECT * FROM hist_order WHERE cntry_key_no IN ({keys})) od ON f.ord_key_no = od.ord_key_no
  LEFT JOIN hist_channel ch ON f.glbl_sales_chnl_key_no = ch.glbl_sales_chnl_key_no
  WHERE f.oper_cntry_key_no IN ({keys}))"""
    cols = {
        "oper_aff_id": "c.aff_id", "oper_cntry_id": "c.amway_cntry_cd", "shp_cntry_id": "g.shp_cc", "ord_dt": _day_ts("d.ord_dt_key_no"),
        "ord_dt_key_no": "d.ord_dt_key_no", "ord_mo_yr_id": "d.ord_mo_yr_key_no", "shp_dt": _day_ts("d.shp_dt_key_no"),
        "shp_dt_key_no": "d.shp_dt_key_no", "shp_mo_yr_id": "d.shp_dt_key_no // 100",
        "comb_ord_flag": "CASE d.comb_ord_flg WHEN 1 THEN 'true' WHEN 0 THEN 'false' END", "comb_ord_id": "d.comb_ord_no", "ord_id": "d.ord_no",
        "inv_cd": "g.inv_no", "curcy_cd": "cu.curcy_cd", "ord_channel": "g.glbl_sales_chnl_cd", "whse_cd": "g.w1", "ord_whse_cd": "g.w2",
        "shp_postal_cd": "g.postl_cd", "account_id": "ab.imc_no", "vol_account_id": "av.imc_no", "ord_account_id": "ao.imc_no",
        "shp_account_id": "a_s.imc_no",
        "ord_canc_flag": "CASE WHEN g.ord_no IS NULL THEN NULL WHEN g.canc_flg = 'Y' THEN 'true' ELSE 'false' END",
        "ord_shp_flag": "CASE WHEN g.ord_no IS NULL THEN NULL WHEN g.shp_flg = 'Y' THEN 'true' ELSE 'false' END",
        "pay_req_flag": "g.pay_req_flg", "org_ord_id": "g.orgnl_ord_no", "ord_type_cd": "g.ord_type_cd", "drop_cd": "g.drop_cd",
        "ord_ln_id": "d.ord_ln_no", "ref_ln_id": "g.ref_ord_ln_no", "ord_ln_disp_cd": "g.ord_ln_disp_cd", "ord_item_cd": "io.cd",
        "shp_item_cd": "i_s.cd", "ord_item_base_cd": _base("io.cd", 4), "shp_item_base_cd": _base("i_s.cd", 4),
        "adj_ln_lc_net": "d.ibo_price_lc_amt", "adj_ln_pv": "d.pv_lc_amt", "adj_ln_bv": "d.bv_lc_amt", "ord_qty": "d.ord_qty",
        "shp_qty": "d.shp_qty", "delivery_mode_cd": "d.deliverymode", "consultant_cd": "d.consultant_id", "update_dt": _RUN,
    }
    return ctes(*tables) + body + f"""
SELECT {_typed(MART, cols, "history")}
FROM hist_demand d
LEFT JOIN hist_country c ON d.oper_cntry_key_no = c.cntry_key_no
LEFT JOIN (SELECT DISTINCT curcy_cd, curcy_key_no FROM hist_currency) cu ON d.curcy_key_no = cu.curcy_key_no
LEFT JOIN acc av ON d.vol_imc_key_no = av.imc_key_no LEFT JOIN acc ao ON d.ord_imc_key_no = ao.imc_key_no
LEFT JOIN acc a_s ON d.shp_imc_key_no = a_s.imc_key_no LEFT JOIN acc ab ON d.imc_key_no = ab.imc_key_no
LEFT JOIN itm io ON d.ord_item_key_no = io.item_key_no LEFT JOIN itm i_s ON d.shp_item_key_no = i_s.item_key_no
LEFT JOIN det g ON d.oper_cntry_key_no = g.oper_cntry_key_no AND d.ord_mo_yr_key_no = g.ord_mo_yr_key_no
 AND d.ord_no = g.ord_no AND d.ord_ln_no = g.ord_ln_no
WHERE d.oper_cntry_key_no IN ({keys})"""


def _invoices() -> str:
    cols = {
        "aff_id": "aff_no", "trx_sourc_cd": "trx_sourc_cd", "cntry_id": "bus_entty_no",
        "org_ord_id": "coalesce(min(CAST(orgnl_ord_no AS BIGINT)), 0)", "ord_dt": "ord_dt", "atm_update_dt": _RUN,
        "ord_bus_natr_cd": "coalesce(min(nullif(trim(ord_bus_natr_cd), '')), '1')", "vol_account_id": "ibo_no",
        "invoice_cd": "left(orgnl_ref_txt, 240)", "ord_mo_yr_id": "ym",
    }
    return ctes("invoice_txn", "invoice_customer") + f""",
ranked AS (
  SELECT *, {_ym("ord_dt")} AS ym,
         dense_rank() OVER (PARTITION BY {_ym("ord_dt")}, bus_entty_no, orgnl_ref_txt, bns_cust_id ORDER BY ord_dt) AS r
  FROM invoice_txn WHERE aff_no IN (570, 30) AND trim(trx_sourc_cd) = '003'),
named AS (
  SELECT t.*, CAST(c.ibo_no AS BIGINT) AS ibo_no
  FROM ranked t LEFT JOIN (SELECT * FROM invoice_customer WHERE aff_no IN (570, 30)) c ON t.bns_cust_id = c.bns_cust_id
  WHERE r = 1 AND orgnl_ref_txt IS NOT NULL)
SELECT {_typed(INVOICES, cols)}
FROM named GROUP BY aff_no, trx_sourc_cd, bus_entty_no, ord_dt, ibo_no, left(orgnl_ref_txt, 240), ym"""


def conform_queries() -> dict[str, str]:
    parts = {1: _source1(), 2: _source2(), 3: _source3(), 4: _source4()}
    queries = {f"conform_source{n}": f"{ctes(*tables)}{body}\nSELECT * FROM out{n}" for n, (tables, body) in parts.items()}
    everything = ctes(*[t for tables, _ in parts.values() for t in tables]) + "".join(body for _, body in parts.values())
    listed = ", ".join(map(str, SOME_MONTHS))
    queries |= {f"{name}_months": f"SELECT * FROM ({sql}) WHERE ord_mo_yr_id IN ({listed})" for name, sql in queries.items()}
    queries["conform_all"] = everything + "\n" + "\nUNION ALL\n".join(f"SELECT * FROM out{n}" for n in parts)
    queries["history_star"] = _history()
    queries["invoice_earliest"] = _invoices()
    return queries


# --- source map and control state ------------------------------------------

def control_queries() -> dict[str, str]:
    from .queries import EVENT_TAGS, FOCUS_MONTHS

    q: dict[str, str] = {}
    focus = "(SELECT unnest([" + _list(FOCUS_MONTHS) + "])::INTEGER AS focus_ym)"
    q["source_by_focus_month"] = ctes("source_map") + f""",
by_both AS (
  SELECT focus_ym, cntry_id, aff_id, new_system_nm,
         row_number() OVER (PARTITION BY focus_ym, cntry_id, aff_id ORDER BY launch_mo_yr_id DESC, new_system_nm DESC) AS r
  FROM {focus} f JOIN source_map ON launch_mo_yr_id <= focus_ym),
by_aff AS (
  SELECT focus_ym, aff_id, new_system_nm,
         row_number() OVER (PARTITION BY focus_ym, aff_id ORDER BY launch_mo_yr_id DESC, new_system_nm DESC) AS r
  FROM {focus} f JOIN source_map ON launch_mo_yr_id <= focus_ym),
c AS (SELECT focus_ym, new_system_nm AS src, string_agg(cntry_id::VARCHAR, ', ' ORDER BY aff_id, cntry_id) AS cntry_list
      FROM by_both WHERE r = 1 GROUP BY ALL),
a AS (SELECT focus_ym, new_system_nm AS src, string_agg(aff_id::VARCHAR, ', ' ORDER BY aff_id) AS aff_list
      FROM by_aff WHERE r = 1 GROUP BY ALL)
SELECT c.focus_ym, c.src, c.cntry_list, a.aff_list FROM c LEFT JOIN a ON c.focus_ym = a.focus_ym AND c.src = a.src"""

    heads = ctes("pend_state", "src1_header", "src2_header", "src3_header", "src4_header")
    day = f"DATE '{RUN_TS:%Y-%m-%d}'"

    def found(moved: bool) -> str:
        old = f" AND (aff IN ({_list(fixed.SRC1_AFFILIATES)}) OR ym <= {fixed.LAST_MONTH_OLD})" if moved else ""
        new = (f" OR (aff IN ({_list(fixed.MOVING_AFFILIATES)}) AND ym >= {fixed.FIRST_MONTH_NEW})" if moved else "")
        return f""",
changed AS (
  SELECT DISTINCT 'EU_AS400' AS src, ym AS ord_mo_yr_id FROM (
    SELECT coalesce(intgrt_ctl_aff, ctl_aff) AS aff, ord_dt // 100 AS ym, last_updt_dt_key_no AS u FROM src1_header)
  WHERE aff IN ('150', '480', '040') AND ym >= {fixed.REOPEN_FLOOR} AND CAST(u AS DATE) = {day}{old}
  UNION ALL
  SELECT DISTINCT 'EU_ATLAS', {_ym(_zone("ord_dt"))} FROM src2_header
  WHERE intgrt_aff_cd = '570' AND {_ym(_zone("ord_dt"))} >= {fixed.REOPEN_FLOOR} AND CAST(updt_dt AS DATE) = {day}
  UNION ALL
  SELECT DISTINCT 'EU_HYBR_EOM', {_ym("order_date_time")} FROM src3_header
  WHERE affiliate_code = '030' AND {_ym("order_date_time")} >= {fixed.REOPEN_FLOOR} AND CAST(updt_dt AS DATE) = {day}
  UNION ALL
  SELECT DISTINCT 'EU_HYBR_NON_EOM', ym FROM (
    SELECT coalesce(intgrt_aff_cd, aff_cd) AS aff, {_ym("ord_dt")} AS ym, updt_dt AS u FROM src4_header)
  WHERE (aff IN ({_list(fixed.SRC4_AFFILIATES)}){new}) AND ym >= {fixed.REOPEN_FLOOR} AND CAST(u AS DATE) = {day})"""

    def queued(state: str) -> str:
        return f""",
queued AS (
  SELECT src, ord_mo_yr_id, updt_on_last_run_flg FROM {state}
  UNION ALL
  SELECT src, CAST(ord_mo_yr_id AS INTEGER), 0 FROM changed c
  WHERE NOT EXISTS (SELECT 1 FROM {state} s WHERE s.src = c.src AND s.ord_mo_yr_id = c.ord_mo_yr_id))
SELECT src, ord_mo_yr_id, CAST(updt_on_last_run_flg + CASE WHEN updt_on_last_run_flg > 0 THEN 1 ELSE 0 END AS INTEGER)
       AS updt_on_last_run_flg FROM queued"""

    q["pending_detect"] = heads + found(False) + queued("pend_state")
    q["pending_detect_follow_moves"] = heads + found(True) + " SELECT src, CAST(ord_mo_yr_id AS INTEGER) AS ord_mo_yr_id FROM changed"
    q["pending_enqueue_events"] = ctes("event_state") + f""",
earlier AS (SELECT * FROM event_state WHERE ord_mo_yr_id < 20240130),
changed AS (SELECT DISTINCT event_type AS src, {_day("ts")} AS ord_mo_yr_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30')""" + queued("earlier")

    def view(state: str, tags=EVENT_TAGS) -> str:
        names = ", ".join(f"coalesce(max(CASE WHEN src = '{t}' THEN ord_mo_yr_id END), 0) AS {t}" for t in tags)
        return f""",
aged_v AS (SELECT *, dense_rank() OVER (ORDER BY ord_mo_yr_id DESC NULLS FIRST) AS rk FROM {state}),
flagged AS (SELECT src, ord_mo_yr_id, rk, CASE WHEN rk <= 2 THEN 0 ELSE updt_on_last_run_flg END AS updt_on_last_run_flg FROM aged_v),
wide AS (SELECT updt_on_last_run_flg, rk, {names} FROM flagged WHERE updt_on_last_run_flg = 0 GROUP BY updt_on_last_run_flg, rk),
view_v AS (
  SELECT {", ".join(tags)}, updt_on_last_run_flg, greatest({", ".join(tags)}) AS ord_mo_yr_id,
         CAST(dense_rank() OVER (ORDER BY greatest({", ".join(tags)}) DESC) AS INTEGER) AS mnth_rnk FROM wide)"""

    def planned_of(tags) -> str:
        return " UNION ALL ".join(
            f"SELECT mnth_rnk, '{t}' AS src, {t} AS src_mo_yr_id, ord_mo_yr_id FROM view_v" for t in tags
        )

    def after_run(aged: str, tags, most: int = 10**9) -> str:
        """What a night run of at most so many ranks leaves of the state: planned pairs done, old done ones forgotten."""
        return view(aged, tags) + f""",
planned AS (SELECT * FROM ({planned_of(tags)}) WHERE src_mo_yr_id > 0 AND mnth_rnk <= {most}),
marked AS (
  SELECT a.src, a.ord_mo_yr_id, CASE WHEN p.src IS NOT NULL THEN 1 ELSE a.updt_on_last_run_flg END AS updt_on_last_run_flg
  FROM {aged} a LEFT JOIN planned p ON a.src = p.src AND a.ord_mo_yr_id = p.src_mo_yr_id),
left_over AS (
  SELECT src, ord_mo_yr_id, CAST(updt_on_last_run_flg AS INTEGER) AS updt_on_last_run_flg FROM marked
  WHERE NOT (updt_on_last_run_flg > 0 AND ord_mo_yr_id NOT IN (SELECT ord_mo_yr_id FROM view_v WHERE mnth_rnk IN (1, 2))))"""

    events = ctes("event_state")
    q["pending_pivot"] = events + view("event_state") + " SELECT * FROM view_v"
    stacked = planned_of(EVENT_TAGS)
    q["plan_months"] = events + view("event_state") + f" SELECT * FROM ({stacked}) WHERE mnth_rnk <= {fixed.DAY_RUN_MONTHS}"
    q["plan_months_night"] = events + view("event_state") + f" SELECT * FROM ({stacked})"
    q["months_wanted"] = events + view("event_state") + f"""
SELECT max(mnth_rnk) AS by_night, least({fixed.DAY_RUN_MONTHS}, max(mnth_rnk)) AS by_day FROM view_v"""
    q["pending_age_mark_purge"] = events + """,
aged AS (SELECT src, ord_mo_yr_id, CASE WHEN updt_on_last_run_flg > 0 THEN updt_on_last_run_flg + 1 ELSE updt_on_last_run_flg END
         AS updt_on_last_run_flg FROM event_state)""" + after_run("aged", EVENT_TAGS) + " SELECT * FROM left_over"
    q["status_report"] = events + """,
u AS (SELECT src, string_agg(ord_mo_yr_id::VARCHAR, ', ' ORDER BY ord_mo_yr_id DESC) AS updated
      FROM event_state WHERE updt_on_last_run_flg = 1 GROUP BY src),
d AS (SELECT src, string_agg(ord_mo_yr_id::VARCHAR, ', ' ORDER BY ord_mo_yr_id DESC) AS deferred
      FROM event_state WHERE updt_on_last_run_flg = 0 GROUP BY src)
SELECT src, coalesce(updated, '-') AS updated, coalesce(deferred, '-') AS deferred FROM u FULL JOIN d USING (src)"""
    q["status_flags"] = events + " SELECT *, max(updt_on_last_run_flg) OVER (PARTITION BY src) AS max_flg FROM event_state"

    latest = ("CASE WHEN trx_creat_dtm IS NOT NULL AND audit_creat_dtm IS NOT NULL AND audit_chng_dtm IS NOT NULL"
              " THEN greatest(trx_creat_dtm, audit_creat_dtm, audit_chng_dtm) END")
    touched = ctes("invoice_txn") + f""",
touched AS (SELECT DISTINCT {_ym("ord_dt")} AS ord_mo_yr_id FROM invoice_txn
  WHERE aff_no IN (570, 30) AND trim(trx_sourc_cd) = '003' AND CAST({latest} AS DATE) = {day})"""
    q["months_to_reload"] = touched + " SELECT * FROM touched ORDER BY 1 DESC"
    q["months_to_reload_by_day"] = touched + " SELECT * FROM touched WHERE ord_mo_yr_id >= 202206 ORDER BY 1 DESC"

    # --- whole runs
    plans = conform_queries()
    q["daily_rebuild_state"] = f"""
WITH s0 AS (SELECT * FROM ({heads}{found(False)}{queued("pend_state")}) WHERE ord_mo_yr_id % 100 BETWEEN 1 AND 12)""" + after_run(
        "s0", fixed.SOURCE_TAGS) + f""",
mart AS (SELECT ord_mo_yr_id, count(*) AS n FROM ({plans["conform_all"]}) GROUP BY 1),
rebuilt AS (SELECT v.ord_mo_yr_id, coalesce(max(n), 0) AS row_count
            FROM view_v v LEFT JOIN mart m ON v.ord_mo_yr_id = m.ord_mo_yr_id GROUP BY 1)
SELECT l.*, r.row_count FROM left_over l LEFT JOIN rebuilt r ON l.ord_mo_yr_id = r.ord_mo_yr_id"""
    q["invoice_refresh_rows"] = f"""SELECT * FROM ({plans["invoice_earliest"]})
WHERE ord_mo_yr_id IN (SELECT ord_mo_yr_id FROM ({q["months_to_reload"]}))"""
    q["invoice_refresh_day"] = f"""SELECT * FROM ({plans["invoice_earliest"]})
WHERE ord_mo_yr_id IN (SELECT ord_mo_yr_id FROM ({q["months_to_reload_by_day"]}))"""
    q["invoice_refresh_night"] = f"""SELECT * REPLACE (CAST(atm_update_dt + INTERVAL '1' HOUR AS TIMESTAMP) AS atm_update_dt) FROM ({plans["invoice_earliest"]})
WHERE ord_mo_yr_id IN (SELECT ord_mo_yr_id FROM ({q["months_to_reload"]}))"""
    q["daily_run_state"] = f"""
WITH s0 AS (SELECT * FROM ({heads}{found(False)}{queued("pend_state")}) WHERE ord_mo_yr_id % 100 BETWEEN 1 AND 12)""" + after_run(
        "s0", fixed.SOURCE_TAGS, 2) + " SELECT * FROM left_over"
    q["control_overlap"] = events + view("event_state") + f""",
planned AS (SELECT src, src_mo_yr_id FROM ({stacked}) WHERE mnth_rnk <= {fixed.DAY_RUN_MONTHS} AND src_mo_yr_id > 0 AND src IN ('click', 'view', 'signup')),
marked AS (SELECT e.src, e.ord_mo_yr_id, CASE WHEN p.src IS NOT NULL THEN 1 ELSE updt_on_last_run_flg END AS f
           FROM event_state e LEFT JOIN planned p ON e.src = p.src AND e.ord_mo_yr_id = p.src_mo_yr_id)
SELECT src, ord_mo_yr_id, CAST(CASE WHEN f > 0 THEN f + 1 ELSE f END AS INTEGER) AS updt_on_last_run_flg, true AS refused, 3 AS version FROM marked"""
    q["history_load_twice"] = f"""
SELECT ord_mo_yr_id, count(*) AS n, count(DISTINCT ord_id) AS n_orders, count(*) AS written FROM ({plans["history_star"]})
WHERE ord_mo_yr_id BETWEEN {HISTORY_RANGE[0]} AND {HISTORY_RANGE[1]} GROUP BY 1"""
    return q


# --- operators -------------------------------------------------------------

def operator_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    groups = "CASE " + " ".join(f"WHEN nat * 10 IN ({_list(m)}) THEN '{g}'" for g, m in fixed.COUNTRY_GROUPS.items()) + f" ELSE '{fixed.OTHER_GROUP}' END"
    q["country_group_rollup"] = ctes("hd") + f"""
SELECT {groups} AS cntry_grp, count(*) AS n_orders, max({_ym("dt")}) AS newest_ym FROM hd GROUP BY 1"""
    q["role_playing_dims"] = ctes("lh") + """
SELECT a.n_name AS cust_nation, b.n_name AS supp_nation, count(*) AS n_lines, CAST(sum(qty) AS DOUBLE) AS sum_qty
FROM lh LEFT JOIN supplier s ON lh.supp = s.s_suppkey LEFT JOIN nation a ON lh.nat = a.n_nationkey
LEFT JOIN nation b ON s.s_nationkey = b.n_nationkey GROUP BY ALL"""
    q["lookup_with_default"] = ctes("src1_header", "src1_channel") + """
SELECT h.ord, h.intgrt_cntry_cd AS cc, h.ord_type, nullif(trim(h.ord_src), '') AS src_cd, coalesce(c.glbl_sales_chnl_cd, '-') AS glbl_sales_chnl_cd
FROM src1_header h LEFT JOIN src1_channel c ON h.intgrt_cntry_cd = c.cntry_cd AND h.ord_type = c.ord_type_cd
 AND nullif(trim(h.ord_src), '') = c.ord_src_cd"""
    q["value_from_row"] = ctes("h1") + """
SELECT ord, comb, reg, dt, cc, coalesce(max(CASE WHEN ord = comb THEN cc END) OVER (PARTITION BY reg, comb, dt), cc) AS first_cc FROM h1"""
    q["prorate"] = ctes("lh") + f""",
w AS (SELECT lh.ord, lh.ln, lh.price, hd.total, sum(lh.price) OVER (PARTITION BY lh.ord) AS t FROM lh JOIN hd ON lh.ord = hd.ord)
SELECT ord, ln, CAST(price AS DOUBLE) AS price, CAST(total AS DOUBLE) AS total, CAST({_share("price", "total", "t")} AS DOUBLE) AS share FROM w"""
    q["first_of_group"] = ctes("li") + """
SELECT ord, ln, CAST(qty AS DOUBLE) AS qty, supp % 3 AS grp,
       CAST(CASE WHEN min(ln) OVER (PARTITION BY ord, supp % 3) = ln THEN qty ELSE 0 END AS DOUBLE) AS kept_qty FROM li"""
    q["rank_in_group"] = """
SELECT l_orderkey, l_suppkey, l_partkey, rank() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_partkey) AS rnk FROM lineitem"""
    q["rank_in_hot_group"] = """
SELECT l_returnflag, l_orderkey, l_partkey, l_linenumber,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey) AS rnk FROM lineitem"""
    q["earliest_per_key"] = ctes("hd") + """
SELECT ord, cust, status, dt FROM (SELECT *, dense_rank() OVER (PARTITION BY cust, status ORDER BY dt) AS r FROM hd) WHERE r = 1"""
    q["rank_distinct_months"] = ctes("hd") + f"""
SELECT ord, {_ym("dt")} AS ym, CAST(dense_rank() OVER (ORDER BY {_ym("dt")} DESC) AS INTEGER) AS mnth_rnk FROM hd"""
    q["keep_last"] = ctes("hd") + """
SELECT cust, status AS last_status FROM (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY dt DESC, status DESC) AS r FROM hd) WHERE r = 1"""
    q["hypothetical_rank"] = ctes("source_map") + """
SELECT cntry_id, CAST(1 + count(DISTINCT CASE WHEN launch_mo_yr_id > 201602 THEN launch_mo_yr_id END) AS INTEGER) AS rank_desc,
       CAST(1 + count(DISTINCT CASE WHEN launch_mo_yr_id < 201602 THEN launch_mo_yr_id END) AS INTEGER) AS rank_asc
FROM source_map GROUP BY cntry_id"""
    q["listagg_other_order"] = """
SELECT n_regionkey, string_agg(n_nationkey::VARCHAR, ', ' ORDER BY n_name DESC) AS nations FROM nation GROUP BY n_regionkey"""
    q["pivot_latest"] = ctes("hd") + " SELECT reg, " + ", ".join(
        f"max(CASE WHEN status = '{s}' THEN {_ym('dt')} END) AS \"{s}\"" for s in "FOP"
    ) + " FROM hd GROUP BY reg"
    q["as_of_lookup"] = ctes("hd", "source_map") + f""",
best AS (
  SELECT h.ord, m.new_system_nm, row_number() OVER (PARTITION BY h.ord ORDER BY m.launch_mo_yr_id DESC, m.new_system_nm DESC) AS r
  FROM hd h JOIN source_map m ON h.nat = m.cntry_id AND m.launch_mo_yr_id <= {_ym("h.dt")})
SELECT h.ord, CAST(h.nat AS BIGINT) AS cntry, {_ym("h.dt")} AS ym, b.new_system_nm AS src
FROM hd h LEFT JOIN best b ON h.ord = b.ord AND b.r = 1"""
    q["split_rejects"] = ctes("src1_line") + """
SELECT ord, ord_ln, CASE WHEN regexp_full_match(trim(item), '[0-9]+') THEN CAST(CAST(trim(item) AS INTEGER) AS VARCHAR) ELSE trim(item) END AS code,
       CASE WHEN regexp_full_match(trim(item), '[0-9]+') THEN '' ELSE 'code is not int' END AS reject_reason FROM src1_line"""
    q["split_too_wide"] = ctes("invoice_txn") + """
SELECT orgnl_ref_txt, trx_sourc_cd, bns_cust_id, ord_dt,
       concat_ws('; ', CASE WHEN length(trx_sourc_cd) > 3 THEN 'trx_sourc_cd is longer than 3' END,
                 CASE WHEN length(orgnl_ref_txt) > 9 THEN 'orgnl_ref_txt is longer than 9' END) AS reject_reason FROM invoice_txn"""
    q["sql_functions"] = ctes("hd") + f"""
SELECT {_ym("dt")} AS ym, CAST(year(dt) * 12 + month(dt) AS INTEGER) AS ymm, {_ym("dt")} AS back,
       CAST(('0x' || substr(md5(status), 1, 15)) AS BIGINT) AS status_no, count(*) AS n FROM hd GROUP BY ALL"""
    q["line_quantities"] = ctes("src1_line") + f""",
st AS (SELECT ord, intgrt_cntry_cd AS cc, ref_ln, count(CASE WHEN ln_type = 'P' THEN NULL ELSE ord_ln END) AS p, count(*) AS n
       FROM src1_line WHERE ord_ln <> ref_ln GROUP BY ALL)
SELECT m.ord, m.ord_ln, {_code("coalesce(r.item, m.item)")} AS ord_item_cd, {_code("m.item")} AS shp_item_cd,
       CAST(CASE WHEN m.ln_type IN ('O', 'A', 'R') THEN m.item_qty ELSE 0 END AS DOUBLE) AS ord_qty,
       CAST(CASE WHEN m.item_type <> 'I' OR m.item_disp = 'S' OR (m.ord_ln = m.ref_ln AND (p > 0 OR coalesce(n, 0) = 0)
            AND m.item_disp IN ('E', 'S')) THEN 0 ELSE m.item_qty END AS DOUBLE) AS shp_qty
FROM src1_line m
LEFT JOIN src1_line r ON m.ord = r.ord AND m.ref_ln = r.ord_ln AND m.intgrt_cntry_cd = r.intgrt_cntry_cd
LEFT JOIN st ON m.ord = st.ord AND m.ord_ln = st.ref_ln AND m.intgrt_cntry_cd = st.cc"""
    q["order_fees"] = ctes("src3_fees") + f"""
SELECT sale_country_code, sales_order_id,
       CAST(sum(CAST(fee_amount AS DECIMAL(38,6))) - sum(coalesce(CAST(fee_tax_total_amount AS DECIMAL(38,6)), 0)) AS DOUBLE) AS fee_total,
       CAST(sum(CASE WHEN fee_code IN ({_list(fixed.ROUNDING_FEES)}) THEN 0
                     ELSE CAST(fee_amount AS DECIMAL(38,6)) - coalesce(CAST(fee_tax_total_amount AS DECIMAL(38,6)), 0) END) AS DOUBLE) AS delivery_fee
FROM src3_fees GROUP BY ALL"""
    q["month_filter"] = ctes("hd") + f" SELECT ord, dt FROM hd WHERE {_ym('dt')} IN (202012, 202101, 202103, 202208)"
    q["day_key_filter"] = ctes("src1_header") + """
SELECT ord, ord_dt, coalesce(nullif(trim(ctl_aff), ''), nullif(trim(intgrt_ctl_aff), '')) AS aff
FROM src1_header WHERE ord_dt // 100 BETWEEN 202106 AND 202109"""
    q["reload_roundtrip"] = ctes("hd") + f""",
kept AS (SELECT {_ym("dt")} AS ord_mo_yr_id, total FROM hd
         WHERE {_ym("dt")} <> 202104 AND ({_ym("dt")} <> 202103 OR status = 'F'))
SELECT ord_mo_yr_id, count(*) AS n, CAST(sum(total) AS DOUBLE) AS total,
       CASE WHEN ord_mo_yr_id = 202103 THEN count(*) END AS republished
FROM kept GROUP BY ord_mo_yr_id"""
    q |= publish_queries(groups)
    q["invoice_fan_out"] = ctes("src3_line", "src3_invoice") + f""",
i AS (SELECT sale_country_code, sales_order_id, CAST(order_line_id AS BIGINT) AS ln, count(*) AS n FROM src3_invoice GROUP BY ALL),
l AS (SELECT coalesce(n, 1) AS n, i.n AS found FROM src3_line s LEFT JOIN i ON s.sale_country_code = i.sale_country_code
      AND s.sales_order_id = i.sales_order_id AND CAST(s.order_line_id AS BIGINT) = i.ln WHERE s.affiliate_code IN ({_list(fixed.SRC3_AFFILIATES)}))
SELECT count(*) AS rows_before, CAST(sum(n) AS BIGINT) AS rows_after, coalesce(max(found), 0) AS greatest_fan_out FROM l"""
    q["role_one_pass"] = ctes("li") + """
SELECT ord, ln, CAST(li.part AS BIGINT) AS part, CAST(CASE WHEN ln % 3 > 0 THEN supp END AS BIGINT) AS other, li.part + 10000000 AS none,
       a.p_name AS name, a.p_size AS size, b.p_name AS other_name, c.p_size AS no_size
FROM li LEFT JOIN part a ON li.part = a.p_partkey LEFT JOIN part b ON ln % 3 > 0 AND li.supp = b.p_partkey
LEFT JOIN part c ON li.part + 10000000 = c.p_partkey"""
    q["as_of_starts"] = ctes("lh", "hd") + """,
s AS (SELECT nat, CAST(dt AS DATE) AS start, max(ord) AS last_ord FROM hd GROUP BY ALL)
SELECT p.ord, p.ln, s.last_ord FROM lh p ASOF LEFT JOIN s ON p.nat = s.nat AND CAST(p.dt AS DATE) >= s.start"""
    return q


def publish_queries(group_of: str) -> dict[str, str]:
    """What publishing leaves; ``group_of`` is the country group of ``nat * 10``."""
    q: dict[str, str] = {}
    rows = ctes("hd") + f""",
o AS (SELECT ord, status, total, nat * 10 AS cntry, {_ym("dt")} AS ord_mo_yr_id, {group_of} AS cntry_grp FROM hd)"""
    per_month = "SELECT '{0}' AS seen, ord_mo_yr_id, count(*) AS n, CAST(sum({1}) AS DOUBLE) AS total FROM o WHERE {2} GROUP BY ord_mo_yr_id"
    q["publish_exchange"] = rows + " " + " UNION ALL ".join([
        per_month.format("before", "total", "true"), per_month.format("old", "total", "true"),
        per_month.format("after", "CASE WHEN ord_mo_yr_id = 202103 THEN 2 * total ELSE total END",
                         "ord_mo_yr_id <> 202104 AND (ord_mo_yr_id <> 202103 OR status = 'F')")])
    q["publish_validated"] = rows + f""",
f AS (SELECT ord, ord_mo_yr_id, cntry_grp AS own, CASE WHEN ord % 97 = 0 THEN 'AFF_480' ELSE cntry_grp END AS cntry_grp FROM o),
w AS (SELECT *, nullif(concat_ws('; ', CASE WHEN ord_mo_yr_id NOT IN ({_list(SOME_MONTHS)}) THEN 'another month' END,
             CASE WHEN own <> cntry_grp THEN 'another country group' END), '') AS reject_reason FROM f)
SELECT ord, ord_mo_yr_id, cntry_grp, reject_reason, count(reject_reason) OVER () AS n_aside FROM w"""
    q["publish_counts"] = rows + """,
m AS (SELECT CAST(y * 100 + m AS INTEGER) AS ym FROM range(2016, 2023) a(y), range(1, 13) b(m) WHERE y * 100 + m <= 202208 OR y * 100 + m = 202212)
SELECT ym AS ord_mo_yr_id, count(ord) AS row_count, 1 AS of_run FROM m LEFT JOIN o ON ord_mo_yr_id = ym GROUP BY ym
UNION ALL
SELECT ym, count(ord), 2 FROM m LEFT JOIN o ON ord_mo_yr_id = ym AND status = 'F' WHERE ym IN (202103, 202104) GROUP BY ym"""
    q["view_refresh"] = rows + """
SELECT ord_mo_yr_id, status, count(*) AS n, CAST(sum(total) AS DOUBLE) AS total, count(DISTINCT cntry) AS n_countries,
       ord_mo_yr_id = 202103 OR ord_mo_yr_id >= 202206 AS refreshed
FROM o WHERE ord_mo_yr_id <> 202104 AND (ord_mo_yr_id <> 202103 OR status = 'F') GROUP BY ord_mo_yr_id, status"""
    q["month_statistics"] = rows + """,
p AS (SELECT * FROM o WHERE ord_mo_yr_id IN (202104, 202105, 202106, 202205, 202206, 202207))
SELECT 'ord_mo_yr_id=' || ord_mo_yr_id || '/cntry_grp=' || cntry_grp AS what, CAST(NULL AS DOUBLE) AS least, CAST(NULL AS DOUBLE) AS greatest, count(*) AS n
FROM p GROUP BY ALL
UNION ALL SELECT 'ord', min(ord), max(ord), 0 FROM p UNION ALL SELECT 'total', min(total), max(total), 0 FROM p"""
    q["tolerant_load"] = ctes("src1_line") + """,
c AS (SELECT ord, ord_ln, trim(item) AS given, TRY_CAST(trim(item) AS INTEGER) AS code FROM src1_line)
SELECT ord, ord_ln, code, CASE WHEN code IS NULL THEN given END AS code_given, CASE WHEN code IS NULL AND given IS NOT NULL THEN 'code is not int' END AS reject_reason,
       count(*) FILTER (code IS NOT NULL OR given IS NULL) OVER () AS n_good, count(*) FILTER (code IS NULL AND given IS NOT NULL) OVER () AS n_bad FROM c"""
    q["reload_staging"] = rows + " SELECT ord, status, CAST(total AS DOUBLE) AS total FROM o WHERE status = 'F'"
    return q


def scalar_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scalar_text"] = """
WITH p AS (SELECT *, '  ' || CASE WHEN p_size > 10 THEN p_name ELSE '' END || ' ' AS padded_name,
                  CASE WHEN p_size > 25 THEN p_brand END AS maybe FROM part)
SELECT p_partkey, nullif(trim(padded_name), '') AS trimmed, coalesce(nullif(trim(padded_name), ''), p_type) AS filled,
       coalesce(maybe, '') || p_type AS joined, left(p_name, 3) AS cut3, substr(p_name, 4) AS from4, right(p_brand, 2) AS last2,
       CAST(length(p_name) AS INTEGER) AS len, CAST(instr(p_name, 'e') AS INTEGER) AS pos_e,
       regexp_replace(p_type, '[B-Z]', 'A', 'g') AS classed, CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS BIGINT) AS digits,
       lpad(p_size::VARCHAR, 6, '0') AS padded, rpad(nullif(trim(padded_name), ''), 7, 'X') AS name7,
       CASE WHEN left(p_type, 3) = 'STA' THEN substr(p_type, 4) ELSE p_type END AS no_prefix,
       CAST(('0x' || substr(md5(rpad(p_name, 7, 'X')), 1, 15)) AS BIGINT) AS name_number,
       CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'ECONOMY' THEN 'E' ELSE '*' END AS recoded,
       CASE p_type WHEN 'SMALL' THEN 'S' END AS recoded_or_null,
       CASE WHEN maybe = 'Brand#2' THEN 'true' ELSE 'false' END AS flagged, '*' AS star, CAST(NULL AS VARCHAR) AS nothing
FROM p"""
    clock = "strptime(CAST(" + _day("dt") + " AS VARCHAR) || lpad(CAST(ord % 24 * 10000 + ord % 60 * 100 AS VARCHAR), 6, '0'), '%Y%m%d%H%M%S')"
    q["scalar_date"] = ctes("hd") + f"""
SELECT ord, {_day("dt")} AS dk, {_ym("dt")} AS ym, {_ym("dt")} AS ym_of_key, CASE WHEN status <> 'P' THEN date_trunc('day', dt) END AS day,
       {clock} AS clock, CAST(hour({clock}) AS INTEGER) AS hr, {_zone("dt + INTERVAL '20' HOUR")} AS shifted,
       CAST(year(dt) * 12 + month(dt) AS INTEGER) AS ymm, strftime(dt, '%Y%m') AS ym_text, strftime(dt, '%Y%m%d') AS day_text,
       CASE WHEN status <> 'P' THEN greatest(dt, upd) END AS latest
FROM hd"""
    q["scalar_number"] = ctes("li") + f"""
SELECT ord, ln, CAST(CAST(price AS DECIMAL(38,0)) AS BIGINT) AS rounded, CASE WHEN rf <> 'R' THEN CAST(ln AS BIGINT) END AS or_null,
       CAST(qty AS DOUBLE) AS money, round(CAST(price AS DOUBLE) / 7, 2) AS seventh,
       round(coalesce(CAST(tax AS DOUBLE) / nullif(CAST(price AS DOUBLE) - CAST(tax AS DOUBLE), 0), 0), 6) AS tax_rate,
       CAST(NULL AS DOUBLE) AS no_ratio, nullif(ln, 1) AS not_one,
       CAST(CASE WHEN rf <> 'N' THEN qty ELSE 0 END + tax AS DOUBLE) AS sum_or_zero,
       CASE WHEN ls = 'F' THEN greatest(ln, 3) END AS great, CAST({_share("price", "qty", "(tax + 1)")} AS DOUBLE) AS part,
       CAST(CAST(CAST(round(price * qty * 100) AS HUGEINT) / 100 AS DECIMAL(18,2)) AS DOUBLE) AS value
FROM li"""
    code = "substr(replace(p_name, ' ', ''), 1, 3) || (p_partkey % 100)::VARCHAR || upper(substr(p_type, 1, 2)) || p_size::VARCHAR || p_brand"
    q["item_base_codes"] = f"""
WITH c AS (SELECT p_partkey, {code} AS code FROM part)
SELECT p_partkey, code, {_base("code", width=15)} AS daily15, {_base("code")} AS daily, {_base("code", 4)} AS history FROM c"""
    q["ymm_roundtrip"] = ctes("hd") + f"""
SELECT {_ym("dt")} AS ym, count(*) AS n, CAST(year(dt) * 12 + month(dt) AS INTEGER) AS ymm, {_ym("dt")} AS back FROM hd GROUP BY ALL"""
    return q


def oracle_sql() -> dict[str, str]:
    return {**conform_queries(), **control_queries(), **operator_queries(), **scalar_queries()}
