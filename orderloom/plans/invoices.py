"""Invoice extract: the earliest transaction of each invoice, and the months to reload."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import Months, day_start, in_months, month_key, previous_month
from ..functions.text import blank_to_null, cut, to_long
from ..operators.groups import earliest_per_key
from ..operators.joins import match
from ..operators.shape import conform
from ..sources.schemas import INVOICE_WIDTHS, INVOICES


def _order_invoices(txn: DataFrame) -> DataFrame:
    return txn.filter(
        F.col("aff_no").isin(*fixed.INVOICE_AFFILIATES) & (F.trim("trx_sourc_cd") == fixed.INVOICE_TRX_SOURCE)
    )


def extract_invoices(src: Mapping[str, DataFrame], months: Months, run_ts: dt.datetime) -> DataFrame:
    """Invoice rows of the months. Reads invoice_txn, invoice_customer.

    Within a month the earliest transactions of an invoice and customer count, all of them
    if several share the day; rows equal after the invoice's text is cut to its width then fold to one.
    """
    month = month_key("ord_dt")
    txn = (
        _order_invoices(src["invoice_txn"])
        .filter(in_months("ord_dt", months) & F.col("orgnl_ref_txt").isNotNull() & F.col("ord_dt").isNotNull())
        .withColumn("ym", month)
    )
    first = earliest_per_key(txn, ["ym", "bus_entty_no", "orgnl_ref_txt", "bns_cust_id"], "ord_dt")
    customers = (
        src["invoice_customer"].filter(F.col("aff_no").isin(*fixed.INVOICE_AFFILIATES))
        .select(F.col("bns_cust_id").alias("c_id"), to_long("ibo_no").alias("vol_account_id"))
    )
    named = match(first, customers, {"bns_cust_id": "c_id"}, "left")
    folded = named.groupBy(
        F.col("aff_no").alias("aff_id"), "trx_sourc_cd", F.col("bus_entty_no").alias("cntry_id"), "ord_dt",
        "vol_account_id", cut("orgnl_ref_txt", INVOICE_WIDTHS["invoice_cd"]).alias("invoice_cd"),
        F.col("ym").alias("ord_mo_yr_id"),
    ).agg(
        F.coalesce(F.min(to_long("orgnl_ord_no")), F.lit(0)).alias("org_ord_id"),
        F.coalesce(F.min(blank_to_null("ord_bus_natr_cd")), F.lit("1")).alias("ord_bus_natr_cd"),
    )
    return conform(folded.withColumn("atm_update_dt", F.lit(run_ts).cast("timestamp_ntz")), INVOICES)


def recent_enough(ym: Column, run_ts: dt.datetime) -> Column:
    """Day runs reload the run's month and the one before; night runs any month."""
    if run_ts.hour in fixed.NIGHT_HOURS:
        return F.lit(True)
    return ym >= previous_month(run_ts.year * 100 + run_ts.month)


def months_to_reload(txn: DataFrame, run_ts: dt.datetime, every_month: bool = False) -> DataFrame:
    """Months with an invoice whose latest stamp is of the run's day, newest first.

    An invoice that lacks one of its three stamps has no latest stamp. A day run leaves old months to the night, unless it is
    to take ``every_month``.
    """
    stamps = ("trx_creat_dtm", "audit_creat_dtm", "audit_chng_dtm")
    today = run_ts.date()
    # The latest of three stamps is of the day: none is missing or later, and one is of it. As ranges these reach the scan.
    none_later = reduce(and_, [F.col(s) < day_start(today + dt.timedelta(days=1)) for s in stamps])
    one_today = reduce(or_, [F.col(s) >= day_start(today) for s in stamps])
    touched = (
        _order_invoices(txn)
        .filter(none_later & one_today)
        .select(month_key("ord_dt").alias("ord_mo_yr_id"))
        .distinct()
    )
    wanted = touched if every_month else touched.filter(recent_enough(F.col("ord_mo_yr_id"), run_ts))
    return wanted.orderBy(F.desc("ord_mo_yr_id"))
