"""Every registered query as a function of (spark, folder of the given tables)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed
from ..functions import dates, registry, text
from ..operators import groups, joins, ranks, shape
from ..plans import control, invoices, source1, source3, source_map
from ..plans.history import conform_history
from ..plans.refresh import CONFORM, conform_pieces, conform_stored, daily_rebuild, daily_run, history_load, invoice_refresh, refresh_offsets
from ..plans.source2 import conform_source2
from ..plans.source4 import conform_source4
from ..session import configure, working_path
from ..sources import publish, state, versions, views
from ..sources.schemas import INVOICES, PENDING
from .standins import RUN_TS, SOME_MONTHS, Standins

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which both engines hand over alike."""
    return df.selectExpr(*[
        f"CAST({f.name} AS DOUBLE) AS {f.name}" if isinstance(f.dataType, T.DecimalType) else f.name for f in df.schema
    ])


def registered(make: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
    """Register a query under its own name; it gets the tables and stand-ins as frames."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(make(Standins(configure(spark), sf_dir)))

    _REGISTRY[make.__name__] = run
    return make


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- plans -----------------------------------------------------------------

class _WithInvoices(dict):
    """Stand-ins with the invoice table that belongs to source 2's orders."""

    def __init__(self, tables: Standins):
        super().__init__()
        self.tables = tables

    def __missing__(self, name: str) -> DataFrame:
        return self.tables["invoices2" if name == "invoices" else name]


# At sf scale every month is conformed in one job; a run passes the months it rebuilds.
ALL_MONTHS = None
SOURCE_PLANS = ("conform_source1", "conform_source2", "conform_source3", "conform_source4")


def _register_plans() -> None:
    def in_pieces(*some):
        return lambda src, months, run_ts: conform_stored(src, months, run_ts, some)

    plans = {
        "conform_source1": source1.conform_source1, "conform_source2": conform_source2,
        "conform_source3": source3.conform_source3, "conform_source4": conform_source4,
        "conform_all": in_pieces(*CONFORM), "history_star": conform_history, "invoice_earliest": invoices.extract_invoices,
    }
    for name, plan in plans.items():
        def make(t, plan=in_pieces(plan) if name in SOURCE_PLANS else plan):
            return plan(_WithInvoices(t), ALL_MONTHS, RUN_TS)

        make.__name__ = name
        registered(make)

        if name in SOURCE_PLANS:
            def some(t, plan=plan):
                return plan(_WithInvoices(t), SOME_MONTHS, RUN_TS)

            some.__name__ = f"{name}_months"
            registered(some)


_register_plans()


# --- source map and control state ------------------------------------------

FOCUS_MONTHS = (201601, 201602, 201603, 201612, 202204)
EVENT_TAGS = ("click", "error", "purchase", "signup", "view")
LAST_EVENT_DAY = dt.date(2024, 1, 30)
DAY_HOUR, NIGHT_HOUR = 10, 22


@registered
def source_by_focus_month(t):
    """Countries and affiliates of the system in force at several months."""
    return source_map.sources_by_month(t["source_map"], FOCUS_MONTHS)


@registered
def pending_detect(t):
    """Months of the four sources with an order updated on the run's day, queued and aged."""
    return control.detect(t["pend_state"], control.changed_months(t, RUN_TS))


@registered
def pending_detect_follow_moves(t):
    """The same with the moving affiliates looked for where their orders are loaded from."""
    return control.changed_months(t, RUN_TS, follow_moves=True)


@registered
def pending_enqueue_events(t):
    """Days with an event on the last day against the days already queued, per event type."""
    last = t["events"].filter(control.changed_on("ts", LAST_EVENT_DAY))
    changed = last.select(F.col("event_type").alias("src"), dates.day_key("ts").alias("ord_mo_yr_id")).distinct()
    earlier = t["event_state"].filter(F.col("ord_mo_yr_id") < 20240130)
    return control.detect(earlier, changed)


def _view(t):
    return control.pending_view(t["event_state"], EVENT_TAGS)


@registered
def pending_pivot(t):
    """Pending days by event type, ranked."""
    return _view(t)


@registered
def plan_months(t):
    """What a day run rebuilds."""
    return control.plan_months(_view(t), DAY_HOUR, tags=EVENT_TAGS)


@registered
def plan_months_night(t):
    """What a night run rebuilds."""
    return control.plan_months(_view(t), NIGHT_HOUR, tags=EVENT_TAGS)


@registered
def months_wanted(t):
    """How many ranks a night run and a day run want."""
    return _view(t).agg(
        control.months_wanted(NIGHT_HOUR).alias("by_night"), control.months_wanted(DAY_HOUR).alias("by_day")
    )


@registered
def pending_age_mark_purge(t):
    """One night run over the state: age, mark the planned days done, forget old done days."""
    aged = control.age(t["event_state"])
    view = control.pending_view(aged, EVENT_TAGS)
    plan = control.plan_months(view, NIGHT_HOUR, tags=EVENT_TAGS).filter(F.col("src_mo_yr_id") > 0)
    marked = control.mark_done(aged, plan.selectExpr("src", "src_mo_yr_id AS ord_mo_yr_id"))
    return control.purge(marked, view, NIGHT_HOUR)


@registered
def status_report(t):
    """Done and deferred days per event type."""
    return control.status_report(t["event_state"])


@registered
def status_flags(t):
    """Flags beside the greatest flag of their source."""
    return groups.with_group(t["event_state"], ["src"], max_flg=F.max(control.FLAG))


@registered
def months_to_reload(t):
    """Months with an invoice stamped on the run's day, as a night run sees them."""
    return invoices.months_to_reload(t["invoice_txn"], RUN_TS.replace(hour=NIGHT_HOUR))


@registered
def months_to_reload_by_day(t):
    """The same as a day run sees them: this month and the one before."""
    return invoices.months_to_reload(t["invoice_txn"], RUN_TS.replace(hour=DAY_HOUR))


# --- operators -------------------------------------------------------------

@registered
def country_group_rollup(t):
    """Orders and newest month per country group."""
    numbered = t["hd"].withColumn("cntry", F.col("nat") * 10).withColumn("cntry_grp", publish.country_group("cntry"))
    return numbered.groupBy("cntry_grp").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max(dates.month_key("dt")).alias("newest_ym")
    )


@registered
def role_playing_dims(t):
    """Lines by customer and supplier country, one dimension in two roles."""
    lines = joins.match(t["lh"], t["supplier"].selectExpr("s_suppkey", "s_nationkey"), {"supp": "s_suppkey"})
    named = joins.role_join(lines, t["nation"], "n_nationkey", {
        "nat": {"n_name": "cust_nation"}, "s_nationkey": {"n_name": "supp_nation"},
    })
    return named.groupBy("cust_nation", "supp_nation").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("qty").alias("sum_qty")
    )


@registered
def lookup_with_default(t):
    """Channel of every order, or '-' where the channel table has none."""
    orders = t["src1_header"].select("ord", F.col("intgrt_cntry_cd").alias("cc"), "ord_type", text.first_filled("ord_src").alias("src_cd"))
    return joins.lookup(
        orders, t["src1_channel"], {"cc": "cntry_cd", "ord_type": "ord_type_cd", "src_cd": "ord_src_cd"},
        default={"glbl_sales_chnl_cd": "-"},
    )


@registered
def value_from_row(t):
    """Country of the first order of each combination, or the own one."""
    keyed = t["h1"].select("ord", "comb", "reg", "dt", "cc")
    return groups.value_from_row(keyed, ["reg", "comb", "dt"], F.col("ord") == F.col("comb"), "cc", "first_cc", fallback="cc")


@registered
def prorate(t):
    """Order totals split over their lines by price."""
    lines = joins.match(t["lh"].select("ord", "ln", "price"), t["hd"].select("ord", "total"), ["ord"], "inner")
    return groups.prorate(lines, ["ord"], "price", "total", "share")


@registered
def first_of_group(t):
    """Quantity kept on the first line of each order and part group."""
    lines = t["li"].select("ord", "ln", "qty", (F.col("supp") % 3).alias("grp"))
    return groups.first_of_group(lines, ["ord", "grp"], "ln", "qty", "kept_qty")


@registered
def rank_in_group(t):
    """Rank of every line item of its order by supplier and part; equal ones tie."""
    rows = t["lineitem"].select("l_orderkey", "l_suppkey", "l_partkey")
    return ranks.rank_in_group(rows, ["l_orderkey"], ["l_suppkey", "l_partkey"], "rnk", block=16)


@registered
def rank_in_hot_group(t):
    """Rank inside a few huge groups: line items by return flag, ordered by order and part."""
    rows = t["lineitem"].select("l_returnflag", "l_orderkey", "l_partkey", "l_linenumber")
    return ranks.rank_in_group(rows, ["l_returnflag"], ["l_orderkey", "l_partkey"], "rnk", block=512)


@registered
def earliest_per_key(t):
    """First orders of every customer and status, ties kept."""
    return groups.earliest_per_key(t["hd"].select("ord", "cust", "status", "dt"), ["cust", "status"], "dt")


@registered
def rank_distinct_months(t):
    """Orders with the rank of their month, newest first."""
    return ranks.rank_distinct(t["hd"].select("ord", dates.month_key("dt").alias("ym")), "ym", "mnth_rnk")


@registered
def keep_last(t):
    """Status of each customer's last order; the greater one on a tie."""
    return groups.keep_last(t["hd"], ["cust"], "dt", "status", "last_status")


@registered
def hypothetical_rank(t):
    """Dense rank that a month would take among the launches of each country, both ways."""
    args = (t["source_map"], ["cntry_id"], "launch_mo_yr_id", 201602)
    down = groups.hypothetical_dense_rank(*args, out="rank_desc")
    return joins.attach(down, groups.hypothetical_dense_rank(*args, out="rank_asc", descending=False), ["cntry_id"])


@registered
def listagg_other_order(t):
    """Nations of each region as text, ordered by name; and newest months of each status first."""
    return groups.listagg_by(t["nation"], ["n_regionkey"], "n_nationkey", order="n_name", descending=True, out="nations")


@registered
def pivot_latest(t):
    """Newest month of each region by status."""
    rows = t["hd"].select("reg", "status", dates.month_key("dt").alias("ym"))
    return groups.pivot_latest(rows, ["reg"], "status", ["F", "O", "P"], "ym")


@registered
def as_of_lookup(t):
    """System in force in each order's country at the order's month."""
    orders = t["hd"].select("ord", F.col("nat").cast("bigint").alias("cntry"), dates.month_key("dt").alias("ym"))
    return joins.as_of(orders, t["source_map"], {"cntry": "cntry_id"}, "ym", "launch_mo_yr_id", "new_system_nm", "src")


@registered
def split_rejects(t):
    """Item codes that are numbers, and the others with the reason."""
    codes = t["src1_line"].selectExpr("ord", "ord_ln", "trim(item) AS code")
    good, bad = shape.split_rejects(codes, {"code": "int"})
    return good.selectExpr("ord", "ord_ln", "CAST(code AS STRING) AS code", "'' AS reject_reason").unionByName(bad)


@registered
def split_too_wide(t):
    """Invoice texts that fit their declared widths, and the others with the reason."""
    rows = t["invoice_txn"].select("orgnl_ref_txt", "trx_sourc_cd", "bns_cust_id", "ord_dt")
    good, bad = shape.split_too_wide(rows, {"trx_sourc_cd": 3, "orgnl_ref_txt": 9})
    return good.withColumn("reject_reason", F.lit("")).unionByName(bad)


@registered
def sql_functions(t):
    """The mart's SQL functions in a query written as SQL text."""
    registry.register(t.spark)
    return t.spark.sql(
        "SELECT ym, ym2ymm(ym) AS ymm, ymm2ym(ym2ymm(ym)) AS back, str2int(status) AS status_no, count(*) AS n "
        "FROM (SELECT cast(year(dt) * 100 + month(dt) AS int) AS ym, status FROM {hd}) GROUP BY ym, status", hd=t["hd"],
    )


@registered
def line_quantities(t):
    """Ordered and shipped quantity of source 1 lines: self join, component counts, bundle rule."""
    lines = t["src1_line"].selectExpr("*", "CAST(intgrt_cntry_cd AS BIGINT) AS cntry_id", "0 AS ym")
    return source1.line_quantities(lines).select("ord", "ord_ln", "ord_item_cd", "shp_item_cd", "ord_qty", "shp_qty")


@registered
def order_fees(t):
    """Net fees per order, all and without rounding differences."""
    return source3.order_fees(t["src3_fees"])


@registered
def month_filter(t):
    """Orders of months with a gap, by range filters that reach the scan."""
    return t["hd"].filter(dates.in_months("dt", (202012, 202101, 202103, 202208))).select("ord", "dt")


@registered
def day_key_filter(t):
    """The same on an integer day key, with the run's affiliates before they moved."""
    kept = t["src1_header"].filter(dates.key_in_months("ord_dt", dates.month_range(202106, 202109)))
    return kept.select("ord", "ord_dt", text.first_filled("ctl_aff", "intgrt_ctl_aff").alias("aff"))


# --- scalar functions, one column each -------------------------------------

@registered
def scalar_text(t):
    name, seg = F.col("p_name"), F.col("p_type")
    padded = F.concat(F.lit("  "), F.when(F.col("p_size") > 10, name).otherwise(""), F.lit(" "))
    maybe = F.when(F.col("p_size") > 25, F.col("p_brand"))
    return t["part"].select(
        "p_partkey",
        text.blank_to_null(padded).alias("trimmed"),
        text.first_filled(padded, seg).alias("filled"),
        text.join_text(maybe, seg).alias("joined"),
        text.cut(name, 3).alias("cut3"),
        F.substr(name, F.lit(4)).alias("from4"),
        F.right(F.col("p_brand"), F.lit(2)).alias("last2"),
        F.length(name).alias("len"),
        F.instr(name, "e").alias("pos_e"),
        F.regexp_replace(F.col("p_type"), "[B-Z]", "A").alias("classed"),
        text.digits_to_long("p_brand").alias("digits"),
        text.pad_number("p_size", 6).alias("padded"),
        text.pad_name(padded, 7).alias("name7"),
        text.drop_prefix("p_type", "STA").alias("no_prefix"),
        text.text_number(text.pad_name(name, 7)).alias("name_number"),
        text.recode("p_type", {"SMALL": "S", "ECONOMY": "E"}, F.lit("*")).alias("recoded"),
        text.recode("p_type", {"SMALL": "S"}).alias("recoded_or_null"),
        text.flag(maybe == "Brand#2").alias("flagged"),
        F.lit("*").alias("star"),
        F.lit(None).cast("string").alias("nothing"),
    )


@registered
def scalar_date(t):
    o = t["hd"].withColumns({"dk": dates.day_key("dt"), "tm": (F.col("ord") % 24 * 10000 + F.col("ord") % 60 * 100).cast("int")})
    bad_day = F.when(F.col("status") == "P", F.lit(20210231)).otherwise(F.col("dk"))
    return o.select(
        "ord", "dk",
        dates.month_key("dt").alias("ym"),
        dates.month_of_day_key("dk").alias("ym_of_key"),
        dates.day_from_key(bad_day).alias("day"),
        dates.clock_from_key("dk", "tm").alias("clock"),
        F.hour(dates.clock_from_key("dk", "tm")).alias("hr"),
        dates.shift_zone(F.col("dt") + F.expr("interval 20 hour"), fixed.SRC2_ZONE, fixed.MART_ZONE_SRC2).alias("shifted"),
        dates.ym2ymm(dates.month_key("dt")).alias("ymm"),
        F.date_format("dt", "yyyyMM").alias("ym_text"),
        F.date_format("dt", "yyyyMMdd").alias("day_text"),
        text.greatest_or_null(F.when(F.col("status") != "P", F.col("dt")), "upd").alias("latest"),
    )


@registered
def scalar_number(t):
    qty, price, tax = F.col("qty"), F.col("price"), F.col("tax")
    return t["li"].select(
        "ord", "ln",
        text.to_long(F.col("price").cast("string")).alias("rounded"),
        text.try_to_long(F.when(F.col("rf") == "R", "x1").otherwise(F.col("ln").cast("string"))).alias("or_null"),
        text.to_money(qty).alias("money"),
        F.round(price.cast("double") / 7, 2).alias("seventh"),
        F.round(text.ratio(tax.cast("double"), price.cast("double") - tax.cast("double"), 0.0), 6).alias("tax_rate"),
        text.ratio(qty.cast("double"), F.lit(0.0)).alias("no_ratio"),
        F.nullif(F.col("ln"), F.lit(1)).alias("not_one"),
        (F.coalesce(F.when(F.col("rf") != "N", qty), F.lit(0)) + tax).alias("sum_or_zero"),
        text.greatest_or_null(F.col("ln"), F.when(F.col("ls") == "F", F.lit(3))).alias("great"),
        text.share_of(price, qty, tax + 1).alias("part"),
        (F.col("price") * F.col("qty")).cast("decimal(18,2)").alias("value"),
    )


@registered
def item_base_codes(t):
    """Base item codes in the three forms."""
    codes = F.concat(F.substring(F.regexp_replace("p_name", " ", ""), 1, 3), (F.col("p_partkey") % 100).cast("string"),
                     F.upper(F.substring("p_type", 1, 2)), F.col("p_size").cast("string"), F.col("p_brand"))
    return t["part"].select("p_partkey", codes.alias("code")).select(
        "*",
        text.base_item_code("code", width=15).alias("daily15"),
        text.base_item_code("code").alias("daily"),
        text.base_item_code("code", test_from=4).alias("history"),
    )


@registered
def ymm_roundtrip(t):
    """Month keys as counters and back, with orders per month."""
    counted = t["hd"].groupBy(dates.month_key("dt").alias("ym")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("ym", "n", dates.ym2ymm("ym").alias("ymm"), dates.ymm2ym(dates.ym2ymm("ym")).alias("back"))


# --- publishing ------------------------------------------------------------

def _orders_by_month(t) -> DataFrame:
    return t["hd"].selectExpr("ord", "status", "CAST(total AS DECIMAL(18, 2)) AS total", "nat * 10 AS cntry", "dt").select(
        "ord", "status", "total", "cntry", dates.month_key("dt").alias("ord_mo_yr_id"), publish.country_group("cntry").alias("cntry_grp"))


EVERY_MONTH = dates.month_range(201601, 202208)
AGAIN = (202103, 202104)


def _per_month(df: DataFrame, tag: str) -> DataFrame:
    return df.groupBy("ord_mo_yr_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total")).select(F.lit(tag).alias("seen"), "*")


@registered
def reload_roundtrip(t):
    """Publish every month, republish two with fewer rows or none, read the table back."""
    rows = t["hd"].selectExpr("status", "total", "dt").withColumn("ord_mo_yr_id", dates.month_key("dt")).drop("dt")
    path, by_month = working_path(t.spark, "reload"), ("ord_mo_yr_id",)
    publish.publish(rows, path, EVERY_MONTH, by_month)
    again = rows.filter((F.col("ord_mo_yr_id") == 202103) & (F.col("status") == "F"))
    counts = publish.publish(again, path, AGAIN, by_month).counts
    stored = publish.read_table(t.spark, path).groupBy("ord_mo_yr_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total")
    )
    written = counts.select(F.col("ord_mo_yr_id").alias("w_ym"), F.col("row_count").alias("republished"))
    return joins.lookup(stored, written, {"ord_mo_yr_id": "w_ym"})


@registered
def publish_exchange(t):
    """What readers see: before an exchange of two months, while its rows are written but not yet in, after it, and of the old version."""
    rows, path, by_month = _orders_by_month(t), working_path(t.spark, "exchange"), ("ord_mo_yr_id",)
    first = publish.publish(rows, path, EVERY_MONTH, by_month)
    again = rows.filter((F.col("ord_mo_yr_id") == AGAIN[0]) & (F.col("status") == "F")).withColumn("total", (F.col("total") * 2).cast("decimal(18,2)"))
    # A run that died: its rows are all there, its manifest is not.
    publish.deal(again.withColumn(publish.REASON, F.lit(None).cast("string")), path, by_month, "died")
    seen = [_per_month(publish.read_table(t.spark, path), "before")]
    publish.publish(again, path, AGAIN, by_month)
    seen += [_per_month(publish.read_table(t.spark, path), "after"), _per_month(publish.read_table(t.spark, path, first.version), "old")]
    return shape.stack(seen)


@registered
def publish_validated(t):
    """Rows an exchange does not take: of another month, or filed under another country group; with what it took."""
    rows, path = _orders_by_month(t), working_path(t.spark, "validated")
    misfiled = rows.withColumn("cntry_grp", F.when(F.col("ord") % 97 == 0, F.lit("AFF_480")).otherwise(F.col("cntry_grp")))
    done = publish.publish(misfiled, path, SOME_MONTHS, reason=publish.in_its_group("cntry"))
    kept = publish.read_table(t.spark, path).withColumn("reject_reason", F.lit(None).cast("string"))
    both = kept.unionByName(publish.kept_aside(t.spark, path, done.version))
    return both.select("ord", "ord_mo_yr_id", "cntry_grp", "reject_reason", F.lit(done.aside).cast("bigint").alias("n_aside"))


@registered
def publish_counts(t):
    """Rows per month that a run wrote, asked for after a later run replaced some of them."""
    rows, path, by_month = _orders_by_month(t), working_path(t.spark, "counts"), ("ord_mo_yr_id",)
    first = publish.publish(rows, path, (*EVERY_MONTH, 202212), by_month)
    later = publish.publish(rows.filter(F.col("ord_mo_yr_id").isin(*AGAIN) & (F.col("status") == "F")), path, AGAIN, by_month)
    then = publish.month_counts(t.spark, path, first.version).withColumn("of_run", F.lit(1))
    return then.unionByName(publish.month_counts(t.spark, path, later.version).withColumn("of_run", F.lit(2)))


def _month_view(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ord_mo_yr_id", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"), F.countDistinct("cntry").alias("n_countries"))


@registered
def view_refresh(t):
    """A stored view after months were replaced, emptied and added, brought up to date from these months alone."""
    rows, path, view = _orders_by_month(t), working_path(t.spark, "base"), working_path(t.spark, "view")
    by_month = ("ord_mo_yr_id",)
    publish.publish(rows.filter("ord_mo_yr_id < 202206"), path, EVERY_MONTH, by_month)
    views.refresh_view(t.spark, path, view, _month_view)
    publish.publish(rows.filter((F.col("ord_mo_yr_id") == AGAIN[0]) & (F.col("status") == "F")), path, AGAIN, by_month)
    publish.publish(rows.filter("ord_mo_yr_id >= 202206"), path, dates.month_range(202206, 202208), by_month)
    done = views.refresh_view(t.spark, path, view, _month_view)
    fresh = done.counts.select(F.col("ord_mo_yr_id").alias("r_ym"), F.lit(True).alias("refreshed"))
    return joins.lookup(publish.read_table(t.spark, view), fresh, {"ord_mo_yr_id": "r_ym"}, default={"refreshed": False})


@registered
def month_statistics(t):
    """The month-offset refresh up to its statistics: rows of each partition and bounds of columns, as the catalog tells them."""
    rows, path, name = _orders_by_month(t), working_path(t.spark, "offsets"), f"offsets_{uuid.uuid4().hex}"

    def build(months):
        return rows.filter(F.col("ord_mo_yr_id").isin(*months))

    try:
        for ts in (RUN_TS, RUN_TS + dt.timedelta(days=7)):
            refresh_offsets(build, path, ts, offsets=(14, 15, 2, 1), partition_cols=("ord_mo_yr_id", "cntry_grp"), table=name,
                            columns=("ord", "total"))
        parts = views.partition_rows(t.spark, name).selectExpr("`partition` AS what", "CAST(NULL AS DOUBLE) AS least", "CAST(NULL AS DOUBLE) AS greatest", "row_count AS n")
        bounds = views.column_bounds(t.spark, name, ("ord", "total")).selectExpr(
            "`column` AS what", "CAST(least AS DOUBLE) AS least", "CAST(greatest AS DOUBLE) AS greatest", "missing AS n")
        return parts.unionByName(bounds)
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")


@registered
def tolerant_load(t):
    """Item codes loaded as numbers and those that are none, dealt in one pass, with both counts."""
    codes = t["src1_line"].selectExpr("ord", "ord_ln", "trim(item) AS code")
    good, bad = working_path(t.spark, "good"), working_path(t.spark, "bad")
    n_good, n_bad = publish.tolerant_load(codes, {"code": "int"}, good, bad)
    both = t.spark.read.parquet(good).unionByName(t.spark.read.parquet(bad))
    return both.withColumns({"n_good": F.lit(n_good).cast("bigint"), "n_bad": F.lit(n_bad).cast("bigint")})


@registered
def reload_staging(t):
    """A staging table truncated and reloaded: only the second load's rows are left."""
    rows, path = _orders_by_month(t), working_path(t.spark, "staging")
    publish.replace_table(rows, path)
    publish.replace_table(rows.filter("status = 'F'"), path)
    return t.spark.read.parquet(path).select("ord", "status", "total")


@registered
def control_overlap(t):
    """Control state after two runs that started from one version: the one that was late is refused and repeats on the other's."""
    path, schema = working_path(t.spark, "control"), PENDING
    seen = t["event_state"].select("src", "ord_mo_yr_id", "updt_on_last_run_flg")
    state.change_state(t.spark, path, schema, lambda held: shape.conform(seen, schema))
    late_version, late = state.read_state(t.spark, path, schema)
    view = control.pending_view(late, EVENT_TAGS)
    planned = control.plan_months(view, DAY_HOUR, tags=EVENT_TAGS).filter(F.col("src_mo_yr_id") > 0)
    mine = planned.selectExpr("src", "src_mo_yr_id AS ord_mo_yr_id")
    state.change_state(t.spark, path, schema, lambda held: control.mark_done(held, mine.filter("src IN ('click', 'view')")))

    def step(held):
        return control.age(control.mark_done(held, mine.filter("src = 'signup'")))

    try:
        state.write_state(step(late), path, late_version)
        refused = False
    except versions.Taken:
        refused = True
    version, final = state.change_state(t.spark, path, schema, step)
    return final.withColumns({"refused": F.lit(refused), "version": F.lit(version)})


@registered
def invoice_fan_out(t):
    """How the invoices of source 3 multiply its lines, counted while the plan runs."""
    seen = []
    for rows in conform_pieces(_WithInvoices(t), ALL_MONTHS, RUN_TS, seen, (source3.conform_source3,)):
        rows.write.format("noop").mode("overwrite").save()
    names, counted = ("rows_before", "rows_after", "greatest_fan_out"), joins.fan_out(*seen)
    return t.spark.createDataFrame([tuple(counted[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@registered
def role_one_pass(t):
    """Parts looked up in two roles and a missing one, with the dimension joined once."""
    lines = t["li"].selectExpr("ord", "ln", "CAST(part AS BIGINT) AS part", "CAST(CASE WHEN ln % 3 > 0 THEN supp END AS BIGINT) AS other", "part + 10000000 AS none")
    dim = t["part"].selectExpr("CAST(p_partkey AS BIGINT) AS p_partkey", "p_name", "p_size")
    return joins.role_join(lines, dim, "p_partkey", {
        "part": {"p_name": "name", "p_size": "size"}, "other": {"p_name": "other_name"}, "none": {"p_size": "no_size"}}, one_pass=True)


@registered
def as_of_starts(t):
    """For each line the status of the last order that its customer's nation placed up to the line's order day: many starts a key."""
    points = t["lh"].select("ord", "ln", "nat", F.to_date("dt").alias("day"))
    starts = t["hd"].select("nat", F.to_date("dt").alias("start"), F.col("ord").alias("start_ord"))
    return joins.as_of(points, starts, ["nat"], "day", "start", "start_ord", "last_ord", block=64).select("ord", "ln", "last_ord")


@registered
def invoice_refresh_day(t):
    """The invoice run by day, which takes the months touched of the newest two."""
    path = working_path(t.spark, "invoices")
    if invoice_refresh(t, path, RUN_TS) is None:
        return t.spark.createDataFrame([], INVOICES)
    return publish.read_published(t.spark, path, INVOICES).drop(publish.GROUP)


@registered
def invoice_refresh_night(t):
    """The invoice run at night, which takes every month touched, whatever its age."""
    path = working_path(t.spark, "invoices")
    if invoice_refresh(t, path, RUN_TS.replace(hour=NIGHT_HOUR)) is None:
        return t.spark.createDataFrame([], INVOICES)
    return publish.read_published(t.spark, path, INVOICES).drop(publish.GROUP)


@registered
def daily_run_state(t):
    """A night run whose control state is a versioned table: the state it leaves, after the state of a run before it."""
    path, mart = working_path(t.spark, "control"), working_path(t.spark, "mart")
    state.change_state(t.spark, path, PENDING, lambda held: shape.conform(t["pend_state"], PENDING))
    run = daily_run(_WithInvoices(t), path, mart, RUN_TS.replace(hour=NIGHT_HOUR), most=2)
    return run.state


@registered
def daily_rebuild_state(t):
    """A whole night run over the four sources: the control state it leaves, with the rows published for each month."""
    run = daily_rebuild(_WithInvoices(t), t["pend_state"], working_path(t.spark, "mart"), RUN_TS.replace(hour=NIGHT_HOUR))
    if run.counts is None:
        return run.state.withColumn("row_count", F.lit(None).cast("bigint"))
    return joins.lookup(run.state, run.counts.withColumnRenamed("ord_mo_yr_id", "p_ym"), {"ord_mo_yr_id": "p_ym"})


@registered
def invoice_refresh_rows(t):
    """The invoice run: months touched on the run's day, published and read back."""
    path = working_path(t.spark, "invoices")
    if invoice_refresh(t, path, RUN_TS, every_month=True) is None:
        return t.spark.createDataFrame([], INVOICES)
    return publish.read_published(t.spark, path, INVOICES).drop(publish.GROUP)


@registered
def history_load_twice(t):
    """The history load, repeated: rows and orders of each month, and the rows the second load wrote."""
    path = working_path(t.spark, "history")
    history_load(t, path, RUN_TS)
    counts = history_load(t, path, RUN_TS).counts
    stored = publish.read_table(t.spark, path).groupBy("ord_mo_yr_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("ord_id").alias("n_orders")
    )
    written = counts.select(F.col("ord_mo_yr_id").alias("w_ym"), F.col("row_count").alias("written"))
    return joins.lookup(stored, written, {"ord_mo_yr_id": "w_ym"})
