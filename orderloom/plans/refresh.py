"""Runs that change a published table: daily rebuild, invoice, history and month-offset refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import as_months, counter_from_month, month_from_counter
from ..functions.text import try_to_long
from ..operators.joins import fan_out
from ..operators.pieces import Piece, gathered, in_turn, pieces_of
from ..operators.shape import stack, too_wide
from ..session import cut_lineage, drop_stored, release, stored
from ..sources.publish import GROUP, MONTH, Published, country_group, in_its_group, kept_aside, publish
from ..sources.schemas import INVOICE_WIDTHS, PENDING
from ..sources.state import change_state
from ..sources.views import refresh_view, register_table
from . import control
from .history import conform_history, history_months
from .invoices import extract_invoices, months_to_reload
from .source1 import conform_source1
from .source2 import conform_source2
from .source3 import conform_source3, order_rows
from .source4 import conform_source4

Sources = Mapping[str, DataFrame]
CONFORM = (conform_source1, conform_source2, conform_source3, conform_source4)
LINE_TABLES = dict(zip(CONFORM, ("src1_line", "src2_line", "src3_line", "src4_line")))


def _line_orders(plan: Callable[..., DataFrame]) -> dict[str, Column]:
    """Order numbers of the tables of lines, and of what belongs to lines, that a source's plan takes a piece of."""
    return {
        conform_source1: {"src1_line": F.col("ord")},
        conform_source2: {"src2_line": F.col("ord_no"), "invoices": try_to_long("invoice_cd")},
        conform_source3: dict.fromkeys(("src3_line", "src3_fulfilment", "src3_fees", "src3_invoice"), try_to_long("sales_order_id")),
        conform_source4: dict.fromkeys(("src4_line", "src4_consignment"), try_to_long("ord_no")),
    }[plan]


def conform_all(
    src: Sources, months: Iterable[int] | None, run_ts: dt.datetime, seen: Observation | None = None, piece: Piece | None = None,
    plans: Sequence[Callable[..., DataFrame]] = CONFORM, orders3: DataFrame | None = None,
) -> DataFrame:
    """Mart rows of all four sources; ``seen`` observes how source 3's invoices multiply its lines.

    Of a ``piece`` its rows only, of fewer ``plans`` theirs; ``orders3`` are source 3's stored orders.
    """
    third = {"seen": seen, "orders": orders3}
    return stack([plan(src, months, run_ts, piece=piece, **(third if plan is conform_source3 else {})) for plan in plans])


def conform_pieces(
    src: Sources, months: Iterable[int] | None, run_ts: dt.datetime, seen: list[Observation] | None = None,
    plans: Sequence[Callable[..., DataFrame]] = CONFORM,
) -> Iterator[DataFrame]:
    """The rows of ``conform_all`` in frames, each to be written before the next is asked for: large sources one by one, in pieces.

    What one frame shuffled is off the disk before the next is shuffled. Small sources are one frame. ``seen`` gets an observation a
    frame of source 3.
    """
    def observation(some) -> Observation | None:
        if seen is None or conform_source3 not in some:
            return None
        seen.append(Observation())
        return seen[-1]

    dealt = {plan: pieces_of(src[LINE_TABLES[plan]]) for plan in plans}
    if all(len(pieces) == 1 for pieces in dealt.values()):
        yield conform_all(src, months, run_ts, observation(plans), plans=plans)
        return
    for plan, pieces in dealt.items():
        spark = src[LINE_TABLES[plan]].sparkSession
        release(spark)
        orders3 = stored(order_rows(src, months), "orders3", "zstd") if plan is conform_source3 and len(pieces) > 1 else None
        for tables, piece in in_turn(src, _line_orders(plan), pieces):
            yield conform_all(tables, months, run_ts, observation((plan,)), piece, (plan,), orders3)
        if orders3 is not None:
            drop_stored(orders3)


def conform_stored(
    src: Sources, months: Iterable[int] | None, run_ts: dt.datetime, plans: Sequence[Callable[..., DataFrame]] = CONFORM
) -> DataFrame:
    """The rows of ``conform_all``; large sources are done in pieces first, whose rows are stored below the shared folder."""
    if all(len(pieces_of(src[LINE_TABLES[plan]])) == 1 for plan in plans):
        return conform_all(src, months, run_ts, plans=plans)
    return gathered(conform_pieces(src, months, run_ts, plans=plans), "mart_rows")


def grouped(df: DataFrame, country: str = "oper_cntry_id") -> DataFrame:
    return df.withColumn(GROUP, country_group(country))


@dataclass
class Run:
    """What one rebuild did: what it published, the new control state, the report, and changes under keys that are no month.

    ``fan_out`` says how source 3's invoices multiplied its lines.
    """

    months: tuple[int, ...]
    published: Published | None
    state: DataFrame
    report: DataFrame
    strange: DataFrame
    fan_out: dict[str, int] | None = None

    @property
    def counts(self) -> DataFrame | None:
        """Rows per month as the run wrote them."""
        return self.published and self.published.counts


def _rebuild(
    src: Sources, detected: DataFrame, path: str, run_ts: dt.datetime, day_months: int, most: int | None
) -> tuple[Published | None, tuple[int, ...], DataFrame, DataFrame, dict[str, int] | None]:
    """Rank, rebuild and publish the months that wait; also the view they were taken from and the pairs that are done."""
    view = control.pending_view(detected)
    plan = cut_lineage(control.plan_months(view, run_ts.hour, day_months=day_months, most=most))
    months = as_months(r[0] for r in plan.select("ord_mo_yr_id").distinct().collect()) or ()
    done = plan.filter(F.col("src_mo_yr_id") > 0).select("src", F.col("src_mo_yr_id").alias("ord_mo_yr_id"))
    if not months:
        return None, (), view, done, None
    seen: list[Observation] = []
    rows = (grouped(frame) for frame in conform_pieces(src, months, run_ts, seen))
    published = publish(rows, path, months, reason=in_its_group("oper_cntry_id"))
    return published, months, view, done, fan_out(*seen)


def daily_rebuild(
    src: Sources, state: DataFrame, path: str, run_ts: dt.datetime, day_months: int = fixed.DAY_RUN_MONTHS,
    most: int | None = None, floor: int = fixed.REOPEN_FLOOR,
) -> Run:
    """Detect, rank, rebuild, publish, mark done, report, purge; the control state is a frame, and so is the new one.

    Every published month is rebuilt from all four sources, so a source without changes
    keeps its rows. The control state is the only thing the driver looks at, and of that at
    most one row per rank and source. A night run rebuilds every pending month, a day run the
    newest ``day_months``; ``most`` bounds either. Changes before ``floor`` re-open nothing.
    """
    changed = control.changed_months(src, run_ts, floor)
    detected = cut_lineage(control.detect(state, control.real_months(changed)))
    published, months, view, done, fanned = _rebuild(src, detected, path, run_ts, day_months, most)
    marked = cut_lineage(control.mark_done(detected, done))
    final = control.purge(marked, view, run_ts.hour)
    return Run(months, published, cut_lineage(final), control.status_report(marked), control.strange_months(changed), fanned)


def daily_run(
    src: Sources, control_path: str, path: str, run_ts: dt.datetime, day_months: int = fixed.DAY_RUN_MONTHS,
    most: int | None = None, floor: int = fixed.REOPEN_FLOOR,
) -> Run:
    """The same with the control state in a versioned table that overlapping runs share.

    A run changes the state twice: it queues and ages before the dear work, and marks and purges after it, each time on the newest
    version. So neither of two overlapping runs loses what the other queued or marked.
    """
    spark = src["src1_header"].sparkSession
    changed = cut_lineage(control.real_months(control.changed_months(src, run_ts, floor)))
    _, detected = change_state(spark, control_path, PENDING, lambda held: control.detect(held, changed))
    published, months, view, done, fanned = _rebuild(src, detected, path, run_ts, day_months, most)
    _, marked = change_state(spark, control_path, PENDING, lambda held: control.mark_done(held, done))
    _, final = change_state(spark, control_path, PENDING, lambda held: control.purge(held, view, run_ts.hour))
    strange = control.strange_months(control.changed_months(src, run_ts, floor))
    return Run(months, published, final, control.status_report(marked), strange, fanned)


def invoice_refresh(
    src: Sources, path: str, run_ts: dt.datetime, reject_path: str | None = None, every_month: bool = False
) -> Published | None:
    """Reload the months with an invoice touched today, all in one job: a night run all of them, a day run the newest two months.

    With ``every_month`` a day run takes all of them too. With a ``reject_path``, rows whose texts exceed the declared widths go there with the
    reason and the load goes on without them; otherwise every row is loaded. The rows are made once.
    """
    found = months_to_reload(src["invoice_txn"], run_ts, every_month)
    months = as_months(r[0] for r in found.collect() if r[0] is not None)
    if not months:
        return None
    rows = grouped(extract_invoices(src, months, run_ts), "cntry_id")
    wide = None if reject_path is None else F.nullif(too_wide(INVOICE_WIDTHS), F.lit(""))
    done = publish(rows, path, months, reason=wide)
    if reject_path is not None:
        # Only what the write put aside is read again.
        kept_aside(rows.sparkSession, path, done.version).write.mode("overwrite").parquet(reject_path)
    return done


def history_load(
    src: Sources, path: str, run_ts: dt.datetime, months: Iterable[int] | None = None, append: bool = False, **kw
) -> Published:
    """Publish the history months to the mart in one step, a large history in pieces; a rerun replaces what it wrote.

    ``append`` adds to what the months hold instead, so a rerun of it adds the rows again.
    """
    months = history_months() if months is None else as_months(months)

    def rows() -> Iterator[DataFrame]:
        orders = {"hist_demand": F.col("ord_no"), "hist_detail": F.col("ord_no")}
        for tables, piece in in_turn(src, orders, pieces_of(src["hist_demand"])):
            yield grouped(conform_history(tables, months, run_ts, piece=piece, **kw))

    return publish(rows(), path, months, add=append)


@dataclass
class Offsets:
    """What a month-offset refresh did: the months it published, those its catalog table took up, its view's refresh."""

    published: Published
    registered: tuple[int, ...] | None = None
    view: Published | None = None


def refresh_offsets(
    build: Callable[[tuple[int, ...]], DataFrame], path: str, run_ts: dt.datetime, offsets: Iterable[int] = (2, 1),
    partition_cols: Iterable[str] = (MONTH,), table: str | None = None, columns: Iterable[str] = (),
    view: tuple[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> Offsets:
    """Rebuild the months that lie the given numbers of months before the run: publish them, then statistics, then the view.

    ``build`` makes the rows of a list of months; what it selects is the caller's. ``table`` names a catalog table over the
    published months, with statistics of its partitions and of ``columns``. ``view`` is a path and what makes a
    stored view's rows of the published ones.
    """
    now = counter_from_month(run_ts.year * 100 + run_ts.month)
    months = as_months(month_from_counter(now - o) for o in offsets)
    rows = build(months)
    done = Offsets(publish(rows, path, months, partition_cols))
    if table is not None:
        done.registered = register_table(rows.sparkSession, table, path, tuple(columns))
    if view is not None:
        done.view = refresh_view(rows.sparkSession, path, *view)
    return done
