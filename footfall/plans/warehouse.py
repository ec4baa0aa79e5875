"""The warehouse build: raw -> detail -> daily summaries -> reports -> report files.

Tables live in the session catalog (``root=None``) or in folders below ``root``. Most reports
are computed from the summaries, which are far smaller than the detail; only the two that need
single events, or items within categories, read the detail itself.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall import operators as op
from footfall.operators.cleaning import DATE_END, DATE_START
from footfall.schemas import retention_columns
from footfall.sinks import create_databases, export_csv, save
from footfall.sources import load_raw, read_layer

log = logging.getLogger(__name__)

RAW_TABLE = "ods.user_behavior"
DETAIL_TABLE = "dwd.user_behavior_detail"
USER_DAYS = "dws.user_daily_behavior"
ITEM_DAYS = "dws.item_daily_behavior"
CATEGORY_DAYS = "dws.category_daily_behavior"
HOURS = "dws.hourly_behavior"
ACTIVITY = "dws.activity"

#: Each summary with the table it is computed from. The activity is written first: one pass over
#: the detail that the user-day and the hourly summary share.
SUMMARIES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    ACTIVITY: (DETAIL_TABLE, op.day_activity),
    USER_DAYS: (ACTIVITY, op.user_days),
    HOURS: (ACTIVITY, op.hourly_summary),
    ITEM_DAYS: (DETAIL_TABLE, lambda d: op.daily_summary(d, "item_id")),
    CATEGORY_DAYS: (DETAIL_TABLE, lambda d: op.daily_summary(d, "category_id")),
}


@dataclass(frozen=True)
class Report:
    """How a report is computed from stored tables, and how it is exported."""

    compute: Callable[..., DataFrame]
    reads: tuple[str, ...]
    order: tuple[str, ...] = ()
    long: bool = False
    schema: StructType | None = None


def reports(end: str = DATE_END, offsets: Sequence[int] = (1, 2, 3)) -> dict[str, Report]:
    """All reports, in an order in which each finds the tables it reads.

    ``offsets`` are the days after which retention is measured.
    """
    return {
        "ads.daily_pv_uv": Report(op.daily_pv_uv, (USER_DAYS, ITEM_DAYS)),
        "ads.hourly_distribution": Report(
            lambda hours, days: op.hourly_distribution(hours, op.active_hours(days)), (HOURS, ACTIVITY)
        ),
        "ads.behavior_funnel": Report(op.behavior_funnel, (USER_DAYS,)),
        "ads.top_items": Report(op.top_items, (ITEM_DAYS,)),
        "ads.top_categories": Report(op.top_categories, (CATEGORY_DAYS,)),
        "ads.weekday_vs_weekend": Report(op.weekday_vs_weekend, (USER_DAYS,)),
        "ads.retention": Report(
            lambda days: op.retention(days, offsets), (USER_DAYS,), schema=retention_columns(offsets)
        ),
        "ads.user_rfm": Report(
            lambda days: op.user_rfm(days, end), (USER_DAYS,), order=("user_id",), long=True
        ),
        "ads.rfm_summary": Report(op.rfm_summary, ("ads.user_rfm",)),
        "ads.user_path": Report(op.user_path, (DETAIL_TABLE,)),
        "ads.heatmap_hour_dow": Report(
            lambda hours, days: op.heatmap_hour_dow(hours, op.active_hours(days)), (HOURS, ACTIVITY)
        ),
        "ads.repurchase_distribution": Report(op.repurchase_distribution, (USER_DAYS,)),
        "ads.category_top_items": Report(
            lambda detail, days: op.category_top_items(detail, category_days=days),
            (DETAIL_TABLE, CATEGORY_DAYS),
        ),
    }


def build_raw(spark: SparkSession, csv_path: str, root: str | None = None) -> None:
    """Load the event CSV into the raw layer."""
    if root is None:
        create_databases(spark)
    events = load_raw(spark, csv_path)
    if op.has_rows(events):
        save(events, RAW_TABLE, root)
    else:
        log.error("no rows in %s", csv_path)


def build_detail(
    spark: SparkSession,
    root: str | None = None,
    start: str = DATE_START,
    end: str = DATE_END,
    tz: str = "Asia/Shanghai",
    replace_days_only: bool = False,
) -> DataFrame | None:
    """Clean the raw layer into the day-partitioned detail; returns the audit, one lazy row.

    With ``replace_days_only`` only the days from ``start`` to ``end`` are written again, and the
    audit then counts the events of just those days as final.
    """
    events = read_layer(spark, RAW_TABLE, root)
    if not op.has_rows(events):
        log.error("the raw layer is empty")
        return None
    save(op.clean(events, start, end, tz=tz), DETAIL_TABLE, root, replace_days_only)
    written = read_layer(spark, DETAIL_TABLE, root, start, end)
    return op.clean_audit(events, start, end, tz=tz, detail=written)


def build_summaries(spark: SparkSession, root: str | None = None) -> None:
    """Write the summary tables."""
    detail = read_layer(spark, DETAIL_TABLE, root)
    if not op.has_rows(detail):
        log.error("the detail layer is empty")
        return
    for name, (source, summarise) in SUMMARIES.items():
        save(summarise(read_layer(spark, source, root)), name, root)


def build_reports(
    spark: SparkSession,
    root: str | None = None,
    end: str = DATE_END,
    only: Iterable[str] | None = None,
    offsets: Sequence[int] = (1, 2, 3),
) -> list[str]:
    """Write the report tables; returns the names written, leaving out empty results."""
    wanted = set(only) if only is not None else None
    written = []
    for name, report in reports(end, offsets).items():
        if wanted is not None and name not in wanted:
            continue
        result = report.compute(*(read_layer(spark, table, root) for table in report.reads))
        save(result, name, root, schema=report.schema)
        if op.has_rows(read_layer(spark, name, root)):
            written.append(name)
        else:
            log.warning("%s is empty", name)
    return written


def export_reports(
    spark: SparkSession,
    out: str,
    root: str | None = None,
    names: Iterable[str] | None = None,
    head: int | None = None,
    offsets: Sequence[int] = (1, 2, 3),
) -> None:
    """Export whole report tables as CSV with a header, short ones as one file each.

    ``head`` cuts long tables (one row per user) to their first rows, which then fit in one file.
    """
    known = reports(offsets=offsets)
    for name in known if names is None else names:
        report = known[name]
        export_csv(
            read_layer(spark, name, root, schema=report.schema),
            f"{out.rstrip('/')}/{name.split('.')[1]}",
            head=head if report.long else None,
            order=report.order,
            single_file=not report.long or head is not None,
        )


def verify(spark: SparkSession, root: str | None = None) -> dict[str, DataFrame]:
    """The checks run after a build: row counts, profile, behaviours, rows per day."""
    raw, detail = (read_layer(spark, t, root) for t in (RAW_TABLE, DETAIL_TABLE))
    return {
        "raw": raw.agg(F.count("*").alias("row_count")),
        "detail": op.table_profile(detail),
        "behaviors": op.rows_per(detail, "behavior").orderBy(F.desc("cnt"), "behavior"),
        "days": op.rows_per(detail, "event_date").orderBy("event_date"),
    }


def build_all(
    spark: SparkSession,
    csv_path: str,
    root: str | None = None,
    start: str = DATE_START,
    end: str = DATE_END,
    tz: str = "Asia/Shanghai",
    offsets: Sequence[int] = (1, 2, 3),
) -> DataFrame | None:
    """Run every step on a raw CSV; returns the cleaning audit."""
    build_raw(spark, csv_path, root)
    audit = build_detail(spark, root, start, end, tz)
    build_summaries(spark, root)
    build_reports(spark, root, end, offsets=offsets)
    return audit
