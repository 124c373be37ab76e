"""Event validation and the five event marts."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import count_where, hours_between, row_count
from tidemark.operators.matching import fifo_match, keep_first


def event_time_parts(events: DataFrame) -> DataFrame:
    t = F.col("timestamp")
    return events.withColumns(
        {"event_date": F.to_date(t), "event_hour": F.hour(t), "event_month": F.date_format(t, "yyyy-MM")}
    )


def validate_events(
    events: DataFrame,
    *,
    tiebreak: tuple[str, ...] = ("user_id", "event_type"),
    raw: Observation | None = None,
    with_keys: Observation | None = None,
) -> DataFrame:
    """Events with both ids, the earliest row per event id, and date, hour and month.

    The observations, if given, receive the row counts before and after the null
    filter when the result is first written; no extra job runs for them. They lie before
    the shuffle, so they may count rows again where lost map output is rebuilt.
    """
    if raw is not None:
        events = events.observe(raw, row_count().alias("rows"))
    keyed = events.filter(F.col("event_id").isNotNull() & F.col("user_id").isNotNull())
    if with_keys is not None:
        keyed = keyed.observe(with_keys, row_count().alias("rows"))
    return event_time_parts(keep_first(keyed, ["event_id"], ["timestamp", *tiebreak]))


def _distinct(column: str | Column, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def project_activity_summary(events: DataFrame, *, approx: bool = False) -> DataFrame:
    """Activity per project; events without a project are left out."""
    kind = F.col("event_type")
    return events.filter(F.col("project_id").isNotNull()).groupBy("project_id").agg(
        row_count().alias("total_events"),
        count_where(kind == "escalation_raised").alias("escalation_count"),
        count_where(kind == "task_completed").alias("task_completions"),
        count_where(kind == "document_uploaded").alias("document_uploads"),
        F.max("timestamp").alias("last_event_timestamp"),
        _distinct("user_id", approx).alias("unique_users"),
        _distinct("event_type", approx).alias("unique_event_types"),
    )


def user_activity_summary(events: DataFrame, *, approx: bool = False) -> DataFrame:
    """Logins, actions, projects and active days per user."""
    kind = F.col("event_type")
    return events.groupBy("user_id").agg(
        count_where(kind == "login").alias("login_count"),
        count_where(kind == "logout").alias("logout_count"),
        count_where(~kind.isin("login", "logout")).alias("actions_taken"),
        _distinct("project_id", approx).alias("projects_touched"),
        F.min("timestamp").alias("first_active"),
        F.max("timestamp").alias("last_active"),
        _distinct("event_date", approx).alias("active_days"),
    )


def escalation_log(events: DataFrame, *, group: str = "project_id", slices: int | None = None) -> DataFrame:
    """One row per raised escalation with the resolution that closed it, first in first out.

    Matched within ``group``; events without one are left out.
    """
    raised = F.col("event_type") == "escalation_raised"
    opened = {
        "event_id": F.col("event_id"),
        "raised_by": F.col("user_id"),
        "raised_at": F.col("timestamp"),
        "severity": F.col("payload").getItem("severity"),
    }
    if group != "project_id":
        opened["project_id"] = F.col("project_id")
    matched = fifo_match(
        events, group=group, time="timestamp", event_id="event_id",
        opens=raised, closes=F.col("event_type") == "escalation_resolved",
        open_fields=opened,
        close_fields={
            "resolved_by": F.col("payload").getItem("resolved_by"),
            "resolved_at": F.col("timestamp"),
        },
        slices=slices,
    )
    return matched.select(
        "event_id", "project_id", "raised_by", "raised_at", "severity",
        F.col("resolved_at").isNotNull().alias("resolved"),
        "resolved_by", "resolved_at",
        hours_between(F.col("raised_at"), F.col("resolved_at")).alias("resolution_time_hours"),
    )


def daily_event_volume(events: DataFrame) -> DataFrame:
    """Events per date and type with the running count per type.

    The window runs over one row per date and type.
    """
    daily = events.groupBy("event_date", "event_type").agg(row_count().alias("event_count"))
    so_far = Window.partitionBy("event_type").orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative_count", F.sum("event_count").over(so_far))


def peak_usage_analysis(events: DataFrame, *, top: int = 20, approx: bool = False) -> DataFrame:
    """The busiest hours; equal totals are ordered by date and hour."""
    hourly = events.groupBy("event_date", "event_hour").agg(
        row_count().alias("total_events"),
        _distinct("user_id", approx).alias("unique_users"),
        _distinct("event_type", approx).alias("event_types_per_hour"),
    )
    return hourly.orderBy(F.desc("total_events"), "event_date", "event_hour").limit(top)


# How each mart is sorted when shown (``-`` is descending); nothing is sorted before a write.
DISPLAY_ORDER = {
    "project_activity_summary": ["-total_events", "project_id"],
    "user_activity_summary": ["-actions_taken", "user_id"],
    "daily_event_volume": ["event_date", "-event_count", "event_type"],
    "peak_usage_analysis": ["-total_events", "event_date", "event_hour"],
}


def show_order(name: str, mart: DataFrame) -> DataFrame:
    keys = DISPLAY_ORDER.get(name, [])
    return mart.orderBy(*[F.desc(k[1:]) if k[0] == "-" else F.asc(k) for k in keys]) if keys else mart


MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "project_activity_summary": project_activity_summary,
    "user_activity_summary": user_activity_summary,
    "escalation_log": escalation_log,
    "daily_event_volume": daily_event_volume,
    "peak_usage_analysis": peak_usage_analysis,
}


class StageTimes:
    """Wall time and rows of the stages of a run, rows counted by the writes themselves."""

    def __init__(self) -> None:
        self.stages: list[tuple[str, float, int]] = []

    def run(self, name: str, write: Callable[[], int]) -> int:
        started = time.perf_counter()
        rows = write()
        self.stages.append((name, time.perf_counter() - started, rows))
        return rows

    def lines(self, input_rows: int) -> list[str]:
        total = sum(seconds for _, seconds, _ in self.stages)
        rate = input_rows / total if total else 0.0
        return [f"{name}: {seconds:.2f} s, {rows} rows" for name, seconds, rows in self.stages] + [
            f"total: {total:.2f} s, {rate:.0f} events/s"
        ]
