"""Workflow-run reports, failure attribution and run summaries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from granary.functions import dates, messages, text
from granary.operators import aggregates, filters

TS = "date_created"


def runs_per_workspace(runs: DataFrame, workspaces: DataFrame, since: datetime) -> DataFrame:
    """Runs per workspace name; counted by id first, so the name join sees one row per workspace."""
    recent = filters.at_or_after(runs, TS, since)
    counts = aggregates.runs_per_group(recent, "workspace_id")
    named = counts.join(
        workspaces.select(F.col("id").alias("workspace_id"), F.col("full_name").alias("workspace")),
        "workspace_id",
    )
    return named.groupBy("workspace").agg(F.sum("total_runs").alias("total_runs"))


def workflow_share(runs: DataFrame, workspaces: DataFrame, since: datetime) -> DataFrame:
    """Runs per workspace and workflow, with the percentage of the workspace's runs."""
    recent = filters.at_or_after(runs, TS, since)
    counts = recent.groupBy("workspace_id", "project_name").agg(F.count(F.lit(1)).alias("runs"))
    totals = counts.groupBy("workspace_id").agg(F.sum("runs").alias("total_runs"))
    named = counts.join(totals, "workspace_id").join(
        workspaces.select(F.col("id").alias("workspace_id"), F.col("full_name").alias("workspace")),
        "workspace_id",
    )
    grouped = named.groupBy("workspace", F.col("project_name").alias("workflow"), "total_runs").agg(
        F.sum("runs").alias("runs")
    )
    share = F.try_divide(F.col("runs"), F.col("total_runs")) * 100
    return grouped.select("workspace", "workflow", "runs", share.alias("percentage"))


def mean_runs_per_month(runs: DataFrame, since: datetime, until: datetime) -> DataFrame:
    rows = filters.between(runs, TS, since, until)
    return aggregates.mean_runs(rows, dates.month_label(F.col(TS)), "month_avg_past_year")


def mean_runs_per_week(runs: DataFrame, since: datetime, until: datetime) -> DataFrame:
    rows = filters.between(runs, TS, since, until)
    return aggregates.mean_runs(rows, dates.year_week_label(F.col(TS)), "week_avg_past_year")


def run_reports(
    runs: DataFrame, workspaces: DataFrame, users: DataFrame, asof: datetime
) -> dict[str, DataFrame]:
    """The eight reports of the run database by name."""
    week = asof - timedelta(weeks=1)
    month = dates.month_before(asof)
    year = dates.years_before(asof, 1)
    return {
        "total_workflows_per_workspace_past_week": runs_per_workspace(runs, workspaces, week),
        "workflow_distribution_past_week": workflow_share(runs, workspaces, week),
        "avg_workflows_run_per_month": mean_runs_per_month(runs, year, asof),
        "avg_workflows_run_per_week": mean_runs_per_week(runs, year, asof),
        "run_status_breakdown_past_year": aggregates.breakdown(runs, "status", "status_count", year, asof),
        "workflow_breakdown_past_month": aggregates.breakdown(runs, "project_name", "runs", month, asof),
        "total_users": aggregates.users_total(users),
        "active_users_past_month": aggregates.users_active(runs, month, asof),
    }


def run_cube(runs: DataFrame, asof: datetime) -> DataFrame:
    """One pass over the runs from which all reports follow: counts per (workspace, project, status, day) and per user.

    The windows of the reports are conditional counts, so they may begin and end within a day.  The two kinds of rows
    are grouping sets of one aggregate: rows with ``of_user`` 0 have the first four keys, the others the user.
    """
    week, month, year = asof - timedelta(weeks=1), dates.month_before(asof), dates.years_before(asof, 1)
    rows = filters.at_or_after(runs, TS, min(week, month, year))
    closed = F.col("complete").isNotNull()

    def within(start: datetime, end: datetime | None = None):
        return filters.in_range(rows, TS, start, end)

    rows = rows.select(
        "workspace_id", "project_name", "status", "user_name", F.to_date(TS).alias("day"),
        within(week).alias("_week"), within(month, asof).alias("_month"), within(year, asof).alias("_year"), closed.alias("_closed"),
    )
    keys = [F.col(k) for k in ("workspace_id", "project_name", "status", "day")]
    cube = rows.groupingSets([keys, [F.col("user_name")]], *keys, F.col("user_name")).agg(
        F.grouping("day").cast("int").alias("of_user"),
        F.count_if("_week").alias("week"), F.count_if("_month").alias("month"), F.count_if("_year").alias("year"),
        F.count_if(F.col("_month") & F.col("_closed")).alias("closed_month"),
        F.count_if(F.col("_year") & F.col("_closed")).alias("closed_year"),
    )
    return cube


def reports_from_cube(cube: DataFrame, workspaces: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    """The eight reports of ``run_reports`` from the rows of ``run_cube``; none of them reads the runs again."""
    runs, people = cube.filter("of_user = 0"), cube.filter("of_user = 1")
    names = workspaces.select(F.col("id").alias("workspace_id"), F.col("full_name").alias("workspace"))

    def total(rows: DataFrame, n: str, keys: Sequence, name: str) -> DataFrame:
        return rows.filter(F.col(n) > 0).groupBy(*keys).agg(F.sum(n).alias(name))

    def share(column: str, n: str, name: str) -> DataFrame:
        counts = total(runs, n, [column], name)
        return aggregates.share_within(counts, name, digits=2).orderBy(F.desc("percentage"), F.asc(column))

    def mean(label, name: str) -> DataFrame:
        return total(runs, "year", [label.alias("_label")], "_n").agg(F.round(F.avg("_n"), 2).alias(name))

    weekly = total(runs, "week", ["workspace_id", "project_name"], "runs")
    sums = weekly.groupBy("workspace_id").agg(F.sum("runs").alias("total_runs"))
    # workspaces of one name are put together, as far as their totals agree
    named = weekly.join(sums, "workspace_id").join(names, "workspace_id")
    grouped = named.groupBy("workspace", F.col("project_name").alias("workflow"), "total_runs").agg(F.sum("runs").alias("runs"))
    return {
        "total_workflows_per_workspace_past_week": sums.join(names, "workspace_id").groupBy("workspace").agg(
            F.sum("total_runs").alias("total_runs")
        ),
        "workflow_distribution_past_week": grouped.select(
            "workspace", "workflow", "runs", (F.try_divide(F.col("runs"), F.col("total_runs")) * 100).alias("percentage")
        ),
        "avg_workflows_run_per_month": mean(dates.month_label(F.col("day")), "month_avg_past_year"),
        "avg_workflows_run_per_week": mean(dates.year_week_label(F.col("day")), "week_avg_past_year"),
        "run_status_breakdown_past_year": share("status", "closed_year", "status_count"),
        "workflow_breakdown_past_month": share("project_name", "closed_month", "runs"),
        "total_users": aggregates.users_total(users),
        "active_users_past_month": people.agg(
            F.count_if((F.col("month") > 0) & F.col("user_name").isNotNull()).alias("users_past_month")
        ),
    }


def failure_reasons(tasks: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """Failed tasks with the known reasons found in their log; the log is dropped."""
    return filters.failed(tasks).select(
        "task_id", "tag", text.found_reasons(F.col("execution_log"), reasons).alias("failure_reasons")
    )


def run_summaries(runs: DataFrame, run_url: str) -> DataFrame:
    """One message per finished run."""
    return runs.select("id", messages.run_summary(run_url).alias("message"))
