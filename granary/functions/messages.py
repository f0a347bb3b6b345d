"""Report lines.  One row is one line; only bounded top lists become one text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from granary.functions import dates, text

NOTHING_FOUND = "Nothing to be found."


def link(url: Column, label: Column) -> Column:
    return F.concat(F.lit("<"), url, F.lit("|"), label, F.lit(">"))


def leaderboard_line(rank: Column, entity_url: str) -> Column:
    """One ranked line of a download leaderboard; groups also show their coverage."""
    coverage = F.when(
        F.coalesce(F.col("total_projects"), F.lit(0)) > 0,
        F.concat(
            F.lit(" ("), F.col("projects_with_downloads").cast("string"), F.lit("/"),
            F.col("total_projects").cast("string"), F.lit(" projects with downloads)"),
        ),
    ).otherwise(F.lit(""))
    return F.concat(
        rank.cast("string"), F.lit(". "),
        link(F.concat(F.lit(entity_url), F.col("project")), F.col("name")),
        F.lit(" - "), F.col("downloads_per_project").cast("string"), F.lit(" downloads, "),
        F.col("number_of_unique_users_downloaded").cast("string"), F.lit(" unique users, "),
        text.size_text(F.col("data_download_size")), F.lit(" egressed"), coverage,
    )


def entity_line(rank: Column, entity_url: str, profile_url: str) -> Column:
    """One line about a newly created entity."""
    kind = F.when(
        F.coalesce(F.col("content_type"), F.lit("")) != "", F.col("content_type")
    ).otherwise(F.col("node_type"))
    entity = link(
        F.concat(F.lit(entity_url), text.prefixed_id(F.col("id"))),
        F.concat(F.lit("*"), F.col("name"), F.lit("*")),
    )
    author = link(
        F.concat(F.lit(profile_url), F.col("created_by").cast("string"), F.lit("/profile")),
        F.coalesce(F.col("user_name_full_name"), F.lit("None")),
    )
    return F.concat(
        rank.cast("string"), F.lit(". "), entity, F.lit(" (Type: "), kind,
        F.lit(", Created on: "), F.date_format("created_on", "yyyy-MM-dd"),
        F.lit(", Created by: "), author, F.lit(", Public: "),
        F.when(F.col("is_public"), F.lit("True")).otherwise(F.lit("False")), F.lit(")"),
    )


# The item fields shown for review, in the order they are shown.
REVIEW_FIELDS = [
    "title", "creator", "keywords", "subject", "collection",
    "publisher", "species", "url", "description",
]


def review_line(rank: Column, label: str = "Identifier", fields: list[str] | None = None) -> Column:
    """One line about a catalogue item that a person has to look at."""
    parts = [rank.cast("string"), F.lit(f". {label}: "), F.coalesce(F.col("sameAs"), F.lit("None"))]
    for field in REVIEW_FIELDS if fields is None else fields:
        parts += [F.lit(f", {field}: "), F.coalesce(F.col(field).cast("string"), F.lit("None"))]
    return F.concat(*parts)


def run_summary(run_url: str) -> Column:
    """Message about a finished workflow run (state, data set, duration, link)."""
    mark = F.when(F.col("is_successful"), F.lit("\U0001F389")).otherwise(F.lit("❌"))
    dataset = F.coalesce(F.nullif(F.col("dataset"), F.lit("")), F.lit("all datasets"))
    return F.concat(
        mark, F.lit(" Workflow run (Name: "), F.col("run_name"), F.lit(", Id: "),
        F.col("id").cast("string"), F.lit(") has completed with state: "), F.col("state"),
        F.lit("\nDataset: "), dataset, F.lit("\nDuration (submission to completion): "),
        dates.duration_text(F.col("submit"), F.col("complete")),
        F.lit("\n\nView run: "), F.lit(run_url), F.col("id").cast("string"),
    )


def created_message(object_id: Column, entity_url: str) -> Column:
    """Notification text for a queue message about a created entity."""
    return F.concat(
        F.lit("Entity "), object_id, F.lit(" has been created and can be viewed at "),
        F.lit(entity_url), object_id,
    )
