"""Keeping a catalogue current: links, stale rows and objects, intake of outside items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions import messages, text
from granary.operators import aggregates, filters, joins, quality, ranking
from granary.sinks.tables import upsert_actions

MINIMAL_SUFFIX = ".minimal_croissant.jsonld"


def link_actions(links: DataFrame, desired: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """insert, update or unchanged for every desired link."""
    return upsert_actions(links, desired, keys, value)


def stale_links(
    links: DataFrame, current: DataFrame, keys: Sequence[str], collections: Sequence[str] | None = None
) -> DataFrame:
    """Stored links whose dataset is no longer current; optionally of some collections only."""
    if collections is not None:
        links = links.filter(F.col("dataset_collection").isin(list(collections)))
    return joins.stale_rows(links, current, keys)


def stale_objects(listing: DataFrame, current: DataFrame, collections: Sequence[str]) -> DataFrame:
    """Stored full documents of the given collections that no current dataset accounts for.

    ``current`` has dataset_id, dataset_version, dataset_collection and
    dataset_name.  Objects with other names, and those of other collections,
    are never stale.
    """
    parts = text.object_key_parts(F.col("key"))
    parsed = listing.select("key", parts.alias("p")).filter(
        F.col("p.collection").isin(list(collections))
    )
    keyed = parsed.select(
        "key",
        F.col("p.dataset_id").alias("dataset_id"),
        F.col("p.dataset_version").alias("dataset_version"),
        F.col("p.collection").alias("dataset_collection"),
        F.col("p.name").alias("dataset_name"),
    )
    wanted = current.withColumn("dataset_version", F.col("dataset_version").cast("string"))
    keys = ["dataset_collection", "dataset_id", "dataset_version", "dataset_name"]
    return joins.stale_rows(keyed, wanted, keys).select("key")


def stale_minimal_objects(listing: DataFrame, current: DataFrame) -> DataFrame:
    """Stored minimal documents whose (name, id) is not in the catalogue any more."""
    named = listing.filter(F.endswith(F.col("key"), F.lit(MINIMAL_SUFFIX)))
    stem = F.replace(F.col("key"), F.lit(MINIMAL_SUFFIX), F.lit(""))
    name, ident = text.split_last_underscore(stem)
    keyed = named.select("key", name.alias("dataset_name"), ident.alias("dataset_id")).filter(
        "dataset_id IS NOT NULL"
    )
    return joins.stale_rows(keyed, current, ["dataset_name", "dataset_id"]).select("key")


def map_records(df: DataFrame, mapping: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """Declared target fields, each an expression over the source record."""
    return df.select(*keep, *[column.alias(name) for name, column in mapping.items()])


def intake_status(
    items: DataFrame, existing: DataFrame, ignored: DataFrame, key: str = "sameAs",
    title: str = "title", long_titles: bool = False,
) -> DataFrame:
    """Items with a ``status``: duplicate, ignored, existing or new.

    Items not stored yet that share a title are duplicates, all of them.  Being
    a duplicate comes before being ignored; both are kept out of the catalogue.
    """
    fresh = items.join(existing.select(key).distinct(), key, "left_anti")
    repeated = ranking.duplicate_rows(fresh.select(key, title), [title], long_titles).select(key)
    marks = ranking.stack(
        repeated.withColumn("_mark", F.lit(1)),
        ignored.select(F.col(ignored.columns[0]).alias(key)).withColumn("_mark", F.lit(2)),
        existing.select(key).withColumn("_mark", F.lit(3)),
    ).groupBy(key).agg(F.min("_mark").alias("_mark"))
    status = (
        F.when(F.col("_mark") == 1, F.lit("duplicate"))
        .when(F.col("_mark") == 2, F.lit("ignored"))
        .when(F.col("_mark") == 3, F.lit("existing"))
        .otherwise(F.lit("new"))
    )
    return items.join(marks, key, "left").withColumn("status", status).drop("_mark")


def accepted(status: DataFrame) -> DataFrame:
    """Items that go into the catalogue, with the description cut to its allowed length."""
    kept = status.filter(F.col("status").isin("new", "existing"))
    return kept.withColumn("description", text.truncated(F.col("description")))


def duplicates(status: DataFrame) -> DataFrame:
    return filters.by_value(status, "status", "duplicate").drop("status")


def review_lines(dups: DataFrame, label: str = "Identifier") -> DataFrame:
    """Numbered lines about the duplicates, for a person to look at."""
    ranked = ranking.numbered(dups, [F.asc("title"), F.asc("sameAs")])
    return ranked.select("rank", messages.review_line(F.col("rank"), label).alias("line"))


def catalogue_intake(
    items: DataFrame,
    existing: DataFrame,
    ignored: DataFrame,
    mapping: Mapping[str, Column],
    rules: Mapping[str, Column],
    index: str,
) -> tuple[DataFrame, DataFrame]:
    """Map, check and judge outside items: (items with a status, rule violations)."""
    mapped = map_records(items, mapping, [index])
    valid, errors = quality.split_by_rules(mapped, rules, index)
    sound = quality.require_fields(valid, ["sameAs", "title"])
    return intake_status(sound, existing, ignored), errors


# The annotation columns written to the catalogue.
ANNOTATION_FIELDS = [
    "title", "creator", "keywords", "subject", "collection",
    "publisher", "species", "sameAs", "source", "url",
]


def annotation_rows(
    stored: DataFrame, items: DataFrame, fields: Sequence[str] = tuple(ANNOTATION_FIELDS)
) -> DataFrame:
    """Annotations for stored entities, matched on ``sameAs``; lists become one text."""
    return aggregates.join_annotations(stored, items, "sameAs", fields)
