"""Dataset documents (JSON-LD) for a metadata catalogue.

A full document lists every file of a dataset, so one document may be larger
than a row or a task can hold.  It is therefore produced as ordered text
fragments (object_key, section, place, line); written in order they are the
document.  Minimal documents have a fixed number of fields and are one row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions import text
from granary.operators import aggregates, joins, ranking
from granary.sinks.files import json_object

# The context of the public Croissant 1.0 vocabulary.
DOCUMENT_CONTEXT = {
    "@language": "en",
    "@vocab": "https://schema.org/",
    "citeAs": "cr:citeAs",
    "column": "cr:column",
    "conformsTo": "dct:conformsTo",
    "cr": "http://mlcommons.org/croissant/",
    "rai": "http://mlcommons.org/croissant/RAI/",
    "data": {"@id": "cr:data", "@type": "@json"},
    "dataType": {"@id": "cr:dataType", "@type": "@vocab"},
    "dct": "http://purl.org/dc/terms/",
    "examples": {"@id": "cr:examples", "@type": "@json"},
    "extract": "cr:extract",
    "field": "cr:field",
    "fileProperty": "cr:fileProperty",
    "fileObject": "cr:fileObject",
    "fileSet": "cr:fileSet",
    "format": "cr:format",
    "includes": "cr:includes",
    "isLiveDataset": "cr:isLiveDataset",
    "jsonPath": "cr:jsonPath",
    "key": "cr:key",
    "md5": "cr:md5",
    "parentField": "cr:parentField",
    "path": "cr:path",
    "recordSet": "cr:recordSet",
    "references": "cr:references",
    "regex": "cr:regex",
    "repeated": "cr:repeated",
    "replace": "cr:replace",
    "sc": "https://schema.org/",
    "separator": "cr:separator",
    "source": "cr:source",
    "subField": "cr:subField",
    "transform": "cr:transform",
}
MINIMAL_CONTEXT = "https://schema.org/"
CONFORMS_TO = "http://mlcommons.org/croissant/1.0"

# Dataset annotations copied into the document; of those marked
# True only the first value is taken.
COPIED_ANNOTATIONS = {
    "accessType": True,
    "alternateName": True,
    "citation": True,
    "conditionsOfAccess": True,
    "countryOfOrigin": False,
    "dataType": False,
    "dataUseModifiers": False,
    "diseaseFocus": False,
    "funder": False,
    "individualCount": True,
    "keywords": False,
    "manifestation": False,
    "measurementTechnique": False,
    "series": True,
    "species": False,
    "specimenCount": True,
    "studyId": True,
    "subject": False,
    "title": True,
    "visualizeDataOn": False,
    "yearProcessed": True,
}

UNKNOWN_MD5 = "unknown_md5"
UNKNOWN_LICENSE = "unknown_license"
KEYS = ["dataset_id", "dataset_version", "dataset_collection"]
SECTIONS = {"head": 0, "metadata": 1, "file": 2, "records": 3, "field": 4, "tail": 5}


def document_key(name: Column, dataset: Column, version: Column, collection: Column) -> Column:
    return F.concat(
        name, F.lit("_"), dataset, F.lit("."), version.cast("string"),
        F.lit("_datasetCollection_"), collection, F.lit("_croissant.jsonld"),
    )


def minimal_key(name: Column, dataset: Column) -> Column:
    return F.concat(name, F.lit("_"), dataset, F.lit(".minimal_croissant.jsonld"))


def object_url(root: str, key: Column) -> Column:
    """Public address of a stored object."""
    return F.concat(F.lit(root), text.quote_plus(key))


def _filled(column: Column, default: Column) -> Column:
    return F.when(F.coalesce(column, F.lit("")) != "", column).otherwise(default)


def _nested(value) -> Column:
    """A constant of nested mappings as a struct column."""
    if isinstance(value, Mapping):
        return F.struct(*[_nested(v).alias(k) for k, v in value.items()])
    return F.lit(value)


def file_versions(nodes: DataFrame, files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Checksum and content type of the wanted (file_id, file_version) pairs of public nodes."""
    history = joins.explode_members(
        nodes.filter("is_public").select(
            text.prefixed_id(F.col("id")).alias("file_id"), "version_history"
        ),
        "version_history", "entry",
    ).select(
        "file_id",
        F.col("entry.versionNumber").alias("file_version"),
        F.col("entry.contentMd5").alias("md5"),
        F.col("entry.fileHandleId").alias("file_handle_id"),
    )
    keys = ["file_id", "file_version"]
    needed = history.join(wanted.select(*keys).distinct(), keys, "left_semi")
    return joins.with_file_type(needed, files).drop("file_handle_id")


def attachments(
    items: DataFrame, entities: DataFrame, nodes: DataFrame, files: DataFrame
) -> DataFrame:
    """Files of each dataset with name, description, checksum and media type.

    ``items`` lists (KEYS, file_id, file_version) and ``entities`` describes each
    (file_id, file_version).  Listed files that have no entity are left out.
    """
    pair = ["file_id", "file_version"]
    listed = items.join(entities, pair)
    known = file_versions(nodes, files, items)
    joined = listed.join(known, pair, "left")
    known_type = F.nullif(F.nullif(F.col("content_type"), F.lit("NOT_SET")), F.lit(""))
    guessed = text.guessed_file_type(_filled(F.col("file_name"), F.col("name")))
    return joined.select(
        *KEYS, *pair, "name",
        _filled(F.col("description"), F.concat(F.lit("Data file associated with "), F.col("name"))).alias(
            "description"
        ),
        F.coalesce(known_type, guessed, F.lit(text.DEFAULT_FILE_TYPE)).alias("encoding"),
        F.coalesce("md5", F.lit(UNKNOWN_MD5)).alias("md5"),
    )


def _file_object(entity_url: str) -> Column:
    ident = F.concat(F.col("file_id"), F.lit("."), F.col("file_version").cast("string"))
    return json_object(**{
        "@type": F.lit("FileObject"),
        "@id": ident,
        "name": F.col("name"),
        "description": F.col("description"),
        "contentUrl": F.concat(F.lit(entity_url), ident),
        "encodingFormat": F.col("encoding"),
        "md5": F.col("md5"),
        "sha256": F.lit("unknown"),
    })


def _field_object() -> Column:
    return json_object(**{
        "@type": F.lit("Field"),
        "@id": F.concat(F.lit("metadata/"), F.col("key")),
        "name": F.col("key"),
        "description": F.lit(""),
        "dataType": F.lit("sc:Text"),
        "source": F.struct(
            F.struct(F.lit("metadata").alias("@id")).alias("fileObject"),
            F.struct(F.col("key").alias("column")).alias("extract"),
        ),
    })


def _head(entity_url: str) -> Column:
    """The document's own fields, up to the opened list of files."""
    ident = F.concat(F.col("dataset_id"), F.lit("."), F.col("dataset_version").cast("string"))
    fields = {
        "@context": _nested(DOCUMENT_CONTEXT),
        "@type": F.lit("Dataset"),
        "@id": ident,
        "name": F.col("name"),
        "description": _filled(F.col("description"), F.concat(F.lit("Dataset for "), F.col("name"))),
        "url": F.concat(F.lit(entity_url), ident),
        "datePublished": F.col("modified_on"),
        "license": F.coalesce(F.get(F.col("annotations")["license"], F.lit(0)), F.lit(UNKNOWN_LICENSE)),
        "version": F.col("dataset_version"),
        "dct:conformsTo": F.lit(CONFORMS_TO),
    }
    for name, first_only in COPIED_ANNOTATIONS.items():
        values = F.col("annotations")[name]
        fields[name] = F.get(values, F.lit(0)) if first_only else values
    whole = json_object(**fields)
    # drop the closing brace, then open the list
    return F.concat(F.substring(whole, F.lit(1), F.length(whole) - 1), F.lit(',"distribution":['))


def _metadata_file(entity_url: str) -> Column:
    ident = F.concat(F.col("dataset_id"), F.lit("."), F.col("dataset_version").cast("string"))
    return json_object(**{
        "@type": F.lit("FileObject"),
        "@id": F.lit("metadata"),
        "contentUrl": F.concat(F.lit(entity_url), ident),
        "name": F.lit("metadata"),
        "description": F.concat(F.lit("Metadata associated with "), F.col("name")),
        "encodingFormat": F.lit("application/csv"),
        "md5": F.lit("unknown"),
        "sha256": F.lit("unknown"),
    })


def record_fields(items: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct annotation keys of the files of each dataset, the first one marked.

    Keys sort without regard to case; the mark decides where a separator goes.
    """
    pair = ["file_id", "file_version"]
    keys = aggregates.union_keys(
        items.join(entities.select(*pair, "annotations"), pair), "annotations", KEYS
    )
    # the count keeps the distinct keys as the common input of both sides, so
    # that their exchange is computed once and reused
    firsts = keys.groupBy(*KEYS).agg(
        F.min(F.struct(F.lower("key"), "key")).alias("_first"), F.count("key").alias("_n")
    )
    joined = keys.join(firsts.filter("_n > 0"), KEYS)
    return joined.select(
        *KEYS, "key", F.lower("key").alias("folded"), (F.col("_first.key") == F.col("key")).alias("is_first")
    )


def dataset_documents(
    datasets: DataFrame,
    items: DataFrame,
    entities: DataFrame,
    nodes: DataFrame,
    files: DataFrame,
    entity_url: str,
) -> DataFrame:
    """Fragments of the full documents of all datasets that have files.

    ``datasets``: KEYS, name, description, modified_on, annotations (map of text
    arrays).  ``items``: KEYS, file_id, file_version.  ``entities``: file_id,
    file_version, name, description, file_name, annotations (map).
    """
    attached = attachments(items, entities, nodes, files)
    shown = datasets.join(attached.select(*KEYS).distinct(), KEYS, "left_semi")
    object_key = document_key(
        F.col("name"), F.col("dataset_id"), F.col("dataset_version"), F.col("dataset_collection")
    )
    shown = shown.withColumn("object_key", object_key)
    # without the name column, which both sides of the joins below would carry
    keyed = shown.select(*KEYS, "object_key")

    record_set = F.lit(
        '],"recordSet":{"@type":"RecordSet","@id":"default","name":"default",'
        '"description":"Metadata for the dataset","field":['
    )
    fixed = {
        "head": _head(entity_url), "metadata": _metadata_file(entity_url),
        "records": record_set, "tail": F.lit("]}}"),
    }
    frame = shown.select(
        "object_key",
        F.inline(F.array(*[
            F.struct(
                F.lit(SECTIONS[name]).alias("section"), F.lit("").alias("place"), line.alias("line")
            )
            for name, line in fixed.items()
        ])),
    )

    def fragments(df: DataFrame, section: str, line: Column, place: Column) -> DataFrame:
        return df.select(
            "object_key", F.lit(SECTIONS[section]).alias("section"),
            place.alias("place"), line.alias("line"),
        )

    file_place = F.concat_ws(
        ".", F.col("file_id"), F.lpad(F.col("file_version").cast("string"), 10, "0")
    )
    field_line = F.concat(F.when(F.col("is_first"), F.lit("")).otherwise(F.lit(",")), _field_object())
    return ranking.stack(
        frame,
        fragments(
            attached.join(keyed, KEYS), "file",
            F.concat(F.lit(","), _file_object(entity_url)), file_place,
        ),
        fragments(
            record_fields(items, entities).join(keyed, KEYS), "field", field_line,
            F.concat_ws("\u0001", "folded", "key"),
        ),
    )


def document_links(datasets: DataFrame, root_url: str) -> DataFrame:
    """Where each full document is stored: KEYS and the object address."""
    key = document_key(
        F.col("name"), F.col("dataset_id"), F.col("dataset_version"), F.col("dataset_collection")
    )
    return datasets.select(*KEYS, object_url(root_url, key).alias("object_url"))


def resolve(links: DataFrame, manifest: DataFrame, root_url: str) -> DataFrame:
    """Published links with the stored pieces of their document, NULL where nothing is stored under the link."""
    pieces = manifest.withColumn("object_url", object_url(root_url, F.col("object_key")))
    return links.join(pieces, "object_url", "left")


def minimal_lines(rows: DataFrame) -> DataFrame:
    """Minimal documents as fragments for the document writer: one each."""
    return rows.select("object_key", F.lit(0).alias("section"), F.lit("").alias("place"), F.col("document").alias("line"))


def minimal_documents(catalog: DataFrame, entity_url: str, default_owner: str) -> DataFrame:
    """One small document per catalogue row: (object_key, dataset_id, dataset_name, document)."""
    rows = catalog.dropna(subset=["id"])
    document = json_object(**{
        "@context": F.lit(MINIMAL_CONTEXT),
        "@type": F.lit("Dataset"),
        "name": F.col("name"),
        "description": F.coalesce("description", F.lit("")),
        "url": F.concat(F.lit(entity_url), F.col("id")),
        "identifier": F.col("id"),
        "creator": F.struct(
            F.lit("Organization").alias("@type"),
            F.coalesce("contributors", F.lit(default_owner)).alias("name"),
        ),
        "license": F.coalesce("license", F.lit("")),
    })
    return rows.select(
        minimal_key(F.col("name"), F.col("id")).alias("object_key"),
        F.col("id").alias("dataset_id"), F.col("name").alias("dataset_name"),
        document.alias("document"),
    )
