"""Text expressions: ids, names, sizes, links, titles, file types, log scans."""

from __future__ import annotations

import mimetypes
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The prefix of public entity ids, and the texts used when nothing is known.
ID_PREFIX = "syn"
NO_REASON = "Failure Reason Undetermined"
DEFAULT_FILE_TYPE = "application/octet-stream"
NOT_AVAILABLE = "N/A"


def prefixed_id(number: Column, prefix: str = ID_PREFIX) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def numeric_id(text: Column, prefix: str = ID_PREFIX) -> Column:
    """The number behind the prefix; NULL if it is not a number."""
    return F.replace(text, F.lit(prefix), F.lit("")).try_cast("bigint")


def display_name(first: Column, last: Column, user: Column) -> Column:
    """First and last name, or the user name if either part is missing."""
    return F.when(first.isNull() | last.isNull(), user).otherwise(F.concat(first, F.lit(" "), last))


def joined_list(values: Column) -> Column:
    """Array as one comma-separated text; missing members are left out."""
    return F.array_join(values, ", ")


def size_text(size: Column, power: int = 30, unit: str = "GiB", digits: int = 3) -> Column:
    """Bytes as text in a binary unit; zero and NULL read as below the last digit shown."""
    amount = F.format_string(f"%.{digits}f {unit}", size.cast("double") / F.lit(float(2**power)))
    below = f"< {0:.{digits}f}5 {unit}"
    return F.when(size.isNull() | (size == 0), F.lit(below)).otherwise(amount)


def title_category(title: Column) -> Column:
    """``component`` for supporting material, ``report`` for everything else."""
    lowered = F.lower(title)
    supporting = lowered.contains("component") | lowered.contains("resource")
    return F.when(supporting, F.lit("component")).otherwise(F.lit("report"))


def quote_plus(text: Column) -> Column:
    """Query-string quoting that keeps ``~`` and quotes ``*``."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def pipe_part(text: Column, index: int) -> Column:
    """0-based member of a pipe-separated text, NULL when the text is shorter."""
    return F.get(F.split(text, "[|]"), F.lit(index))


def truncated(text: Column, length: int = 1000) -> Column:
    return F.substring(text, 1, length)


def found_reasons(log: Column, reasons: Sequence[str], default: str = NO_REASON) -> Column:
    """Every listed reason that occurs in the log, comma-separated, in list order."""
    if not reasons:
        return F.lit(default)
    found = F.concat_ws(", ", *[F.when(F.contains(log, F.lit(r)), F.lit(r)) for r in reasons])
    return F.when(found == "", F.lit(default)).otherwise(found)


def read_pair_names(path: Column) -> Column:
    """``_1.`` and ``_2.`` become ``_R1.`` and ``_R2.`` anywhere in the text."""
    return F.replace(
        F.replace(path, F.lit("_1."), F.lit("_R1.")), F.lit("_2."), F.lit("_R2.")
    )


def read_pair_object(key: Column, root: str) -> Column:
    """The new object key of a paired read file below ``root``, NULL for other keys."""
    quoted = "\\Q" + root + "\\E"
    paired = key.rlike(f"^{quoted}{ID_PREFIX}\\d+/.*_[12,]\\.fastq\\.gz$")
    return F.when(paired, read_pair_names(key))


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for item in sorted(table.items()) for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def guessed_file_type(name: Column) -> Column:
    """Media type from the file-name suffix, NULL when the suffix is not known.

    The suffix tables are those of the Python standard library, taken when the
    plan is built.  A compression suffix is looked through (``a.csv.gz``), and
    so are short forms of packed suffixes (``.tgz``).
    """
    known = mimetypes.MimeTypes(filenames=())
    types = {**known.types_map[False], **known.types_map[True]}
    unpacked = {short: full[: full.rindex(".")] for short, full in known.suffix_map.items()}

    # leading dots of a file name do not start a suffix
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"^\.+", "")
    suffix = F.regexp_extract(stem, r"(\.[^.]*)$", 1)
    before = F.regexp_extract(stem, r"(\.[^.]*)\.[^.]*$", 1)
    effective = F.coalesce(
        _lookup(unpacked, F.lower(suffix)),
        F.when(suffix.isin(sorted(known.encodings_map)), F.lower(before)),
        F.lower(suffix),
    )
    return _lookup(types, effective)


def split_last_underscore(text: Column) -> tuple[Column, Column]:
    """(before, after) the last underscore; both NULL when there is none."""
    has_one = text.contains("_")
    pattern = r"(?s)^(.*)_([^_]*)$"
    return (
        F.when(has_one, F.regexp_extract(text, pattern, 1)),
        F.when(has_one, F.regexp_extract(text, pattern, 2)),
    )


def object_key_parts(key: Column, prefix: str = ID_PREFIX) -> Column:
    """Split ``{name}_{id}.{version}_datasetCollection_{collection}_...`` object keys.

    Returns a struct (name, dataset_id, dataset_version, collection) whose
    fields are NULL when the key has not both marked parts.
    """
    version_mark = F.regexp_extract(key, rf"(_{prefix}\d+\.\d+_)", 1)
    collection_mark = F.regexp_extract(key, rf"_datasetCollection_({prefix}\d+)_", 1)
    matched = (version_mark != "") & (collection_mark != "")
    inner = F.replace(version_mark, F.lit("_"), F.lit(""))
    return F.struct(
        F.when(matched, F.split_part(key, version_mark, F.lit(1))).alias("name"),
        F.when(matched, F.split_part(inner, F.lit("."), F.lit(1))).alias("dataset_id"),
        F.when(matched, F.split_part(inner, F.lit("."), F.lit(2))).alias("dataset_version"),
        F.when(matched, collection_mark).alias("collection"),
    )
