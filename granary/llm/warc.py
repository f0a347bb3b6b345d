"""WARC archives: written with revisit records, read back by a reader that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import scratch_path

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: base32
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_END = "\0"  # last byte of a gzip member of less than 16 MiB
STEP = 1 << 16  # compressed bytes unpacked at a time
RECORDS_PER_FILE = 2000


def _digest(hexed: str) -> str:
    """Bare upper-case base32 of a hexadecimal SHA-1: five digits give four letters."""
    groups = f"transform(sequence(0, 7), g -> cast(conv(substr({hexed}, g * 5 + 1, 5), 16, 10) as int))"
    return (
        f"array_join(flatten(transform({groups}, v -> transform(array(15, 10, 5, 0), "
        f"s -> substr('{_ALPHABET}', (shiftright(v, s) & 31) + 1, 1)))), '')"
    )


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """One record per page: equal payloads of enough bytes are kept once, at the largest page_id; others revisit it."""
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", text.alias("payload")).withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    first = rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("sha").agg(
        F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("copies")
    )
    # payloads seen once need no partner, so only repeated ones are joined
    first = first.where("copies > 1").select("sha", "kept")
    rows = rows.join(first, "sha", "left")
    revisit = F.col("kept").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")))
    return rows.select(
        "page_id", "url", "payload_bytes", F.expr(_digest("sha")).alias("payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("kept")).alias("refers_to"), "payload",
    )


def write_archives(rows: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write records as WARC files with at most ``per_file`` records each, every record a gzip member of its own.

    Spark's text writer takes the members as they are and puts the line separator after each: their last byte.
    """
    crlf = "\r\n"
    body = F.when(F.col("record_type") == "revisit", "").otherwise(F.col("payload"))
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "")
    line = F.concat(
        F.lit(f"WARC/1.1{crlf}WARC-Type: "), "record_type",
        F.lit(f"{crlf}WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">{crlf}WARC-Target-URI: "), clean,
        F.lit(f"{crlf}WARC-Payload-Digest: sha1:"), "payload_digest",
        F.lit(f"{crlf}X-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit(f"{crlf}WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{crlf}Content-Length: "), F.octet_length(body).cast("string"), F.lit(f"{crlf}{crlf}"), body,
    )

    def members(batches):
        for b in batches:
            for lo in range(0, len(b), 100):
                yield pd.DataFrame({"member": [member(x)[:-1] for x in b["record"].iloc[lo : lo + 100]]})

    packed = rows.select(F.concat(line, F.lit(f"{crlf}{crlf}")).cast("binary").alias("record"))
    packed = packed.mapInPandas(members, "member binary").select(F.col("member").cast("string").alias("value"))
    packed.write.option("lineSep", _END).option("maxRecordsPerFile", per_file).text(path)


def member(record: bytes) -> bytes:
    """A record as one gzip member that ends in a zero byte: behind 16 MiB or more stands an empty member."""
    out = gzip.compress(record, 6, mtime=0)
    return out if out.endswith(_END.encode()) else out + gzip.compress(b"", 6, mtime=0)


def inflate(raw: bytes) -> tuple[bytes, list[tuple[int, int]]]:
    """Bytes of all readable gzip members, and the (from, to) ranges given up; plain bytes come back as they are.

    Of a damaged member the bytes before the damage are kept, and its range is given up.
    """
    return unpacked(raw)[:2]


def unpacked(raw: bytes) -> tuple[bytes, list[tuple[int, int]], list[int]]:
    """What ``inflate`` gives, and the places in the bytes where a member's rest is missing."""
    if not raw.startswith(_MEMBER) and _VERSION.search(raw[:64]):
        return raw, [], []
    out, gaps, seams, at = bytearray(), [], [], 0
    while at < len(raw):
        unzip, lo = zlib.decompressobj(31), at
        broken = False
        while lo < len(raw) and not unzip.eof and not broken:
            before = unzip.copy()
            try:
                out += unzip.decompress(raw[lo : lo + STEP])
            except zlib.error:
                broken = True
                # the failed call gave nothing, so its bytes go in again one by one up to the damage
                try:
                    for k in range(lo, min(lo + STEP, len(raw))):
                        out += before.decompress(raw[k : k + 1])
                except zlib.error:
                    pass
            lo += STEP
        if unzip.eof and not broken:
            at = min(lo, len(raw)) - len(unzip.unused_data)
            continue
        later = raw.find(_MEMBER, at + 1)
        later = later if later >= 0 else len(raw)
        gaps.append((at, later))
        seams.append(len(out))
        at = later
    return bytes(out), gaps, seams


def _entity(headers: dict[str, str], block: bytes) -> bytes:
    """The payload of a response block: what follows the HTTP headers, or the whole block without them."""
    if headers.get("content-type", "").lower().startswith("application/http") or re.match(rb"HTTP/\d", block):
        head, found, body = block.partition(b"\r\n\r\n")
        return body if found else b""
    return block


def _told(digest: str, payload: bytes) -> bool:
    """Whether a digest header names the payload; a missing one, or one by an unknown method, is not checked."""
    name, _, value = digest.strip().partition(":")
    name = name.lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return True
    real = hashlib.new(name, payload)
    return value.lower() == real.hexdigest() or value.upper().rstrip("=") == base64.b32encode(real.digest()).decode().rstrip("=")


def salvage(data: bytes, seams: list[int] | tuple[int, ...] = ()):
    """Records of an archive as ("record", headers, payload) and unreadable ranges as ("gap", from, to).

    The payload of a response is its HTTP body, or its block where that has no HTTP headers.  After a record that
    fails a check (headers, length, ending, digest) the search goes on at the next version line.  No record reaches
    over a seam, where bytes are missing.
    """
    at = 0
    while at < len(data):
        head = _VERSION.match(data, at)
        end = data.find(b"\r\n\r\n", at) if head else -1
        good, headers, body, stop = False, {}, b"", at
        if end >= 0:
            for raw in data[head.end() : end].split(b"\r\n"):
                key, _, value = raw.partition(b":")
                headers[key.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
            length = headers.get("content-length", "")
            if length.isascii() and length.isdigit():
                body = data[end + 4 : end + 4 + int(length)]
                stop = end + 4 + int(length) + 4
                good = data[stop - 4 : stop] == b"\r\n\r\n" and len(body) == int(length)
                cut = bisect_right(seams, at)
                good = good and not (cut < len(seams) and seams[cut] < stop)
                if good and headers.get("warc-type") == "response":
                    told, block = headers.get("warc-payload-digest", ""), body
                    body = _entity(headers, block)
                    # some writers take the whole block for the payload
                    good = _told(told, body) or _told(told, block)
                    good = good and _told(headers.get("warc-block-digest", ""), block)
        if good:
            yield "record", headers, body
            at = stop
            continue
        later = _VERSION.search(data, at + 1)
        stop = later.start() if later else len(data)
        yield "gap", at, stop
        at = stop


def read_archives(spark, path: str) -> DataFrame:
    """Rows of every archive below ``path``: records (kind "record") and quarantined ranges (kind "gap").

    Gap offsets count bytes of the file (kind "member") or of its unpacked content (kind "gap").
    """
    schema = (
        "kind string, file string, gap_from long, gap_to long, page_id long, url string, payload_bytes long, "
        "payload_digest string, record_type string, refers_to long, payload string"
    )
    number = re.compile(r"(-?\d+)>$")

    def ident(value: str | None) -> int | None:
        found = number.search(value or "")
        return int(found.group(1)) if found else None

    def read(batches):
        for b in batches:
            for file, raw in zip(b.path, b.content):
                data, members, seams = unpacked(raw)
                out = [("member", file, lo, hi, None, None, None, None, None, None, None) for lo, hi in members]
                for item in salvage(data, seams):
                    if item[0] == "gap":
                        out.append(("gap", file, item[1], item[2], None, None, None, None, None, None, None))
                        continue
                    h, body = item[1], item[2]
                    kind = h.get("warc-type")
                    told, told_digest = h.get("x-payload-length", ""), h.get("warc-payload-digest")
                    out.append((
                        "record", file, None, None, ident(h.get("warc-record-id")), h.get("warc-target-uri"),
                        len(body) if kind == "response" else int(told) if told.isdigit() else None,
                        told_digest.removeprefix("sha1:") if told_digest else None, kind,
                        ident(h.get("warc-refers-to")), body.decode("utf-8", "replace") if kind == "response" else None,
                    ))
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
                for c in ("gap_from", "gap_to", "page_id", "payload_bytes", "refers_to"):
                    frame[c] = frame[c].astype("Int64")
                yield frame

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(read, schema)


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write archives of all pages to the shared folder and read them back; a null html is an empty payload.

    Repeated page_ids give one record each.  No pages, no records.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(records(pages, min_revisit_bytes), path)
    return read_archives(pages.sparkSession, path)
