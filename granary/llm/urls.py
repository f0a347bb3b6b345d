"""URL filters: a sorted array of 64-bit digests, memory-mapped and probed by binary search."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Host and path of the rules of the registered query, and its blocked hosts
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
BLOCKED = [("spam-farm.example.org", "")]
_ENTRY = np.dtype([("digest", "<u8"), ("at", "<u8"), ("size", "<u4"), ("verdict", "<u4")])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` and for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, path


def build_index(entries: list[tuple[str, str, str]]) -> tuple[bytes, list[int]]:
    """File content (count, entries sorted by digest, strings) and the lengths of paths that occur."""
    strings = {host + path: verdict for host, path, verdict in entries}
    rows, pool = [], b""
    for text, verdict in strings.items():
        raw = text.encode()
        rows.append((xxhash.xxh64_intdigest(raw), len(pool), len(raw), verdict == "block"))
        pool += raw
    rows = np.sort(np.array(rows, dtype=_ENTRY), order="digest")
    head = np.array([len(rows)], "<u8").tobytes()
    return head + rows.tobytes() + pool, sorted({len(path) for _, path, _ in entries})


class DigestIndex:
    """A memory-mapped index file."""

    def __init__(self, path: str):
        n = int(np.fromfile(path, "<u8", 1)[0])
        self.rows = np.memmap(path, _ENTRY, "r", offset=8, shape=(n,)) if n else np.empty(0, _ENTRY)
        start = 8 + n * _ENTRY.itemsize
        self.pool = np.memmap(path, np.uint8, "r", offset=start) if os.path.getsize(path) > start else np.empty(0, np.uint8)
        self.digests = self.rows["digest"]

    def text(self, row: int) -> str:
        """The stored string of a row."""
        at, size = int(self.rows[row]["at"]), int(self.rows[row]["size"])
        return self.pool[at : at + size].tobytes().decode()

    def probe(self, texts: list[str]) -> np.ndarray:
        """Row of each text, or -1; equal digests are told apart by the stored strings."""
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        wanted = np.array([xxhash.xxh64_intdigest(r) for r in raws], np.uint64)
        at = np.searchsorted(self.digests, wanted)
        out = np.full(len(raws), -1, np.int64)
        for k in np.flatnonzero(self.digests[np.minimum(at, max(len(self.rows) - 1, 0))] == wanted) if len(self.rows) else []:
            j = at[k]
            while j < len(self.rows) and self.digests[j] == wanted[k]:
                if self.text(j) == texts[k]:
                    out[k] = j
                    break
                j += 1
        return out


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, blocked: list[tuple[str, str]] = BLOCKED
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row; ``blocked`` decides where no rule fits, else allow.

    A url is probed with every suffix of its host and every start of its path that has the length of a stored path;
    the longest stored string wins.  A null url has an empty host and path and is allowed.  Repeated rows stay.
    The lists are configuration; their index file reaches each executor once, as a Spark file, and is not loaded
    but mapped there.
    """
    spark = pages.sparkSession
    parts = []
    for entries in (rules, [(h, p, "block") for h, p in blocked]):
        content, lengths = build_index(entries)
        # an index file per content and call: Spark keeps the file it was given until the session ends
        name = f"url-index-{uuid.uuid4().hex}"
        with open(os.path.join(tempfile.mkdtemp(), name), "wb") as f:
            f.write(content)
        spark.sparkContext.addFile(f.name)
        parts.append((name, lengths))
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))

    def longest(index: DigestIndex, lengths: list[int], hosts, paths) -> np.ndarray:
        texts, owner = [], []
        for k, (h, p) in enumerate(zip(hosts, paths)):
            labels = h.split(".") if h else []
            for j in range(len(labels)):
                for n in lengths:
                    if n <= len(p):
                        texts.append(".".join(labels[j:]) + p[:n])
                        owner.append(k)
        best = np.full(len(hosts), -1, np.int64)
        for k, row in zip(owner, index.probe(texts)):
            if row >= 0 and (best[k] < 0 or index.rows[row]["size"] > index.rows[best[k]]["size"]):
                best[k] = row
        return best

    def judged(batches):
        (first, l1), (second, l2) = [(DigestIndex(SparkFiles.get(name)), lengths) for name, lengths in parts]
        for b in batches:
            hosts, paths = b.host.tolist(), b.path.tolist()
            rule, other = longest(first, l1, hosts, paths), longest(second, l2, hosts, paths)
            out = b.copy()
            out["rule"] = [first.text(r) if r >= 0 else None for r in rule]
            out["verdict"] = [
                ("block" if first.rows[r]["verdict"] else "allow") if r >= 0 else "block" if o >= 0 else "allow"
                for r, o in zip(rule, other)
            ]
            yield out

    return rows.mapInPandas(judged, StructType(rows.schema.fields + [StructField("rule", StringType()), StructField("verdict", StringType())]))
