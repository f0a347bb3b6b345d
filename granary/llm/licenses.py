"""License scans in DataFrame functions: MinHash bands over overlapping windows, then exact shingle containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import literal_table

# Notices and opening passages of public licenses
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
]
WIDTH = 3  # words of a shingle
SMALLEST = 4  # shingles of the smallest window; sizes double from there, and windows overlap by half
# One row each.  A window is the first size of at least twice its template, so the template fills at least a quarter of
# it, and shingles of no template are not hashed.  With 0.8 of the template there, at least a sixth of the hashed
# shingles are common: they collide with probability 1 - (5/6)**64 = 0.99999 or more.
BANDS = 64
MIN_CONTAINMENT = 0.8

_WORDS = "filter(split(lower(regexp_replace({text}, '[^\\\\p{{L}}\\\\p{{N}}]+', ' ')), ' '), w -> w <> '')"


def _shingles(words: str) -> str:
    """Hashes of all runs of WIDTH words; a shorter text is one run."""
    return (
        f"CASE WHEN size({words}) = 0 THEN cast(array() AS array<bigint>) "
        f"WHEN size({words}) < {WIDTH} THEN array(xxhash64(array_join({words}, ' '))) "
        f"ELSE transform(sequence(0, size({words}) - {WIDTH}), i -> "
        f"xxhash64({words}[i] || ' ' || {words}[i + 1] || ' ' || {words}[i + 2])) END"
    )


def _bands(shingles: str) -> str:
    """The smallest of BANDS differently seeded hashes."""
    return f"transform(sequence(1, {BANDS}), s -> struct(s AS band, array_min(transform({shingles}, h -> xxhash64(h, s))) AS low))"


def templates(spark, rows=None) -> DataFrame:
    """license, template (its number), size of its windows, number of its shingles, and the distinct ones."""
    rows = [(k, name, text) for k, (name, text) in enumerate(rows or TEMPLATES)]
    out = literal_table(spark, rows, "template int, license string, text string")
    out = out.withColumn("words", F.expr(_WORDS.format(text="text")))
    out = out.withColumn("goal", F.expr(f"array_distinct({_shingles('words')})"))
    out = out.withColumn("length", F.expr(f"size({_shingles('words')})"))
    doublings = F.ceil(F.log2(F.greatest(2 * F.col("length"), F.lit(SMALLEST)) / SMALLEST) - 1e-9)
    return out.withColumn("width", (SMALLEST * F.pow(F.lit(2), doublings)).cast("int")).select(
        "template", "license", "width", "length", "goal"
    )


def scan(docs: DataFrame, rows=None, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """doc_id, license, template, containment and first window of every license text found in a document.

    The window is the first of those that hold most of the text.  Windows that hold no template shingle have
    containment 0 and are left out before they are hashed.  Null and empty
    texts give no rows; repeated rows give one finding each per doc_id.
    """
    spark = docs.sparkSession
    known = templates(spark, rows)
    # the templates are configuration; their shingles and window sizes are settled as literals once
    settled = known.select("width", "goal").collect()
    widths = sorted({r["width"] for r in settled})
    all_goals = sorted({h for r in settled for h in r["goal"]})
    literal = "array(" + ", ".join(f"{h}L" if h > -(2**63) else "-9223372036854775807L - 1L" for h in all_goals) + ")"
    text = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # explode of one element keeps Catalyst from working the words out again inside every use of them
    words = text.select("doc_id", F.explode(F.array(F.expr(_WORDS.format(text="text")))).alias("words"))
    hashed = words.select("doc_id", F.explode(F.array(F.expr(_shingles("words")))).alias("h")).where(F.expr(f"arrays_overlap(h, {literal})"))
    # places and values of the template shingles; the others count for no template
    hits = F.expr(f"filter(transform(h, (x, i) -> struct(i AS i, x AS x)), p -> array_contains({literal}, p.x))")
    hits = hashed.select("doc_id", F.explode(F.array(hits)).alias("hits"))
    wide = hits.withColumn("width", F.explode(F.array(*[F.lit(s) for s in widths])))
    # window number w covers shingles w * width / 2 .. w * width / 2 + width
    wide = wide.withColumn(
        "w", F.explode(F.expr("array_distinct(flatten(transform(hits, p -> let_windows(p.i))))".replace(
            "let_windows(p.i)", "if(p.i < width / 2, array(0), array(int(p.i div (width div 2)) - 1, int(p.i div (width div 2))))"
        )))
    ).withColumn("at", F.expr("cast(w * (width div 2) as int)"))
    # what is around a window, up to the longest template of its size
    near = "filter(hits, p -> p.i >= at - width div 2 AND p.i < at + width + width div 2)"
    windows = wide.select("doc_id", "width", "at", F.explode(F.array(F.expr(near))).alias("near"))
    part = "transform(filter(near, p -> p.i >= at AND p.i < at + width), p -> p.x)"
    windows = windows.withColumn("part", F.explode(F.array(F.expr(part))))
    probes = windows.withColumn("b", F.explode(F.expr(_bands("part")))).select("doc_id", "width", "at", "near", "part", "b.*")
    goals = known.withColumn("b", F.explode(F.expr(_bands("goal")))).select("template", "license", "width", "length", "goal", "b.*")
    found = probes.join(goals, ["width", "band", "low"])
    # the text of the window widened by the template's length, so that no copy is cut by its edges
    around = F.expr("transform(filter(near, p -> p.i >= at - length AND p.i < at + width + length), p -> p.x)")
    found = found.select(
        "doc_id", "license", "template", (F.size(F.array_intersect(around, "goal")) / F.size("goal")).alias("containment"),
        F.size(F.array_intersect("part", "goal")).alias("inside"), "at",
    )
    found = found.where(F.col("containment") >= min_containment)
    best = F.max(F.struct(F.col("containment"), F.col("inside"), (-F.col("at")).alias("at")))
    return found.groupBy("doc_id", "license", "template").agg(best.alias("best")).select(
        "doc_id", "license", "template", F.col("best.containment").alias("containment"), (-F.col("best.at")).alias("first_shingle")
    )
