from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granary.functions import dates, messages, text, versions


def values(df, column):
    return [r[column] for r in df.collect()]


def test_release_names_in_all_spellings(spark):
    """Every pair of numbers with every type, spelled with zeros, points or underscores and any case."""
    made = []
    for major, minor in [(0, 0), (3, 14), (12, 7), (105, 20)]:
        for kind in ("gamma", "GAMMA", "gAmMa", ""):
            for name in (f"{major}.{minor}-{kind}", f"00{major}_0{minor}-{kind}"):
                up = kind.upper()
                made.append((name, (f"{major}_{minor}_{up}", up, major, minor, None)))
    df = spark.createDataFrame([(name,) for name, _ in made], "name string")
    got = {r["name"]: tuple(r["parsed"]) for r in versions.parse_release(df, "name").collect()}
    assert got == dict(made)


def test_release_names_at_fault(spark):
    """What is wrong is told by the number of dashes first, then by the two numbers before the dash."""
    heads = ["4.2", "4", "4.2.1", "four.2", "4.", ".2", " 4.2", "4.2 "]
    for tails, wanted in (([""], "Unexpected folder name format: "), (["-gamma"], "Unexpected version format: "), (["-gamma-delta", "--", "-gamma-"], "Unexpected folder name format: ")):
        names = [h + t for h in heads for t in tails if not (h == "4.2" and t == "-gamma")]
        df = spark.createDataFrame([(n,) for n in names], "name string")
        for r in versions.parse_release(df, "name").collect():
            assert tuple(r["parsed"]) == (None, None, None, None, wanted + r["name"])


def test_cohort_versions(spark):
    good = {f"{kind}_{a}_{b}": f"{int(a)}_{int(b)}_{kind.upper()}" for kind in ("public", "Consortium", "pUBLIC") for a in ("7", "007", "41") for b in ("0", "05")}
    bad = ["", "public", "public_7", "public_7_", "public_7_1_1", "7_1_public", "public 7 1", "private_7_1", "public_7_one", "public_preview_7_1", " public_7_1"]
    df = spark.createDataFrame([(v,) for v in [*good, *bad]], "version string")
    got = {r["version"]: (r["parsed"]["release"], r["parsed"]["error"]) for r in versions.parse_cohort_version(df, "version").collect()}
    assert got == {**{v: (r, None) for v, r in good.items()}, **{v: (None, f"Unexpected version format: {v}") for v in bad}}


def test_strict_parsing_fails_the_job(spark):
    df = versions.parse_release(spark.createDataFrame([("bad",)], "name string"), "name")
    with pytest.raises(PySparkException, match="Unexpected folder name format: bad"):
        versions.raise_on_error(df, "parsed").collect()


def test_release_paths_by_depth_and_number(spark):
    paths = {}
    for number in range(25):
        name = f"Release {number:02d}"
        paths[f"top/{name}"] = number > 16
        paths[name] = paths[f"top/{name}/below"] = paths[f"a/top/{name}"] = False
    paths["top/Release 5"] = True  # only the exact old names are skipped
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["path"]: r["valid"] for r in df.select("path", versions.valid_release_path(F.col("path")).alias("valid")).collect()}
    assert got == paths


def test_untyped_releases_are_seventeen():
    assert versions.UNTYPED_RELEASES[0] == "Release 00"
    assert versions.UNTYPED_RELEASES[-1] == "Release 16"
    assert len(versions.UNTYPED_RELEASES) == 17


def test_month_bounds_and_clamping():
    assert dates.month_bounds("2024-12-15") == (date(2024, 12, 1), date(2025, 1, 1))
    assert dates.previous_month(date(2024, 3, 31)) == date(2024, 2, 29)
    assert dates.years_before(datetime(2024, 2, 29, 5), 1) == datetime(2023, 2, 28, 5)
    assert dates.lookback_moment("2025-01-05", 48) == datetime(2025, 1, 3)
    assert dates.lookback_label(24, "2025-01-05") == "Yesterday"
    assert dates.lookback_label(48, "2025-01-05") == "2025-01-03"


def test_sunday_week_matches_python(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1999-12-25', DATE'2005-01-10')) AS d")
    rows = days.select("d", dates.sunday_week(F.col("d")).alias("w")).collect()
    assert [r["w"] for r in rows] == [int(r["d"].strftime("%U")) for r in rows]


@pytest.mark.parametrize("start, end", [
    (datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30)),
    (datetime(2024, 1, 1), datetime(2024, 1, 2, 0, 0, 5)),
    (datetime(2024, 1, 1), datetime(2024, 1, 12, 23, 59, 59, 120)),
    (datetime(2024, 1, 2), datetime(2024, 1, 1, 1)),
    (datetime(2024, 1, 2), datetime(2024, 1, 2)),
])
def test_duration_text_reads_like_python(spark, start, end):
    df = spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
    assert values(df.select(dates.duration_text(F.col("a"), F.col("b")).alias("t")), "t") == [str(end - start)]


def test_duration_unknown(spark):
    df = spark.createDataFrame([(None, datetime(2024, 1, 1))], "a timestamp, b timestamp")
    assert values(df.select(dates.duration_text(F.col("a"), F.col("b")).alias("t")), "t") == ["unknown"]


def test_quote_plus_matches_python(spark):
    from urllib.parse import quote_plus

    samples = ["a b~c*d", "x/y?z&é", "100%+1", "", "(v1)'!"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert values(df.select(text.quote_plus(F.col("s")).alias("q")), "q") == [quote_plus(s) for s in samples]


def test_guessed_file_type_matches_python(spark):
    import mimetypes

    known = mimetypes.MimeTypes(filenames=())
    samples = [
        "a.csv", "a.CSV", "a.txt.gz", "b.tgz", "b.tar.gz", "c.unknown", "noext", ".bashrc", "d.json",
        "e.TXT.gz", "f.svgz", "g.h5", "dir.d/file", "h.tar", "i.gz", "j.PNG", "k.b.c.pdf", "l.rtf",
    ]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    found = values(df.select(text.guessed_file_type(F.col("s")).alias("t")), "t")
    assert found == [known.guess_type(s, strict=False)[0] for s in samples]


def test_size_text(spark):
    df = spark.createDataFrame([(0,), (None,), (2**30,), (1_610_612_736,)], "b bigint")
    assert values(df.select(text.size_text(F.col("b")).alias("t")), "t") == [
        "< 0.0005 GiB", "< 0.0005 GiB", "1.000 GiB", "1.500 GiB",
    ]


@pytest.mark.parametrize("title, category", [
    ("A Component list", "component"), ("shared RESOURCE", "component"), ("TEP package", "report"), ("", "report"),
])
def test_title_category(spark, title, category):
    df = spark.createDataFrame([(title,)], "t string")
    assert values(df.select(text.title_category(F.col("t")).alias("c")), "c") == [category]


def test_display_name_and_ids(spark):
    df = spark.createDataFrame(
        [("Ada", "L", "ada", "syn12"), (None, "L", "bob", "syn"), ("Cy", None, "cy", "12x")],
        "f string, l string, u string, s string",
    )
    assert values(df.select(text.display_name(F.col("f"), F.col("l"), F.col("u")).alias("n")), "n") == ["Ada L", "bob", "cy"]
    assert values(df.select(text.numeric_id(F.col("s")).alias("n")), "n") == [12, None, None]


def test_found_reasons(spark):
    df = spark.createDataFrame([("x NO tissue y", ), ("fine",), (None,)], "log string")
    found = df.select(text.found_reasons(F.col("log"), ["NO tissue", "y", "bad"]).alias("r"))
    assert values(found, "r") == ["NO tissue, y", text.NO_REASON, text.NO_REASON]


def test_read_pair_renames(spark):
    root = "samplesheets/x.y/"
    keys = [
        root + "syn12/SRR1_1.fastq.gz", root + "syn12/SRR1_2.fastq.gz", root + "syn12/SRR1_3.fastq.gz",
        root + "other/SRR1_1.fastq.gz", "samplesheets/xzy/syn12/SRR1_1.fastq.gz",
    ]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    found = values(df.select(text.read_pair_object(F.col("k"), root).alias("n")), "n")
    assert found == [root + "syn12/SRR1_R1.fastq.gz", root + "syn12/SRR1_R2.fastq.gz", None, None, None]
    assert values(df.limit(1).select(text.read_pair_names(F.lit("a_1.b_2.c")).alias("n")), "n") == ["a_R1.b_R2.c"]


def test_pipe_part(spark):
    df = spark.createDataFrame([("a|b|c|d|e|GENE|x",), ("a|b",)], "t string")
    assert values(df.select(text.pipe_part(F.col("t"), 5).alias("g")), "g") == ["GENE", None]


def test_object_key_parts(spark):
    keys = [
        "My_name_syn1.2_datasetCollection_syn3_croissant.jsonld",
        "a_syn1.2_x_syn9.9_datasetCollection_syn3_c.jsonld",
        "a_syn1_datasetCollection_syn3_c.jsonld", "readme.txt",
    ]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(text.object_key_parts(F.col("k")).alias("p"))
    assert [tuple(p) for p in values(df, "p")] == [
        ("My_name", "syn1", "2", "syn3"), ("a", "syn1", "2", "syn3"), (None,) * 4, (None,) * 4,
    ]


def test_last_underscore(spark):
    df = spark.createDataFrame([("a_b_syn1",), ("plain",), ("_x",)], "t string")
    name, ident = text.split_last_underscore(F.col("t"))
    assert [tuple(r) for r in df.select(name, ident).collect()] == [("a_b", "syn1"), (None, None), ("", "x")]


def test_run_summary(spark):
    df = spark.createDataFrame(
        [("r1", "happy", "succeeded", True, "set A", datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30)),
         ("r2", "sad", "failed", False, None, None, None)],
        "id string, run_name string, state string, is_successful boolean, dataset string, submit timestamp, complete timestamp",
    )
    first, second = values(df.select(messages.run_summary("https://x/").alias("m")), "m")
    assert "state: succeeded\nDataset: set A\nDuration (submission to completion): 1:30:00\n" in first
    assert "Dataset: all datasets\nDuration (submission to completion): unknown" in second
    assert first.endswith("View run: https://x/r1")
