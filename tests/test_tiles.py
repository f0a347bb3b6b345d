import random

import pytest
from pyspark.sql import functions as F

from granary.operators import tiles


def table(spark, n=400, seed=1):
    pick = random.Random(seed)
    rows = [(f"g{pick.randrange(9)}", f"s{pick.randrange(23):02d}", pick.choice([None, *range(50)])) for _ in range(n)]
    rows += [(None, "s01", 7), ("g1", None, 7), ("empty", "s03", None)]
    return rows, spark.createDataFrame([(g, s, None if v is None else float(v)) for g, s, v in rows], "gene string, sample string, v double")


def brute(rows):
    cells = {}
    for g, s, v in rows:
        if g is not None and s is not None:
            cells.setdefault((g, s), []).append(v)
    return {k: max((v for v in vs if v is not None), default=None) for k, vs in cells.items()}


@pytest.mark.parametrize("width", [1, 5, 23, 64])
def test_tiles_hold_the_matrix(spark, tmp_path, width):
    rows, df = table(spark)
    tiles.write_tiles(df, str(tmp_path), "gene", "sample", "v", width)
    stored, places = tiles.read_tiles(spark, str(tmp_path))
    cells = brute(rows)
    names = sorted({s for _, s in cells})
    genes = sorted({g for g, _ in cells})
    assert [r["sample"] for r in places.orderBy("tile", "place").collect()] == names
    assert max(r["place"] for r in places.collect()) < width
    asked = ["s03", "none", names[-1]]
    got = {r["gene"]: tuple(r)[1:] for r in tiles.selected(stored, places, "gene", "sample", asked).collect()}
    assert got == {g: tuple(cells.get((g, s)) for s in asked) for g in genes}
    tiles.write_lines(tiles.lines(stored, places, "gene", "sample"), str(tmp_path / "text"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "text").glob("part-*"))).splitlines()
    shown = lambda v: "" if v is None else f"{v:.1f}"
    assert text == ["\t".join(["gene", *names])] + ["\t".join([g, *[shown(cells.get((g, s))) for s in names]]) for g in genes]


def test_no_columns_are_looked_up_to_plan_tiles(spark, tmp_path):
    _, df = table(spark)
    tiles.write_tiles(df, str(tmp_path), "gene", "sample", "v", 4)
    stored, places = tiles.read_tiles(spark, str(tmp_path))
    assert stored.columns == ["gene", "c0", "c1", "c2", "c3", "tile"]
    plan = tiles.tiled(df, places, "gene", "sample", "v", 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_empty_matrix(spark, tmp_path):
    _, df = table(spark)
    tiles.write_tiles(df.filter("v < 0"), str(tmp_path), "gene", "sample", "v", 4)
    places = spark.read.parquet(str(tmp_path / "manifest"))
    assert places.count() == 0
    none = tiles.tiled(df.filter(F.lit(False)), places, "gene", "sample", "v", 4)
    assert tiles.selected(none, places, "gene", "sample", ["a"]).count() == 0
    assert [r["line"] for r in tiles.lines(none, places, "gene", "sample").collect()] == ["gene"]
