"""Matrices of any width as tiles: a fixed number of columns each, and a manifest that says which.

A wide table needs its columns when it is planned, so a matrix with one column per sample would have to bring all
sample names to the driver.  Tiles always have the same columns; which sample a column shows is data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from granary.operators import ranking

WIDTH = 64  # columns of a tile


def manifest(cells: DataFrame, col: str, width: int = WIDTH) -> DataFrame:
    """(column name, tile, place) of every column value, in their order; numbered without one big window."""
    names = cells.select(col).dropna().distinct()
    numbers = ranking.numbered(names, [F.asc(col)], "_number", start=0)
    return numbers.select(
        col, F.floor(F.col("_number") / width).cast("int").alias("tile"), (F.col("_number") % width).cast("int").alias("place")
    )


def tiled(cells: DataFrame, places: DataFrame, row: str, col: str, value: str, width: int = WIDTH) -> DataFrame:
    """One row per matrix row and tile: ``c0`` to ``c{width - 1}`` hold the largest value of each cell.

    A single hash aggregate; rows and tiles without any value are left out.
    """
    found = cells.filter(F.col(row).isNotNull()).join(places, col)
    columns = [F.max(F.when(F.col("place") == k, F.col(value))).alias(f"c{k}") for k in range(width)]
    return found.groupBy(row, "tile").agg(*columns)


def write_tiles(cells: DataFrame, path: str, row: str, col: str, value: str, width: int = WIDTH) -> None:
    """Store a matrix given as cells: the manifest, and the tiles in one folder each.

    The cells are worked out once and stored as well, since the manifest needs them before the tiles do.
    """
    spark = cells.sparkSession
    cells.write.mode("overwrite").parquet(f"{path}/cells")
    stored = spark.read.schema(cells.schema).parquet(f"{path}/cells")
    manifest(stored, col, width).write.mode("overwrite").parquet(f"{path}/manifest")
    rows = tiled(stored, spark.read.parquet(f"{path}/manifest"), row, col, value, width)
    rows.write.mode("overwrite").partitionBy("tile").parquet(f"{path}/tiles")


def read_tiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(tiles, manifest) of a stored matrix."""
    return spark.read.parquet(f"{path}/tiles"), spark.read.parquet(f"{path}/manifest")


def _width(tiles: DataFrame) -> int:
    return sum(1 for c in tiles.columns if c.startswith("c") and c[1:].isdigit())


def selected(tiles: DataFrame, places: DataFrame, row: str, col: str, names: Sequence[str]) -> DataFrame:
    """The named columns of every matrix row as a wide table; names the matrix lacks are NULL throughout.

    Only tiles with one of the names are joined; the names are part of the plan and nothing is looked up before.
    """
    wanted = places.filter(F.col(col).isin(list(names)))
    values = F.array(*[F.col(f"c{k}") for k in range(_width(tiles))])
    cells = tiles.join(wanted, "tile").select(row, col, F.get(values, F.col("place")).alias("_value"))
    shown = [F.max(F.when(F.col(col) == n, F.col("_value"))).alias(n) for n in names]
    rows = tiles.select(row).distinct()
    return rows.join(cells.groupBy(row).agg(*shown), row, "left")


def lines(tiles: DataFrame, places: DataFrame, row: str, col: str, sep: str = "\t", missing: str = "") -> DataFrame:
    """The whole matrix as text: (is_row, row, line), a line of headings and one line per matrix row.

    A line is as long as the matrix is wide; nothing else is gathered.  Tiles a row has no value in are filled up.
    """
    width = _width(tiles)
    sizes = places.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    held = F.array(*[F.coalesce(F.col(f"c{k}").cast("string"), F.lit(missing)) for k in range(width)])
    piece = tiles.join(sizes, "tile").select(row, "tile", F.array_join(F.slice(held, F.lit(1), F.col("n").cast("int")), sep).alias("text"))
    count = places.agg(F.count(F.lit(1))).scalar()
    by_tile = F.map_from_entries(F.collect_list(F.struct("tile", "text")))

    def blank(tile: Column) -> Column:
        size = F.least(F.lit(width), F.col("_count") - tile * width)
        return F.array_join(F.array_repeat(F.lit(missing), size), sep)

    last = F.floor((F.col("_count") - 1) / width).cast("int")
    rows = piece.groupBy(row).agg(by_tile.alias("_tiles")).withColumn("_count", count.cast("int")).select(
        F.lit(1).alias("is_row"), F.col(row).cast("string").alias("row"),
        F.transform(F.sequence(F.lit(0), last), lambda t: F.coalesce(F.try_element_at("_tiles", t), blank(t))).alias("_texts"),
    )
    rows = rows.select("is_row", "row", F.concat_ws(sep, "row", F.array_join("_texts", sep)).alias("line"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("tile", "place", col))), lambda c: c[col])
    head = places.agg(F.concat_ws(sep, F.lit(row), names).alias("line"))
    return ranking.stack(head.select(F.lit(0).alias("is_row"), F.lit(None).cast("string").alias("row"), "line"), rows)


def write_lines(text: DataFrame, path: str) -> None:
    """The lines of a matrix as text files that concatenate in name order, the headings once at the top."""
    text.orderBy("is_row", "row").select("line").write.mode("overwrite").text(path)
