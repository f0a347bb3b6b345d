"""Gene by sample matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from granary.functions import text
from granary.operators import aggregates, joins, tiles

GENE = "Hugo"


def expression_cells(expression: DataFrame, mapping: DataFrame) -> DataFrame:
    """(gene, specimen, tpm) from expression rows; files without a specimen are left out.

    The gene is the sixth pipe-separated part of ``target_id``.
    """
    specimens = mapping.select("file_id", "specimen")
    rows = expression.select(
        "file_id", text.pipe_part(F.col("target_id"), 5).alias(GENE), "tpm"
    )
    return aggregates.matrix_cells(joins.lookup(rows, specimens, ["file_id"]), GENE, "specimen", "tpm")


def gene_matrix(
    expression: DataFrame, mapping: DataFrame, specimens: Sequence[str] | None = None
) -> DataFrame:
    """One row per gene, one column per specimen, the largest value in each cell."""
    cells = expression_cells(expression, mapping)
    return aggregates.sample_matrix(cells, GENE, "specimen", "tpm", specimens)


def write_gene_tiles(expression: DataFrame, mapping: DataFrame, path: str, width: int = tiles.WIDTH) -> None:
    """The gene matrix stored in tiles, for any number of specimens; ``tiles`` reads, selects and prints it."""
    tiles.write_tiles(expression_cells(expression, mapping), path, GENE, "specimen", "tpm", width)
