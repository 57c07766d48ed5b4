"""Merged ranges: every empty cell of a range takes the top-left value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_KEY = ["workbook", "sheet", "r", "c"]
ROWS_PER_TASK = 1024


def fill_merged(
    cells: DataFrame,
    merges: DataFrame,
    max_rows: int = 1_048_576,
    max_cols: int = 16_384,
) -> DataFrame:
    """``cells`` plus the covered cells, with ``origin`` = ``cell`` or ``merge``.

    A range whose top-left cell is empty adds nothing, and a covered cell that holds
    its own value keeps it. One range may cover a million rows, so ranges are first
    cut into row blocks and spread before they are blown up to cells.
    """
    anchors = merges.join(
        cells.select(
            "workbook", "sheet", F.col("r").alias("min_r"), F.col("c").alias("min_c"), "value", "kind"
        ),
        ["workbook", "sheet", "min_r", "min_c"],
    )
    last_row = F.least("max_r", F.lit(max_rows))
    blocks = (
        anchors.where((F.col("min_r") <= last_row) & (F.col("min_c") <= max_cols))
        .select(
            "*", F.explode(F.sequence("min_r", last_row, F.lit(ROWS_PER_TASK))).alias("block_r")
        )
        .withColumn("block_end", F.least(F.col("block_r") + ROWS_PER_TASK - 1, last_row))
        .repartition("workbook", "sheet", "min_r", "min_c", "block_r")
    )
    rows = blocks.select("*", F.explode(F.sequence("block_r", "block_end")).alias("r"))
    covered = rows.select(
        "workbook",
        "sheet",
        "r",
        F.explode(F.sequence("min_c", F.least("max_c", F.lit(max_cols)))).alias("c"),
        "value",
        "kind",
        "min_r",
        "min_c",
    ).where((F.col("r") != F.col("min_r")) | (F.col("c") != F.col("min_c")))
    # Only cells that some range covers are looked up, so a small set of ranges
    # never makes the whole grid shuffle.
    taken = cells.select(*CELL_KEY).join(covered.select(*CELL_KEY), CELL_KEY, "left_semi")
    added = covered.join(taken, CELL_KEY, "left_anti").select(*CELL_KEY, "value", "kind")
    return cells.select(*CELL_KEY, "value", "kind", F.lit("cell").alias("origin")).unionByName(
        added.withColumn("origin", F.lit("merge"))
    )
