"""Sparse matrices in long form (row, cell, n) and their axes."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.readid import cell_name
from strandloom.operators.molecules import representatives
from strandloom.shared import if_small, written


def numbered(df: DataFrame, *order: str | Column, name: str = "idx") -> DataFrame:
    """``df`` with its place in the order, from 0, without moving it to one task.

    A sorted table is written with each row's partition and place; partitions' sizes, one number each, give the offsets.
    """
    place = F.monotonically_increasing_id()
    table = written(df.orderBy(*order).withColumn("part_no", F.shiftright(place, 33)).withColumn("part_at", place.bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    sizes = sorted((r["part_no"], r["n"]) for r in table.groupBy("part_no").agg(F.count("*").alias("n")).collect())
    before = accumulate((n for _, n in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame([(part, at) for (part, _), at in zip(sizes, before)], "part_no bigint, part_from bigint")
    return table.join(if_small(offsets), "part_no").withColumn(name, F.col("part_from") + F.col("part_at")).drop("part_no", "part_at", "part_from")


def unique_cells(bus: DataFrame, sep: str = "_", append_sample: bool = True) -> DataFrame:
    """(cell) of the unique BUs."""
    cell = cell_name(F.col("barcode"), F.col("sample_id") if append_sample else None, sep)
    return representatives(bus).where(F.col("barcode").isNotNull()).select(cell.alias("cell")).distinct()


def shared_cells(*parts: DataFrame) -> DataFrame:
    """(cell): the union of all parts' cells without the empty name: the columns of every matrix."""
    every = parts[0].select("cell")
    for p in parts[1:]:
        every = every.unionByName(p.select("cell"))
    return every.where("cell <> ''").distinct()


def reindexed(matrix: DataFrame, cells: DataFrame) -> DataFrame:
    """``matrix`` without the cells that aren't among ``cells``; cells without a count exist on the axis only."""
    return matrix.join(cells.select("cell"), "cell", "left_semi").select(*matrix.columns)


def dense_rows(matrix: DataFrame, cells: DataFrame, row: str) -> DataFrame:
    """(row, line): the counts of a row over all cells in name order, zeros filled in, joined by commas.

    The axis is numbered and a row holds its own counts only; the zeros between them are written by their number, so
    the axis may have any length for which a line is a string. A matrix or an axis without rows gives none.
    """
    axis = numbered(cells.select("cell").where("cell is not null").distinct(), "cell", name="at")
    width = axis.count()
    count = F.struct("at", F.coalesce(F.col("n").cast("int"), F.lit(0)).alias("n"))
    held = matrix.join(if_small(axis), "cell", "left").groupBy(row).agg(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), count))).alias("held"))
    before = "coalesce(get(held, i - 1).at, -1)"
    counts = f"array_join(transform(held, (x, i) -> if(x.at = {before}, raise_error('a cell occurs twice in a row'), concat(repeat('0,', cast(x.at - {before} - 1 as int)), x.n))), ',')"
    line = f"if(size(held) = 0, concat('0', repeat(',0', {width - 1})), concat({counts}, repeat(',0', cast({width - 1} - get(held, size(held) - 1).at as int))))"
    return held.where(F.lit(width > 0)).select(row, F.expr(line).alias("line"))


def triplets(matrix: DataFrame, rows: DataFrame, cells: DataFrame, row: str) -> DataFrame:
    """(row_idx, col_idx, n), both from 1, of numbered axes (row, idx) and (cell, idx)."""
    at_row = matrix.join(rows.select(row, (F.col("idx") + 1).alias("row_idx")), row)
    return at_row.join(cells.select("cell", (F.col("idx") + 1).alias("col_idx")), "cell").select("row_idx", "col_idx", "n")


def pivoted(matrix: DataFrame, row: str, cells: list[str]) -> DataFrame:
    """A small wide table of the named cells, zeros filled in; long form is the rule."""
    return matrix.groupBy(row).pivot("cell", cells).agg(F.sum("n")).fillna(0)
