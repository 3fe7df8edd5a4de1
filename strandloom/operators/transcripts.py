"""Second-pass transcript reads and representatives to transcript-by-cell counts, in sparse long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.readid import cell_name
from strandloom.operators.molecules import representatives


def reads_once(reads: DataFrame) -> DataFrame:
    """(read_id) that occur on exactly one line; ``*`` lines and lines without a transcript count as occurrences."""
    return reads.groupBy("read_id").agg(F.count("*").alias("n")).where("n = 1").select("read_id")


def representative_cells(bus: DataFrame, sheet: DataFrame, sep: str = "_", append_sample: bool = True) -> DataFrame:
    """(read_id, cell) of representatives; a read of several samples takes the last of the sheet, there the last BU."""
    rows = representatives(bus).where(F.col("barcode").isNotNull()).join(sheet.select("sample_id", "sample_idx"), "sample_id")
    cell = cell_name(F.col("barcode"), F.col("sample_id") if append_sample else None, sep)
    last = F.max(F.struct("sample_idx", "first_ord", cell.alias("cell")))
    return rows.groupBy("read_id").agg(last.alias("last")).select("read_id", "last.cell")


def counted_reads(reads: DataFrame, cells: DataFrame) -> DataFrame:
    """(ord, transcript_id, cell): the lines that count: a transcript, a read on one line, and a representative.

    One aggregate over the read finds those on one line and keeps their line, so the lines are scanned and shuffled once.
    """
    once = reads.groupBy("read_id").agg(F.count("*").alias("n"), F.min("ord").alias("ord"), F.min("transcript_id").alias("transcript_id")).where("n = 1 and transcript_id <> '*'")
    return once.join(cells, "read_id").select("ord", "transcript_id", "cell")


def transcript_matrix(counted: DataFrame) -> DataFrame:
    """(transcript_id, cell, n bigint)."""
    return counted.groupBy("transcript_id", "cell").agg(F.count("*").alias("n"))


def row_order(counted: DataFrame) -> DataFrame:
    """(transcript_id, first_ord): rows in order of their first counted line."""
    return counted.groupBy("transcript_id").agg(F.min("ord").alias("first_ord"))
