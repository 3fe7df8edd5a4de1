"""Alignments of reads with a transcript, over all samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_reads(reads: DataFrame) -> DataFrame:
    """(sample_id, read_id) of reads with any line whose transcript isn't ``*``."""
    return reads.where(F.col("transcript_id") != "*").select("sample_id", "read_id").distinct()


def filtered(alignments: DataFrame, valid: DataFrame) -> DataFrame:
    """The alignments of valid reads, unchanged."""
    return alignments.join(valid.withColumnRenamed("read_id", "query_name"), ["sample_id", "query_name"], "left_semi").select(*alignments.columns)


def filter_stats(alignments: DataFrame, reads: DataFrame, kept: DataFrame, sheet: DataFrame) -> DataFrame:
    """(sample_id, valid_read_ids, reads_in_bam, reads_written): a row for each sample of the sheet; alignments are counted."""
    count = lambda df, name: df.groupBy("sample_id").agg(F.count("*").alias(name))
    parts = [count(valid_reads(reads), "valid_read_ids"), count(alignments, "reads_in_bam"), count(kept, "reads_written")]
    out = sheet.select("sample_id")
    for p in parts:
        out = out.join(p, "sample_id", "left")
    return out.fillna(0, ["valid_read_ids", "reads_in_bam", "reads_written"])


def merged(alignments: DataFrame, by: Sequence[str] = ("rname", "pos")) -> DataFrame:
    """All samples' alignments in order of ``by``: range partitions, sorted within, so the files read in order are sorted."""
    return alignments.repartitionByRange(*by).sortWithinPartitions(*by)
