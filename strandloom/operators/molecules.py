"""Transcript reads and alignments to one representative read for each barcode-UMI (BU)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.readid import with_molecule

AMBIGUOUS, UNIQUE = "ambiguous", "unique"


def last_transcripts(reads: DataFrame) -> DataFrame:
    """(sample_id, read_id, transcript_id): the last line of each read by ``ord``; lines without a transcript field don't count."""
    return reads.where(F.col("transcript_id").isNotNull()).groupBy("sample_id", "read_id").agg(F.max_by("transcript_id", "ord").alias("transcript_id"))


def read_lengths(reads: DataFrame, alignments: DataFrame) -> DataFrame:
    """(sample_id, ord, read_id, transcript_id, read_length int): a row for each alignment of a mapped read, length 0 if unknown."""
    aligned = alignments.select("sample_id", F.col("query_name").alias("read_id"), F.coalesce("query_length", F.lit(0)).cast("int").alias("read_length"), "ord")
    return aligned.join(last_transcripts(reads), ["sample_id", "read_id"]).select("sample_id", "ord", "read_id", "transcript_id", "read_length")


def bu_table(lengths: DataFrame, strict: bool = True) -> DataFrame:
    """One row for each BU with a transcript: (sample_id, bu, barcode, umi, read_id, transcript_id, read_length, status, first_ord).

    A BU of one transcript is unique and represented by its longest read, ties by the smaller read id; a BU of several is
    ambiguous: read and transcript are named so and its length is null. Rows of transcript ``*`` don't count. All of it
    aggregates before the shuffle. An empty table gives an empty table; with ``strict`` an unparsable read id fails.
    """
    rows = with_molecule(lengths.where(F.col("transcript_id") != "*"), strict=strict)
    groups = rows.groupBy("sample_id", "bu").agg(
        F.min("barcode").alias("barcode"),
        F.min("umi").alias("umi"),
        F.min("transcript_id").alias("lo"),
        F.max("transcript_id").alias("hi"),
        F.min(F.struct((-F.col("read_length")).alias("short"), "read_id")).alias("best"),
        F.min("ord").alias("first_ord"),
    )
    one = F.col("lo") == F.col("hi")
    return groups.select(
        "sample_id",
        "bu",
        "barcode",
        "umi",
        F.when(one, F.col("best.read_id")).otherwise(AMBIGUOUS).alias("read_id"),
        F.when(one, F.col("lo")).otherwise(AMBIGUOUS).alias("transcript_id"),
        F.when(one, -F.col("best.short")).cast("int").alias("read_length"),
        F.when(one, UNIQUE).otherwise(AMBIGUOUS).alias("status"),
        "first_ord",
    )


def representatives(bus: DataFrame) -> DataFrame:
    """The rows of unique BUs: by ``status`` if there is such a column, else by the read id."""
    return bus.where(F.col("status") == UNIQUE) if "status" in bus.columns else bus.where(F.col("read_id") != AMBIGUOUS)
