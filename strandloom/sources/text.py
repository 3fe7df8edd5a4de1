"""Readers of the text formats, each with a fixed schema and the order of lines where it matters.

``paths`` maps a sample to its file; a ``.gz`` file is decompressed by its extension and is one partition. ``ord`` counts
up with the lines of a file: within a partition by place, over partitions by file offset.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.gtf import SPACE, trimmed
from strandloom.operators.samples import check_sheet, clean_sheet
from strandloom.shared import if_small

# Fixed value: the mandatory fields of an alignment line.
SAM_FIELDS = ("query_name", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, ord bigint, line string) of text files; lines end at a line feed. ``ord`` rises within a file."""
    rows = spark.read.option("lineSep", "\n").text(list(paths))
    # Blocks of a file are read in any order; the offset of a row's block, then its place in the partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), place.alias("at")).alias("o"), F.col("value").alias("line"))
    return placed.select("file", (F.shiftleft(F.col("o.block").cast("bigint"), 20) + F.col("o.at")).alias("ord"), "line")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _of_samples(rows: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """``rows`` of one read over the files of ``paths``, with the hidden file path in column file: sample_id instead.

    A path may be a folder of part files; a file that is two samples' is read once and gives both its rows.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    files = []
    for sample, path in paths.items():
        p = jvm.org.apache.hadoop.fs.Path(path)
        system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files += [(s.getPath().toString(), sample) for s in system.listStatus(p)]
    return rows.join(if_small(spark.createDataFrame(files, "file string, sample_id string")), "file").drop("file")


def sample_lines(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(sample_id, ord, line) of each sample's file, in one read over all of them."""
    if not paths:
        return spark.createDataFrame([], "sample_id string, ord bigint, line string")
    return _of_samples(lines(spark, *dict.fromkeys(paths.values())), paths).select("sample_id", "ord", "line")


def _content(df: DataFrame) -> DataFrame:
    """Lines that are neither comments (by their first character) nor blank."""
    return df.where(~F.col("line").startswith("#") & (trimmed(F.col("line")) != ""))


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample_idx bigint and the sheet's columns): sample_id and fastq_path are required, workdir may be missing."""
    rows = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', inferSchema=False)
    check_sheet(rows)
    return clean_sheet(rows.withColumn("sample_idx", F.monotonically_increasing_id()))


def read_assignments(raw: DataFrame) -> DataFrame:
    """(sample_id, ord, read_id, gene_id) of whitespace-separated ``raw`` lines with at least five fields."""
    parts = F.filter(F.split("line", f"{SPACE}+"), lambda x: x != "")
    rows = _content(raw).select("sample_id", "ord", parts.alias("p")).where(F.size("p") >= 5)
    return rows.select("sample_id", "ord", F.get("p", F.lit(0)).alias("read_id"), F.get("p", F.lit(4)).alias("gene_id"))


def transcript_reads(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(sample_id, ord, read_id, transcript_id) of tab-separated files with quoting; a missing second field is null."""
    rows = spark.read.csv(list(dict.fromkeys(paths.values())), sep="\t", quote='"', escape='"', multiLine=True, schema="read_id string, transcript_id string", mode="PERMISSIVE", nullValue="\0", emptyValue="")
    rows = rows.select("read_id", "transcript_id", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ord"))
    rows = rows.where(F.col("read_id").isNotNull() & ~F.col("read_id").startswith("#"))
    return _of_samples(rows, paths).select("sample_id", "ord", "read_id", "transcript_id")


def alignments(raw: DataFrame) -> DataFrame:
    """SAM ``raw`` lines without the header: the fields, tags, and query_length: that of the sequence, 0 if there is none."""
    fields = F.split("line", "\t")
    rows = raw.where(~F.col("line").startswith("@") & (F.col("line") != "")).select("sample_id", "ord", fields.alias("f")).where(F.size("f") >= len(SAM_FIELDS))
    named = rows.select("sample_id", "ord", *(F.get("f", F.lit(i)).alias(n) for i, n in enumerate(SAM_FIELDS)), F.slice("f", F.lit(len(SAM_FIELDS) + 1), F.greatest(F.size("f") - len(SAM_FIELDS), F.lit(0))).alias("tags"))
    whole = {n: F.col(n).cast("int") for n in ("flag", "pos", "mapq", "pnext", "tlen")}
    return named.withColumns(whole | {"query_length": F.when(F.col("seq") == "*", 0).otherwise(F.length("seq"))})


def bu_csv(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """BU tables as written, all strings, with sample_id and first_ord; a line that repeats the header is none of the rows.

    The header tells the columns, the same for all samples; status may be missing.
    """
    every = list(dict.fromkeys(paths.values()))
    head = spark.read.text(every[0]).where(F.col("value").startswith("bu,")).first()
    names = (head["value"] if head else "bu").strip().split(",")
    rows = spark.read.csv(every, quote='"', escape='"', schema=", ".join(f"`{n}` string" for n in names))
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("first_ord"))
    return _of_samples(rows.where(~F.col(names[0]).eqNullSafe(names[0])), paths)


def passing_transcripts(raw: DataFrame, min_reads: int) -> DataFrame:
    """(sample_id, transcript_id) of count-matrix CSV ``raw`` lines whose counts sum to at least ``min_reads``.

    Empty cells count nothing; a row with a cell that is no number has sum 0. The first line is the header.
    """
    first = raw.groupBy("sample_id").agg(F.min("ord").alias("header"))
    body = raw.join(first, "sample_id").where((F.col("ord") > F.col("header")) & (F.col("line") != "")).withColumn("c", F.split("line", ","))
    numbers = F.transform(F.filter(F.slice("c", F.lit(2), F.greatest(F.size("c") - 1, F.lit(0))), lambda x: x != ""), lambda x: x.try_cast("double"))
    total = F.when(F.exists(numbers, lambda x: x.isNull()), 0.0).otherwise(F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x))
    return body.where(total >= min_reads).select("sample_id", F.regexp_replace(F.get("c", F.lit(0)), '^"|"$', "").alias("transcript_id")).distinct()


def cell_list(spark: SparkSession, path: str) -> DataFrame:
    """(ord, cell): the non-blank lines of a column file, trimmed, in their order."""
    return lines(spark, path).select("ord", trimmed(F.col("line")).alias("cell")).where("cell <> ''")
