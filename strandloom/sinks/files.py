"""Writers of the output formats.

Tables are written by Spark's tasks as ordered part files. An output of at most ONE_FILE_BYTES is then made one file; a
larger one stays a folder of that name with its part files, which read in order of their names are that file.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.matrix import dense_rows, numbered, triplets
from strandloom.shared import if_small

#: Bytes of part files that are copied into one file; what is larger stays as its tasks wrote it.
ONE_FILE_BYTES = 64 << 20
#: Non-zeros of one file of compressed sparse rows, and the rest of its last row.
CSR_NONZEROS = 1 << 24

# The columns and head lines of the formats.
BU_COLUMNS = ("bu", "barcode", "umi", "read_id", "transcript_id", "read_length", "status")
LENGTH_COLUMNS = ("read_id", "transcript_id", "read_length")
STATISTICS_COLUMNS = ("sample_id", "valid_read_ids", "reads_in_bam", "reads_written", "output_bam")
MANIFEST_COLUMNS = ("sample_id", "fastq_path", "workdir", "sample_dir", "out_dir")
NONZERO_COLUMNS = ("transcript_id", "sampleid_barcode", "count")
GTF_HEAD = "# Consensus transcript annotation\n"
MATRIX_HEAD = "%%MatrixMarket matrix coordinate integer general\n%\n"

GTF_ORDER = ("chrom", "strand", "start", "end", "transcript_id", "level", "exon_number")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _settle(spark: SparkSession, folder: str, path: str, head: str = "") -> None:
    """Moves the part files of ``folder`` (there are none if it is missing) to ``path``, after ``head``: as one file or as a folder."""
    jvm, source, system = _hadoop(spark, folder)
    new = jvm.org.apache.hadoop.fs.Path
    target = new(path)
    parts = sorted((s for s in system.listStatus(source) if s.getPath().getName().startswith("part-")), key=lambda s: s.getPath().getName()) if system.exists(source) else []
    start = gzip.compress(head.encode()) if path.endswith(".gz") else head.encode()
    system.delete(target, True)
    if sum(s.getLen() for s in parts) > ONE_FILE_BYTES:
        system.rename(source, target)
        if head:
            with_head = system.create(new(target, "part--head" + (".txt.gz" if path.endswith(".gz") else ".txt")), True)  # sorts before part-0
            with_head.write(start)
            with_head.close()
        return
    out = system.create(target, True)
    try:
        if head or not parts:
            out.write(start)
        for part in parts:
            stream = system.open(part.getPath())
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
    finally:
        out.close()
    system.delete(source, True)


def _text(df: DataFrame, path: str, end: str, *by: str) -> str:
    """Writes the lines beside ``path``, compressed as it says; gives the folder."""
    folder = f"{path}-parts-{uuid.uuid4().hex}"
    writer = df.write.option("lineSep", end).option("compression", "gzip" if path.endswith(".gz") else "none")
    (writer.partitionBy(*by) if by else writer).text(folder)
    return folder


def write_lines(df: DataFrame, column: str, order: Sequence[str], path: str, head: str = "", end: str = "\n") -> None:
    """Text of ``column`` in the order of ``order``; gzipped if ``path`` says so; an empty table gives ``head`` alone."""
    _settle(df.sparkSession, _text(df.orderBy(*order).select(F.col(column).cast("string")), path, end), path, head)


def write_sample_lines(df: DataFrame, column: str, order: Sequence[str], paths: Mapping[str, str], head: str = "", end: str = "\n") -> None:
    """``write_lines`` of the rows of each sample (by sample_id) to its path in ``paths``, all in one pass over ``df``."""
    if not paths:
        return
    spark, samples = df.sparkSession, list(paths)
    numbers = spark.createDataFrame(list(enumerate(samples)), "sample_no int, sample_id string")
    rows = df.join(if_small(numbers), "sample_id").select("sample_no", *order, F.col(column).cast("string").alias("out_line"))
    sorted_rows = rows.repartitionByRange("sample_no", *order).sortWithinPartitions("sample_no", *order).select("sample_no", "out_line")
    folder = _text(sorted_rows, paths[samples[0]], end, "sample_no")
    for i, sample in enumerate(samples):
        _settle(spark, f"{folder}/sample_no={i}", paths[sample], head)
    _, source, system = _hadoop(spark, folder)
    system.delete(source, True)


def _line(columns: Sequence[str], sep: str) -> Column:
    """The delimited line of ``columns``; a field with the separator, a quote or a line end is quoted; null is empty."""
    quoted = lambda c: F.when(c.rlike(f'[{sep}"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.concat_ws(sep, *(F.coalesce(quoted(F.col(c).cast("string")), F.lit("")) for c in columns))


def write_table(df: DataFrame, order: Sequence[str], path: str, columns: Sequence[str], sep: str = ",", end: str = "\n") -> None:
    """Delimited ``columns`` after a header."""
    write_lines(df.withColumn("out_line", _line(columns, sep)), "out_line", order, path, sep.join(columns) + end, end)


def write_sample_tables(df: DataFrame, order: Sequence[str], paths: Mapping[str, str], columns: Sequence[str], sep: str = ",") -> None:
    """``write_table`` of the rows of each sample to its path in ``paths``."""
    write_sample_lines(df.withColumn("out_line", _line(columns, sep)), "out_line", order, paths, sep.join(columns) + "\n")


def write_axis(axis: DataFrame, name: str, path: str) -> None:
    """The names of a numbered axis, one a line, in order."""
    write_lines(axis, name, ["idx"], path)


def write_matrix_market(matrix: DataFrame, rows: DataFrame, cells: DataFrame, row: str, prefix: str) -> None:
    """``prefix``.mtx (coordinates, integer, general) with ``prefix``_rows.txt and ``prefix``_cols.txt."""
    at = triplets(matrix, rows, cells, row)
    size = at.agg(F.count("*")).first()[0]
    head = f"{MATRIX_HEAD}{rows.count()} {cells.count()} {size}\n"
    write_lines(at.withColumn("line", F.concat_ws(" ", "row_idx", "col_idx", "n")), "line", ["row_idx", "col_idx"], f"{prefix}.mtx", head)
    write_axis(rows, row, f"{prefix}_rows.txt")
    write_axis(cells, "cell", f"{prefix}_cols.txt")


def write_matrix_csv(matrix: DataFrame, rows: DataFrame, cells: DataFrame, row: str, path: str, corner: str = "") -> None:
    """A dense CSV over the given axes, one line a row; ``corner`` is the first header field. Every row name gets a line."""
    held = dense_rows(matrix, cells, row)
    width = cells.count()
    empty = F.expr(f"concat('0', repeat(',0', {width - 1}))") if width else F.lit("")
    full = rows.join(held, row, "left").select("idx", F.concat(F.col(row), F.lit(","), F.coalesce("line", empty)).alias("line"))
    head = cells.groupBy().agg(F.array_join(F.array_sort(F.collect_list("cell")), ",").alias("line")).select(F.lit(0).alias("idx"), F.concat(F.lit(corner + ","), "line").alias("line"))
    write_lines(head.unionByName(full.withColumn("idx", (F.col("idx") + 1).cast("int"))), "line", ["idx"], path)


def write_csr(matrix: DataFrame, rows: DataFrame, cells: DataFrame, row: str, folder: str, nonzeros: int = CSR_NONZEROS) -> int:
    """The matrix as compressed sparse rows: ``folder``/matrix-<k>.npz hold its rows in order, transcripts.txt and barcodes.txt the
    axes; gives the number of files.

    Each file is a valid .npz (indices, indptr, format, shape, data), written by a task; stacked in order they are the
    matrix. A file ends with the row that takes it beyond ``nonzeros``, so a task holds that many and one row.
    """
    n_rows, n_cells = rows.count(), cells.count()
    at = triplets(matrix, rows, cells, row).select((F.col("row_idx") - 1).alias("r"), (F.col("col_idx") - 1).alias("c"), F.col("n").cast("int").alias("n"))
    # A row belongs to the file in which its first non-zero falls; a number for each file comes to the driver.
    slots = numbered(at, "r", "c", name="k").groupBy("r").agg(F.floor(F.min("k") / nonzeros).alias("slot"))
    begins = [(r["slot"], r["r"]) for r in slots.groupBy("slot").agg(F.min("r").alias("r")).orderBy("slot").collect()] or [(0, 0)]
    edges = [0, *(r for _, r in begins[1:]), n_rows]
    numbers = matrix.sparkSession.createDataFrame([(slot, k) for k, (slot, _) in enumerate(begins)], "slot bigint, file_no int")
    every = numbers.select("file_no", F.lit(-1).cast("bigint").alias("r"), F.lit(-1).cast("bigint").alias("c"), F.lit(0).alias("n"))  # also a file without a count
    held_at = at.join(slots, "r").join(if_small(numbers), "slot").select("file_no", "r", "c", "n").unionByName(every)
    placed = held_at.repartitionById(len(begins), "file_no").sortWithinPartitions("r", "c")
    system, inner = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    system.create_dir(inner, recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = TaskContext.get().partitionId()
        held = pd.concat(list(batches)).query("r >= 0")
        height = edges[k + 1] - edges[k]
        counts = np.bincount(held["r"].to_numpy(np.int64) - edges[k], minlength=height)
        out = io.BytesIO()
        np.savez_compressed(out, indices=held["c"].to_numpy(np.int32), indptr=np.r_[0, np.cumsum(counts)].astype(np.int32), format=np.array(b"csr"), shape=np.array([height, n_cells]), data=held["n"].to_numpy(np.int32))
        with fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")[0].open_output_stream(f"{inner}/matrix-{k:05d}.npz") as f:
            f.write(out.getvalue())
        yield pd.DataFrame({"file_no": [k]})

    write_axis(rows, row, f"{folder}/transcripts.txt")
    write_axis(cells, "cell", f"{folder}/barcodes.txt")
    return placed.mapInPandas(run, "file_no int").count()


def write_nonzero(matrix: DataFrame, rows: DataFrame, cells: DataFrame, path: str) -> None:
    """The non-zero counts with the names of their transcripts and cells, row by row."""
    placed = matrix.join(rows.select("transcript_id", F.col("idx").alias("row_idx")), "transcript_id").join(cells.select("cell", F.col("idx").alias("col_idx")), "cell")
    named = placed.select("row_idx", "col_idx", "transcript_id", F.col("cell").alias("sampleid_barcode"), F.col("n").cast("int").alias("count"))
    write_table(named, ["row_idx", "col_idx"], path, NONZERO_COLUMNS, sep="\t", end="\r\n")


def write_bu_csv(bus: DataFrame, paths: Mapping[str, str]) -> None:
    """Each sample's BU table in order of first appearance; the length of an ambiguous BU reads ``ambiguous``."""
    out = bus.withColumn("read_length", F.coalesce(F.col("read_length").cast("string"), F.lit("ambiguous")))
    write_sample_tables(out, ["first_ord"], paths, BU_COLUMNS)


def write_read_lengths(lengths: DataFrame, paths: Mapping[str, str]) -> None:
    write_sample_tables(lengths, ["ord"], paths, LENGTH_COLUMNS, sep="\t")


def write_filtered(alignments: DataFrame, folder: str, samples: Sequence[str]) -> dict[str, str]:
    """Each sample's filtered alignments as a folder of Parquet files, in one pass; gives the folders by sample."""
    spark = alignments.sparkSession
    numbers = spark.createDataFrame(list(enumerate(samples)), "sample_no int, sample_id string")
    alignments.join(if_small(numbers), "sample_id").repartitionByRange("sample_no", "ord").write.mode("overwrite").partitionBy("sample_no").parquet(folder)
    jvm, _, system = _hadoop(spark, folder)
    out = {}
    for i, sample in enumerate(samples):
        source, out[sample] = jvm.org.apache.hadoop.fs.Path(f"{folder}/sample_no={i}"), f"{folder}/{sample}_filtered.parquet"
        target = jvm.org.apache.hadoop.fs.Path(out[sample])
        system.rename(source, target) if system.exists(source) else system.mkdirs(target)
    return out


def write_filter_stats(stats: DataFrame, filtered: Mapping[str, str], path: str) -> None:
    """Counts of each sample, with the place of its filtered alignments in the last column."""
    places = stats.sparkSession.createDataFrame(list(filtered.items()), "sample_id string, output_bam string")
    write_table(stats.join(if_small(places), "sample_id"), ["sample_id"], path, STATISTICS_COLUMNS, sep="\t", end="\r\n")


def write_manifest(sheet: DataFrame, path: str) -> None:
    """The resolved sample sheet; further columns are left out."""
    write_table(sheet, ["sample_idx"], path, MANIFEST_COLUMNS, sep="\t", end="\r\n")


def write_statistics(stats: DataFrame, path: str) -> None:
    """Two blocks in one CSV: metrics, a blank row, samples."""
    spark = stats.sparkSession
    extra = spark.createDataFrame([(0, -1, "metric,value"), (1, -2, ""), (1, -1, "sample_id,transcripts_after_read_filter")], "section int, place bigint, line string")
    body = stats.select("section", "place", F.concat_ws(",", "name", F.col("value").cast("string")).alias("line"))
    write_lines(extra.unionByName(body), "line", ["section", "place"], path, end="\r\n")


def write_gtf(lines: DataFrame, path: str) -> None:
    write_lines(lines, "line", GTF_ORDER, path, GTF_HEAD)


def write_features(features: DataFrame, relations: DataFrame, folder: str) -> None:
    """Parquet tables for lookups: features by type, sorted by place, and relations by parent; statistics serve as index."""
    features.repartitionByRange("featuretype", "seqid", "start").sortWithinPartitions("featuretype", "seqid", "start").write.mode("overwrite").partitionBy("featuretype").parquet(f"{folder}/features")
    relations.repartitionByRange("parent").sortWithinPartitions("parent", "child").write.mode("overwrite").parquet(f"{folder}/relations")


def axes(matrix: DataFrame, cells: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """Numbered axes (row, idx) and (cell, idx) in name order."""
    return numbered(matrix.select(row).distinct(), row), numbered(cells.select("cell").distinct(), "cell")

