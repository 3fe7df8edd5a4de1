"""The whole flow over a project folder: from each sample's files to matrices that share their cells and a consensus annotation.

Barcode calling, alignment and isoform discovery are other programs; their files are the input: in each sample's folder the
sorted alignments as SAM text, in its OUT folder the read assignments, transcript reads and annotation of the first pass.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators import alignments as aln
from strandloom.operators import annotation as ann
from strandloom.operators import features as feat
from strandloom.operators import genes, matrix, molecules, samples, transcripts
from strandloom.shared import written
from strandloom.sinks import files
from strandloom.sources import text

STEPS = ("bu", "genes", "filter", "collapse", "database", "transcripts")


@dataclass(frozen=True)
class Names:
    """File names within a sample's folder or its OUT folder, and below the project."""

    alignments: str = "{sample_id}_sorted.sam"
    assignments: str = "OUT.read_assignments.tsv.gz"
    reads: str = "OUT.transcript_model_reads.tsv.gz"
    annotation: str = "OUT.transcript_models.gtf"
    counts: str = "transcript_matrix.csv"
    bu: str = "{sample_id}_bu.csv"
    lengths: str = "OUT.transcript_model_reads_with_length.tsv.gz"
    second_reads: str = "multisample/OUT/OUT.transcript_model_reads.tsv.gz"
    matrices: str = "multisample/matrices"
    merged: str = "multisample/merged"
    consensus: str = "multisample/consensus"


def _save(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def _cell_axis(spark: SparkSession, path: str, bus: DataFrame, sep: str, append_sample: bool) -> DataFrame:
    """(cell, idx) of the cell file in its order; where it is missing or has no cell, the cells of the BUs in name order."""
    if text.exists(spark, path):
        axis = matrix.numbered(text.cell_list(spark, path), "ord").select("cell", "idx")
        if not axis.isEmpty():
            return axis
    return matrix.numbered(matrix.unique_cells(bus, sep, append_sample), "cell")


def run(spark: SparkSession, sheet_path: str, project: str, skip: Collection[str] = (), names: Names = Names(), sep: str = "_", append_sample: bool = True, nonzero: bool = False, min_reads: int = ann.MIN_READS, min_samples: int = ann.MIN_SAMPLES, end_tol: int = ann.END_TOL, junction_tol: int = ann.JUNCTION_TOL) -> dict[str, DataFrame]:
    """Runs the steps that aren't in ``skip`` and writes their files; gives their tables by name.

    The sample sheet is read once, each sample's paths come from it; a sample sheet with a repeated id is refused. Cells are
    named by sample and barcode with ``sep`` between, or without ``append_sample`` by the barcode alone. ``nonzero``: the
    transcript counts are also written as a table of their non-zeros.
    """
    project = project.rstrip("/")
    sheet = written(samples.resolve_dirs(samples.check_unique(text.sample_sheet(spark, sheet_path)), project), "sheet")
    files.write_manifest(sheet, f"{project}/multisample/resolved_samples.tsv")
    rows = sheet.orderBy("sample_idx").collect()  # one row for each sample
    at = lambda name: {r["sample_id"]: f"{r['out_dir']}/{name.format(sample_id=r['sample_id'])}" for r in rows}
    beside = lambda name: {r["sample_id"]: f"{r['sample_dir']}/{name.format(sample_id=r['sample_id'])}" for r in rows}
    out: dict[str, DataFrame] = {"sheet": sheet}
    reads = text.transcript_reads(spark, at(names.reads))
    align = text.alignments(text.sample_lines(spark, beside(names.alignments)))
    if "bu" not in skip:
        lengths = written(molecules.read_lengths(reads, align), "lengths")
        out["bus"] = bus = written(molecules.bu_table(lengths), "bus")
        files.write_read_lengths(lengths, at(names.lengths))
        files.write_bu_csv(bus, at(names.bu))
    else:
        out["bus"] = bus = written(text.bu_csv(spark, at(names.bu)), "bus")
    matrices = f"{project}/{names.matrices}"
    if "genes" not in skip:
        counts = written(genes.gene_matrix(text.read_assignments(text.sample_lines(spark, at(names.assignments))), sep, append_sample), "genes")
        cells = matrix.shared_cells(counts, matrix.unique_cells(bus, sep, append_sample))
        row_axis, cell_axis = files.axes(counts, cells, "gene_id")
        files.write_matrix_market(counts, row_axis, cell_axis, "gene_id", f"{matrices}/gene_matrix")
        files.write_axis(cell_axis, "cell", f"{matrices}/shared_barcodes.txt")
        files.write_matrix_csv(counts, row_axis, cell_axis, "gene_id", f"{matrices}/gene_matrix.csv.gz", "gene_id")
        out |= {"genes": counts, "cells": cell_axis}
    if "filter" not in skip:
        kept = written(aln.filtered(align, aln.valid_reads(reads)), "filtered")
        filtered = files.write_filtered(kept, f"{project}/{names.merged}/filtered", list(beside(names.alignments)))
        out["alignments"] = _save(aln.merged(kept), f"{project}/{names.merged}/all_samples_merged.parquet")
        files.write_filter_stats(aln.filter_stats(align, reads, kept, sheet), filtered, f"{project}/{names.merged}/filtering_statistics.tsv")
    gtf = f"{project}/{names.consensus}/consensus.gtf"
    if "collapse" not in skip:
        records = written(ann.gtf_records(text.sample_lines(spark, at(names.annotation))), "records")
        # Count matrices of the first pass are optional: a sample without one keeps all of its transcripts.
        held = {s: p for s, p in at(names.counts).items() if text.exists(spark, p)}
        passing = text.passing_transcripts(text.sample_lines(spark, held), min_reads) if held else None
        tx = ann.placed(ann.assembled(ann.features_of(records), passing), sheet)
        out["consensus"] = final = written(ann.consensus(tx, end_tol, junction_tol, min_samples), "consensus")
        files.write_gtf(ann.gtf_lines(final), gtf)
        files.write_statistics(ann.statistics(tx, final, sheet), f"{project}/{names.consensus}/integrated_statistics.csv")
    if "database" not in skip:
        records = written(ann.gtf_records(text.sample_lines(spark, {"consensus": gtf})), "records")
        out["features"] = table = written(feat.features(records), "features")
        out["relations"] = relations = feat.relations(table)
        files.write_features(table, relations, f"{project}/{names.consensus}/database")
    if "transcripts" not in skip:
        second = text.transcript_reads(spark, {"merged": f"{project}/{names.second_reads}"})
        counted = written(transcripts.counted_reads(second, transcripts.representative_cells(bus, sheet, sep, append_sample)), "counted")
        cells = out["cells"] if "cells" in out else _cell_axis(spark, f"{matrices}/shared_barcodes.txt", bus, sep, append_sample)
        out["transcripts"] = counts = written(matrix.reindexed(transcripts.transcript_matrix(counted), cells), "transcripts")
        row_axis = matrix.numbered(transcripts.row_order(counted), "first_ord").select("transcript_id", "idx")
        files.write_matrix_market(counts, row_axis, cells, "transcript_id", f"{matrices}/transcript_matrix")
        files.write_csr(counts, row_axis, cells, "transcript_id", f"{matrices}/transcript_matrix_csr")
        files.write_matrix_csv(counts, row_axis, cells, "transcript_id", f"{matrices}/transcript_matrix.csv.gz")
        if nonzero:
            files.write_nonzero(counts, row_axis, cells, f"{matrices}/nonzero.tsv.gz")
    return out
