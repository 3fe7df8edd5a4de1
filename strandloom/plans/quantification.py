"""Queries of the quantification and annotation operators over the driver's tables, and the SQL that checks them.

read_assignments serve as the assignments and, by isoform, as the second pass's transcript reads; bu_reads as the first
pass's transcript reads and as alignments; transcripts as each sample's annotation, written out as GTF lines first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.gtf import attribute, junctions, strand_ends
from strandloom.functions.readid import with_molecule
from strandloom.operators import alignments as aln
from strandloom.operators import annotation as ann
from strandloom.operators import features as feat
from strandloom.operators import genes, matrix, molecules, samples, transcripts
from strandloom.shared import written

PROJECT = "/project"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "read_assignments")


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "bu_reads").select("sample_id", "ord", "read_id", "transcript_id")


def _alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "bu_reads").select("sample_id", "ord", F.col("read_id").alias("query_name"), F.coalesce("read_length", F.lit(0)).alias("query_length"))


def _second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assignments(spark, sf_dir).select("ord", "read_id", F.col("isoform_id").alias("transcript_id"))


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.resolve_dirs(samples.clean_sheet(table(spark, sf_dir, "samples")), PROJECT)


def _bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return molecules.bu_table(molecules.read_lengths(_reads(spark, sf_dir), _alignments(spark, sf_dir)))


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.counted_reads(_second(spark, sf_dir), transcripts.representative_cells(_bus(spark, sf_dir), _sheet(spark, sf_dir)))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.shared_cells(genes.gene_matrix(_assignments(spark, sf_dir)), matrix.unique_cells(_bus(spark, sf_dir)))


def annotation_lines(tx: DataFrame) -> DataFrame:
    """(sample_id, ord, line): a transcript line and its exon lines for each row; exons with a null bound have none."""
    attrs = F.concat(F.coalesce(F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; ')), F.lit("")), F.lit('transcript_id "'), "transcript_id", F.lit('";'))
    known = F.filter(F.coalesce("exons", F.expr("cast(array() as array<struct<exon_start: int, exon_end: int>>)")), lambda x: x["exon_start"].isNotNull() & x["exon_end"].isNotNull())
    span = F.struct(F.coalesce(F.array_min(F.transform(known, lambda x: x["exon_start"])), F.lit(1)).alias("exon_start"), F.coalesce(F.array_max(F.transform(known, lambda x: x["exon_end"])), F.lit(1)).alias("exon_end"))
    rows = tx.select("sample_id", "tx_key", "chrom", "strand", "source", attrs.alias("attrs"), F.posexplode(F.concat(F.array(span), known)).alias("i", "x"))
    kind = F.when(F.col("i") == 0, "transcript").otherwise("exon")
    dot = lambda c: F.coalesce(c, F.lit("."))
    line = F.concat_ws("\t", dot("chrom"), dot("source"), kind, F.col("x.exon_start").cast("string"), F.col("x.exon_end").cast("string"), F.lit("."), dot("strand"), F.lit("."), "attrs")
    return rows.select("sample_id", (F.shiftleft("tx_key", 12) + F.col("i")).alias("ord"), line.alias("line"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed lines, landed once: several columns come from the attributes."""
    return written(ann.gtf_records(annotation_lines(table(spark, sf_dir, "transcripts"))), "records")


def _assembled(spark: SparkSession, sf_dir: str, passing: DataFrame | None = None) -> DataFrame:
    return written(ann.in_sheet_order(ann.assembled(ann.features_of(_records(spark, sf_dir)), passing), _sheet(spark, sf_dir)), "transcripts")


def _exon_text(exons: str = "exons") -> F.Column:
    return F.array_join(F.transform(exons, lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), ",")


def read_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_molecule(_assignments(spark, sf_dir).select("ord", "read_id"))


def assignment_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genes.assigned_reads(_assignments(spark, sf_dir))


def gene_bu_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genes.single_gene(genes.molecule_genes(_assignments(spark, sf_dir)))


def gene_bu_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genes.several_genes(genes.molecule_genes(_assignments(spark, sf_dir)))


def gene_matrix_coo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genes.gene_matrix(_assignments(spark, sf_dir))


def gene_matrix_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.dense_rows(genes.gene_matrix(_assignments(spark, sf_dir)), _cells(spark, sf_dir), "gene_id")


def gene_by_sample_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules of each gene by sample as a wide table; its columns are the sheet's samples."""
    names = [r[0] for r in _sheet(spark, sf_dir).select("sample_id").orderBy("sample_idx").collect()]
    single = gene_bu_unique(spark, sf_dir).groupBy("gene_id", F.col("sample_id").alias("cell")).agg(F.count("*").alias("n"))
    return matrix.pivoted(single, "gene_id", names)


def transcript_map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return molecules.last_transcripts(_reads(spark, sf_dir))


def valid_read_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aln.valid_reads(_reads(spark, sf_dir))


def read_lengths_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return molecules.read_lengths(_reads(spark, sf_dir), _alignments(spark, sf_dir))


def bu_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The BU table as its file shows it: the length of an ambiguous BU reads so."""
    return _bus(spark, sf_dir).withColumn("read_length", F.coalesce(F.col("read_length").cast("string"), F.lit(molecules.AMBIGUOUS)))


def bu_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return molecules.representatives(_bus(spark, sf_dir)).select("sample_id", "bu", "read_id", "transcript_id", "read_length")


def alignment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aln.filtered(_alignments(spark, sf_dir), aln.valid_reads(_reads(spark, sf_dir)))


def alignment_filter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aln.filter_stats(_alignments(spark, sf_dir), _reads(spark, sf_dir), alignment_filter(spark, sf_dir), _sheet(spark, sf_dir))


def alignment_merge_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aln.merged(alignment_filter(spark, sf_dir), ["sample_id", "query_name", "ord"])


def unique_reads_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.reads_once(_second(spark, sf_dir))


def transcript_matrix_coo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.reindexed(transcripts.transcript_matrix(_counted(spark, sf_dir)), _cells(spark, sf_dir))


def transcript_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.numbered(transcripts.row_order(_counted(spark, sf_dir)), "first_ord")


def transcript_cross_sample_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.representative_cells(_bus(spark, sf_dir), _sheet(spark, sf_dir))


def shared_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.numbered(_cells(spark, sf_dir), "cell")


def mtx_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = genes.gene_matrix(_assignments(spark, sf_dir))
    rows = matrix.numbered(counts.select("gene_id").distinct(), "gene_id")
    return matrix.triplets(counts, rows, shared_barcodes(spark, sf_dir), "gene_id")


def gtf_attr_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.col("pairs")
    return _records(spark, sf_dir).select("ord", "feature", "chrom", "start", "end", attribute(pairs, "gene_id").alias("gene_id"), attribute(pairs, "transcript_id").alias("transcript_id"))


def transcript_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = strand_ends(F.col("exons"), F.col("strand"))
    return _assembled(spark, sf_dir).select("sample_id", "transcript_id", "gene_id", "chrom", "strand", "source", "is_reference", F.size("exons").alias("n_exons"), ends["five"].alias("five"), ends["three"].alias("three"), _exon_text().alias("exon_text"))


def junction_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir).select("sample_id", "transcript_id", F.posexplode(junctions(F.col("exons"))).alias("at", "j")).select("sample_id", "transcript_id", "at", "j.donor", "j.acceptor")


def reference_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir).groupBy("sample_id", "is_reference").agg(F.count("*").alias("n"))


def reference_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.last_references(_assembled(spark, sf_dir)).select("transcript_id", "sample_id", "gene_id", "chrom", "strand", _exon_text().alias("exon_text"))


def _passing(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    """Transcripts with at least ``least`` reads in their sample."""
    return _reads(spark, sf_dir).groupBy("sample_id", "transcript_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def min_reads_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir, _passing(spark, sf_dir, ann.MIN_READS)).select("sample_id", "transcript_id", "is_reference")


def min_reads_filter_empty_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir, _passing(spark, sf_dir, 1 << 40)).select("sample_id", "transcript_id", "is_reference")


def tolerance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.close_pairs(_assembled(spark, sf_dir).where("not is_reference"))


def novel_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    novel = _assembled(spark, sf_dir).where("not is_reference")
    return ann.collapsed(ann.novel_groups(novel)).select("transcript_id", "gene_id", "chrom", "strand", "n_samples", "n_members", _exon_text().alias("exon_text"))


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(ann.consensus(_assembled(spark, sf_dir)), "consensus")


def consensus_gtf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.gtf_lines(_final(spark, sf_dir)).select("line")


def integrated_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = _assembled(spark, sf_dir)
    return ann.statistics(tx, written(ann.consensus(tx), "consensus"), _sheet(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ann.gtf_lines(_final(spark, sf_dir))
    order = matrix.numbered(lines, "chrom", "strand", "start", "end", "transcript_id", "level", "exon_number", name="ord")
    return feat.features(ann.gtf_records(order.select(F.lit("consensus").alias("sample_id"), "ord", "line")))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select("featuretype", "seqid", "start", "end", "strand", "gene_id", "transcript_id")


def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.feature_counts(_features(spark, sf_dir))


def feature_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of each parent, by level."""
    return feat.relations(_features(spark, sf_dir)).groupBy("parent", "level").agg(F.count("*").alias("n"))


def sample_sheet_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sheet(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        gene_matrix_coo, read_id_parse, assignment_scan_filter, gene_bu_unique, gene_bu_ambiguous, gene_matrix_zero_filled, gene_by_sample_pivot,
        transcript_map_last_wins, valid_read_ids, read_lengths_join, bu_table, bu_representatives, alignment_filter, alignment_filter_stats, alignment_merge_sorted,
        unique_reads_once, transcript_matrix_coo, transcript_row_index, transcript_cross_sample_last_wins, shared_barcodes, mtx_triplets,
        gtf_attr_parse, transcript_assembly, junction_list, reference_split, reference_last_wins, min_reads_filter, min_reads_filter_empty_set,
        tolerance_pairs, novel_collapse, consensus_gtf_lines, integrated_statistics, feature_table, feature_counts, feature_relations, sample_sheet_resolve,
    )
}
