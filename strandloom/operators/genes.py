"""Read assignments to gene-by-cell counts of molecules with one gene, in sparse long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.readid import NO_FEATURE, cell_name, with_molecule


def assigned_reads(df: DataFrame) -> DataFrame:
    """(sample_id, read_id, gene_id) of the rows with a gene."""
    return df.where(F.col("gene_id").isNotNull() & ~F.col("gene_id").isin(*NO_FEATURE)).select("sample_id", "read_id", "gene_id")


def molecule_genes(df: DataFrame) -> DataFrame:
    """(sample_id, barcode, umi, first_gene, last_gene) of each molecule; it has one gene if both are the same.

    Two extremes aggregate before the shuffle, whatever the number of rows of a molecule. Reads whose name doesn't parse
    are left out; rows without a gene neither count nor make a molecule ambiguous.
    """
    reads = with_molecule(assigned_reads(df))
    return reads.groupBy("sample_id", "barcode", "umi").agg(F.min("gene_id").alias("first_gene"), F.max("gene_id").alias("last_gene"))


def single_gene(molecules: DataFrame) -> DataFrame:
    return molecules.where(F.col("first_gene") == F.col("last_gene")).select("sample_id", "barcode", "umi", F.col("first_gene").alias("gene_id"))


def several_genes(molecules: DataFrame) -> DataFrame:
    return molecules.where(F.col("first_gene") != F.col("last_gene"))


def gene_matrix(df: DataFrame, sep: str = "_", append_sample: bool = True) -> DataFrame:
    """(gene_id, cell, n bigint): molecules of each gene in each cell. An empty table gives an empty matrix."""
    cell = cell_name(F.col("barcode"), F.col("sample_id") if append_sample else None, sep)
    return single_gene(molecule_genes(df)).groupBy("gene_id", cell.alias("cell")).agg(F.count("*").alias("n"))
