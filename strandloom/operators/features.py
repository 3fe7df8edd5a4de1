"""Annotation lines as tables of features and of the relations between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.gtf import attribute
from strandloom.operators.matrix import numbered

COUNTED = ("gene", "transcript", "exon")


def features(records: DataFrame, merge: bool = False) -> DataFrame:
    """(id, seqid, source, featuretype, start, end, score, strand, frame, pairs, gene_id, transcript_id) of GTF records.

    Genes and transcripts are named by their ids, exons by exon_id; what has no id is called <featuretype>_<number> in order.
    Of records of equal id the second and later get the suffix _1, _2 ...; with ``merge`` they become one record, the
    first with all their attributes, each pair once and sorted.
    """
    pairs = F.col("pairs")
    own = F.when(F.col("feature") == "gene", attribute(pairs, "gene_id")).when(F.col("feature") == "transcript", attribute(pairs, "transcript_id")).when(F.col("feature") == "exon", attribute(pairs, "exon_id"))
    rows = records.withColumns({"own": own, "gene_id": attribute(pairs, "gene_id"), "transcript_id": attribute(pairs, "transcript_id")})
    nameless = numbered(rows.where("own is null"), "feature", "ord", name="place")
    starts = nameless.groupBy("feature").agg(F.min("place").alias("from_place"))
    called = nameless.join(starts, "feature").withColumn("id", F.concat("feature", F.lit("_"), (F.col("place") - F.col("from_place") + 1).cast("string"))).drop("place", "from_place")
    named = rows.where("own is not null").withColumn("id", F.col("own"))
    if merge:
        every = called.unionByName(named)
        first = F.min_by(F.struct(*(F.col(c) for c in every.columns if c not in ("id", "pairs"))), "ord").alias("m")
        merged = every.groupBy("id").agg(first, F.array_sort(F.array_distinct(F.flatten(F.collect_list("pairs")))).alias("pairs"))
        out = merged.select("id", "m.*", "pairs")
    else:
        nth = F.row_number().over(Window.partitionBy("id").orderBy("ord"))
        out = called.unionByName(named.withColumn("nth", nth).withColumn("id", F.when(F.col("nth") > 1, F.concat("id", F.lit("_"), (F.col("nth") - 1).cast("string"))).otherwise(F.col("id"))).drop("nth"))
    return out.select("id", F.col("chrom").alias("seqid"), "source", F.col("feature").alias("featuretype"), "start", "end", "score", "strand", "frame", "pairs", "gene_id", "transcript_id")


def relations(table: DataFrame) -> DataFrame:
    """(parent, child, level int): gene over transcript and transcript over exon at 1, gene over exon at 2."""
    rows = table.select("id", "featuretype", "gene_id", "transcript_id")
    under = lambda kind, parent, level: rows.where((F.col("featuretype") == kind) & F.col(parent).isNotNull()).select(F.col(parent).alias("parent"), F.col("id").alias("child"), F.lit(level).alias("level"))
    return under("transcript", "gene_id", 1).unionByName(under("exon", "transcript_id", 1)).unionByName(under("exon", "gene_id", 2)).distinct()


def feature_counts(table: DataFrame) -> DataFrame:
    """(featuretype, n bigint) of genes, transcripts and exons, 0 where there are none."""
    sums = table.agg(*(F.count_if(F.col("featuretype") == k).alias(k) for k in COUNTED))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(k).alias("featuretype"), F.col(k).alias("n")) for k in COUNTED))))
