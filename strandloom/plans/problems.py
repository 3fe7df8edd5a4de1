"""Queries of the general data-processing problems over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.badrows import failed_lines, valid_rows
from strandloom.operators.intervals import periods_and_gaps
from strandloom.operators.skew import balanced_fragments, balanced_join, balanced_stats

#: Strings that stand for no gene or barcode.
NO_KEY = ("*", ".", "")
SHARE = 0.02


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = table(spark, sf_dir, "transcripts").where("gene_id <> ''")
    exons = tx.select("gene_id", "chrom", F.inline("exons"))
    return periods_and_gaps(exons, ["gene_id", "chrom"], "exon_start", "exon_end")


def p1_gene_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered and uncovered positions of each gene and chromosome."""
    width = (F.col("last_pos") - F.col("first_pos") + 1).cast("bigint")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, width)), F.lit(0)).cast("bigint")
    return p1_found(spark, sf_dir).groupBy("gene_id", "chrom").agg(F.count_if(F.col("kind") == "period").alias("n_periods"), of("period").alias("covered"), of("gap").alias("uncovered"))


def _stats(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    return balanced_stats(table(spark, sf_dir, "read_assignments"), field, ["ord"], {"n_reads": ["read_id"], "n_bus": ["barcode", "umi"]}, NO_KEY)


def _matched(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    """(the field, n_rows, n_matching): rows of each of its values, in the tasks of the plan, beside those of the matching table."""
    rows = table(spark, sf_dir, "read_assignments").select(field).where(F.col(field).isNotNull() & ~F.col(field).isin(*NO_KEY))
    other = table(spark, sf_dir, {"barcode": "bu_reads", "gene_id": "ref_genes"}[field]).groupBy(field).agg(F.count("*").alias("n_matching"))
    shards = balanced_fragments(rows, other, field, "left").groupBy("task_id", field).agg(F.count("*").alias("n_rows"), F.max("n_matching").alias("n_matching"))
    return shards.groupBy(field).agg(F.sum("n_rows").alias("n_rows"), F.coalesce(F.max("n_matching"), F.lit(0)).cast("bigint").alias("n_matching"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_rows = table(spark, sf_dir, "read_assignments").count()
    fields = [_matched(spark, sf_dir, f).select(F.lit(f).alias("field_name"), F.col(f).alias("key_value"), "n_rows") for f in ("barcode", "gene_id")]
    return fields[0].unionByName(fields[1]).where(F.col("n_rows") * 100 >= all_rows * round(SHARE * 100)).select("field_name", "key_value")


def p3_barcode_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each barcode in read_assignments and in bu_reads."""
    return _matched(spark, sf_dir, "barcode").withColumnRenamed("n_matching", "n_bu_reads")


def p3_barcode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "barcode").withColumnRenamed("key_value", "barcode")


def p3_gene_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir, "gene_id").withColumnRenamed("key_value", "gene_id")


def p3_gene_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of read_assignments for each reference gene's name and biotype, and those without one."""
    reads = table(spark, sf_dir, "read_assignments").select("ord", "gene_id", "sample_id")
    genes = table(spark, sf_dir, "ref_genes").select("gene_id", "gene_name", "biotype")
    return balanced_join(reads, genes, "gene_id", "left").groupBy("sample_id", "gene_name", "biotype").agg(F.count("*").alias("n_rows"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_lines(table(spark, sf_dir, "raw_lines"))


def p4_valid_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(table(spark, sf_dir, "raw_lines"), "OUT.read_assignments.gz")


def p4_valid_model_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(table(spark, sf_dir, "raw_lines"), "OUT.transcript_model_reads.gz")


QUERIES = {f.__name__: f for f in (p1_found, p1_gene_cover, p3_found, p3_barcode_reads, p3_barcode_stats, p3_gene_stats, p3_gene_join, p4_found, p4_valid_assignments, p4_valid_model_reads)}

_EXONS = "select distinct gene_id, chrom, x.exon_start s, x.exon_end e from (select gene_id, chrom, unnest(exons) x from transcripts where gene_id <> '' and chrom is not null) where x.exon_start <= x.exon_end"
_PERIODS = f"""with ex as ({_EXONS}),
  m as (select *, max(e) over (partition by gene_id, chrom order by s, e rows between unbounded preceding and 1 preceding) before from ex),
  n as (select *, sum(case when before is null or s > before + 1 then 1 else 0 end) over (partition by gene_id, chrom order by s, e rows unbounded preceding) run from m),
  p as (select gene_id, chrom, run, min(s) s, max(e) e from n group by all),
  found as (select gene_id, chrom, 'period' kind, s first_pos, e last_pos from p union all
    select gene_id, chrom, 'gap', e + 1, nxt - 1 from (select *, lead(s) over (partition by gene_id, chrom order by s) nxt from p) where nxt is not null)"""
_KEYED = lambda f: f"""select {f}, count(*) n_rows, count(distinct read_id) n_reads, count(distinct case when umi is not null and barcode is not null then barcode || '/' || umi end) n_bus
  from read_assignments where {f} is not null and {f} not in ('*', '.', '') group by 1"""  # noqa: E731

_LINES = r"""with l as (select line_id, file_name, case when right(raw_line, 1) = chr(13) then left(raw_line, length(raw_line) - 1) else raw_line end line from raw_lines where raw_line is not null),
  k as (select *, regexp_matches(line, '^(?:"(?:[^"]|"")*"|[^"\t][^"\t]*|)(?:\t(?:"(?:[^"]|"")*"|[^"\t]*))*$') quoted,
    case file_name when 'OUT.read_assignments.gz' then 9 else 2 end wanted from l where not regexp_matches(line, '^(#|[ \t]*$)')),
  f as (select *, list_transform(regexp_extract_all(chr(9) || line, '\t("(?:[^"]|"")*"|[^"\t]*)', 1), lambda x: case when x like '"%' then replace(substr(x, 2, length(x) - 2), '""', '"') else x end) v from k),
  r as (select *, case when not quoted then 'quoting' when len(v) <> wanted then 'columns'
    when not regexp_matches(v[1], '^[A-Za-z0-9]{16}(?s:.*)_[A-Za-z0-9]{12}#') then 'read_id'
    when wanted = 2 then case when v[2] = '' then 'value' end
    when v[3] not in ('+', '-', '.') or v[6] not in ('unique', 'unique_minor_difference', 'inconsistent', 'ambiguous', 'intergenic', 'noninformative') then 'value'
    when v[8] <> '.' and len(list_filter(string_split(v[8], ','), lambda x: case when regexp_matches(x, '^[0-9]+-[0-9]+$') then
      not (try_cast(split_part(x, '-', 1) as hugeint) between 1 and try_cast(split_part(x, '-', 2) as hugeint) and try_cast(split_part(x, '-', 2) as hugeint) <= 2147483647) else true end)) > 0 then 'value' end reason from f)"""

ORACLE = {
    "p4_found": _LINES + " select line_id, reason from r where reason is not null",
    "p4_valid_assignments": _LINES
    + " select line_id, v[1] read_id, v[2] chrom, v[3] strand, v[4] isoform_id, v[5] gene_id, v[6] assignment_type, v[7] assignment_events, v[8] exons, v[9] additional_info from r where reason is null and wanted = 9",
    "p4_valid_model_reads": _LINES + " select line_id, v[1] read_id, v[2] transcript_id from r where reason is null and wanted = 2",
    "p1_found": _PERIODS + " select gene_id, chrom, kind, cast(first_pos as int) first_pos, cast(last_pos as int) last_pos from found",
    "p1_gene_cover": _PERIODS
    + """ select gene_id, chrom, cast(count(*) filter (where kind = 'period') as bigint) n_periods,
      cast(coalesce(sum(last_pos - first_pos + 1) filter (where kind = 'period'), 0) as bigint) covered,
      cast(coalesce(sum(last_pos - first_pos + 1) filter (where kind = 'gap'), 0) as bigint) uncovered from found group by 1, 2""",
    "p3_found": """with k as (select 'barcode' field_name, barcode key_value from read_assignments union all select 'gene_id', gene_id from read_assignments)
      select field_name, key_value from k where key_value not in ('*', '.', '') group by 1, 2 having count(*) * 50 >= (select count(*) from read_assignments)""",
    "p3_barcode_reads": """with b as (select barcode, count(*) n from bu_reads group by 1), r as (select barcode, count(*) n from read_assignments where barcode not in ('*', '.', '') group by 1)
      select r.barcode, r.n n_rows, coalesce(b.n, 0) n_bu_reads from r left join b on r.barcode = b.barcode""",
    "p3_barcode_stats": _KEYED("barcode"),
    "p3_gene_stats": _KEYED("gene_id"),
    "p3_gene_join": "select r.sample_id, g.gene_name, g.biotype, count(*) n_rows from read_assignments r left join ref_genes g on r.gene_id = g.gene_id group by 1, 2, 3",
}
