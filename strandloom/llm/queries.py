"""Queries of the training-data operators over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.groups import linked_groups
from strandloom.llm.mixing import mix
from strandloom.llm.near import near_links, near_pairs
from strandloom.llm.spans import shared_spans
from strandloom.llm.tokens import token_counts, token_ids
from strandloom.llm.topn import top_n

#: Share of their boundaries that nearly equal transcripts have in common.
SIMILARITY = 0.75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "transcript_matches").where("is_match")
    return linked_groups(pairs, ["left_sample_id", "left_transcript_id"], ["right_sample_id", "right_transcript_id"], ["sample_id", "transcript_id"])


def p2_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and samples of each group."""
    return p2_found(spark, sf_dir).groupBy("group_sample_id", "group_transcript_id").agg(F.count("*").alias("n_records"), F.countDistinct("sample_id").alias("n_samples"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(table(spark, sf_dir, "bu_reads"), ["sample_id", "bu"], "read_length", "read_id", 3)


def _boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts with the sorted distinct boundaries of their valid exons: 2 * start and 2 * end + 1, so a start never equals an end."""
    valid = "filter(exons, x -> x.exon_start <= x.exon_end)"
    both = f"array_sort(array_distinct(flatten(transform({valid}, x -> array(2 * cast(x.exon_start as bigint), 2 * cast(x.exon_end as bigint) + 1)))))"
    return table(spark, sf_dir, "transcripts").select("tx_key", "chrom", "strand", F.expr(both).alias("boundaries"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(_boundaries(spark, sf_dir), "tx_key", ["chrom", "strand"], "boundaries", SIMILARITY)


def p5_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, group and number of links of each transcript."""
    return near_links(_boundaries(spark, sf_dir), "tx_key", ["chrom", "strand"], "boundaries", SIMILARITY)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document."""
    return token_counts(table(spark, sf_dir, "documents"), ["doc_id", "source"], "text")


def p8_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_shared_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared code points of every document, and their share of its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    shared = p9_found(spark, sf_dir).groupBy("doc_id").agg(F.sum(F.col("span_to") - F.col("span_from")).alias("shared_chars"))
    both = docs.join(shared, "doc_id", "left").fillna(0, ["shared_chars"])
    return both.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))


QUERIES = {f.__name__: f for f in (p2_found, p2_group_sizes, p5_found, p5_links, p6_found, p7_ids, p7_counts, p8_chosen, p8_shares, p9_found, p9_shared_chars)}

_LINKS = """with recursive m as (select left_sample_id || chr(1) || left_transcript_id a, right_sample_id || chr(1) || right_transcript_id b from transcript_matches where is_match
    and left_sample_id is not null and left_transcript_id is not null and right_sample_id is not null and right_transcript_id is not null),
  e as (select a, b from m union select b, a from m),
  reach as (select a, a b from e union select r.a, e.b from reach r join e on r.b = e.a),
  g as (select a, min(b) g from reach group by a),
  found as (select split_part(a, chr(1), 1) sample_id, split_part(a, chr(1), 2) transcript_id, split_part(g, chr(1), 1) group_sample_id, split_part(g, chr(1), 2) group_transcript_id from g)"""

_BOUNDS = """with b as (select tx_key, chrom, strand, unnest(exons) x from transcripts where chrom is not null and strand is not null),
  p as (select tx_key, chrom, strand, 'start' side, x.exon_start v from b where x.exon_start <= x.exon_end union select tx_key, chrom, strand, 'end', x.exon_end from b where x.exon_start <= x.exon_end),
  n as (select tx_key, count(*) n from p group by 1),
  c as (select l.tx_key a, r.tx_key b, count(*) c from p l join p r on l.chrom = r.chrom and l.strand = r.strand and l.side = r.side and l.v = r.v and l.tx_key < r.tx_key group by 1, 2),
  found as (select a left_key, b right_key from c join n l on l.tx_key = a join n r on r.tx_key = b where c.c * 4 >= 3 * (l.n + r.n - c.c))"""
_SPANS = """with g as (select doc_id, i, substr(text, cast(i as int) + 1, 80) s from (select doc_id, text, unnest(range(0, length(text) - 79)) i from documents where length(text) >= 80)),
  t as (select s from g group by s having count(distinct doc_id) > 1),
  w as (select doc_id, i a, i + 80 b from g where s in (select s from t)),
  m as (select *, max(b) over (partition by doc_id order by a rows between unbounded preceding and 1 preceding) before from w),
  r as (select *, sum(case when before is null or a > before then 1 else 0 end) over (partition by doc_id order by a rows unbounded preceding) run from m),
  found as (select doc_id, cast(min(a) as int) span_from, cast(max(b) as int) span_to from r group by doc_id, run)"""

ORACLE = {
    "p5_found": _BOUNDS + " select left_key, right_key from found",
    "p5_links": _BOUNDS.replace("with b", "with recursive b", 1)
    + """, k as (select tx_key, chrom, strand, string_agg(side || v, ',' order by side, v) s from p group by 1, 2, 3),
      cl as (select tx_key, min(tx_key) over (partition by chrom, strand, s) class_key from k),
      e as (select left_key a, right_key b from found union all select right_key, left_key from found),
      reach as (select tx_key a, tx_key b from k union select r.a, e.b from reach r join e on e.a = r.b),
      g as (select a, min(b) group_key from reach group by 1), ln as (select a, count(*) n from e group by 1)
      select cl.tx_key, class_key, group_key, coalesce(ln.n, 0) n_links from cl join g on g.a = cl.tx_key left join ln on ln.a = cl.tx_key""",
    "p9_found": _SPANS + " select doc_id, span_from, span_to from found",
    "p9_shared_chars": _SPANS
    + """, k as (select doc_id, sum(span_to - span_from) c from found group by 1)
      select d.doc_id, coalesce(cast(length(text) as int), 0) n_chars, cast(coalesce(c, 0) as bigint) shared_chars, case when length(text) > 0 then coalesce(c, 0) * 1.0e0 / length(text) else 0.0e0 end shared_share
      from documents d left join k on k.doc_id = d.doc_id""",
    "p2_found": _LINKS + " select * from found",
    "p2_group_sizes": _LINKS + " select group_sample_id, group_transcript_id, count(*) n_records, count(distinct sample_id) n_samples from found group by 1, 2",
    "p6_found": """with r as (select sample_id, bu, read_id, max(read_length) l from bu_reads where sample_id is not null and bu is not null and read_id is not null group by all having max(read_length) is not null),
      n as (select *, row_number() over (partition by sample_id, bu order by l desc, read_id) k from r) select sample_id, bu, cast(k as int) rank_no, read_id from n where k <= 3""",
}
