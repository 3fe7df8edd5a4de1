"""SQL for the queries of quantification.py, in other constructs than theirs where there is a choice."""

from __future__ import annotations

_MOLECULE = "regexp_matches(read_id, '^[A-Za-z0-9]{16}[^\\n]*?_[A-Za-z0-9]{12}#')"
_BARCODE = "substr(read_id, 1, 16)"
_UMI = "regexp_extract(read_id, '^[A-Za-z0-9]{16}[^\\n]*?_([A-Za-z0-9]{12})#', 1)"
_A = f"""a as (select sample_id, {_BARCODE} barcode, {_UMI} umi, gene_id from read_assignments where {_MOLECULE} and gene_id not in ('*', '.', '')),
  u as (select sample_id, barcode, umi, min(gene_id) gene_id from a group by 1, 2, 3 having count(distinct gene_id) = 1),
  gm as (select gene_id, sample_id || '_' || barcode cell, count(*) n from u group by 1, 2)"""
_B = f"""lm as (select sample_id, read_id, transcript_id from (select *, row_number() over (partition by sample_id, read_id order by ord desc) k from bu_reads where transcript_id is not null) where k = 1),
  rl as (select b.sample_id, b.ord, b.read_id, l.transcript_id, coalesce(b.read_length, 0) read_length from bu_reads b join lm l on l.sample_id = b.sample_id and l.read_id = b.read_id),
  rb as (select *, {_BARCODE} barcode, {_UMI} umi from rl where transcript_id <> '*'),
  rk as (select *, row_number() over (partition by sample_id, barcode, umi order by read_length desc, read_id) k from rb),
  bg as (select sample_id, barcode, umi, count(distinct transcript_id) nt, min(ord) first_ord from rb group by 1, 2, 3),
  bu as (select r.sample_id, r.barcode || r.umi bu, r.barcode, r.umi, case when nt = 1 then read_id else 'ambiguous' end read_id, case when nt = 1 then transcript_id else 'ambiguous' end transcript_id,
    case when nt = 1 then cast(read_length as int) end read_length, case when nt = 1 then 'unique' else 'ambiguous' end status, g.first_ord
    from rk r join bg g on r.sample_id = g.sample_id and r.barcode = g.barcode and r.umi = g.umi where k = 1),
  sh as (select trim(sample_id) sample_id, sample_idx from samples where sample_id <> ''),
  rc as (select read_id, cell from (select read_id, b.sample_id || '_' || barcode cell, row_number() over (partition by read_id order by sample_idx desc, first_ord desc) k from bu b join sh on sh.sample_id = b.sample_id where status = 'unique') where k = 1),
  cells as (select cell from gm union select sample_id || '_' || barcode from bu where status = 'unique')"""
_C = """o as (select read_id from read_assignments group by 1 having count(*) = 1),
  ct as (select r.ord, r.isoform_id transcript_id, rc.cell from read_assignments r join o on o.read_id = r.read_id join rc on rc.read_id = r.read_id where r.isoform_id <> '*'),
  tm as (select transcript_id, cell, count(*) n from ct group by 1, 2)"""
_T = """x as (select tx_key, sample_id, transcript_id, unnest(exons) e from transcripts where gene_id <> '' and transcript_id <> ''),
  ex as (select sample_id, transcript_id, e.exon_start s, e.exon_end e from x where e.exon_start is not null and e.exon_end is not null),
  ea as (select sample_id, transcript_id, list(struct_pack(s := s, e := e) order by s, e) ex, string_agg(s || '-' || e, ',' order by s, e) exon_text from ex group by 1, 2),
  md as (select *, min(tx_key) over (partition by sample_id, transcript_id) pos, row_number() over (partition by sample_id, transcript_id order by tx_key desc) k from transcripts where gene_id <> '' and transcript_id <> ''),
  sh as (select trim(sample_id) sample_id, sample_idx from samples where sample_id <> ''),
  tx as (select m.sample_id, m.transcript_id, m.gene_id, coalesce(m.chrom, '.') chrom, coalesce(m.strand, '.') strand, coalesce(m.source, '.') source,
    (m.gene_id like 'ENSG%' or m.transcript_id like 'ENS%' or coalesce(m.source, '.') in ('ENSEMBL', 'HAVANA')) is_reference, ea.ex, ea.exon_text, cast(len(ea.ex) as int) n_exons, sh.sample_idx * 17592186044416 + m.pos * 4096 ord, sh.sample_idx
    from md m join ea on ea.sample_id = m.sample_id and ea.transcript_id = m.transcript_id join sh on sh.sample_id = m.sample_id where k = 1)"""
_NEAR = """abs(l.ex[1].s - b.ex[1].s) <= 100 and abs(l.ex[b.n_exons].e - b.ex[b.n_exons].e) <= 100
   and len(list_filter(range(1, b.n_exons), lambda i: abs(l.ex[i].e - b.ex[i].e) > 10 or abs(l.ex[i + 1].s - b.ex[i + 1].s) > 10)) = 0"""
_G = f"""nb as (select *, min(ord) over (partition by chrom, strand, n_exons) bord, row_number() over (partition by chrom, strand, n_exons order by ord) rn from tx where not is_reference),
  f as (select bord, 0::bigint rn, []::struct(ord bigint, ex struct(s int, e int)[])[] ld, null::bigint l, null::bigint ord, null::varchar sample_id from nb group by bord
    union all select f.bord, b.rn, case when m is null then list_append(f.ld, struct_pack(ord := b.ord, ex := b.ex)) else f.ld end, coalesce(m, b.ord), b.ord, b.sample_id
    from f join nb b on b.bord = f.bord and b.rn = f.rn + 1, lateral (select list_filter(f.ld, lambda l: {_NEAR})[1].ord m)),
  gr as (select bord, l, count(distinct sample_id) n_samples, count(*) n_members from f where rn > 0 group by 1, 2 having count(distinct sample_id) >= 2),
  gn as (select gr.*, row_number() over (order by gr.bord, gr.l) no from gr),
  co as (select 'tCOLL_' || right('000000' || no, greatest(6, length(no::varchar))) transcript_id, 'gCOLL_' || right('000000' || no, greatest(6, length(no::varchar))) gene_id, t.chrom, t.strand, n_samples, n_members, t.exon_text, t.ex from gn join tx t on t.ord = gn.l),
  lr as (select * from (select *, row_number() over (partition by transcript_id order by ord desc) k from tx where is_reference) where k = 1),
  fi as (select transcript_id, gene_id, chrom, strand, source, ex, true ref from lr union all select transcript_id, gene_id, chrom, strand, 'IsoQuant', ex, false from co),
  fs as (select *, cast(ex[1].s as int) st, cast(ex[len(ex)].e as int) en from fi),
  gf as (select * from (select *, row_number() over (partition by gene_id, strand order by chrom, st, en, transcript_id) k from fs) where k = 1),
  xl as (select transcript_id, gene_id, chrom, strand, source, unnest(ex) x, unnest(range(1, len(ex) + 1)) i from fs)"""
_LINES = """select concat_ws(chr(9), chrom, source, 'gene', st, en, '.', strand, '.', 'gene_id "' || gene_id || '";') line from gf
  union all select concat_ws(chr(9), chrom, source, 'transcript', st, en, '.', strand, '.', 'gene_id "' || gene_id || '"; transcript_id "' || transcript_id || '";') from fs
  union all select concat_ws(chr(9), chrom, source, 'exon', x.s, x.e, '.', strand, '.', 'gene_id "' || gene_id || '"; transcript_id "' || transcript_id || '"; exon_number "' || i || '";') from xl"""
_PASS = "ps as (select sample_id, transcript_id from bu_reads group by 1, 2 having count(*) >= {})"
_MIN_READS = """select sample_id, transcript_id, is_reference from tx where is_reference or not exists (select 1 from ps where ps.sample_id = tx.sample_id)
  or exists (select 1 from ps where ps.sample_id = tx.sample_id and ps.transcript_id = tx.transcript_id)"""

ORACLE = {
    "gene_matrix_coo": f"with {_A} select * from gm",
    "read_id_parse": f"select ord, read_id, {_BARCODE} barcode, {_UMI} umi, {_BARCODE} || {_UMI} bu from read_assignments where {_MOLECULE}",
    "assignment_scan_filter": "select sample_id, read_id, gene_id from read_assignments where gene_id not in ('*', '.', '')",
    "gene_bu_unique": f"with {_A} select sample_id, barcode, umi, gene_id from u",
    "gene_bu_ambiguous": f"with {_A} select sample_id, barcode, umi, min(gene_id) first_gene, max(gene_id) last_gene from a group by 1, 2, 3 having count(distinct gene_id) > 1",
    "gene_matrix_zero_filled": f"""with {_A}, {_B}, g as (select distinct gene_id from gm)
      select gene_id, string_agg(n::varchar, ',' order by cell) line from (select g.gene_id, c.cell, coalesce(m.n, 0) n from g cross join cells c left join gm m on m.gene_id = g.gene_id and m.cell = c.cell) group by 1""",
    "transcript_map_last_wins": f"with {_A}, {_B} select * from lm",
    "valid_read_ids": "select distinct sample_id, read_id from bu_reads where transcript_id <> '*'",
    "read_lengths_join": f"with {_A}, {_B} select sample_id, ord, read_id, transcript_id, cast(read_length as int) read_length from rl",
    "bu_table": f"with {_A}, {_B} select sample_id, bu, barcode, umi, read_id, transcript_id, coalesce(read_length::varchar, 'ambiguous') read_length, status, first_ord from bu",
    "bu_representatives": f"with {_A}, {_B} select sample_id, bu, read_id, transcript_id, read_length from bu where status = 'unique'",
    "alignment_filter": "select sample_id, ord, read_id query_name, coalesce(read_length, 0) query_length from bu_reads b where exists (select 1 from bu_reads v where v.sample_id = b.sample_id and v.read_id = b.read_id and v.transcript_id <> '*')",
    "alignment_filter_stats": f"""with {_A}, {_B}, v as (select distinct sample_id, read_id from bu_reads where transcript_id <> '*'),
      i as (select sample_id, count(*) n from bu_reads group by 1), k as (select b.sample_id, count(*) n from bu_reads b join v on v.sample_id = b.sample_id and v.read_id = b.read_id group by 1), c as (select sample_id, count(*) n from v group by 1)
      select sh.sample_id, coalesce(c.n, 0) valid_read_ids, coalesce(i.n, 0) reads_in_bam, coalesce(k.n, 0) reads_written from sh left join c on c.sample_id = sh.sample_id left join i on i.sample_id = sh.sample_id left join k on k.sample_id = sh.sample_id""",
    "unique_reads_once": "select read_id from (select read_id, count(*) n from read_assignments group by 1) where n = 1",
    "transcript_matrix_coo": f"with {_A}, {_B}, {_C} select tm.* from tm join cells on cells.cell = tm.cell",
    "transcript_row_index": f"with {_A}, {_B}, {_C} select transcript_id, min(ord) first_ord, row_number() over (order by min(ord)) - 1 idx from ct group by 1",
    "transcript_cross_sample_last_wins": f"with {_A}, {_B} select * from rc",
    "shared_barcodes": f"with {_A}, {_B} select cell, row_number() over (order by cell) - 1 idx from cells where cell <> ''",
    "mtx_triplets": f"""with {_A}, {_B}, r as (select gene_id, row_number() over (order by gene_id) i from (select distinct gene_id from gm)), c as (select cell, row_number() over (order by cell) i from cells)
      select r.i row_idx, c.i col_idx, gm.n from gm join r on r.gene_id = gm.gene_id join c on c.cell = gm.cell""",
    "gtf_attr_parse": """with k as (select *, list_filter(coalesce(exons, []), lambda x: x.exon_start is not null and x.exon_end is not null) ok from transcripts),
      p as (select *, unnest(range(0, len(ok) + 1)) i from k)
      select tx_key * 4096 + i ord, case when i = 0 then 'transcript' else 'exon' end feature, coalesce(chrom, '.') chrom,
      cast(case when i > 0 then ok[i].exon_start else coalesce(list_min(list_transform(ok, lambda x: x.exon_start)), 1) end as int) "start",
      cast(case when i > 0 then ok[i].exon_end else coalesce(list_max(list_transform(ok, lambda x: x.exon_end)), 1) end as int) "end", gene_id, transcript_id from p""",
    "transcript_assembly": f"""with {_T} select sample_id, transcript_id, gene_id, chrom, strand, source, is_reference, n_exons, cast(case when strand = '+' then ex[1].s else ex[n_exons].e end as int) five,
      cast(case when strand = '+' then ex[n_exons].e else ex[1].s end as int) three, exon_text from tx""",
    "junction_list": f"""with {_T}, o as (select sample_id, transcript_id, s, e, row_number() over (partition by sample_id, transcript_id order by s, e) i, lead(s) over (partition by sample_id, transcript_id order by s, e) a from ex)
      select o.sample_id, o.transcript_id, cast(i - 1 as int) "at", e donor, a acceptor from o join tx on tx.sample_id = o.sample_id and tx.transcript_id = o.transcript_id where a is not null""",
    "reference_split": f"with {_T} select sample_id, is_reference, count(*) n from tx group by 1, 2",
    "reference_last_wins": f"with {_T} select transcript_id, sample_id, gene_id, chrom, strand, exon_text from (select *, row_number() over (partition by transcript_id order by ord desc) k from tx where is_reference) where k = 1",
    "min_reads_filter": f"with {_T}, {_PASS.format(5)} {_MIN_READS}",
    "min_reads_filter_empty_set": f"with {_T} select sample_id, transcript_id, is_reference from tx",
    "tolerance_pairs": f"""with {_T}, s as (select chrom, strand, n_exons, exon_text, any_value(ex) ex, min(ord) ord from tx where not is_reference group by 1, 2, 3, 4)
      select l.ord left_ord, b.ord right_ord from s l join s b on l.chrom = b.chrom and l.strand = b.strand and l.n_exons = b.n_exons and l.ord < b.ord where {_NEAR}""",
    "novel_collapse": f"with recursive {_T}, {_G} select transcript_id, gene_id, chrom, strand, n_samples, n_members, exon_text from co",
    "consensus_gtf_lines": f"with recursive {_T}, {_G} {_LINES}",
    "integrated_statistics": f"""with recursive {_T}, {_G} select 0 section, 0::bigint place, 'reference_transcripts' "name", (select count(*) from lr) "value" union all select 0, 1, 'novel_transcripts_before_collapse', (select count(*) from tx where not is_reference)
      union all select 0, 2, 'novel_transcripts_after_collapse', (select count(*) from co) union all select 0, 3, 'total_transcripts_final', (select count(*) from fi)
      union all select 1, sh.sample_idx, sh.sample_id, (select count(*) from tx where tx.sample_id = sh.sample_id) from sh""",
    "feature_table": f"""with recursive {_T}, {_G} select 'gene' featuretype, chrom seqid, st "start", en "end", strand, gene_id, cast(null as varchar) transcript_id from gf
      union all select 'transcript', chrom, st, en, strand, gene_id, transcript_id from fs union all select 'exon', chrom, x.s, x.e, strand, gene_id, transcript_id from xl""",
    "feature_counts": f"with recursive {_T}, {_G} select 'gene' featuretype, (select count(*) from gf) n union all select 'transcript', (select count(*) from fs) union all select 'exon', (select count(*) from xl)",
    "feature_relations": f"""with recursive {_T}, {_G} select gene_id parent, 1 "level", count(*) n from fs group by 1 union all select transcript_id, 1, count(*) from xl group by 1 union all select gene_id, 2, count(*) from xl group by 1""",
    "sample_sheet_resolve": """with s as (select sample_idx, trim(sample_id) sample_id, trim(fastq_path) fastq_path, coalesce(trim(workdir), '') workdir from samples where sample_id <> ''),
      d as (select *, case when workdir = '' then '/project/per_sample/' || sample_id when workdir like '/%' then workdir else '/project/' || workdir end sample_dir from s)
      select *, sample_dir || '/OUT' out_dir from d""",
}
# The samples of the fixed sheet.
_SAMPLES = ("QX11_LV", "QX11_RV", "QX12_LV", "QX12_RV", "QX13_LV", "QX13_RV", "qx14_lv", "QX14-RV", "MB02_A", "MB02_B", "MB03_A", "MB03_A2")
ORACLE["gene_by_sample_pivot"] = f"with {_A} select gene_id, " + ", ".join(f"""count(*) filter (where sample_id = '{s}') "{s}\"""" for s in _SAMPLES) + " from u group by 1"
ORACLE["alignment_merge_sorted"] = ORACLE["alignment_filter"]
