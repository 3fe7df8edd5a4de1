"""GTF lines to transcripts, and transcripts of many samples to one consensus annotation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.gtf import attribute, attributes, exon_count, first_start, is_reference, last_end, trimmed
from strandloom.operators.matrix import numbered
from strandloom.shared import if_small, written

MIN_READS, MIN_SAMPLES, END_TOL, JUNCTION_TOL = 5, 2, 100, 10
#: Width of the bins of starts and of ends in which leaders are found; at least four times the tolerance of the ends.
BIN = 1 << 12
GTF_FIELDS = ("chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")


def gtf_records(lines: DataFrame) -> DataFrame:
    """(sample_id, ord, the nine fields with start and end int, pairs) of GTF ``lines`` (sample_id, ord, line).

    Comments and blank lines are skipped; any other line must have exactly nine fields, else the query fails.
    """
    fields = F.split("line", "\t")
    content = ~F.col("line").startswith("#") & (trimmed(F.col("line")) != "")
    wrong = F.raise_error(F.concat(F.lit("not a GTF line of nine fields: "), F.col("line"))).cast("array<string>")
    # Filters may be evaluated in any order, so the check itself leaves out what isn't content.
    right = F.when(~content, F.lit(None)).when(F.size(fields) == len(GTF_FIELDS), fields).otherwise(wrong)
    rows = lines.where(content).select("sample_id", "ord", right.alias("f"))
    named = rows.select("sample_id", "ord", *(F.get("f", F.lit(i)).alias(n) for i, n in enumerate(GTF_FIELDS)))
    return named.withColumns({"start": F.col("start").cast("int"), "end": F.col("end").cast("int"), "pairs": attributes(F.col("attributes"))})


def features_of(records: DataFrame) -> DataFrame:
    """Transcript and exon records that name both a transcript and a gene, with transcript_id, gene_id and ref."""
    named = records.withColumns({"transcript_id": attribute(F.col("pairs"), "transcript_id"), "gene_id": attribute(F.col("pairs"), "gene_id")})
    kept = named.where(F.col("feature").isin("transcript", "exon") & (F.col("transcript_id") != "") & (F.col("gene_id") != ""))
    return kept.withColumn("ref", is_reference(F.col("transcript_id"), F.col("gene_id"), F.col("source"), F.col("pairs")))


def enough_reads(features: DataFrame, passing: DataFrame) -> DataFrame:
    """Transcript records without the novel ones that aren't in ``passing`` (sample_id, transcript_id).

    A sample without a passing transcript keeps all of its records.
    """
    passing = passing.select("sample_id", "transcript_id").distinct()
    some = if_small(written(passing.select("sample_id").distinct().withColumn("some", F.lit(True)), "some"))
    marked = features.join(some, "sample_id", "left").join(passing.withColumn("passes", F.lit(True)), ["sample_id", "transcript_id"], "left")
    return marked.where(F.col("ref") | F.col("some").isNull() | F.col("passes").isNotNull()).drop("some", "passes")


def assembled(features: DataFrame, passing: DataFrame | None = None) -> DataFrame:
    """(sample_id, transcript_id, pos, chrom, strand, gene_id, source, is_reference, exons): transcripts with their exons.

    A transcript named on several lines takes its values from the last and its place from the first. Exons are all the
    exon lines of that transcript_id in the sample, sorted by start and end; transcripts without exons are dropped.
    """
    tx = features.where("feature = 'transcript'")
    tx = tx if passing is None else enough_reads(tx, passing)
    values = F.struct("chrom", "strand", "gene_id", "source", F.col("ref").alias("is_reference"))
    meta = tx.groupBy("sample_id", "transcript_id").agg(F.min("ord").alias("pos"), F.max_by(values, "ord").alias("m"))
    exons = features.where("feature = 'exon'").groupBy("sample_id", "transcript_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("exons"))
    return meta.join(exons, ["sample_id", "transcript_id"]).select("sample_id", "transcript_id", "pos", "m.*", "exons")


def in_sheet_order(tx: DataFrame, sheet: DataFrame) -> DataFrame:
    """``tx`` of the samples of ``sheet``, with ord: the order of samples in the sheet, then the place in the file, below 2^44."""
    return tx.join(sheet.select("sample_id", "sample_idx"), "sample_id").withColumn("ord", F.shiftleft(F.col("sample_idx"), 44).bitwiseOR(F.col("pos").cast("bigint")))


def placed(tx: DataFrame, sheet: DataFrame) -> DataFrame:
    """As ``in_sheet_order`` for places of any size, such as file offsets: ord counts all transcripts from 0, in one order."""
    return numbered(tx.join(sheet.select("sample_id", "sample_idx"), "sample_id"), "sample_idx", "pos", name="ord")


def last_references(tx: DataFrame) -> DataFrame:
    """One row for each reference transcript_id: that of the last sample."""
    ref = tx.where("is_reference")
    last = F.max_by(F.struct(*(F.col(c) for c in ref.columns if c != "transcript_id")), "ord").alias("m")
    return ref.groupBy("transcript_id").agg(last).select("transcript_id", "m.*")


def _match(a: str, b: str, end_tol: int, junction_tol: int) -> str:
    """SQL: whether exon lists of equal size match, the cheap test of the ends first."""
    n = f"size({a})"
    ends = f"abs({a}[0].start - {b}[0].start) <= {end_tol} and abs({a}[{n} - 1].end - {b}[{n} - 1].end) <= {end_tol}"
    near = f"abs({a}[i].end - {b}[i].end) <= {junction_tol} and abs({a}[i + 1].start - {b}[i + 1].start) <= {junction_tol}"
    return f"({ends} and ({n} = 1 or forall(sequence(0, greatest({n} - 2, 0)), i -> {near})))"


def _binned(rows: DataFrame, width: int, shift: int, tol: int) -> DataFrame:
    """``rows`` in each cell that holds a structure which they could match, with own: whether the cell is their own."""
    near = lambda at, by: F.floor((F.col(at) + F.lit(shift + by)) / width)
    both = rows.select("*", near("first_at", 0).alias("own_first"), near("last_at", 0).alias("own_last"), F.explode(F.sequence(near("first_at", -tol), near("first_at", tol))).alias("first_bin"))
    both = both.withColumn("last_bin", F.explode(F.sequence(near("last_at", -tol), near("last_at", tol))))
    cell = F.concat_ws("\t", "chrom", "strand", "n", "first_bin", "last_bin")
    own = (F.col("own_first") == F.col("first_bin")) & (F.col("own_last") == F.col("last_bin"))
    return both.select(*rows.columns, cell.alias("cell"), own.alias("own"))


class _Scan:
    """One cell's structures in order: the leaders so far, and those that may turn out to be leaders."""

    def __init__(self, end_tol: int, junction_tol: int) -> None:
        self.tols = end_tol, junction_tol
        self.near: dict[tuple[int, int], list[tuple[int, bool, list[int]]]] = {}

    def _place(self, x: list[int]) -> tuple[int, int]:
        """Cell of the first donor and last acceptor, of both ends if there is one exon."""
        tol = 1 + self.tols[len(x) > 2]
        return (x[1] // tol, x[-2] // tol) if len(x) > 2 else (x[0] // tol, x[1] // tol)

    def add(self, ord: int, sure: bool, x: list[int]) -> None:
        self.near.setdefault(self._place(x), []).append((ord, sure, x))

    def first(self, x: list[int]) -> tuple[int | None, int | None]:
        """Order numbers of the first leader and of the first possible leader that ``x`` matches."""
        end_tol, junction_tol = self.tols
        a, b = self._place(x)
        found: list[int | None] = [None, None]
        for at in ((a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
            for ord, sure, y in self.near.get(at, ()):
                if (found[not sure] is None or ord < found[not sure]) and abs(x[0] - y[0]) <= end_tol and abs(x[-1] - y[-1]) <= end_tol and all(abs(p - q) <= junction_tol for p, q in zip(x[1:-1], y[1:-1])):
                    found[not sure] = ord
        return found[0], found[1]


#: States of a structure: it may be a leader, is one, follows a leader not yet sure to be the first, follows ``leader``.
OPEN, LEADS, FOLLOWS, PLACED = range(4)
_SCANNED = "chrom string, strand string, n int, at array<int>, ord bigint, first_at int, last_at int, state int, leader bigint"


def _scanned(rows: DataFrame, end_tol: int, junction_tol: int) -> DataFrame:
    """One round over ``rows`` (those of _SCANNED, cell, own): the undecided structures of their own cells with their new state.

    A task reads its cells one after another in order; it holds the leaders and possible leaders of one cell.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, scan = None, None
        for pdf in batches:
            states, placed = pdf["state"].to_numpy().copy(), pdf["leader"].to_numpy().astype(object)
            for i, (c, own, state, ord, at) in enumerate(zip(pdf["cell"], pdf["own"], pdf["state"], pdf["ord"], pdf["at"])):
                if c != cell:
                    cell, scan = c, _Scan(end_tol, junction_tol)
                at = at.tolist()
                if state == LEADS:
                    scan.add(ord, True, at)
                    continue
                if state == FOLLOWS and not own:
                    continue
                leader, possible = scan.first(at)
                if leader is not None:
                    states[i] = FOLLOWS if possible is not None and possible < leader else PLACED
                    placed[i] = leader
                elif own and possible is None:
                    states[i], placed[i] = LEADS, ord
                    scan.add(ord, True, at)
                else:
                    scan.add(ord, False, at)
            kept = (pdf["own"] & (pdf["state"] != LEADS)).to_numpy()
            out = pdf.drop(columns=["cell", "own"])
            out["state"], out["leader"] = states, pd.array(placed, dtype="Int64")
            yield out[kept]

    return rows.repartition("cell").sortWithinPartitions("cell", "ord").mapInPandas(run, _SCANNED)


def leaders(tx: DataFrame, end_tol: int = END_TOL, junction_tol: int = JUNCTION_TOL) -> DataFrame:
    """(chrom, strand, n, exons, ord, leader): each distinct structure with the order number of its group's leader.

    Transcripts are taken in order; one joins the first group whose leader it matches, else it leads a new group. Equal
    structures always share a group, so they are collapsed first. A structure leads if no earlier leader matches it, and
    only structures near by can. So cells of starts and ends are scanned at the same time, each with copies of what lies
    within the tolerance of its borders; what depends on an undecided structure of another cell waits for the next round,
    in which the borders lie elsewhere. A round decides at least the earliest structure that is left of each locus.
    """
    rows = tx.select(F.coalesce("chrom", F.lit(".")).alias("chrom"), F.coalesce("strand", F.lit(".")).alias("strand"), "exons", "ord").withColumn("n", exon_count(F.col("exons")))
    structures = rows.groupBy("chrom", "strand", "n", "exons").agg(F.min("ord").alias("ord"))
    flat = F.flatten(F.transform("exons", lambda x: F.array(x["start"], x["end"])))
    left = structures.select("chrom", "strand", "n", flat.alias("at"), "ord", first_start(F.col("exons")).alias("first_at"), last_end(F.col("exons")).alias("last_at"), F.lit(OPEN).alias("state"), F.lit(None).cast("bigint").alias("leader"))
    left = written(left, "structures")
    width = max(BIN, 4 * (end_tol + 1))
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        shift = width // 2 * (len(rounds) % 2)
        cells = _binned(left, width, shift, end_tol)
        for done in rounds:
            cells = cells.unionByName(_binned(done.where(F.col("state") == LEADS), width, shift, end_tol))
        if rounds:
            busy = written(_binned(left, width, shift, end_tol).where("own").select("cell").distinct(), "cells")
            cells = cells.join(if_small(busy), "cell", "left_semi").select(cells.columns)
        rounds.append(written(_scanned(cells, end_tol, junction_tol), "round"))
        left = rounds[-1].where(F.col("state").isin(OPEN, FOLLOWS))
    decided = left.limit(0)
    for done in rounds:
        decided = decided.unionByName(done.where(F.col("state").isin(LEADS, PLACED)))
    exons = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(F.get("at", 2 * i).alias("start"), F.get("at", 2 * i + 1).alias("end")))
    return decided.select("chrom", "strand", "n", exons.cast(tx.schema["exons"].dataType).alias("exons"), "ord", "leader")


def close_pairs(tx: DataFrame, end_tol: int = END_TOL, junction_tol: int = JUNCTION_TOL) -> DataFrame:
    """(left_ord, right_ord), left_ord < right_ord: pairs of distinct structures that match, each named by its first transcript.

    A range join on equal keys: the start and the first donor, of a single exon its end, are cut into bins of their
    tolerance, and the one side looks into its own bin and those beside it.
    """
    rows = tx.select(F.coalesce("chrom", F.lit(".")).alias("chrom"), F.coalesce("strand", F.lit(".")).alias("strand"), "exons", "ord").withColumn("n", exon_count(F.col("exons")))
    one = rows.groupBy("chrom", "strand", "n", "exons").agg(F.min("ord").alias("ord"))
    donor_tol = F.when(F.col("n") > 1, junction_tol + 1).otherwise(end_tol + 1)
    binned = one.withColumns({"start_bin": F.floor(first_start(F.col("exons")) / (end_tol + 1)), "donor_bin": F.floor(F.get("exons", F.lit(0))["end"] / donor_tol)})
    beside = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)).alias(c)
    key = ["chrom", "strand", "n", "start_bin", "donor_bin"]
    right = binned.select("chrom", "strand", "n", F.col("exons").alias("other"), F.col("ord").alias("right_ord"), beside("start_bin"), "donor_bin").select("chrom", "strand", "n", "other", "right_ord", "start_bin", beside("donor_bin"))
    pairs = binned.withColumnRenamed("ord", "left_ord").join(right, key).where("left_ord < right_ord")
    return pairs.where(F.expr(_match("exons", "other", end_tol, junction_tol))).select("left_ord", "right_ord")


def novel_groups(tx: DataFrame, end_tol: int = END_TOL, junction_tol: int = JUNCTION_TOL, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """(chrom, strand, n, leader, bucket_ord, n_samples, n_members, exons): groups of at least ``min_samples`` samples."""
    rows = tx.select(F.coalesce("chrom", F.lit(".")).alias("chrom"), F.coalesce("strand", F.lit(".")).alias("strand"), "exons", "ord", "sample_id").withColumn("n", exon_count(F.col("exons")))
    led = written(leaders(tx, end_tol, junction_tol), "leaders")
    key = ["chrom", "strand", "n"]
    members = rows.join(led.drop("ord"), [*key, "exons"])
    groups = members.groupBy(*key, "leader").agg(F.count_distinct("sample_id").alias("n_samples"), F.count("*").alias("n_members")).where(F.col("n_samples") >= min_samples)
    first = led.groupBy(*key).agg(F.min("ord").alias("bucket_ord"))
    return groups.join(first, key).join(led.where("ord = leader").select(*key, "leader", "exons"), [*key, "leader"])


def collapsed(groups: DataFrame) -> DataFrame:
    """Groups as consensus transcripts, numbered by first appearance of their bucket, then of their leader."""
    ids = numbered(groups, "bucket_ord", "leader", name="place")
    name = lambda prefix: F.format_string(f"{prefix}_%06d", F.col("place") + 1)
    return ids.select(name("tCOLL").alias("transcript_id"), name("gCOLL").alias("gene_id"), "chrom", "strand", F.lit("IsoQuant").alias("source"), F.lit("consensus").alias("sample_id"), F.lit(False).alias("is_reference"), "exons", "n_samples", "n_members")


def consensus(tx: DataFrame, end_tol: int = END_TOL, junction_tol: int = JUNCTION_TOL, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """(transcript_id, gene_id, chrom, strand, source, sample_id, is_reference, exons): references and collapsed novel ones."""
    novel = collapsed(novel_groups(tx.where("not is_reference"), end_tol, junction_tol, min_samples))
    cols = ["transcript_id", "gene_id", "chrom", "strand", "source", "sample_id", "is_reference", "exons"]
    return last_references(tx).select(cols).unionByName(novel.select(cols))


def gtf_lines(tx: DataFrame) -> DataFrame:
    """(chrom, strand, start, end, transcript_id, level, exon_number, line): sort by all but line for the file's order.

    A gene has one line for each strand, before its first transcript and with that one's coordinates. Exons count up by
    coordinate on either strand.
    """
    tx = tx.withColumns({"start": first_start(F.col("exons")), "end": last_end(F.col("exons"))})
    order = ["chrom", "strand", "start", "end", "transcript_id"]
    line = lambda feature, start, end, attrs: F.concat_ws("\t", "chrom", "source", F.lit(feature), F.col(start).cast("string"), F.col(end).cast("string"), F.lit("."), "strand", F.lit("."), attrs)
    gene = F.format_string('gene_id "%s";', "gene_id")
    both = F.format_string('gene_id "%s"; transcript_id "%s";', "gene_id", "transcript_id")
    number = F.format_string('gene_id "%s"; transcript_id "%s"; exon_number "%d";', "gene_id", "transcript_id", "exon_number")
    keys = lambda level, no: [*order, F.lit(level).alias("level"), no.cast("int").alias("exon_number")]
    first = tx.groupBy("gene_id", "strand").agg(F.min(F.struct("chrom", "start", "end", "transcript_id", "source")).alias("f")).select("gene_id", "strand", "f.*")
    genes = first.select(*keys(0, F.lit(0)), line("gene", "start", "end", gene).alias("line"))
    transcripts = tx.select(*keys(1, F.lit(0)), line("transcript", "start", "end", both).alias("line"))
    exons = tx.select(*order, "source", "gene_id", F.posexplode("exons").alias("i", "x")).withColumns({"exon_number": F.col("i") + 1, "x_start": F.col("x.start"), "x_end": F.col("x.end")})
    return genes.unionByName(transcripts).unionByName(exons.select(*keys(2, F.col("exon_number")), line("exon", "x_start", "x_end", number).alias("line")))


def statistics(tx: DataFrame, final: DataFrame, sheet: DataFrame) -> DataFrame:
    """(section int, name, value bigint): counts of the consensus, then transcripts of each sample of the sheet."""
    one = lambda df, name, place: df.agg(F.count("*").alias("value")).select(F.lit(0).alias("section"), F.lit(place).cast("bigint").alias("place"), F.lit(name).alias("name"), "value")
    parts = one(final.where("is_reference"), "reference_transcripts", 0)
    parts = parts.unionByName(one(tx.where("not is_reference"), "novel_transcripts_before_collapse", 1))
    parts = parts.unionByName(one(final.where("not is_reference"), "novel_transcripts_after_collapse", 2)).unionByName(one(final, "total_transcripts_final", 3))
    per = sheet.select("sample_id", "sample_idx").join(tx.groupBy("sample_id").agg(F.count("*").alias("value")), "sample_id", "left").fillna(0, ["value"])
    return parts.unionByName(per.select(F.lit(1).alias("section"), F.col("sample_idx").cast("bigint").alias("place"), F.col("sample_id").alias("name"), "value"))
