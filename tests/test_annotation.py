import random

import pytest

from strandloom.operators import annotation as ann
from strandloom.operators import features as feat

SHEET = [("s0", 0), ("s1", 1), ("s2", 2)]
TX = "sample_id string, transcript_id string, pos bigint, chrom string, strand string, gene_id string, source string, is_reference boolean, exons array<struct<start: int, end: int>>, ord bigint"


def transcripts(spark, rows):
    """rows: (sample number, transcript_id, chrom, strand, exons, reference)."""
    return spark.createDataFrame([(f"s{s}", t, i, c, d, "ENSG1" if ref else "novel", "IsoQuant", ref, x, (s << 44) | i) for i, (s, t, c, d, x, ref) in enumerate(rows)], TX)


def scan(rows, end_tol, junction_tol, min_samples):
    """Leaders in order: (bucket's first, leader, samples, members)."""
    out, buckets = [], {}
    for i, (s, _, c, d, x, _) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[0])):
        buckets.setdefault((c, d, len(x)), []).append((i, s, x))
    for members in buckets.values():
        groups = []
        for i, s, x in members:
            for g in groups:
                y = g[0][2]
                if abs(x[0][0] - y[0][0]) <= end_tol and abs(x[-1][1] - y[-1][1]) <= end_tol and all(abs(a[1] - b[1]) <= junction_tol and abs(a2[0] - b2[0]) <= junction_tol for a, b, a2, b2 in zip(x, y, x[1:], y[1:])):
                    g.append((i, s, x))
                    break
            else:
                groups.append([(i, s, x)])
        out += [(g[0][2], len({s for _, s, _ in g}), len(g)) for g in groups if len({s for _, s, _ in g}) >= min_samples]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_collapse_equals_leader_scan(spark, monkeypatch, seed):
    monkeypatch.setattr(ann, "BIN", [1 << 20, 64, 7, 150][seed])
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        n, at = rng.choice([1, 1, 2, 3]), rng.choice([100, 150, 220, 9000]) + rng.randrange(0, 200, 10 + seed)
        exons = [(at + 1000 * k + rng.randrange(0, 25, 6), at + 1000 * k + 400 + rng.randrange(0, 25, 6)) for k in range(n)]
        rows.append((rng.randrange(3), f"t{i}", rng.choice(["c1", "c1", "c2"]), rng.choice("+-"), exons, False))
    rows += rows[:60]
    found = ann.collapsed(ann.novel_groups(transcripts(spark, rows).repartition(5), 100, 10, 2)).collect()
    got = [([tuple(x) for x in r["exons"]], r["n_samples"], r["n_members"]) for r in sorted(found, key=lambda r: r["transcript_id"])]
    assert got == [(list(x), s, m) for x, s, m in scan(rows, 100, 10, 2)]
    assert sorted(r["transcript_id"] for r in found) == [f"tCOLL_{i + 1:06d}" for i in range(len(found))]


def test_chain_and_tolerances(spark):
    mono = lambda s, at: (s, f"m{at}", "c", "+", [(at, at + 50)], False)
    found = ann.novel_groups(transcripts(spark, [mono(0, 0), mono(1, 80), mono(2, 160), mono(0, 160)]), 100, 10, 2).collect()
    assert sorted((r["exons"][0]["start"], r["n_members"]) for r in found) == [(0, 2), (160, 2)]
    two = lambda s, j: (s, f"j{j}", "c", "+", [(0, 100 + j), (200, 300)], False)
    assert ann.novel_groups(transcripts(spark, [two(0, 0), two(1, 10)])).count() == 1
    assert ann.novel_groups(transcripts(spark, [two(0, 0), two(1, 11)])).count() == 0
    assert ann.novel_groups(transcripts(spark, [mono(0, 1), mono(0, 2), mono(0, 3)])).count() == 0
    assert ann.collapsed(ann.novel_groups(transcripts(spark, [mono(0, 1)]).limit(0))).count() == 0


def test_chains_over_many_cells(spark, monkeypatch):
    """Starts and ends that run on over many cells, in order, in turned order and at random: each decides the next."""
    monkeypatch.setattr(ann, "BIN", 404)
    rng = random.Random(8)
    at = list(range(0, 9000, 30))
    for order in (at, at[::-1], rng.sample(at, len(at))):
        rows = [(i % 3, f"t{i}", "c", "+", [(a, a + rng.choice([500, 590, 650]))], False) for i, a in enumerate(order)]
        found = ann.collapsed(ann.novel_groups(transcripts(spark, rows), 100, 10, 1)).collect()
        got = [([tuple(x) for x in r["exons"]], r["n_samples"], r["n_members"]) for r in sorted(found, key=lambda r: r["transcript_id"])]
        assert got == [(list(x), s, m) for x, s, m in scan(rows, 100, 10, 1)]


def lines(spark, texts, sample="s0"):
    return spark.createDataFrame([(sample, i, x) for i, x in enumerate(texts)], "sample_id string, ord bigint, line string")


def gtf(feature, start, end, attrs, source="IsoQuant", chrom="c", strand="+"):
    return "\t".join([chrom, source, feature, str(start), str(end), ".", strand, ".", attrs])


def test_assembly(spark):
    a = 'gene_id "g"; transcript_id "t1";'
    texts = [
        "# head", "  ", gtf("transcript", 1, 9, a), gtf("exon", 7, 9, a), gtf("exon", 1, 3, a), gtf("CDS", 1, 3, a), gtf("transcript", 1, 9, a, source="HAVANA"),
        gtf("transcript", 1, 9, 'gene_id "g"; transcript_id "no_exons";'), gtf("exon", 1, 2, 'gene_id "g"; transcript_id "no_line";'), gtf("transcript", 1, 2, 'gene_id "g";'), gtf("transcript", 1, 2, 'gene_id ""; transcript_id "x";'),
        gtf("transcript", 1, 2, 'gene_id "ENSG1"; transcript_id "transcript7";'), gtf("exon", 1, 2, 'gene_id "ENSG1"; transcript_id "transcript7";'),
    ]
    got = {r["transcript_id"]: r for r in ann.assembled(ann.features_of(ann.gtf_records(lines(spark, texts)))).collect()}
    assert set(got) == {"t1", "transcript7"}
    assert got["t1"]["pos"] == 2 and got["t1"]["source"] == "HAVANA" and got["t1"]["is_reference"]
    assert [tuple(x) for x in got["t1"]["exons"]] == [(1, 3), (7, 9)] and got["transcript7"]["is_reference"]
    with pytest.raises(Exception, match="nine fields"):
        ann.gtf_records(lines(spark, ["a\tb"])).collect()


def test_min_reads(spark):
    texts = [gtf("transcript", 1, 2, f'gene_id "g"; transcript_id "{t}";', source=s) for t, s in (("n1", "x"), ("n2", "x"), ("ENST", "x"), ("h", "HAVANA"))]
    two = lines(spark, texts).unionByName(lines(spark, texts, "s1"))
    kept = ann.enough_reads(ann.features_of(ann.gtf_records(two)), spark.createDataFrame([("s0", "n1")], "sample_id string, transcript_id string"))
    assert {(r["sample_id"], r["transcript_id"]) for r in kept.collect()} == {("s0", "n1"), ("s0", "ENST"), ("s0", "h"), ("s1", "n1"), ("s1", "n2"), ("s1", "ENST"), ("s1", "h")}


def test_last_reference_and_lines(spark):
    rows = [(1, "ENST1", "c", "-", [(5, 9), (20, 30)], True), (0, "ENST1", "c", "-", [(1, 2)], True), (0, "ENST2", "c", "-", [(3, 4)], True)]
    ref = ann.last_references(transcripts(spark, rows))
    assert {(r["transcript_id"], r["sample_id"]) for r in ref.collect()} == {("ENST1", "s1"), ("ENST2", "s0")}
    out = ann.gtf_lines(ref).orderBy("chrom", "strand", "start", "end", "transcript_id", "level", "exon_number").collect()
    assert [r["line"].split("\t")[2:5] for r in out] == [["gene", "3", "4"], ["transcript", "3", "4"], ["exon", "3", "4"], ["transcript", "5", "30"], ["exon", "5", "9"], ["exon", "20", "30"]]
    assert out[5]["line"].endswith('exon_number "2";')


def test_features(spark):
    a = 'gene_id "g"; transcript_id "t";'
    records = ann.gtf_records(lines(spark, [gtf("gene", 1, 9, 'gene_id "g";'), gtf("transcript", 1, 9, a), gtf("transcript", 1, 8, a + ' tag "x";'), gtf("exon", 1, 3, a), gtf("exon", 5, 9, a + ' exon_id "e";')]))
    table = feat.features(records)
    assert {r["id"] for r in table.collect()} == {"g", "t", "t_1", "exon_1", "e"}
    merged = {r["id"]: r for r in feat.features(records, merge=True).collect()}
    assert set(merged) == {"g", "t", "exon_1", "e"} and merged["t"]["end"] == 9 and [p["k"] for p in merged["t"]["pairs"]] == ["gene_id", "tag", "transcript_id"]
    assert {tuple(r) for r in feat.relations(table).collect()} == {("g", "t", 1), ("g", "t_1", 1), ("t", "exon_1", 1), ("t", "e", 1), ("g", "exon_1", 2), ("g", "e", 2)}
    assert {tuple(r) for r in feat.feature_counts(table).collect()} == {("gene", 1), ("transcript", 2), ("exon", 2)}
    assert {tuple(r) for r in feat.feature_counts(table.limit(0)).collect()} == {("gene", 0), ("transcript", 0), ("exon", 0)}
