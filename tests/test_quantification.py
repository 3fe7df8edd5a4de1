import pytest
from pyspark.sql import functions as F

from strandloom.functions.gtf import attribute, attributes
from strandloom.functions.readid import with_molecule
from strandloom.operators import alignments as aln
from strandloom.operators import genes, matrix, molecules, samples, transcripts

BC, UMI = "ACGTACGTACGTACGT", "AAAACCCCGGGG"


def rid(tag, bc=BC, umi=UMI):
    return f"{bc}_{umi}#{tag}"


@pytest.mark.parametrize(
    "name, umi",
    [
        (rid("r1_+"), UMI),
        (f"{BC}xx_bad_{UMI}#r", UMI),
        (f"{BC[:15]}_{UMI}#r", None),
        (f"{BC}_{UMI[:11]}#r", None),
        (f"{BC}\r_{UMI}#", UMI),
        (f"{BC} _{UMI}#", UMI),
        (f"{BC}\n_{UMI}#", None),
        ("", None),
        (None, None),
        (f"{BC}" + "x" * 100_000 + f"_{UMI}#", UMI),
    ],
)
def test_read_names(spark, name, umi):
    df = spark.createDataFrame([(name,)], "read_id string")
    found = [(r["barcode"], r["umi"], r["bu"]) for r in with_molecule(df).collect()]
    assert found == ([(BC, umi, BC + umi)] if umi else [])
    if umi is None:
        with pytest.raises(Exception, match="no barcode and umi"):
            with_molecule(df, strict=True).collect()


def assignments(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, read_id string, gene_id string")


def test_gene_matrix(spark):
    rows = [("s", rid("1"), "A"), ("s", rid("2"), "*"), ("s", rid("3"), "A"), ("t", rid("1"), "A"), ("t", rid("2"), "B"), ("s", rid("4", umi="T" * 12), "A"), ("s", "bad", "A"), ("s", None, "A"), ("s", rid("5", umi="C" * 12), None)]
    df = assignments(spark, rows)
    assert [tuple(r) for r in genes.gene_matrix(df).collect()] == [("A", f"s_{BC}", 2)]
    assert [tuple(r) for r in genes.gene_matrix(df, append_sample=False).collect()] == [("A", BC, 2)]
    assert genes.several_genes(genes.molecule_genes(df)).count() == 1
    assert genes.gene_matrix(df.limit(0)).count() == 0


def test_gene_matrix_ignores_row_order(spark):
    rows = [("s", rid(str(i), umi=f"{i % 7:012d}"), f"G{i % 3 if i % 7 < 3 else 0}") for i in range(60)]
    a, b = (sorted(map(tuple, genes.gene_matrix(assignments(spark, x)).collect())) for x in (rows, rows[::-1]))
    assert a == b


def test_one_file_four_meanings(spark):
    """A read mapped to T1, later to *: valid for the filter, dropped by the BU table, not unique."""
    reads = spark.createDataFrame([("s", 1, rid("r"), "T1"), ("s", 2, rid("r"), "*"), ("s", 3, rid("q", umi="T" * 12), "T2"), ("s", 4, rid("n", umi="G" * 12), None)], "sample_id string, ord bigint, read_id string, transcript_id string")
    align = spark.createDataFrame([("s", i, n, length) for i, (n, length) in enumerate([(rid("r"), 9), (rid("q", umi="T" * 12), 5), (rid("q", umi="T" * 12), None), (rid("n", umi="G" * 12), 4), ("unmapped", 7)])], "sample_id string, ord bigint, query_name string, query_length int")
    assert {r["read_id"] for r in aln.valid_reads(reads).collect()} == {rid("r"), rid("q", umi="T" * 12)}
    lengths = molecules.read_lengths(reads, align)
    assert sorted(r["read_length"] for r in lengths.collect()) == [0, 5, 9]
    assert [(r["bu"], r["read_length"], r["status"]) for r in molecules.bu_table(lengths).collect()] == [(BC + "T" * 12, 5, "unique")]
    assert {r["read_id"] for r in transcripts.reads_once(reads).collect()} == {rid("q", umi="T" * 12), rid("n", umi="G" * 12)}
    stats = aln.filter_stats(align, reads, aln.filtered(align, aln.valid_reads(reads)), spark.createDataFrame([("s",), ("empty",)], "sample_id string"))
    assert {tuple(r) for r in stats.collect()} == {("s", 2, 5, 3), ("empty", 0, 0, 0)}


def test_representatives(spark):
    rows = [("s", 1, rid("r2"), "T1", 7), ("s", 2, rid("r1"), "T1", 7), ("s", 3, rid("r0"), "T1", 3), ("s", 4, rid("x", umi="T" * 12), "T1", 1), ("s", 5, rid("y", umi="T" * 12), "T2", 2), ("s", 6, rid("z"), "*", 99)]
    lengths = spark.createDataFrame(rows, "sample_id string, ord bigint, read_id string, transcript_id string, read_length int")
    bus = {r["bu"]: r for r in molecules.bu_table(lengths).collect()}
    assert bus[BC + UMI]["read_id"] == rid("r1") and bus[BC + UMI]["first_ord"] == 1
    other = bus[BC + "T" * 12]
    assert (other["read_id"], other["transcript_id"], other["read_length"], other["status"]) == ("ambiguous", "ambiguous", None, "ambiguous")
    table = molecules.bu_table(lengths)
    assert molecules.representatives(table).count() == molecules.representatives(table.drop("status")).count() == 1
    assert molecules.bu_table(lengths.limit(0)).count() == 0


def test_last_sample_wins_and_matrix(spark):
    sheet = spark.createDataFrame([("b", 0), ("a", 1)], "sample_id string, sample_idx bigint")
    bus = spark.createDataFrame([(s, BC + UMI, bc, UMI, rid("r"), "T", 5, "unique", 1) for s, bc in (("a", BC), ("b", BC))], "sample_id string, bu string, barcode string, umi string, read_id string, transcript_id string, read_length int, status string, first_ord bigint")
    cells = transcripts.representative_cells(bus, sheet)
    assert [tuple(r) for r in cells.collect()] == [(rid("r"), f"a_{BC}")]
    reads = spark.createDataFrame([(1, rid("r"), "c-T"), (2, rid("other"), "c-T"), (3, "twice", "c"), (4, "twice", "c")], "ord bigint, read_id string, transcript_id string")
    counted = transcripts.counted_reads(reads, cells)
    assert [tuple(r) for r in transcripts.transcript_matrix(counted).collect()] == [("c-T", f"a_{BC}", 1)]
    shared = matrix.shared_cells(matrix.unique_cells(bus), spark.createDataFrame([("only_here",), ("",)], "cell string"))
    assert {r[0] for r in shared.collect()} == {f"a_{BC}", f"b_{BC}", "only_here"}


def test_matrix_forms(spark):
    m = spark.createDataFrame([("g1", "b", 2), ("g2", "a", 1), ("g2", "gone", 7)], "gene_id string, cell string, n bigint")
    cells = spark.createDataFrame([("a",), ("b",), ("c",)], "cell string")
    kept = matrix.reindexed(m, cells)
    assert kept.count() == 2
    assert {tuple(r) for r in matrix.dense_rows(kept, cells, "gene_id").collect()} == {("g1", "0,2,0"), ("g2", "1,0,0")}
    rows, cols = matrix.numbered(kept.select("gene_id").distinct(), "gene_id"), matrix.numbered(cells, "cell")
    assert sorted(tuple(r) for r in matrix.triplets(kept, rows, cols, "gene_id").collect()) == [(1, 2, 2), (2, 1, 1)]
    assert {tuple(r) for r in matrix.pivoted(kept, "gene_id", ["a", "b"]).collect()} == {("g1", 0, 2), ("g2", 1, 0)}


def test_dense_rows_of_any_width(spark, monkeypatch):
    """More cells than the former bound (here 5) give their dense rows as well."""
    monkeypatch.setattr(matrix, "MAX_DENSE", 5, raising=False)
    names = [f"c{i:02d}" for i in range(23)]
    counts = {(g, c): (7 * g + i) % 11 for g in range(9) for i, c in enumerate(names) if (g * g + i) % 5 < g % 4}
    m = spark.createDataFrame([(f"g{g}", c, n) for (g, c), n in counts.items()] + [("g0", "gone", 3)], "gene_id string, cell string, n bigint").repartition(5)
    cells = spark.createDataFrame([(c,) for c in [*reversed(names), *names[:4], None]], "cell string")
    want = {(f"g{g}", ",".join(str(counts.get((g, c), 0)) for c in names)) for g in {0} | {g for g, _ in counts}}
    assert {tuple(r) for r in matrix.dense_rows(m, cells, "gene_id").collect()} == want
    assert matrix.dense_rows(m.limit(0), cells, "gene_id").count() == matrix.dense_rows(m, cells.limit(0), "gene_id").count() == 0


def test_numbered_over_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert all(r["v"] == r["idx"] for r in matrix.numbered(df, "v").collect())
    assert matrix.numbered(df.limit(0), "v").count() == 0


def test_sample_sheet(spark):
    rows = [(0, " s1 ", "f", None), (1, "", "f", ""), (2, " ", "f", "/abs/w/"), (3, "s3", "f", "w/x"), (4, None, "f", "")]
    sheet = samples.resolve_dirs(samples.clean_sheet(spark.createDataFrame(rows, "sample_idx bigint, sample_id string, fastq_path string, workdir string")), "/p/")
    assert {(r["sample_id"], r["workdir"], r["sample_dir"], r["out_dir"]) for r in sheet.collect()} == {("s1", "", "/p/per_sample/s1", "/p/per_sample/s1/OUT"), ("", "/abs/w/", "/abs/w", "/abs/w/OUT"), ("s3", "w/x", "/p/w/x", "/p/w/x/OUT")}
    with pytest.raises(ValueError, match="fastq_path"):
        samples.clean_sheet(sheet.drop("fastq_path"))
    with pytest.raises(ValueError, match="more than once"):
        samples.check_unique(sheet.unionByName(sheet))


@pytest.mark.parametrize(
    "text, want",
    [
        ('tag "a"; tag "b"; flag;', {"tag": "b", "flag": None}),
        ('note "x;y";', {"note": "x"}),
        ('  gene_id "G";; ', {"gene_id": "G"}),
        ('a ""v"" ; b  w', {"a": "v", "b": "w"}),
        ("", {"a": None}),
        (";;;", {"a": None}),
        (None, {"a": None}),
    ],
)
def test_attributes(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(*(attribute(attributes(F.col("t")), k).alias(k) for k in want)).first()
    assert row.asDict() == want
