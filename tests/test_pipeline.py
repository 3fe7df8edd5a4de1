import csv
import gzip

import numpy as np
import pytest

from strandloom.plans import pipeline
from strandloom.sinks import files
from strandloom.sources import text

BC = ["ACGTACGTACGTACGT", "TTTTACGTACGTACGT"]


def rid(b, u, tag):
    return f"{BC[b]}_{u * 12}#{tag}"


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(content.encode()))
    else:
        path.write_text(content)


@pytest.fixture
def project(tmp_path):
    put(tmp_path / "samples.tsv", "sample_id\tfastq_path\tworkdir\ns1\tf1\t\ns2\tf2\n\n")
    a = rid(0, "A", "1")
    for s in ("s1", "s2"):
        home = tmp_path / "per_sample" / s
        put(home / "OUT/OUT.read_assignments.tsv.gz", f"# c\n{a}\tc\t+\tT\tG1\tu\n{rid(0, 'C', '2')} c + T *\n{rid(1, 'G', '3')}\tc\t+\tT\tG{s[1]}\nbad c + T G1\nshort c\n")
        put(home / "OUT/OUT.transcript_model_reads.tsv.gz", f"# c\n{a}{s}\tT1\n{a}{s}\t\"T2\"\n{rid(0, 'C', '2')}{s}\tT1\nonly_one\n{rid(1, 'T', '9')}{s}\t*\n")
        put(home / f"{s}_sorted.sam", "@HD\tVN:1.6\n" + "".join(f"{n}\t0\tc\t{p}\t60\t4M\t*\t0\t0\t{q}\t*\tNM:i:0\n" for n, p, q in ((a + s, 7, "ACGT"), (a + s, 5, "AC"), (rid(0, "C", "2") + s, 1, "*"), ("other", 2, "A"))))
        exons = "\n".join(f'c\tIsoQuant\t{k}\t{x}\t{y}\t.\t+\t.\tgene_id "n{s}"; transcript_id "t{s}";' for k, x, y in (("transcript", 10, 90), ("exon", 60, 90), ("exon", 10, 30)))
        ref = "\n".join(f'c\tHAVANA\t{k}\t1\t5\t.\t-\t.\tgene_id "ENSG1"; transcript_id "ENST1";' for k in ("transcript", "exon"))
        put(home / "OUT/OUT.transcript_models.gtf", f"# c\n{exons}\n{ref}\n")
    put(tmp_path / "multisample/OUT/OUT.transcript_model_reads.tsv.gz", f"{a}s1\ttCOLL_000001\n{a}s2\ttCOLL_000001\n{rid(0, 'C', '2')}s1\tENST1\n{rid(0, 'C', '2')}s1\tENST1\n{rid(0, 'C', '2')}s2\tENST1\n")
    return tmp_path


def read(path):
    return gzip.decompress(path.read_bytes()).decode() if path.suffix == ".gz" else path.read_bytes().decode()


def test_whole_flow(spark, project):
    out = pipeline.run(spark, str(project / "samples.tsv"), str(project))
    cells = [f"{s}_{b}" for s in ("s1", "s2") for b in sorted(BC)]
    m = project / "multisample/matrices"
    assert read(m / "shared_barcodes.txt").split() == cells
    assert read(m / "gene_matrix.csv.gz").splitlines() == ["gene_id," + ",".join(cells), "G1,1,1,1,0", "G2,0,0,0,1"]
    assert read(m / "gene_matrix.mtx").splitlines() == ["%%MatrixMarket matrix coordinate integer general", "%", "2 4 4", "1 1 1", "1 2 1", "1 3 1", "2 4 1"]
    assert read(m / "gene_matrix_rows.txt") == "G1\nG2\n"
    assert read(m / "transcript_matrix.csv.gz").splitlines() == ["," + ",".join(cells), "tCOLL_000001,1,0,1,0", "ENST1,0,0,1,0"]
    with np.load(m / "transcript_matrix_csr/matrix-00000.npz") as z:
        assert z["shape"].tolist() == [2, 4] and z["indptr"].tolist() == [0, 2, 3] and z["indices"].tolist() == [0, 2, 2] and z["data"].tolist() == [1, 1, 1] and z["format"].item() == b"csr"
    bu = list(csv.DictReader(read(project / "per_sample/s1/OUT/s1_bu.csv").splitlines()))
    assert [(r["bu"], r["read_id"], r["transcript_id"], r["read_length"], r["status"]) for r in bu] == [(BC[0] + "A" * 12, rid(0, "A", "1") + "s1", "T2", "4", "unique"), (BC[0] + "C" * 12, rid(0, "C", "2") + "s1", "T1", "0", "unique")]
    assert read(project / "per_sample/s2/OUT/OUT.transcript_model_reads_with_length.tsv.gz").splitlines()[0] == "read_id\ttranscript_id\tread_length"
    stats = read(project / "multisample/merged/filtering_statistics.tsv")
    assert stats.split("\r\n")[1].split("\t")[:4] == ["s1", "2", "4", "3"]
    assert [r["pos"] for r in spark.read.parquet(str(project / "multisample/merged/all_samples_merged.parquet")).orderBy("rname", "pos").collect()] == [1, 1, 5, 5, 7, 7]
    gtf = read(project / "multisample/consensus/consensus.gtf").splitlines()
    assert gtf[0] == "# Consensus transcript annotation" and [x.split("\t")[2] for x in gtf[1:]] == ["gene", "transcript", "exon", "exon", "gene", "transcript", "exon"]
    block = read(project / "multisample/consensus/integrated_statistics.csv").split("\r\n")
    assert block[:8] == ["metric,value", "reference_transcripts,1", "novel_transcripts_before_collapse,2", "novel_transcripts_after_collapse,1", "total_transcripts_final,2", "", "sample_id,transcripts_after_read_filter", "s1,2"]
    assert spark.read.parquet(str(project / "multisample/consensus/database/features")).count() == 7 and out["relations"].count() == 8
    assert "s2\tf2\t\t" in read(project / "multisample/resolved_samples.tsv")


def test_skipped_steps_read_files(spark, project):
    pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["database", "transcripts"])
    before = read(project / "multisample/matrices/gene_matrix.csv.gz")
    out = pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["bu", "genes", "filter", "collapse", "database"])
    assert set(out) == {"sheet", "bus", "transcripts"} and out["transcripts"].count() == 3
    assert read(project / "multisample/matrices/gene_matrix.csv.gz") == before


def test_passing_transcripts(spark, tmp_path):
    put(tmp_path / "m.csv", ",c1,c2\nt1,3,2\nt2,4,\nt3,9,x\n\nt4,1e1,\n")
    raw = text.sample_lines(spark, {"s": str(tmp_path / "m.csv")})
    assert {r["transcript_id"] for r in text.passing_transcripts(raw, 5).collect()} == {"t1", "t4"}


def test_assignment_spaces(spark, tmp_path):
    put(tmp_path / "a.tsv", " r c\x1c+ T\x85G \n#x y z a b\n x # y\n")
    raw = text.sample_lines(spark, {"s": str(tmp_path / "a.tsv")})
    assert [(r["read_id"], r["gene_id"]) for r in text.read_assignments(raw).collect()] == [("r", "G")]


def test_collapse_of_large_annotations(spark, project):
    """Blocks that start at 16 MiB and later: their lines don't run into the next sample's, nor meet their own sample's first block."""
    both = lambda t, source, a, b: "".join(f'c\t{source}\t{k}\t{a}\t{b}\t.\t+\t.\tgene_id "g"; transcript_id "{t}";\n' for k in ("transcript", "exon"))
    far = ("#" + "x" * 998 + "\n") * ((17 << 20) // 1000 + 1)
    # Lone starts, in sample order: the consensus numbers follow the place of each group's leader.
    put(project / "per_sample/s1/OUT/OUT.transcript_models.gtf", both("n0", "IsoQuant", 5000, 5900) + far + both("ENST1", "HAVANA", 1, 5) + both("n1", "IsoQuant", 1000, 1900))
    put(project / "per_sample/s2/OUT/OUT.transcript_models.gtf", both("n1", "IsoQuant", 1000, 1900) + both("ENST1", "HAVANA", 1, 7) + both("n0", "IsoQuant", 5000, 5900))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        out = pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["genes", "filter", "database", "transcripts"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    found = {r["transcript_id"]: (r["sample_id"], r["exons"][0]["start"], r["exons"][0]["end"]) for r in out["consensus"].collect()}
    assert found == {"ENST1": ("s2", 1, 7), "tCOLL_000001": ("consensus", 5000, 5900), "tCOLL_000002": ("consensus", 1000, 1900)}


def test_cell_file_of_many_blocks(spark, project):
    """The cell file is read in several blocks and has blank lines; its cells are still numbered from 0 without holes."""
    pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["filter", "collapse", "database"])
    m = project / "multisample/matrices"
    (m / ".shared_barcodes.txt.crc").unlink(missing_ok=True)
    put(m / "shared_barcodes.txt", "\n\n".join(["", *read(m / "shared_barcodes.txt").split(), ""]))
    texts = {n: read(m / n) for n in ("transcript_matrix.mtx", "transcript_matrix_cols.txt", "transcript_matrix.csv.gz")}
    with np.load(m / "transcript_matrix_csr/matrix-00000.npz") as z:
        csr = {k: z[k].tolist() for k in z.files}
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["bu", "genes", "filter", "collapse", "database"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert {n: read(m / n) for n in texts} == texts
    with np.load(m / "transcript_matrix_csr/matrix-00000.npz") as z:
        assert {k: z[k].tolist() for k in z.files} == csr


def test_count_matrix_of_a_sample(spark, project):
    """s1 has a count matrix, in which its novel transcript has too few reads; s2 has none and keeps its own."""
    put(project / "per_sample/s1/OUT/transcript_matrix.csv", ",c1,c2\nts1,2,2\nENST1,0,1\nother,5,\n")
    skip = ["genes", "filter", "database", "transcripts"]
    run = lambda **how: pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=skip, **how)
    stats = lambda: read(project / "multisample/consensus/integrated_statistics.csv").split("\r\n")
    run()
    assert stats()[1:5] == ["reference_transcripts,1", "novel_transcripts_before_collapse,1", "novel_transcripts_after_collapse,0", "total_transcripts_final,1"]
    assert stats()[7:9] == ["s1,1", "s2,2"]
    run(min_reads=4)
    assert stats()[1:4] == ["reference_transcripts,1", "novel_transcripts_before_collapse,2", "novel_transcripts_after_collapse,1"]


@pytest.mark.parametrize("content", [None, " \n\n"])
def test_cells_without_a_cell_file(spark, project, content):
    pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["genes", "filter", "collapse", "database", "transcripts"])
    m = project / "multisample/matrices"
    if content:
        put(m / "shared_barcodes.txt", content)
    pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["bu", "genes", "filter", "collapse", "database"])
    cells = [f"{s}_{b}" for s, b in (("s1", BC[0]), ("s2", BC[0]))]
    assert read(m / "transcript_matrix_cols.txt").split() == cells
    assert read(m / "transcript_matrix.csv.gz").splitlines() == ["," + ",".join(cells), "tCOLL_000001,1,1", "ENST1,0,1"]


def test_filtered_alignments_of_each_sample(spark, project):
    """The statistics name what is there: each sample's alignments of valid reads, and an empty folder for a sample without any."""
    put(project / "per_sample/s2/OUT/OUT.transcript_model_reads.tsv.gz", "# c\n")
    pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["genes", "collapse", "database", "transcripts"])
    stats = {r["sample_id"]: r for r in csv.DictReader(read(project / "multisample/merged/filtering_statistics.tsv").splitlines(), delimiter="\t")}
    assert (stats["s1"]["reads_written"], stats["s2"]["reads_written"]) == ("3", "0")
    rows = spark.read.parquet(stats["s1"]["output_bam"]).collect()
    assert sorted(r["pos"] for r in rows) == [1, 5, 7] and {r["sample_id"] for r in rows} == {"s1"}
    assert stats["s2"]["output_bam"].endswith("s2_filtered.parquet") and list((project / "multisample/merged/filtered/s2_filtered.parquet").iterdir()) == []


def test_nonzero_table_and_axes(spark, project):
    pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["filter", "collapse", "database"], nonzero=True)
    m = project / "multisample/matrices"
    cell = lambda s: f"{s}_{BC[0]}"
    assert read(m / "nonzero.tsv.gz").splitlines() == ["transcript_id\tsampleid_barcode\tcount", f"tCOLL_000001\t{cell('s1')}\t1", f"tCOLL_000001\t{cell('s2')}\t1", f"ENST1\t{cell('s2')}\t1"]
    assert read(m / "transcript_matrix_csr/transcripts.txt").split() == ["tCOLL_000001", "ENST1"]
    assert read(m / "transcript_matrix_csr/barcodes.txt") == read(m / "shared_barcodes.txt")
    out = pipeline.run(spark, str(project / "samples.tsv"), str(project), skip=["filter", "collapse", "database"], append_sample=False)
    assert {r["cell"] for r in out["cells"].collect()} == set(BC) and {r["cell"] for r in out["transcripts"].collect()} == {BC[0]}


def test_large_outputs_stay_part_files(spark, project, monkeypatch):
    """Outputs above the bound are folders whose files, one after another, are the file; later steps read them."""
    sheet = str(project / "samples.tsv")
    names = ["multisample/matrices/gene_matrix.mtx", "multisample/matrices/gene_matrix.csv.gz", "multisample/consensus/consensus.gtf", "per_sample/s1/OUT/s1_bu.csv", "per_sample/s2/OUT/OUT.transcript_model_reads_with_length.tsv.gz"]
    pipeline.run(spark, sheet, str(project))
    texts = {n: read(project / n) for n in names}
    counts = read(project / "multisample/matrices/transcript_matrix.csv.gz")
    monkeypatch.setattr(files, "ONE_FILE_BYTES", 0)
    out = pipeline.run(spark, sheet, str(project))
    for n in names:
        parts = sorted(p for p in (project / n).iterdir() if p.name.startswith("part-"))
        assert "".join(gzip.decompress(p.read_bytes()).decode() if n.endswith(".gz") else p.read_text() for p in parts) == texts[n]
    assert not list(project.rglob("*-parts-*"))
    monkeypatch.undo()
    again = pipeline.run(spark, sheet, str(project), skip=["bu", "genes", "filter", "collapse"])
    assert again["bus"].count() == out["bus"].count() and again["features"].count() == out["features"].count()
    assert read(project / "multisample/matrices/transcript_matrix.csv.gz") == counts


def test_sparse_rows_over_several_files(spark, tmp_path):
    """Files end with the row that fills them; empty rows belong to the file before; stacked they are the matrix."""
    held = {(r, c): r * 10 + c + 1 for r in (1, 2, 5, 6, 9) for c in range(0, 7, r % 3 + 1)}
    m = spark.createDataFrame([(f"t{r}", f"c{c}", n) for (r, c), n in held.items()], "transcript_id string, cell string, n bigint").repartition(3)
    rows = spark.createDataFrame([(f"t{r}", r) for r in range(12)], "transcript_id string, idx bigint")
    cells = spark.createDataFrame([(f"c{c}", c) for c in range(8)], "cell string, idx bigint")
    for nonzeros, least in ((5, 3), (1 << 20, 1)):
        folder = tmp_path / f"csr{nonzeros}"
        n = files.write_csr(m, rows, cells, "transcript_id", str(folder), nonzeros)
        blocks = []
        for k in range(n):
            with np.load(folder / f"matrix-{k:05d}.npz") as z:
                dense = np.zeros(z["shape"], int)
                for r in range(len(dense)):
                    dense[r, z["indices"][z["indptr"][r] : z["indptr"][r + 1]]] = z["data"][z["indptr"][r] : z["indptr"][r + 1]]
                blocks.append(dense)
        assert n >= least and {(int(r), int(c)): int(v) for (r, c), v in np.ndenumerate(np.vstack(blocks)) if v} == held and sum(map(len, blocks)) == 12
    assert files.write_csr(m.limit(0), rows, cells, "transcript_id", str(tmp_path / "none")) == 1
