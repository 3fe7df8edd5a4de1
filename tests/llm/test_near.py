import random

import numpy as np
import pytest

from strandloom.llm import near, queries
from strandloom.llm.near import common_in_band, near_links, near_pairs


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            row[j], prev = (prev + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_banded_alignment():
    rng = random.Random(1)
    seq = lambda n: [rng.randrange(6) for _ in range(n)]
    pairs = [(seq(rng.randrange(0, 20)), seq(rng.randrange(0, 20))) for _ in range(800)]
    band = np.array([rng.randrange(0, 12) for _ in pairs])
    got = common_in_band([np.array(a) for a, _ in pairs], [np.array(b) for _, b in pairs], band)
    for (a, b), w, c in zip(pairs, band, got):
        d = len(a) + len(b) - 2 * lcs(a, b)
        assert c == (lcs(a, b) if d <= w else -1)
    assert len(common_in_band([], [], np.array([], int))) == 0


def records(n, seed, shared=0):
    rng = random.Random(seed)
    base = [sorted(rng.sample(range(shared, 60), rng.choice([1, 2, 3, 4, 6, 8, 14]))) for _ in range(12)]
    rows = []
    for i in range(n):
        s = set(rng.choice(base)) | set(range(shared))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            s ^= {rng.randrange(shared, 60)}
        rows.append((i, rng.choice(["c1", "c2", None]), rng.choice(["+", "-"]), sorted(s) if rng.random() > 0.03 else None))
    return rows


def jaccard_pairs(rows, least):
    out = set()
    for i, c, d, s in rows:
        for j, c2, d2, s2 in rows:
            if i < j and c is not None and (c, d) == (c2, d2) and s and s2 and len({*s} & {*s2}) >= least * len({*s} | {*s2}):
                out.add((i, j))
    return out


@pytest.mark.parametrize("bucket, shared", [(256, 0), (5, 0), (5, 3)])
def test_pairs_equal_brute_force(spark, bucket, shared):
    rows = records(350, bucket + shared, shared)
    df = spark.createDataFrame([(*r, "x") for r in rows], "tx bigint, chrom string, strand string, seq array<int>, a string").repartition(4)
    found = [tuple(r) for r in near_pairs(df, "tx", ["chrom", "strand"], "seq", 0.75, bucket=bucket).collect()]
    assert len(found) == len(set(found)) and set(found) == jaccard_pairs(rows, 0.75)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near, "if_small", lambda df: df)
    rows = records(120, 9)
    df = spark.createDataFrame(rows, "tx bigint, chrom string, strand string, seq array<int>")
    assert {tuple(r) for r in near_pairs(df, "tx", ["chrom", "strand"], "seq", 0.75, bucket=8).collect()} == jaccard_pairs(rows, 0.75)


def test_links(spark):
    rows = records(150, 4)
    df = spark.createDataFrame(rows, "tx bigint, chrom string, strand string, seq array<int>")
    found = {r["tx"]: r for r in near_links(df, "tx", ["chrom", "strand"], "seq", 0.75).collect()}
    pairs = jaccard_pairs(rows, 0.75)
    usable = {i: (c, d, tuple(s)) for i, c, d, s in rows if c is not None and s}
    assert set(found) == set(usable)
    for i, r in found.items():
        assert r["n_links"] == sum(i in p for p in pairs)
        assert r["class_key"] == min(j for j in usable if usable[j] == usable[i])
    for a, b in pairs:
        assert found[a]["group_key"] == found[b]["group_key"] <= a
    assert near_pairs(df.limit(0), "tx", ["chrom", "strand"], "seq", 0.75).count() == 0


def test_repeated_kmers_keep_order(spark):
    """Sequences with repeats: k-mers are labelled, and alignment counts each repeat once."""
    rows = [(1, "b", [1, 2, 1, 2, 1, 2, 1, 2, 9]), (2, "b", [1, 2, 1, 2, 1, 2, 1, 2]), (3, "b", [9, 8, 7, 6, 5, 4, 3, 2]), (4, "b", [2, 1, 2, 1])]
    df = spark.createDataFrame(rows, "id bigint, block string, seq array<bigint>")
    assert {tuple(r) for r in near_pairs(df, "id", ["block"], "seq", 0.75).collect()} == {(1, 2)}
    assert {tuple(r) for r in near_pairs(df, "id", ["block"], "seq", 0.75, k=2).collect()} == {(1, 2)}


def test_a_start_is_never_an_end(spark, tmp_path):
    """An exon of one position has two boundaries, and an end doesn't match a start at its position."""
    exons = {1: [(5, 5), (8, 9)], 2: [(5, 6), (8, 9)], 3: [(10, 20)], 4: [(20, 30)], 5: [(10, 20), (20, 30)], 6: [(10, 20), (25, 30)], 7: [(10, 20), (20, 30), (9, 1)], 8: [(2**31 - 1, 2**31 - 1)], 9: [(2**31 - 1, 2**31 - 1)]}
    df = spark.createDataFrame([(k, "c", "+", x) for k, x in exons.items()], "tx_key bigint, chrom string, strand string, exons array<struct<exon_start: int, exon_end: int>>")
    df.write.parquet(f"{tmp_path}/transcripts.parquet")
    sides = [(k, "c", "+", {("start", a) for a, b in x if a <= b} | {("end", b) for a, b in x if a <= b}) for k, x in exons.items()]
    found = {tuple(r) for r in queries.p5_found(spark, str(tmp_path)).collect()}
    assert found == jaccard_pairs(sides, 0.75) == {(5, 7), (8, 9)}
    seq = {r["tx_key"]: len(r["boundaries"]) for r in queries._boundaries(spark, str(tmp_path)).collect()}
    assert seq == {k: len(s) for k, _, _, s in sides}
    assert {r["tx_key"]: r["n_links"] for r in queries.p5_links(spark, str(tmp_path)).collect()} == {k: int(k in (5, 7, 8, 9)) for k in exons}


def test_last_level_is_compared_by_blocks(spark):
    """Buckets that stay crowded at the last level lose no pair."""
    rows = records(200, 11, shared=3)
    df = spark.createDataFrame(rows, "tx bigint, chrom string, strand string, seq array<int>").repartition(3)
    found = [tuple(r) for r in near_pairs(df, "tx", ["chrom", "strand"], "seq", 0.75, bucket=4, deepest=2).collect()]
    assert len(found) == len(set(found)) and set(found) == jaccard_pairs(rows, 0.75)


def test_recall_in_a_crowded_locus(spark):
    """Many records that share boundaries and few of which are alike: at least nine tenths of the planted pairs are found."""
    rng = random.Random(5)
    shared, rows, planted = list(range(6)), [], set()
    for i in range(0, 1200, 2):
        own = rng.sample(range(10, 4000), rng.choice([1, 2, 4, 8, 12]))
        rows += [(i, "c", "+", sorted(shared + own)), (i + 1, "c", "+", sorted(shared + own[1:] + [5000 + i] * (len(own) > 7)))]
    planted = {p for p in jaccard_pairs(rows, 0.75) if rows[p[0]][3] != rows[p[1]][3]}
    df = spark.createDataFrame(rows, "tx bigint, chrom string, strand string, seq array<int>").repartition(4)
    found = {tuple(r) for r in near_pairs(df, "tx", ["chrom", "strand"], "seq", 0.75, bucket=32).collect()}
    assert len(planted) > 500 and found <= jaccard_pairs(rows, 0.75)
    assert len(planted & found) >= 0.9 * len(planted)


def test_records_of_a_class_are_paired_by_blocks(spark, monkeypatch):
    """A class of many equal records, alone and linked to another such class."""
    monkeypatch.setattr(near, "COPIES", 7)
    rows = [(i, "c", "+", [1, 2, 3, 4] if i % 2 else [1, 2, 3, 4, 5]) for i in range(80)] + [(100 + i, "c", "+", [7, 8]) for i in range(30)] + [(200, "c", "+", [9])]
    df = spark.createDataFrame(rows, "tx bigint, chrom string, strand string, seq array<int>").repartition(3)
    found = [tuple(r) for r in near_pairs(df, "tx", ["chrom", "strand"], "seq", 0.75).collect()]
    assert len(found) == len(set(found)) and set(found) == jaccard_pairs(rows, 0.75)


def test_sketches_keep_the_order_of_the_sequence():
    """The k-mers of smallest hash, further ones among those left, by rising place; none beyond a row's size."""
    rng = np.random.default_rng(1)
    kmers = rng.integers(0, 2**63, (50, 9)).astype(np.uint64)
    sizes = rng.integers(1, 10, 50)
    seeds = [rng.integers(0, 99, 50).astype(np.uint64) for _ in range(3)]
    found = near.picked(kmers, sizes, seeds, 2)
    for row, n, at, *seed in zip(kmers, sizes, found, *seeds):
        left, want = list(range(n)), []
        for level, s in enumerate(seed):
            for _ in range(2 if level == 0 else 1):
                if left:
                    want.append(min(left, key=lambda i: near._mixed(row[i : i + 1] ^ near._mixed(np.array([s])))[0]))
                    left.remove(want[-1])
        assert at.tolist() == sorted(want) + [9] * (4 - len(want))
