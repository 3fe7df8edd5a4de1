"""Near-duplicate sequences: order MinHash candidates, verified by banded alignment.

Records are grouped into classes of equal sequences first. A class's sequence is cut into k-mers, each labelled with its
number of occurrence. A sketch keeps the k-mers of smallest hash in their order in the sequence, under each of many hash
functions; classes with an equal sketch meet in its bucket. The classes of a bucket that holds too many are sketched
further: each level keeps one k-mer more, the one of smallest hash among those left, under each of a few more hash
functions, and the classes that agree in it meet in a smaller bucket. A class without a k-mer left (there is one at most
in a bucket) meets all others of its bucket. What still holds too many at the last level is compared by pairs of blocks,
so no task holds a bucket. Pairs that meet, and whose lengths allow the similarity, are aligned within the band of
insertions and deletions that the threshold allows.

Of a pair with i of u k-mers in common, one sketch of two meets with probability i(i-1) / (u(u-1)), and a further one
that keeps k with (i-k+1) / (u-k+1). At the default similarity the first is at least 1/2 (i = 3, u = 4) and the others
at least 1/2, or 1/3 at the last level (i = 6, u = 8). A pair is missed once in 10^12 times if its buckets aren't crowded,
and if all are, at most once in 40,000.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.groups import smallest_labels
from strandloom.shared import if_small, written

SKETCHES = 40
KEPT = 2
#: The classes of a bucket that holds more are sketched further, and compared by blocks of so many at the last level.
BUCKET = 256
#: Further sketches of a class in a crowded bucket at each level, and the k-mers that the last level keeps.
FURTHER = 3
DEEPEST = 6
#: Records of a class that one task pairs with those of another at a time.
COPIES = 1024
#: K-mers of a matrix.
CELLS = 1 << 20


def with_kmers(df: DataFrame, seq: str, k: int) -> DataFrame:
    """``df`` with kmers array<bigint>: a hash of each k-mer of the array ``seq`` together with its number of occurrence."""
    words = df.withColumn("words", F.expr(f"transform(sequence(1, greatest(size({seq}) - {k} + 1, 1)), i -> xxhash64(slice({seq}, i, {k})))"))
    once = F.expr("transform(words, w -> xxhash64(w, 1))")
    labelled = F.expr("transform(words, (w, i) -> xxhash64(w, size(filter(slice(words, 1, i + 1), y -> y = w))))")
    return words.withColumn("kmers", F.when(F.size(F.array_distinct("words")) == F.size("words"), once).otherwise(labelled)).drop("words")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def picked(kmers: np.ndarray, sizes: np.ndarray, seeds: Sequence[np.ndarray], kept: int) -> np.ndarray:
    """(rows, kept + levels): places of the k-mers that a sketch keeps, in order; places not below ``sizes`` are none.

    ``kmers``: a matrix padded beyond each row's ``sizes``. ``seeds``: a number for each row for the first ``kept``, and for
    each further one.
    """
    rows, width = np.arange(len(kmers)), kmers.shape[1]
    gone = np.arange(width) >= sizes[:, None]
    places = []
    for level, seed in enumerate(seeds):
        ranks = _mixed(kmers ^ _mixed(seed)[:, None])
        for _ in range(kept if level == 0 else 1):
            at = np.where(gone, np.uint64(2**64 - 1), ranks).argmin(axis=1)
            places.append(np.where(gone[rows, at], width, at))
            gone[rows, at] = True
    return np.sort(np.stack(places, axis=1), axis=1)


def _bucket_of(kmers: np.ndarray, places: np.ndarray, block: np.ndarray, way: np.ndarray) -> np.ndarray:
    """One number for the block, the hash functions and the k-mers kept, in order."""
    padded = np.c_[kmers, np.zeros(len(kmers), np.uint64)]
    key = _mixed(block ^ _mixed(way))
    for column in places.T:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + padded[np.arange(len(kmers)), column])
    return key.view(np.int64)


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, padded k-mers, sizes) of parts of a batch with a column kmers, by length."""
    lists = batch.column(batch.schema.get_field_index("kmers"))
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(sizes := lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    order = np.argsort(sizes, kind="stable")
    begin = 0
    while begin < len(order):
        most = max(1, CELLS // max(1, int(sizes[order[begin]])))
        part = order[begin : begin + most]
        part = part[: max(1, int(np.searchsorted(sizes[part], sizes[part[0]] * 5 // 4 + 1, side="right")))]
        n = sizes[part]
        column = np.arange(int(n.max(initial=1)))
        at = np.minimum((ends[part] - n)[:, None] + column, max(0, len(flat) - 1))
        yield part, np.where(column < n[:, None], flat[at] if len(flat) else np.uint64(0), np.uint64(0)), n
        begin += len(part)


def first_buckets(classes: DataFrame, sketches: int, kept: int) -> DataFrame:
    """(class, n, way bigint, bucket bigint): the bucket of each sketch of the classes (class, n, block_no, kmers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            for rows, kmers, sizes in _matrices(batch):
                found = np.empty((len(rows), sketches), np.int64)
                for j in range(sketches):
                    way = np.full(len(rows), j, np.uint64)
                    found[:, j] = _bucket_of(kmers, picked(kmers, sizes, [way], kept), block[rows], way)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * sketches), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows)) for c in batch.columns[:2]), lists], names=["class", "n", "buckets"])

    lists = classes.select("class", "n", "block_no", "kmers").mapInArrow(run, "class bigint, n int, buckets array<bigint>")
    return lists.select("class", "n", F.posexplode("buckets").alias("way", "bucket")).withColumn("way", F.col("way").cast("bigint"))


def further_buckets(members: DataFrame, classes: DataFrame, sketches: int, kept: int, level: int, further: int = FURTHER) -> DataFrame:
    """(class, n, way, bucket) of the ``members`` (class, way) of crowded buckets, with one k-mer more, in ``further`` ways.

    ``way`` names the hash functions of all levels: the sketch, then the choice at each level, as digits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            ways = batch.column(3).to_numpy(zero_copy_only=False)
            for rows, kmers, sizes in _matrices(batch):
                for choice in range(further):
                    way = ways[rows] + sketches * further ** (level - 1) * choice
                    # Levels up to here share their hash functions with the buckets that are divided.
                    seeds = [(way % (sketches * further**k) + (k << 40)).astype(np.uint64) for k in range(level + 1)]
                    bucket = _bucket_of(kmers, picked(kmers, sizes, seeds, kept), block[rows], (way + (level << 40)).astype(np.uint64))
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows)) for c in batch.columns[:2]), pa.array(way), pa.array(bucket)], names=["class", "n", "way", "bucket"])

    rows = members.select("class", "way").join(if_small(classes.select("class", "n", "block_no", "kmers")), "class").select("class", "n", "block_no", "way", "kmers")
    return rows.mapInArrow(run, "class bigint, n int, way bigint, bucket bigint")


def _fits(na: Column, nb: Column, similarity: float) -> Column:
    """Whether different sequences of these lengths can be so similar: the common part is shorter than one of them."""
    return F.least(na, nb) - F.when(na == nb, 1).otherwise(0) >= (na + nb) * (similarity / (1 + similarity)) - 1e-6


def _pairs_in(left: DataFrame, right: DataFrame, key: list[str], fits: Column | None, similarity: float) -> DataFrame:
    """(a, b), a < b: classes of the two sides that share a bucket and whose lengths allow the similarity."""
    a = left.select(*key, *(F.col(c).alias(f"{c}_a") for c in left.columns if c not in key))
    b = right.select(*key, *(F.col(c).alias(f"{c}_b") for c in right.columns if c not in key))
    allowed = (F.col("class_a") != F.col("class_b")) & _fits(F.col("n_a"), F.col("n_b"), similarity)
    pairs = a.join(b, key).where(allowed if fits is None else allowed & fits)
    return pairs.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))


def by_blocks(members: DataFrame, counts: DataFrame, size: int, similarity: float) -> DataFrame:
    """(a, b) of buckets of any number of ``members``: a key for each pair of blocks of about ``size`` classes."""
    cut = members.join(if_small(counts), "bucket").withColumn("blocks", F.ceil(F.col("members") / size).cast("int"))
    cut = cut.select("bucket", "class", "n", F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cut = cut.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "class", "n", "own")
    once = (F.col("class_a") < F.col("class_b")) & ((F.col("own_a") != F.col("own_b")) | (F.col("x") == F.col("y")))
    return _pairs_in(cut, cut, ["bucket", "x", "y"], once, similarity)


def candidates(classes: DataFrame, similarity: float, sketches: int = SKETCHES, kept: int = KEPT, bucket: int = BUCKET, further: int = FURTHER, deepest: int = DEEPEST) -> DataFrame:
    """(a, b) bigint, a < b: pairs of ``classes`` (class, n, block_no, kmers), a written table, that meet, once each."""
    wide = max(classes.rdd.getNumPartitions(), 2 * classes.sparkSession.sparkContext.defaultParallelism)  # few bytes, much work
    buckets = written(first_buckets(classes.repartition(wide, "class"), sketches, kept), "buckets")
    met, level = None, 0
    while True:
        counts = written(buckets.groupBy("bucket").agg(F.count("*").alias("members")).where(F.col("members") > bucket), "crowded")
        large = if_small(counts.select("bucket"))
        ordered = F.col("class_a") < F.col("class_b")
        calm = buckets.join(large, "bucket", "left_anti").select("bucket", "class", "n")
        found = _pairs_in(calm, calm, ["bucket"], ordered, similarity)
        met = found if met is None else met.unionByName(found)
        if counts.isEmpty():
            break
        crowded = written(buckets.join(large, "bucket", "left_semi"), "members")
        if kept + level >= deepest:
            met = met.unionByName(by_blocks(crowded.select("bucket", "class", "n"), counts, bucket, similarity))
            break
        # A class without a k-mer left is the only one of its bucket.
        spent = crowded.join(if_small(classes.where(F.size("kmers") <= kept + level).select("class")), "class", "left_semi")
        met = met.unionByName(_pairs_in(spent.select("bucket", "class", "n"), crowded.select("bucket", "class", "n"), ["bucket"], None, similarity))
        level += 1
        buckets = written(further_buckets(crowded, classes, sketches, kept, level, further), "buckets")
    return met.distinct()


def common_in_band(left: Sequence[np.ndarray], right: Sequence[np.ndarray], band: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair, or -1 if it needs more than ``band`` insertions and deletions."""
    na, nb = np.fromiter(map(len, left), int, len(left)), np.fromiter(map(len, right), int, len(right))
    w, rows = int(band.max(initial=0)), int(na.max(initial=0))
    far = np.iinfo(np.int32).max // 2
    a = np.zeros((len(left), rows), np.int64)
    b = np.zeros((len(left), max(rows, int(nb.max(initial=0))) + 2 * w + 2), np.int64)
    for k, (x, y) in enumerate(zip(left, right)):
        a[k, : len(x)] = x
        b[k, w + 1 : w + 1 + len(y)] = y
    # Column c of a row i stands for place j = i + c - w of the right sequence.
    column = np.arange(2 * w + 1)
    j0 = column - w
    cost = np.where((j0 >= 0) & (j0 <= nb[:, None]), j0, far)
    answer = np.where(na == 0, nb, far)
    for i in range(1, rows + 1):
        j = i + j0
        here = b[:, i : i + 2 * w + 1]
        same = (here == a[:, i - 1 : i]) & (j >= 1) & (j <= nb[:, None])
        step = np.minimum(np.where(same, cost, far), np.c_[cost[:, 1:], np.full(len(cost), far)] + 1)
        step = np.where((j >= 0) & (j <= nb[:, None]), step, far)
        # The cheapest place to the left, with one insertion for each step from it.
        step = np.minimum.accumulate(step - column, axis=1) + column
        cost = np.where((j >= 0) & (j <= nb[:, None]), step, far)
        done = np.flatnonzero(na == i)
        at = nb[done] - i + w
        fits = (at >= 0) & (at <= 2 * w)
        answer[done[fits]] = cost[done[fits], at[fits]]
    return np.where(answer <= band, (na + nb - answer) // 2, -1)


def aligned_pairs(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of those (a, b, left, right) whose common subsequence is at least ``similarity`` of what they hold together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            total = (pdf["left"].map(len) + pdf["right"].map(len)).to_numpy()
            # common / (total - common) >= s, that is total - 2 common <= total (1 - s) / (1 + s)
            band = np.floor(total * (1 - similarity) / (1 + similarity) + 1e-9).astype(int)
            order = np.argsort(total, kind="stable")[::-1]
            begin = 0
            while begin < len(order):
                # The longest pair left sets the size of the matrices.
                part = order[begin : begin + max(1, min(4096, CELLS // (2 * int(total[order[begin]]) + 1)))]
                rows = pdf.iloc[part]
                common = common_in_band(rows["left"].tolist(), rows["right"].tolist(), band[part])
                yield rows.loc[common >= 0, ["a", "b"]]
                begin += len(part)

    return pairs.mapInPandas(run, "a bigint, b bigint")


def near_classes(df: DataFrame, id_col: str, block: Sequence[str], seq: str, similarity: float, k: int = 1, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(members, links): (record, class) of each record, and the pairs (a, b) of classes that are nearly the same.

    ``seq`` is an array of whole numbers; records are compared within equal ``block`` columns. A class is named by its
    smallest record. Rows with a null id, a null block column or a null or empty sequence have no class.
    """
    whole = F.size(F.coalesce(F.col(seq), F.array())) > 0
    for c in (id_col, *block):
        whole = whole & F.col(c).isNotNull()
    rows = df.where(whole).select(F.col(id_col).cast("bigint").alias("record"), F.to_json(F.array(*(F.col(c).cast("string") for c in block))).alias("block"), F.col(seq).cast("array<bigint>").alias("seq"))
    classes = with_kmers(rows.groupBy("block", "seq").agg(F.min("record").alias("class")), "seq", k)
    classes = written(classes.withColumns({"block_no": F.xxhash64("block"), "n": F.size("seq")}), "classes")
    members = written(rows.join(if_small(classes.select("block", "seq", "class")), ["block", "seq"]).select("record", "class"), "members")
    met = candidates(classes, similarity, **sizes)
    side = lambda key, name: if_small(classes.select(F.col("class").alias(key), F.col("seq").alias(name), F.col("block").alias(f"{name}_block")))
    both = met.join(side("a", "left"), "a").join(side("b", "right"), "b").where("left_block = right_block").select("a", "b", "left", "right")
    return members, written(aligned_pairs(both, similarity), "links")


def near_pairs(df: DataFrame, id_col: str, block: Sequence[str], seq: str, similarity: float, **how: int) -> DataFrame:
    """(left_key, right_key) bigint, left_key < right_key: every pair of records that are nearly or exactly the same.

    Similarity is the length of the longest common subsequence over that of both less the common part, for sequences
    of distinct numbers in order the share of their union that they have in common. An empty table gives no rows.
    """
    members, links = near_classes(df, id_col, block, seq, similarity, **how)
    copies = written(members.groupBy("class").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    # Classes of many records are cut into blocks, so that a key holds the records of two blocks.
    blocks = if_small(copies.where(F.col("copies") > COPIES).select("class", F.ceil(F.col("copies") / COPIES).cast("int").alias("blocks")))
    placed = members.join(blocks, "class", "left").select("class", "record", F.pmod(F.xxhash64("record"), F.coalesce("blocks", F.lit(1))).cast("int").alias("at"))
    each = links.unionByName(copies.select(F.col("class").alias("a"), F.col("class").alias("b")))
    for end in ("a", "b"):
        of = blocks.select(F.col("class").alias(end), "blocks")
        each = each.join(of, end, "left").withColumn(f"{end}_at", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
    for end, name in (("a", "x"), ("b", "y")):
        each = each.join(placed.select(F.col("class").alias(end), F.col("at").alias(f"{end}_at"), F.col("record").alias(name)), [end, f"{end}_at"])
    pairs = each.where("a <> b or x < y")
    return pairs.select(F.least("x", "y").alias("left_key"), F.greatest("x", "y").alias("right_key"))


def near_links(df: DataFrame, id_col: str, block: Sequence[str], seq: str, similarity: float, **how: int) -> DataFrame:
    """(record, class_key, group_key, n_links) bigint: each record's class of equal records, the smallest record that it
    is linked to directly or through others, and the number of records nearly or exactly the same as it."""
    members, links = near_classes(df, id_col, block, seq, similarity, **how)
    copies = written(members.groupBy("class").agg(F.count("*").alias("copies")), "copies")
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    others = both.join(copies.select(F.col("class").alias("b"), "copies"), "b").groupBy(F.col("a").alias("class")).agg(F.sum("copies").alias("others"))
    labels = smallest_labels(links.select(F.col("b").alias("hi"), F.col("a").alias("lo"))).select(F.col("id").alias("class"), "label")
    per_class = copies.join(others, "class", "left").join(labels, "class", "left")
    joined = members.join(if_small(written(per_class, "sizes")), "class")
    return joined.select(F.col("record").alias(id_col), F.col("class").alias("class_key"), F.coalesce("label", "class").alias("group_key"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
