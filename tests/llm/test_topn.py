import json
import random
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from strandloom.llm import topn

DATA = Path("/root/testdata/sf0.1/bu_reads.parquet")


def brute(rows, n):
    best = {}
    for g, h, s, i in rows:
        if None not in (g, h, s, i):
            best.setdefault((g, h), {})
            best[g, h][i] = max(s, best[g, h].get(i, s))
    return {(*k, r + 1, i) for k, items in best.items() for r, (i, _) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:n])}


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["s1", "s1", "s2", None]), rng.choice(["hot"] * 8 + [f"b{i}" for i in range(40)]), rng.choice([None, 0, 5, *range(300)]), rng.choice([None, *(f"r{i}" for i in range(900))])) for _ in range(6000)]
    df = spark.createDataFrame([(*r, "x") for r in rows + rows[:500]], "g string, h string, score int, item string, group_key string").repartition(5)
    for n in (1, 3):
        found = [tuple(r) for r in topn.top_n(df, ["g", "h"], "score", "item", n, row_group_rows=100).collect()]
        assert len(found) == len(set(found)) and set(found) == brute(rows, n)
    assert topn.top_n(df.limit(0), ["g", "h"], "score", "item", 3).count() == 0


def test_row_groups_are_skipped(spark):
    """A group over many row groups: only those that can hold one of its best items are read."""
    df = spark.range(0, 60_000).selectExpr("'g' as g", "cast(id % 5000 as int) as score", "concat('item', lpad(cast(id as string), 40, 'x')) as item")
    path = topn.cluster(df, ["g"], "score", "item")
    files = [r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect()]
    read, skipped = map(sum, zip(*(topn.best_of_file(f, 3)[1:] for f in files)))
    assert skipped > read > 0
    best = topn.best_items(topn.top_of_clustered(spark, path, 3).toPandas(), 3)
    assert {x[-5:] for x in best["item"]} == {"14999", "19999", "24999"}


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables aren't here")
def test_most_row_groups_of_the_largest_group_are_skipped(spark):
    """Of the BU that holds a tenth of the rows, only the row groups with its best reads and its last rows are read."""
    path = topn.cluster(spark.read.parquet(str(DATA)), ["sample_id", "bu"], "read_length", "read_id")
    files = [r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect()]
    read, skipped = map(sum, zip(*(topn.best_of_file(f, 3)[1:] for f in files)))
    hot = spark.read.parquet(str(DATA)).groupBy("sample_id", "bu").count().orderBy("count", ascending=False).first()
    key = json.dumps([hot["sample_id"], hot["bu"]], separators=(",", ":"))
    own = sum(topn._bounds(m, g)[1] == key for f in files for m in [pq.ParquetFile(f.removeprefix("file:")).metadata] for g in range(m.num_row_groups))
    assert own >= hot["count"] // topn.ROW_GROUP_ROWS - 1 >= 3
    assert skipped >= own - 1 and read > 0


def test_equal_scores_over_many_row_groups(spark, monkeypatch):
    """No row group of equal scores can be skipped; each is merged with the best rows of its group only."""
    df = spark.range(0, 20_000, 1, 1).selectExpr("if(id % 10 < 8, 'hot', concat('g', id % 1000)) as g", "7 as score", "lpad(cast(id as string), 6, '0') as item")
    path = topn.cluster(df, ["g"], "score", "item", 100)
    files = [r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect()]
    sizes, whole = [], topn.best_items
    monkeypatch.setattr(topn, "best_items", lambda rows, n: sizes.append(len(rows)) or whole(rows, n))
    results = [topn.best_of_file(f, 3) for f in files]
    assert sum(r[1] for r in results) >= 150
    assert sorted(sizes)[-len(files) - 1] <= 103  # all but the last ranking of each file
    got = {tuple(r) for r in topn.top_n(df, ["g"], "score", "item", 3, row_group_rows=100).collect()}
    assert got == {(g, k, i) for g, _, k, i in brute([(r["g"], "", r["score"], r["item"]) for r in df.collect()], 3)}


def test_fractional_scores(spark):
    """Scores that differ by less than one are told apart; NaN and null don't count."""
    rows = [("g", 1.25, "a"), ("g", 1.75, "b"), ("g", float("nan"), "c"), ("g", None, "d"), ("g", 1.5, "e"), ("h", -0.5, "a"), ("h", float("inf"), "b")]
    df = spark.createDataFrame(rows, "g string, score double, item string")
    want = {("g", 1, "b"), ("g", 2, "e"), ("h", 1, "b"), ("h", 2, "a")}
    assert {tuple(r) for r in topn.top_n(df, ["g"], "score", "item", 2).collect()} == want
    exact = spark.createDataFrame([("g", Decimal("90071992547409930.01"), "a"), ("g", Decimal("90071992547409930.02"), "b")], "g string, score decimal(20,2), item string")
    assert [r["item"] for r in topn.top_n(exact, ["g"], "score", "item", 1).collect()] == ["b"]
    with pytest.raises(TypeError, match="not numbers"):
        topn.top_n(spark.createDataFrame([("g", "x", "a")], "g string, score string, item string"), ["g"], "score", "item", 1)


def test_other_file_systems_are_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        topn._readable("s3a://bucket/folder")
