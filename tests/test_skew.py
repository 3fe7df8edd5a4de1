import random
from collections import Counter

from pyspark.sql import functions as F

from strandloom.operators.skew import SPLIT, balanced_fragments, balanced_join, balanced_stats, key_loads, shard_plan, with_task


def frame(spark, n=4000):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 6 + [f"k{rng.randrange(40)}", "", "*", None]), rng.choice([None, *(f"r{j}" for j in range(300))]), rng.choice([None, "a", "b"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "ord bigint, key string, read string, load string").repartition(5)


def test_stats_equal_brute_force(spark):
    rows, df = frame(spark)
    want = {}
    for _, k, r, x in rows:
        if k not in (None, "", "*"):
            w = want.setdefault(k, [0, set(), set()])
            w[0] += 1
            if r is not None:
                w[1].add(r)
                if x is not None:
                    w[2].add((r, x))
    found = balanced_stats(df, "key", ["ord"], {"reads": ["read"], "both": ["read", "load"]}, ["", "*"], tasks=7).collect()
    assert {r["key_value"]: (r["n_rows"], r["reads"], r["both"]) for r in found} == {k: (n, len(a), len(b)) for k, (n, a, b) in want.items()}
    assert len(found) == len(want)
    assert balanced_stats(df.limit(0), "key", ["ord"], {"reads": ["read"]}).count() == 0


def test_tasks_are_balanced(spark):
    _, df = frame(spark)
    plan = shard_plan(key_loads(df, "key"), 8)
    assert len(plan.large) <= SPLIT * 8 and len(plan.large["hot"]) > 8 // 2
    placed = with_task(df.where("key is not null").withColumn("s", F.xxhash64("ord")), "key", "s", plan)
    loads = [r["n"] for r in placed.groupBy("task_id").agg(F.count("*").alias("n")).collect()]
    assert max(loads) < 2 * sum(loads) / 8


def test_join_equals_plain_join(spark):
    rows, df = frame(spark)
    small = spark.createDataFrame([("hot", "x", 1), ("k1", "y", 2), ("k1", "y", 2), (None, "z", 3), ("other", "w", 4)], "key string, read string, v int")
    for how in ("inner", "left"):
        found = balanced_join(df, small, "key", how, tasks=6)
        assert found.columns == ["ord", "key", "read", "load", "read_right", "v"]
        want = df.join(small.withColumnRenamed("read", "read_right"), "key", how).select(found.columns)
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.collect()))
    clash = df.withColumnsRenamed({"load": "task_id", "read": "join_key"})
    assert balanced_join(clash, small, "key").columns == ["ord", "key", "join_key", "task_id", "read", "v"]
    assert balanced_join(clash, small, "key").count() == balanced_join(df, small, "key").count()
    assert balanced_join(df.limit(0), small, "key").count() == 0
    assert balanced_join(df, small.limit(0), "key", "left").count() == len(rows)


def largest_share(df, tasks):
    """Rows of the largest partition, as a multiple of the mean."""
    loads = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(loads) * tasks / sum(loads)


def test_nulls_and_equal_rows_are_spread(spark):
    small = spark.createDataFrame([("hot", 1), ("k1", 2), (None, 3)], "key string, v int")
    half_null = spark.range(40_000).selectExpr("if(id % 2 = 0, null, concat('k', id % 50)) as key")
    equal = spark.range(40_000).selectExpr("if(id % 5 < 3, 'hot', concat('k', id % 50)) as key")
    for df in (half_null, equal):
        placed = balanced_fragments(df.repartition(5), small, "key", "left", tasks=8)
        assert largest_share(placed, 8) < 2
        plain = df.join(small, "key", "left").groupBy("key", "v").count()
        assert Counter(map(tuple, placed.groupBy("key", "v").count().collect())) == Counter(map(tuple, plain.collect()))


def test_grouping_by_task_needs_no_shuffle(spark):
    df = spark.range(100).selectExpr("concat('k', id % 7) as key")
    small = spark.createDataFrame([("k1", 2)], "key string, v int")
    joined = balanced_fragments(df, small, "key", tasks=8)
    grouped = joined.groupBy("task_id", "key").count()
    exchanges = lambda x: x._jdf.queryExecution().executedPlan().toString().count("+- Exchange ") + x._jdf.queryExecution().executedPlan().toString().count(":- Exchange ")
    assert "shufflepartitionidpassthrough" in grouped._jdf.queryExecution().executedPlan().toString()
    assert exchanges(grouped) == exchanges(joined)
