"""Per-key work when a few keys hold most records: fragments and replicates by load.

The load of every key is counted first (partial counts before the shuffle). Keys above a fraction of a task's fair
share are large; there are at most ``tasks * SPLIT`` of them, whatever the data. A large key is cut into shards in
proportion to its load; the others are packed by the load of their hash buckets. Shards and buckets are bin-packed to
tasks, largest first. Rows go to their task by that plan; a matching side is replicated only to the shards of large keys.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.shared import written

#: A key is large from 1 / SPLIT of a task's fair share on.
SPLIT = 4
BUCKETS_PER_TASK = 16


@dataclass(frozen=True)
class ShardPlan:
    """Tasks of each large key's shards and of each hash bucket of the other keys; bounded by the number of tasks."""

    tasks: int
    large: Mapping[str, Sequence[int]]
    buckets: Sequence[int]


def key_loads(df: DataFrame, key: str) -> DataFrame:
    """(key_value string, load bigint): rows of each key; null is a key of its own."""
    return df.groupBy(F.col(key).cast("string").alias("key_value")).agg(F.count("*").alias("load"))


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def shard_plan(loads: DataFrame, tasks: int) -> ShardPlan:
    """Bin-packing of shards and buckets to tasks, largest load first, each to the task with the least load so far.

    What comes to the driver is bounded by ``tasks``: at most SPLIT * tasks large keys and BUCKETS_PER_TASK * tasks sums.
    """
    n = tasks * BUCKETS_PER_TASK
    total = loads.agg(F.sum("load")).first()[0] or 0
    fair = max(1, math.ceil(total / tasks))
    is_large = F.col("load") * SPLIT > fair
    large = {r["key_value"]: r["load"] for r in loads.where(is_large).collect()}
    rest = {r["b"]: r["load"] for r in loads.where(~is_large).groupBy(_bucket(F.col("key_value"), n).alias("b")).agg(F.sum("load").alias("load")).collect()}
    items = [(rest.get(b, 0), 1, b) for b in range(n)]
    for k, load in large.items():
        shards = max(1, math.ceil(load * SPLIT / fair))
        items += [(load / shards, 0, k)] * shards
    heap = [(0.0, t) for t in range(tasks)]
    at_large: dict[str, list[int]] = {k: [] for k in large}
    at_bucket = [0] * n
    for load, kind, name in sorted(items, key=lambda x: (-x[0], x[1], str(x[2]))):
        held, t = heapq.heappop(heap)
        heapq.heappush(heap, (held + load, t))
        if kind:
            at_bucket[name] = t
        else:
            at_large[name].append(t)
    return ShardPlan(tasks, at_large, at_bucket)


def _placements(df: DataFrame, key: str, plan: ShardPlan) -> DataFrame:
    """``df`` with shard_tasks, the tasks that hold rows of its string column ``key``: one for each shard, else that of its bucket.

    Both tables of the plan are bounded by its number of tasks.
    """
    spark = df.sparkSession
    kind = T.StructType([T.StructField("large_key", T.StringType()), T.StructField("large_tasks", T.ArrayType(T.IntegerType()))])
    large = spark.createDataFrame([(k, list(v)) for k, v in plan.large.items()], kind)
    packed = spark.createDataFrame(list(enumerate(plan.buckets)), "bucket int, bucket_task int")
    both = df.withColumn("bucket", _bucket(F.col(key), len(plan.buckets))).join(F.broadcast(packed), "bucket")
    both = both.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("large_key")) & F.col("large_tasks").isNotNull(), "left")
    return both.withColumn("shard_tasks", F.coalesce("large_tasks", F.array("bucket_task"))).drop("bucket", "bucket_task", "large_key", "large_tasks")


def with_task(df: DataFrame, key: str, spread: str, plan: ShardPlan) -> DataFrame:
    """``df`` (with a string column ``key``) with task_id instead of the whole number ``spread``: equal key and spread, equal task."""
    shard = F.expr(f"element_at(shard_tasks, cast(pmod(`{spread}`, size(shard_tasks)) + 1 as int))")
    return _placements(df, key, plan).withColumn("task_id", shard).drop("shard_tasks", spread)


def default_tasks(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def balanced_stats(df: DataFrame, key: str, spread: Sequence[str], distinct: Mapping[str, Sequence[str]] | None = None, ignore: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """(key_value string, n_rows bigint, one bigint count for each entry of ``distinct``) for every key.

    ``distinct`` names counts of distinct combinations of columns; combinations with a null don't count. ``spread``:
    columns by which a large key's rows are cut into shards. Null keys and those in ``ignore`` are no keys; an empty
    table gives no rows. Rows are counted within each shard before they are shuffled; distinct values go to the tasks of
    the plan, where a value belongs to one shard of its key, so that the shards' counts add up.
    """
    distinct = dict(distinct or {})
    tasks = tasks or default_tasks(df)
    keyed = df.where(F.col(key).isNotNull() & ~F.col(key).isin(*ignore)) if ignore else df.where(F.col(key).isNotNull())
    plan = shard_plan(written(key_loads(keyed, key), "loads"), tasks)
    name = F.col(key).cast("string").alias("key_value")
    rows = with_task(keyed.select(name, F.xxhash64(*spread).alias("spread")), "key_value", "spread", plan).groupBy("task_id", "key_value").agg(F.count("*").alias("n_rows"))
    if distinct:
        whole = lambda cols: F.when(F.concat(*cols).isNotNull(), F.to_json(F.array(*(F.col(c).cast("string") for c in cols))))
        values = F.array(*(F.struct(F.lit(i).alias("kind"), whole(cols).alias("v")) for i, cols in enumerate(distinct.values())))
        long = keyed.select(name, F.inline(values)).where(F.col("v").isNotNull()).withColumn("spread", F.xxhash64("v"))
        seen = with_task(long, "key_value", "spread", plan).repartitionById(tasks, "task_id").groupBy("task_id", "key_value", "kind", "v").agg(F.lit(1))
        counts = seen.groupBy("task_id", "key_value").agg(*(F.count_if(F.col("kind") == i).alias(n) for i, n in enumerate(distinct)))
        rows = rows.unionByName(counts, allowMissingColumns=True)
    return rows.groupBy("key_value").agg(F.sum("n_rows").alias("n_rows"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in distinct))


def _placed_join(df: DataFrame, small: DataFrame, key: str, how: str, tasks: int | None) -> tuple[DataFrame, list[str]]:
    """The join with columns c0, c1, ... for those of the result and task_id, and the names of the result's columns."""
    tasks = tasks or default_tasks(df)
    plan = shard_plan(written(key_loads(df, key), "loads"), tasks)
    wide = len(df.columns)
    left = df.toDF(*(f"c{i}" for i in range(wide)))
    left = left.withColumns({"join_key": F.col(f"c{df.columns.index(key)}").cast("string"), "join_place": F.monotonically_increasing_id()})
    left = with_task(left, "join_key", "join_place", plan).repartitionById(plan.tasks, "task_id")
    others = [c for c in small.columns if c != key]
    right = small.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("right_key"), *(F.col(c).alias(f"c{wide + i}") for i, c in enumerate(others)))
    right = _placements(right, "right_key", plan).withColumn("right_task", F.explode(F.array_distinct("shard_tasks"))).drop("shard_tasks").repartitionById(plan.tasks, "right_task")
    on = (left["task_id"] == right["right_task"]) & (left["join_key"] == right["right_key"])
    joined = left.join(right.hint("merge"), on, how).drop("join_key", "right_key", "right_task")
    return joined, [*df.columns, *(f"{c}_right" if c in df.columns else c for c in others)]


def balanced_fragments(df: DataFrame, small: DataFrame, key: str, how: str = "inner", tasks: int | None = None) -> DataFrame:
    """``balanced_join`` with task_id, the task that a row was placed in: grouping by it and more columns needs no further shuffle.

    Rows of a large key, null included, go to its shards in turn, by their place in the input partition, so equal rows are
    spread as well. ``df`` should be a scan or a written table, whose rows keep their places if a partition is read again.
    """
    joined, names = _placed_join(df, small, key, how, tasks)
    return joined.select("task_id", *(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def balanced_join(df: DataFrame, small: DataFrame, key: str, how: str = "inner", tasks: int | None = None) -> DataFrame:
    """``df`` ⋈ ``small`` on ``key``, large keys of ``df`` cut into shards, their rows of ``small`` replicated to those only.

    ``how`` is inner or left. Null keys match nothing; a left join keeps them, spread like any large key. Columns of
    ``small`` that clash with ``df``'s get the suffix ``_right``. Repeated rows join as often as they occur; an empty ``df``
    gives no rows.
    """
    joined, names = _placed_join(df, small, key, how, tasks)
    return joined.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))
