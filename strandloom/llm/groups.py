"""Groups of records linked by pairwise matches, directly or through others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strandloom.shared import written


def _relabelled(df: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced by its target in ``moves`` (child, parent), if it has one."""
    return df.join(moves.select(F.col("child").alias(column), "parent"), column, "left").withColumn(column, F.coalesce("parent", column)).drop("parent")


def _edges(a: Column, b: Column, df: DataFrame) -> DataFrame:
    """(hi, lo) of each pair of different labels, once."""
    return df.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(F.col("hi") > F.col("lo")).distinct()


def _written_counting(df: DataFrame, label: str, condition: Column) -> tuple[DataFrame, int]:
    """``df`` written, and the rows that meet ``condition``, counted by the tasks that write."""
    seen = Observation()
    return written(df.observe(seen, F.count_if(condition).alias("n")), label), seen.get["n"]


def smallest_labels(edges: DataFrame) -> DataFrame:
    """(id bigint, label bigint): for each id of ``edges`` (hi > lo), the smallest id that it is linked to.

    Each round gives every label the smallest label across its edges (partial minima before the shuffle), shortens the
    resulting chains by pointer jumping until no pointer moves, then redraws the edges between the labels that are left.
    A label without a smaller neighbour takes one in, or, if all its neighbours prefer smaller ones, gets an edge to one
    of those and moves in the next round: two rounds leave at most half of the labels that still have edges. Every
    round's tables are written to the shared folder, so a lost executor costs at most that step; only counts come to the
    driver. A label of very many edges is one key of the joins, in which adaptive execution splits its partition.
    """
    left, n = _written_counting(edges, "edges", F.lit(True))
    labels = left.select(F.explode(F.array("hi", "lo")).alias("id")).distinct().withColumn("label", F.col("id"))
    while n:
        moves = left.groupBy(F.col("hi").alias("child")).agg(F.min("lo").alias("parent"))
        moved = 1
        while moved:
            target = moves.select(F.col("child").alias("parent"), F.col("parent").alias("jump"))
            jumped = moves.join(target, "parent", "left").select("child", F.coalesce("jump", "parent").alias("parent"), F.col("jump").isNotNull().alias("moved"))
            table, moved = _written_counting(jumped, "jumps", F.col("moved"))
            moves = table.select("child", "parent")
        labels = _relabelled(labels, "label", moves)
        redrawn = _edges(F.col("hi"), F.col("lo"), _relabelled(_relabelled(left, "hi", moves), "lo", moves))
        left, n = _written_counting(redrawn, "edges", F.lit(True))
    return written(labels, "labels")


def linked_groups(pairs: DataFrame, left: Sequence[str], right: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(names, group_<name> for each name): every record of ``pairs`` with the smallest record linked to it.

    ``left`` and ``right``: the columns of a pair's two records, compared as strings by code point, column by column.
    A pair with a null in any of them links nothing and is left out; a record paired only with itself is its own group.
    Repeated and turned-round pairs change nothing; an empty table gives no rows; other columns are dropped.
    """
    ends = [F.struct(*(F.col(c).cast("string").alias(n) for c, n in zip(cols, names))) for cols in (left, right)]
    whole = F.lit(True)
    for c in (*left, *right):
        whole = whole & F.col(c).isNotNull()
    named = pairs.where(whole).select(ends[0].alias("a"), ends[1].alias("b")).distinct()
    # Ids follow the order of the records, so the smallest id of a group is that of its smallest record.
    records = named.select(F.explode(F.array("a", "b")).alias("r")).distinct()
    ids = written(records.orderBy("r").withColumn("id", F.monotonically_increasing_id()), "records")
    of = lambda end: ids.select(F.col("r").alias(end), F.col("id").alias(f"{end}_id"))
    links = named.where(F.col("a") != F.col("b")).join(of("a"), "a").join(of("b"), "b")
    labels = smallest_labels(_edges(F.col("a_id"), F.col("b_id"), links))
    grouped = ids.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    first = ids.select(F.col("id").alias("label"), F.col("r").alias("g"))
    return grouped.join(first, "label").select(*(F.col("r")[n].alias(n) for n in names), *(F.col("g")[n].alias(f"group_{n}") for n in names))
