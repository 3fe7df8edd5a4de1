"""Continuous periods and gaps of overlapping, nested and gapped closed intervals, per entity."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.shared import written

#: Positions are cut into tiles of this width at least, so that a list holds half as many intervals at most.
TILE = 1 << 20
FAN_IN = 16


def union_of(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted disjoint intervals of each group; intervals that overlap or adjoin become one.

    Bounds are 64-bit numbers below the largest. Sorted lists laid end to end are runs, which numpy's stable sort merges
    two by two in linear time.
    """
    if not len(group):
        return group, start, end
    order = np.argsort(start, kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    group, start, end = group[order], start[order], end[order]
    # The running maximum of each group's ends, found on their ranks, so that groups can be told apart by a summand.
    values, rank = np.unique(end, return_inverse=True)
    base = group.astype(np.int64) * len(values)
    reach = values[np.maximum.accumulate(rank + base) - base]
    opens = np.r_[True, (group[1:] != group[:-1]) | (start[1:] > reach[:-1] + 1)]
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], len(group)] - 1
    return group[first], start[first], reach[last]


def _lists(groups: pd.DataFrame, gid: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    gid, start, end = union_of(gid, start, end)
    cuts = np.flatnonzero(np.diff(gid)) + 1
    out = groups.iloc[gid[np.r_[0, cuts]] if len(gid) else []].reset_index(drop=True)
    out["starts"] = np.split(start, cuts) if len(gid) else []
    out["ends"] = np.split(end, cuts) if len(gid) else []
    return out


def _groups(pdf: pd.DataFrame, keys: Sequence[str]) -> tuple[np.ndarray, pd.DataFrame]:
    gid = pdf.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
    _, first = np.unique(gid, return_index=True)
    return gid, pdf[list(keys)].iloc[first].reset_index(drop=True)


def partial_lists(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One list for each key and input batch, from rows of (keys, pos_from, pos_to), before any shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                gid, groups = _groups(pdf, keys)
                yield _lists(groups, gid, pdf["pos_from"].to_numpy(), pdf["pos_to"].to_numpy())

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("starts", longs), T.StructField("ends", longs)])
    return df.select(*keys, "pos_from", "pos_to").mapInPandas(run, schema)


def merge_lists(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One list for each key, from any number of lists of it: the aggregate's merge, a batch at a time.

    Rows of a key come together by a shuffle and a sort within partitions; the list of a key that runs over
    the end of a batch is merged with the next batch, so a task holds one batch and one list.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if carry is None else pd.concat([carry, pdf], ignore_index=True)
            gid, groups = _groups(pdf, keys)
            sizes = pdf["starts"].map(len).to_numpy()
            merged = _lists(groups, np.repeat(gid, sizes), np.concatenate(pdf["starts"].to_numpy()), np.concatenate(pdf["ends"].to_numpy()))
            carry = merged.iloc[-1:]
            yield merged.iloc[:-1]
        if carry is not None:
            yield carry

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, df.select(*keys, "starts", "ends").schema)


def tile_lists(df: DataFrame, keys: Sequence[str], tile: int = TILE, fan_in: int = FAN_IN) -> DataFrame:
    """(keys, tile, starts, ends): the sorted disjoint intervals of each key and tile, by a reduction tree.

    Leaves are the lists of the input partitions; each level merges at most ``fan_in`` nodes of a key.
    """
    at = [*keys, "tile"]
    cut = df.select(
        *keys,
        F.explode(F.sequence(F.floor(F.col("pos_from") / tile), F.floor(F.col("pos_to") / tile))).alias("tile"),
        "pos_from",
        "pos_to",
    ).select(
        *at,
        F.greatest("pos_from", F.col("tile") * tile).alias("pos_from"),
        F.least("pos_to", (F.col("tile") + 1) * tile - 1).alias("pos_to"),
    )
    lists = written(partial_lists(cut, at).withColumn("node", F.spark_partition_id()), "leaves")
    leaves = (lists.agg(F.max("node")).first()[0] or 0) + 1
    levels = max(1, math.ceil(math.log(leaves, fan_in)))
    for level in range(levels):
        lists = lists.withColumn("node", F.floor(F.col("node") / fan_in).cast("int") if level + 1 < levels else F.lit(0))
        lists = merge_lists(lists, [*at, "node"])
    return lists.drop("node")


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _positions(name: str, kind: T.DataType) -> Column:
    """Whole numbers as they are, dates as days, timestamps as microseconds, those without a zone as on a clock of 24 hours each day."""
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"cast(cast(cast(`{name}` - {_EPOCH} as interval second) as decimal(24, 6)) * 1000000 as bigint)")
    return F.col(name).cast("bigint")


def _value(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.col(name).cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"{_EPOCH} + `{name}` * interval '0.000001' second")
    return F.col(name).cast(kind)


def tile_width(rows: DataFrame) -> int:
    """The power of two from TILE on that is at least the mean length of (pos_from, pos_to): cuts add two rows an interval at most, on average."""
    mean = rows.agg(F.avg(F.col("pos_to").cast("double") - F.col("pos_from") + 1)).first()[0] or 1
    return max(TILE, 1 << math.ceil(math.log2(max(1.0, mean))))


def periods_and_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, tile: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """(keys, kind, first_pos, last_pos): maximal covered runs (``period``) and the runs between them (``gap``).

    Closed intervals of whole numbers, dates (by days) or timestamps (by microseconds), in the type of ``start``. Rows with a null key, a null bound or
    start > end are ignored; an empty table gives no rows; repeated rows and ties change nothing; other columns are dropped.
    Positions are cut into tiles, by default as wide as ``tile_width`` says. A key's lists are bounded by the tile width,
    and what is stitched over tiles has at most two rows a tile, so no task holds a whole key.
    """
    names = [f"key_{i}" for i in range(len(keys))]
    usable = F.lit(True)
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    kind = df.schema[start].dataType
    at = lambda c, n: _positions(c, df.schema[c].dataType).alias(n)
    rows = df.where(usable & (F.col(start) <= F.col(end))).select(*(F.col(k).alias(n) for k, n in zip(keys, names)), at(start, "pos_from"), at(end, "pos_to"))
    tile = tile or tile_width(rows)
    tiles = written(tile_lists(rows, names, tile, fan_in), "tiles")

    pieces = tiles.select(*names, "tile", F.explode(F.arrays_zip("starts", "ends")).alias("p")).select(*names, "tile", F.col("p.starts").alias("s"), F.col("p.ends").alias("e"))
    on_edge = (F.col("s") == F.col("tile") * tile) | (F.col("e") == (F.col("tile") + 1) * tile - 1)
    inner = pieces.where(~on_edge).select(*names, F.lit("period").alias("kind"), "s", "e")
    by_start = Window.partitionBy(*names).orderBy("s")
    stitched = (
        pieces.where(on_edge)
        .withColumn("opens", F.when(F.lag("e").over(by_start) + 1 == F.col("s"), 0).otherwise(1))
        .withColumn("run", F.sum("opens").over(by_start))
        .groupBy(*names, "run")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"))
        .select(*names, F.lit("period").alias("kind"), "s", "e")
    )
    between = F.expr("zip_with(slice(starts, 2, size(starts) - 1), slice(ends, 1, size(ends) - 1), (s, e) -> struct(e + 1 as s, s - 1 as e))")
    inner_gaps = tiles.where(F.size("starts") > 1).select(*names, F.lit("gap").alias("kind"), F.inline(between))
    across = (
        tiles.select(*names, "tile", F.element_at("starts", 1).alias("first"), F.element_at("ends", -1).alias("last"))
        .withColumn("next", F.lead("first").over(Window.partitionBy(*names).orderBy("tile")))
        .where(F.col("next") > F.col("last") + 1)
        .select(*names, F.lit("gap").alias("kind"), (F.col("last") + 1).alias("s"), (F.col("next") - 1).alias("e"))
    )
    every = inner.unionByName(stitched).unionByName(inner_gaps).unionByName(across)
    return every.select(*(F.col(n).alias(k) for k, n in zip(keys, names)), "kind", _value("s", kind).alias("first_pos"), _value("e", kind).alias("last_pos"))
