"""The N best items of every group, reading only row groups that can still matter.

The table is clustered by group in the shared folder: files hold whole groups or, of a group too large for a file, a
part of it; rows within a file are sorted by group and falling score, in row groups of few rows, so that a group of
several times as many has row groups of its own. A task then opens a file's row groups in descending order of their
maximum score, keeps the N best items of each group, and skips a row group whose maximum lies strictly below the current
N-th score of every group that it contains.

In a file sorted by group, a row group of several groups holds the first rows of all of them but one. Those have no N-th
score before it is read, whatever is known of the groups in it, so only row groups of one group, whose first and last
group are the same by the statistics, can be skipped. The few items left of each file are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.shared import shared_path, written

#: Rows of a row group of the clustered files. Groups of less than about three times as many are always read whole.
ROW_GROUP_ROWS = 1024
SCORES = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint", "float": "double", "double": "double"}


def _clustered_schema(kind: str) -> str:
    return f"group_key string, score {kind}, item string"


def score_type(df: DataFrame, score: str) -> str:
    """The type in which scores are compared: no whole or decimal number changes by it; others than numbers are refused."""
    kind = df.schema[score].dataType.simpleString()
    if kind not in SCORES and not kind.startswith("decimal"):
        raise TypeError(f"scores of {score} are {kind}, not numbers")
    return SCORES.get(kind, kind)


def _readable(path: str) -> str:
    """``path``, if tasks can read row groups there."""
    try:
        fs.FileSystem.from_uri(path)
    except (ValueError, NotImplementedError) as e:
        raise ValueError(f"row groups can't be read one by one at {path}: name a folder of another file system in spark.checkpoint.dir") from e
    return path


def cluster(df: DataFrame, groups: Sequence[str], score: str, item: str, row_group_rows: int = ROW_GROUP_ROWS) -> str:
    """Writes (group_key, score, item) clustered by group; gives the folder.

    Rows without item or group are left out, as are those whose score is null or no number (NaN). A partition far above
    the others' size is split by adaptive execution (rebalance), so one large group becomes several files.
    """
    kind = score_type(df, score)
    whole = ~F.isnan(score) if kind == "double" else F.lit(True)
    for c in (*groups, score, item):
        whole = whole & F.col(c).isNotNull()
    rows = df.where(whole).select(F.to_json(F.array(*(F.col(c).cast("string") for c in groups))).alias("group_key"), F.col(score).cast(kind).alias("score"), F.col(item).cast("string").alias("item"))
    path = _readable(shared_path(df.sparkSession, "clustered"))
    sorted_rows = rows.hint("rebalance", F.col("group_key")).sortWithinPartitions("group_key", F.desc("score"), "item")
    sorted_rows.write.option("parquet.block.row.count.limit", row_group_rows).parquet(path)
    return path


def best_items(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    """The n best items of each group: an item counts once with its greatest score; ties by the smaller item."""
    rows = rows.sort_values(["group_key", "score", "item"], ascending=[True, False, True], kind="stable")
    rows = rows[~rows.duplicated(["group_key", "item"])]
    return rows[rows.groupby("group_key", sort=False).cumcount() < n]


def _bounds(meta: pq.FileMetaData, g: int) -> tuple[float, str | None]:
    """The maximum score of a row group (infinite if unknown), and its group if it has one only."""
    group, score = meta.row_group(g).column(0).statistics, meta.row_group(g).column(1).statistics
    one = group is not None and group.has_min_max and group.min == group.max
    return (score.max if score is not None and score.has_min_max else np.inf), (group.min if one else None)


def best_of_file(path: str, n: int) -> tuple[pd.DataFrame, int, int]:
    """The n best items of each group in a clustered file, with the numbers of row groups read and skipped."""
    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as handle:
        file = pq.ParquetFile(handle)
        known = [(*_bounds(file.metadata, g), g) for g in range(file.metadata.num_row_groups)]
        best: dict[str, float] = {}
        # The best rows of groups with row groups of their own, the rest, and those rows of the rest that begin or end a row group.
        own: dict[str, pd.DataFrame] = {}
        mixed: list[pd.DataFrame] = []
        edge: dict[str, list[pd.DataFrame]] = {}
        read = 0
        for top, group, g in sorted(known, key=lambda x: (-x[0], x[2])):
            if group is not None and top < best.get(group, -np.inf):
                continue
            read += 1
            rows = best_items(file.read_row_group(g).to_pandas(), n)
            if group is None:
                mixed.append(rows)
                keys = rows["group_key"].to_numpy()
                first, last = rows[: int((keys[:n] == keys[0]).sum())], rows[len(keys) - int((keys[-n:] == keys[-1]).sum()) :]
                parts = {keys[0]: first, keys[-1]: last}
                for name, part in parts.items():
                    edge.setdefault(name, []).append(part)
            else:
                before = [own[group]] if group in own else []
                own[group] = best_items(pd.concat([rows, *before, *edge.pop(group, [])]), n)
                parts = {group: own[group]}
            best.update({k: max(x["score"].min(), best.get(k, -np.inf)) for k, x in parts.items() if len(x) >= n})
        held = [*own.values(), *mixed]
        found = best_items(pd.concat(held), n) if held else pd.DataFrame({"group_key": [], "score": [], "item": []})
        return found, read, len(known) - read


def top_of_clustered(spark, path: str, n: int, kind: str = "bigint") -> DataFrame:
    """(group_key, score, item): at most n rows for each group and file of the clustered table at ``path``."""
    schema = _clustered_schema(kind)
    rows = spark.read.schema(schema).parquet(path)
    files = written(rows.select(F.col("_metadata.file_path").alias("path")).distinct(), "files")
    tasks = max(1, min(files.count(), spark.sparkContext.defaultParallelism * 4))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                yield best_of_file(p, n)[0]

    return files.repartition(tasks).mapInPandas(run, schema)


def top_n(df: DataFrame, groups: Sequence[str], score: str, item: str, n: int, row_group_rows: int = ROW_GROUP_ROWS) -> DataFrame:
    """(groups, rank_no int, item): the n best items of every group by falling score, ties by the smaller item.

    An item counts once with its greatest score. Rows with a null group, score or item don't count; an empty table gives
    no rows; repeated rows change nothing; other columns are dropped. Scores are whole, decimal or floating numbers (NaN
    doesn't count), compared as they are.
    """
    found = top_of_clustered(df.sparkSession, cluster(df, groups, score, item, row_group_rows), n, score_type(df, score))
    once = found.groupBy("group_key", "item").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank_no", F.row_number().over(Window.partitionBy("group_key").orderBy(F.desc("score"), "item"))).where(F.col("rank_no") <= n)
    names = F.from_json("group_key", "array<string>")
    return ranked.select(*(names[i].cast(df.schema[c].dataType).alias(c) for i, c in enumerate(groups)), "rank_no", F.col("item").alias(item))
