"""Stretches of text that appear verbatim in more than one document, exactly, without comparing documents in pairs.

Compact windows: the tokens of a text are the hashes of its ``gram``-code-point pieces. In the Cartesian tree of the
hashes, a node that is minimal over at least ``length - gram + 1`` tokens stands for every stretch of ``length`` code
points whose first smallest token it is: an interval of first positions, from first_at to last_at. Equal stretches have
windows of equal minimum under every hash function, so all functions that are asked must agree. Windows whose minimum
occurs in one document only are left out; what the others cover is a region of text. Regions that occur as a whole in
two documents, code point for code point, are shared as they are. Over the others a second hash function's windows are
laid: only the intervals that both windows cover, and whose two minima occur together in two documents, are left, and
their stretches are compared one by one, again code point for code point.

Equal texts collapse in partial aggregates before every shuffle, so a passage that a third of the documents hold costs
each task a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.shared import BROADCAST_BYTES, if_small, written

LENGTH = 80
#: Longer grams have fewer chance meetings, shorter ones fewer windows.
GRAM_SHARE = 0.3
CHUNK_CHARS = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
TOP = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2^64."""
    inverse = pow(BASE, -1, 1 << 64)
    both = []
    for b in (BASE, inverse):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


class Chunk:
    """Prefix hashes of the code points of some texts, laid end to end."""

    def __init__(self, texts: list[str]) -> None:
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        n = len(self.points)
        power, self.inverse = _powers(1 << max(4, int(n).bit_length()))
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.points.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.prefix[1:])

    def hashes(self, begin: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Of the pieces of ``size`` code points at each of ``begin``; the size is part of the hash."""
        raw = (self.prefix[begin + size] - self.prefix[begin]) * self.inverse[begin]
        return mix(raw ^ np.uint64(BASE) * np.asarray(size, np.uint64))

    def windows(self, length: int, gram: int, function: int = 0) -> tuple[np.ndarray, ...]:
        """(text, minimum, first_at, last_at) of each window under a hash function, by place; positions within the chunk.

        The Cartesian tree is divided from its roots, the texts, down, all nodes of a level at once; a node's equal minima
        divide it together, and what holds too few tokens for a stretch is left out.
        """
        reach = length - gram + 1
        lo, hi = self.ends - self.sizes, self.ends - gram  # first and last token of each text
        value = np.full(len(self.points) + 1, TOP, np.uint64)
        whole = np.arange(max(0, len(self.points) - gram + 1))
        value[whole] = mix(self.hashes(whole, gram) + np.uint64(function))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            large = hi - lo + 1 >= reach
            lo, hi = lo[large], hi[large]
            if not len(lo):
                break
            least = np.minimum.reduceat(value, np.stack([lo, hi + 1], axis=1).ravel())[::2]
            size = hi - lo + 1
            ends = np.cumsum(size)
            tokens = np.arange(ends[-1]) + np.repeat(lo - (ends - size), size)
            hits = np.flatnonzero(value[tokens] == np.repeat(least, size))
            at, node = tokens[hits], np.searchsorted(ends, hits, side="right")
            other = node[1:] != node[:-1]
            begin = np.where(np.r_[True, other], lo[node], np.r_[0, at[:-1] + 1])
            first, last = np.maximum(begin, at - reach + 1), np.minimum(at, hi[node] - reach + 1)
            some = first <= last
            found.append((value[at[some]], first[some], last[some]))
            end = np.flatnonzero(np.r_[other, True])
            lo = np.insert(begin, end + 1, at[end] + 1)
            hi = np.insert(at - 1, end + 1, hi[node[end]])
        low, first, last = (np.concatenate(x) for x in zip(*found)) if found else (value[:0], whole[:0], whole[:0])
        order = np.argsort(first, kind="stable")
        return np.searchsorted(self.ends, first[order], side="right"), low[order], first[order], last[order]


def _chunked(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(place of the first text, texts) of runs of about CHUNK_CHARS code points; null is as empty."""
    begin, size, chunk = 0, 0, []
    for i, t in enumerate(texts):
        chunk.append(t or "")
        size += len(chunk[-1])
        if size >= CHUNK_CHARS:
            yield begin, chunk
            begin, size, chunk = i + 1, 0, []
    if chunk:
        yield begin, chunk


def with_windows(df: DataFrame, length: int, gram: int, function: int = 0, keep_text: bool = True) -> DataFrame:
    """``df`` with windows array<struct<low bigint, first_at int, last_at int>>: those of its column text; no shuffle."""
    fields = [pa.field("low", pa.int64()), pa.field("first_at", pa.int32()), pa.field("last_at", pa.int32())]
    kept = [c for c in df.columns if keep_text or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _chunked(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                chunk = Chunk(texts)
                text, low, first, last = chunk.windows(length, gram, function)
                start = (chunk.ends - chunk.sizes)[text]
                each = pa.StructArray.from_arrays([pa.array(low.view(np.int64)), pa.array((first - start).astype(np.int32)), pa.array((last - start).astype(np.int32))], fields=fields)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)), each)
                columns = [batch.column(batch.schema.get_field_index(c)).slice(begin, len(texts)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*kept, "windows"])

    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in kept)
    return df.mapInArrow(run, f"{schema}, windows array<struct<low: bigint, first_at: int, last_at: int>>")


def _in_two(lo: str, hi: str):
    return F.col(lo) < F.col(hi)


def _cut_out(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, low, first_at, last_at, text): the windows of (doc, text), or those in its column windows, with their stretches' code points."""
    given = "windows" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _chunked(batch.column(1).to_pylist()):
                if given:
                    lists = batch.column(2).slice(begin, len(texts))
                    text, flat = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy()), lists.flatten()
                    low, first, last = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                else:
                    chunk = Chunk(texts)
                    text, low, first, last = chunk.windows(length, gram)
                    start = (chunk.ends - chunk.sizes)[text]
                    low, first, last = low.view(np.int64), first - start, last - start
                pieces = [texts[t][a:b] for t, a, b in zip(text.tolist(), first.tolist(), (last + length).tolist())]
                columns = [batch.column(0).take(pa.array(text + begin)), pa.array(low, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(pieces, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "low", "first_at", "last_at", "text"])

    return docs.mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, low bigint, first_at int, last_at int, text string")


def _region_texts(docs: DataFrame, lows: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, low, first_at, last_at, text): each window of the minima ``lows``, a written table, with its text.

    If the minima are few enough to be broadcast, a document's windows are cut out of its text and filtered where they are
    found. Else the windows are filtered by a shuffle first, and texts join what is left of their windows.
    """
    if lows.count() * 8 <= BROADCAST_BYTES:
        return _cut_out(docs, length, gram).join(F.broadcast(lows), "low")
    met = with_windows(docs, length, gram, keep_text=False).select("doc", F.inline("windows")).join(lows, "low")
    lists = met.groupBy("doc").agg(F.collect_list(F.struct("low", "first_at", "last_at")).alias("windows"))
    return _cut_out(docs.join(lists, "doc").select("doc", "text", "windows"), length, gram)


def shared_spans(df: DataFrame, id_col: str, text_col: str, length: int = LENGTH) -> DataFrame:
    """(id_col, span_from int, span_to int): the maximal runs of code points of each document that lie in any stretch of
    ``length`` code points which also appears in a document of another id; zero-based, span_to is one past the last.

    Null, empty and shorter texts share nothing; rows without an id are left out; rows of one id are one document. Whole
    texts are compared as they are, repeated ones included; an empty table gives no rows; other columns are dropped.
    Hashes only name what is compared: what is shared is decided on the code points.
    """
    gram = max(1, int(length * GRAM_SHARE))
    docs = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).where(F.length("text") >= length)
    both = F.min("lo").alias("lo"), F.max("hi").alias("hi")
    windows = with_windows(docs, length, gram, keep_text=False).select("doc", F.explode("windows.low").alias("low"))
    lows = written(windows.groupBy("low").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where(_in_two("lo", "hi")).select("low"), "lows")
    held = written(_region_texts(docs, lows, length, gram).select("doc", "low", "first_at", "last_at", "text"), "held")

    # Texts are compared once; then two hashes and the length name them.
    name = lambda c: F.struct(F.xxhash64(c).alias("h"), F.xxhash64(c, F.lit(1)).alias("i"), F.length(c).alias("n"))
    members = held.select("doc", "low", name("text").alias("region"), "first_at", "last_at")
    regions = written(held.groupBy("low", "text").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")), "regions")
    whole = written(regions.where(_in_two("lo", "hi")).select("low", name("text").alias("region")), "whole")
    whole = members.join(if_small(whole), ["low", "region"], "left_semi").select("doc", F.col("first_at").alias("a"), (F.col("last_at") + length).alias("b"))

    open_lows = regions.groupBy("low").agg(F.count("*").alias("n"), F.count_if(~_in_two("lo", "hi")).alias("single")).where("n > 1 and single > 0").select("low")
    undecided = with_windows(regions.join(if_small(written(open_lows, "open")), "low", "left_semi").select("low", "text", "lo", "hi"), length, gram, function=1)
    undecided = written(undecided.withColumnRenamed("low", "low1"), "undecided")
    pairs = undecided.select("low1", "lo", "hi", F.explode("windows.low").alias("low")).groupBy("low1", "low").agg(*both).where(_in_two("lo", "hi")).select("low1", "low")
    each = undecided.select("low1", "text", "lo", "hi", F.inline("windows")).join(if_small(written(pairs, "pairs")), ["low1", "low"])
    cut = F.expr(f"transform(sequence(first_at, last_at), o -> struct(o as o, substring(text, o + 1, {length}) as stretch))")
    stretches = each.select(F.col("low1").alias("low"), name("text").alias("region"), "lo", "hi", F.explode(cut).alias("s")).select("low", "region", "lo", "hi", "s.o", "s.stretch")
    twice = stretches.groupBy("low", "stretch").agg(*both).where(_in_two("lo", "hi")).select("low", name("stretch").alias("stretch"))
    single = stretches.where(~_in_two("lo", "hi")).select("low", "region", "o", name("stretch").alias("stretch"))
    # At most ``length - gram + 1`` places of each region.
    places = single.join(if_small(written(twice, "twice")), ["low", "stretch"], "left_semi").groupBy("low", "region").agg(F.collect_set("o").alias("places"))
    parts = members.join(places, ["low", "region"]).select("doc", "first_at", F.explode("places").alias("o")).select("doc", (F.col("first_at") + F.col("o")).alias("a"), (F.col("first_at") + F.col("o") + length).alias("b"))

    by_place = Window.partitionBy("doc").orderBy("a", "b")
    before = F.max("b").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    runs = whole.unionByName(parts).withColumn("opens", F.when(F.col("a") <= before, 0).otherwise(1)).withColumn("run", F.sum("opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc", "run").agg(F.min("a").cast("int").alias("span_from"), F.max("b").cast("int").alias("span_to")).select(F.col("doc").alias(id_col), "span_from", "span_to")
