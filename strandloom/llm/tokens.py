"""Byte-level BPE ids of whole texts with a public tokenizer's vocabulary file, many words at a time in numpy.

A task cuts its texts into words by the tokenizer's pattern and encodes each distinct word once. Words of similar length
form a padded matrix of byte ids, however long they are; in each round every row merges its leftmost pair of minimum
rank and the other places of that pair, pairs being looked up in a hash table; rows without a mergeable pair leave the
matrix, and holes are closed up.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie, on every executor.
TOKENIZERS = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k"

# Fixed value of the tokenizer: the pattern of its words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters of a matrix at most, unless a single word is longer.
CELLS = 1 << 18
#: Words and characters that a task holds at once; the words are then forgotten and encoded anew, with the same ids.
KEPT_WORDS = 1 << 20
CHUNK_CHARS = 4 << 20
NONE = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: itself if printable, else 256, 257 and on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def widths(longest: int) -> list[int]:
    """Lengths that bound the buckets of words, each about a quarter above the one before, up to ``longest``."""
    out = [2]
    while out[-1] < longest:
        out.append(out[-1] + max(1, out[-1] // 4))
    return out


class PairRanks:
    """Rank of each mergeable pair of ids in an open-addressing hash table; lookups are vectorised."""

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(4, int(len(left) * 4).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size + 64, -1, np.int64)
        self.ranks = np.full(size + 64, NONE, np.int32)
        keys = self._key(left, right)
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):  # place all pairs at once, the colliding ones a slot further on
            at = self._home(keys[todo]) + self.probes
            free = self.keys[at] == -1
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.ranks[at[put]] = keys[todo[put]], todo[put]
            todo = todo[~put]
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE for pairs that don't merge; ids below 0 are padding."""
        shape = left.shape
        keys = self._key(left.ravel(), right.ravel())
        home = self._home(keys)
        ranks = np.where(self.keys[home] == keys, self.ranks[home], NONE)
        miss = np.flatnonzero((self.keys[home] != keys) & (self.keys[home] != -1) & (left.ravel() >= 0) & (right.ravel() >= 0))
        for p in range(1, self.probes):
            if not len(miss):
                break
            at = home[miss] + p
            hit = self.keys[at] == keys[miss]
            ranks[miss[hit]] = self.ranks[at[hit]]
            miss = miss[~hit]
        return np.where((left.ravel() >= 0) & (right.ravel() >= 0), ranks, NONE).reshape(shape)


class _Cells:
    """Rows of ids with holes (-1), each id's neighbours, and the rank of each id's pair with the next one."""

    def __init__(self, ids: np.ndarray, ranks: np.ndarray) -> None:
        self.ids = ids
        self.ranks = np.full(ids.shape, NONE, np.int32)
        self.ranks[:, :-1] = ranks
        width = ids.shape[1]
        self.width, self.used = width, (ids >= 0).sum(axis=1)
        column = np.arange(width, dtype=np.int32)
        self.before = np.tile(column - 1, (len(ids), 1))
        self.after = np.where(column + 1 < self.used[:, None], column + 1, width).astype(np.int32)

    def taken(self, rows: np.ndarray) -> _Cells:
        some = object.__new__(_Cells)
        some.width, some.used = self.width, self.used[rows]
        some.ids, some.ranks, some.before, some.after = self.ids[rows], self.ranks[rows], self.before[rows], self.after[rows]
        return some

    def _packed(self, values: np.ndarray, fill: int) -> np.ndarray:
        """``values`` of the ids without the holes, padded."""
        row, column = np.nonzero(self.ids >= 0)
        ends = np.cumsum(self.used)
        out = np.full((len(self.ids), int(self.used.max(initial=0))), fill, np.int32)
        out[row, np.arange(len(row)) - (ends - self.used)[row]] = values[row, column]
        return out

    def packed(self) -> np.ndarray:
        return self._packed(self.ids, -1)

    def closed_up(self) -> _Cells:
        """Without holes, if they fill half of the widest row."""
        if self.used.max() * 2 > self.width:
            return self
        return _Cells(self.packed(), self._packed(self.ranks, NONE)[:, :-1])

    def merge(self, best: np.ndarray, merged: np.ndarray, rank_of: PairRanks) -> None:
        """Merges the pairs of rank ``best``, one for each row, wherever they occur without overlap from the left."""
        width = self.width
        ids, ranks, before, after = (x.reshape(-1) for x in (self.ids, self.ranks, self.before, self.after))
        at = np.flatnonzero(self.ranks == best[:, None])
        base = at - at % width
        second = base + after[at]
        # Every other pair of a run in which each begins where the one before ends.
        opens = np.r_[True, second[:-1] != at[1:]]
        place = np.arange(len(at))
        keep = (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
        at, base, second = at[keep], base[keep], second[keep]
        row = base // width
        third = after[second]
        ids[at], ids[second], ranks[second] = merged[best[row]], -1, NONE
        after[at] = third
        inner = third < width
        before[(base + third)[inner]] = (at - base)[inner]
        ranks[at] = NONE
        ranks[at[inner]] = rank_of(ids[at[inner]], ids[(base + third)[inner]])
        first = before[at]
        inner = first >= 0
        left = (base + first)[inner]
        ranks[left] = rank_of(ids[left], ids[at[inner]])
        self.used -= np.bincount(row, minlength=len(self.used))


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as handle:
            model = json.load(handle)["model"]
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.bytes = np.zeros(256, np.int32)
        for letter, b in byte_letters().items():
            self.bytes[b] = ids[letter]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.ranks = PairRanks(np.array([ids[a] for a, _ in pairs]), np.array([ids[b] for _, b in pairs]))

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        """Ids of each row, padded with -1, from byte ids padded with -1.

        Each round every row merges its leftmost pair of minimum rank, with the further places of that pair that don't
        overlap: a pair's rank lies above those of the pairs that its parts came from, so these are next in turn anyway.
        Merged letters leave holes, which ``before`` and ``after`` step over until half of the matrix is holes.
        """
        out = np.full(rows.shape, -1, np.int32)
        place = np.arange(len(rows))
        cells = _Cells(rows, self.ranks(rows[:, :-1], rows[:, 1:]))
        while True:
            best = cells.ranks.min(axis=1)
            live = best != NONE
            if not live.all():
                done = cells.taken(~live).packed()
                out[place[~live], : done.shape[1]] = done
                cells, place, best = cells.taken(live), place[live], best[live]
            if not len(place):
                return out
            cells.merge(best, self.merged, self.ranks)
            cells = cells.closed_up()

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and number of ids of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        starts = np.cumsum(sizes) - sizes
        parts, owner = [flat[starts[sizes == 1]]], [np.flatnonzero(sizes == 1)]
        low = 1
        for width in widths(int(sizes.max(initial=0))):
            of = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            height = max(1, CELLS // width)
            for k in range(0, len(of), height):
                here = of[k : k + height]
                col = np.arange(int(sizes[here].max()))
                used = col < sizes[here][:, None]
                rows = np.where(used, flat[np.minimum(starts[here][:, None] + col, len(flat) - 1)], -1).astype(np.int32)
                ids = self.matrix(rows)
                row, _ = np.nonzero(ids >= 0)
                parts.append(ids[ids >= 0])
                owner.append(here[row])
        ids, owners = np.concatenate(parts), np.concatenate(owner)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(words))


class Encoder:
    """Ids of texts; keeps the ids of the words seen so far."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(WORDS).findall
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and number of ids of each text; none for an empty or null text."""
        split, counts, words = self.split, [], []
        for text in texts:
            found = split(text) if text else []
            counts.append(len(found))
            words += found
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            ids, sizes = self.vocabulary.encode([w.encode() for w in new])
            self.known.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
            self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
        word = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[word]
        begins = (np.cumsum(self.sizes) - self.sizes)[word]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.cumsum([0, *counts])
        before = np.r_[0, ends]
        if len(self.known) > KEPT_WORDS:
            self.forget()
        return ids, np.diff(before[bounds])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept over its tasks."""
    return Encoder(path)


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about CHUNK_CHARS characters, so that a batch of long texts isn't held as words at once."""
    chunk: list[str | None] = []
    size = 0
    for t in texts:
        chunk.append(t)
        size += len(t or "")
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _path(tokenizer: str, folder: str) -> str:
    return f"{folder}/{tokenizer}.json"


def token_ids(df: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER, folder: str = TOKENIZERS) -> DataFrame:
    """(id_col, ids array<int>): ids of each whole text, without special tokens, in one pass without a shuffle.

    A null or empty text has the empty list. Strings of special tokens are ordinary text. Repeated ids give a row each;
    an empty table gives none; other columns are dropped. ``tokenizer``: a byte-level vocabulary file in ``folder``.
    """
    path = _path(tokenizer, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            keys, done = batch.column(0), 0
            for texts in _chunks(batch.column(1).to_pylist()):
                ids, sizes = encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([keys.slice(done, len(texts)), lists], names=[id_col, "ids"])
                done += len(texts)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def token_counts(df: DataFrame, columns: list[str], text_col: str, tokenizer: str = TOKENIZER, folder: str = TOKENIZERS) -> DataFrame:
    """``columns`` and n_tokens bigint, the number of ids of each whole text; 0 for a null or empty one."""
    path = _path(tokenizer, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            sizes = [encode(texts)[1] for texts in _chunks(batch.column(batch.num_columns - 1).to_pylist())]
            n = pa.array(np.concatenate([np.empty(0, np.int64), *sizes]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=[*columns, "n_tokens"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    return df.select(*columns, F.col(text_col).cast("string").alias("whole_text")).mapInArrow(run, f"{schema}, n_tokens bigint")
