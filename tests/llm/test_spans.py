import random

import numpy as np
import pytest

from strandloom.llm import spans


def brute(docs, length):
    where = {}
    for d, t in docs:
        for i in range(len(t or "") - length + 1):
            where.setdefault(t[i : i + length], set()).add(d)
    out = set()
    for d, t in docs:
        if d is None:
            continue
        hit = np.zeros(len(t or "") + 1, bool)
        for i in range(len(t or "") - length + 1):
            if len({x for x in where[t[i : i + length]] if x is not None}) > 1:
                hit[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(int), 0]))
        out |= {(d, int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])}
    return out


def corpus(seed, letters="abc de\n", n=60):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))
    parts = [text(rng.choice([15, 19, 20, 21, 30, 50, 90])) for _ in range(8)] + ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ab" * 20, "😀é" * 15]
    docs = [(i, "".join(rng.choice([text(rng.randrange(0, 40)), rng.choice(parts), rng.choice(parts)[3:]]) for _ in range(rng.randrange(0, 6)))) for i in range(n)]
    docs += [(100, None), (101, ""), (102, docs[3][1]), (103, docs[3][1]), (104, parts[0] + parts[0]), (None, parts[1]), (105, "z" * 19), (106, "q" * 100)]
    return docs


@pytest.mark.parametrize("seed, length, letters", [(1, 20, "abc de\n"), (2, 20, "ab"), (3, 7, "abcdef"), (4, 3, "abcdefghij")])
def test_equals_brute_force(spark, seed, length, letters):
    docs = corpus(seed, letters)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "id bigint, text string, doc string").repartition(3)
    found = [tuple(r) for r in spans.shared_spans(df, "id", "text", length).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(docs, length)


def test_without_broadcast_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(spans, "if_small", lambda df: df)
    monkeypatch.setattr(spans, "BROADCAST_BYTES", -1)
    docs = corpus(7)
    df = spark.createDataFrame(docs, "id bigint, text string")
    assert {tuple(r) for r in spans.shared_spans(df, "id", "text", 20).collect()} == brute(docs, 20)


@pytest.mark.parametrize("function", [0, 1])
def test_windows_are_the_nodes_of_the_tree(function):
    """Each stretch lies in one window, whose minimum is that of its tokens, at its first smallest token."""
    texts = [t for _, t in corpus(5) if t] + ["", "x" * 30, "ab" * 300]
    chunk = spans.Chunk(texts)
    text, low, first, last = chunk.windows(20, 6, function)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    want = [s + i for s, t in zip(chunk.ends - chunk.sizes, texts) for i in range(len(t) - 19)]
    assert covered.tolist() == want
    tokens = spans.mix(chunk.hashes(np.arange(len(chunk.points) - 5), 6) + np.uint64(function))
    for t, w, a, b in zip(text, low, first, last):
        assert chunk.ends[t] - chunk.sizes[t] <= a <= b <= chunk.ends[t] - 20
        at = {i + int(tokens[i : i + 15].argmin()) for i in range(a, b + 1)}
        assert len(at) == 1 and tokens[at.pop()] == w


def test_trees_of_equal_tokens_stay_low():
    """Periodic texts of a million letters: equal minima divide a node together."""
    text, low, first, last = spans.Chunk(["a" * 1_000_000 + "b", "abc" * 200_000]).windows(80, 24)
    assert (last - first + 1).sum() == 1_000_001 - 79 + 600_000 - 79


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "id string, text string")
    assert spans.shared_spans(df, "id", "text").count() == 0
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    df = spark.createDataFrame([("a", long), ("b", "#" + long[400_000:400_100] + "#")], "id string, text string")
    assert {tuple(r) for r in spans.shared_spans(df, "id", "text").collect()} == {("a", 400_000, 400_100), ("b", 1, 101)}
