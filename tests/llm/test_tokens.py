import random

import pytest

from strandloom.llm import tokens

tokenizers = pytest.importorskip("tokenizers")
PATH = f"{tokens.TOKENIZERS}/{tokens.TOKENIZER}.json"


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def hard_texts():
    rng = random.Random(1)
    letters = "abcdeABC01 \n\t'é中😀ß ​\r_-!ſ²"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 120))) for _ in range(600)]
    words = ["a" * 4000, "ab" * 2000 + "x", "".join(rng.choice("abcdefghij") for _ in range(5000)), "=-=-" * 800, " " * 2000 + "x", "\n" * 501, "中文" * 700, "😀" * 300]
    return [None, "", " ", "  \n", "<|endoftext|> a<|endoftext|>", "'s 's''s don't'll we'VE I'm'd  \n\n x\t\ty  ", "﻿1\r\n00:00:01,000 --> 00:00:02,000\r\n", *words, *texts]


def test_ids_equal_the_library(spark, library):
    texts = hard_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts[:5])], "id bigint, text string, ids string").repartition(3)
    found = {r["id"]: r["ids"] for r in tokens.token_ids(df, "id", "text").collect()}
    assert found == dict(enumerate(library(texts + texts[:5])))
    counts = {r["id"]: r["n_tokens"] for r in tokens.token_counts(df, ["id"], "text").collect()}
    assert counts == {k: len(v) for k, v in found.items()}
    assert tokens.token_ids(df.limit(0), "id", "text").count() == 0


def test_forgetting_and_chunks_change_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 400)
    encode, texts, got = tokens.Encoder(PATH), hard_texts(), []
    for chunk in tokens._chunks(texts):
        ids, sizes = encode(chunk)
        at = 0
        for n in sizes:
            got.append(ids[at : at + n].tolist())
            at += n
    assert got == library(texts)


def test_pairs_are_found(library):
    v = tokens.encoder(PATH).vocabulary
    assert len(v.merged) == 50_000 and (v.ranks.keys >= 0).sum() == 50_000


def test_real_texts(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    assert {r["doc_id"]: r["ids"] for r in tokens.token_ids(docs, "doc_id", "text").collect()} == want


def test_words_of_all_lengths_share_the_matrices(library, monkeypatch):
    """Words from a byte to thousands of them, in matrices of several rows and of one."""
    rng = random.Random(2)
    words = ["".join(rng.choice(letters) for _ in range(n)) for n in (*range(1, 140), 200, 500, 501, 3000) for letters in ("ab", "abcdefghijklmnop", "中文字幕的")]
    for cells in (1 << 7, tokens.CELLS):
        monkeypatch.setattr(tokens, "CELLS", cells)
        ids, sizes = tokens.Vocabulary(PATH).encode([w.encode() for w in words])
        ends = sizes.cumsum()
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == library(words)
    assert tokens.widths(7) == [2, 3, 4, 5, 6, 7] and tokens.widths(1000)[-1] >= 1000
