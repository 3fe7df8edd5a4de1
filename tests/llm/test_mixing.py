import random

import pytest

from strandloom.llm import mixing


def documents(spark, n=1500):
    rng = random.Random(1)
    words = ["river", "door", "cup", "lamp", "stone"]
    rows = [(i, rng.choice(["big"] * 6 + ["mid", "mid", "small", "unlisted", None]), rng.choice([None, "", *(" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(20))]), "x") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string, h string").repartition(3)


TARGETS = [("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.4, 4), ("absent", 0.2, 2), ("none", 0.0, 2), (None, 0.1, 1)]


def targets(spark, rows=TARGETS):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares_and_caps(spark):
    docs = documents(spark)
    chosen, report = mixing.mix(docs, targets(spark))
    rows, by = chosen.collect(), {r["source"]: r for r in report.collect()}
    assert len({r["doc_id"] for r in rows}) == len(rows)
    caps = {s: c for s, _, c in TARGETS}
    assert all(1 <= r["repeats"] <= caps[r["source"]] and r["n_tokens"] > 0 for r in rows)
    assert set(by) == {"big", "mid", "small", "absent", "none"} and by["absent"]["mix_tokens"] == by["none"]["mix_tokens"] == 0
    total = sum(r["n_tokens"] * r["repeats"] for r in rows)
    for s, share in (("big", 0.5 / 1.2), ("mid", 0.3 / 1.2), ("small", 0.4 / 1.2)):
        given = sum(r["n_tokens"] * r["repeats"] for r in rows if r["source"] == s)
        assert by[s]["mix_tokens"] == given and by[s]["actual_share"] == pytest.approx(given / total)
        assert abs(given / total - share) * total <= 60 + 1  # a document has at most 60 tokens
        assert {r["repeats"] for r in rows if r["source"] == s} <= {min(r["repeats"] for r in rows if r["source"] == s) + k for k in (0, 1)}
    tight = [s for s in ("big", "mid", "small") if by[s]["mix_tokens"] >= by[s]["max_repeats"] * by[s]["held_tokens"] - 1]
    assert tight  # the mix is as large as it can be


def test_given_total(spark):
    docs = documents(spark)
    chosen, report = mixing.mix(docs, targets(spark), total_tokens=3000)
    for r in report.collect():
        want = {"big": 1250, "mid": 750, "small": 1000}.get(r["source"], 0)
        assert abs(r["mix_tokens"] - want) <= 31
    chosen, report = mixing.mix(docs, targets(spark), total_tokens=10**9)
    assert all(r["mix_tokens"] == r["max_repeats"] * r["held_tokens"] for r in report.collect() if r["source"] in ("big", "mid", "small"))
    assert mixing.mix(docs, targets(spark), total_tokens=0)[0].count() == 0


def test_equal_hashes_and_steps(spark):
    """Documents of one hash stay together; thresholds refine until one document is left."""
    sizes = spark.createDataFrame([(i, "a", 10, h) for i, h in enumerate([5, 5, 5, 6, 7, 1 << 58])], "doc bigint, source string, n_tokens bigint, h bigint")
    for rest, below in ((1, 0), (16, 3), (36, 4), (59, 6)):
        cut = mixing.thresholds(sizes, spark.createDataFrame([("a", rest)], "source string, rest bigint")).collect()
        assert sum(h < cut[0]["threshold"] for h in [5, 5, 5, 6, 7, 1 << 58]) == below, rest


def test_empty(spark):
    docs = documents(spark, 50)
    for d, t in ((docs.limit(0), targets(spark)), (docs, targets(spark).limit(0)), (docs.where("text is null"), targets(spark))):
        chosen, report = mixing.mix(d, t)
        assert chosen.count() == 0 and all(r["mix_tokens"] == 0 for r in report.collect())
