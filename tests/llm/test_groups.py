import random

from strandloom.llm import groups as groups_module
from strandloom.llm.groups import linked_groups

COLS = (["la", "lb"], ["ra", "rb"], ["a", "b"])
KIND = "la string, lb string, ra string, rb string, a string"


def groups(rows):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for la, lb, ra, rb in rows:
        if None not in (la, lb, ra, rb):
            x, y = sorted((find((la, lb)), find((ra, rb))))
            up[y] = x
    return {(*x, *find(x)) for x in list(up)}


def check(spark, rows):
    df = spark.createDataFrame([(*r, "extra") for r in rows], KIND).repartition(3)
    found = [tuple(r) for r in linked_groups(df, *COLS).collect()]
    assert len(found) == len(set(found)) and set(found) == groups(rows)


def test_random_links(spark):
    rng = random.Random(1)
    name = lambda: (rng.choice(["s1", "s2", "", None]), rng.choice([None, *(f"t{i}" for i in range(150))]))
    rows = [(*name(), *name()) for _ in range(160)]
    rows += [r[2:] + r[:2] for r in rows[:30]] + rows[:20] + [("x", "self", "x", "self")]
    check(spark, rows)


def test_long_chain_and_hub(spark):
    rng = random.Random(2)
    order = list(range(300))
    rng.shuffle(order)
    rows = [("c", f"{a:04d}", "c", f"{b:04d}") for a, b in zip(order, order[1:])]
    rows += [("d", f"{i:04d}", "d", f"{i + 1:04d}") for i in range(200)]
    rows += [("h", "hub", "h", f"{i}") for i in range(300)] + [("a", "\U0001f600", "a", "￿")]
    check(spark, rows)


def test_empty(spark):
    df = spark.createDataFrame([], KIND)
    assert linked_groups(df, *COLS).columns == ["a", "b", "group_a", "group_b"] and linked_groups(df, *COLS).count() == 0
    check(spark, [("a", "b", "a", "b")])


def test_star_whose_centre_comes_last(spark, monkeypatch):
    """All ends of a star are smallest among their neighbours but one; the others get edges to it and follow in the next round."""
    rows = [("z", "centre", "a", f"end{i:04d}") for i in range(3000)]
    labels = []
    plain = groups_module._written_counting
    monkeypatch.setattr(groups_module, "_written_counting", lambda df, label, condition: labels.append(label) or plain(df, label, condition))
    check(spark, rows)
    assert labels.count("edges") == 3  # two rounds
