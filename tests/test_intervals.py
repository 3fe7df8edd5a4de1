import random

import pytest

from strandloom.operators.intervals import periods_and_gaps


def brute(rows):
    out, by = set(), {}
    for g, c, s, e in rows:
        if g is not None and c is not None and s is not None and e is not None and s <= e:
            by.setdefault((g, c), []).append((s, e))
    for k, xs in by.items():
        cur = None
        for s, e in sorted(xs):
            if cur and s <= cur[1] + 1:
                cur[1] = max(cur[1], e)
                continue
            if cur:
                out |= {(*k, "period", *cur), (*k, "gap", cur[1] + 1, s - 1)}
            cur = [s, e]
        out.add((*k, "period", *cur))
    return out


@pytest.mark.parametrize("tile, fan_in, parts", [(1 << 20, 16, 3), (64, 2, 9), (7, 2, 5)])
def test_equals_brute_force(spark, tile, fan_in, parts):
    rng = random.Random(tile)
    rows = [(rng.choice(["g1", "g1", "g1", "g2", None]), rng.choice(["c1", "c2", None]), s := rng.choice([None, *range(1, 900, 3)]), None if s is None else rng.choice([None, s - 2, *range(s, s + 40, 5)])) for _ in range(600)]
    rows += rows[:50]
    df = spark.createDataFrame([(*r, "x") for r in rows], "g string, c string, s int, e int, tile string").repartition(parts)
    found = [tuple(r) for r in periods_and_gaps(df, ["g", "c"], "s", "e", tile, fan_in).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)


def test_ends_of_the_range_and_empty(spark):
    rows = [("g", 2147483640, 2147483647), ("g", -5, 3), ("g", 4, 4), ("h", 1, 1)]
    df = spark.createDataFrame(rows, "kind string, s int, e int")
    found = {tuple(r) for r in periods_and_gaps(df.withColumnRenamed("kind", "k"), ["k"], "s", "e").collect()}
    assert found == {("g", "period", -5, 4), ("g", "gap", 5, 2147483639), ("g", "period", 2147483640, 2147483647), ("h", "period", 1, 1)}
    assert periods_and_gaps(df.limit(0).withColumnRenamed("kind", "k"), ["k"], "s", "e").count() == 0


def test_long_positions(spark):
    """Positions beyond 32 bits, among them an interval over a third of a year in microseconds."""
    rng = random.Random(4)
    rows = [(rng.choice("ab"), "c", s := rng.randrange(-(10**15), 10**15), s + rng.choice([0, 10, 10**9, 10**13])) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, c string, s bigint, e bigint").repartition(4)
    assert {tuple(r) for r in periods_and_gaps(df, ["g", "c"], "s", "e").collect()} == brute(rows)


def test_times_and_dates(spark):
    """Timestamps adjoin by microseconds, dates by days; results have their type."""
    rows = [("a", "2024-01-01 00:00:00", "2024-01-01 11:59:59.999999"), ("a", "2024-01-01 12:00:00", "2024-03-01 00:00:00"), ("a", "2025-01-01 00:00:00", "2025-01-01 00:00:00")]
    text = spark.createDataFrame(rows, "k string, s string, e string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        summer = spark.sql("select 'a' k, timestamp_ntz'2024-03-10 01:00:00' s, timestamp_ntz'2024-03-10 02:30:00' e")
        assert [str(r["last_pos"]) for r in periods_and_gaps(summer, ["k"], "s", "e").collect()] == ["2024-03-10 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for kind in ("timestamp", "timestamp_ntz"):
        found = periods_and_gaps(text.selectExpr("k", f"cast(s as {kind}) s", f"cast(e as {kind}) e"), ["k"], "s", "e")
        assert dict(found.dtypes)["first_pos"] == kind
        got = {tuple(r) for r in found.selectExpr("kind", "cast(first_pos as string)", "cast(last_pos as string)").collect()}
        assert got == {("period", "2024-01-01 00:00:00", "2024-03-01 00:00:00"), ("gap", "2024-03-01 00:00:00.000001", "2024-12-31 23:59:59.999999"), ("period", "2025-01-01 00:00:00", "2025-01-01 00:00:00")}
    days = periods_and_gaps(text.selectExpr("k", "cast(s as date) s", "cast(e as date) e"), ["k"], "s", "e")
    assert {tuple(map(str, r)) for r in days.collect()} == {("a", "period", "2024-01-01", "2024-03-01"), ("a", "gap", "2024-03-02", "2024-12-31"), ("a", "period", "2025-01-01", "2025-01-01")}
