import re

from strandloom.operators.badrows import LAYOUTS, failed_lines, valid_rows

A, M = LAYOUTS
ID = "ACGTACGTACGTACGT_AAAACCCCGGGG#r1"
GOOD = [ID, "chr1", "+", "T", "G", "unique", "ev", "1-5,7-9", "*"]


def line(**change):
    return "\t".join(change.get(f"f{i}", x) for i, x in enumerate(GOOD))


CASES = [
    (A, line(), None, GOOD),
    (A, line() + "\r", None, GOOD),
    (A, line() + "\r\r", None, [*GOOD[:8], "*\r"]),
    (A, "# comment", "skip", None),
    (A, " \t ", "skip", None),
    (A, "", "skip", None),
    (A, "\r", "skip", None),
    (A, None, "skip", None),
    (A, line(f4='"G\tx"'), None, [*GOOD[:4], "G\tx", *GOOD[5:]]),
    (A, line(f4='"G""q"'), None, [*GOOD[:4], 'G"q', *GOOD[5:]]),
    (A, line(f4='""'), None, [*GOOD[:4], "", *GOOD[5:]]),
    (A, line(f4='"""'), "quoting", None),
    (A, line(f4='"G"x'), "quoting", None),
    (A, line(f4='G"x'), "quoting", None),
    (A, line(f8='"open'), "quoting", None),
    (A, line(f8='"open""'), "quoting", None),
    (A, line(f8='"a"\t"b'), "quoting", None),
    (A, line() + "\tx", "columns", None),
    (A, "x", "columns", None),
    (A, "\t" + line(), "columns", None),
    (A, line(f0="ACGTACGTACGTACG_AAAACCCCGGGG#"), "read_id", None),
    (A, line(f0="ACGTACGTACGTACGTxx_bad_AAAACCCCGGGG#"), None, ["ACGTACGTACGTACGTxx_bad_AAAACCCCGGGG#", *GOOD[1:]]),
    (A, line(f0=" " + ID), "read_id", None),
    (A, line(f0=ID.lower(), f2="x"), "value", None),
    (A, line(f2="?"), "value", None),
    (A, line(f5="Unique"), "value", None),
    (A, line(f7="."), None, [*GOOD[:7], ".", "*"]),
    (A, line(f7=""), "value", None),
    (A, line(f7="0-5"), "value", None),
    (A, line(f7="5-4"), "value", None),
    (A, line(f7="5-5,"), "value", None),
    (A, line(f7="0005-10"), None, [*GOOD[:7], "0005-10", "*"]),
    (A, line(f7="1-2147483647"), None, [*GOOD[:7], "1-2147483647", "*"]),
    (A, line(f7="1-2147483648"), "value", None),
    (A, line(f7="1-" + "9" * 60), "value", None),
    (A, line(f7="٣-٤"), "value", None),
    (A, line(f7="1-2 "), "value", None),
    (M, ID + "\tT1", None, [ID, "T1"]),
    (M, ID + "\t", "value", None),
    (M, '"' + ID + '"\t"T""1"', None, [ID, 'T"1']),
    (M, ID, "columns", None),
    (M, line(), "columns", None),
    ("other", ID + "\tT1", "columns", None),
    (None, ID + "\tT1", "columns", None),
    (A, "x" + "\t" * 50_000, "columns", None),
    (A, '"' * 50_001, "quoting", None),
    (A, line(f8="y" * 300_000), None, [*GOOD[:8], "y" * 300_000]),
]


def frame(spark, cases):
    return spark.createDataFrame([(i, f, text, f"r{i}") for i, (f, text, _, _) in enumerate(cases)], "line_id bigint, file_name string, raw_line string, reason string")


def test_reasons_and_valid_rows(spark):
    df = frame(spark, CASES)
    found = {r["line_id"]: r["reason"] for r in failed_lines(df).collect()}
    assert found == {i: c[2] for i, c in enumerate(CASES) if c[2] not in (None, "skip")}
    for name, layout in LAYOUTS.items():
        rows = {r["line_id"]: list(r)[1:] for r in valid_rows(df, name).collect()}
        assert rows == {i: c[3] for i, c in enumerate(CASES) if c[0] == name and c[2] is None}
        assert valid_rows(df, name).columns == ["line_id", *layout.columns]


def test_repeats_and_empty(spark):
    df = frame(spark, [CASES[11], CASES[11], CASES[24], CASES[24]])
    assert sorted(r["reason"] for r in failed_lines(df).collect()) == ["quoting", "quoting", "value", "value"]
    assert failed_lines(df.limit(0)).count() == 0 and valid_rows(df.limit(0), A).count() == 0


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("strandloom.operators.badrows.if_small", lambda df: df)
    df = frame(spark, CASES)
    assert failed_lines(df).count() == sum(c[2] not in (None, "skip") for c in CASES)


def test_a_plain_parser_agrees(spark):
    """Random lines against a character-by-character reading of the quoting rule."""
    import random

    rng = random.Random(5)
    lines = ["".join(rng.choice('a"\t"b') for _ in range(rng.randrange(1, 9))) for _ in range(1500)]

    def fields(s):
        out, i = [], 0
        while True:
            if s[i : i + 1] == '"':
                i, text = i + 1, ""
                while True:
                    if i >= len(s):
                        return None
                    if s[i] == '"' and s[i + 1 : i + 2] == '"':
                        text, i = text + '"', i + 2
                    elif s[i] == '"':
                        i += 1
                        break
                    else:
                        text, i = text + s[i], i + 1
                if i < len(s) and s[i] != "\t":
                    return None
            else:
                end = s.find("\t", i)
                end = len(s) if end < 0 else end
                text, i = s[i:end], end
                if '"' in text:
                    return None
            out.append(text)
            if i >= len(s):
                return out
            i += 1

    df = spark.createDataFrame([(i, M, x) for i, x in enumerate(lines)], "line_id bigint, file_name string, raw_line string")
    got = {r["line_id"]: r["reason"] for r in failed_lines(df).collect()}
    for i, x in enumerate(lines):
        if re.fullmatch(r"[ \t]*", x):
            assert i not in got
            continue
        f = fields(x)
        assert got[i] == ("quoting" if f is None else "columns" if len(f) != 2 else "read_id"), x


def test_null_and_repeated_line_ids(spark):
    """A line that fails gives one row, whatever its line_id; valid lines of the same line_id stay."""
    good, bad, torn = "A" * 16 + "_" + "B" * 12 + "#r\tT1", "x\tT1", "x"
    rows = [(i, M, x) for i in (None, 7) for x in (good, bad, torn, good, bad)]
    df = spark.createDataFrame(rows, "line_id bigint, file_name string, raw_line string").repartition(3)
    failed = sorted((r["line_id"] or 0, r["reason"]) for r in failed_lines(df).collect())
    assert failed == [(i, why) for i in (0, 7) for why in ("columns", "read_id", "read_id")]
    assert sorted((r["line_id"] or 0, r["transcript_id"]) for r in valid_rows(df, M).collect()) == [(0, "T1"), (0, "T1"), (7, "T1"), (7, "T1")]
