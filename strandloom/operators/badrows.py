"""Separate the lines that fail to parse, with the reason, from the valid rows.

Structure (quoting, number of fields) is checked on each line. Field values are checked once for each distinct value
of a column; the values that fail form a dictionary with reasons, which is joined back to the lines that hold them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.shared import if_small, written


@dataclass(frozen=True)
class Check:
    """A field (by place), the reason that its invalid values give, and the SQL condition that holds for valid ones."""

    field: int
    reason: str
    valid: str


@dataclass(frozen=True)
class Layout:
    columns: Sequence[str]
    checks: Sequence[Check]


# Fixed values of the formats.
READ_ID = r"\A[A-Za-z0-9]{16}(?s:.*?)_[A-Za-z0-9]{12}#"
STRANDS = ("+", "-", ".")
ASSIGNMENT_TYPES = ("unique", "unique_minor_difference", "inconsistent", "ambiguous", "intergenic", "noninformative")
MAX_POSITION = 2147483647

_number = "ltrim('0', {})"
_at_most = f"(length({_number}) < 10 or length({_number}) = 10 and {_number} <= '{MAX_POSITION}')"
_a, _b = "substring_index(p, '-', 1)", "substring_index(p, '-', -1)"
_a_le_b = f"(length({_number.format(_a)}) < length({_number.format(_b)}) or length({_number.format(_a)}) = length({_number.format(_b)}) and {_number.format(_a)} <= {_number.format(_b)})"
EXONS = f"v = '.' or forall(split(v, ',', -1), p -> p rlike r'\\A[0-9]+-[0-9]+\\z' and {_number.format(_a)} <> '' and {_a_le_b} and {_at_most.format(_b, _b, _b)})"
_one_of = lambda values: "v in (" + ", ".join(f"'{x}'" for x in values) + ")"

READ_ASSIGNMENTS = Layout(
    ("read_id", "chrom", "strand", "isoform_id", "gene_id", "assignment_type", "assignment_events", "exons", "additional_info"),
    (Check(0, "read_id", f"v rlike r'{READ_ID}'"), Check(2, "value", _one_of(STRANDS)), Check(5, "value", _one_of(ASSIGNMENT_TYPES)), Check(7, "value", EXONS)),
)
MODEL_READS = Layout(("read_id", "transcript_id"), (Check(0, "read_id", f"v rlike r'{READ_ID}'"), Check(1, "value", "v <> ''")))
LAYOUTS = {"OUT.read_assignments.gz": READ_ASSIGNMENTS, "OUT.transcript_model_reads.gz": MODEL_READS}
#: The first reason that applies is given.
REASONS = ("quoting", "columns", "read_id", "value")


def fields_of(line: Column, keep: int) -> Column:
    """struct(bad, n, fields): whether quoting fails, the number of tab-separated fields, and the first ``keep`` of them.

    A field that starts with a quote ends at the next single quote, which a tab or the line's end must follow; ``""``
    inside it stands for a quote. Lines without quotes are only split.
    """
    typed = f"struct(false as bad, false as open, 0 as n, '' as cur, cast(array() as array<string>) as fields)"
    body = "if(a.open, p, substr(p, 2))"
    single = f"replace({body}, '\"\"', '')"  # left to right, as pairs are read inside a quoted field
    closes = f"(endswith({single}, '\"') and instr({single}, '\"') = length({single}))"
    still_open = f"(instr({single}, '\"') = 0)"
    quoted = "(a.open or startswith(p, '\"'))"
    text = f"replace({body}, '\"\"', '\"')"
    closed_text = f"replace(substr({body}, 1, length({body}) - 1), '\"\"', '\"')"
    cur = lambda t: f"if(a.open, concat(a.cur, '\\t', {t}), {t})"
    push = lambda t: f"if(a.n < {keep}, array_append(a.fields, {t}), a.fields)"
    step = f"""case
      when a.bad then a
      when {quoted} and {closes} then struct(false as bad, false as open, a.n + 1 as n, '' as cur, {push(cur(closed_text))} as fields)
      when {quoted} and {still_open} then struct(false as bad, true as open, a.n as n, {cur(text)} as cur, a.fields as fields)
      when {quoted} or instr(p, '"') > 0 then struct(true as bad, false as open, a.n as n, '' as cur, a.fields as fields)
      else struct(false as bad, false as open, a.n + 1 as n, '' as cur, {push('p')} as fields) end"""
    scanned = F.expr(f"aggregate(split(line, '\\t', -1), {typed}, (a, p) -> {step}, a -> struct(a.bad or a.open as bad, a.n as n, a.fields as fields))")
    plain = F.expr(f"struct(false as bad, size(split(line, '\\t', -1)) as n, slice(split(line, '\\t', -1), 1, {keep}) as fields)")
    return F.when(F.instr(line, '"') == 0, plain).otherwise(scanned)


def parsed_lines(df: DataFrame, layouts: Mapping[str, Layout] = LAYOUTS) -> DataFrame:
    """``df`` (line_id, file_name, raw_line and others) with parsed = struct(bad, n, fields), without comments and blanks."""
    keep = max(len(x.columns) for x in layouts.values())
    line = F.regexp_replace("raw_line", r"\r\z", "")
    rows = df.withColumn("line", line).where(F.col("line").isNotNull() & ~F.col("line").rlike(r"\A(#|[ \t]*\z)"))
    return rows.withColumn("parsed", fields_of(F.col("line"), keep))


def _structure(layouts: Mapping[str, Layout]) -> Column:
    """The reason of a line's structure; a file without a layout has no right number of fields."""
    wanted = F.lit(-1)
    for name, layout in layouts.items():
        wanted = F.when(F.col("file_name") == name, len(layout.columns)).otherwise(wanted)
    return F.when(F.col("parsed.bad"), "quoting").when(F.col("parsed.n") != wanted, "columns")


def _checked_values(lines: DataFrame, layouts: Mapping[str, Layout]) -> DataFrame:
    """(line_no, line_id, check_id, v): each checked field of the lines of right structure."""
    cases = F.lit(None)
    for name, layout in layouts.items():
        pairs = F.array(*(F.struct(F.lit(f"{name}/{c.field}").alias("check_id"), F.get("fields", F.lit(c.field)).alias("v")) for c in layout.checks))
        cases = F.when(F.col("file_name") == name, pairs).otherwise(cases)
    return lines.select("line_no", "line_id", F.inline(cases))


def invalid_values(values: DataFrame, layouts: Mapping[str, Layout] = LAYOUTS) -> DataFrame:
    """(check_id, v, reason_no): each distinct value checked once; those that fail."""
    ok, no = F.lit(True), F.lit(None)
    for name, layout in layouts.items():
        for c in layout.checks:
            here = F.col("check_id") == f"{name}/{c.field}"
            ok = F.when(here, F.expr(c.valid)).otherwise(ok)
            no = F.when(here, REASONS.index(c.reason)).otherwise(no)
    return values.select("check_id", "v").distinct().where(~ok).select("check_id", "v", no.cast("int").alias("reason_no"))


def structured(df: DataFrame, layouts: Mapping[str, Layout] = LAYOUTS) -> DataFrame:
    """(line_no, line_id, file_name, structure, fields): each line parsed once, in a written table; structure is the reason of a wrong one, or null.

    ``line_no`` tells lines apart whose line_id is null or repeated.
    """
    lines = parsed_lines(df, layouts).select(F.monotonically_increasing_id().alias("line_no"), "line_id", "file_name", _structure(layouts).alias("structure"), F.col("parsed.fields").alias("fields"))
    return written(lines, "lines")


def _failed(lines: DataFrame, layouts: Mapping[str, Layout]) -> DataFrame:
    """(line_no, line_id, reason) of the failed ones of the structured ``lines``."""
    values = _checked_values(lines.where(F.col("structure").isNull()), layouts)
    bad = if_small(written(invalid_values(values, layouts), "invalid"))
    by_value = values.join(bad, ["check_id", "v"]).groupBy("line_no", "line_id").agg(F.min("reason_no").alias("reason_no"))
    named = F.element_at(F.array(*map(F.lit, REASONS)), F.col("reason_no") + 1)
    by_structure = lines.where(F.col("structure").isNotNull()).select("line_no", "line_id", F.col("structure").alias("reason"))
    return by_structure.unionByName(by_value.select("line_no", "line_id", named.alias("reason")))


def failed_lines(df: DataFrame, layouts: Mapping[str, Layout] = LAYOUTS) -> DataFrame:
    """(line_id, reason): the failed lines, each with the first reason that applies.

    Null and blank lines and comments are neither valid nor failed; one carriage return at the end is not part of a
    line; a file name without layout (or null) fails as ``columns``. Repeated lines fail each under its own line_id, one row for each, also if it is null or repeated.
    """
    return _failed(structured(df, layouts), layouts).select("line_id", "reason")


def valid_rows(df: DataFrame, file_name: str, layouts: Mapping[str, Layout] = LAYOUTS) -> DataFrame:
    """(line_id, the columns of ``file_name``'s layout): its lines without a failure, fields unquoted, those of a null or repeated line_id too."""
    lines = structured(df.where(F.col("file_name") == file_name), layouts)
    good = lines.where(F.col("structure").isNull()).join(_failed(lines, layouts), "line_no", "left_anti")
    return good.select("line_id", *(F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(layouts[file_name].columns)))
