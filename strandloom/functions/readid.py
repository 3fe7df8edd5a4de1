"""Barcode and molecule id of a read, from its name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 16 letters or digits, anything but a line feed, then the first _ that 12 letters or digits and # follow.
READ_NAME = r"^([A-Za-z0-9]{16})[^\n]*?_([A-Za-z0-9]{12})#"
#: Names that stand for no gene or transcript.
NO_FEATURE = ("*", ".", "")


def barcode_of(name: Column) -> Column:
    """The barcode, or an empty string if the name doesn't parse; null for a null name."""
    return F.regexp_extract(name, READ_NAME, 1)


def umi_of(name: Column) -> Column:
    return F.regexp_extract(name, READ_NAME, 2)


def with_molecule(df: DataFrame, read_col: str = "read_id", strict: bool = False) -> DataFrame:
    """``df`` with barcode, umi and bu (both together) parsed from ``read_col``.

    Names that don't parse, null ones too, leave the result; with ``strict`` they fail the query instead.
    """
    parsed = df.withColumns({"barcode": barcode_of(F.col(read_col)), "umi": umi_of(F.col(read_col))})
    known = F.coalesce(F.col("barcode") != "", F.lit(False))
    if strict:
        fail = F.raise_error(F.concat(F.lit("no barcode and umi in read id: "), F.coalesce(F.col(read_col), F.lit("null")))).cast("string")
        parsed = parsed.withColumn("barcode", F.when(known, F.col("barcode")).otherwise(fail))
    else:
        parsed = parsed.where(known)
    return parsed.withColumn("bu", F.concat("barcode", "umi"))


def cell_name(barcode: Column, sample: Column | None = None, sep: str = "_") -> Column:
    """The matrix column of a barcode: with its sample in front unless ``sample`` is None."""
    return barcode if sample is None else F.concat(sample, F.lit(sep), barcode)
