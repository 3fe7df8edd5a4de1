"""The sample sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.gtf import trimmed

REQUIRED = ("sample_id", "fastq_path")


def check_sheet(sheet: DataFrame) -> DataFrame:
    missing = sorted(set(REQUIRED) - set(sheet.columns))
    if missing:
        raise ValueError(f"the sample sheet must have at least the columns {sorted(REQUIRED)}; missing: {missing}")
    return sheet


def clean_sheet(sheet: DataFrame) -> DataFrame:
    """Rows with a sample id (a blank one counts, an empty one doesn't), values trimmed, a missing workdir empty."""
    check_sheet(sheet)
    sheet = sheet if "workdir" in sheet.columns else sheet.withColumn("workdir", F.lit(""))
    texts = {c: trimmed(F.col(c)) for c, kind in sheet.dtypes if kind == "string"}
    return sheet.where(F.col("sample_id") != "").withColumns(texts).withColumn("workdir", F.coalesce("workdir", F.lit("")))


def resolve_dirs(sheet: DataFrame, project_dir: str) -> DataFrame:
    """``sheet`` with sample_dir and out_dir: workdir itself if absolute, under the project if relative, else per_sample/<id>."""
    under = lambda *parts: F.concat_ws("/", F.lit(project_dir.rstrip("/")), *parts)
    place = F.when(F.col("workdir") == "", under(F.lit("per_sample"), F.col("sample_id"))).when(F.col("workdir").startswith("/"), F.col("workdir")).otherwise(under(F.col("workdir")))
    return sheet.withColumn("sample_dir", F.regexp_replace(place, r"(?<=.)/+\z", "")).withColumn("out_dir", F.concat("sample_dir", F.lit("/OUT")))


def check_unique(sheet: DataFrame) -> DataFrame:
    """Fails if a sample id occurs twice, which would give two matrix columns of one name."""
    twice = sheet.groupBy("sample_id").count().where("count > 1").select("sample_id").limit(5).collect()
    if twice:
        raise ValueError(f"sample ids occur more than once: {[r[0] for r in twice]}")
    return sheet
