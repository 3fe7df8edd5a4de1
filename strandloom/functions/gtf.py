"""Attribute texts and exon structures of annotations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks a transcript as part of the reference annotation.
REFERENCE_GENE = "ENSG"
REFERENCE_TRANSCRIPT = "ENS"
REFERENCE_SOURCES = ("ENSEMBL", "HAVANA")
REFERENCE_KEY = "havana_transcript"

#: Space characters, as regular expression and one by one.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
SPACES = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def attributes(text: Column) -> Column:
    """array<struct<k, v>> of the fields of an attribute text, in order.

    Fields end at any semicolon, also inside quotes; a field without a space is dropped; all quotes around a value go.
    """
    inner = F.btrim(trimmed(text), F.lit(";"))
    fields = F.filter(F.transform(F.split(inner, ";"), trimmed), lambda f: F.instr(f, " ") > 0)
    pair = lambda f: F.struct(F.substring_index(f, " ", 1).alias("k"), F.btrim(trimmed(F.substr(f, F.instr(f, " ") + 1)), F.lit('"')).alias("v"))
    return F.transform(fields, pair)


def attribute(pairs: Column, key: str) -> Column:
    """The last value of ``key``, or null."""
    return F.try_element_at(F.filter(pairs, lambda p: p["k"] == key), F.lit(-1))["v"]


def is_reference(transcript_id: Column, gene_id: Column, source: Column, pairs: Column) -> Column:
    return gene_id.startswith(REFERENCE_GENE) | transcript_id.startswith(REFERENCE_TRANSCRIPT) | source.isin(*REFERENCE_SOURCES) | F.exists(pairs, lambda p: p["k"] == REFERENCE_KEY)


# Exons are array<struct<start, end>>, sorted.


def exon_count(exons: Column) -> Column:
    return F.size(exons)


def first_start(exons: Column) -> Column:
    return F.get(exons, F.lit(0))["start"]


def last_end(exons: Column) -> Column:
    """The end of the last exon, which needn't be the greatest end."""
    return F.try_element_at(exons, F.lit(-1))["end"]


def strand_ends(exons: Column, strand: Column) -> Column:
    """struct(five, three): on every strand but + the end comes first."""
    plus = F.coalesce(strand == "+", F.lit(False))
    return F.struct(F.when(plus, first_start(exons)).otherwise(last_end(exons)).alias("five"), F.when(plus, last_end(exons)).otherwise(first_start(exons)).alias("three"))


def junctions(exons: Column) -> Column:
    """array<struct<donor, acceptor>> between neighbouring exons; empty for a single exon."""
    n = F.greatest(F.size(exons) - 1, F.lit(0))
    return F.zip_with(F.slice(exons, F.lit(1), n), F.slice(exons, F.lit(2), n), lambda a, b: F.struct(a["end"].alias("donor"), b["start"].alias("acceptor")))
