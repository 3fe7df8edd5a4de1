"""Mixes of several sources by target shares of the tokens, without sorting the documents.

Each document has a 60-bit hash. Tokens are summed by source and by the hash's first 10 bits; running sums find the
bucket in which a source's budget ends, and only the documents of that bucket are summed again by the next 10 bits, until
it holds one document. A source then gives all its documents the whole repeats that its budget covers, and one more to
the documents below its threshold; documents are only filtered by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.tokens import TOKENIZER, TOKENIZERS, token_counts
from strandloom.shared import if_small, written

HASH_BITS = 60
STEP_BITS = 10


def document_sizes(df: DataFrame, id_col: str, source_col: str, text_col: str, tokenizer: str = TOKENIZER, folder: str = TOKENIZERS) -> DataFrame:
    """(doc, source, n_tokens, h): tokens and 60-bit hash of each document with an id, a source and at least one token."""
    docs = df.where(F.col(id_col).isNotNull() & F.col(source_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    h = F.shiftrightunsigned(F.xxhash64("doc"), 64 - HASH_BITS)
    return written(token_counts(docs, ["doc", "source"], "text", tokenizer, folder).where("n_tokens > 0").withColumn("h", h), "sizes")


def budgets(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, held, budget, whole, rest) of each source of ``targets``.

    Shares are taken relative to the sum over the sources that hold tokens. Without ``total_tokens`` the mix is the
    largest in which every source meets its share; with it, a source gives at most max_repeats times what it holds.
    """
    held = sizes.groupBy("source").agg(F.sum("n_tokens").alias("held"))
    wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = written(wanted.join(held, "source", "left").fillna(0, ["held", "target_share", "max_repeats"]), "held")
    usable = (F.col("held") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    share = both.where(usable).agg(F.sum("target_share")).first()[0] or 1.0
    part = F.col("target_share") / F.lit(share)
    most = F.col("held") * F.col("max_repeats")
    total = total_tokens if total_tokens is not None else both.where(usable).agg(F.min(most / part)).first()[0] or 0
    budget = F.when(usable, F.least(F.floor(part * F.lit(float(total)) + 1e-6), most)).otherwise(0).cast("bigint")
    whole = F.when(F.col("held") > 0, F.floor(F.col("budget") / F.greatest("held", F.lit(1)))).otherwise(0).cast("bigint")
    return both.withColumn("budget", budget).withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("held"))


def thresholds(sizes: DataFrame, rests: DataFrame) -> DataFrame:
    """(source, threshold): documents with h below it hold about ``rest`` of the source's tokens, within half a document.

    What is kept between steps has one row for each source, and the documents of the boundary buckets, from which the next
    step is made. Documents of equal hash go together.
    """
    state = written(rests.where("rest > 0").select("source", F.lit(0).cast("bigint").alias("prefix"), "rest"), "state")
    running = Window.partitionBy("source").orderBy("digit")
    bits = HASH_BITS
    boundary = sizes.select("source", "n_tokens", "h")
    while True:
        bits -= STEP_BITS
        inside = boundary.join(if_small(state.select("source", "prefix", "rest")), "source").where(F.shiftright("h", bits + STEP_BITS) == F.col("prefix"))
        sums = inside.groupBy("source", "prefix", "rest", F.shiftright("h", bits).bitwiseAND(F.lit((1 << STEP_BITS) - 1)).alias("digit")).agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
        last = sums.withColumn("reached", F.sum("t").over(running)).where("reached > rest and reached - t <= rest")
        state = written(last.select("source", (F.col("prefix") * (1 << STEP_BITS) + F.col("digit")).alias("prefix"), (F.col("rest") - F.col("reached") + F.col("t")).alias("rest"), "t", "n"), "state")
        if bits == 0 or state.where("n > 1").isEmpty():
            break
        here = F.shiftright("h", bits) == F.col("prefix")
        boundary = written(boundary.join(if_small(state.select("source", "prefix")), "source").where(here).select("source", "n_tokens", "h"), "boundary")
    return state.select("source", F.shiftleft(F.col("prefix") + F.when(F.col("rest") * 2 >= F.col("t"), 1).otherwise(0), bits).alias("threshold"))


def mix(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", total_tokens: int | None = None, **tokens: str) -> tuple[DataFrame, DataFrame]:
    """(chosen, report): the documents of a mix with their repeats, and what each source gives to it.

    ``chosen``: id_col, source, n_tokens bigint, repeats bigint (from 1 to the source's max_repeats). ``report``: source,
    target_share, max_repeats, held_tokens, mix_docs, mix_tokens, actual_share; one row for each source of ``targets``, 0
    where it gives nothing. Documents with null id or source, of other sources, or without a token (null, empty) aren't
    chosen. A source whose shares, repeats or documents are missing gives nothing and the others' shares fill its place.
    """
    sizes = document_sizes(df, id_col, source_col, text_col, **tokens)
    plan = written(budgets(sizes, targets, total_tokens), "budgets")
    cut = plan.join(thresholds(sizes, plan), "source", "left").select("source", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    repeats = F.col("whole") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    chosen = written(sizes.join(if_small(written(cut, "cut")), "source").select("doc", "source", "n_tokens", repeats.alias("repeats")).where("repeats > 0"), "chosen")
    given = chosen.groupBy("source").agg(F.count("*").alias("mix_docs"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("mix_tokens"))
    every = chosen.agg(F.sum(F.col("n_tokens") * F.col("repeats"))).first()[0] or 1
    report = plan.join(given, "source", "left").fillna(0, ["mix_docs", "mix_tokens"])
    report = report.select("source", "target_share", "max_repeats", F.col("held").alias("held_tokens"), "mix_docs", "mix_tokens", (F.col("mix_tokens") / F.lit(every)).alias("actual_share"))
    return chosen.withColumnRenamed("doc", id_col), report
