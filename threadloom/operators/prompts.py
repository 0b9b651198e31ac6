"""What a step or a job is asked: built from messages and earlier output, and compared with what was stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import is_blank, token_estimate, word_count
from threadloom.operators.steps import CAPS, render_prompt, transcripts

BUDGET = 0.7


def build_steps(rows: DataFrame, chains: DataFrame, template: str) -> DataFrame:
    """Rows (row_id, chain, kind, k, previous_summary, max_tokens) with previous, rebuilt_limit and prompt.

    A blank previous output is none, any other stands as it is and counts for a short step's limit; a row without
    max_tokens has its kind's cap.
    """
    parts = []
    for kind in CAPS:
        t = transcripts(chains, kind).select("chain", F.lit(kind).alias("kind"), "k", "transcript", "tokens")
        parts.append(t)
    asked = rows.join(parts[0].unionByName(parts[1]), ["chain", "kind", "k"])
    previous = F.when(~is_blank(F.col("previous_summary")), F.col("previous_summary"))
    cap = F.coalesce("max_tokens", *[F.when(F.col("kind") == k, F.lit(c)) for k, c in CAPS.items()])
    spent = F.least(F.col("tokens") + F.when(previous.isNotNull(), token_estimate(previous)).otherwise(0), cap)
    limit = F.floor(F.when(F.col("kind") == "short", spent).otherwise(cap) * F.lit(0.75)).cast("int")
    built = asked.select("*", previous.alias("previous"), limit.alias("rebuilt_limit"))
    return built.withColumn("prompt", render_prompt(template, F.col("transcript"), F.col("rebuilt_limit"), F.col("previous"))).drop("transcript", "tokens")


def assert_limits(built: DataFrame) -> DataFrame:
    """The rows themselves; an action on them fails at the first whose stored limit isn't the rebuilt one."""
    wrong = F.concat_ws(" ", F.lit("stored and rebuilt limits differ:"), F.col("row_id").cast("string"), F.col("output_words").cast("string"), F.col("rebuilt_limit").cast("string"))
    same = F.col("output_words").eqNullSafe(F.col("rebuilt_limit"))
    return built.withColumn("output_words", F.when(same, F.col("output_words")).otherwise(F.raise_error(wrong).cast("int")))


def budget(limit: Column) -> Column:
    """Words a job asks for: less than the limit, so that most answers keep it."""
    return F.floor(limit * F.lit(BUDGET)).cast("int")


def may_drop(due: Column) -> Column:
    """How many of the facts due the last attempt may leave out."""
    return F.greatest(F.lit(1).cast("long"), F.floor(due / 10)).cast("int")


def job_text(job: Column, prompt: Column, draft: Column, limit: Column, due: Column) -> Column:
    """The text of a job: the prompt afresh, or the draft to be shortened, the last time with leave to drop facts."""
    shorten = F.concat(
        F.lit("Shorten this draft of "), word_count(draft).cast("string"), F.lit(" words to at most "), budget(limit).cast("string"), F.lit(" words"),
        F.when(job == "compress_last", F.concat(F.lit("; up to "), may_drop(due).cast("string"), F.lit(" facts may go"))).otherwise(""), F.lit(":\n\n"), draft,
    )
    return F.when(job.isin("compress", "compress_last"), shorten).when(job == "fresh", prompt)


def generation_tokens(n_messages: Column) -> Column:
    """Tokens allowed for a generated conversation."""
    return F.least(F.lit(32_000), n_messages * 160 + 6_000).cast("int")


def switched(template: Column, old: str, new: str) -> list[Column]:
    """A template with one part replaced, and whether it had that part."""
    return [F.replace(template, F.lit(old), F.lit(new)).alias("template"), F.contains(template, F.lit(old)).alias("switched")]
