"""Blocks of a conversation, the steps they make, and what each step is asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import token_estimate

SIZES = {"short": 20, "long": 60}
CAPS = {"short": 1000, "long": 4000}
#: Fixed value: what stands for a previous summary where there is none.
NO_PREVIOUS = "There is no previous summary -- the messages are the beginning of the conversation."


def good_chains(chains: DataFrame) -> DataFrame:
    """Chains that didn't fail, the first received of each id. Aggregated, so any number of repeats costs no skew."""
    columns = chains.columns
    kept = chains.where(F.col("id").isNotNull() & F.col("`__failed__`").isNull())
    return kept.groupBy("id").agg(F.min_by(F.struct(*columns), "received_at").alias("r")).select("r.*")


def messages(chains: DataFrame) -> DataFrame:
    """(chain, seq, peer, text) of every message."""
    return chains.select(F.col("id").alias("chain"), F.explode("messages").alias("m")).where("m IS NOT NULL").select(
        "chain", "m.seq", F.coalesce("m.peer", F.lit("")).alias("peer"), F.coalesce("m.text", F.lit("")).alias("text")
    )


def steps(chains: DataFrame) -> DataFrame:
    """(chain, kind, k, lo, hi): complete blocks only, message numbers from 1, both ends included."""
    n = F.coalesce(F.size("messages"), F.lit(0))
    parts = []
    for kind, size in SIZES.items():
        full = chains.select(F.col("id").alias("chain"), F.floor(n / size).cast("int").alias("blocks")).where("blocks > 0")
        parts.append(
            full.select("chain", F.lit(kind).alias("kind"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("k")).select(
                "chain", "kind", "k", (F.col("k") * size + 1).alias("lo"), ((F.col("k") + 1) * size).alias("hi")
            )
        )
    return parts[0].unionByName(parts[1])


def with_chunks(chains: DataFrame) -> DataFrame:
    """Chains with their block lists: ``chunks`` and ``chunks_long``, arrays of (k, [lo, hi]), empty for short chains."""
    n = "coalesce(size(messages), 0)"
    made = lambda size: F.expr(
        f"CASE WHEN {n} >= {size} THEN transform(sequence(0, {n} div {size} - 1), k -> struct(cast(k AS int) AS k, array(cast(k * {size} + 1 AS int), cast((k + 1) * {size} AS int)) AS seqs))"
        " ELSE cast(array() AS array<struct<k:int,seqs:array<int>>>) END"
    )
    return chains.withColumns({"chunks": made(SIZES["short"]), "chunks_long": made(SIZES["long"])})


def stored_steps(chains: DataFrame) -> DataFrame:
    """(chain, kind, k, lo, hi) from the block lists that chains carry; null blocks are left out."""
    parts = [
        chains.select(F.col("id").alias("chain"), F.lit(kind).alias("kind"), F.explode(column).alias("c")).where("c IS NOT NULL")
        for kind, column in (("short", "chunks"), ("long", "chunks_long"))
    ]
    return parts[0].unionByName(parts[1]).select("chain", "kind", "c.k", F.get("c.seqs", F.lit(0)).alias("lo"), F.get("c.seqs", F.lit(1)).alias("hi"))


def chain_view(chains: DataFrame, kind: str) -> DataFrame:
    """Chains as a kind of step sees them: its block list in ``chunks``."""
    return chains.withColumn("chunks", F.col("chunks" if kind == "short" else "chunks_long"))


def step_order(all_steps: DataFrame) -> DataFrame:
    """Steps with their place in the chain: by their last message, short before long."""
    from pyspark.sql.window import Window

    by = Window.partitionBy("chain").orderBy("hi", F.desc("kind"))
    return all_steps.withColumn("place", F.row_number().over(by))


def step_messages(chains: DataFrame, kind: str) -> DataFrame:
    """(chain, k, seq, peer, text): messages of complete blocks, joined on the block number, not by range."""
    size = SIZES[kind]
    blocks = chains.select(
        F.col("id").alias("chain"), F.floor(F.coalesce(F.size("messages"), F.lit(0)) / size).cast("int").alias("blocks"), "messages"
    )
    found = blocks.select("chain", "blocks", F.explode("messages").alias("m")).where("m IS NOT NULL")
    return found.select(
        "chain",
        F.floor((F.col("m.seq") - 1) / size).cast("int").alias("k"),
        "blocks",
        "m.seq",
        F.coalesce("m.peer", F.lit("")).alias("peer"),
        F.coalesce("m.text", F.lit("")).alias("text"),
    ).where("k < blocks").drop("blocks")


def transcripts(chains: DataFrame, kind: str) -> DataFrame:
    """(chain, k, transcript, tokens): ``peer: text`` lines in order, and the messages' estimated tokens."""
    line = F.struct("seq", F.concat_ws(": ", "peer", "text").alias("line"))
    lines = F.array_sort(F.collect_list(line))  # at most one block
    return step_messages(chains, kind).groupBy("chain", "k").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("transcript"),
        F.sum(token_estimate(F.col("text"))).cast("int").alias("tokens"),
    )


def word_limit(kind: str, input_tokens: Column) -> Column:
    """Words allowed: three quarters of the cap, for short steps of the input if that is less."""
    cap = F.lit(CAPS[kind])
    return F.floor((F.least(input_tokens, cap) if kind == "short" else cap) * F.lit(0.75)).cast("int")


def step_id(chain: Column, kind: Column, k: Column, variant: Column) -> Column:
    return F.concat(chain, F.lit("-"), F.when(kind == "short", "s").otherwise("l"), k.cast("string"), variant)


def parse_step_id(name: Column) -> list[Column]:
    """chain, kind, k, variant of a step id; the last dash divides."""
    pattern = r"^(.*)-(.)([0-9]*)([^-]*)$"
    return [
        F.regexp_extract(name, pattern, 1).alias("chain"),
        F.when(F.regexp_extract(name, pattern, 2) == "s", "short").otherwise("long").alias("kind"),
        F.regexp_extract(name, pattern, 3).try_cast("int").alias("k"),
        F.regexp_extract(name, pattern, 4).alias("variant"),
    ]


def prompt_fields(asked: Column) -> list[Column]:
    """previous, conversation, limit of a rendered prompt."""
    return [
        F.regexp_extract(asked, r"(?s)<previous_summary>\s*(.*?)\s*</previous_summary>", 1).alias("previous"),
        F.regexp_extract(asked, r"(?s)<conversation>\s*(.*?)\s*</conversation>", 1).alias("conversation"),
        F.regexp_extract(asked, r"([0-9]+) words", 1).try_cast("int").alias("word_limit"),
    ]


def render_prompt(template: str, transcript: Column, limit: Column, previous: Column) -> Column:
    """A prompt from a template with {previous}, {conversation} and {limit}; the wording is the caller's."""
    held = F.when(F.trim(F.coalesce(previous, F.lit(""))) == "", F.lit(NO_PREVIOUS)).otherwise(previous)
    out = F.lit(template)
    for name, value in (("{previous}", held), ("{conversation}", transcript), ("{limit}", limit.cast("string"))):
        out = F.replace(out, F.lit(name), value)
    return out


def hash_sample(name: Column, per_mille: int) -> Column:
    """Whether the sha1 of a name, as a number, modulo 1000 is below a limit: the same rows on every run and engine."""
    digits = F.sha1(name)
    value = F.aggregate(
        F.sequence(F.lit(1), F.lit(40)),
        F.lit(0),
        lambda a, i: (a * 16 + F.instr(F.lit("0123456789abcdef"), F.substring(digits, i, F.lit(1))) - 1) % 1000,
    )
    return value < per_mille
