"""Arrays for training: targets of a trajectory, label masks, padding, hold-outs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IGNORED = -100


def trainable_turns(rows: DataFrame, key: str = "row_id", messages: str = "messages") -> DataFrame:
    """(key, turn, prefix, target): every assistant turn with all that stands before it."""
    each = rows.select(key, messages, F.posexplode(messages).alias("turn", "m")).where("m.role = 'assistant'")
    return each.select(
        key, "turn", F.slice(messages, F.lit(1), F.col("turn")).alias("prefix"), F.coalesce("m.content", F.lit("")).alias("target")
    )


def word_ids(text: Column, vocabulary: int = 50_000) -> Column:
    """Ids of white-space words by hash: a stand-in for a tokenizer that any engine can repeat."""
    found = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    return F.transform(found, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int") % vocabulary)


def encode(prompt_ids: Column, target_ids: Column, longest: int) -> list[Column]:
    """input_ids and labels (the prompt masked); null, so dropped, if longer than allowed, never shortened.

    The arrays stand more than once in the result, so they should be columns of a prior step, not expressions.
    """
    fits = F.size(prompt_ids) + F.size(target_ids) <= longest
    masked = F.array_repeat(F.lit(IGNORED), F.size(prompt_ids))
    return [
        F.when(fits, F.concat(prompt_ids, target_ids)).alias("input_ids"),
        F.when(fits, F.concat(masked, target_ids)).alias("labels"),
    ]


def common_prefix(a: str, b: str) -> Column:
    """Length of the common prefix of two arrays."""
    return F.expr(
        f"coalesce(try_element_at(filter(transform(sequence(0, greatest(size({a}), size({b}))), i -> "
        f"CASE WHEN get({a}, i) IS NULL OR get({b}, i) IS NULL OR get({a}, i) <> get({b}, i) THEN i END), x -> x IS NOT NULL), 1), 0)"
    )


def pad_batches(rows: DataFrame, batch: str, array: str, fill: int) -> DataFrame:
    """Arrays padded to the longest of their batch: the length is aggregated and joined back."""
    longest = rows.groupBy(batch).agg(F.max(F.size(array)).alias("longest"))
    return rows.join(longest, batch).withColumn(
        array, F.concat(F.col(array), F.array_repeat(F.lit(fill), F.col("longest") - F.size(array)))
    ).drop("longest")


def turns_of(rows: DataFrame, key: str = "row_id", messages: str = "messages", calls: str | None = "tool_calls", which: str = "all") -> DataFrame:
    """(key, turn, kind, prefix, target): what a trajectory trains: ``tool``, assistant turns that call tools (``which``: all
    of them, the first, or none), and ``answer``, its last turn, which has to be an assistant's.

    ``calls`` names the messages' field of calls, null where messages have none. The target is a turn's text, its calls as
    JSON after it.
    """
    if which not in ("all", "first", "none"):
        raise ValueError("which is all, first or none")
    ended = rows.withColumn(
        "_m",
        F.when(F.expr(f"element_at({messages}, -1).role") == "assistant", F.col(messages)).otherwise(
            F.raise_error(F.concat(F.lit("a trajectory must end with the assistant's answer: "), F.col(key).cast("string")))
        ),
    )
    each = ended.select(key, "_m", F.posexplode("_m").alias("turn", "m"))
    last = F.size("_m") - 1
    text = F.coalesce("m.content", F.lit(""))
    called = F.coalesce(F.size(f"m.{calls}"), F.lit(0)) > 0 if calls else F.lit(False)
    answers = each.where(F.col("turn") == last).select(key, "turn", F.lit("answer").alias("kind"), "_m", text.alias("target"))
    if which == "none" or not calls:
        out = answers
    else:
        tools = each.where((F.col("turn") < last) & (F.col("m.role") == "assistant") & called)
        tools = tools.select(key, "turn", F.lit("tool").alias("kind"), "_m", F.concat(text, F.to_json(f"m.{calls}")).alias("target"))
        if which == "first":
            tools = tools.groupBy(key).agg(F.min_by(F.struct(*tools.columns), "turn").alias("r")).select("r.*")
        out = tools.unionByName(answers)
    return out.select(key, "turn", "kind", F.slice("_m", F.lit(1), F.col("turn")).alias("prefix"), "target")


def encode_rendered(prompt_ids: str, full_ids: str, longest: int) -> list[Column]:
    """input_ids and labels where the prompt with its answer is rendered as one text: the longest common prefix of the
    two is masked; null if longer than allowed."""
    fits = F.size(full_ids) <= longest
    shared = common_prefix(prompt_ids, full_ids).cast("int")
    rest = F.slice(full_ids, shared + 1, F.greatest(F.size(full_ids) - shared, F.lit(0)))
    return [
        F.when(fits, F.col(full_ids)).alias("input_ids"),
        F.when(fits, F.concat(F.array_repeat(F.lit(IGNORED), shared), rest)).alias("labels"),
    ]


def encode_pairs(pairs: DataFrame, key: str, prompt_ids: str, chosen_ids: str, rejected_ids: str, longest: int) -> DataFrame:
    """key, chosen_input_ids, chosen_labels, rejected_input_ids, rejected_labels of the pairs of which both sides fit."""
    sides = []
    for side, ids in (("chosen", chosen_ids), ("rejected", rejected_ids)):
        sides += [c.alias(f"{side}_{n}") for c, n in zip(encode(F.col(prompt_ids), F.col(ids), longest), ("input_ids", "labels"))]
    fit = F.size(prompt_ids) + F.greatest(F.size(chosen_ids), F.size(rejected_ids)) <= longest
    return pairs.where(fit).select(key, *sides)


def sample_report(samples: DataFrame, length: str, longest: int, by: list[str] | None = None) -> DataFrame:
    """by, samples, kept, dropped (longer than allowed) of encoded samples and the shortest, upper median, 95th of 100 and
    longest kept one."""
    from threadloom.operators.alignment import join_nulls, order_statistics

    by = by or []
    flat = samples.withColumn("_all", F.lit(1))
    keys = ["_all", *by]
    counts = flat.groupBy(*keys).agg(
        F.count("*").alias("samples"), F.count_if(F.col(length) <= longest).alias("kept"), F.count_if(F.col(length) > longest).alias("dropped")
    )
    lengths = order_statistics(flat.where(F.col(length) <= longest), keys, length, {"median": (1, 2), "p95": (95, 100)}).drop("n")
    return join_nulls(counts, lengths, keys, "left").select(*by, "samples", "kept", "dropped", "least", "median", "p95", "most")


def hold_out(samples: DataFrame, key: str, seed: str = "42", least: int = 20, cap: int = 64) -> DataFrame:
    """(key, held): a twentieth of the samples, ``cap`` at most, none of fewer than ``least``; those first by sha1 of seed
    and key. The feature is the cap, so the held ones are a top-n."""
    ids = samples.select(key).distinct()
    n = ids.count()
    size = min(cap, max(1, n // 20)) if n >= least else 0
    drawn = ids.orderBy(F.sha1(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(size).withColumn("held", F.lit(True))
    return ids.join(F.broadcast(drawn), key, "left").select(key, F.coalesce("held", F.lit(False)).alias("held"))  # cap rows
