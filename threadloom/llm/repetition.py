"""Repetition inside a single document.

Method: the runs of ``n`` words of a document are hashed to buckets, and every run is an event (bucket, whether the run
has started earlier in its document). Two multinomials over these events are fitted, one to all documents (raw corpus),
one to the trusted target: documents trusted for other reasons, such as how their production stopped and how they scored.
A document's score is its log-likelihood ratio, target against raw, less what it would be if each of its runs stood there
for the first time, divided by its length. What a bucket's share of the corpus adds cancels out, so a run counts by how
much less often trusted documents repeat it: a refrain of trusted texts costs little, a run that only broken generations
repeat much. Both multinomials are smoothed towards the recurrence of all their runs.

Documents whose score is at most a threshold are candidates. The threshold is fitted, not guessed, and loses nothing: a
document with a share ``s`` of repeated words has at least ``s / n`` repeated starts a word (a start covers at most ``n``
words), each of which costs at least ``LEAST`` of what a repeated run costs on average. Where trusted documents repeat as
much as others, the ratio tells nothing and every document with a repeated run is a candidate. The exact share is
computed for candidates only.

Everything is built-in functions over arrays in O(n log n) a document, so one very long text neither needs a shuffle nor
quadratic time. The model has at most ``BUCKETS`` rows.

Defined cases: null, empty and wordless texts have 0 words and share 0; texts shorter than ``n`` words have no run; a
null ``trusted`` is not trusted, and without that column all documents are; rows written twice give one row; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.session import materialize

BUCKETS = 1 << 16
#: What is known of all runs counts as so many runs of a bucket.
SMOOTHING = 1000.0
#: A repeated run never costs less than this share of what one costs on average.
LEAST = 0.5


def run_hashes(df: DataFrame, keys: list[str], text: str, trusted: str | None, n: int) -> DataFrame:
    """keys, trusted, words, hs (hashes of the runs of n words in order; null for shorter texts)."""
    faith = F.coalesce(F.col(trusted), F.lit(False)) if trusted else F.lit(True)
    words = df.select(*keys, faith.alias("_trusted"), F.expr(f"regexp_extract_all(lower(`{text}`), '[\\\\p{{L}}\\\\p{{N}}_]+', 0)").alias("w"))
    at = ", ".join(f"get(w, i + {j})" for j in range(n))
    return words.select(
        *keys,
        "_trusted",
        F.coalesce(F.size("w"), F.lit(0)).alias("words"),
        F.expr(f"CASE WHEN size(w) >= {n} THEN transform(sequence(0, size(w) - {n}), i -> xxhash64({at})) END").alias("hs"),
    )


def repeated_runs(hashes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, trusted, words, again: (p, b), place and bucket, of each run that has started earlier in its document.

    Only documents with an equal pair of hashes are sorted; there a run that has started earlier follows its equal.
    """
    runs = hashes.select(
        *keys,
        "_trusted",
        "words",
        F.expr(
            "CASE WHEN size(array_distinct(hs)) < size(hs) THEN "
            "sort_array(transform(hs, (h, i) -> struct(h AS h, i AS p))) END"
        ).alias("g"),
    )
    return runs.select(
        *keys,
        "_trusted",
        "words",
        F.expr(
            "CASE WHEN g IS NULL THEN array() ELSE sort_array(transform(filter("
            "transform(sequence(0, size(g) - 1), j -> struct(g[j].p AS p, g[j].h AS h, "
            "j > 0 AND g[greatest(j, 1) - 1].h = g[j].h AS again)), x -> x.again), "
            f"x -> struct(x.p AS p, cast(pmod(x.h, {BUCKETS}) AS int) AS b))) END"
        ).alias("again"),
    )


def covered(n: int) -> Column:
    """Words in the repeated runs of ``again``: exact, overlaps counted once."""
    return F.expr(
        f"CASE WHEN size(again) = 0 THEN 0 ELSE {n} + aggregate(sequence(1, size(again)), 0, (a, j) -> a + "
        f"CASE WHEN j < size(again) THEN least({n}, again[least(j, size(again) - 1)].p - again[j - 1].p) ELSE 0 END) END"
    )


def fit_ratio(hashes: DataFrame, repeats: DataFrame) -> DataFrame:
    """(bucket, ratio, mean): what a repeated run of a bucket adds to the ratio, and what one adds on average.

    Counts are over all rows; the table has at most BUCKETS rows whatever the input. Log odds of recurrence in the target
    less those in the raw corpus; never above ``LEAST`` of the mean, which is at most 0.
    """
    runs = (
        hashes.select("_trusted", F.explode(F.expr(f"transform(hs, h -> cast(pmod(h, {BUCKETS}) AS int))")).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count_if("_trusted").alias("target"))
    )
    again = (
        repeats.select("_trusted", F.explode("again.b").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw_again"), F.count_if("_trusted").alias("target_again"))
    )
    zero = F.lit(0).cast("long")
    counts = materialize(
        runs.join(again, "bucket", "left").select(
            "bucket", "raw", "target", F.coalesce("raw_again", zero).alias("raw_again"), F.coalesce("target_again", zero).alias("target_again")
        ),
        "runs",
    )
    rate = lambda a, n: (F.sum(a) + F.lit(0.5)) / (F.sum(n) + F.lit(1.0))
    rates = F.broadcast(counts.agg(rate("raw_again", "raw").alias("p"), rate("target_again", "target").alias("q")))  # one row
    odds = lambda a, n, p: F.log((F.col(a) + SMOOTHING * F.col(p)) / (F.col(n) - F.col(a) + SMOOTHING * (1 - F.col(p))))
    mean = F.least(F.lit(0.0), F.log(F.col("q") / (1 - F.col("q"))) - F.log(F.col("p") / (1 - F.col("p"))))
    own = odds("target_again", "target", "q") - odds("raw_again", "raw", "p")
    return counts.where("raw_again > 0").crossJoin(rates).select("bucket", F.least(own, LEAST * mean).alias("ratio"), mean.alias("mean"))


def repetition_scores(df: DataFrame, keys: list[str], text: str, trusted: str | None = None, n: int = 5) -> DataFrame:
    """keys, words, again, score, mean of every distinct row with a repeated run; the others' score is 0.

    The model's size is bounded by BUCKETS, so it is broadcast.
    """
    hashes = run_hashes(df, keys, text, trusted, n)
    # Filtered once it is stored: a filter on arrays still to be made would be pushed down and make them for every element.
    repeats = materialize(repeated_runs(hashes, keys), "repeats").where(F.size("again") > 0)
    model = materialize(fit_ratio(hashes, repeats).coalesce(1), "ratios")
    rows = repeats.dropDuplicates(keys)
    cost = (
        rows.select(*keys, F.explode("again.b").alias("bucket"))
        .join(F.broadcast(model), "bucket")
        .groupBy(*keys)
        .agg(F.sum("ratio").alias("cost"), F.first("mean").alias("mean"))
    )
    return rows.join(cost, keys).select(*keys, "words", "again", (F.col("cost") / F.col("words")).alias("score"), "mean")


def candidates(scored: DataFrame, min_share: float, n: int = 5) -> DataFrame:
    """The scored rows that may have ``min_share`` repeated words."""
    return scored.where(F.col("score") <= F.lit(min_share / n * LEAST) * F.col("mean") + 1e-9)


def repeated_documents(
    df: DataFrame, keys: list[str], text: str, trusted: str | None = None, n: int = 5, min_words: int = 10, min_share: float = 0.3
) -> DataFrame:
    """keys, words, repeated, share, score of every document of at least ``min_words`` words and ``min_share`` repetition."""
    found = candidates(repetition_scores(df, keys, text, trusted, n), min_share, n).withColumn("repeated", covered(n))
    shared = found.select(*keys, "words", "repeated", (F.col("repeated") / F.col("words")).alias("share"), "score")
    return shared.where((F.col("words") >= min_words) & (F.col("share") >= min_share))


def repetition_shares(df: DataFrame, keys: list[str], text: str, n: int = 5) -> DataFrame:
    """keys, words, repeated of every distinct row: the share is their quotient."""
    runs = repeated_runs(run_hashes(df, keys, text, None, n), keys)
    return runs.select(*keys, "words", covered(n).alias("repeated")).dropDuplicates(keys)
