"""Column functions over texts: counting, normalising, anchors, format flags and fact matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of the format flags.
BULLETS = r"(?m)^\s*([-*•]|\d+[.)])\s+\S"
META = (
    r"(?i)^\s*(here('s| is) (a |the )?(summary|recap)|summary:|in summary,|this (conversation|summary)\b|"
    r"below is|the following (is|summary))"
)
THINK_LEAK = r"(?im)</?think>|^\s*thinking process\b"
NARRATION = (
    r"(?i)^\s*(i('ll| will) (summarize|summarise|now)|let me (summarize|summarise|start)|"
    r"first,? (i|let me)|okay,? (so|let))"
)
ECHO = r"(?i)</?conversation>|</?previous_summary>|there is no previous summary"
FLAGS = {"bullets": BULLETS, "meta": META, "think_leak": THINK_LEAK, "narration": NARRATION, "echo": ECHO}

#: Words that are no anchors.
STOPWORDS = (
    "the a an of in on at to for and or with from by is are was were be been her his their its my our your she he "
    "they it that this as per not no up out if when than so"
).split()
#: Number words and their digits.
NUMBERS = dict(
    zip(
        "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
        "eighteen nineteen twenty".split(),
        range(21),
    )
) | {w: 10 * i for i, w in enumerate("thirty forty fifty sixty seventy eighty ninety".split(), 3)}
TOKEN = r"[\p{L}\p{N}]+(?:[.,:/][0-9]+)*"
SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"
WINDOW, STRICT_WINDOW = 15, 6


def word_count(text: Column) -> Column:
    """Words between white space of any kind; null has 0."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != ""))


def token_estimate(text: Column) -> Column:
    """Four characters to a token, rounded up."""
    return F.floor((F.length(F.coalesce(text, F.lit(""))) + 3) / 4).cast("int")


def is_blank(text: Column) -> Column:
    """Null, empty or only white space of any kind."""
    return ~F.coalesce(text, F.lit("")).rlike(r"[^\s\x1c-\x1f\x85\p{Z}]")


def flag(text: Column, name: str) -> Column:
    return F.coalesce(text, F.lit("")).rlike(FLAGS[name])


def normalise(text: Column) -> Column:
    """Lower case, straight quotes, no thousands separators, number words as digits.

    The replacements of number words run only on texts that have one.
    """
    t = F.translate(F.lower(F.coalesce(text, F.lit(""))), "’‘“”", "''\"\"")
    t = F.regexp_replace(t, r"(\d),(\d{3})(?!\d)", "$1$2")
    edge, end = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
    digits = t
    for word, value in NUMBERS.items():
        digits = F.regexp_replace(digits, f"{edge}{word}{end}", str(value))
    return F.when(t.rlike(f"{edge}({'|'.join(NUMBERS)}){end}"), digits).otherwise(t)


def tokens(normalised: Column) -> Column:
    return F.regexp_extract_all(normalised, F.lit(TOKEN), F.lit(0))


def anchors(fact_tokens: Column, ignore: Column | None = None) -> Column:
    """Tokens that carry evidence: no stop words, no ignored names, and of two characters or a digit; repeats stay."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    kept = F.filter(fact_tokens, lambda t: ~F.array_contains(stop, t) & ((F.length(t) >= 2) | t.rlike(r"^\p{Nd}$")))
    if ignore is not None:
        kept = F.filter(kept, lambda t: ~F.array_contains(ignore, t))
    return kept


def has_fact(text: str, text_tokens: str, fact: str, fact_anchors: str, strict: bool = False) -> Column:
    return F.expr(has_fact_sql(text, text_tokens, fact, fact_anchors, strict))


def has_fact_sql(text: str, text_tokens: str, fact: str, fact_anchors: str, strict: bool = False) -> str:
    """Whether a text states a fact; all four are names of prepared columns, or of a lambda's fields.

    The normalised fact is a substring, or its anchors stand together: within 15 tokens all of them but one (all of one
    or two), numbers always; strictly within 6 tokens all of them, two in order with at most one word between.
    """
    span = STRICT_WINDOW if strict else WINDOW
    need = "size(a)" if strict else "CASE WHEN size(a) <= 2 THEN size(a) ELSE size(a) - 1 END"
    a, k = fact_anchors, text_tokens
    window = f"slice({k}, i + 1, {span})"
    near = (
        f"exists(sequence(0, size({k}) - 1), i -> array_contains({a}, {k}[i]) "
        f"AND forall(filter({a}, n -> n rlike '[0-9]'), n -> array_contains({window}, n)) "
        f"AND size(filter({a}, x -> array_contains({window}, x))) >= {need.replace('(a)', f'({a})')})"
    )
    if strict:
        pair = f"exists(sequence(0, size({k}) - 1), i -> {k}[i] = {a}[0] AND array_contains(slice({k}, i + 2, 2), {a}[1]))"
        near = f"CASE WHEN size({a}) = 2 THEN {pair} ELSE {near} END"
    return (
        f"{fact} <> '' AND {text} <> '' AND (contains({text}, {fact}) OR "
        f"CASE WHEN size({a}) > 0 AND size({k}) > 0 THEN {near} ELSE false END)"
    )
