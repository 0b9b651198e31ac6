"""Text cut off by field limits or mid-transfer.

Method: per source, the texts of each length that end incompletely, as a share of those at least that long, are the
discrete hazard of being cut there; window functions give it. It is tested twice, with false-discovery control
(Benjamini-Hochberg within the source):

* against the hazards of the neighbouring lengths: a length that stands out is a *limit*;
* over bands of lengths (of 1, 2, 4, ... characters, up to all of them) against the hazard that the source's own natural
  ends would give, which is the share of lines inside its texts that end without a mark: a band that exceeds it is one of
  texts cut in *transfer*, at no length in particular.

Incomplete endings are flagged at significant lengths of either kind, and nowhere else: a source that writes without
sentence marks inside its texts as well is not cut wherever its texts end so. Sources of fewer than ``LEAST_ROWS`` texts
are tested as one.

An ending is incomplete unless prose ends with a sentence mark, or one followed by closing quotes or brackets; an
ellipsis closes nothing. An item of a list needs no mark: it is whole if its last words end sentences or items inside
other texts (counts over the whole corpus); at a limit its last three words must, elsewhere two are enough.

Defined cases: null, blank, punctuation-only and placeholder texts have no content and are not cut; rows written twice
give one row; a null source is one of the small ones; an empty table gives an empty result. All of it is built-in
functions; what is shuffled are counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.session import materialize

#: Words that stand for no answer (fixed values), alone or in brackets.
_PLACEHOLDER = (
    r"(?i)^[^\p{L}\p{N}]*(n\s*/\s*a|na|none|null|nil|nan|empty|blank|missing|undefined|unknown|todo|tbd|placeholder|"
    r"(no|without)\s+(content|summary|answer|response|output|text|data)|"
    r"(content|summary|answer|response|output)\s+(missing|empty|unavailable|not available)|not\s+available|"
    r"leer|kein(e)?\s+inhalt|vide|aucun\s+contenu|vac[ií]o|sin\s+contenido|vazio|sem\s+conte[uú]do)[^\p{L}\p{N}]*$"
)
#: White space and invisible characters at a text's edges, closing quotes and brackets, and sentence marks (fixed values).
_SPACE = " \t\n\r\f\v\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_CLOSING = "\"'”’»›)]}」』）】"
_MARKS = [".", "!", "?", "。", "！", "？", "؟"]
_ITEM = r"^\s*([-*•–—‣▪◦·]|\d+[.)])\s+\S"
_BULLET = r"^\s*([-*•–—‣▪◦·]|\d+[.)])\s+"
#: Sources of fewer texts are tested together.
LEAST_ROWS = 200
#: Share of natural ends without a mark before any line is seen, and how many lines that guess counts for.
HABIT, HABIT_LINES = 0.005, 20
#: Bands are at most 2 ** LEVELS characters wide; the widest is taken for all lengths.
LEVELS = 24
FDR = 0.05


def has_content(text: Column) -> Column:
    """False for null, blank and punctuation-only texts and for placeholders."""
    t = F.coalesce(text, F.lit(""))
    return t.rlike(r"[\p{L}\p{N}]") & ~t.rlike(_PLACEHOLDER)


def trimmed(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit("")), F.lit(_SPACE))


def last_line(text: Column) -> Column:
    return F.trim(F.substring_index(text, "\n", -1), F.lit(_SPACE))


def _plain(text: Column) -> Column:
    """Lower case, every digit as 0, quotes, brackets and commas left out, ends of sentences and lines as \\u0001."""
    drop = "\"“”„«»()[]{},;:*"
    mapped = F.translate(text, "123456789!?。！？\n" + drop, "000000000...." + "." + "\u0001")
    return F.lower(mapped)


def _tail(line: Column, words: int) -> Column:
    return F.substring_index(F.trim(line, F.lit(" .")), " ", -words)


def sentence_ends(texts: DataFrame, text: str = "t") -> DataFrame:
    """(w, n): how many sentences or items inside texts end with the words ``w``, the last two or the last three.

    The last sentence of a text says nothing about where sentences end, so it isn't counted. One pass over whole texts
    with string functions; only counts are shuffled.
    """
    parts = F.split(_plain(F.col(text)), "\u0001+|[.] +")
    inside = texts.select(F.explode(F.slice(parts, F.lit(1), F.size(parts) - 1)).alias("s")).where("length(s) > 2")
    tails = inside.select(F.explode(F.array(_tail(F.col("s"), 2), _tail(F.col("s"), 3))).alias("w"))
    return tails.groupBy("w").agg(F.count("*").alias("n"))


def _tail_chance(n: Column, expected: Column) -> Column:
    """At most the chance of ``n`` or more events where ``expected`` are: exact up to two, then Chernoff's bound."""
    bound = F.exp(-(n * F.log(n / expected) - n + expected))
    return (
        F.when(n == 1, 1 - F.exp(-expected))
        .when(n == 2, 1 - F.exp(-expected) * (1 + expected))
        .when(n > expected, bound)
        .otherwise(F.lit(1.0))
    )


def _discoveries(tested: DataFrame, source: str, order: list[str], tests: Column, fdr: float) -> DataFrame:
    """Rows whose chance ``p`` passes Benjamini and Hochberg's step-up rule among a source's ``tests``."""
    ranked = tested.withColumn("i", F.row_number().over(Window.partitionBy(source).orderBy("p", *order))).withColumn("m", tests)
    passed = ranked.withColumn("pass", F.when(F.col("p") <= F.lit(fdr) * F.col("i") / F.col("m"), F.col("i")))
    return passed.withColumn("last", F.max("pass").over(Window.partitionBy(source))).where(F.col("i") <= F.col("last")).drop("i", "m", "pass", "last")


def length_limits(counts: DataFrame, source: str = "source", span: int = 20, fdr: float = 1e-3, least: int = 5) -> DataFrame:
    """(source, len, n, at_risk, hazard, neighbours) of the lengths at which texts end incompletely significantly often.

    ``counts``: (source, len, all, n), how many texts have the length and how many of them end incompletely. Where no text
    of a source is longer than some length, hazards near that length are high, so it is a limit too.
    """
    by = Window.partitionBy(source).orderBy("len")
    near = by.rangeBetween(-span, span)
    risk = counts.withColumn("at_risk", F.sum("all").over(by.rowsBetween(0, Window.unboundedFollowing)))
    around = risk.select(
        source,
        "len",
        "n",
        "at_risk",
        (F.col("n") / F.col("at_risk")).alias("hazard"),
        # Lengths that no text has are at risk as well: the next longer ones stand for them.
        ((F.sum("n").over(near) - F.col("n") + 0.5) / (F.lit(2 * span) * F.avg("at_risk").over(near) + 1.0)).alias("neighbours"),
    )
    tested = around.withColumn("p", _tail_chance(F.col("n"), F.col("at_risk") * F.col("neighbours")))
    longest = F.max("len").over(Window.partitionBy(source))
    return _discoveries(tested, source, ["len"], longest, fdr).where(F.col("n") >= least).drop("p")


def transfer_bands(counts: DataFrame, habits: DataFrame, source: str = "source", fdr: float = FDR) -> DataFrame:
    """(source, level, band, all, n, expected): bands of 2 ** level lengths in which texts end incompletely significantly
    more often than by the source's habit.

    ``habits``: (source, habit), the share of natural ends without a mark. A length lies in one band of each level.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))
    each = counts.select(source, "len", "all", "n", levels.alias("level"))
    last = F.col("level") == LEVELS
    banded = (
        each.groupBy(source, "level", F.when(last, F.lit(0)).otherwise(F.expr("shiftright(len, level)")).alias("band"))
        .agg(F.sum("all").alias("all"), F.sum("n").alias("n"))
        .join(habits, source)
        .withColumn("expected", F.col("all") * F.col("habit"))
    )
    tested = banded.withColumn("p", _tail_chance(F.col("n"), F.col("expected")))
    tests = F.count("*").over(Window.partitionBy(source))
    return _discoveries(tested, source, ["level", "band"], tests, fdr).where("n > 0").select(source, "level", "band", "all", "n", "expected")


def endings(df: DataFrame, keys: list[str], text: str, source: str) -> DataFrame:
    """keys, source, len, ending (``whole``, ``cut`` or, for a list item without a mark, ``item``), two, three, lines,
    unmarked.

    Rows without content are left out. two and three are the last words of an item without a mark; lines are those of
    prose inside the text, unmarked how many of them end without a sentence mark.
    """
    t = df.where(has_content(F.col(text))).select(*keys, F.col(source).alias("source"), trimmed(F.col(text)).alias("t"))
    core = t.select(*keys, "source", "t", F.rtrim("t", F.lit(_SPACE + _CLOSING)).alias("core"))
    ellipsis = F.col("core").endswith("…") | F.col("core").endswith("..") | F.col("core").endswith(". .")
    last = last_line(F.col("t"))
    ending = (
        F.when(ellipsis | F.col("t").endswith("\ufffd"), "cut")
        .when(F.right("core", F.lit(1)).isin(_MARKS), "whole")
        .when(last.rlike(_ITEM), "item")
        .otherwise("cut")
    )
    line = F.when(F.col("ending") == "item", _plain(F.regexp_replace(last, _BULLET, "")))
    parts = F.split("t", "\n")
    inner = F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: (F.length(x) > 20) & ~x.rlike(_ITEM))
    closed = lambda x: F.right(F.rtrim(x, F.lit(_SPACE + _CLOSING)), F.lit(1)).isin(_MARKS + [":"])
    return (
        core.select(*keys, "source", "t", ending.alias("ending"), F.when(F.contains("t", F.lit("\n")), inner).alias("inner"))
        .select(
            *keys,
            "source",
            F.length("t").alias("len"),
            "ending",
            _tail(line, 2).alias("two"),
            _tail(line, 3).alias("three"),
            F.coalesce(F.size("inner"), F.lit(0)).alias("lines"),
            F.coalesce(F.size(F.filter("inner", lambda x: ~closed(x))), F.lit(0)).alias("unmarked"),
        )
    )


def judged_endings(df: DataFrame, keys: list[str], text: str, source: str) -> DataFrame:
    """keys, source, pool, len, incomplete, strictly, lines, unmarked of every text with content, rows written twice once.

    incomplete: the ending is, wherever it stands; strictly: it is at a limit. pool: the source as it is tested.
    """
    rows = materialize(endings(df, keys, text, source).dropDuplicates(keys), "endings")
    texts = df.where(F.col(text).isNotNull()).select(trimmed(F.col(text)).alias("t"))
    wanted = materialize(rows.where("ending = 'item'").select(F.explode(F.array("two", "three")).alias("w")).distinct(), "wanted")
    known = materialize(sentence_ends(texts).join(wanted, "w", "left_semi").select("w"), "ends")
    items = (
        rows.where("ending = 'item'")
        .join(known.select(F.col("w").alias("three"), F.lit(True).alias("has_three")), "three", "left")
        .join(known.select(F.col("w").alias("two"), F.lit(True).alias("has_two")), "two", "left")
    )
    here = [*keys, "source", "len", "lines", "unmarked"]
    both = items.select(*here, F.col("has_two").isNull().alias("incomplete"), F.col("has_three").isNull().alias("strictly")).unionByName(
        rows.where("ending <> 'item'").select(*here, (F.col("ending") == "cut").alias("incomplete"), (F.col("ending") == "cut").alias("strictly"))
    )
    large = rows.groupBy("source").agg(F.count("*").alias("all")).where(F.col("all") >= LEAST_ROWS)
    pools = large.where("source IS NOT NULL").select("source", F.col("source").alias("pool"))
    return both.join(pools, "source", "left").withColumn("pool", F.coalesce("pool", F.lit("")))


def significant_lengths(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(limits, bands) of judged endings, each by pool: see ``length_limits`` and ``transfer_bands``."""
    counts = judged.groupBy("pool", "len").agg(
        F.count("*").alias("all"), F.count_if("incomplete").alias("n"), F.count_if("strictly").alias("strict"), F.sum("lines").alias("lines"), F.sum("unmarked").alias("unmarked")
    )
    counts = materialize(counts, "lengths")
    habits = counts.groupBy("pool").agg(
        ((F.sum("unmarked") + F.lit(HABIT * HABIT_LINES)) / (F.sum("lines") + F.lit(HABIT_LINES))).alias("habit")
    )
    limits = length_limits(counts.select("pool", "len", "all", F.col("strict").alias("n")), "pool")
    return materialize(limits, "limits"), materialize(transfer_bands(counts, habits, "pool"), "bands")


def cut_texts(df: DataFrame, keys: list[str], text: str, source: str) -> DataFrame:
    """keys, source, length, at_limit of every text with content that stops inside a word or a sentence."""
    judged = materialize(judged_endings(df, keys, text, source), "judged")
    limits, bands = significant_lengths(judged)
    found = judged.where("incomplete OR strictly")
    # The significant lengths among those that occur, so that rows meet them by equality.
    lengths = found.select("pool", "len").distinct()
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level")
    placed = lengths.select("pool", "len", level).withColumn(
        "band", F.when(F.col("level") == LEVELS, F.lit(0)).otherwise(F.expr("shiftright(len, level)"))
    )
    in_band = placed.join(bands, ["pool", "level", "band"], "left_semi").select("pool", "len").distinct().withColumn("in_band", F.lit(True))
    at_limit = limits.select("pool", "len", F.lit(True).alias("at_limit"))
    told = found.join(at_limit, ["pool", "len"], "left").join(in_band, ["pool", "len"], "left")
    return told.where(F.when(F.col("at_limit"), F.col("strictly")).otherwise(F.col("in_band") & F.col("incomplete"))).select(
        *keys, "source", F.col("len").alias("length"), F.coalesce("at_limit", F.lit(False)).alias("at_limit")
    )


def length_report(df: DataFrame, keys: list[str], text: str, source: str) -> DataFrame:
    """(source, kind, low, high, texts, cut): every significant length (``limit``) and band of lengths (``transfer``).

    low to high are the lengths, both included; high is null where there is no upper end.
    """
    limits, bands = significant_lengths(materialize(judged_endings(df, keys, text, source), "judged"))
    all_of = F.col("level") == LEVELS
    low = F.expr("shiftleft(band, level)")
    return limits.select(
        F.col("pool").alias("source"), F.lit("limit").alias("kind"), F.col("len").alias("low"), F.col("len").alias("high"), F.col("at_risk").alias("texts"), F.col("n").alias("cut")
    ).unionByName(
        bands.select(
            F.col("pool").alias("source"),
            F.lit("transfer").alias("kind"),
            F.when(all_of, F.lit(0)).otherwise(low).alias("low"),
            F.when(~all_of, low + F.expr("shiftleft(1, level)") - 1).alias("high"),
            F.col("all").alias("texts"),
            F.col("n").alias("cut"),
        )
    )


def cut_rates(df: DataFrame, keys: list[str], text: str, source: str, by: list[str]) -> DataFrame:
    """by, rows, cut: how many rows of each source are cut; rows written twice count once."""
    cut = cut_texts(df, keys, text, source).select(*keys, F.lit(1).alias("is_cut"))
    rows = df.select(*{*keys, *by}).distinct()
    return rows.join(cut, keys, "left").groupBy(*by).agg(F.count("*").alias("rows"), F.count("is_cut").alias("cut"))
