"""Broken prompt and response pairs.

Method: the opening sentences of the responses are grouped where equal, then clustered by MinHash over runs of five
words, each link verified (Jaccard of at least 0.8 of those runs), and joined to components by hash-to-min. A template
reveals refusals if it recurs across unrelated prompts and nearly all responses that open so are *ungrounded*: of the
words that are rare in the corpus they hold hardly any that their own question has, though they are in its language. A
summary can't recur so, whatever its wording, and a common remark recurs in grounded summaries as well. What chance
allows is judged by the share of ungrounded responses in the corpus. The wording of revealed refusals (runs of three
words) then tells other ungrounded responses made of the same phrases. A lexicon of declining phrases decides only
ungrounded responses that neither reached, such as those of a corpus too small for templates to recur in;
``refusals`` says by which evidence each row came. Termination checks (the ending rules of ``truncation``), a copy check
and a language check label the rest.

A pair has at most one defect, the first of: empty, refusal, truncated, copy, other_language. Copies are measured by
the share of the response's words in runs of six words that its question has as well, languages by function words and
scripts over the whole response and the whole question; a response without the function words that its question's
language can't do without is in another language too, whichever that is.

Questions are joined to responses by step, so a chain with a third of all rows is spread over its steps, and adaptive
execution splits what is still skewed; nothing is gathered per chain. Each text is read once, in one pass that gives
the hashes of its openings and what it has in common with its question; only hashes and counts are aggregated. The
rarity of words is two tables of ``BUCKETS`` counts over all responses and all chains.

Defined cases: a null or blank response is ``empty``, and so are punctuation and placeholders; a pair without a
question is neither copy nor other_language, and a refusal only by templates that others revealed or by the lexicon;
rows written twice give one row; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.components import hash_to_min, union_all
from threadloom.llm.truncation import cut_texts, has_content, trimmed
from threadloom.llm.words import KEPT, counts, words
from threadloom.session import materialize

#: A response is ungrounded if less than this share of its words, weighed by their rarity, stands in its question.
GROUNDED = 0.3
#: The lexicon is also asked about responses of an opening only that are less grounded than this.
DOUBTFUL = 0.5
#: Share of a template's responses that are ungrounded, and prompts it recurs across, at least.
UNGROUNDED_SHARE, PROMPTS = 0.75, 3
#: Natural logarithm of the chance below which "nearly always ungrounded" isn't taken for chance.
CHANCE = 14.0
#: Openings are this many sentences of a response, of at least so many characters each.
OPENING, LEAST_CHARS = 3, 8
#: Share of the three-word runs of an opening that revealed refusals know.
PHRASES = 0.5
ROWS, BANDS, SHINGLE, SIMILARITY = 4, 12, 5, 0.8
#: Sentences of a band that are compared in one piece; of a larger band two such parts at a time.
PART = 500
COPY_RUN, COPY_SHARE = 6, 0.8
BUCKETS = 1 << 18
DEFECTS = ("empty", "refusal", "truncated", "copy", "other_language")

#: Phrases that decline a task (fixed values), matched in lower case with straight apostrophes.
_TASK = (
    r"(summar\w*|condens\w*|produc\w*|continue|assist|help|write about|go through|complete|fulfil\w*|compl\w*|provide|"
    r"proceed|answer|generate|process|discuss|engage|share|respond|work on|do that|do this|this (task|request|conversation))"
)
DECLINE = re.compile(
    "|".join(
        [
            r"\bi('m| am)( \w+)? (unable|not able|not permitted|not allowed|not in a position|not comfortable|prevented|forbidden)\b",
            r"\bi (cannot|can't|can not|won't|will not|must not|may not|shouldn't|should not)( \w+)? " + _TASK,
            r"\bi won't be able\b",
            r"\bi('d| would) (rather|prefer) not\b",
            r"\bi (have to|must|need to|will|respectfully)( \w+)? (decline|refuse|pass on)\b",
            r"\bi (decline|refuse)\b",
            r"\b(isn't|is not|it's not|not) possible for me\b",
            r"\bnot (something|a request|a task) (that )?i('m| am| can)\b",
            r"\bsomething i (cannot|can't|won't)\b",
            r"\bmy (instructions|guidelines|rules|policies|policy)\b.*\b(not allow|don't allow|prevent|forbid|prohibit|not permit)",
            r"\b(against|violates?|outside) (my|the) (guidelines|instructions|rules|polic\w+|scope)",
            r"\bnot be (appropriate|right|proper|fitting) (for me|of me|to)\b",
            r"\bno (summary|account|answer|response) (can|will) be (provided|given|produced|made|written)",
            r"\b(request|task)\b.*\b(declined|refused|rejected|denied)\b",
            r"\bas an? (ai|language model|assistant)\b.*\b(cannot|can't|unable|not able)",
            r"\b(dabei|damit|das|diese\w*|hierbei) kann ich( \w+)? (leider )?nicht\b",
            r"\bkann ich( \w+){0,3} nicht (zusammenfassen|helfen|erledigen|beantworten|weitermachen)",
            r"\bich (kann|darf|möchte|werde)( \w+){0,4} nicht( \w+)? (zusammenfassen|helfen|erledigen|beantworten|bearbeiten|weiter\w*|schreiben)",
            r"\bich muss( \w+){0,3} ablehnen\b",
            r"\bje (ne peux|ne suis|ne pourrai|ne vais|refuse|dois refuser|dois décliner)( pas)?\b.*\b(résumer|aider|continuer|traiter|rédiger|conversation|demande|tâche|mesure)",
            r"\bno (puedo|podré|voy a|me es posible|me está permitido)\b.*\b(resumir|ayudar|continuar|hacer|escribir|conversación|solicitud|tarea|petición)",
            r"\bnão (posso|poderei|vou|me é possível|consigo)\b.*\b(resumir|ajudar|continuar|fazer|escrever|conversa|pedido|tarefa)",
            r"\bnon posso\b.*\b(riassumere|aiutare|continuare)",
            r"не (могу|буду)\b.*(помо|резюм|обобщ|выполн|продолж|кратк)",
            r"δεν μπορώ\b.*(συνοψ|βοηθ|συνεχ|περίληψη)",
            r"(要約|お手伝い|対応|お答え|続行)[^。]*(できません|できかねます|いたしかねます)",
        ]
    )
)


def declines(text: str) -> bool:
    """Whether a text declines its task, by the lexicon."""
    return bool(DECLINE.search(text.lower().replace("’", "'").replace("‘", "'")))


# --- templates -----------------------------------------------------------------------------------------------------

_SENTENCES = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n+")
_NO_WORD = re.compile(r"(?:[^\w']|_)+")


def openings(response: str) -> tuple[list[str], int, str]:
    """The first sentences of a response, lower case, without marks; how many sentences of some length it has; and the
    opening as it is."""
    parts = _SENTENCES.split(response.replace("’", "'").replace("‘", "'"))
    first, n = [], 0
    for i, part in enumerate(parts):
        if len(part) >= LEAST_CHARS:
            n += 1
            if i < OPENING:
                first.append(_NO_WORD.sub(" ", part.lower()).strip())
    return [x for x in first if len(x) >= LEAST_CHARS], n, " ".join(parts[:OPENING])


def shingles(sentence: str) -> frozenset:
    """The runs of words of a sentence; a shorter one is one run."""
    ws = sentence.split(" ")
    return frozenset(" ".join(ws[i : i + SHINGLE]) for i in range(max(1, len(ws) - SHINGLE + 1)))


def alike(p: frozenset, q: frozenset) -> bool:
    """Whether the Jaccard similarity of two sets of runs is ``SIMILARITY`` at least; sizes too unlike tell at once."""
    n, m = len(p), len(q)
    if min(n, m) < SIMILARITY * max(n, m):
        return False
    both = len(p & q)
    return both >= SIMILARITY * (n + m - both)


def _signature(sentence: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, frozenset]:
    runs = shingles(sentence)
    h = np.array([xxhash.xxh32_intdigest(r) for r in runs], dtype=np.uint64)
    return ((h[:, None] * a[None, :] + b[None, :]) % np.uint64((1 << 61) - 1)).min(axis=0), runs


def linked(sentences: list[str]) -> list[tuple[str, str]]:
    """Links (a, b), a < b, that join all of the sentences between which a chain of pairs alike by ``SIMILARITY`` leads.

    A sentence is held against each group found so far until one of its members is alike, so no pair that meets the
    threshold is left out but those of one group, and many variants of one template cost about one comparison each.
    """
    groups: list[list[tuple[str, frozenset]]] = []
    links = []
    for s in sentences:
        runs = shingles(s)
        joined, apart = [(s, runs)], []
        for group in groups:
            other = next((x for x, q in group if alike(runs, q)), None)
            if other is None:
                apart.append(group)
            else:
                links.append((min(s, other), max(s, other)))
                joined = group + joined if len(group) > len(joined) else joined + group
        groups = [*apart, joined]
    return links


def template_clusters(sentences: DataFrame) -> DataFrame:
    """(sentence, root): components of distinct sentences linked by verified MinHash; a sentence alone is its own root.

    All sentences of a band are compared with one another. A band of more than ``PART`` of them is cut into parts, and
    each pair of parts is compared by itself, so a bucket with a third of all sentences is never gathered in one task.
    """

    def bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(11)
        a = rng.integers(1, 1 << 29, ROWS * BANDS, dtype=np.uint64)
        b = rng.integers(0, 1 << 60, ROWS * BANDS, dtype=np.uint64)
        for batch in batches:
            out = []
            for s in batch["sentence"]:
                mins, _ = _signature(s, a, b)
                for k in range(BANDS):
                    band = mins[k * ROWS : (k + 1) * ROWS].tobytes()
                    out.append((s, xxhash.xxh64_intdigest(bytes([k]) + band) - (1 << 63)))
            yield pd.DataFrame(out, columns=["sentence", "band"])

    banded = materialize(sentences.select("sentence").mapInPandas(bands, "sentence string, band long"), "bands")
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("sentence").alias("a"), F.max("sentence").alias("z"))
    shared = shared.where("a < z").select("band", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    placed = banded.join(shared, "band").withColumn("part", F.expr("int(pmod(xxhash64(sentence), parts))"))
    # A sentence goes to each pair of parts that its own belongs to: (part, other) or (other, part).
    cells = placed.select(
        "band", "sentence", F.explode(F.expr("transform(sequence(0, parts - 1), i -> struct(least(i, part) AS i, greatest(i, part) AS j))")).alias("cell")
    ).select("band", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "sentence")
    cells = cells.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "sentence")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []
        for batch in batches:
            found = []
            for *key, s in zip(batch["band"], batch["i"], batch["j"], batch["sentence"]):
                if key != cell:
                    found += linked(held)
                    cell, held = key, []
                if not held or held[-1] != s:
                    held.append(s)
            yield pd.DataFrame(found, columns=["a", "b"])
        yield pd.DataFrame(linked(held), columns=["a", "b"])

    edges = cells.mapInPandas(compare, "a string, b string").distinct()
    groups = hash_to_min(materialize(edges, "edges"))
    return sentences.select("sentence").join(groups.select(F.col("member").alias("sentence"), "root"), "sentence", "left").select(
        "sentence", F.coalesce("root", "sentence").alias("root")
    )


def refusal_templates(looked: DataFrame) -> DataFrame:
    """(h, sentence, root): openings of templates that recur across prompts in ungrounded responses only.

    Chance is judged by the number of prompts, so rows written twice or a chain asked over and over count for nothing.
    An opening is counted over all responses, by hash; only ungrounded ones are spelt out and clustered.
    """
    base = F.broadcast(
        looked.agg(F.least(F.greatest(F.avg(F.col("bare").cast("double")), F.lit(0.02)), F.lit(0.98)).alias("p"))
    )  # one row
    opened = looked.select("row", "prompt", "bare", F.explode("opened").alias("h"))
    counted = opened.groupBy("h").agg(F.count("*").alias("n"), F.count_if("bare").alias("n_bare"))
    bare = looked.where("bare").select("prompt", F.explode(F.arrays_zip("opened", "sentences")).alias("o")).select(
        "prompt", F.col("o.opened").alias("h"), F.col("o.sentences").alias("sentence")
    )
    spelt = bare.groupBy("h").agg(F.first("sentence").alias("sentence"))
    mostly = materialize(
        spelt.join(counted.where(F.col("n_bare") >= F.lit(UNGROUNDED_SHARE) * F.col("n")), "h"), "openings"
    )
    clusters = materialize(template_clusters(mostly.select("sentence")).join(mostly, "sentence"), "clusters")
    prompts = bare.join(clusters.select("h", "root"), "h").groupBy("root").agg(F.approx_count_distinct("prompt").alias("prompts"))
    whole = prompts.crossJoin(base).where((F.col("prompts") >= PROMPTS) & (-F.log("p") * F.col("prompts") > CHANCE))
    return clusters.join(whole.select("root"), "root", "left_semi").select("h", "sentence", "root")


def _runs(sentence: str) -> Column:
    """Hashes of the runs of three words of a sentence; none for shorter ones."""
    return F.expr(
        f"transform(sequence(0, size(split({sentence}, ' ')) - 3, 1), i -> xxhash64(slice(split({sentence}, ' '), i + 1, 3)))"
    )


def refusals(looked: DataFrame) -> DataFrame:
    """(row, evidence): responses that decline, and whether a template, phrases of such or the lexicon told so."""
    templates = materialize(refusal_templates(looked).select("h").distinct(), "templates")
    opened = looked.select("row", "prompt", "bare", "n_sentences", F.explode("opened").alias("h"))
    # A response that isn't ungrounded is a refusal if it has no other sentence than templates.
    by_template = materialize(
        opened.join(templates, "h", "left_semi")
        .groupBy("row", "prompt", "bare", "n_sentences")
        .agg(F.countDistinct("h").alias("found"))
        .where(F.col("bare") | (F.col("found") >= F.col("n_sentences")))
        .select("row", "prompt"),
        "revealed",
    )
    sentences = materialize(
        looked.where("bare").select("row", "prompt", F.explode("sentences").alias("s")).where("size(split(s, ' ')) >= 3"), "bare"
    )
    runs = sentences.select("row", "prompt", F.xxhash64("s").alias("h"), F.explode(_runs("s")).alias("run"))
    known = (
        runs.join(by_template.select("row"), "row", "left_semi")
        .groupBy("run")
        .agg(F.approx_count_distinct("prompt").alias("prompts"))
        .where("prompts >= 2")
        .select("run", F.lit(1.0).alias("known"))
    )
    by_phrase = (
        runs.join(by_template.select("row"), "row", "left_anti")
        .join(known, "run", "left")
        .groupBy("row", "h")
        .agg(F.avg(F.coalesce("known", F.lit(0.0))).alias("share"))
        .where(F.col("share") >= PHRASES)
        .select("row")
        .distinct()
    )
    lexicon = looked.where("says").select("row")
    told = (
        by_template.select("row", F.lit(1).alias("e"))
        .unionByName(by_phrase.select("row", F.lit(2).alias("e")))
        .unionByName(lexicon.select("row", F.lit(3).alias("e")))
    )
    names = F.array(F.lit("template"), F.lit("phrase"), F.lit("lexicon"))
    return told.groupBy("row").agg(F.min("e").alias("e")).select("row", F.get(names, F.col("e") - 1).alias("evidence"))


# --- copies and languages -------------------------------------------------------------------------------------------

#: Function words of each language (fixed values), folded; none belongs to two lists.
FUNCTION_WORDS = {
    "en": "the and was were is with that this they their of to for from but not have had has which who while because at on it are will would be",
    "de": "der die das und ist nicht ein eine einen dem den mit auf fur zu von sich auch wie noch wir ich aber sie im bei nach wurde haben hat sein uber schon dass sind",
    "fr": "le les des et est une pour dans qui pas sur avec nous vous il elle au aux du ce cette ont mais plus son sa ses je etait ete avant encore deja",
    "es": "el los las y es una por con para del al lo pero su sus ya muy nos fue hay ser estaba tiene como mas todavia sobre aunque sigue hasta",
    "pt": "o os as e um uma com nao do da dos das em no na nos ao ele ela mas foi ser tem ainda ja muito pelo pela aos sua seu nossa porque ficou",
    "it": "il gli di che non sono per con una della del nel alla anche questo piu ma ha hanno era lo",
    "nl": "het een van en niet dat met zijn voor maar ook naar bij nog wordt heeft aan ik wij",
}
_LANGUAGE_OF: dict[str, list[str]] = {}
for _language, _list in FUNCTION_WORDS.items():
    for _word in _list.split():
        _LANGUAGE_OF.setdefault(_word, []).append(_language)
_SCRIPTS = {
    "ja": re.compile("[぀-ヿ一-鿿]"),
    "ru": re.compile("[Ѐ-ӿ]"),
    "el": re.compile("[Ͱ-Ͽἀ-῿]"),
    "ko": re.compile("[가-힯]"),
    "ar": re.compile("[؀-ۿ]"),
    "he": re.compile("[֐-׿]"),
    "th": re.compile("[฀-๿]"),
    "hi": re.compile("[ऀ-ॿ]"),
}


_OTHER_SCRIPT = re.compile("[" + "".join(p.pattern[1:-1] for p in _SCRIPTS.values()) + "]")


def language_votes(text: str, ws: Counter[str]) -> dict[str, float]:
    """Votes for each language: function words in Latin script, one in about two words for any other script."""
    votes: dict[str, float] = {}
    for w in _LANGUAGE_OF.keys() & ws.keys():
        languages = _LANGUAGE_OF[w]
        for language in languages:
            votes[language] = votes.get(language, 0.0) + ws[w] / len(languages)
    if not text.isascii() and _OTHER_SCRIPT.search(text):
        for language, script in _SCRIPTS.items():
            n = len(script.findall(text))
            if n:
                votes[language] = votes.get(language, 0.0) + n / (4.0 if language in ("ja", "ko", "th") else 10.0)
    return votes


def language(votes: dict[str, float], least: float = 2.0) -> str | None:
    """The language with most votes, if it has enough of them."""
    if not votes:
        return None
    best = max(votes, key=lambda k: (votes[k], k))
    return best if votes[best] >= least else None


def copied_share(answer: list[str], question: list[str], run: int = COPY_RUN) -> float:
    """Share of the answer's words in runs of ``run`` words that the question has too; shorter answers are one run."""
    n = min(run, len(answer))
    if n == 0 or len(question) < n:
        return 0.0
    known = {tuple(question[i : i + n]) for i in range(len(question) - n + 1)}
    covered, until = 0, 0
    for i in range(len(answer) - n + 1):
        if tuple(answer[i : i + n]) in known:
            covered += i + n - max(i, until)
            until = i + n
    return covered / len(answer)


#: Words without spaces between them are compared by pairs of characters.
_UNSPACED = re.compile("[぀-ヿ一-鿿가-힯฀-๿]")


def units(text: str, ws: Iterable[str]) -> set[str]:
    """What a text is compared by: its distinct words, or pairs of characters where words aren't spaced."""
    found = set(ws)
    if not text.isascii() and _UNSPACED.search(text):
        for w in list(found):
            if len(w) > 2 and _UNSPACED.search(w):
                found.discard(w)
                found.update(w[i : i + 2] for i in range(len(w) - 1))
    return found


def _bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word) % BUCKETS


def holders(texts: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """How many texts hold the words of each bucket, and how many there are: one pass, a fixed number of counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, held = np.zeros(BUCKETS, dtype=np.int64), 0, Counter()

        def settle() -> None:
            np.add.at(total, [_bucket(w) for w in held], list(held.values()))
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for t in batch.column(0).slice(at, 256).to_pylist():
                    rows += 1
                    held.update(units(t, counts(t)))
                if len(held) > KEPT:
                    settle()
        if held:
            settle()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(total[some], rows))], names=["bucket", "n"]
        )

    got = (
        texts.where(F.col(text).isNotNull())
        .select(text)
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    out = np.zeros(BUCKETS + 1)
    out[got["bucket"].to_numpy(dtype=int)] = got["n"].to_numpy(dtype=float)
    return out[:-1], int(out[-1])


class Weights(dict):
    """The weight of each word, by its bucket; words are kept up to a fixed number."""

    def __init__(self, of_bucket: list[float]):
        self.of_bucket = of_bucket

    def __missing__(self, word: str) -> float:
        if len(self) >= KEPT:
            self.clear()
        self[word] = found = self.of_bucket[_bucket(word)]
        return found


def rarity(responses: DataFrame, chains: DataFrame) -> np.ndarray:
    """What a word of each bucket weighs: the logarithm of its share of the responses or of the chains, the greater."""
    talk = "array_join(transform(messages, m -> concat(coalesce(m.peer, ''), ' ', coalesce(m.text, ''))), ' ')"
    known = chains.where("id IS NOT NULL AND size(messages) > 0").groupBy("id").agg(F.first("messages").alias("messages"))
    parts = [holders(responses, "response"), holders(known.select(F.expr(talk).alias("talk")), "talk")]
    share = np.max([(n + 1) / (rows + 2) for n, rows in parts], axis=0)
    return -np.log(np.minimum(share, 1.0)).astype(np.float32)


#: A text of so many different words has some function words of its language, this share of them at least.
ENOUGH_WORDS, FUNCTION_SHARE = 12, 0.03


def differs(response: str, answer: Counter[str], asked: str, said: Counter[str], grounded: float) -> bool:
    """Whether a response is in another language than what was said."""
    mine, theirs = language_votes(response, answer), language_votes(asked, said)
    own, other = language(mine), language(theirs)
    if own and other:
        return own != other and mine[own] > mine.get(other, 0.0)
    # One of the two is in a language without a list: it lacks the function words of the other's.
    if grounded >= GROUNDED or min(len(answer), len(said)) < ENOUGH_WORDS:
        return False
    n, m = answer.total(), said.total()
    if other and not own:
        return mine.get(other, 0.0) < FUNCTION_SHARE * n < theirs[other] * n / m
    return bool(own) and theirs.get(own, 0.0) < FUNCTION_SHARE * m < mine[own] * m / n


LOOKED = (
    "row string, prompt string, defect string, bare boolean, says boolean, n_sentences int, opened array<long>, sentences array<string>"
)


def look(pairs: DataFrame, weights: np.ndarray) -> DataFrame:
    """What one reading tells of each pair (row, prompt, response, previous, talk).

    defect is ``copy``, ``other_language`` or null; bare: ungrounded, in the language of its question; says: not
    well grounded, and declining by the lexicon; opened and sentences: its openings hashed and, if bare, spelt out.
    The question is the previous summary and the talk; the talk (without one, the previous summary) tells the language.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(weights)  # 1 MB
    names = [x.split(" ")[0] for x in LOOKED.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(shared.value.tolist())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # few texts are Python objects at a time
                some = batch.slice(at, 256).to_pydict()
                out = []
                for row, prompt, response, previous, talk in zip(*(some[c] for c in ("row", "prompt", "response", "previous", "talk"))):
                    answer, held, said = counts(response), counts(previous), counts(talk)
                    known = held.keys() | said.keys()
                    defect, grounded = None, None
                    if known:
                        mine = units(response, answer)
                        there = [weights[w] for w in mine & units(f"{previous or ''} {talk or ''}", known)]
                        total = sum(map(weights.__getitem__, mine))
                        grounded = sum(there) / total if total > 0 else 1.0
                        n = answer.total()
                        if sum(answer[w] for w in answer.keys() & known) >= COPY_SHARE * n and (
                            copied_share(words(response), words(previous) + words(talk)) >= COPY_SHARE
                        ):
                            defect = "copy"
                        elif differs(response, answer, talk or previous or "", said or held, grounded):
                            defect = "other_language"
                    bare = grounded is not None and grounded < GROUNDED and defect is None
                    first, n_sentences, opening = openings(response)
                    doubtful = bare or grounded is None or (grounded < DOUBTFUL and n_sentences <= OPENING)
                    says = defect != "copy" and doubtful and declines(opening)
                    opened = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in first]
                    out.append((row, prompt, defect, bare, says, n_sentences, opened, first if bare else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return pairs.select("row", "prompt", "response", "previous", "talk").mapInArrow(read, LOOKED)


# --- the tables -----------------------------------------------------------------------------------------------------


def step_texts(chains: DataFrame, short: int = 20, long: int = 60) -> DataFrame:
    """(chain, kind, k, talk): the messages of every full block of 20 (short) and 60 (long), one row a step."""
    known = chains.where("id IS NOT NULL AND size(messages) > 0").select(F.col("id").alias("chain"), "messages").dropDuplicates(["chain"])
    top = "array_max(transform(messages, m -> coalesce(m.seq, 0)))"
    parts = []
    for kind, size in (("short", short), ("long", long)):
        steps = known.select(
            "chain", "messages", F.explode(F.expr(f"filter(sequence(0, greatest({top} div {size}, 0)), k -> k * {size} < {top})")).alias("k")
        )
        inside = f"filter(messages, m -> m.seq > k * {size} AND m.seq <= (k + 1) * {size})"
        parts.append(
            steps.select(
                "chain",
                F.lit(kind).alias("kind"),
                F.col("k").cast("int").alias("k"),
                F.expr(f"array_join(transform({inside}, m -> concat(coalesce(m.peer, ''), ': ', coalesce(m.text, ''))), '\\n')").alias("talk"),
            )
        )
    return parts[0].unionByName(parts[1])


def questions(chosen: DataFrame, dpo: DataFrame, chains: DataFrame) -> DataFrame:
    """(row, prompt, response, previous, talk) of the pairs of both tables that have content.

    prompt is the chain. The instruction of a dpo prompt is no part of what can be copied; one without tags is all talk.
    """
    asked = chosen.where(F.col("row_id").isNotNull() & has_content(F.col("summary"))).select(
        F.concat(F.lit("chosen:"), F.col("row_id")).alias("row"), "chain", "kind", "k", trimmed(F.col("summary")).alias("response"), F.col("previous_summary").alias("previous")
    )
    with_talk = asked.join(step_texts(chains), ["chain", "kind", "k"], "left").select("row", F.col("chain").alias("prompt"), "response", "previous", "talk")
    content = F.expr("array_join(transform(filter(prompt, m -> m IS NOT NULL AND coalesce(m.role, '') <> 'system'), m -> coalesce(m.content, '')), '\n')")
    own = dpo.where(F.col("row_id").isNotNull() & has_content(F.col("rejected"))).select(
        F.concat(F.lit("dpo:"), F.col("row_id")).alias("row"), "chain", trimmed(F.col("rejected")).alias("response"), content.alias("question")
    )
    inner = F.regexp_extract("question", r"(?s)<conversation>(.*)</conversation>", 1)
    own = own.select(
        "row",
        F.col("chain").alias("prompt"),
        "response",
        F.regexp_extract("question", r"(?s)<previous_summary>(.*)</previous_summary>", 1).alias("previous"),
        F.when(inner != "", inner).otherwise(F.col("question")).alias("talk"),
    )
    return with_talk.unionByName(own)


def looked_pairs(chosen: DataFrame, dpo: DataFrame, chains: DataFrame) -> DataFrame:
    """``look`` at every pair with content, once; rows written twice are one row."""
    texts = chosen.select(F.col("summary").alias("response")).unionByName(dpo.select(F.col("rejected").alias("response")))
    weights = rarity(texts.where(has_content(F.col("response"))), chains)
    return materialize(look(questions(chosen, dpo, chains), weights).dropDuplicates(["row"]), "looked")


def defective_pairs(chosen: DataFrame, dpo: DataFrame, chains: DataFrame) -> DataFrame:
    """(tab, row_id, defect) of every defective pair of both tables."""
    sources = chosen.select(
        F.concat(F.lit("chosen:"), F.col("row_id")).alias("row"), F.col("summary").alias("response"), F.col("teacher").alias("source")
    ).unionByName(dpo.select(F.concat(F.lit("dpo:"), F.col("row_id")).alias("row"), F.col("rejected").alias("response"), F.lit("dpo").alias("source")))
    sources = sources.where("row IS NOT NULL")
    looked = looked_pairs(chosen, dpo, chains)
    labels = [
        sources.where(~has_content(F.col("response"))).select("row", F.lit(0).alias("d")),
        refusals(looked).select("row", F.lit(1).alias("d")),
        cut_texts(sources, ["row"], "response", "source").select("row", F.lit(2).alias("d")),
        looked.where("defect = 'copy'").select("row", F.lit(3).alias("d")),
        looked.where("defect = 'other_language'").select("row", F.lit(4).alias("d")),
    ]
    first = union_all(labels).groupBy("row").agg(F.min("d").alias("d"))
    names = F.array(*[F.lit(x) for x in DEFECTS])
    return first.select(
        F.substring_index("row", ":", 1).alias("tab"),
        F.substring_index("row", ":", -1).cast("long").alias("row_id"),
        F.get(names, F.col("d")).alias("defect"),
    )


def defect_report(found: DataFrame) -> DataFrame:
    return found.groupBy("tab", "defect").agg(F.count("*").alias("pairs"))
