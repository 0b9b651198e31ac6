"""Overlaps, leakage, components and defects."""

import random
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from threadloom.llm import components, defects, leakage, overlap
from threadloom.llm.words import WORD, counts, fold, lcs, words


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_words():
    assert words("Élan, élan_ÉLAN; ﬁx İ") == words("elan elan elan ") + words("ﬁx i")
    assert fold(None) == "" and words("") == []
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert lcs(a, b) == plain_lcs(a, b)


MESSAGES = "array<struct<role:string,content:string>>"
VOCABULARY = [f"w{i}" for i in range(300)]


def record(ws, speaker="Ann", ask="Sum up."):
    third = len(ws) // 3
    lines = "\n".join(f"{speaker}: " + " ".join(ws[i : i + 10]) for i in range(third, 2 * third, 10))
    asked = f"{ask}\n<previous_summary>\n{' '.join(ws[:third])}\n</previous_summary>\n<conversation>\n{lines}\n</conversation>\nAt most 9 words."
    last = ws[third + 10 * -(-third // 10) :] if third % 10 else ws[2 * third :]
    return [("system", "be kind"), ("user", asked), ("assistant", " ".join(last))]


def test_overlaps(spark):
    rng = random.Random(4)
    rows, want = [], set()
    for i in range(60):
        ws = rng.choices(VOCABULARY, k=240)
        rows.append((2 * i, record(ws), "train", "s"))
        if i % 3 == 0:  # the same, in other clothes
            rows.append((2 * i + 1, record([w.upper() for w in ws], "Bob", "Shorten!"), "test", "s"))
            want.add((2 * i, 2 * i + 1))
        elif i % 3 == 1:  # nearly the same
            at = set(rng.sample(range(240), 10))
            rows.append((2 * i + 1, record([w for j, w in enumerate(ws) if j not in at]), "valid", "r"))
            want.add((2 * i, 2 * i + 1))
        else:  # half of it
            rows.append((2 * i + 1, record(ws[:120] + rng.choices(VOCABULARY, k=120)), "valid", "r"))
    rows += [(1000, None, "train", "s"), (1001, [], "test", None), (1002, [None, (None, None)], "valid", "s"), (None, record(ws), "test", "s"), (1003, record(ws), None, "s")]
    df = spark.createDataFrame(rows + rows[:6], f"row_id long, messages {MESSAGES}, split string, source string").withColumn("text_key", F.lit("clash"))
    got = {(r.train_id, r.other_id) for r in overlap.cross_split_overlaps(df).collect()}
    assert got == want
    report = {(r.split, r.source): (r.records, r.shared) for r in overlap.overlap_report(*overlap.overlap_classes(df)).collect()}
    assert report[("test", "s")][1] == 20
    assert overlap.cross_split_overlaps(df.where("false")).count() == 0


def scattered(ws, share, rng, new):
    """A copy with a share of its words replaced at random places."""
    out = list(ws)
    for j in rng.sample(range(len(ws)), round(len(ws) * share)):
        out[j] = new()
    return out


def test_overlaps_near_the_least_similarity(spark):
    rng = random.Random(12)
    common = [f"w{i}" for i in range(2000)]
    weights = [1 / (i + 3) for i in range(2000)]
    rows = []
    for i in range(120):
        ws = rng.choices(common, weights, k=400)
        new = (lambda: f"n{rng.randrange(10**9)}") if i % 2 else (lambda: rng.choices(common, weights)[0])
        rows.append((2 * i, record(ws), "train", "s"))
        rows.append((2 * i + 1, record(scattered(ws, 0.19 - 0.03 * (i % 4), rng, new)), "valid", "s"))
    df = spark.createDataFrame(rows, f"row_id long, messages {MESSAGES}, split string, source string")
    got = {(r.train_id, r.other_id) for r in overlap.cross_split_overlaps(df).collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(120)}


def test_overlaps_where_all_records_are_alike(spark):
    rng = random.Random(13)
    ws = rng.choices([f"w{i}" for i in range(2000)], k=300)
    rows = [(i, record(scattered(ws, 0.08, rng, lambda: f"n{rng.randrange(10**9)}")), "test" if i % 2 else "train", "s") for i in range(12)]
    df = spark.createDataFrame(rows, f"row_id long, messages {MESSAGES}, split string, source string")
    assert overlap.cross_split_overlaps(df).count() == 36
    assert overlap.cross_split_overlaps(df.where("row_id < 2")).count() == 1


def test_bins_bound_the_words_in_common():
    import pandas as pd

    rng, sketcher = random.Random(14), overlap.Sketcher()
    for _ in range(100):
        a, b = (rng.choices(VOCABULARY, k=rng.randint(1, 400)) + ["the"] * rng.choice([0, 9, 300]) for _ in range(2))
        (_, _, p, more_p), (_, _, q, more_q) = sketcher(a), sketcher(b)
        p, q = (overlap._nibbles(pd.Series([x]))[0].astype(int) for x in (p, q))
        assert sum(map(min, p, q)) + min(more_p, more_q) >= (Counter(a) & Counter(b)).total() and p.sum() + more_p == len(a)


def test_copies_are_grouped(spark):
    """A hot group of equal records is compared once and still gives every pair."""
    ws = random.Random(1).choices(VOCABULARY, k=120)
    rows = [(i, record(ws), "train" if i % 4 else "test", "s") for i in range(80)]
    df = spark.createDataFrame(rows, f"row_id long, messages {MESSAGES}, split string, source string")
    assert overlap.cross_split_overlaps(df).count() == 60 * 20


def test_blocks_keep_recall():
    for n in (2, 1000, 10**5, 10**8):
        plan = overlap.block_plan(n)
        assert (1 - overlap.AGREEMENT ** len(plan[0])) ** len(plan) <= overlap.MISS + 1e-9


def test_blocks_are_taken_in_rounds(spark, monkeypatch):
    """No round has more block rows or pairs than the texts allow; the pairs are those of all blocks at once."""
    rng, taken, near = random.Random(15), [], []
    rows, want = [], set()
    for i in range(150):
        ws = rng.choices(VOCABULARY, k=200)
        rows += [(2 * i, record(ws), "train", "s"), (2 * i + 1, record(scattered(ws, 0.1, rng, lambda: rng.choice(VOCABULARY))), "test", "s")]
        want.add((2 * i, 2 * i + 1))
    df = spark.createDataFrame(rows, f"row_id long, messages {MESSAGES}, split string, source string")
    for name, allowed in (("ROUND_BLOCKS", (16, 0)), ("ROUND_NEAR", (4, 0)), ("ROUND_TEXTS", (0.25, 0))):
        monkeypatch.setattr(overlap, name, allowed, raising=False)
    blocks, room = overlap._blocks, overlap.with_room
    monkeypatch.setattr(overlap, "_blocks", lambda *args: taken.append(args[-1]) or blocks(*args))
    monkeypatch.setattr(overlap, "with_room", lambda pairs, *args: near.append(pairs.count()) or room(pairs, *args))
    got = {(r.train_id, r.other_id) for r in overlap.cross_split_overlaps(df).collect()}
    assert got == want
    assert max(map(len, taken)) <= 16 and [b for part in taken for b in part] == overlap.block_plan(300)
    assert max(near) <= 4 * 300
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_leaks_as_in_plain_python(spark):
    rng = random.Random(8)
    names = [f"né{chr(97 + i % 26)}{i}" for i in range(900)]
    common = [f"c{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(names, k=4) + rng.choices(common, k=rng.randint(6, 30)) + rng.choices(names, k=3)), "test") for i in range(40)]
    items += [(98, "too short", "valid"), (99, None, "valid"), (0, items[0][1], "test")]
    docs = []
    for d in range(150):
        ws = rng.choices(common + names[:50], k=rng.randint(0, 120))
        if d % 3 == 0:
            it = items[rng.randrange(40)][1].split()
            n = rng.choice([11, 12, 13, len(it)])
            at = rng.randrange(max(1, len(it) - n + 1))
            cut = rng.randint(0, len(ws))
            ws[cut:cut] = [w.upper() if d % 2 else unicodedata.normalize("NFD", w) + "," for w in it[at : at + n]]
        docs.append((d, rng.choice([" ", "\n", " - "]).join(ws)))
    docs += [(900, None), (901, ""), (902, "x " * 50000 + items[5][1]), (902, "x " * 50000 + items[5][1])]
    grams = defaultdict(set)
    for i, t, _ in items:
        w = words(t)
        for a in range(len(w) - 11):
            grams[tuple(w[a : a + 12])].add(i)
    want = {(d, i) for d, t in docs for w in [words(t)] for a in range(len(w) - 11) for i in grams.get(tuple(w[a : a + 12]), ())}
    ddf = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    idf = spark.createDataFrame(items, "item_id long, item_text string, item_split string")
    got = leakage.leaked_passages(ddf, idf)
    rows = [(r.doc_id, r.item_id) for r in got.where("kind = 'passage'").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 20
    assert leakage.leaked_passages(ddf.where("false"), idf).count() == 0
    assert leakage.leaked_passages(ddf, idf.where("false")).count() == 0
    # A basis of too low rank costs candidates, never a result.
    rank, leakage.RANK = leakage.RANK, 3
    try:
        low = leakage.leaked_passages(ddf, idf).where("kind = 'passage'").collect()
    finally:
        leakage.RANK = rank
    assert {(r.doc_id, r.item_id) for r in low} == want


def test_paraphrases_are_found(spark):
    """Items of any length with words replaced at random places; the least share of words left decides."""
    rng = random.Random(9)
    names = [f"n{i}" for i in range(3000)]
    items, docs, want = [], [], set()
    for i in range(60):
        ws = rng.choices(names, k=rng.choice([20, 60, 150]))
        items.append((i, " ".join(ws), "test"))
        out = scattered(ws, (0.1, 0.18, 0.4)[i % 3], rng, lambda: f"z{rng.randrange(10**6)}")
        docs.append((i, " ".join(rng.choices(names, k=80) + out + rng.choices(names, k=80))))
        if i % 3 < 2:
            want.add((i, i))
    got = leakage.leaked_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string, item_split string"))
    assert {(r.doc_id, r.item_id) for r in got.where("lcs >= 0.8 * item_words").collect()} == want


PEERS = "id string, category string, peers array<struct<name:string,role:string,bio:string>>"


def test_components_and_splits(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        peers = [(rng.choice([f"Ann {j}", f" ann  {j} ", f"ANN {j}"]), rng.choice(["user", None, "peer"]), None) for j in rng.sample(range(260), 2)]
        peers += [("Robo", rng.choice(["assistant", " Assistant"]), None), (rng.choice(["", " ", None, "Guest", "N/A", "unknown", "USER"]), "user", None), None]
        rows.append((f"c{i:03}", rng.choice("xy"), peers))
    rows += [("hot%03d" % i, "x", [("Zoë", "user", None) if i % 2 else ("Zoë", "peer", None)]) for i in range(120)]
    rows += [("n1", None, None), ("n2", "x", []), (None, "x", [("Ann 1", "user", None)])]
    df = spark.createDataFrame(rows + rows[:30], PEERS)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, _, peers in rows:
        for p in peers or []:
            if i and p and p[0] and (p[1] or "").strip().lower() != "assistant":
                key = " ".join(unicodedata.normalize("NFC", p[0]).casefold().split())
                if key not in components.NOBODY:
                    parent[find("c:" + i)] = find("n:" + key)
    groups = defaultdict(set)
    for i, _, _ in rows:
        if i:
            groups[find("c:" + i)].add(i)
    got = defaultdict(set)
    for r in components.chain_components(df).collect():
        got[r.root].add(r.member)
    assert {min(g): g for g in groups.values() if len(g) > 1} == dict(got)
    split = {r.chain: r.split for r in components.split_chains(df).collect()}
    assert set(split) == {i for i, _, _ in rows if i}
    assert all(len({split[i] for i in g}) == 1 for g in groups.values())
    assert components.chain_components(df.where("false")).count() == 0
    assert components.split_chains(df.where("false")).count() == 0


def test_splits_come_near_their_shares(spark):
    df = spark.createDataFrame([(f"c{i}", "ab"[i % 2], [(f"P{i // 2}", "user", None)]) for i in range(2000)], PEERS)
    got = Counter((r.category, r.split) for r in components.split_chains(df).collect())
    for c in "ab":
        assert abs(got[(c, "train")] - 800) <= 40 and abs(got[(c, "valid")] - 100) <= 40 and abs(got[(c, "test")] - 100) <= 40


CHOSEN = "row_id long, chain string, kind string, k int, previous_summary string, summary string, teacher string"
DPO = f"row_id long, chain string, prompt {MESSAGES}, rejected string"
TALK = [(i, "Ann", f"we went over the {w} and said that it was all for the best of them") for i, w in enumerate("garden river school market bridge museum harbor station library theater forest island valley castle temple palace tunnel desert canyon glacier".split(), 1)]
GOOD = "Ann was glad about the garden, and the others agreed that the river walk will be on Sunday."
GERMAN = "Die Gruppe hat sich auf den Garten geeinigt und der Fluss ist nicht mehr im Plan, auch wenn noch alles offen ist."


@pytest.mark.parametrize(
    "text, says",
    [
        ("I'm sorry, but I can’t help with summarising this conversation.", True),
        ("Dabei kann ich leider nicht helfen.", True),
        ("Je suis désolé, mais je ne peux pas résumer cette conversation.", True),
        ("Desculpe, mas não posso resumir esta conversa.", True),
        ("Sorry, I cannot polish the stone path until the spice order is settled.", False),
        ("Ann cannot label the walnut shelf alone and asked for help.", False),
        ("Gaspen had to decline the offer to weigh the spare key.", False),
    ],
)
def test_declining(text, says):
    assert defects.declines(text) == says


def test_defects(spark):
    from tests.test_core import chain

    chains = chain(spark, [{"id": "c", "messages": TALK}, {"id": "c", "messages": TALK}, {"id": "d"}])
    copy = " ".join(t for _, _, t in TALK[2:6]) + "."
    answers = {1: GOOD, 2: None, 3: " \n", 4: "n/a", 5: GOOD[:40], 6: "I'm sorry, but I cannot summarise this conversation.", 7: copy, 8: GERMAN, 9: GOOD + " " + "Nothing else was said by them. " * 900, 10: "…"}
    rows = [(i, "c", "short", 0, None, s, "t") for i, s in answers.items()] + [(11, None, None, None, None, GOOD, None), (12, "d", "short", 0, GERMAN + " " + GERMAN, GERMAN.replace("Garten", "Hof").replace("Plan", "Rennen"), "t"), (None, "c", "short", 0, None, None, "t")]
    chosen = spark.createDataFrame(rows + rows[:8], CHOSEN).withColumn("row", F.lit("clash")).withColumn("defect", F.lit(0))
    asked = [("system", "x"), ("user", "<previous_summary>\nnone\n</previous_summary>\n<conversation>\n" + "\n".join(f"{p}: {t}" for _, p, t in TALK) + "\n</conversation>")]
    dpo = spark.createDataFrame([(1, "c", asked, GOOD), (2, "c", asked, copy), (3, "c", asked, GERMAN), (4, "c", None, GOOD), (5, "c", [], None), (6, "c", asked, GOOD[:50])], DPO)
    got = sorted((r.tab, r.row_id, r.defect) for r in defects.defective_pairs(chosen, dpo, chains).collect())
    assert [x for x in got if x[0] == "chosen" and x[1] < 12] == sorted(
        ("chosen", i, d) for i, d in {2: "empty", 3: "empty", 4: "empty", 5: "truncated", 6: "refusal", 7: "copy", 8: "other_language", 10: "empty"}.items()
    )
    assert [x for x in got if x[0] == "dpo"] == [("dpo", 2, "copy"), ("dpo", 3, "other_language"), ("dpo", 5, "empty"), ("dpo", 6, "truncated")]
    assert defects.defective_pairs(chosen.where("false"), dpo.where("false"), chains.where("false")).count() == 0


PAIR = "row string, prompt string, response string, previous string, talk string"


def looked(spark, rows):
    df = spark.createDataFrame(rows, PAIR)
    talks = df.select(F.col("prompt").alias("id"), F.expr("array(named_struct('peer', '', 'text', talk))").alias("messages")).where("talk IS NOT NULL")
    return defects.look(df, defects.rarity(df, talks)).dropDuplicates(["row"])


def summaries(rng, n=400):
    """Summaries of talks by the words of the talks, in the corpus' common wording."""
    rows = []
    for i in range(n):
        talk = rng.choices(VOCABULARY, k=60)
        said = rng.sample(talk, 12)
        rows.append((f"r{i}", f"p{i % 150}", f"It was settled that {said[0]} and {said[1]} stay on the list of all. They went over {' '.join(said[2:])}.", None, " ".join(talk) + " the and that was for of on"))
    return rows


def told(spark, rows):
    return {r.row: r.evidence for r in defects.refusals(looked(spark, rows)).collect()}


def test_templates_reveal_refusals_without_a_lexicon(spark, monkeypatch):
    monkeypatch.setattr(defects, "DECLINE", __import__("re").compile("(?!)"))
    rng = random.Random(2)
    talk = lambda: " ".join(rng.choices(VOCABULARY, k=60)) + " the and that was for of on"
    strange = "Such matters are best left to those concerned by them"
    rows = summaries(rng)
    # A wording that no lexicon has, a long one beside it, one too rare to recur, and one made of its phrases.
    rows += [(f"x{i}", f"q{i}", f"{strange}." if i % 2 else f"{strange}. " + "Nobody gains by another pair of eyes here. " * 9, None, talk()) for i in range(40)]
    rows += [("rare", "q900", "One would sooner not touch any such thing.", None, talk())]
    rows += [("made", "q901", "Regrettably, such matters are best left to those nearby.", None, talk())]
    rows += [("none", None, f"{strange}.", None, None)]
    got = told(spark, rows + rows[-5:])
    assert got == {f"x{i}": "template" for i in range(40)} | {"made": "phrase", "none": "template"}
    # The same words in grounded responses reveal nothing.
    common = [(f"y{i}", f"s{i}", f"{strange}. It was settled that {' '.join(t.split()[:9])} stay on the list of all.", None, t) for i, t in enumerate(talk() for _ in range(60))]
    assert told(spark, summaries(rng) + [(f"z{i}", f"q{i}", f"{strange}.", None, talk()) for i in range(20)] + common) == {}


def test_the_lexicon_decides_what_does_not_recur(spark):
    rng = random.Random(5)
    rows = summaries(rng) + [("x", "q", "I'm sorry, but I cannot summarise this conversation.", None, "w1 w2 w3 and the w4")]
    assert told(spark, rows) == {"x": "lexicon"}


def test_variants_of_a_template_vote_together(spark, monkeypatch):
    monkeypatch.setattr(defects, "DECLINE", __import__("re").compile("(?!)"))
    rng = random.Random(3)
    strange = "Such matters as were raised here over the past days are best left to those who are concerned by them and not to any other"
    talk = lambda: " ".join(rng.choices(VOCABULARY, k=60)) + " the and that was for of on"
    rows = summaries(rng) + [(f"x{i}", f"q{i}", f"{strange} {end}.", None, talk()) for i, end in enumerate(["party", "person", "people", "pair"] * 2)]
    assert told(spark, rows) == {f"x{i}": "template" for i in range(8)}


def plain_roots(sentences):
    """The root of each sentence by comparing all pairs."""
    runs = {s: frozenset(" ".join(s.split()[i : i + 5]) for i in range(max(1, len(s.split()) - 4))) for s in sentences}
    root = {s: s for s in sentences}
    for s in sentences:
        for t in sentences:
            if len(runs[s] & runs[t]) >= 0.8 * len(runs[s] | runs[t]) and root[s] != root[t]:
                low, high = sorted((root[s], root[t]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


@pytest.mark.parametrize("part", [500, 7])
def test_links_are_found_whatever_shares_their_band(spark, monkeypatch, part):
    """The least sentence of a band is unlike the others, which are like one another; bands are compared in parts, too."""
    monkeypatch.setattr(defects, "PART", part, raising=False)
    rng = random.Random(16)
    base = [f"w{i}" for i in range(60)]
    alike = [" ".join([*base[:-1], f"end{i}"]) for i in range(3)]
    unlike = [" ".join(["aaa"] + [f"x{n}" if i in at else w for i, w in enumerate(base) if i]) for n in range(120) for at in [rng.sample(range(6, 54), 2)]]
    sentences = [*alike, *unlike, "short", "w0 w1 w2"]
    want = plain_roots(sentences)
    got = {r.sentence: r.root for r in defects.template_clusters(spark.createDataFrame([(s,) for s in sentences], "sentence string")).collect()}
    assert len({want[s] for s in alike}) == 1 and want[alike[0]] != want[unlike[0]]
    assert got == want


def test_other_languages_without_a_list():
    swedish = "Gruppen enades om att trädgården ska öppnas igen på lördag eftersom alla vill hjälpa till med murarna".split()
    talk = " ".join(t for _, _, t in TALK)
    swedish, said = " ".join(swedish), counts(talk)
    assert defects.differs(swedish, counts(swedish), talk, said, 0.1)
    assert not defects.differs(swedish, counts(swedish), talk, said, 0.6)
    assert defects.differs(GOOD, counts(GOOD), swedish, counts(swedish), 0.1)


def test_words_fold_accents():
    text = "Élan vital_x, cafe\u0301’s ЁЖ—ﬁne 3,5\u00a0km\n日本語。İ"
    assert words(text) == WORD.findall(fold(text)) == "elan vital x cafe s еж".split() + words("ﬁne 3 5 km 日本語 i")
    assert counts(text + " " + text) == Counter(words(text) * 2)
    rng = random.Random(20)
    for _ in range(300):
        made = "".join(rng.choice("aZ9_ é\u0301’≠ßﬃİЖ語。\u00a0\n-") for _ in range(rng.randint(0, 30)))
        assert words(made) == WORD.findall(fold(made))
