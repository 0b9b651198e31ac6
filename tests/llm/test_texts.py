"""Tokenizer, splitting, repetition and truncation."""

import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.llm import bpe, chunks, repetition, truncation

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def rank_bytes():
    with open(f"{bpe.TOKENIZER_DIR}/byte_bpe_50k.tiktoken", "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def own(rank_bytes):
    return bpe.Bpe.from_rank_file(rank_bytes)


@pytest.fixture(scope="module")
def other(rank_bytes):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_bytes.splitlines())}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "\n\n  \t x", "a" * 3000, "ab" * 2000, "Ünïcödé ß ﬁ 漢字かな 한글", "👩‍👩‍👧 é​﻿", "<|endoftext|> it's", "\x00\x01", " ".join("word" for _ in range(3000))]


def test_ids_equal_another_implementation(own, other):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab é漢\n .,'1😀") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    for t in texts:
        assert own.encode(t) == other.encode_ordinary(t)
    assert own.encode(None) == []


def test_ids_of_a_table(spark):
    df = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "hi there", "z")], "doc_id long, text string, ids string")
    got = {r.doc_id: r.out for r in df.select("doc_id", bpe.token_ids(F.col("text"), bpe.rank_file(spark)).alias("out")).collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) == 2
    assert df.where("false").select(bpe.token_ids(F.col("text"), bpe.rank_file(spark)).alias("out")).count() == 0


def test_pieces_spell_the_text(own, other):
    rng = random.Random(2)
    words = ["Alpha", "béta", "γάμμα", "delta.", "Echo!", "foxtrot", "漢字。", "x" * 50, "\n", "1,234", "😀"]
    texts = [" ".join(rng.choices(words, k=rng.randint(50, 900))) for _ in range(40)] + ODD + ["漢" * 3000, "z" * 9000, "\n" * 4000, "a. " * 2500]
    for t in texts:
        got = chunks.pieces(t, own, 100, 12)
        n = len(other.encode_ordinary(t))
        assert bool(got) == (n > 100)
        at, spelled = 0, ""
        for i, (start, end, tokens, tier, piece) in enumerate(got):
            assert piece == t[start:end] and tokens == len(other.encode_ordinary(piece)) <= 100
            assert start <= at and end > at
            spelled += t[at:end]
            at = end
            if tier == 1:
                assert re.search(r"[.!?。…\n][\"'”’»)\]」』）]*$", piece)
        assert not got or spelled == t


def test_piece_ends_at_the_last_sentence(own):
    t = "One two three four. " * 60
    assert all(p[4].rstrip().endswith(".") for p in chunks.pieces(t, own, 100, 12))


def test_oversized_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 2000), (3, "word " * 2000), (4, "word")], "doc_id long, text string")
    ranks = bpe.rank_file(spark)
    assert {r.doc_id for r in chunks.oversized(df, "doc_id", "text", ranks).collect()} == {3}
    assert chunks.split_oversized(df.where("false"), "doc_id", "text", ranks).count() == 0
    assert chunks.split_oversized(df.withColumn("_text", F.lit(1)), "doc_id", "text", ranks).where("piece = 0").count() == 2


def test_found_documents_are_those_split(spark, own, monkeypatch, tmp_path):
    from threadloom.llm import queries

    texts = [None, "", "word " * 790, "word " * 900, "A line ends here. " * 400, "漢" * 900, "x y " * 399]
    df = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3])], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    split, made = chunks.split_oversized, []
    monkeypatch.setattr(chunks, "split_oversized", lambda *args: made.append(split(*args)) or made[-1])
    got = sorted(r.doc_id for r in queries.p9_found(spark, str(tmp_path)).collect())
    assert got == sorted([3] + [i for i, t in enumerate(texts) if chunks.pieces(t or "", own, 800, 40)]) and 3 in got and 4 in got
    assert len(made) == 1 and got == sorted(r.doc_id for r in made[0].where("piece = 0").collect())


def repeated(text, n=5):
    ws = re.findall(r"\w+", (text or "").lower())
    seen, covered = set(), set()
    for i in range(len(ws) - n + 1):
        g = tuple(ws[i : i + n])
        if g in seen:
            covered.update(range(i, i + n))
        seen.add(g)
    return len(ws), len(covered)


def test_repetition_as_in_plain_python(spark):
    rng = random.Random(5)
    texts = [None, "", "...", "a b c d", "a a a a a a a a a a", "x y z v w " * 4, "one " * 20000]
    texts += [" ".join(rng.choices("a b c".split(), k=rng.randint(5, 60))) for _ in range(60)]
    texts += [" ".join(rng.choices([f"w{i}" for i in range(500)], k=80)) for _ in range(60)]
    rows = [("t", i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:9], "tab string, row_id long, summary string, words int")
    shares = repetition.repetition_shares(df, ["tab", "row_id"], "summary")
    assert {(r.row_id, r.words, r.repeated) for r in shares.collect()} == {(i, *repeated(t)) for i, t in enumerate(texts)}
    got = [r.row_id for r in repetition.repeated_documents(df, ["tab", "row_id"], "summary").collect()]
    want = [i for i, t in enumerate(texts) if repeated(t)[0] >= 10 and repeated(t)[1] >= 0.3 * repeated(t)[0]]
    assert sorted(got) == want
    assert repetition.repeated_documents(df.where("false"), ["tab", "row_id"], "summary").count() == 0


WHOLE = ["It ends.", 'He said "so."', "(Done.)", "Is it? ", "終わり。", "- one\n- two went home today", "Both (a) and b!»", "1. first thing\n2. second thing.", "Ends twice.​"]
CUT = ["It en", "It ends with the", "It ends ...", "It ends…", "It [...]", "It ends (…)", "It ends, and�", 'He said "so', "- one thing\n- two we"]
EMPTY = [None, "", " \n\t ", "-", "…", "...", "​", "n/a", "N/A", "None", "(empty)", "<no content>", "?!"]


def test_endings(spark):
    # Other texts say how sentences and items end.
    inside = [f"Somebody else {x}. More of it follows." for x in ("went home today", "saw one thing", "had the second thing")] * 3
    rows = [("a", i, t, "m") for i, t in enumerate(WHOLE + CUT + EMPTY + inside)]
    df = spark.createDataFrame(rows + rows[:20], "tab string, row_id long, summary string, source string")
    got = sorted(r.row_id for r in truncation.cut_texts(df, ["tab", "row_id"], "summary", "source").collect())
    assert got == list(range(len(WHOLE), len(WHOLE) + len(CUT)))
    rates = truncation.cut_rates(df, ["tab", "row_id"], "summary", "source", ["tab", "source"]).first()
    assert (rates.rows, rates.cut) == (len(rows), len(CUT))
    assert truncation.cut_texts(df.where("false"), ["tab", "row_id"], "summary", "source").count() == 0


def test_limits_are_found(spark):
    rng = random.Random(9)
    rows = [(x, int(rng.gauss(400, 80)), rng.random() < 0.3) for x in "st" for _ in range(4000)] + [("s", 300, True)] * 80 + [("t", 300, False)] * 80
    df = spark.createDataFrame(rows, "source string, len int, cut boolean")
    counts = df.groupBy("source", "len").agg(F.count("*").alias("all"), F.count_if("cut").alias("n"))
    assert [(r.source, r.len) for r in truncation.length_limits(counts).collect()] == [("s", 300)]


def test_hazards_decide_where_incomplete_endings_count(spark):
    rng = random.Random(10)
    prose = lambda n: " ".join(rng.choices("we went over the list and the plan of it".split(), k=n))
    rows = []
    for i in range(900):
        # Source a ends without marks everywhere, so nothing of it is cut; b is cut in transfer; c at 120 characters.
        rows.append(("a", f"{prose(12)}\n{prose(14)}\n{prose(12 + i % 9)}"))
        rows.append(("b", f"{prose(12)}.\n{prose(12 + i % 9)}" + (" th" if i % 10 == 0 else ".")))
        rows.append(("c", f"{prose(12)}.\n{prose(12 + i % 9)}.") if i % 10 else ("c", (prose(60) + " " + prose(60))[:119] + "x"))
    df = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "row_id long, summary string, source string")
    got = {r.row_id: r.at_limit for r in truncation.cut_texts(df, ["row_id"], "summary", "source").collect()}
    assert set(got) == {i for i, (s, t) in enumerate(rows) if s != "a" and not t.endswith(".")}
    assert all(at == (rows[i][0] == "c") for i, at in got.items())
    report = {(r.source, r.kind) for r in truncation.length_report(df, ["row_id"], "summary", "source").collect()}
    assert ("c", "limit") in report and ("b", "transfer") in report and not any(s == "a" for s, _ in report)


@pytest.mark.parametrize("clean", [0, 1])
def test_repetition_is_found_where_every_text_repeats(spark, clean):
    rng = random.Random(7)
    rows = [(i, " ".join([" ".join(f"w{rng.randrange(10**6)}" for _ in range(12))] * 3)) for i in range(400)]
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(60))) for i in range(clean)]
    df = spark.createDataFrame(rows, "row_id long, summary string")
    assert {r.row_id for r in repetition.repeated_documents(df, ["row_id"], "summary").collect()} == set(range(400))
    one = spark.createDataFrame([(1, "a b c d e a b c d e a b c d e")], "row_id long, summary string")
    assert repetition.repeated_documents(one, ["row_id"], "summary").count() == 1
    assert repetition.repeated_documents(df.withColumn("_trusted", F.lit(1)), ["row_id"], "summary", None).count() == 400


def test_the_ratio_rejects_what_trusted_texts_repeat_less(spark):
    rng = random.Random(8)
    new = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    loop = lambda n: " ".join([new(n)] * 4)
    rows, want = [], set()
    for i in range(600):
        kind = i % 6
        if kind == 0:
            text, want = loop(10), want | {i}
        elif kind == 1:
            run = new(5)
            text = f"{run} {new(60)} {run}"  # one repeated start in 70 words
        else:
            text = new(50)
        rows.append((i, text, None if kind == 2 else kind > 1 or i % 60 < 2))
    df = spark.createDataFrame(rows, "row_id long, summary string, trusted boolean")
    scored = repetition.repetition_scores(df, ["row_id"], "summary", "trusted")
    assert {r.row_id for r in repetition.candidates(scored, 0.3).collect()} == want and scored.count() == 200
    assert {r.row_id for r in repetition.repeated_documents(df, ["row_id"], "summary", "trusted").collect()} == want
