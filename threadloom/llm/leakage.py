"""Evaluation texts leaking into training text.

Method: latent semantic retrieval. Held-out items are TF-IDF vectors over their own words, with document frequencies
counted over the whole corpus; a randomised SVD, computed with partial sums on the executors, gives a latent basis.
Every document is cut into overlapping passages that together hold each run of ``run`` words whole; passages are
projected and compared with the items by cosine; candidates are then checked word by word.

The search loses nothing. If a passage p holds a run v of item x, all weights being positive, then <p, x> is at least
|v|^2, hence at least the least such value over the runs of x, of which m(x) is ``SLACK``. What the basis leaves out of x is at most
|p| * residual(x). So p is a candidate of x exactly if cos(p, x) in latent space reaches
(m(x) - |p| * residual(x)) / (|p| |x|), a threshold for each pair and not a guess. Passages whose whole energy is below
the least m(x) are never projected.

A paraphrase, most of an item's words in order but no such run, is looked for among the same candidates: what of it lies
in a passage weighs enough unless nearly all of its heavy words were replaced. What the words
in common rule out is left; the longest common subsequence decides the rest.

Items are the query set: they are taken in blocks of at most ``BLOCK_WORDS`` words, so what is broadcast (vocabulary,
basis, runs) has a fixed bound, and documents are only ever streamed through, whole, without a shuffle of text.

Defined cases: null, empty and short texts hold nothing; items of fewer than ``run`` words leak nowhere; repeated rows
give one result; an empty corpus or item table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.words import lcs, words

BLOCK_WORDS = 50_000
RANK = 320
#: Candidates weigh at least this share of an item's lightest run. Below 1 for paraphrases only, whose words may be divided
#: between two passages; runs need no more than 1.
SLACK = 0.75
SCHEMA = "doc_id long, item_id long, run int, lcs int, item_words int, kind string"


def randomised_svd(rows: DataFrame, terms: int, rank: int, power: int = 1, seed: int = 7) -> np.ndarray:
    """An orthonormal basis (terms x rank) of the row space of a sparse matrix of rows (ids array<int>, weights array<double>).

    Each pass sketches the matrix with partial sums a task: A'A times a terms x rank block. Only such blocks, whose size
    the caller bounds, reach the driver.
    """
    rng = np.random.default_rng(seed)
    block = rng.standard_normal((terms, rank))
    context = rows.sparkSession.sparkContext
    schema = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("row", T.ArrayType(T.DoubleType()))])
    for _ in range(power + 1):
        shared = context.broadcast(block)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, seen = np.zeros((terms, rank)), np.zeros(terms, dtype=bool)
            for batch in batches:
                for ids, weights in zip(batch["ids"], batch["weights"]):
                    i, w = np.asarray(ids), np.asarray(weights)
                    total[i] += np.outer(w, w @ shared.value[i])
                    seen[i] = True
            yield pd.DataFrame({"term": np.flatnonzero(seen).astype("int32"), "row": list(total[seen])})

        sums = (
            rows.select("ids", "weights")
            .mapInPandas(partial, schema)
            .select("term", F.posexplode("row").alias("j", "x"))
            .groupBy("term", "j")
            .agg(F.sum("x").alias("x"))
            .toPandas()
        )
        image = np.zeros((terms, rank))
        image[sums["term"].to_numpy(dtype=int), sums["j"].to_numpy(dtype=int)] = sums["x"].to_numpy(dtype=float)
        block = np.linalg.qr(image)[0]
    return block


def document_frequencies(docs: DataFrame, text: str, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """Documents that hold each word of the vocabulary, and all documents with a text, over the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        n, total = np.zeros(len(known) + 1, dtype="int64"), 0
        for batch in batches:
            for t in batch["t"]:
                total += 1
                n[[known[w] for w in set(words(t)) if w in known]] += 1
        n[-1] = total
        at = np.flatnonzero(n)
        yield pd.DataFrame({"term": at, "n": n[at]})

    got = (
        docs.where(F.col(text).isNotNull())
        .select(F.make_valid_utf8(F.col(text)).alias("t"))
        .mapInPandas(count, "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    out = np.zeros(len(vocabulary) + 1)
    out[got["term"].to_numpy(dtype=int)] = got["n"].to_numpy(dtype=float)
    return out[:-1], int(out[-1])


def _least_run(ids: np.ndarray, weight: np.ndarray, run: int) -> tuple[float, float]:
    """Least |v|^2 over the runs of an item: with equal words merged, and without."""
    square = weight[ids] ** 2
    plain = np.convolve(square, np.ones(run), "valid").min()
    merged = min(
        float(((np.unique(ids[i : i + run], return_counts=True)[1] ** 2) * weight[np.unique(ids[i : i + run])] ** 2).sum())
        for i in range(len(ids) - run + 1)
    )
    return merged, float(plain)


def _search_block(
    docs: DataFrame, key: str, text: str, items: list[tuple[int, list[str]]], run: int, paraphrase: float
) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    df, n = document_frequencies(docs, text, vocabulary)
    weight = np.log((n + 2) / (df + 1)) + 0.05
    ids = [np.array([vocabulary[w] for w in ws]) for _, ws in items]
    vectors = []
    for i in ids:
        at, c = np.unique(i, return_counts=True)
        vectors.append((at, c * weight[at]))
    sparse = spark.createDataFrame(
        [(a.tolist(), v.tolist()) for a, v in vectors], "ids array<int>, weights array<double>"
    )
    rank = min(RANK, len(items), len(vocabulary))
    basis = randomised_svd(sparse, len(vocabulary), rank)
    latent = np.stack([v @ basis[a] for a, v in vectors])
    size = np.array([np.sqrt((v**2).sum()) for _, v in vectors])
    residual = np.sqrt(np.maximum(size**2 - (latent**2).sum(axis=1), 0)) + 1e-6 * size
    least = [_least_run(i, weight, run) for i in ids]
    model = {
        "vocabulary": vocabulary,
        "weight": weight,
        "basis": basis.astype("float32"),
        "latent": latent.astype("float32"),
        "size": size,
        "residual": residual,
        "least": np.array([m for m, _ in least]) * SLACK,
        "energy": min(p for _, p in least) * SLACK,
        "items": items,
        "counts": [Counter(ws) for _, ws in items],
        "runs": [{tuple(ws[i : i + run]) for i in range(len(ws) - run + 1)} for _, ws in items],
    }
    shared = spark.sparkContext.broadcast(model)
    names = ["doc_id", "item_id", "run", "lcs", "item_words", "kind"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        known, w = m["vocabulary"], np.append(m["weight"], 0.0)
        basis = np.vstack([m["basis"], np.zeros((1, m["basis"].shape[1]), dtype="float32")]) * w[:, None].astype("float32")
        none = len(known)
        for batch in batches:
            out: list[tuple] = []
            for doc, t in zip(batch["k"], batch["t"]):
                ws = words(t)
                if len(ws) < run:
                    continue
                at = np.array([known.get(x, none) for x in ws])
                energy = np.concatenate([[0.0], np.cumsum(w[at] ** 2)])
                starts = np.arange(0, len(ws) - run + 1, run)
                stops = np.minimum(starts + 2 * run - 1, len(ws))
                starts = starts[energy[stops] - energy[starts] >= m["energy"]]
                found: dict[int, set[int]] = {}
                for s in range(0, len(starts), 512):
                    some = starts[s : s + 512]
                    spans = some[:, None] + np.arange(2 * run - 1)[None, :]
                    terms = np.where(spans < len(ws), at[np.minimum(spans, len(ws) - 1)], none)
                    p = basis[terms].sum(axis=1)
                    length = _lengths(terms, w, none)
                    inner = p @ m["latent"].T
                    cosine = inner / (length[:, None] * m["size"][None, :])
                    needed = (m["least"][None, :] - length[:, None] * m["residual"][None, :]) / (
                        length[:, None] * m["size"][None, :]
                    )
                    for a, i in zip(*np.nonzero(cosine >= needed)):
                        found.setdefault(int(i), set()).add(int(some[a]))
                for i, places in found.items():
                    item, text_words = m["items"][i]
                    hit = any(
                        tuple(ws[a : a + run]) in m["runs"][i]
                        for s in places
                        for a in range(s, min(s + run, len(ws) - run + 1))
                    )
                    # The answer check: the part of the item's words that stands, in order, around the passages. It can't be
                    # more than they have in common, which costs less to count.
                    lo, hi = max(0, min(places) - len(text_words)), max(places) + 2 * run + len(text_words)
                    if not hit and (Counter(ws[lo:hi]) & m["counts"][i]).total() < paraphrase * len(text_words):
                        continue
                    common = lcs(ws[lo:hi], text_words)
                    if hit or common >= paraphrase * len(text_words):
                        longest = _longest_run(ws[lo:hi], text_words) if hit else 0
                        out.append((doc, item, longest, common, len(text_words), "passage" if hit else "paraphrase"))
            if out:
                yield pd.DataFrame(out, columns=names)

    source = docs.where(F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("k"), F.make_valid_utf8(F.col(text)).alias("t")
    )
    return source.mapInPandas(search, SCHEMA)


def _lengths(terms: np.ndarray, w: np.ndarray, none: int) -> np.ndarray:
    """Euclidean lengths of passages with equal words merged; ``none`` weighs nothing."""
    weights = w[terms]
    same = terms[:, :, None] == terms[:, None, :]
    return np.maximum(np.sqrt(np.einsum("pi,pij,pj->p", weights, same, weights, optimize=True)), 1e-9)


def _longest_run(a: list[str], b: list[str]) -> int:
    """Longest common run of words."""
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                now[j + 1] = before[j] + 1
                if now[j + 1] > best:
                    best = now[j + 1]
        before = now
    return best


def leaked_passages(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", run: int = 12, paraphrase: float = 0.8
) -> DataFrame:
    """(doc_id, item_id, run, lcs, item_words, kind): kind is ``passage`` where the document holds ``run`` consecutive
    words of the item, ``paraphrase`` where it only holds most of its words in order. run is the longest common run."""
    listed = items.where("item_id IS NOT NULL AND item_text IS NOT NULL").select("item_id", "item_text").distinct()
    block: list[tuple[int, list[str]]] = []
    size, parts = 0, []
    for row in listed.orderBy("item_id").toLocalIterator():  # the query set, one block at a time
        ws = words(row["item_text"])
        if len(ws) < run:
            continue
        block.append((row["item_id"], ws))
        size += len(ws)
        if size >= BLOCK_WORDS:
            parts.append(_search_block(docs, key, text, block, run, paraphrase))
            block, size = [], 0
    if block:
        parts.append(_search_block(docs, key, text, block, run, paraphrase))
    if not parts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def leak_report(found: DataFrame, items: DataFrame) -> DataFrame:
    """(item_split, items, leaked, documents) over all held-out items."""
    hits = found.where("kind = 'passage'").groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"))
    return (
        items.select("item_id", "item_split")
        .distinct()
        .join(hits, "item_id", "left")
        .groupBy("item_split")
        .agg(
            F.count("*").alias("items"),
            F.count("documents").alias("leaked"),
            F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
        )
    )
