"""Honest chaining: each step's summary is made from the producer's own summary of the step before."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Producer = Callable[[str, str, int], str]


def extractive(previous: str, transcript: str, limit: int, share: float = 0.8, verb: str = "said", bullets: bool = False, drop_last: bool = False) -> str:
    """A deterministic summary: what was held, then every line, rewritten, within a share of the limit.

    ``bullets`` gives one item a line, ``drop_last`` forgets the last part that was held, as a weaker producer does.
    """
    lines = []
    for line in transcript.split("\n"):
        who, _, said = line.partition(": ")
        lines.append(f"{who} {verb} {said.rstrip('.!?')}.")
    held = [x for x in previous.split("\n") if x] if bullets else ([previous] if previous else [])
    if drop_last and held:
        held = held[:-1] if bullets else [held[0].rsplit(". ", 1)[0] + "."]
    parts = held + ([f"- {x}" for x in lines] if bullets else lines)
    out, room = [], int(limit * share)
    for part in parts:
        ws = part.split()[: room - sum(len(x) for x in out)]
        if ws:
            out.append(ws)
    return ("\n" if bullets else " ").join(" ".join(x) for x in out)


def walk(steps: DataFrame, produce: Producer = extractive, stop_on_error: bool = False) -> DataFrame:
    """(chain, kind, k, summary, error) from (chain, kind, k, transcript, word_limit), in order within a chain and kind.

    A fold over one chain's steps, whose number a chain bounds. Whatever error the producer raises stands in the row and
    empties what is held; with ``stop_on_error`` the chain's later steps have no row.
    """

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held, out = "", []
        for k, transcript, limit in frame.sort_values("k")[["k", "transcript", "word_limit"]].itertuples(index=False):
            error = None
            try:
                held = produce(held, transcript or "", int(limit))
            except Exception as raised:  # the producer is the caller's
                held, error = "", f"{type(raised).__name__}: {raised}"
            out.append((*key, k, held, error))
            if error and stop_on_error:
                break
        return pd.DataFrame(out, columns=["chain", "kind", "k", "summary", "error"])

    return steps.select("chain", "kind", F.col("k").cast("int").alias("k"), "transcript", "word_limit").groupBy("chain", "kind").applyInPandas(
        one, "chain string, kind string, k int, summary string, error string"
    )
