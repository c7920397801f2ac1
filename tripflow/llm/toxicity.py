"""Toxic passages: maximal scoring segments over token log-odds, judged by extreme-value statistics.

Learning counts, for every word and word beginning, the labelled documents of each class that hold
it. A Dirichlet prior gives the log-odds of each; a word not seen often enough takes those of its
longest beginning that was, so that inflected forms are known by their stem. Entries whose
log-odds are surely positive form the lexicon; any other token costs a constant.

Scoring scans a text once. A word said again counts where the gap to its last counted place costs as much as the
word scores; nearer, the two are one passage's evidence, so a passage loses the cost of one such gap at most. All maximal segments come from one left-to-right pass; each segment
of score S in a text of n tokens is expected K n exp(-lambda S) times by chance, lambda being the
positive root of E[exp(lambda s)] = 1 over the tokens of clean texts. Sums over the best r segments
give the chance P that a clean text looks as bad, and the score is pi / (pi + (1 - pi) P),
with pi the share of toxic texts learned from.

Null and empty texts have no tokens and take the score of P = 1, which is pi. Repeated rows are scored
alike, each on its own; texts of any length are scanned whole. Without labels of both classes every
text scores 0. Other columns pass through untouched.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
FLUSH = 300_000
#: Part of the highest log-odds of a rare word that entries need, where ``least_log_odds`` is more than that.
LEAST_OF_HIGHEST = 0.65


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass(frozen=True)
class Model:
    """``scores``: log-odds by word or beginning (with a final ``*``); at most ``max_entries``."""

    scores: dict[str, float]
    cost: float
    decay: float
    factor: float
    prior: float


def _entries(text: str) -> set[str]:
    words = set(tokens(text))
    out = set(words)
    for size in BEGINNINGS:
        out.update(w[:size] + "*" for w in words if len(w) > size)
    return out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pd.DataFrame:
        names = list(counts[0].keys() | counts[1].keys())
        out = pd.DataFrame(
            {"entry": names, "clean": [counts[0][n] for n in names], "toxic": [counts[1][n] for n in names]}
        )
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            counts[label].update(_entries(text))
            if len(counts[0]) + len(counts[1]) > FLUSH:
                yield flush()
    yield flush()


def fit(
    documents: DataFrame,
    labels: DataFrame,
    prior_share: float = 0.015,
    least_root: float = 5.0,
    least_log_odds: float = 4.0,
    cost: float = 0.01,
    max_entries: int = 100_000,
    max_labels: int = common.MAX_LABELS,
) -> Model:
    """Learn from labelled documents outside the held-out fold, about ``max_labels`` at most, equal texts counted once.

    The Dirichlet prior weighs as much as ``prior_share`` of the texts. An entry is kept if its
    log-odds are at least ``least_log_odds``, or ``LEAST_OF_HIGHEST`` of what the class shares allow, and the root of its likelihood ratio against no link
    with the label is at least ``least_root``; the model keeps the ``max_entries`` surest, which
    bounds what is sent to the executors.
    """
    known = (
        common.labelled(documents, labels, "toxic", max_labels)
        .groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n"))
        .agg(F.max(F.struct("label", "text")).alias("r"))
        .select("r.label", "r.text")
    )
    known = common.stored(known, "toxicity-known")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model({}, cost, 1.0, 1.0, 0.0)
    counted = (
        known.mapInPandas(_count, "entry string, clean long, toxic long")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("toxic >= 2")
    )
    prior_documents = prior_share * (toxic + clean)
    share = toxic / (toxic + clean)
    # The most that a rare word can have: it falls as the share of toxic texts rises.
    highest = math.log((1 + prior_share) / prior_share) + math.log((1 - share + prior_share) / (share + prior_share))
    least_log_odds = min(least_log_odds, LEAST_OF_HIGHEST * highest)
    held = F.col("toxic") + F.col("clean")
    ratio = F.col("toxic") * F.log(F.col("toxic") / (held * share)) + F.when(F.col("clean") > 0, F.col("clean")).otherwise(
        F.lit(0)
    ) * F.log(F.greatest(F.col("clean"), F.lit(1)) / (held * (1 - share)))
    prior = held / (toxic + clean) * prior_documents
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(t / (toxic + prior_documents - t)) - F.log(c / (clean + prior_documents - c))
    surest = (
        counted.select(
            "entry",
            odds.alias("log_odds"),
            F.sqrt(F.greatest(2 * ratio, F.lit(0.0))).alias("root"),
            (c / (clean + prior_documents)).alias("clean_rate"),
        )
        .where((F.col("log_odds") >= least_log_odds) & (F.col("root") >= least_root))
        .orderBy(F.desc("root"), "entry")
        .limit(max_entries)
        .collect()
    )
    entries = {r["entry"]: (r["log_odds"], r["clean_rate"]) for r in surest}
    # The share of a clean text's tokens that an entry makes up, at 200 tokens a text.
    chances = [(odds, rate / 200) for e, (odds, rate) in entries.items() if not e.endswith("*")]
    decay = _root(chances, cost)
    return Model({e: s for e, (s, _) in entries.items()}, cost, decay, 0.1, share)


def _root(chances: list[tuple[float, float]], cost: float) -> float:
    """The positive lambda with sum of p exp(lambda s) = 1, the other tokens scoring -cost."""
    rest = max(0.0, 1.0 - sum(p for _, p in chances))

    def over(x: float) -> bool:
        return sum(p * math.exp(min(x * s, 700.0)) for s, p in chances) + rest * math.exp(-x * cost) > 1.0

    low, high = 0.0, 1.0
    while not over(high) and high < 8:
        high *= 2
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return max(low, 0.05)


class Lexicon(dict):
    """Scores of words, looked up once each: the word's own, else its longest beginning's, else 0."""

    def __init__(self, scores: dict[str, float]) -> None:
        super().__init__()
        self.scores = scores

    def __missing__(self, word: str) -> float:
        found = self.scores.get(word)
        for size in reversed(BEGINNINGS):
            if found is None and len(word) > size:
                found = self.scores.get(word[:size] + "*")
        if len(self) > FLUSH:
            self.clear()
        self[word] = found or 0.0
        return self[word]


def segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, end), in linear time.

    ``hits`` are the positions and scores of positive tokens; those between cost ``cost`` each.
    Each stack entry holds the running sums before and after the segment (Ruzzo and Tompa).
    """
    stack: list[list] = []  # sum before, sum after, first, end, next entry below with a smaller sum before
    total, at = 0.0, 0
    for position, score in hits:
        total -= cost * (position - at)
        entry = [total, total + score, position, position + 1, -1]
        total, at = total + score, position + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= entry[0]:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= entry[1]:
                entry[4] = j
                stack.append(entry)
                break
            entry[0], entry[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(e[1] - e[0], e[2], e[3]) for e in stack]


def chance(scores: list[float], n: int, decay: float, factor: float) -> float:
    """Chance that a clean text of ``n`` tokens has segments as good: the best r together, best r."""
    if not scores:
        return 1.0
    best, total = 1.0, 0.0
    offset = math.log(max(factor * n, 1.0))
    for r, score in enumerate(sorted(scores, reverse=True), 1):
        total += decay * score - offset
        if total <= r:  # the sum's density only falls beyond
            break
        tail = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
        best = min(best, math.exp(min(0.0, min(0.0, tail) + r * math.log(2))))
    return best


def evidence(found: list[tuple[float, int, int]], hits: list[tuple[int, float]], words: list[str]) -> list[float]:
    """Scores of the segments, best first, each word only in the best it occurs in: said again it is no new evidence."""
    places, seen, out = [i for i, _ in hits], set(), []
    for score, first, end in sorted(found, key=lambda s: (-s[0], s[1])):
        for i, s in hits[bisect_left(places, first) : bisect_left(places, end)]:
            if words[i] in seen:
                score -= s
            seen.add(words[i])
        if score > 0:
            out.append(score)
    return out


def judge(model: Model, text: str | None, lexicon: Lexicon) -> tuple[float, int, list[tuple[float, int, int]]]:
    """Score, token count and segments of one text."""
    words = tokens(text or "")
    hits, last = [], {}
    for i, s in enumerate(map(lexicon.__getitem__, words)):
        if s and (words[i] not in last or model.cost * (i - last[words[i]]) >= s):
            last[words[i]] = i
            hits.append((i, s))
    found = segments(hits, model.cost)
    p = chance(evidence(found, hits, words), len(words), model.decay, model.factor)
    score = model.prior / (model.prior + (1 - model.prior) * p) if model.prior else 0.0
    return score, len(words), found


def judged(model: Model, text: str = "text") -> Column:
    """A struct of ``score``, ``n_tokens`` and ``passages`` (score, first and end token) for a text column."""

    @F.pandas_udf("score double, n_tokens int, passages array<struct<score: double, first: int, end: int>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(model.scores)
        for batch in texts:
            rows = [judge(model, t, lexicon) for t in batch]
            yield pd.DataFrame(
                {
                    "score": [r[0] for r in rows],
                    "n_tokens": [r[1] for r in rows],
                    "passages": [[{"score": s, "first": a, "end": b} for s, a, b in r[2]] for r in rows],
                }
            )

    return run(text)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with the fields of ``judged``; columns of these names in the input are replaced."""
    kept = documents.drop("score", "n_tokens", "passages")
    return kept.withColumn("_judged", judged(model)).select(*kept.columns, "_judged.*")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    model = fit(documents, common.table(spark, sf_dir, "labels"))
    return score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        (common.fold() == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
