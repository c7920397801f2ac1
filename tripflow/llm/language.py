"""Language of a text by error-correcting output codes over character n-grams.

Each language has a codeword of bits, and each bit a binary classifier that tells the languages with a
one from those with a zero by hashed n-grams of one to three letters. Its weights are the log ratio of the n-gram's
mean probability in either group of languages; they come from grouped counts over all texts one may learn
from, each text having one vote. A text's margin for a bit is the mean weight of its n-grams, drawn to zero for
short texts. On a bounded sample of these texts each classifier's threshold and steepness are set, and how often it is
right about each language. Decoding is loss-weighted: a language's loss is the exponential loss of its
codeword's bits under the classifiers' outputs, each weighted by how often that classifier is
right about that language. The language of least loss is chosen; where the runner-up's is nearly as small,
the text is flagged ``ambiguous``.

With six languages or fewer the code holds every division into two groups once; beyond that, the best of some
seeded random codes by its least distance between codewords.

Defined results: texts that are null or hold no letter (Unicode) are ``und`` with score 0. All languages seen take part, though
seen once. Without texts to learn from every text is ``und``; with one language it is that, with score 1. A null
doc_id is in fold 0, which one may learn from. Rows are judged each on its own, so repeated rows get the
same result (each has its vote in the counts). Ties go to the smaller language value. An empty table gives
an empty result. Columns that clash with the results' names are replaced; others pass through. Texts are read whole,
in stretches of bounded length.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

UNKNOWN = "und"
GRAMS = 3
BUCKETS = 1 << 15
#: Letters hashed at once.
STRETCH = 1 << 20
#: A text's vote is split among its n-grams in whole numbers, so that sums do not depend on their order.
VOTE = 1 << 30
#: Share of probability spread evenly over all n-grams.
EVEN = 0.05
#: A text of so many n-grams has half of its mean weight as margin.
HALF_AT = 40
MAX_SAMPLE = 20_000
MAX_LANGUAGES = 512
#: Losses lie between 1/e and e.
AMBIGUOUS_BELOW = 0.25
RESULTS = ("lang_pred", "score", "runner_up", "gap", "ambiguous")


# --- n-grams -------------------------------------------------------------------------------


@functools.cache
def _is_letter() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)


def letters(text: str) -> np.ndarray:
    """Code points in lower case, each run of others one blank, with a blank at both ends; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _is_letter()[codes]
    if not is_letter.any():
        return np.empty(0, np.uint32)
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    kept[0] = True
    codes = np.where(is_letter, codes, np.uint32(32))[kept]
    ends = [np.uint32(32)]
    return np.concatenate((ends if codes[0] != 32 else [], codes, ends if codes[-1] != 32 else [])).astype(np.uint32)


def gram_counts(codes: np.ndarray) -> np.ndarray:
    """How often each bucket's n-grams occur."""
    total = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for start in range(0, len(codes), STRETCH):
        for n in range(1, GRAMS + 1):
            # n-grams that begin in this stretch
            some = codes[start : min(start + STRETCH, len(codes) - n + 1) + n - 1]
            if len(some) < n:
                continue
            hashes = np.full(len(some) - n + 1, n, np.uint32)
            for i in range(n):
                hashes = (hashes ^ some[i : len(some) - n + 1 + i]) * np.uint32(0x9E3779B1)
                hashes ^= hashes >> np.uint32(15)
            total += np.bincount((hashes * np.uint32(0x85EBCA6B)) >> shift, minlength=BUCKETS)
    return total


# --- codes ---------------------------------------------------------------------------------


def codewords(languages: int, seed: int = 42, draws: int = 20) -> np.ndarray:
    """A row of +1 and -1 per language; columns differ, also from each other's opposite, and are not constant."""
    if languages <= 6:
        columns = range(1, 1 << max(languages - 1, 0))
        bits = [[0 if i == 0 else column >> (i - 1) & 1 for column in columns] for i in range(languages)]
        return 1 - 2 * np.array(bits, np.int64).reshape(languages, len(columns))
    width = int(np.ceil(10 * np.log2(languages)))
    draw = np.random.RandomState(seed)
    best, distance = None, -1
    for _ in range(draws):
        drawn = np.where(draw.rand(languages, 2 * width) < 0.5, 1, -1)
        drawn *= drawn[:1]
        drawn = np.unique(drawn[:, np.abs(drawn.sum(axis=0)) < languages], axis=1)
        code = drawn[:, draw.permutation(drawn.shape[1])[:width]]
        apart = (width - code @ code.T) // 2
        np.fill_diagonal(apart, width)
        if apart.min() > distance:
            best, distance = code, int(apart.min())
    return best


# --- learning ------------------------------------------------------------------------------


def fold(doc_id: str = "doc_id") -> Column:
    """Remainder by 4 of the CRC-32 of the id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4, F.lit(0))


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    votes: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch["lang"], batch["text"]):
            counts = gram_counts(letters(text))
            if total := counts.sum():
                votes.setdefault(language, np.zeros(BUCKETS, np.int64))
                votes[language] += (counts * (VOTE / total)).astype(np.int64)
    for language, vote in votes.items():
        buckets = np.flatnonzero(vote)
        yield pd.DataFrame({"lang": language, "bucket": buckets.astype(np.int32), "votes": vote[buckets]})


@dataclass(frozen=True)
class Model:
    """``code`` (language, bit), ``weights`` (bucket, bit); per bit a threshold and a steepness; ``trust`` (language, bit)."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    threshold: np.ndarray
    steepness: np.ndarray
    trust: np.ndarray

    def margins(self, codes: np.ndarray) -> np.ndarray:
        counts = gram_counts(codes)
        found = np.flatnonzero(counts)
        return counts[found] @ self.weights[found] / (counts.sum() + HALF_AT)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        outputs = np.tanh(self.steepness * (margins - self.threshold))
        return (self.trust * np.exp(-self.code * outputs)).sum(axis=1)

    def judge(self, text: str | None) -> tuple[str, float, str | None, float, bool]:
        codes = letters(text or "")
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0, None, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, None, float(np.e - 1 / np.e), False
        losses = self.losses(self.margins(codes))
        first, second = np.argsort(losses, kind="stable")[:2]
        gap = float(losses[second] - losses[first])
        # Share of the chosen language where losses, means over the bits, count as negative log-odds of all bits.
        shares = np.exp((losses[first] - losses) * max(4, self.code.shape[1]))
        return self.languages[first], float(1 / shares.sum()), self.languages[second], gap, gap < AMBIGUOUS_BELOW


def _bit_weights(votes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log ratio of the mean probabilities of both groups of languages; ``votes`` is (language, bucket)."""
    chance = (1 - EVEN) * votes / votes.sum(axis=1, keepdims=True) + EVEN / votes.shape[1]
    groups = [(code == side).astype(float) for side in (1, -1)]
    ones, zeros = ((chance.T @ g) / g.sum(axis=0) for g in groups)
    return np.log(ones / zeros)


def _sampled(rows: DataFrame, max_rows: int) -> DataFrame:
    found = rows.count()
    if found <= max_rows:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(common.HASHES)) < common.HASHES * max_rows // found)


def _measured(sample: DataFrame, model: Model) -> DataFrame:
    """(lang, margins) of the sampled texts with letters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(lang, letters(text)) for lang, text in zip(batch["lang"], batch["text"])]
            rows = [(lang, model.margins(codes)) for lang, codes in rows if len(codes)]
            yield pd.DataFrame(rows, columns=["lang", "margins"])

    return sample.select("lang", "text").mapInPandas(run, "lang string, margins array<double>")


def _per_bit(rows: DataFrame, languages: tuple[str, ...], value: Column, name: str) -> np.ndarray:
    """Means of ``value`` as (language, bit); a row per language and bit reaches the driver."""
    found = rows.groupBy("lang", "bit").agg(F.avg(value).alias(name)).collect()
    table = np.full((len(languages), max((r["bit"] for r in found), default=-1) + 1), np.nan)
    place = {lang: i for i, lang in enumerate(languages)}
    for r in found:
        table[place[r["lang"]], r["bit"]] = r[name]
    # Languages that the sample lacks take the mean of the others.
    return np.where(np.isnan(table), np.nanmean(table, axis=0, keepdims=True), table)


def fit(documents: DataFrame, max_sample: int = MAX_SAMPLE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from the texts outside the held-out fold that have a language.

    Counts cover all of them; thresholds and trust are set on about ``max_sample`` of them, chosen by a hash of
    the id. The driver holds a number per language and bucket, so more than ``max_languages`` are an error.
    """
    rows = documents.where((fold() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    votes = common.stored(
        rows.select("lang", "text")
        .mapInPandas(_votes, "lang string, bucket int, votes long")
        .groupBy("lang", "bucket")
        .agg(F.sum("votes").alias("votes")),
        "language-votes",
    )
    languages = tuple(sorted(r["lang"] for r in votes.select("lang").distinct().limit(max_languages + 1).collect()))
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn: pass a larger max_languages")
    none = np.zeros((0, 0))
    if len(languages) < 2:
        return Model(languages, none, none, none, none, none)
    found = votes.toArrow()
    place = np.searchsorted(np.array(languages, object), found["lang"].to_numpy())
    table = np.zeros((len(languages), BUCKETS))
    table[place, found["bucket"].to_numpy()] = found["votes"].to_numpy()

    code = codewords(len(languages))
    even = np.ones(code.shape[1])
    model = Model(languages, code, _bit_weights(table, code), 0 * even, even, np.ones(code.shape))
    measured = common.stored(_measured(_sampled(rows, max_sample), model), "language-margins")
    bits = measured.select("lang", F.posexplode("margins").alias("bit", "margin"))
    mean = _per_bit(bits, languages, F.col("margin"), "mean")
    square = _per_bit(bits, languages, F.col("margin") * F.col("margin"), "square")
    ones, zeros = ((mean * (code == s)).sum(axis=0) / (code == s).sum(axis=0) for s in (1, -1))
    threshold = (ones + zeros) / 2
    gap = np.maximum(ones - zeros, 1e-9)
    # A spread of a third of the gap at least: texts of two languages then come out between both.
    spread = np.maximum((square - mean * mean).mean(axis=0), (gap / 3) ** 2)
    # Half the log-odds of two normal groups of the same spread.
    steepness = gap / spread / 2

    above = F.col("margin") > F.get(F.array(*[F.lit(float(t)) for t in threshold]), F.col("bit"))
    share = _per_bit(bits, languages, above.cast("int"), "share")
    right = np.where(code > 0, share, 1 - share) + 1e-3
    return Model(languages, code, model.weights, threshold, steepness, right / right.sum(axis=1, keepdims=True))


# --- prediction ----------------------------------------------------------------------------


def judged(model: Model, text: str = "text") -> Column:
    @F.pandas_udf("lang_pred string, score double, runner_up string, gap double, ambiguous boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([model.judge(t) for t in batch], columns=list(RESULTS))

    return run(F.col(text))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """The columns but ``text``, and the predicted language with its score, runner-up, gap and flag."""
    kept = [c for c in documents.columns if c != "text" and c not in RESULTS]
    return documents.select(*kept, judged(model).alias("_j")).select(*kept, *[f"_j.{c}" for c in RESULTS])


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(documents)
    return predict(documents.select("doc_id", "text"), model).withColumn("held_out", fold() == 2)
