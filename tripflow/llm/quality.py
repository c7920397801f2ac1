"""Document quality: a classifier's evidence joined with the quality of the site a document comes from.

A logistic regression on surface features of the whole text gives each document its evidence. The
documents of a host (``source``) and of a path within it (``source``, ``lang``) then form two levels of
Beta priors: a host's rate of good documents is drawn to the rate of all hosts with a strength that the
spread between hosts sets (method of moments), and a path's rate to its host's in the same
way. Sites with few documents stay near their parent. A document's own evidence is left
out of the rates it is judged with, and its log-odds are its evidence plus what the path's
rate differs from the overall rate by. All rates come from grouped sums that combine before the
shuffle.

Defined results: a null text counts as empty; an empty text has features of zeros and is judged by them and its
site. Null hosts and paths are a site of their own. Rows are judged each on its own, repeated ones
too, though all count in their site's rate. Without labels of both classes the evidence of every document is the share
of good ones (1 without any). An empty table gives an empty result. Columns that clash with the results' names are
replaced; others pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

FEATURES = [
    "log_words", "upper", "symbols", "exclaims", "bars", "digits", "stops", "blank", "lines",
    "word_length", "distinct", "commonest", "repeated_lines",
]
RESULTS = ("evidence", "host_rate", "path_rate", "score")
LEAST_RATE = 0.001


def _classes() -> dict[str, np.ndarray]:
    kinds = {
        "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "lower": b"abcdefghijklmnopqrstuvwxyz",
        "symbols": b"#$%&*+=<>@\\^_`{}~[]/",
        "exclaims": b"!",
        "bars": b"|",
        "digits": b"0123456789",
        "stops": b".?",
        "blank": b" \t\r\v\f",
        "lines": b"\n",
    }
    return {k: np.frombuffer(v, np.uint8).astype(np.int64) for k, v in kinds.items()}


CLASSES = _classes()


def features(text: str | None) -> list[float]:
    """Values of ``FEATURES``, all between 0 and about 1 but the logarithm of the words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = {k: counts[v].sum() / len(data) for k, v in CLASSES.items()}
    seen = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        float(np.log1p(len(words)) / 10),
        float(share["upper"] / max(share["upper"] + share["lower"], 1e-9)),
        *(float(share[k]) for k in ("symbols", "exclaims", "bars", "digits", "stops", "blank", "lines")),
        sum(map(len, words)) / len(words) / 20,
        len(seen) / len(words),
        seen.most_common(1)[0][1] / len(words),
        1 - len(set(lines)) / len(lines),
    ]


def with_features(documents: DataFrame) -> DataFrame:
    """The columns but ``text``, and one double per feature. Columns named like a feature are replaced."""

    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def computed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([features(t) for t in batch], columns=FEATURES)

    kept = [c for c in documents.columns if c != "text" and c not in FEATURES]
    return documents.select(*kept, computed("text").alias("_f")).select(*kept, "_f.*")


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    intercept: float

    def log_odds(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(FEATURES, self.weights, strict=True):
            total = total + F.col(name) * weight
        return F.greatest(F.least(total, F.lit(12.0)), F.lit(-12.0))


def fit(
    featured: DataFrame, labels: DataFrame, penalty: float = 1e-4, max_labels: int = common.MAX_LABELS
) -> Model:
    """Learn from labelled documents outside the held-out fold, about ``max_labels`` at most.

    ``featured`` has doc_id and features.
    """
    rows = featured.join(F.broadcast(common.known_labels(labels, "quality", max_labels)), "doc_id")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 1.0
        share = min(max(share, 1e-5), 1 - 1e-5)
        return Model((0.0,) * len(FEATURES), float(np.log(share / (1 - share))))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
    fitted = LogisticRegression(regParam=penalty, maxIter=30).fit(vectors.coalesce(8).persist())
    return Model(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def _strength(sites: DataFrame, total: str, n: str) -> tuple[float, float]:
    """Mean and prior strength of the rates in ``sites`` by the method of moments."""
    row = sites.agg(F.sum(total).alias("s"), F.sum(n).alias("n")).first()
    if not row["n"]:
        return 1 - LEAST_RATE, 1.0
    mean = min(max(row["s"] / row["n"], LEAST_RATE), 1 - LEAST_RATE)
    rate = F.col(total) / F.col(n)
    spread = sites.agg(
        F.sum(F.col(n) * (rate - mean) ** 2).alias("q"), F.count("*").alias("k"), F.sum(F.col(n) * F.col(n)).alias("n2")
    ).first()
    noise = mean * (1 - mean)
    scale = row["n"] - spread["n2"] / row["n"]
    between = (spread["q"] - (spread["k"] - 1) * noise) / scale if scale > 0 else 0.0
    between = min(max(between, noise * 1e-4), noise * 0.5)
    return mean, noise / between - 1


@dataclass(frozen=True)
class Sites:
    """``rates`` has the sums of each host and path; the rest are the priors' strengths and the overall rate."""

    rates: DataFrame
    mean: float
    host_strength: float
    path_strength: float


def site_rates(featured: DataFrame, model: Model, host: str = "source", path: str = "lang") -> Sites:
    evidence = featured.select(F.col(host).alias("_h"), F.col(path).alias("_p"), _logistic(model.log_odds()).alias("_e"))
    paths = common.stored(
        evidence.groupBy("_h", "_p").agg(F.sum("_e").alias("_path_sum"), F.count("*").alias("_path_n")), "quality-paths"
    )
    hosts = paths.groupBy("_h").agg(F.sum("_path_sum").alias("_host_sum"), F.sum("_path_n").alias("_host_n"))
    mean, host_strength = _strength(hosts, "_host_sum", "_host_n")
    _, path_strength = _strength(paths, "_path_sum", "_path_n")
    both = paths.alias("p").join(hosts.alias("h"), F.col("p._h").eqNullSafe(F.col("h._h")))
    rates = common.stored(both.select("p.*", "_host_sum", "_host_n"), "quality-sites")
    return Sites(rates, mean, host_strength, path_strength)


def judged(featured: DataFrame, model: Model, sites: Sites, host: str = "source", path: str = "lang") -> DataFrame:
    """Adds ``evidence``, ``host_rate``, ``path_rate`` and ``score`` to the rows' columns, features left out."""
    kept = [c for c in featured.columns if c not in FEATURES and c not in RESULTS]
    evidence = featured.select(*kept, _logistic(model.log_odds()).alias("evidence"))
    own = F.col("evidence")
    host_rate = (sites.mean * sites.host_strength + F.col("_host_sum") - own) / (sites.host_strength + F.col("_host_n") - 1)
    path_rate = (host_rate * sites.path_strength + F.col("_path_sum") - own) / (sites.path_strength + F.col("_path_n") - 1)
    clipped = F.greatest(F.least(F.col("path_rate"), F.lit(1 - LEAST_RATE)), F.lit(LEAST_RATE))
    total = F.log(own / (1 - own)) + F.log(clipped / (1 - clipped)) - float(np.log(sites.mean / (1 - sites.mean)))
    return (
        evidence.join(sites.rates, F.col(host).eqNullSafe(F.col("_h")) & F.col(path).eqNullSafe(F.col("_p")))
        .withColumns({"host_rate": host_rate, "path_rate": path_rate})
        .withColumn("score", _logistic(total))
        .select(*kept, *RESULTS)
    )


def _logistic(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def score(documents: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """Judge all documents (without their text) with a model learned from the labelled ones among them."""
    featured = common.stored(with_features(documents), "quality-features")
    model = fit(featured, labels)
    return judged(featured, model, site_rates(featured, model, host, path), host, path)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return score(documents, common.table(spark, sf_dir, "labels")).select(
        "doc_id",
        (common.fold() == 1).alias("held_out"),
        "evidence",
        "host_rate",
        "path_rate",
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
