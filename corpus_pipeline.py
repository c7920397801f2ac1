"""The training corpus: drop toxic and poor documents and near copies, mix the sources, pack the rest.

Every stage takes what the one before it kept. Input columns travel as one struct, so that no
column of the documents can clash with a stage's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common, jaccard, mixing, packing, quality
from tripflow.llm import toxicity as toxic

TOXIC_AT = 0.7
GOOD_AT = 0.5


def _with_row(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("_row"), *columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text does not score as toxic."""
    model = toxic.fit(docs, common.table(spark, sf_dir, "labels"))
    return docs.where(toxic.judged(model)["score"] < TOXIC_AT)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their text and site together call good."""
    rows = docs.select("doc_id", "text", "source", "lang")
    featured = common.stored(quality.with_features(rows), "quality-features")
    model = quality.fit(featured, common.table(spark, sf_dir, "labels"))
    sites = quality.site_rates(featured, model)
    judged = quality.judged(quality.with_features(_with_row(docs, "text", "source", "lang")), model, sites)
    return judged.where(F.col("score") >= GOOD_AT).select("_row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; repeated rows count once."""
    stays = jaccard.join(docs).where("stays").select("doc_id", "text_hash").distinct()
    stays = common.stored(stays, "jaccard-stays")
    rows = _with_row(docs, "doc_id", jaccard.text_hash())
    same = rows["doc_id"].cast("long").eqNullSafe(stays["doc_id"]) & (rows["text_hash"] == stays["text_hash"])
    return (
        rows.join(stays, same)
        .groupBy(rows["doc_id"], rows["text_hash"])
        .agg(F.first("_row").alias("_row"))
        .select("_row.*")
    )


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(_with_row(docs, "doc_id", "text", "source"))
    return mixed.where("times > 0").select("_row", F.explode(F.sequence(F.lit(1), "times"))).select("_row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    return packing.pack(packing.pieces(docs, packing.tokenizer_path()))


STAGES = [
    ("toxicity", toxicity),
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Scoring, fitted models and tokenization have no SQL form; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
