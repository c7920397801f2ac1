"""I-Match fingerprints: hashes of the terms of a band of document frequency, over randomised lexicons.

The lexicon holds the terms whose share of documents lies between ``rarest`` and ``commonest``. As the
shares of all terms add up to the mean number of terms of a document, it has at most that number divided by ``rarest``
entries, whatever the corpus. A text's kept terms, sorted, give one full hash, as in I-Match. Then 16 randomised lexicons
each keep a term by its hash, at one half, a quarter, an eighth of the terms and so on; of these, the
three densities that leave about one, a half and a quarter of a term are hashed. A changed term so
spoils few of the 48 hashes, and the share of equal ones is the likeness of two texts.

A text with fewer than ``least_terms`` terms in the lexicon uses all its terms. The fingerprint is the number of terms, the full
hash, the density and the 48 hashes (``-`` for a lexicon that keeps nothing), as text.

Defined results: a null text is empty, and all empty texts have the fingerprint ``0``. Of two texts, equal fingerprints
have likeness 1; otherwise an empty one has likeness 0 to any other. Rows of equal ids are in
the order of their texts, backwards; a null id is after all others. The next document of a table's only row is
the row itself. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

LEXICONS = 16
SEEDS = common.mixed(np.arange(1, LEXICONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
PUNCTUATION = bytes(32 if chr(b) in "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~" else b for b in range(256))
FLUSH = 300_000


def terms(text: str) -> set[bytes]:
    """Distinct lower-case words, ASCII punctuation taken as blanks."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(PUNCTUATION).split())


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()

    def flush() -> pd.DataFrame:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))
        out = pd.DataFrame({"term": hashes.view(np.int64), "n": list(counts.values())})
        counts.clear()
        return out

    for batch in batches:
        for text in batch["text"]:
            counts.update(terms(text))
            if len(counts) > FLUSH:
                yield flush()
    yield flush()


def lexicon(documents: DataFrame, rarest: float = 0.0005, commonest: float = 0.1) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all texts."""
    texts = documents.select("text").where("text IS NOT NULL")
    n = documents.count()
    counted = texts.mapInPandas(_count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counted.where((F.col("n") >= rarest * n) & (F.col("n") <= commonest * n))
    return np.sort(band.select("term").toPandas()["term"].to_numpy(dtype=np.int64)).view(np.uint64)


class Hashes(dict):
    """Hash of each term, and whether the lexicon holds it (the lowest bit)."""

    def __init__(self, lexicon: np.ndarray) -> None:
        super().__init__()
        self.held = frozenset(lexicon.tolist())

    def __missing__(self, term: bytes) -> int:
        if len(self) > FLUSH:
            self.clear()
        value = xxhash.xxh3_64_intdigest(term)
        self[term] = value = (value << 1) | (value in self.held)
        return value


def fingerprint(words: set[bytes], memo: Hashes, least_terms: int = 4) -> str:
    found = list(map(memo.__getitem__, words))
    kept = [h >> 1 for h in found if h & 1]
    if len(kept) < least_terms:
        kept = [h >> 1 for h in found]
    if not kept:
        return "0"
    hashes = np.array(sorted(set(kept)), dtype=np.uint64)
    full = xxhash.xxh3_64_hexdigest(hashes.tobytes())
    density = max(1, round(math.log2(len(hashes))))
    drawn = common.mixed(hashes[None, :] ^ SEEDS[:, None])
    parts = []
    for level in (density, density + 1, density + 2):
        chosen = drawn < np.uint64(1 << (64 - level))
        sums = np.where(chosen, hashes[None, :], np.uint64(0)).sum(axis=1, dtype=np.uint64)
        values = common.mixed(sums + SEEDS) >> np.uint64(32)
        parts += [f"{v:08x}" if some else "-" for v, some in zip(values.tolist(), chosen.any(axis=1).tolist(), strict=True)]
    return f"{len(hashes)}:{full}:{density}:{' '.join(parts)}"


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among those that either text has, at the densities that both have."""
    if a == b:
        return 1.0
    if a == "0" or b == "0":
        return 0.0
    (_, _, level_a, parts_a), (_, _, level_b, parts_b) = a.split(":"), b.split(":")
    left, right = parts_a.split(" "), parts_b.split(" ")
    shift = int(level_b) - int(level_a)
    same = either = 0
    for i, x in enumerate(left):
        j = i - shift * LEXICONS
        if 0 <= j < len(right) and (x != "-" or right[j] != "-"):
            either += 1
            same += x == right[j]
    return same / either if either else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next one's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def range_starts(ids: DataFrame, range_rows: int) -> DataFrame:
    """Every ``range_rows``-th id of the sorted ids, the least one included; a stored table of one column."""
    parts = common.shuffle_partitions(ids.sparkSession)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the partition
    ordered = ids.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").withColumn("_place", place)
    return common.stored(ordered.where(F.col("_place") % range_rows == 0).select("doc_id").distinct(), "fingerprint-starts")


#: Ids between two starts at most, and ranges per shuffle partition at least: even tasks also on few rows.
RANGE_ROWS, RANGES_A_PARTITION = 10_000, 8


def in_order(documents: DataFrame, range_rows: int | None = None) -> DataFrame:
    """Rows dealt to ranges of ids (``_range``), each followed by the first row of the range below it.

    That row is marked ``_extra``; the lowest range is followed by the very first row of the table. A range starts at
    every ``range_rows``-th id; without that number, as often as the two constants above say. Tasks get the starts as a broadcast array, 8 bytes a range; the first rows are found by a
    join with a table of one id a range, so the plan does not grow with the rows.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # A null among large ids would turn them into doubles, so it is dealt as the least id.
    known = F.coalesce("doc_id", F.lit(-(2**63)))
    if range_rows is None:
        parts = RANGES_A_PARTITION * common.shuffle_partitions(spark)
        range_rows = min(RANGE_ROWS, max(1, documents.count() // parts))
    found = range_starts(rows.select(known.alias("doc_id")), range_rows).toPandas()["doc_id"]
    count = len(found)
    starts = spark.sparkContext.broadcast(np.sort(found.to_numpy(dtype=np.int64)))

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts.value, doc_id.to_numpy(dtype=np.int64), "right") - 1).astype("int32")

    dealt = rows.withColumn("_range", range_of(known))
    # Every range holds its start, so the range above is the next number.
    heads = (
        rows.select("doc_id", range_of(known).alias("_below"))
        .groupBy("_below")
        .agg(F.max("doc_id").alias("_head"))
        .select("_head", ((F.col("_below") + 1) % max(count, 1)).cast("int").alias("_range"))
    )
    heads = common.stored(heads, "fingerprint-heads")
    first = rows.join(heads, rows["doc_id"].eqNullSafe(heads["_head"])).groupBy("doc_id", "_range").agg(F.max("text").alias("text"))
    extra = first.select("doc_id", "text", "_range", F.lit(True).alias("_extra"))
    return dealt.withColumn("_extra", F.lit(False)).unionByName(extra)


def fingerprints(documents: DataFrame, rarest: float = 0.0005, commonest: float = 0.1) -> DataFrame:
    """Fingerprint of each text and its edited text, and their likeness to each other and the next document's."""
    words = documents.sparkSession.sparkContext.broadcast(lexicon(documents, rarest, commonest))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Hashes(words.value)
        held = None  # the row whose next one has not come yet
        for batch in batches:
            out = []
            for doc_id, text, place, extra in zip(batch["doc_id"], batch["text"], batch["_range"], batch["_extra"], strict=True):
                own = fingerprint(terms(text), memo)
                if held is not None and held[2] == place:
                    changed = edited(held[1], text)
                    altered = held[3] if changed == held[1] else fingerprint(terms(changed), memo)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append(
                        (held[0], len(held[1]), digest, held[3], altered, likeness(held[3], altered), likeness(held[3], own))
                    )
                held = None if extra else (doc_id, text, place, own)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    ordered = in_order(documents)
    return (
        ordered.repartition(common.shuffle_partitions(documents.sparkSession), "_range")
        .sortWithinPartitions("_range", "_extra", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
        .select(common.as_text("doc_id", "doc_id"), "text", "_range", "_extra")
        .mapInPandas(run, RESULT)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(common.table(spark, sf_dir, "documents"))
