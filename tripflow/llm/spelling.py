"""Spelling variants: each word and the far commoner word that is one edit away.

The letters of a word are a set of (letter, how many-th of its kind): a binary vector. One inserted or deleted
letter changes one component of it, a replaced one two, so near words are within Hamming distance two. PartEnum with
three parts: the components are dealt to three parts by a hash, and vectors that differ in two components agree on
one part entirely. A signature is a part's number and content. One edit also leaves one half of a word as it is,
the first or the last ``m`` letters, ``m`` half the shorter length; the signature carries that half, which keeps
anagrams and words of the same syllables apart. Equal signatures are joined, and the join itself compares the
words, so that only near pairs leave it: no group's pairs are written out.

All joins are asked to sort and merge. Spark takes signatures for about as large as the words' files, though a word has
about nine of them, and words in files for about as large as these, though they are compressed: it would broadcast a gigabyte through the driver.

A word's chain of forms has at most 19 words, as counts grow tenfold at each step, and is followed
by pointer doubling over written tables.

Defined results: a null text has no runs. A null doc_id counts as the empty text in the hash that
deletes letters. Repeated rows count as often as they occur. Texts without words of seven letters, and empty tables, give
no rows. Ties of the commonest near word go to the smallest in code-point order. Only doc_id and text
are read, so other columns cannot clash. Texts and runs of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

PARTS = 3
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: One in so many (id, run) pairs loses a code point.
DROPPED = 31

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(documents: DataFrame) -> DataFrame:
    """Words (``word``, ``n``) of all texts: runs of letters, some of them short of one code point.

    A word of at least seven letters comes from a run of as many, so shorter runs are not even listed.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(rf"([A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}})"), F.lit(1))
    run = F.translate(F.col("_run"), _UPPER, _UPPER.lower())
    crc = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_run")))
    at = F.pmod("_h", F.length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", 1, at), F.substring("_run", at + 2, F.length("_run")))
    return (
        documents.select("doc_id", F.explode(runs).alias("_run"))
        .select("doc_id", run.alias("_run"))
        .select("_run", crc.alias("_h"))
        .select(F.when(F.pmod("_h", F.lit(DROPPED)) == 0, shorter).otherwise(F.col("_run")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))
    )


def _parts(word: Column) -> Column:
    """The content of each part, as one number: the exclusive or of the hashes of its components."""
    letters = F.array_sort(F.split(word, ""))
    components = F.transform(letters, lambda c, i: F.xxhash64(c, i - F.array_position(letters, c)))

    def content(part: int) -> Column:
        of_part = F.filter(components, lambda e: F.pmod(e, F.lit(PARTS)) == part)
        return F.aggregate(of_part, F.lit(0).cast("long"), lambda total, e: total.bitwiseXOR(e))

    return F.array(*[content(p) for p in range(PARTS)])


def signatures(words: DataFrame) -> DataFrame:
    """Rows (key, word, n): each part's content with each half, as one 64-bit number.

    A word may be the shorter or the longer of a pair, so it has halves of both lengths. Equal keys of
    different signatures only cost a comparison.
    """
    word, length = F.col("word"), F.length("word")
    halves = F.array_distinct(F.array(F.floor(length / 2), F.floor((length - 1) / 2))).cast("array<int>")
    sides = F.flatten(
        F.transform(
            halves,
            lambda m: F.array(
                F.struct(m.alias("m"), F.lit(0).alias("side"), F.substring(word, F.lit(1), m).alias("half")),
                F.struct(m.alias("m"), F.lit(1).alias("side"), F.substring(word, -m, m).alias("half")),
            ),
        )
    )
    return (
        words.select("word", "n", F.posexplode(_parts(word)).alias("_part", "_content"))
        .select("word", "n", "_part", "_content", F.explode(sides).alias("_s"))
        .select(F.xxhash64("_part", "_content", "_s.m", "_s.side", "_s.half").alias("key"), "word", "n")
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair (``low`` < ``high``, with their counts) that one edit turns into one another, once."""
    keyed = signatures(words)
    low, high = keyed.alias("l"), keyed.alias("h")
    near = (
        (F.col("l.key") == F.col("h.key"))
        & (F.col("l.word") < F.col("h.word"))
        & (F.abs(F.length("l.word") - F.length("h.word")) <= 1)
        & (F.levenshtein("l.word", "h.word", 1) == 1)
    )
    return (
        low.join(high.hint("merge"), near)
        .select(F.col("l.word").alias("low"), F.col("l.n").alias("low_n"), F.col("h.word").alias("high"), F.col("h.n").alias("high_n"))
        .distinct()
    )


def forms(words: DataFrame) -> DataFrame:
    """Words with ``n_near``, and ``form`` and ``form_n``: the commonest near word, if ten times as common."""
    both = F.array(
        F.struct(F.col("low").alias("word"), F.col("high").alias("other"), F.col("high_n").alias("other_n")),
        F.struct(F.col("high").alias("word"), F.col("low").alias("other"), F.col("low_n").alias("other_n")),
    )
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other"))
    near = (
        near_pairs(words)
        .select(F.inline(both))
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
    )
    is_form = -F.col("best.minus") >= TIMES * F.col("n")
    return words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.minus")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(``word``, ``root``) of every word that has a form: the last word of its chain of forms."""
    found = common.stored(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        # Twice as far along the chain each turn. A word has few near ones, so no root is a hot key.
        further = common.stored(
            found.join(ahead.hint("merge"), "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
            ),
            "spelling-roots",
        )
        found = further.drop("_moved")
        if further.where("_moved").isEmpty():
            return found


def variants(documents: DataFrame) -> DataFrame:
    """Every word with its near words' number, form and root. ``documents`` has doc_id and text."""
    words = common.stored(word_counts(documents.select("doc_id", "text")), "spelling-words")
    formed = common.stored(forms(words), "spelling-forms")
    return formed.join(roots(formed).hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.table(spark, sf_dir, "documents"))
