"""Packing token sequences: a configuration linear program over the histogram of lengths.

Documents become token ids with an end id; longer ones than the capacity are cut so that only
the first piece is shorter. Only the histogram of piece lengths, at most ``capacity`` numbers,
reaches the driver. There the linear program over patterns (multisets of lengths that fit
one sequence) is solved by multiplicative weights: each length has a price that falls as it gets covered, and a
knapsack over the capacity finds the dearest pattern. Scaled so that nothing is covered twice, the pattern counts are rounded
down; what is left goes through the same again until rounding leaves nearly all, and that rest is packed best-fit decreasing.

A pattern used k times gives, for each of its places, k slots of one length in k sequences. Pieces of a
length are numbered in ranges of a hash of their document and take the slots in order, so
that no length, however common, is sorted in one task. The slot table has a row per place of a pattern; its
size follows the patterns, not the documents.

Defined results: a null text is empty and has only the end id. Rows that are repeated or share an id are packed
each on its own (``row`` numbers equal ids, from 0, in the order of their ids' digest). Null ids are kept.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

CAPACITY = 2048
END_ID = 0
#: Letters and marks that no Unicode version since the vocabulary was made has classed anew.
PLAIN = re.compile("[\x00-\x1b\x20-\x7e\xa0-ɏ‐-‧€]*")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of() -> dict[str, int]:
    """Byte values of the visible characters that byte-level vocabularies are written in."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as the ``tokenizers`` library gives them, without added special tokens.

    Plain texts are encoded with the file's vocabulary by ``tiktoken``, which gives the same ids in
    a fifth of the time; texts with characters out of the plain ranges, or with the text of a
    special token, go to ``tokenizers`` itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.library = Tokenizer.from_str(text)
        described = json.loads(text)
        self.special = [t["content"] for t in described["added_tokens"]]
        value = _bytes_of()
        ranks = {
            bytes(value[c] for c in token): number
            for token, number in described["model"]["vocab"].items()
            if token not in self.special
        }
        self.fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``digest`` (CRC-32 of all ids) of each piece.

    ``tokenizer`` is the path of the vocabulary file, the same on all machines.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.concatenate([encoder.ids(text or ""), end])
                digest = zlib.crc32(ids.tobytes())
                first = len(ids) % capacity or capacity
                for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, stop - capacity)
                    crc = zlib.crc32(ids[start:stop].tobytes()) if stop - start < len(ids) else digest
                    out.append((doc_id, piece, start, stop - start, crc, digest))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "digest"])

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, digest long"
    rows = documents.select(common.as_text("doc_id", "doc_id"), "text").mapInPandas(run, schema)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def dearest_pattern(lengths: np.ndarray, values: np.ndarray, capacity: int) -> dict[int, int]:
    """Index -> times of the multiset of lengths of greatest total value that fits the capacity."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(int(lengths[0]), capacity + 1):
        fits = np.searchsorted(lengths, room, "right")
        worth = best[room - lengths[:fits]] + values[:fits]
        k = int(worth.argmax())
        if worth[k] > best[room - 1]:
            best[room], choice[room] = worth[k], k
        else:
            best[room] = best[room - 1]
    out: Counter = Counter()
    room = capacity
    while room >= lengths[0]:
        if choice[room] < 0:
            room -= 1
            continue
        out[int(choice[room])] += 1
        room -= int(lengths[choice[room]])
    return dict(out)


def fractional(
    counts: dict[int, int], first: dict[int, float], capacity: int, rounds: int, sharpness: float
) -> list[tuple[dict[int, int], float]]:
    """Patterns (length -> times) with amounts that cover no length more often than its count.

    Multiplicative weights: the price of a length starts at ``first`` and is multiplied by
    exp(-sharpness * coverage), so that what lags behind gets dearer against the rest.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    needs = np.array([counts[int(v)] for v in lengths], dtype=float)
    start = np.array([first[int(v)] for v in lengths])
    covered = np.zeros(len(lengths))
    amounts: dict[tuple, float] = {}
    for _ in range(rounds):
        pattern = dearest_pattern(lengths, start * np.exp(-sharpness * (covered - covered.min())), capacity)
        index, times = np.array(list(pattern)), np.array(list(pattern.values()))
        amount = float((needs[index] / times).min()) / sharpness
        covered[index] += times * amount / needs[index]
        key = tuple(sorted(pattern.items()))
        amounts[key] = amounts.get(key, 0.0) + amount
    most = covered.max()
    return [({int(lengths[i]): t for i, t in key}, amount / most) for key, amount in amounts.items()]


def best_fit(counts: dict[int, int], capacity: int) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing over a histogram: each length goes to the fullest sequences that have room.

    Sequences of equal content are handled together, so the work follows the lengths, not the counts.
    """
    rooms: list[int] = []  # ascending, with the sequences of each room by content
    groups: dict[int, Counter] = {}

    def put(room: int, content: tuple[int, ...], times: int) -> None:
        if room not in groups:
            bisect.insort(rooms, room)
            groups[room] = Counter()
        groups[room][content] += times

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if left >= each:
                    put(capacity - each * length, (length,) * each, left // each)
                    left %= each
                else:
                    put(capacity - left * length, (length,) * left, 1)
                    left = 0
                continue
            room = rooms[at]
            content, there = groups[room].popitem()
            # As many into each as fit: those would be the fullest ones after the first.
            each = min(room // length, left)
            times = min(there, left // each)
            if times < there:
                groups[room][content] = there - times
            elif not groups[room]:
                del groups[room]
                rooms.pop(at)
            put(room - each * length, content + (length,) * each, times)
            left -= each * times
    out: Counter = Counter()
    for group in groups.values():
        out.update(group)
    return out


def prices(packed: dict[tuple[int, ...], int]) -> dict[int, float]:
    """What a piece of each length costs in a packing: its part of what its sequence holds, on the mean."""
    cost: Counter = Counter()
    pieces_of: Counter = Counter()
    for lengths, times in packed.items():
        filled = sum(lengths)
        for k in lengths:
            cost[k] += times * k / filled
            pieces_of[k] += times
    return {k: cost[k] / pieces_of[k] for k in cost}


def solve(
    counts: dict[int, int], capacity: int = CAPACITY, rounds: int = 150, sharpness: float = 8.0
) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) with the number of sequences of each; all counts are used up.

    The program is solved anew for what rounding leaves, until rounding leaves nearly all; the
    rest is packed best-fit decreasing. The first prices are those of a best-fit packing. Of all turns at which one could
    have left the rest to best-fit, the first too, that with the fewest sequences counts.
    """
    left = {k: v for k, v in counts.items() if v}
    used: Counter = Counter()
    if left.get(capacity):
        used[(capacity,)] = left.pop(capacity)
    best: Counter | None = None
    while left:
        before = sum(left.values())
        packed = best_fit(left, capacity)
        best = _fewer(best, used, packed)
        first = prices(packed)
        for pattern, amount in fractional(left, first, capacity, rounds, sharpness):
            times = min(int(amount), *(left.get(k, 0) // t for k, t in pattern.items()))
            if times:
                for k, t in pattern.items():
                    left[k] -= t * times
                used[tuple(sorted((k for k, t in pattern.items() for _ in range(t)), reverse=True))] += times
        left = {k: v for k, v in left.items() if v}
        if sum(left.values()) > 0.9 * before:  # small counts round to nothing
            break
    return sorted(_fewer(best, used, best_fit(left, capacity)).items(), reverse=True)


def _fewer(best: Counter | None, used: Counter, rest: Counter) -> Counter:
    """``used`` and ``rest`` together, if these are fewer sequences than ``best``."""
    if best is not None and best.total() <= used.total() + rest.total():
        return best
    return used + rest


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """One row per place of a pattern: the slots first .. first + times - 1 of its length are at ``offset``
    in the sequences from ``sequence`` on. Sorted by length and first."""
    rows, next_slot, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, next_slot[length], sequence, offset))
            next_slot[length] += times
            offset += length
        sequence += times
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return dict(zip(("length", "first", "sequence", "offset"), columns, strict=True))


def pack(cut: DataFrame, capacity: int = CAPACITY, range_rows: int = 20_000) -> DataFrame:
    """Give every piece of ``cut`` its ``sequence_id`` and ``offset``; ``row`` tells equal ids apart."""
    cut = common.stored(cut, "packing-pieces")
    histogram = {int(r["length"]): int(r["count"]) for r in cut.groupBy("length").count().collect()}
    table = slots(solve(histogram, capacity))
    ranges = max(1, -(-sum(histogram.values()) // range_rows))
    # Equal lengths are numbered within ranges of a hash; totals of the ranges give their starts.
    in_range = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(ranges))
    ranged = cut.withColumn("_range", in_range)
    order = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = common.stored(
        ranged.groupBy("length", "_range")
        .agg(F.count("*").alias("n"))
        .select("length", "_range", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_start")),
        "packing-starts",
    )
    within = Window.partitionBy("length", "_range").orderBy("doc_id", "digest", "piece")
    numbered = (
        ranged.withColumn("_n", F.row_number().over(within) - 1)
        .join(starts, ["length", "_range"])
        .withColumn("_slot", F.col("_n") + F.col("_start"))
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, slot: pd.Series) -> pd.DataFrame:
        low = np.searchsorted(table["length"], length.to_numpy(), "left")
        high = np.searchsorted(table["length"], length.to_numpy(), "right")
        wanted = slot.to_numpy()
        while (low + 1 < high).any():  # the last place of the length that starts at the slot or before
            middle = (low + high) // 2
            right = (low + 1 < high) & (table["first"][np.minimum(middle, len(table["first"]) - 1)] <= wanted)
            low, high = np.where(right, middle, low), np.where((low + 1 < high) & ~right, middle, high)
        return pd.DataFrame(
            {"sequence_id": table["sequence"][low] + wanted - table["first"][low], "offset": table["offset"][low]}
        )

    return numbered.withColumn("_at", placed("length", "_slot")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("_at.sequence_id").alias("sequence_id"),
        F.col("_at.offset").alias("offset"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(common.table(spark, sf_dir, "documents"), tokenizer_path()))
