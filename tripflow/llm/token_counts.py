"""Token counts: byte-pair merges applied to many words at once, rank by rank, on ragged arrays.

The vocabulary's pieces never have a word mark (U+2581) after another character, so a text splits into words,
each a run of marks with what follows, and its count is the sum of its words' counts. The
distinct words of a batch lie one behind the other in one array of symbols. In every step each word
finds its pair of lowest rank (leftmost of equals) and all words merge theirs at the same time; words without a pair are
done. What survives is counted: a symbol of the vocabulary once, any other character by its UTF-8 bytes.

A word too long to go one merge at a time merges all places of its lowest pair in a step when no pair
that arises could come before it, so the steps follow the ranks, not the length. Where one could, as in long runs of blanks,
the rest of that word is merged one place after the other from a queue, in n log n.

Defined results: null and empty texts have 0 bytes and 0 tokens. Ids may be null or repeated; each row is
counted on its own. Texts of any length are counted whole. An empty table gives an empty result. Columns that clash
with the results' names are replaced; others pass through.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")
RESULTS = ("n_bytes", "n_tokens", "over_limit")
NEVER = np.iinfo(np.int64).max
MEMO = 400_000


class Merges:
    """The pairs of a piece vocabulary: which two symbols join to which, and how early."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        normal = [
            i for i in range(library.get_piece_size())
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        ]
        pieces = {library.id_to_piece(i): library.get_score(i) for i in normal}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("the vocabulary has pieces that span words")
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.size = len(pieces)
        found = []
        for piece, score in pieces.items():
            for cut in range(1, len(piece)):
                left, right = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, order[score], self.ids[piece]))
        found.sort()
        self.keys, self.ranks, self.joined = (np.array(c, dtype=np.int64) for c in zip(*found, strict=True))

    def symbol(self, text: str) -> int | None:
        """Number of a piece, or of a single character out of the vocabulary (above all pieces)."""
        number = self.ids.get(text)
        return self.size + ord(text) if number is None and len(text) == 1 else number

    @functools.cached_property
    def table(self) -> dict[int, tuple[int, int]]:
        """Rank and result by pair."""
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.joined.tolist()), strict=True))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, ``NEVER`` if it does not merge, and the symbol it becomes."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.ranks[at], NEVER), self.joined[at]


def count_words(words: list[str], merges: Merges) -> np.ndarray:
    """Tokens of each word (not empty), all merged together."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    text = "".join(words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    distinct, back = np.unique(points, return_inverse=True)
    number = np.array([merges.symbol(chr(p)) for p in distinct], dtype=np.int64)
    symbols = number[back]
    owner = np.repeat(np.arange(len(words)), sizes)
    cost = np.ones(len(points), np.int64)  # tokens a symbol stands for, as long as it is not merged
    unknown = symbols >= merges.size
    p = points[unknown]
    cost[unknown] = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
    total = np.zeros(len(words), np.int64)

    rank, joined = _ranked(symbols, owner, merges)
    while len(symbols):
        # The lowest rank of each word; words are runs of equal owners.
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(rank, start)
        length = np.diff(np.r_[start, len(owner)])
        done = np.repeat(lowest == NEVER, length)
        if done.any():
            np.add.at(total, owner[done], cost[done])
            symbols, owner, cost, rank, joined = (x[~done] for x in (symbols, owner, cost, rank, joined))
            continue
        best = rank == np.repeat(lowest, length)
        places = np.flatnonzero(best)
        leading = places[np.r_[True, owner[places[1:]] != owner[places[:-1]]]]
        chosen, slow = _all_places(places, leading, symbols, owner, rank, joined, length, start, merges)
        if len(slow):
            ends = np.searchsorted(owner, slow), np.searchsorted(owner, slow, "right")
            for word, low, high in zip(slow, *ends, strict=True):
                total[word] += one_by_one(symbols[low:high].tolist(), cost[low:high].tolist(), merges)
            others = ~np.isin(owner, slow)
            symbols, owner, cost, rank, joined = (x[others] for x in (symbols, owner, cost, rank, joined))
            continue
        symbols[chosen] = joined[chosen]
        cost[chosen] = 1
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        # Only pairs at a merged symbol change.
        moved = np.cumsum(keep) - 1
        symbols, owner, cost, rank, joined = (x[keep] for x in (symbols, owner, cost, rank, joined))
        at = moved[chosen]
        changed = np.zeros(len(symbols), bool)
        changed[at] = True
        changed[at[at > 0] - 1] = True
        touched = np.flatnonzero(changed)
        rank[touched], joined[touched] = _ranked_at(touched, symbols, owner, merges)
    return total


def one_by_one(symbols: list[int], cost: list[int], merges: Merges) -> int:
    """Tokens of one word, always merging the leftmost pair of lowest rank next."""
    n, table = len(symbols), merges.table
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    queue: list[tuple[int, int, int, int]] = []

    def offer(left: int, right: int) -> None:
        pair = symbols[left] << 32 | symbols[right]
        if pair in table:
            rank, new = table[pair]
            heapq.heappush(queue, (rank, left, pair, new))

    for i in range(n - 1):
        offer(i, i + 1)
    while queue:
        _, left, pair, new = heapq.heappop(queue)
        right = after[left]
        # Gone: one of both has merged with something else.
        if symbols[left] < 0 or right < 0 or symbols[left] << 32 | symbols[right] != pair:
            continue
        symbols[left], cost[left] = new, 1
        symbols[right], cost[right] = -1, 0
        after[left] = after[right]
        if after[left] >= 0:
            before[after[left]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    return sum(cost)


def _ranked(symbols: np.ndarray, owner: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    return _ranked_at(np.arange(len(symbols)), symbols, owner, merges)


def _ranked_at(at: np.ndarray, symbols: np.ndarray, owner: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of the pair of each place and the next one in the same word."""
    rank, joined = np.full(len(at), NEVER), np.zeros(len(at), np.int64)
    paired = (at + 1 < len(symbols)) & (owner[at] == owner[np.minimum(at + 1, len(symbols) - 1)])
    rank[paired], joined[paired] = merges.pairs(symbols[at[paired]], symbols[at[paired] + 1])
    return rank, joined


def _all_places(places, leading, symbols, owner, rank, joined, length, start, merges, long: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The leftmost place of each word's lowest pair; in long words all its places. Second: long words where that is not safe."""
    if not (length > long).any():
        return leading, leading[:0]
    word_length = np.zeros(int(owner.max()) + 1, np.int64)
    word_length[owner[start]] = length
    many = places[word_length[owner[places]] > long]
    # Overlapping places: in a run of neighbours every second one merges.
    run = np.flatnonzero(np.r_[True, (np.diff(many) > 1) | (owner[many[1:]] != owner[many[:-1]])])
    within = np.arange(len(many)) - np.repeat(run, np.diff(np.r_[run, len(many)]))
    many = many[within % 2 == 0]
    # Pairs that arise: the symbol before with the new one, the new one with what follows, two new ones.
    after = np.minimum(many + 2, len(symbols) - 1)
    before = np.maximum(many - 1, 0)
    fresh = np.zeros(len(symbols), bool)
    fresh[many] = True
    new = joined[many]
    follow = np.where(fresh[after], joined[after], symbols[after])
    lead = np.where(fresh[np.maximum(many - 2, 0)], joined[np.maximum(many - 2, 0)], symbols[before])
    low_after = np.where(owner[after] == owner[many], merges.pairs(new, follow)[0], NEVER)
    low_after_plain = np.where(owner[after] == owner[many], merges.pairs(new, symbols[after])[0], NEVER)
    low_before = np.where(owner[before] == owner[many], merges.pairs(lead, new)[0], NEVER)
    low_before_plain = np.where(owner[before] == owner[many], merges.pairs(symbols[before], new)[0], NEVER)
    arising = np.minimum(np.minimum(low_after, low_before), np.minimum(low_after_plain, low_before_plain))
    unsafe = np.unique(owner[many[arising <= rank[many]]])
    safe = many[~np.isin(owner[many], unsafe)]
    return np.sort(np.concatenate([safe, leading[~np.isin(leading, safe) & ~np.isin(owner[leading], owner[safe])]])), unsafe


class Counts(dict):
    """Tokens per word, filled in by the batch."""

    def add(self, words: set[str], merges: Merges) -> None:
        missing = [w for w in words if w not in self]
        if len(self) + len(missing) > MEMO:
            self.clear()
            missing = list(words)
        for first in range(0, len(missing), 50_000):
            part = missing[first : first + 50_000]
            self.update(zip(part, count_words(part, merges).tolist(), strict=True))


def split_words(text: str) -> list[str]:
    """Words of a text as the vocabulary sees it: a blank in front, blanks as marks."""
    return WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def with_counts(documents: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """``documents`` with ``n_bytes``, ``n_tokens`` and ``over_limit``. ``model``: path of the vocabulary on all machines."""
    kept = [c for c in documents.columns if c not in RESULTS]

    @F.pandas_udf("n_bytes long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        merges, counts = Merges(model), Counts()
        for batch in batches:
            sizes, totals = [], []
            for first in range(0, len(batch), 256):
                split = [split_words(t or "") for t in batch.iloc[first : first + 256]]
                counts.add(set().union(*split), merges)
                totals += [sum(map(counts.__getitem__, words)) for words in split]
            sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in batch]
            yield pd.DataFrame({"n_bytes": sizes, "n_tokens": totals})

    return documents.withColumn("_n", counted("text")).select(*kept, "_n.*", (F.col("_n.n_tokens") > limit).alias("over_limit"))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_counts(documents, model_path()).select("doc_id", "n_bytes", "n_tokens", "over_limit")
