"""N-gram Jaccard join: size-banded tiles with bitmap signatures, then exact intersection.

A text's set holds its distinct shingles as 64-bit hashes. Texts of equal sets are one node. Two
nodes can only be linked if they share one of their smallest hashes, so a tile is the nodes that hold a given
hash among their smallest, cut into bands of size: a band's nodes and those of the band below are all that can
reach the threshold. Within a tile, the parity bitmaps of two sets differ in at most as many bits
as the sets differ in shingles, which bounds the overlap from above; what passes is checked on
the sorted arrays.

The smallest hashes kept are ``min(keys, n - ceil(t n) + 1)``. The second number is the prefix that
misses nothing. For larger sets, ``keys`` = 20 hashes in random order miss a link at the very threshold
with a chance of 0.25 ** 20, about 1e-12, and a closer one less often; ``keys=None`` always takes the whole prefix. The
queries use 20, as whole prefixes need more disk than the check tool grants (README).

Hot tiles. In the first rounds every node of a tile is compared with one pivot only, another one in each
tile, which joins nearly all of a large group of copies at linear cost. Later, only nodes that are still in
different components meet, in square cells of at most ``cell`` rows a side, so that a tile of any size is many
small pieces of work; cells emit the pairs that pass the bitmaps, not all pairs, and a pair of several
tiles in one of them only.

Counting links. Components need few of a group's links, a count needs all. With ``count_links`` no pivots are drawn:
cells compare all their nodes and emit those with a pair that passes the bitmaps; these come back to the cell with
their texts, all their passing pairs are checked exactly, and the cell emits a count and a star per node, not pairs.

Defined results: null or empty texts have the empty set and are linked with nothing. Rows with a
null id take part; a component is named by its smallest non-null id, null if it has none. Repeated rows and
equal ids with different texts each stay a row. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common
from tripflow.llm.components import components

LINK_AT = 75  # hundredths
MEMO = 300_000
#: What is kept of a node's row in a cell.
MEMBER = ["tile", "key", "base", "node", "block", "x", "y"]


class WordHashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, width: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words; fewer words are one shingle.

    Splitting bytes cuts at the six ASCII blanks and lowering bytes touches A to Z only.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    size = min(width, n)
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out = common.mixed(out + hashes[k : n - size + 1 + k])
    return np.unique(out)


def band(n: int, threshold: int = LINK_AT) -> int:
    """Sizes a band apart differ by the threshold's ratio, so links reach the next band at most."""
    return int(math.floor(math.log(n) / math.log(100 / threshold) + 1e-9))


def band_bits(level: int, threshold: int = LINK_AT) -> int:
    """Bits of the bitmaps that band ``level`` is compared with: a power of two, twice its sizes or more."""
    return 1 << min(17, max(7, 1 + math.ceil(level * math.log2(100 / threshold) + 1e-9)))


def parity_bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit i is the parity of the number of hashes that fall on it; halves fold together by XOR."""
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def prefix_length(n: int, keys: int | None, threshold: int = LINK_AT) -> int:
    whole = n - (-(-n * threshold // 100)) + 1
    return whole if keys is None else min(keys, whole)


def sketches(documents: DataFrame, width: int = 5, keys: int | None = 20, threshold: int = LINK_AT) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node`` (digest of the set), ``level``, ``keys`` and ``bits`` of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, width, memo) for t in batch["text"]]
            levels = [band(len(s), threshold) if len(s) else -1 for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_hash": batch["text_hash"],
                    "n_shingles": [len(s) for s in sets],
                    "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "level": levels,
                    "keys": [s[: prefix_length(len(s), keys, threshold)].view(np.int64) for s in sets],
                    "bits": [
                        parity_bitmap(s, band_bits(v + 1, threshold)).tobytes() if len(s) else None
                        for s, v in zip(sets, levels, strict=True)
                    ],
                }
            )

    schema = "doc_id string, text_hash long, n_shingles long, node binary, level int, keys array<long>, bits binary"
    rows = documents.select(common.as_text("doc_id", "doc_id"), text_hash(), "text").mapInPandas(run, schema)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def may_link(small: Column, large: Column, threshold: int = LINK_AT) -> Column:
    """Whether the sizes alone allow a link, whichever is larger."""
    return F.least(small, large) * 100 >= F.greatest(small, large) * threshold


def close_bits(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """Of rows (a, b, n_a, n_b, bits_a, bits_b), the pairs whose bitmaps allow a link."""
    for batch in batches:
        keep = []
        for n_a, n_b, x, y in zip(batch["n_a"], batch["n_b"], batch["bits_a"], batch["bits_b"], strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            x, y = folded(x, min(len(x), len(y))), folded(y, min(len(x), len(y)))
            differing = int(np.bitwise_count(x ^ y).sum())
            keep.append(_enough(n_a + n_b, differing, threshold))
        yield batch.loc[keep, ["a", "b"]]


def _enough(total, differing, threshold: int):
    """Overlap is at most (total - differing) / 2, so the similarity at most (total - d) / (total + d)."""
    return 100 * (total - differing) >= threshold * (total + differing)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmap(s) folded to ``words`` 64-bit words along the last axis."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def verified(pairs: DataFrame, texts: DataFrame, width: int = 5, threshold: int = LINK_AT) -> DataFrame:
    """Of ``pairs`` (a, b), those whose sets reach the threshold. ``texts`` has one (node, text) per node."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHashes()
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for a, x, y in zip(batch["a"], batch["text_a"], batch["text_b"], strict=True):
                if a != last:
                    last, left = a, shingle_set(x, width, memo)
                right = shingle_set(y, width, memo)
                common_size = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * common_size >= threshold * (len(left) + len(right) - common_size))
            yield batch.loc[keep, ["a", "b"]]

    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return sides.select("a", "b", "text_a", "text_b").mapInPandas(run, "a binary, b binary")


def cell_pairs(
    tile: np.ndarray, level: np.ndarray, base: np.ndarray, n: np.ndarray, root: np.ndarray, block: np.ndarray,
    diagonal: np.ndarray, bits: np.ndarray, threshold: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs within equal ``tile`` numbers (sorted) that may be linked and are not in one component.

    All tiles are compared at once, rows at distance 1, then 2, and so on, as long as tiles reach. Rows of one
    block meet in the cell on the diagonal only.
    """
    left, right = [], []
    at = np.arange(len(tile))
    step = 1
    while len(at):
        at = at[at + step < len(tile)]
        at = at[tile[at] == tile[at + step]]
        i, j = at, at + step
        own = (level[i] == base[i]) | (level[j] == base[j])
        sized = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * threshold
        picked = own & sized & (root[i] != root[j]) & (diagonal[i] | (block[i] != block[j]))
        i, j = i[picked], j[picked]
        if len(i):
            differing = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1).astype(np.int64)
            enough = _enough(n[i] + n[j], differing, threshold)
            left.append(i[enough])
            right.append(j[enough])
        step += 1
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def least_common(cells: np.ndarray, key: np.ndarray, keys: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows (i, j), each of one cell, share no key below that of their tile.

    The lower keys that several rows of a cell hold are numbered, and each row's are the bits of its words.
    """
    lower = [k[k < own] for k, own in zip(keys, key, strict=True)]
    row = np.repeat(np.arange(len(lower)), [len(k) for k in lower])
    held = pd.DataFrame({"row": row, "cell": cells[row], "key": np.concatenate([np.empty(0, np.int64), *lower])})
    held = held[held.duplicated(["cell", "key"], keep=False)].sort_values(["cell", "key"], kind="stable")
    new = ~held.duplicated(["cell", "key"]).to_numpy()
    number = np.cumsum(new)
    number = number - held.assign(n=number).groupby("cell")["n"].transform("min").to_numpy()
    words = np.zeros((int(number.max(initial=-1)) // 64 + 1, len(lower)), np.uint64)
    np.bitwise_or.at(words, (number // 64, held["row"].to_numpy()), np.uint64(1) << (number % 64).astype(np.uint64))
    found = np.ones(len(i), bool)
    for word in words:
        found &= (word[i] & word[j]) == 0
    return found


def _tile_search(threshold: int, members: bool = False):
    """Over rows sorted by cell, the pairs (a, b) of nodes that pass size and bitmaps, each in the tile of their least common key.

    With ``members``, the rows of the nodes that have such a pair in the cell.
    """

    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        cells = frame.groupby(["tile", "x", "y"], sort=False).ngroup().to_numpy()
        bases = frame["base"].to_numpy()
        words = np.array([band_bits(int(v), threshold) // 64 for v in bases])
        diagonal = (frame["x"] == frame["y"]).to_numpy()
        nodes, key, keys = frame["node"].to_numpy(), frame["key"].to_numpy(), frame["keys"].to_numpy()
        for size in np.unique(words):
            rows = np.flatnonzero(words == size)
            bits = np.stack([folded(np.frombuffer(b, np.uint64), size) for b in frame["bits"].to_numpy()[rows]])
            i, j = cell_pairs(
                cells[rows],
                frame["level"].to_numpy()[rows],
                bases[rows],
                frame["n"].to_numpy()[rows],
                pd.factorize(frame["root"])[0][rows],
                frame["block"].to_numpy()[rows],
                diagonal[rows],
                bits,
                threshold,
            )
            i, j = rows[i], rows[j]
            first = least_common(cells, key, keys, i, j)
            i, j = i[first], j[first]
            out.append(np.union1d(i, j) if members else pd.DataFrame({"a": nodes[i], "b": nodes[j]}))
        if members:
            return frame.loc[np.concatenate(out), MEMBER]
        found = pd.concat(out)
        swap = found["a"].to_numpy() > found["b"].to_numpy()
        found.loc[swap, ["a", "b"]] = found.loc[swap, ["b", "a"]].to_numpy()
        return found

    return _by_whole_cells(pairs)


def _by_whole_cells(work: Callable[[pd.DataFrame], pd.DataFrame]):
    """Over batches sorted by cell, ``work`` on frames that hold cells as a whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            last = batch.iloc[-1][["tile", "x", "y"]]
            open_cell = ((batch["tile"] == last["tile"]) & (batch["x"] == last["x"]) & (batch["y"] == last["y"])).to_numpy()
            held = batch[open_cell]
            if not open_cell.all():
                yield work(batch[~open_cell].reset_index(drop=True))
        if held is not None and len(held):
            yield work(held.reset_index(drop=True))

    return run


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j) of ``sets``: pair by pair, or for many pairs as products of
    the incidence matrix of the shingles that several sets hold."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    width = int((times > 1).sum())
    # Rough seconds: a pair costs some 20 us and 20 ns a shingle, the product 2e10 operations a second.
    if (2e-5 * len(i) + 2e-8 * int((sizes[i] + sizes[j]).sum())) < 1e-10 * width * len(sets) ** 2:
        return np.array(
            [len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(i.tolist(), j.tolist(), strict=True)], int
        )
    total = np.zeros((len(sets), len(sets)), np.float64)
    step = max(64, (1 << 22) // len(sets))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, width, step):
        part = slice(*np.searchsorted(column, [low, low + step]))
        held = np.zeros((len(sets), step), np.float32)
        held[row[part], column[part] - low] = 1
        total += held @ held.T
    return total[i, j].astype(int)


def _link_counts(width: int, keys: int | None, threshold: int):
    """Over rows of ``MEMBER`` with text and copies, sorted by cell: (node, root, links) of the nodes with links.

    ``links`` counts the documents of the nodes linked in this cell, ``root`` is a node reached by such links.
    """

    def of_cell(frame: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        n = np.array([len(s) for s in sets])
        base = int(frame["base"].iloc[0])
        level = np.array([band(v, threshold) for v in n])
        same = np.zeros(len(frame), np.int64)
        diagonal = (frame["x"] == frame["y"]).to_numpy()
        bits = np.stack([parity_bitmap(s, band_bits(base, threshold)) for s in sets])
        i, j = cell_pairs(
            same, level, same + base, n, np.arange(len(frame)), frame["block"].to_numpy(), diagonal, bits, threshold
        )
        prefixes = [s[: prefix_length(len(s), keys, threshold)].view(np.int64) for s in sets]
        first = least_common(same, frame["key"].to_numpy(), prefixes, i, j)
        i, j = i[first], j[first]
        both = overlaps(sets, i, j)
        linked = 100 * both >= threshold * (n[i] + n[j] - both)
        i, j = i[linked], j[linked]
        copies = frame["copies"].to_numpy()
        links = np.zeros(len(frame), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = np.arange(len(frame))
        while (root[i] != root[j]).any():
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, root[i], low)
            np.minimum.at(root, root[j], low)
            root = root[root]
        nodes = frame["node"].to_numpy()
        return pd.DataFrame({"node": nodes, "root": nodes[root], "links": links})[links > 0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHashes()

        def work(frame: pd.DataFrame) -> pd.DataFrame:
            cells = (cell.reset_index(drop=True) for _, cell in frame.groupby(["tile", "x", "y"], sort=False))
            return pd.concat([of_cell(c, [shingle_set(t, width, memo) for t in c["text"]]) for c in cells])

        yield from _by_whole_cells(work)(batches)

    return run


def tiles(nodes: DataFrame, threshold: int = LINK_AT) -> DataFrame:
    """(tile, key, base, node, n, level) of the tiles with two nodes or more.

    A node is in the tiles of its own band and, as the smaller partner, of the band above.
    """
    keyed = nodes.select("node", F.col("n_shingles").alias("n"), "level", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    rows = common.stored(keyed.join(shared, "key"), "jaccard-keys")
    banded = rows.withColumn("base", F.explode(F.array(F.col("level"), F.col("level") + 1)))
    return banded.select(F.xxhash64("key", "base").alias("tile"), "key", "base", "node", "n", "level")


def pivot_pairs(tiled: DataFrame, nodes: DataFrame, roots: DataFrame, turn: int, threshold: int = LINK_AT) -> DataFrame:
    """Pairs of each tile's pivot and the tile's other nodes that size and bitmaps let pass.

    The pivot is the own-band node that comes first by a hash of tile, node and turn, so that a node meets
    another pivot in each of its tiles. Nodes that are in the pivot's component already are left out.
    """
    rooted = tiled.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    draw = F.struct(F.xxhash64("tile", "node", F.lit(turn)), "node", "root")
    pivots = rooted.where("level = base").groupBy("tile").agg(F.min(draw).alias("p"))
    pairs = (
        rooted.join(pivots.select("tile", "p.node", "p.root").toDF("tile", "pivot", "pivot_root"), "tile")
        .where("root <> pivot_root")
        .select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
        .distinct()
    )
    sized = nodes.select("node", F.col("n_shingles").alias("n"), "bits")
    return (
        pairs.join(sized.toDF("a", "n_a", "bits_a"), "a")
        .join(sized.toDF("b", "n_b", "bits_b"), "b")
        .where(may_link(F.col("n_a"), F.col("n_b"), threshold))
        .mapInPandas(lambda batches: close_bits(batches, threshold), "a binary, b binary")
    )


def candidate_pairs(
    tiled: DataFrame, nodes: DataFrame, roots: DataFrame, cell: int = 1024, threshold: int = LINK_AT, members: bool = False
) -> DataFrame:
    """Pairs of one tile, in different components so far, that pass size and bitmaps; each pair once.

    With ``members``, the cells' rows of the nodes of such pairs instead.
    """
    rooted = tiled.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_tiles = (
        rooted.groupBy("tile")
        .agg(F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high"),
             F.max((F.col("level") == F.col("base")).cast("int")).alias("own"))
        .where("low <> high AND own = 1")
        .select("tile", F.ceil(F.col("rows") / cell).cast("int").alias("sides"))
    )
    # Row block i of a tile with s blocks meets all blocks: cells (min(i, j), max(i, j)).
    block = F.pmod(F.xxhash64("node"), F.col("sides")).cast("int")
    spread = (
        rooted.join(open_tiles, "tile")
        .withColumn("i", block)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .select(
            "tile", "key", "base", "node", "n", "level", "root", F.col("i").alias("block"),
            F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"),
        )
    )
    with_bits = spread.join(nodes.select("node", "keys", "bits"), "node")
    return (
        with_bits.repartition("tile", "x", "y")
        .sortWithinPartitions("tile", "x", "y")
        .mapInPandas(
            _tile_search(threshold, members),
            "tile long, key long, base int, node binary, block int, x int, y int" if members else "a binary, b binary",
        )
    )


def join(
    documents: DataFrame, width: int = 5, keys: int | None = 20, threshold: int = LINK_AT, cell: int = 1024,
    pivot_rounds: int = 2, count_links: bool = False,
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``stays`` of each row, ``links`` if counted.

    ``stays`` marks one text of each component: that of its smallest id. Texts with the empty set all stay.
    ``links`` is the number of other rows, exact copies among them, whose set reaches the threshold with the row's;
    all of them are counted, which takes no pivots.
    """
    spark = documents.sparkSession
    sketched = common.stored(sketches(documents, width, keys, threshold), "jaccard-sketches")
    filled = sketched.where("node IS NOT NULL")
    nodes = common.stored(
        filled.groupBy("node").agg(
            F.first("n_shingles").alias("n_shingles"),
            F.first("level").alias("level"),
            F.first("keys").alias("keys"),
            F.first("bits").alias("bits"),
            F.min("doc_id").alias("doc_id"),
            F.count("*").alias("copies"),
        ),
        "jaccard-nodes",
    )
    tiled = common.stored(tiles(nodes, threshold), "jaccard-tiles")

    links = []
    roots = spark.createDataFrame([], "node binary, root binary")
    if count_links:
        members = common.stored(candidate_pairs(tiled, nodes, roots, cell, threshold, members=True), "jaccard-members")
        texts = _texts(members.select("node").distinct(), nodes, documents, width)
        counted = common.stored(
            members.join(texts, "node")
            .join(nodes.select("node", "copies"), "node")
            .repartition("tile", "x", "y")
            .sortWithinPartitions("tile", "x", "y")
            .mapInPandas(_link_counts(width, keys, threshold), "node binary, root binary, links long"),
            "jaccard-counts",
        )
        roots = components(counted.select(F.col("root").alias("a"), F.col("node").alias("b")))
        return _named(sketched, nodes, roots, counted.groupBy("node").agg(F.sum("links").alias("links")))

    for turn in range(pivot_rounds):
        close = pivot_pairs(tiled, nodes, roots, turn, threshold)
        links.append(common.stored(_check(close, nodes, documents, width, threshold), "jaccard-pivot-links"))
        # Between the turns roots only spare comparisons, so one round will do.
        roots = components(functools.reduce(DataFrame.union, links), None if turn == pivot_rounds - 1 else 1)
    rest = candidate_pairs(tiled, nodes, roots, cell, threshold)
    links.append(common.stored(_check(rest, nodes, documents, width, threshold), "jaccard-links"))
    roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(links[-1]))

    return _named(sketched, nodes, roots, nodes.select("node", F.lit(0).alias("links")).limit(0)).drop("links")


def _named(sketched: DataFrame, nodes: DataFrame, roots: DataFrame, links: DataFrame) -> DataFrame:
    """The rows with their component and links; ``links`` has the linked documents of a node, without its own copies."""
    named = nodes.select("node", "doc_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The smallest id, nulls last, and of equal ids the smallest node.
    first_node = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"), first_node["node"].alias("first_node"))
    by_node = (
        named.join(smallest, "root")
        .join(links, "node", "left")
        .select(
            "node",
            "component_id",
            F.when(F.col("node") == F.col("first_node"), F.struct("doc_id")).alias("stays"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    return (
        sketched.select("doc_id", "text_hash", "n_shingles", "node")
        .join(common.stored(by_node, "jaccard-components"), "node", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("links", F.lit(0)).alias("links"),
            (F.col("node").isNull() | (F.col("stays").isNotNull() & F.col("doc_id").eqNullSafe(F.col("stays.doc_id")))).alias(
                "stays"
            ),
        )
    )


def _check(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, width: int, threshold: int) -> DataFrame:
    """Fetch the texts of the pairs' nodes, one each, and compare their sets."""
    pairs = common.stored(pairs, "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    return verified(pairs, _texts(wanted, nodes, documents, width), width, threshold)


def _texts(wanted: DataFrame, nodes: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """One (node, text) for each node of ``wanted``."""
    owners = wanted.join(nodes.select("node", "doc_id"), "node")
    # Equal ids may carry different texts, so the text is matched by its set as well.
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    texts = rows.join(owners, rows["doc_id"].eqNullSafe(owners["doc_id"])).select("node", "text")

    def same_set(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, width, memo) for t in batch["text"]]
            yield batch[[xxhash.xxh3_128_digest(s.tobytes()) == k for s, k in zip(sets, batch["node"], strict=True)]]

    texts = texts.mapInPandas(same_set, "node binary, text string").groupBy("node").agg(F.first("text").alias("text"))
    return common.stored(texts, "jaccard-texts")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = join(common.table(spark, sf_dir, "documents"), count_links=True)
    return found.select("doc_id", "n_shingles", "component_id", "links")


SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                      ELSE list_distinct([w[i:i + 4] FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, r.component_id, coalesce(l.links, 0) AS links
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON s.doc_id = r.a
LEFT JOIN (SELECT a, count(*) AS links FROM links GROUP BY a) l ON s.doc_id = l.a
"""
