from __future__ import annotations

import itertools
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from tripflow.llm import components, jaccard, mixing, topk, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def oracle(sql: str, sf: str, *tables: str):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.sql(sql).df()


def rows(frame, *columns: str) -> list[tuple]:
    plain = lambda v: None if pd.isna(v) else v
    return sorted(
        (tuple(plain(v) for v in r) for r in frame[list(columns)].astype(object).itertuples(index=False)), key=str
    )


@pytest.mark.parametrize(
    ("module", "query", "tables", "columns"),
    [
        (jaccard, "op7_jaccard_join", ["documents"], ["doc_id", "n_shingles", "component_id"]),
        (mixing, "op4_mixing", ["documents"], ["doc_id", "size", "source_size", "target", "taken"]),
        (topk, "op3_topk", ["embeddings"], ["query_id", "rank", "vec_id", "score"]),
        (warc, "op2_warc", ["pages"], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]),
    ],
)
def test_query_equals_sql(spark, sf, module, query, tables, columns):
    mine = getattr(module, query)(spark, sf).toPandas()
    assert rows(mine, *columns) == rows(oracle(module.SQL, sf, *tables), *columns)


def brute_components(texts: dict[int, str | None]) -> dict[int, int]:
    def shingles(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        inter = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * inter >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {k: low if r == high else r for k, r in root.items()}
    return root


def near_copies(seed: int, groups: int, size: int, words: int, edits: int) -> list[str]:
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    out = []
    passage = [word() for _ in range(60)]
    for _ in range(groups):
        base = [word() for _ in range(words)] + passage
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(edits + 1)):
                copy[draw.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("cell", [4, 1024])
def test_jaccard_against_all_pairs(spark, cell):
    texts = near_copies(3, 6, 12, 120, 6) + near_copies(4, 4, 6, 3, 1) + ["a b", "A b", "a\tb ", "", None, "a b c d e"] * 2
    data = [(i * 3 + 1, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = jaccard.join(spark.createDataFrame(data, DOCS), cell=cell).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_components({d[0]: d[1] for d in data})
    stays = [r["component_id"] for r in found if r["stays"]]
    assert sorted(stays) == sorted({r["component_id"] for r in found})


def test_jaccard_without_pivots_finds_the_same(spark):
    data = [(i, t) for i, t in enumerate(near_copies(5, 5, 8, 80, 5))]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    runs = [sorted((r["doc_id"], r["component_id"]) for r in jaccard.join(frame, pivot_rounds=p, keys=k, cell=5).collect())
            for p, k in ((0, None), (1, 20))]
    assert runs[0] == runs[1]


def test_jaccard_odd_rows(spark):
    data = [(None, "one two three four five six"), (7, "one two three four five six"), (7, "one two three four five six"),
            (7, "quite another text of seven words here"), (None, None), (9, "")]
    found = jaccard.join(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == sorted(
        [("None", 2, "7"), ("7", 2, "7"), ("7", 2, "7"), ("7", 3, "7"), ("None", 0, "None"), ("9", 0, "9")]
    )
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bitmap_bound_never_rejects_a_link():
    draw = np.random.default_rng(2)
    for _ in range(300):
        n = int(draw.integers(1, 400))
        base = draw.integers(0, 2**63, n, dtype=np.uint64)
        other = np.unique(np.r_[base[: n - n // 8], draw.integers(0, 2**63, int(draw.integers(0, n // 8 + 1)), dtype=np.uint64)])
        base = np.unique(base)
        bits = min(jaccard.band_bits(jaccard.band(len(s)) + 1) for s in (base, other))
        differing = int(np.bitwise_count(jaccard.parity_bitmap(base, bits) ^ jaccard.parity_bitmap(other, bits)).sum())
        inter = len(np.intersect1d(base, other))
        if 100 * inter >= 75 * (len(base) + len(other) - inter):
            assert jaccard._enough(len(base) + len(other), differing, 75)
        wide = jaccard.parity_bitmap(base, bits * 4)
        assert (jaccard.folded(wide, bits // 64) == jaccard.parity_bitmap(base, bits)).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_components_of_random_links(spark):
    draw = random.Random(11)
    pairs = [(draw.randrange(120), draw.randrange(120)) for _ in range(90)] + [(7, i) for i in range(200, 260)]
    root = {n: n for p in pairs for n in p}
    for a, b in pairs:
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    links = spark.createDataFrame([*pairs, *pairs[:9], (None, 4)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert found == {n: r for n, r in root.items() if r != n}
    early = components.components(links, rounds=1).collect()
    assert len(early) == len({r["node"] for r in early})
    assert all(root[r["node"]] == root[r["root"]] and r["root"] < r["node"] for r in early)
    assert components.components(links.limit(0)).count() == components.components(links.limit(0), rounds=1).count() == 0


def test_mix_targets_turns_and_odd_rows(spark):
    draw = random.Random(1)
    data = [(i, " ".join(["w"] * draw.randrange(30)), "en", s, 0)
            for i, s in enumerate(draw.choices(["a", "b", "c", None], [8, 1, 1, 1], k=600))]
    data += [(1, "x y", "en", "a", 0)] * 3 + [(None, None, "en", "a", 0), (5000, "", "en", "empty", 0)]
    frame = spark.createDataFrame(data, DOCS).selectExpr("*", "'mine' AS target", "0 AS taken")
    runs = [sorted(map(str, mixing.mix(frame, range_rows=n).select("doc_id", "source", "size", "target", "taken").collect()))
            for n in (7, 10_000)]
    assert runs[0] == runs[1]
    found = mixing.mix(frame).collect()
    assert len(found) == len(data)
    total = sum(r["size"] for r in found)
    per_source = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        per_source.setdefault(r["source"], [r["target"], r["source_size"], 0])[2] += r["taken"]
    assert sum(t for t, _, _ in per_source.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s and abs(t - taken) <= 60 for t, s, taken in per_source.values())
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_topk_odd_vectors(spark):
    nan = float("nan")
    data = [(0, [0.1, 0.2]), (50, [0.1, 0.2]), (50, [0.1, 0.2]), (1, [1e307, 1e300]), (2, [nan]), (3, None), (4, []),
            (5, [None, 0.5]), (100, [-0.1, 0.3, 0.5]), (None, [0.1])]
    use = topk.usable(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    found = topk.search(use.where("vec_id % 50 = 0"), use, query_block=1, row_block=2).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(a, b) for a in (0, 50, 100) for b in (0, 1, 4, 50, 100) if a != b}
    scores = {(r["query_id"], r["vec_id"]): (r["rank"], r["score"]) for r in found}
    assert scores[0, 1] == (1, 2**63 - 1) and scores[0, 50] == (2, 25 * 25 + 51 * 51) and scores[0, 100] == (3, 25 * -26 + 51 * 76)
    assert topk.search(use.limit(0), use).count() == 0


def test_warc_round_trip(spark, tmp_path):
    long = "é\r\n\r\nWARC/1.1\r\n" * 9000
    data = [(1, "u", "x"), (2, "u", "x"), (3, None, None), (4, "", ""), (5, "a\nb", long), (5, "a\nb", long), (None, "u", "x"),
            (5, "z", "other"), (9, "q", "other"), (10, "q", "0\r\n\r\n")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    warc.write(pages, f"{tmp_path}/w", segment_bytes=1000, chunk_bytes=37, records_per_file=3)
    found = warc.read(spark, f"{tmp_path}/w").collect()
    assert len(found) == len(data) and all(r["problem"] is None for r in found)
    kept = sorted(r["payload"].decode() for r in found if r["record_type"] == "response")
    assert kept == sorted({d[2] or "" for d in data})
    revisits = sorted((r["record_id"], r["refers_to"]) for r in found if r["record_type"] == "revisit")
    assert revisits == [("<urn:x-page:1:0>", "<urn:x-page:2:0>"), ("<urn:x-page:3:0>", "<urn:x-page:4:0>"),
                        ("<urn:x-page:5:1>", "<urn:x-page:5:0>"), ("<urn:x-page:5:2>", "<urn:x-page:9:0>"),
                        ("<urn:x-page::0>", "<urn:x-page:2:0>")]
    warc.write(pages, f"{tmp_path}/v", least_revisit_bytes=2)
    assert {r["record_id"] for r in warc.read(spark, f"{tmp_path}/v").where("record_type = 'revisit'").collect()} == {
        "<urn:x-page:5:1>", "<urn:x-page:5:2>"}
    warc.write(pages.limit(0), f"{tmp_path}/empty")
    assert warc.read(spark, f"{tmp_path}/empty").count() == 0


def test_warc_damaged_segments_are_reported(spark, tmp_path):
    page = spark.createDataFrame([(1, "u", "abc" * 900)], "page_id long, url string, html string")
    warc.write(page, f"{tmp_path}/w", segment_bytes=1000)
    text = max((tmp_path / "w").glob("part-*.txt"), key=lambda f: f.stat().st_size).read_bytes()
    cut = text.index(b"WARC/1.1\r\nWARC-Type: continuation")
    again = text.index(b"WARC/1.1\r\nWARC-Type: continuation", cut + 1)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "part-0.warc").write_bytes(text[:cut] + text[again:])
    row = warc.read(spark, f"{tmp_path}/d").first()
    assert row["problem"] == "segments missing or repeated" and row["payload"] is None


@pytest.mark.parametrize("cell", [7, 1024])
def test_jaccard_counts_all_links(spark, cell):
    """Groups of near copies that one pivot joins: every link counts, copies too, whatever the component needs."""
    texts = near_copies(6, 3, 30, 120, 3) + near_copies(7, 3, 5, 60, 9) + ["a b", "A b", "a\tb ", "", None, "a b c d e"] * 2
    sets = [set(jaccard.shingle_set(t, 5, jaccard.WordHashes()).tolist()) for t in texts]
    linked = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    counts = [sum(linked(s, t) for t in sets) - bool(s) for s in sets]
    assert max(counts) > 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in jaccard.join(frame, cell=cell, count_links=True).collect()}
    assert [found[i]["links"] for i in range(len(texts))] == counts
    assert {i: r["component_id"] for i, r in found.items()} == brute_components(dict(enumerate(texts)))
    components_only = jaccard.join(frame, cell=cell)
    assert "links" not in components_only.columns
    assert {tuple(r) for r in components_only.collect()} == {
        tuple(r[c] for c in components_only.columns) for r in found.values()}


def test_op7_returns_the_links_of_sql(spark, sf):
    head = jaccard.SQL[: jaccard.SQL.index("), reach AS")]
    sql = head + ") SELECT d.doc_id, count(l.b) AS links FROM documents d LEFT JOIN links l ON l.a = d.doc_id GROUP BY d.doc_id"
    mine = jaccard.op7_jaccard_join(spark, sf).toPandas()
    assert rows(mine, "doc_id", "links") == rows(oracle(sql, sf, "documents"), "doc_id", "links")


def test_overlaps_both_ways():
    draw = np.random.default_rng(5)
    sets = [np.unique(draw.integers(0, 90, 60).astype(np.uint64)) for _ in range(40)]
    i, j = np.triu_indices(40, 1)
    expected = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert jaccard.overlaps(sets, i, j).tolist() == expected
    assert [jaccard.overlaps(sets, i[k : k + 1], j[k : k + 1])[0] for k in range(9)] == expected[:9]
