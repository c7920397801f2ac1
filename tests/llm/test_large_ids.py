"""Ids beyond 2^53 beside null ids: none may change on its way through a task."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tripflow.llm import fingerprint, jaccard, packing, warc

LARGE = [2**53 + k for k in (1, 3, 5, 7, 9)] + [2**63 - 1, -(2**53) - 1, 0, None]


def texts():
    draw = random.Random(2)
    base = ["".join(draw.choices("abcdef", k=4)) for _ in range(60)]
    some = [" ".join(base), " ".join([*base[:59], "other"]), " ".join(base[::-1]), "alone in here", "", " ".join(base)]
    return [*some, "x y z", None, " ".join(base)]


@pytest.fixture(scope="module")
def documents(spark):
    # One batch, so that null and large ids share it.
    return spark.createDataFrame(list(zip(LARGE, texts())), "doc_id long, text string").coalesce(1)


def test_jaccard_join(spark, documents):
    found = {r["doc_id"]: (r["links"], r["component_id"]) for r in jaccard.join(documents, count_links=True).collect()}
    assert set(found) == set(LARGE)
    group = [LARGE[0], LARGE[1], LARGE[5], None]
    assert all(found[i] == (3, LARGE[0]) for i in group)
    assert all(found[i] == (0, i) for i in LARGE if i not in group)


def test_packing(spark, documents):
    found = packing.pieces(documents, packing.tokenizer_path()).collect()
    encoder = packing.Encoder(packing.tokenizer_path())
    expected = {
        (i, zlib.crc32(encoder.ids(t or "").tobytes() + packing.END_ID.to_bytes(4, "little"))) for i, t in zip(LARGE, texts())
    }
    assert {(r["doc_id"], r["ids_crc32"]) for r in found} == expected
    assert {r["doc_id"] for r in packing.pack(packing.pieces(documents, packing.tokenizer_path())).collect()} == set(LARGE)


def test_fingerprints(spark, documents):
    found = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in fingerprint.fingerprints(documents).collect()}
    by_id = dict(zip(LARGE, texts()))
    order = [*sorted((i for i in LARGE if i is not None), reverse=True), None]
    for i, following in zip(order, [*order[1:], order[0]]):
        text, other = by_id[i] or "", by_id[following] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert found[i] == (len(text), hashlib.sha256(edited.encode()).hexdigest())


def test_warc(spark, tmp_path):
    rows = [(i, "http://a/", t) for i, t in zip(LARGE, texts())]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    found = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.op2_warc(spark, str(tmp_path)).collect()}
    by_id = dict(zip(LARGE, texts()))
    for i, text in by_id.items():
        alike = [j for j, t in by_id.items() if j is not None and (t or "") == (text or "")]
        largest = max(alike)
        kind = ("response", None) if i == largest else ("revisit", largest)
        assert found[i] == (*kind, len(text or ""))
