from __future__ import annotations

import hashlib
import itertools
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm import common, fingerprint, html_text, packing, quality, token_counts, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HARD = [
    None, "", " ", "  ", "a", "  hello   world \n x\t y", "aaaaaaaaaaaaaaaa" * 40, "ababab" * 100, "日本語のテキスト" * 50,
    "\U0001f642é\xa0<s> </s>▁▁a ▁", "\x00a\x00\x1c\x1d", "<|endoftext|> x", " " * 1000, "a" + " " * 777 + "b", "th" * 3000,
    "it's I'LL 12345 ½ ǅ ß​", "x\n\n\n\n  y" * 30,
    *("".join(random.Random(k).choice("aeinorst ") for _ in range(60 + 9 * k)) for k in range(40)),
    "".join(random.Random(5).choice("ab") for _ in range(3000)),
]


# --- toxicity ------------------------------------------------------------------------------


def brute_segments(hits, cost):
    """All maximal segments by their definition: best total in a stretch, then left and right of it."""
    if not hits:
        return []
    best = None
    for i, j in itertools.combinations_with_replacement(range(len(hits)), 2):
        total = sum(s for _, s in hits[i : j + 1]) - cost * (hits[j][0] - hits[i][0] - (j - i))
        if best is None or total > best[0] + 1e-12:
            best = (total, i, j)
    total, i, j = best
    return [*brute_segments(hits[:i], cost), (total, hits[i][0], hits[j][0] + 1), *brute_segments(hits[j + 1 :], cost)]


def test_segments_are_all_maximal_ones():
    draw = random.Random(7)
    for _ in range(200):
        places = sorted(draw.sample(range(200), draw.randrange(1, 14)))
        hits = [(p, draw.random() * 3 + 0.1) for p in places]
        mine = toxicity.segments(hits, 0.11)
        expected = brute_segments(hits, 0.11)
        assert [(a, b) for _, a, b in mine] == [(a, b) for _, a, b in expected]
        assert [s for s, _, _ in mine] == pytest.approx([s for s, _, _ in expected])


def corpus(n=900):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("bcdfg") + draw.choice("aeiou") for _ in range(3))
    docs, labels = [], []
    for i in range(n):
        bad = i % 7 == 0
        poor = i % 5 == 0
        words = [word() for _ in range(draw.randrange(30, 90))]
        if bad:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), "vexu" + draw.choice(["lon", "tar", "mi", "da", "pel"]) + draw.choice("aeiou"))
        text = " ".join(w.upper() + "!!" for w in words) if poor else " ".join(words) + "."
        docs.append((i, text, "en" if i % 2 else None, f"s{i % 4}" if i % 4 else None, len(text)))
        if i % 3:
            labels.append((i, int(not poor), int(bad)))
    docs += [(n, None, None, None, 0), (n + 1, "", "en", "s1", 0), (None, "VEXUlona vexutari", "en", "s1", 0), docs[6], docs[6]]
    return docs, labels


def tables(spark, n=900):
    docs, labels = corpus(n)
    return (
        spark.createDataFrame(docs, DOCS).selectExpr("*", "'mine' AS score", "1 AS upper"),
        spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"),
    )


def test_toxicity_finds_stems_in_unseen_words(spark):
    docs, labels = tables(spark)
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 905
    held = [i for i in range(900) if not i % 3]
    right = sum((by_id[i]["score"] >= 0.7) == (i % 7 == 0) for i in held)
    assert right / len(held) > 0.97
    assert by_id[900]["score"] == by_id[901]["score"] < 0.7 <= by_id[None]["score"]
    assert all(0 <= r["score"] <= 1 for r in found)


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = tables(spark, 30)
    empty = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, empty).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), empty).count() == 0


def test_toxicity_finds_a_passage_of_words_said_before():
    model = toxicity.Model({w: 5.0 for w in ("va", "ve", "vi", "vo", "vu")}, 0.01, 1.0, 0.1, 0.1)
    singly = ["a"] * 20_000
    for k, w in enumerate(model.scores):
        singly[100 + 3000 * k] = w
    judge = lambda words: toxicity.judge(model, " ".join(words), toxicity.Lexicon(model.scores))
    assert judge(singly)[0] < 0.2
    score, n, passages = judge([*singly, *model.scores, *["a"] * 50])
    assert score > 0.99 and (25.0, 20_000, 20_005) in passages
    # Singly just before the passage: one gap is lost at most.
    near = ["a"] * 20_000
    for k, w in enumerate(model.scores):
        near[19_600 + 90 * k] = w
    assert max(s for s, _, _ in judge([*near, *model.scores])[2]) > 20
    # One word again and again is one word's evidence.
    assert judge((["va"] + ["a"] * 600) * 40)[0] == judge(["va"] + ["a"] * (601 * 40 - 1))[0]


def test_toxicity_learns_where_most_labels_are_toxic(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("bcdfg") + draw.choice("aeiou") for _ in range(3))
    bad = lambda: "vexu" + draw.choice(["lon", "tar", "mi", "da", "pel"]) + draw.choice("aeiou")
    data = [(i, " ".join([word() for _ in range(50)] + [bad() for _ in range(4 * (i % 5 < 3))])) for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 < 3)) for i in range(900) if i % 3], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    held = [r for r in found if not r["doc_id"] % 3]
    assert sum((r["score"] >= 0.7) == (r["doc_id"] % 5 < 3) for r in held) / len(held) > 0.97


def test_chance_counts_all_segments():
    assert toxicity.chance([6.0] * 60, 500, 1.0, 0.1) < toxicity.chance([6.0] * 20, 500, 1.0, 0.1)
    assert toxicity.chance([6.0] * 5000, 500, 1.0, 0.1) == pytest.approx(0.0, abs=1e-300)


# --- quality -------------------------------------------------------------------------------


def test_known_labels_are_bounded_and_stable(spark):
    rows = [(i, i % 2, None) for i in range(3000)] + [(1, 0, 1), (2, 1, 1), (None, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int, quality int")
    whole = {r.doc_id: r.label for r in common.known_labels(labels, "toxic").collect()}
    free = {r.doc_id for r in labels.where((common.fold() != 1) & F.col("doc_id").isNotNull()).collect()}
    assert whole == {i: max(i % 2, i == 2) for i in free}
    some = {r.doc_id: r.label for r in common.known_labels(labels, "toxic", 500).collect()}
    assert 400 < len(some) < 600 and some.items() <= whole.items()
    again = common.known_labels(labels.repartition(7), "toxic", 500).collect()
    assert {r.doc_id for r in again} == set(some)
    assert common.known_labels(labels.limit(0), "toxic").isEmpty()


def test_quality_held_out_and_odd_rows(spark):
    docs, labels = tables(spark)
    found = quality.score(docs, labels).collect()
    assert len(found) == 905
    by_id = {r["doc_id"]: r["score"] for r in found}
    held = [i for i in range(900) if not i % 3]
    assert sum((by_id[i] >= 0.5) == bool(i % 5) for i in held) / len(held) > 0.98
    assert all(0 <= s <= 1 for s in by_id.values())
    assert quality.score(docs.limit(0), labels).count() == 0
    assert quality.score(docs, labels.limit(0)).count() == 905


def test_sites_are_shrunk_by_their_size(spark):
    rows = [(f"h{h}", "p", 0.9 if h else 0.1) for h in range(6) for _ in range(200)] + [("tiny", "p", 0.0), ("tiny", "p", 0.0)]
    logit = lambda p: float(np.log(max(p, 1e-4) / (1 - p)))
    featured = spark.createDataFrame(
        [(i, s, p, *([logit(e)] + [0.0] * (len(quality.FEATURES) - 1))) for i, (s, p, e) in enumerate(rows)],
        ", ".join(["doc_id long", "source string", "lang string", *(f"{f} double" for f in quality.FEATURES)]),
    )
    model = quality.Model((1.0, *([0.0] * (len(quality.FEATURES) - 1))), 0.0)
    sites = quality.site_rates(featured, model)
    rate = {r["source"]: r["path_rate"] for r in quality.judged(featured, model, sites).collect()}
    assert rate["h0"] < 0.2 and rate["h1"] > 0.85
    assert rate["h0"] < rate["tiny"] < rate["h1"]  # two poor rows pull less than two hundred


# --- fingerprints --------------------------------------------------------------------------


def test_fingerprints_of_edited_and_next_texts(spark):
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(400)]
    texts = [" ".join(draw.sample(words, 60)) for _ in range(80)] + ["", None, texts_equal := "x " * 30, texts_equal, "é"]
    data = [(i * 2**50, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    found = {r["doc_id"]: r for r in fingerprint.fingerprints(frame, rarest=0.01, commonest=0.5).collect()}
    assert len(found) == len(data)
    backwards = sorted(data, reverse=True)
    for (doc_id, text), (_, following) in zip(backwards, backwards[1:] + backwards[:1], strict=True):
        changed = fingerprint.edited(text or "", following or "")
        row = found[doc_id]
        assert row["n_chars"] == len(text or "")
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    usual = [found[i * 2**50] for i in range(1, 80)]
    assert np.mean([r["near_edited"] for r in usual]) > 3 * np.mean([r["near_next"] for r in usual])
    assert found[82 * 2**50]["fingerprint"] == found[83 * 2**50]["fingerprint"] and found[83 * 2**50]["near_next"] == 1.0
    assert found[80 * 2**50]["fingerprint"] == "0"


def test_fingerprints_of_odd_tables(spark):
    data = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (None, "x y"), (2**60 + 1, "é" * 5)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert fingerprint.fingerprints(frame).count() == 5
    alone = fingerprint.fingerprints(frame.limit(1)).first()
    assert alone["near_next"] == 1.0
    assert fingerprint.fingerprints(frame.limit(0)).count() == 0


def test_ranges_follow_one_another(spark):
    draw = random.Random(9)
    ids = [draw.choice([draw.randrange(-50, 50), 2**53 + draw.randrange(9), -(2**63), 2**63 - 1, None, 7, 7]) for _ in range(300)]
    data = [(i, f"t{draw.randrange(40)}" if draw.random() < 0.9 else None) for i in ids]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    for range_rows in (1, 4, 1000):
        ordered = fingerprint.in_order(frame, range_rows)
        rows = [(r["_range"], r["_extra"], r["doc_id"], r["text"]) for r in ordered.collect()]
        down = lambda r: (r[0] is not None, r[0] or 0, r[1])
        expected = sorted([(i, t or "") for i, t in data], key=down, reverse=True)
        by_range = {}
        for place, extra, *row in rows:
            by_range.setdefault(place, ([], []))[extra].append(tuple(row))
        assert len(by_range) == len({k for k, *_ in rows}) and all(len(extras) == 1 for _, extras in by_range.values())
        found, heads = [], []
        for place in sorted(by_range, reverse=True):
            own, extras = by_range[place]
            found += sorted(own, key=down, reverse=True)
            heads.append((len(found), extras[0]))
        assert found == expected
        assert all(head == expected[end % len(expected)] for end, head in heads)
        if range_rows == 1000:
            assert len(by_range) <= 10


def scrambled(h):
    for shift in (32, 32):
        h = (h ^ (h >> shift)) * 0xD6E8FEB86659FD93 % 2**64
    return h ^ (h >> 32)


def brute_fingerprint(text, band):
    """The definition, with whole numbers and one lexicon after the other."""
    all_terms = fingerprint.terms(text)
    kept = [t for t in all_terms if t in band]
    hashes = sorted({xxhash.xxh3_64_intdigest(t) for t in (kept if len(kept) >= 4 else all_terms)})
    if not hashes:
        return "0"
    full = xxhash.xxh3_64_hexdigest(b"".join(h.to_bytes(8, "little") for h in hashes))
    first = max(1, round(np.log2(len(hashes))))
    parts = []
    for level in range(first, first + 3):
        for k in range(1, 17):
            seed = scrambled(k * 0x9E3779B97F4A7C15 % 2**64)
            drawn = [h for h in hashes if scrambled(h ^ seed) < 2 ** (64 - level)]
            parts.append(f"{scrambled((sum(drawn) + seed) % 2**64) >> 32:08x}" if drawn else "-")
    return f"{len(hashes)}:{full}:{first}:{' '.join(parts)}"


def test_fingerprints_equal_their_definition(spark):
    draw = random.Random(14)
    common_words, usual = ["the", "of", "and"], [f"w{k}" for k in range(60)]
    texts = [" ".join(draw.sample(common_words, 2) + draw.sample(usual, draw.randrange(0, 12))) for _ in range(60)] + ["", None, "rare one"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = [fingerprint.terms(t or "") for t in texts]
    counts = {t: sum(t in h for h in held) for h in held for t in h}
    band = {t for t, n in counts.items() if 0.03 * len(texts) <= n <= 0.4 * len(texts)}
    found = {r["doc_id"]: r for r in fingerprint.fingerprints(frame, rarest=0.03, commonest=0.4).collect()}
    sizes = set()
    for i, text in enumerate(texts):
        following = texts[i - 1] or ""
        own, changed = brute_fingerprint(text or "", band), brute_fingerprint(fingerprint.edited(text or "", following), band)
        assert (found[i]["fingerprint"], found[i]["edited_fingerprint"]) == (own, changed)
        assert found[i]["near_edited"] == fingerprint.likeness(own, changed)
        assert found[i]["near_next"] == fingerprint.likeness(own, brute_fingerprint(following, band))
        sizes.add(len(held[i] & band))
    # On both sides of the least number of terms.
    assert {3, 4} <= sizes


# --- html ----------------------------------------------------------------------------------


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href=/a>A<li>B</ul></nav><div class="cookie-notice">We use</div><div><p>Shared box of the host</p></div>
<article><header><h1>Head &amp; line {n}</h1></header><p>One <b>bo</b>ld<br>two&nbsp;three<p>Four &lt;five&gt; {n}
<div><span>Read also this</span></div><form><p>Mail</form><ul><li>own item {n}</ul><div class="comments"><p>Nice!</div></article>
<aside>Side</aside><footer>&copy; x</footer></body>"""


def test_main_text_and_templates(spark):
    data = [(i, f"http://h{i % 2}.example/x{i}", PAGE.replace("{n}", str(i))) for i in range(24)]
    data += [(100, None, None), (101, "", ""), (102, "http://h0.example", "plain &amp; <b>un</b>finished <a hr"), (3, "u", "<p>x</p>")]
    frame = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "0 AS n_chars")
    found = {(r["page_id"], r["url"]): r for r in html_text.extract(frame).collect()}
    assert len(found) == len(data)
    for i in range(24):
        row = found[i, f"http://h{i % 2}.example/x{i}"]
        assert row["text"] == f"Head & line {i} One bold two three Four <five> {i} own item {i}"
        assert row["n_chars"] == len(row["text"])
    assert found[100, None]["text"] == found[101, ""]["text"] == ""
    assert found[102, "http://h0.example"]["text"] == "plain & unfinished"
    assert found[3, "u"]["text"] == "x"
    assert html_text.extract(frame.limit(0)).count() == 0


def test_recurring_paragraphs_without_a_main_element_go(spark):
    page = "<body><div><p>Subscribe now</p></div><div><p>Text number {n}</p></div></body>"
    data = [(i, "http://h/x", page.replace("{n}", str(i))) for i in range(9)]
    found = html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {f"Text number {i}" for i in range(9)}


@pytest.mark.parametrize("box, inside", [
    ('<main class="has-sidebar">', "x"), ('<article class="post ad-free">', "x"), ('<article id="post-share">', "x"),
    ('<article class="sidebar">', "x"), ('<div class="page no-sidebar">', "x"), ("<main>", '<p class="share-price">x</p>'),
    ("<article>", '<div id="banner-history">x</div>'), ("<article>", '<p class="notice">x</p>'), ("<main>", '<h2 id="ads">x</h2>'),
])
def test_class_names_do_not_lose_the_article(box, inside):
    assert html_text.main_text(f"<body><nav>n</nav>{box}<p>text</p>{inside}</body>", set()).split() == ["text", "x"]


@pytest.mark.parametrize("box", [
    '<div class="ad">', '<div class="x cookie-notice">', '<section id="site-footer">', '<div class="sidebar_left">',
    '<article class="comments">', '<div class="Top-Banner2">',
])
def test_class_names_of_other_boxes(box):
    page = f"<main><p>text</p>{box}<p>y</div></section></article></main>"
    assert html_text.main_text(page, set()) == "text"


def test_repeated_articles_are_no_template(spark):
    page = "<html><head><title>{n}</title></head><body><div id=top>Site</div><div><p>The same story</p><p>in two parts</p></div></body>"
    other = "<body><div id=top>Site</div><div><p>Story number {n}</p></div></body>"
    data = [(i, "http://h/x", page.replace("{n}", str(i))) for i in range(6)]
    data += [(10 + i, "http://h/x", other.replace("{n}", str(i))) for i in range(7)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert {found[i] for i in range(6)} == {"The same story in two parts"}
    assert {found[10 + i] for i in range(7)} == {f"Story number {i}" for i in range(7)}


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    pages = [(i, "http://h/x", f"<body><div>{'Seen by six' if i < 6 else 'Own ' + str(i)}</div><div><p>Text {i}</p></div></body>") for i in range(900)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(found[i] == (f"Text {i}" if i < 6 else f"Own {i} Text {i}") for i in range(900))


def brute_templates(pages, least=5):
    """Subtree hashes of each host with as many different rests, by plain loops over whole pages."""
    rests = {}
    for url, page in pages:
        for subtree, rest in html_text.template_candidates(page):
            rests.setdefault((url, subtree), set()).add(rest % html_text.CELLS)
    return {k for k, v in rests.items() if len(v) >= least}


def test_templates_equal_brute_force(spark, sf):
    pages = common.table(spark, sf, "pages").select("page_id", "url", "html", html_text.host().alias("h")).where("html IS NOT NULL")
    rows = pages.collect()
    many = brute_templates([(r["h"], r["html"]) for r in rows])
    keys = {r["page_key"]: r["page_id"] for r in pages.select(html_text.page_key(), "page_id").collect()}
    found = {keys[r["page_key"]]: set(r["template"]) for r in html_text.templates(pages.drop("h")).collect()}
    expected = {r["page_id"]: {s for s, _ in html_text.template_candidates(r["html"]) if (r["h"], s) in many} for r in rows}
    assert found == {i: t for i, t in expected.items() if t}


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a " * 100_000 + '"', "<a '" * 100_000 + ">", "<a<a" * 100_000 + ' "x>', '<a "' * 100_001, "<a \"'" * 100_000,
    "<div>" * 20_000 + "</p>" * 20_000, "<div>" * 20_000 + "</b>" * 20_000, "<span>" * 20_000 + "<p>" * 20_000,
    "<li>" * 20_000, "<b><p>" * 20_000, "</" * 100_000, "<!" * 100_000, "<script" * 50_000, "<script>x" * 50_000, "<" * 300_000,
    "<table><tr><td>" * 10_000 + "<tr>" * 10_000, "<p a='" * 50_000 + "'>" * 10,
])
def test_broken_long_pages_take_time_in_proportion(page):
    start = time.perf_counter()
    html_text.main_text(page, {1})
    html_text.template_candidates(page)
    assert time.perf_counter() - start < 8


def test_deep_and_broken_markup():
    assert html_text.main_text("<div>" * 5000 + "deep", set()) == "deep"
    assert html_text.main_text("a < b <3 <p class='x>y</p>", set()).startswith("a < b <3")
    assert html_text.main_text("<p>a</p></p></div>b", set()) == "a b"


# --- token counts and packing ---------------------------------------------------------------


def test_token_counts_equal_the_library(spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    texts = HARD + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", "1 AS n_bytes")
    found = {r["doc_id"]: r for r in token_counts.with_counts(frame, token_counts.model_path(), limit=50).collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or ""))
        assert (found[i]["n_tokens"], found[i]["over_limit"], found[i]["n_bytes"]) == (n, n > 50, len((text or "").encode()))
    assert token_counts.with_counts(frame.limit(0), token_counts.model_path()).count() == 0


def test_encoder_equals_the_library(spark, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.tokenizer_path())
    encoder = packing.Encoder(packing.tokenizer_path())
    texts = [t or "" for t in HARD] + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_packing_is_gapless_whole_and_tight(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = [(-1, t) for t in HARD[:6]] + [(None, "x"), (None, "x"), (-2, " a" * 5000)]
    docs = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    found = packing.pack(packing.pieces(docs, packing.tokenizer_path()), range_rows=50).collect()
    ends = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0) and r["length"] > 0
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= packing.CAPACITY
    assert len(ends) <= -(-sum(ends.values()) // packing.CAPACITY) * 1.01 + 1
    long = sorted((r["piece"], r["start"], r["length"]) for r in found if r["doc_id"] == -2)
    assert long == [(0, 0, 5001 - 4096), (1, 5001 - 4096, 2048), (2, 5001 - 2048, 2048)]
    assert packing.pack(packing.pieces(docs.limit(0), packing.tokenizer_path())).count() == 0


def test_solver_uses_all_and_is_near_the_bound():
    draw = np.random.default_rng(1)
    counts = {int(k): int(v) for k, v in zip(range(1, 257), draw.integers(0, 400, 256), strict=True)}
    patterns = packing.solve(counts, capacity=256, rounds=60)
    used = {}
    for lengths, times in patterns:
        assert sum(lengths) <= 256
        for k in lengths:
            used[k] = used.get(k, 0) + times
    assert used == {k: v for k, v in counts.items() if v}
    plain = packing.best_fit(counts, 256)
    assert sum(t for _, t in patterns) <= 1.03 * sum(plain.values())


def test_pattern_is_the_dearest():
    lengths, values = np.array([2, 3, 5]), np.array([2.0, 3.5, 5.1])
    pattern = packing.dearest_pattern(lengths, values, 9)
    assert pattern == {1: 3}


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf):
    docs = common.table(spark, sf, "documents")
    extra = docs.limit(3).union(docs.limit(3)).selectExpr("*")
    docs = common.stored(docs.unionByName(extra).selectExpr("*", "doc_id AS size", "'x' AS score"), "in")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.stored(stage(spark, before, sf), name)
        assert after.columns == docs.columns
        assert after.exceptAll(before).count() == 0 or name == "mixing_sources"
        assert after.distinct().exceptAll(before).count() == 0
        if name == "jaccard_join":
            assert after.count() == after.select("doc_id").distinct().count() < before.count()
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert last.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


@pytest.mark.parametrize("text", [
    " " * 100_000, "x" + " " * 99_999 + "y", "=" * 50_000, "- " * 30_000, "\t" * 40_000, "ab" * 40_000, "\n \n" * 20_000, "─" * 20_000,
])
def test_long_runs_are_counted_in_time(text):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    merges = token_counts.Merges(token_counts.model_path())
    merges.table
    start = time.perf_counter()
    found = int(token_counts.count_words(token_counts.split_words(text), merges).sum())
    took = time.perf_counter() - start
    assert found == len(library.encode(text)) and took < 3


def test_random_runs_equal_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    merges, draw = token_counts.Merges(token_counts.model_path()), random.Random(11)
    texts = ["".join(c * draw.randrange(1, 150) for c in draw.choices(" =-_.\n\tab0─", k=draw.randrange(1, 9))) for _ in range(400)]
    for text in texts:
        assert int(token_counts.count_words(token_counts.split_words(text), merges).sum()) == len(library.encode(text)), repr(text)
