"""The operators against brute force and exact round trips, with nulls, empty and repeated rows."""

import hashlib
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from check import connect, difference
from pyspark.sql import functions as F

from ledgerlark.llm import (
    buckets,
    class_ngrams,
    components,
    cross_polytope,
    html_text,
    line_dedup,
    packing,
    pii,
    sentencepiece_offsets,
    simhash_blocks,
    simhash_pivots,
    toxicity,
)
from ledgerlark.llm.queries import ORACLE, QUERIES, tokenizer_file

FOLDER = "/root/testdata/sf0.001"
LONG = "Lorem ipsum dolor sit amet, " * 4000
SCHEMA = "doc_id long, text string, fp string, _lines int, n_chars long"
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "One word"), (5, "a b c d e f g h i j k l m n o p"),
    (6, "a b c d e f g h i j k l m n o p"), (6, "a b c d e f g h i j k l m n o p"), (None, "a null id row"),
    (None, None), (7, LONG), (8, LONG + "end."), (9, "Ünïcödé ΣΑΣ 日本 😀 don't x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Edge cases, with extra columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "x", 1, 0) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def _query(name, spark, folder=FOLDER):
    return QUERIES[name](spark, folder).toPandas()


def _roots(names, linked):
    root = {n: n for n in names}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in names}


def _simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles if words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = _roots({n for e in edges for n in e}, edges)
    assert {r.node: r.root for r in found} == {n: r for n, r in want.items() if n != r}


def test_cells_let_every_pair_meet_once(spark):
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 50), (2, 3), (3, 1)) for i in range(n)], "key long, id long")
    met = Counter()
    for slot, group in buckets.cells(rows.withColumn("k", rows.key), "key", "id", 10).toPandas().groupby("slot"):
        for a, b in combinations(group.itertuples(), 2):
            if not a.crossed or a.home != b.home:
                met[a.k, min(a.id, b.id), max(a.id, b.id)] += 1
        assert len(group) < 40
    assert met == {(k, a, b): 1 for k, n in ((1, 50), (2, 3)) for a, b in combinations(range(n), 2)}


def test_op1_against_all_pairs(spark, texts):
    found = _query("op1_simhash_near_dedup", spark)
    prints = {i: _simhash(t) for i, t in texts.items()}
    linked = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = _roots(prints, linked)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.itertuples()} == {
        i: (f"{prints[i]:016x}", want[i]) for i in prints
    }


def test_op1_odd_rows(odd, empty):
    found = simhash_pivots.near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found if r.doc_id}
    assert by_id[1].fp == 0 and by_id[3].component_id == 1 and by_id[6].component_id == 5
    assert {r.component_id for r in found if r.doc_id is None} == {1, None}
    odd = odd.withColumns({name: F.lit(7) for name in ("_root", "_fp", "_least", "row", "hash", "id", "root")})
    kept = simhash_pivots.keep_one(odd)
    assert kept.columns == odd.columns and all(r._root == r.hash == 7 and r.fp == "x" for r in kept.collect())
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 9]
    assert simhash_pivots.near_duplicates(empty).count() == 0


def test_pivot_search_finds_every_link(spark):
    random = np.random.default_rng(3)
    base = random.integers(0, 2**63, 40, dtype=np.uint64)
    values = set(base.tolist())
    for value in base.tolist():
        for _ in range(12):
            for bit in random.integers(0, 64, random.integers(1, 4)):
                value ^= 1 << int(bit)
            values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash_pivots.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert _roots(signed, [(r.a, r.b) for r in found]) == _roots(signed, near)


def test_op2_round_trip(spark, texts, odd, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    encode = Tokenizer.from_file(path).encode
    found = packing.pack_documents(spark.read.parquet(f"{FOLDER}/documents.parquet"), path).toPandas()
    for doc_id, pieces in found.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        ids = [*encode(texts[doc_id], add_special_tokens=False).ids, 2]
        assert b"".join(pieces.ids) == np.array(ids, "<u4").tobytes()
        assert pieces.start.tolist() == [0, *pieces.length.cumsum()[:-1]] and set(pieces.doc_tokens) == {len(ids)}
    for _, pieces in found.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum()[:-1]] and pieces.length.sum() <= 4096
    tokens = packing.pack_documents(odd, path).toPandas()
    want = sum(len(encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert tokens.length.sum() == want and set(tokens[tokens.doc_id == 1].length) == {1}
    assert packing.pack_documents(empty, path).count() == 0


def test_first_fit_decreasing_is_first_fit():
    sizes = np.random.default_rng(1).integers(1, 100, 300).tolist()
    bins, free = packing.first_fit_decreasing(sizes, 100), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        place = next((i for i, room in enumerate(free) if room >= sizes[item]), len(free))
        free[place:] = free[place:] or [100]
        free[place] -= sizes[item]
        assert bins[item] == place


def test_op3_against_all_pairs(spark):
    random = np.random.default_rng(5)
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in rows[:200]}
    for i in range(60):
        near = vectors[rows[i % 5].vec_id]
        vectors[10_000 + i] = near + random.normal(size=64) * random.uniform(0, 0.6) * np.linalg.norm(near) / 8
    vectors |= {20_000 + i: vectors[rows[1].vec_id] * 2.0 for i in range(3)}
    odd = {30_000: None, 30_001: [], 30_002: [0.0] * 64, 30_003: [float("nan")] * 64, 30_004: [1.0, None], 30_005: [1.0, 2.0]}
    frame = spark.createDataFrame(
        [(i, None if v is None else [x if x is None else float(x) for x in v], 1) for i, v in (vectors | odd).items()],
        "vec_id long, embedding array<double>, cid int",
    )
    found = {r.vec_id: r for r in cross_polytope.near_duplicates(frame).collect()}
    unit = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    linked = [(a, b) for a, b in combinations(unit, 2) if unit[a] @ unit[b] >= 0.9]
    links = Counter(i for pair in linked for i in pair)
    assert all(found[i].n_links <= links[i] for i in unit)
    assert sum(found[i].n_links for i in unit) >= 0.9 * sum(links.values()) > 0
    assert all((found[i].n_links, found[i].component_id) == (0, i) for i in odd)


def test_op4_learns_words_and_finds_sentences(spark, odd, empty):
    random = np.random.default_rng(2)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    rows = []
    for i in range(600):
        sentences = [" ".join(random.choice(words, 8)) for _ in range(random.integers(1, 12))]
        if i % 4 == 0:
            sentences[len(sentences) // 2] += " nasty"
        rows.append((i, ". ".join(sentences), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs, docs)
    scored = toxicity.score(docs, model).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in scored)
    assert all("nasty" in r.text[r.start : r.end] for r in scored if r.toxic)
    clashing = docs.withColumnsRenamed({"toxic": "_score"}).withColumns({"score": F.lit(1), "found": F.lit("x")})
    kept = toxicity.accepted(clashing, model)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows if not r[2]}
    labels = spark.createDataFrame([(4, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(odd, toxicity.train(odd, labels)).collect()} == {0.0}
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0


def test_op4_few_labels_are_not_learnt_by_heart(spark):
    random = np.random.default_rng(6)
    rows = []
    for i in range(400):
        words = ["".join(random.choice(list("abcdefgh"), 7)) for _ in range(30)]  # most of them met once
        if i % 8 == 0:
            words[5] = random.choice(["nasty", "rotten"])
        rows.append((i, " ".join(words), int(i % 8 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, docs)).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.toxic for r in held) >= 5 and all((r.score >= 0.5) == bool(r.toxic) for r in held)


def test_op4_score_is_the_noisy_or_of_its_sentences(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    random = np.random.default_rng(3)
    weights, bias, leak = random.normal(0, 0.3, toxicity.FEATURES).astype(np.float32).astype(float), -2.0, -4.0
    for row in toxicity.score(docs, (weights, bias, leak)).collect():
        none, best = 1 / (1 + np.exp(leak)), None
        for start, end, words in toxicity.sentences(row.text):
            logit = bias + sum(weights[f] for word in set(words) for f in toxicity.features(word))
            none /= 1 + np.exp(min(logit, 700))
            best = max(best or (-np.inf,), (logit, start, end), key=lambda x: x[0])
        assert row.score == pytest.approx(1 - none, abs=1e-4)
        assert row.worst == pytest.approx(1 / (1 + np.exp(-best[0])), abs=1e-4)


def test_op4_telling_features():
    flat = np.array([1, 2, 1, 1, 2, 3] + [2, 3] * 20, np.int32)
    ends = [3, 4, 6, *range(8, 48, 2)]
    positive = np.array([True, True] + [False] * 21)
    assert not toxicity.telling(flat, ends, positive)[[2, 3]].any()
    flat[4] = 4
    assert toxicity.telling(flat, ends, positive)[1] and not toxicity.telling(flat, ends, positive)[4]


def test_op10_words_side_by_side():
    encoder = sentencepiece_offsets.Encoder(tokenizer_file("piece_bpe_32k.model"))
    random = np.random.default_rng(8)
    words = ["".join(random.choice(list("▁▁aeinstréxq日ß"), random.integers(1, 70))) for _ in range(3000)]
    encoder.learn(words)
    assert all(encoder.cache[word] == encoder.merge(word) for word in words)


def test_op4_held_out_accuracy(spark):
    found = _query("op4_toxicity", spark, "/root/testdata/sf0.1").set_index("doc_id")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas().set_index("doc_id").toxic
    held = found.join(labels, how="inner").query("held_out")
    assert (held.predicted == held.toxic).mean() > 0.95
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in found.held_out.items())


@pytest.mark.parametrize("name", ORACLE)
def test_sql_twins(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


def test_op5_odd_rows(spark, empty):
    line = "A line that is long enough"
    rows = [(i, f"{line}\nown {i}\n\t{line.upper()} ") for i in range(4)] + [(None, line), (9, None), (3, f"{line}\nown 3")]
    names = ["_lines", "lines", "words", "keeps", "row", "id", "_id", "row_hash", "_dropped", "kept", "n_lines", "n_dropped"]
    docs = spark.createDataFrame(
        [(i, t, *range(len(names))) for i, t in rows], f"doc_id long, text string, {', '.join(f'{n} int' for n in names)}"
    )
    found = line_dedup.deduplicated(docs).collect()
    want = [(i, f"own {i}", 3, 2) for i in range(3)]
    want += [(3, rows[3][1], 3, 0), (3, f"{line}\nown 3", 2, 0), (None, "", 1, 1), (9, "", 1, 0)]
    assert Counter((r.row.doc_id, r.kept, r.n_lines, r.n_dropped) for r in found) == Counter(want)
    kept = line_dedup.remove_shared_lines(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter((i, t, *range(len(names))) for i, t, _, _ in want)
    assert line_dedup.remove_shared_lines(empty.select("doc_id", "text")).count() == 0


def test_op5_lines_behind_the_first_word_of_the_bitmap(spark):
    line = "A line that is long enough"
    text = "\n".join([f"line {i}" for i in range(200)] + [line] + [f"more {i}" for i in range(100)] + [line])
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    found = {r.row.doc_id: (r.kept, r.n_dropped) for r in line_dedup.deduplicated(docs).collect()}
    assert found[0][0] == text.replace(f"\n{line}", "") and found[0][1] == 2 and found[2] == (text, 0)
    # only the words of lines 200 and 301 are written down
    bitmaps = line_dedup.keep_bitmaps(docs).collect()
    assert [[(p.word, p.mask) for p in r.keeps] for r in bitmaps] == [[(3, ~(1 << 8)), (4, ~(1 << 45))]] * 2


def test_op5_a_line_in_every_document(spark):
    rows = [(i, f"A line that all documents hold\nown line number {i} of them") for i in range(3000)]
    found = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.row.doc_id for r in found if not r.n_dropped) == [2999] and len(found) == 3000


def test_op6_pages():
    tree = html_text.grow_tree(np.array(html_text.LABELLED, float))
    page = """<html><head><title>T</title></head><body><header><h2>Site</h2><p>A long slogan of the site</p></header>
    <ul class="menu"><li><a href=x>One</a><li><a href=y>Two</a></ul><div id="cookie-notice"><p>We use cookies here</p></div>
    <main><article><h1>A &amp; B</h1><p>First&nbsp;text <b>bold<p>Short.<aside><p>Related words</p></aside>
    <p>More   text</p></article></main><section id="comments"><p>I do not agree with the text at all, not one bit</p></section>
    <form><p>Your mail<input></p></form><script>var x = "<p>no</p>";</script><footer>&copy; 2020</footer></body></html><p"""
    assert html_text.main_text(page, tree) == "A & B First text bold Short. More text"
    assert html_text.main_text(None, tree) == html_text.main_text("", tree) == html_text.main_text("<p></p>", tree) == ""
    rows = np.array(html_text.LABELLED, float)
    assert np.mean([html_text.is_main(tree, row[:-1]) == bool(row[-1]) for row in rows]) > 0.9


def test_op6_forms_layout_names_and_unclosed_elements():
    tree = html_text.grow_tree(np.array(html_text.LABELLED, float))
    text = " ".join(["many words of the article stand here"] * 6)
    paragraphs = f"<p>{text}</p><p>{text}</p>"
    menu = "<nav><a href=x>Home</a> <a href=y>News</a></nav>"
    both = f"{text} {text}"
    for around in ("form action=x", "div class=has-sidebar", 'div class="page with-nav"', "div id=page-search"):
        end = around.split()[0]
        for inside in (f"<article>{paragraphs}</article>", f"<main>{paragraphs}</main>", paragraphs):
            page = f"<html><body><{around}>{menu}{inside}<div class=footer>All rights</div></{end}></body></html>"
            assert html_text.main_text(page, tree) == both, (around, inside)
    beside = f"<article>{paragraphs}</article><div class=related-posts><article><p>{text}</p></article></div>"
    assert html_text.main_text(beside, tree) == both
    form = f"<article>{paragraphs}<form><p>Your name and mail, and then some more words</p></form></article>"
    assert html_text.main_text(form, tree) == both
    for name in ("svg", "object", "noscript", "select", "math", "iframe"):
        page = f"<article><p>{text}</p><div><{name}><b>not text</b></div><p>{text}</p></article>"
        assert html_text.main_text(page, tree) == both, name
        assert html_text.main_text(page.replace("</div>", f"<{name}>x</{name}></div>"), tree) == both, name
    assert html_text.main_text(f"<article><p>{text}</p><script>var x<p>{text}</p></article>", tree) == text


def test_op6_links_decide_and_words_of_furniture_around_all_text_do_not():
    tree = html_text.grow_tree(np.array(html_text.LABELLED, float))
    assert {html_text.FEATURES[tree[0]], html_text.FEATURES[tree[2][0]]} == {"furniture", "links"}
    text = " ".join(["word"] * 60)
    after = f"<article><p>{text}</p><p><a>See the full list here</a></p></article>"
    assert html_text.main_text(after, tree) == f"{text} See the full list here"
    for beside in ("<div><a href=x>Home</a> <a href=y>News</a></div>", "<div><a href=x>Home</a></div>" * 3):
        for page in (f"<body><p>{text}</p>{beside}</body>", f"<body>{beside}<p>{text}</p>{beside}</body>"):
            assert html_text.main_text(page, tree) == text
    for name in ("legal", "post tags", "search", "share"):
        assert html_text.main_text(f'<div id="{name}"><article><p>{text}</p></article></div>', tree) == text
        assert html_text.main_text(f'<div class="{name}"><p>{text}</p><p>{text}</p></div>', tree) == f"{text} {text}"
        assert html_text.main_text(f'<p>{text}</p><p>{text}</p><div class="{name}"><p>{text}</p></div>', tree) == f"{text} {text}"
    for name in ("comments", "related-posts"):
        assert html_text.main_text(f"<article><p>{text}</p></article><div class={name}><p>{text} {text}</p></div>", tree) == text


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "</b2>" * 50_000, '<div class="x-nav">' * 40_000, "<p>a</x>" * 60_000])
def test_op6_time_grows_with_the_length_of_a_page(page):
    import time

    start = time.time()
    html_text.blocks(page + "text")
    assert time.time() - start < 5


def test_op6_rows_of_a_table(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<article><p>x"), (3, "<article><p>x")], "page_id long, html string")
    found = pages.select("page_id", html_text.extract(F.col("html")).alias("text"))
    assert sorted(map(tuple, found.collect())) == [(1, ""), (2, ""), (3, "x"), (3, "x")]
    assert pages.limit(0).select(html_text.extract(F.col("html"))).count() == 0


def test_op6_keeps_articles(spark):
    found = _query("op6_html_extraction", spark).set_index("page_id")
    for row in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", row.html, re.S)
        if inner:
            import html

            want = " ".join(html.unescape(re.sub("<[^>]*>", " ", inner[1])).split())
            assert found.text[row.page_id] == want and found.n_chars[row.page_id] == len(want)


def test_op7_edited_texts(spark, texts):
    found = _query("op7_document_fingerprints", spark).set_index("doc_id")
    order = sorted(texts)
    for i, doc_id in enumerate(order):
        text, half = texts[doc_id], len(texts[doc_id]) // 2
        want = text[: len(text) - half] + texts[order[(i + 1) % len(order)]][:half]
        assert found.edited_sha256[doc_id] == hashlib.sha256(want.encode()).hexdigest()
    assert (found.near_edited > found.near_next).mean() > 0.95
    prints = [(int(p, 16), texts[i]) for i, p in found.fingerprint.items()]
    assert len({t for _, t in prints}) >= len({p for p, _ in prints})
    for doc_id in (0, 50, 100):
        own = int(found.fingerprint[doc_id], 16)
        assert found.n_near[doc_id] == sum((own ^ p).bit_count() <= 3 for p, _ in prints) - 1


def _pair_print(text):
    """128 bits, each set if over half of the hashes of neighbouring words have it."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    out = ""
    for n in range(2):
        hashes = []
        for before, word in zip([None, *words], words):
            seed = xxhash.xxh64_intdigest(n.to_bytes(4, "little"), 42)
            for part in (before, word):
                seed = seed if part is None else xxhash.xxh64_intdigest(part.encode(), seed)
            hashes.append(seed)
        out += f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)):016x}"
    return out


def test_op7_fingerprints_against_plain_votes(spark, texts):
    found = _query("op7_document_fingerprints", spark).set_index("doc_id")
    order = sorted(texts)
    for i, doc_id in enumerate(order):
        text, after = texts[doc_id] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        own, edited, other = (_pair_print(t) for t in (text, text[: len(text) - half] + after[:half], after))
        row = found.loc[doc_id]
        assert (row.fingerprint, row.edited_fingerprint) == (own, edited)
        for near, print_ in ((row.near_edited, edited), (row.near_next, other)):
            apart = (int(own, 16) ^ int(print_, 16)).bit_count()
            assert near == pytest.approx(max(0.0, np.cos(np.pi * apart / 128)))


def test_op7_votes(spark, odd, empty):
    rows = simhash_blocks.fingerprints(odd.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text"), ["doc_id"])
    found = {r.doc_id: (r.fp0, r.fp1) for r in rows.collect()}
    assert found[1] == found[2] == found[3] == (0, 0) and found[5] == found[6]
    assert simhash_blocks.compare_edited(odd).count() == len(ODD) - 1
    assert simhash_blocks.compare_edited(empty).count() == 0


def test_op8_base_and_held_out(spark, texts, odd, empty):
    found = _query("op8_class_ngrams", spark).set_index("doc_id")
    low = lambda text: [*text.encode().lower().split(), None]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in low(t))
    total, distinct = sum(counts.values()), len(counts)
    for i, text in texts.items():
        row, tokens = found.loc[i], low(text)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[i], len(tokens), total)
        assert row.n_known == sum(counts[w] > 0 for w in tokens)
        assert row.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens))
    out = found[found.held_out]
    assert out.score.sum() > out.base_score.sum()
    assert class_ngrams.score(odd).count() == len(ODD) and class_ngrams.score(empty).count() == 0


def test_op8_probabilities_sum_to_one():
    random = np.random.default_rng(4)
    width = class_ngrams.FREQUENT + class_ngrams.BANDS
    pairs = np.zeros((width, width))
    walk = random.integers(0, 30, 5000)
    walk = np.concatenate([[0], walk, [0]])
    np.add.at(pairs, (walk[:-1], walk[1:]), 1)
    words = (pairs.sum(axis=0) > 0).astype(float)
    model = class_ngrams.Model(pairs, words, 0.4)
    some = np.flatnonzero(words)
    before = model.label[7]
    mass = (10 ** (model.after[before, model.label[some]] + model.emit[some])).sum() + 10 ** model.unseen[before]
    assert mass == pytest.approx(1.0, abs=0.02)


def test_op8_neighbours_decide_the_class_of_rare_words(spark):
    # words between "the" and "runs", or alone; 500 of either are frequent, the others equally rare
    nouns, verbs = [f"noun{i}" for i in range(600)], [f"verb{i}" for i in range(600)]
    lines = [f"the {n} runs" for n in nouns] + verbs
    often = [x for x in lines if int(re.sub("[^0-9]", "", x)) < 500] * 4
    # ids that are not held out
    ids = (i for i in range(10**6) if zlib.crc32(str(i).encode()) % class_ngrams.FOLDS != class_ngrams.HELD_OUT)
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % class_ngrams.FOLDS == class_ngrams.HELD_OUT][:2]
    rows = [(next(ids), line) for line in lines * 2 + often] + [(held[0], "the noun599 runs"), (held[1], "the verb599 runs")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in class_ngrams.score(docs).where("held_out").collect()}
    assert found[held[0]] > found[held[1]] + 1


def test_op8_words_of_blocks_travel_packed():
    rng, n = np.random.default_rng(5), 40_000
    rows = {"block": rng.integers(0, 4, n), "local": np.arange(n), "total": rng.geometric(0.3, n), "symbol": rng.integers(1, 1030, n),
            "first": rng.random(n) < 0.2, "hash": rng.integers(-(2**63), 2**63 - 1, n)}
    whole = pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in rows.items()})
    (packed,) = class_ngrams._by_blocks(iter([whole.slice(0, 15_000), whole.slice(15_000)]))
    assert packed.column(0).to_pylist() == [0, 1, 2, 3]
    assert sum(map(len, packed.column(1).to_pylist())) < 14 * n  # a row of the five columns took 26 bytes in the shuffle
    one = pa.array(packed.column(1).to_pylist(), pa.binary())
    told = pa.RecordBatch.from_pydict(
        {"block": packed.column(0), "doc_ids": pa.array([[1]] * 4), "held": pa.array([[False]] * 4), "lengths": pa.array([[1]] * 4),
         "tokens": pa.array([b""] * 4), "n_local": pa.array([n + 1] * 4), "packed": pa.array([[x] for x in one.to_pylist()])}
    )
    for block, row in enumerate(class_ngrams._rows(class_ngrams._known(iter([told])))):
        mine = rows["block"] == block
        for name, kind, key in (("totals", np.int64, "total"), ("symbols", np.uint16, "symbol"), ("hashes", np.int64, "hash"), ("firsts", bool, "first")):
            found = class_ngrams._unpacked(row[name], kind)
            assert len(found) == n + 1 and (found[:n][mine] == rows[key][mine]).all()
            assert (found[:n][~mine] == (class_ngrams.FREQUENT + class_ngrams.BANDS - 1 if name == "symbols" else 0)).all()


def test_op8_best_class_is_that_of_the_likeliest_neighbours():
    grid = np.zeros((class_ngrams.ALL, class_ngrams.ALL))
    grid[1, 3] = grid[3, 2] = grid[4, 5] = grid[5, 6] = 100
    grid[2, 1] = grid[6, 4] = 99
    ahead = class_ngrams.ALL
    word, code = np.array([0, 0, 1, 1]), np.array([2, ahead + 1, 6, ahead + 4])
    assert class_ngrams.best_classes(grid, np.array([60, 60]), word, code, np.ones(4, int)).tolist() == [3, 5]


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_best_classes(grid, old, word, code, n):
    every, counts = np.arange(class_ngrams.ALL), grid.sum(axis=0)
    spread, found = class_ngrams._SMOOTHING * class_ngrams.ALL, old.copy()
    for w in range(len(old)):
        own = Counter()
        for c, k in zip(code[word == w].tolist(), n[word == w].tolist()):
            own[c] += k
        times = sum(k for c, k in own.items() if c < class_ngrams.ALL)
        value = np.zeros(class_ngrams.ALL)
        for of in every:
            mine = of == old[w]
            size = max(counts[of] - mine * times, 1e-9)
            for key, k in own.items():
                c = key % class_ngrams.ALL
                if key < class_ngrams.ALL:
                    cell = max(grid[of, c] - mine * k, 0) + spread * counts[c] / counts.sum()
                    value[of] += k * (np.log(max(cell, 1e-300)) - np.log(size + spread))
                else:
                    cell = max(grid[c, of] - mine * k, 0)
                    value[of] += k * (np.log(cell + spread * size / counts.sum()) - np.log(size))
        value[(counts == 0) | (every == class_ngrams.END) | (every == class_ngrams.ALL - 1)] = -np.inf
        if value.max() > value[old[w]] + 1e-9:
            found[w] = value.argmax()
    return found


def test_op8_best_classes_equal_a_plain_loop():
    rng, size = np.random.default_rng(8), class_ngrams.ALL
    grid = rng.integers(0, 400, (size, size)).astype(float)
    grid[:, 70] = grid[70] = 0
    n_words = 300
    old = rng.integers(1, size - 1, n_words)
    old[old == 70] = 71
    word = np.concatenate([np.arange(n_words), rng.integers(0, 40, 3000)])  # some words with many entries, in no order
    code, n = rng.integers(0, 2 * size, len(word)), rng.integers(1, 4, len(word))
    expected = _plain_best_classes(grid, old, word, code, n)
    assert (expected != old).mean() > 0.5
    assert class_ngrams.best_classes(grid, old, word, code, n).tolist() == expected.tolist()
    wide = n.astype(np.int64) << 52  # too long for one number with its key
    assert class_ngrams._summed(word * 2 * size + code, wide)[1].sum() == wide.sum()
    assert class_ngrams.best_classes(grid, old[:0], word[:0], code[:0], n[:0]).tolist() == []


def test_op8_best_classes_hold_sums_of_few_words_at_once():
    rng, n_words = np.random.default_rng(9), 40_000
    word, code = np.repeat(np.arange(n_words), 2), rng.integers(0, 2 * class_ngrams.ALL, 2 * n_words)
    grid = rng.integers(1, 400, (class_ngrams.ALL, class_ngrams.ALL)).astype(float)
    tracemalloc.start()
    class_ngrams.best_classes(grid, np.full(n_words, 60), word, code, np.ones(len(word), int))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 << 20  # a number for every entry and class takes 52 MB


@pytest.mark.parametrize("most", [1, 40, 6 << 20])
def test_op8_blocks_hold_the_words_of_all_documents(monkeypatch, most):
    monkeypatch.setattr(class_ngrams, "_BLOCK_CHARS", most)
    monkeypatch.setattr(class_ngrams.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 3))
    texts = [None, "", " \t\n ", "\x0bA\x1cB\x85É  a ", "ZZ a", " q", "a\rb\x0cc", "\x00 ı İ K", "x " * 30] * 2
    held = [i % 3 == 1 for i in range(len(texts))]
    whole = pa.RecordBatch.from_pydict({"doc_id": pa.array([None, *range(1, len(texts))]), "held": pa.array(held), "text": pa.array(texts)})
    rows = [*class_ngrams._rows(class_ngrams._blocks(iter([whole.slice(0, 5), whole.slice(5, 0), whole.slice(5)])))]
    assert [r["block"] for r in rows] == [(3 << 33) + i for i in range(len(rows))]
    assert (len(rows) == len(texts)) == (most == 1) and (len(rows) == 1) == (most > 40)
    found, at = [], 0
    for row in rows:
        tokens = class_ngrams._unpacked(row["tokens"], np.int32)
        ends = np.cumsum(row["lengths"])
        mine = [[row["words"][x] for x in tokens[a:b]] for a, b in zip(ends - row["lengths"], ends)]
        taught = Counter(w for words, out in zip(mine, row["held"]) if not out for w in words)
        assert [taught[w] for w in row["words"]] == row["counts"] and len({*row["words"]}) == len(row["words"])
        assert row["doc_ids"] == whole.column(0).to_pylist()[at : at + len(mine)] and row["held"] == held[at : at + len(mine)]
        at += len(mine)
        found += mine
    assert found == [(t or "").encode().lower().split() for t in texts]


def test_op8_words_are_numbered_without_a_step_in_python_each(monkeypatch):
    monkeypatch.setattr(class_ngrams.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    rng = np.random.default_rng(10)
    texts = [" ".join(map(str, x)) for x in rng.integers(0, 10**6, (1000, 400)).tolist()]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1000)), "held": pa.array([False] * 1000), "text": pa.array(texts)})

    def plain():
        local = defaultdict()
        local.default_factory = local.__len__
        return [[local[w] for w in text.encode().lower().split()] for text in texts]

    def seconds(run):
        begin = time.process_time()
        run()
        return time.process_time() - begin

    ours, loop = (min(seconds(run) for _ in range(3)) for run in (lambda: [*class_ngrams._blocks(iter([batch]))], plain))
    assert ours < loop


def test_op8_pairs_are_added_to_the_matrix_once_for_many_documents(monkeypatch):
    rng, calls, bincount = np.random.default_rng(11), [], np.bincount
    texts = [rng.integers(0, class_ngrams.FREQUENT + class_ngrams.ALL, k).astype(np.uint16) for k in rng.integers(0, 5, 1200)]
    held = [i % 7 == 0 for i in range(len(texts))]
    expected = Counter()
    for s, out in zip(texts, held):
        row = [class_ngrams.END, *s.tolist(), class_ngrams.END]
        expected.update(() if out else [a * (class_ngrams.FREQUENT + class_ngrams.ALL) + b for a, b in zip(row, row[1:])])
    batch = pa.RecordBatch.from_pydict({"held_out": pa.array(held), "symbols": pa.array([s.tobytes() for s in texts], pa.binary())})
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or bincount(*a, **k))
    (found,) = class_ngrams._pairs(iter([batch.slice(0, 700), batch.slice(700)]))
    assert dict(zip(*(c.to_pylist() for c in found.columns))) == expected and len(calls) == 1
    monkeypatch.setattr(class_ngrams, "_PAIR_BYTES", 100)
    (found,) = class_ngrams._pairs(iter([batch]))
    assert dict(zip(*(c.to_pylist() for c in found.columns))) == expected


def test_op8_scores_of_a_batch_are_those_of_each_text():
    rng, width = np.random.default_rng(12), class_ngrams.FREQUENT + class_ngrams.BANDS
    pairs = np.zeros((width, width))
    walk = np.concatenate([[0], rng.integers(0, 40, 3000), [0]])
    np.add.at(pairs, (walk[:-1], walk[1:]), 1)
    model = class_ngrams.Model(pairs, (pairs.sum(axis=0) > 0).astype(float), 0.4)
    texts = [rng.choice([*range(1, 40), width - 1], k) for k in (0, 1, 7, 300, 0)]
    expected = []
    for s in texts:
        total = 0.0
        for a, b in zip([class_ngrams.END, *s], [*s, class_ngrams.END]):
            last = model.label[a]
            total += model.unseen[last] if b == width - 1 else model.after[last, model.label[b]] + model.emit[b]
        expected.append(total)
    assert model.scores([s.astype(np.uint16).tobytes() for s in texts]) == pytest.approx(expected)

def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        odd_even = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(odd_even) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def _base(text):
    return [
        f"{k}:{m.start()}:{m.end()}" for k, f in FORMS.items() for m in re.finditer(f, text or "") if _valid(k, m.group())
    ]


def test_op9_base_spans(spark, empty):
    texts = [
        None, "", "a@b.co x_y@z.org;a@b@c.de.f", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "é😀 +49 (30) 123-4567. +1 2", "1" * 5000 + "a" * 5000 + "@", "+1 (269) 555-3296 4524132264652876", "a.b@c@d.e f@g-.h",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.base for r in pii.find(docs).withColumn("base", pii.written("base")).collect()}
    assert found == {i: ",".join(_base(t)) for i, t in enumerate(texts)}
    assert pii.find(empty).count() == 0


def test_op9_patterns_find_other_forms(spark):
    seeds = [(i, f"words before call: +49 30 1234{i:03d} and more") for i in range(12)]
    rows = [*seeds, (100, "please call: 030 1234 5678 today"), (101, "there were 030 1234 5678 of them"), (None, None)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, base int")
    found = {r.doc_id: r.s for r in pii.find(docs).withColumn("s", pii.written("spans")).collect()}
    assert found[100] == "phone:13:26"
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[100] == "please call: [PHONE] today" and clean[0] == "words before call: [PHONE] and more" and clean[None] is None


def test_op9_unknown_values_do_not_count_as_errors_and_found_values_are_seeds(spark):
    call = [f"please call: +49 30 1234{i:03d} now" for i in range(6)] + [f"please call: 030 5678 {i:03d} now" for i in range(4)]
    again = [f"reach us at: 030 5678 {i:03d} now" for i in range(4)] + ["reach us at: 040 999 888 now"]
    # numbers behind a pattern without seeds, behind one of mixed kinds, and behind one that meets shapes no phone has
    order = [f"order no. 555 666 {i:03d} came" for i in range(4)]
    mixed = [f"and see +49 30 7777{i:03d} now" for i in range(4)] + [f"and see x{i}@y.de now" for i in range(4)]
    shapes = [f"my code= +49 30 8888{i:03d} now" for i in range(4)] + [f"my code= 11 22 {i}3 now" for i in range(4)]
    texts = [*call, *again, *order, *mixed, "and see 030 123 4567 now", *shapes, "my code= 030 123 4568 now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    kept = {*order, "and see 030 123 4567 now", "my code= 030 123 4568 now", *shapes[4:]}
    for i, text in enumerate(texts):
        assert (masked[i] == text) == (text in kept), (text, masked[i])


def test_op9_leaves_ordinary_numbers_alone(spark):
    at = [f"get us at +49 30 555{i:04d} now" for i in range(3)]
    amounts = [f"the stock was valued at 12{i:06d} units" for i in range(200)]
    dates = [f"it stood at 2019-{1 + i % 12:02d}-{1 + i % 28:02d} again" for i in range(50)]
    ring = [f"so ring us at: +49 30 666{i:04d} now" for i in range(3)] + [f"so ring us at: 030 77{i} 88{i} now" for i in range(5)]
    shared = [f"see invoice 030 77{i} 88{i} there" for i in range(5)]
    invoices = [f"see invoice 7770{i:05d} there" for i in range(300)]
    texts = [*at, *amounts, *dates, *ring, *shared, *invoices]
    masked = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        assert (masked[i] == text) == (text in {*amounts, *dates, *invoices, *shared}), (text, masked[i])


def test_op9_many_spans_and_long_words(spark):
    import time

    number = [f"+49 30 {i:07d}" for i in range(50_000)]
    text = "ü call " + " and ".join(number) + " " + "w" * 300 + " +49 30 1234567"
    names = ["_spans", "_id", "marks", "id", "hash", "data", "row"]
    docs = spark.createDataFrame([(1, text, *range(7))], f"doc_id long, text string, {', '.join(f'{n} int' for n in names)}")
    start = time.time()
    found = pii.find(docs).collect()[0]
    want = [(m.start(), m.end()) for m in re.finditer(r"\+49 30 \d{7}", text)]
    assert [(s.start, s.end) for s in found.base if s.kind == 3] == want
    assert [text.encode()[s["from"] : s.to].decode() for s in found.base if s.kind == 3][-2:] == [number[-1], "+49 30 1234567"]
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert tuple(clean.collect()[0]) == (1, re.sub(r"\+49 30 \d{7}", "[PHONE]", text), *range(7))
    assert time.time() - start < 60
    rows = spark.createDataFrame([("a " + "w" * 300 + " 1",), ("one",), ("",), ("A  b\tC ",)], "t string")
    patterns = [r.p for r in rows.select(pii._patterns(F.col("t")).alias("p")).collect()]
    assert patterns == [["1", "w" * 300 + " 1"], ["one"], [], ["c", "b c"]]


def test_op10_against_the_library(spark, texts, odd):
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_file("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    encoder = sentencepiece_offsets.Encoder(path)
    hard = ["a▁b  c\td\ne ", "\n\n  x", "a\x00b", "\n▁ ▁▁x", "<s> </s> <0x41>", "x" * 500 + " " * 40 + "y\n\n\n z"]
    for text in [*texts.values(), *(t for _, t in ODD if t), *hard]:
        normal, source = encoder.normalize(text)
        ids = np.frombuffer(encoder.encode(normal), "<u4").astype(np.int64)
        assert ids.tolist() == library.encode(text)
        begins, data = encoder.spans(text, source, ids), text.encode()
        assert begins[0] == 0 and begins[-1] == len(data) and (np.diff(begins) >= 0).all()
    found = sentencepiece_offsets.encode(odd, path).collect()
    assert Counter((r.doc_id, r.ids, r.decoded) for r in found) == Counter(
        (i, np.array(x := library.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes(), library.decode(x))
        for i, t in ODD
    )


def test_op10_character_map():
    from sentencepiece import SentencePieceNormalizer

    try:
        normalizer = SentencePieceNormalizer(rule_name="nmt_nfkc")
        blob = normalizer.serialized_model_proto()
    except Exception as error:  # the installed library may lack the rules
        pytest.skip(str(error))
    from sentencepiece import sentencepiece_model_pb2

    chars = sentencepiece_model_pb2.ModelProto.FromString(blob).normalizer_spec.precompiled_charsmap
    table = sentencepiece_offsets.CharMap(chars)
    assert table.longest("ﬁx".encode(), 0) == (3, b"fi")
    assert table.longest("x".encode(), 0) is None


def test_packing_in_small_batches_loses_and_doubles_no_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "_BATCH_ROWS", 3)
    monkeypatch.setattr(packing, "_BATCH_BYTES", 64)
    docs = spark.createDataFrame([(i, " ".join(["word"] * (7 * i % 40))) for i in range(60)], "doc_id long, text string")
    found = packing.pack_documents(docs.coalesce(1), tokenizer_file("word_bpe_49k.json"), capacity=16).toPandas()
    for _, pieces in found.sort_values("start").groupby("doc_id"):
        assert list(pieces.start) == [0, *pieces.length.cumsum()[:-1]] and pieces.length.sum() == pieces.doc_tokens.iloc[0]
    for _, pieces in found.sort_values("offset").groupby("sequence_id"):
        assert list(pieces.offset) == [0, *pieces.length.cumsum()[:-1]] and pieces.length.sum() <= 16
    assert found.doc_id.nunique() == 60


def test_packing_holds_a_plain_word_once(monkeypatch):
    words = packing._Words(tokenizer_file("word_bpe_49k.json"))
    texts = ["alpha", "Alpha", "alpha,", "été", "Été!?", "beta", "...", "a1", "ALPHA."]
    for _ in range(2):
        for text in texts:
            assert words[text.encode()] == packing._bytes(words.tokenizer.encode(text, add_special_tokens=False).ids)
        monkeypatch.setattr(packing, "_CACHED_WORDS", 1)  # the second time, every word empties the table
    words = packing._Words(tokenizer_file("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "_CACHED_WORDS", 100)
    for text in texts[:1] + texts[5:6]:
        words[text.encode()]
    tables = [words, *(v for k, v in vars(words).items() if isinstance(v, dict) and k != "letters")]
    assert sum(map(len, tables)) == 2
