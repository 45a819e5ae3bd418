"""Source divergence, periodic runs and web archives against plain versions, with odd rows and broken input."""

import gzip
import hashlib
import io
import re
import zlib

import numpy as np
import pytest
from check import connect, difference
from pyspark.sql import functions as F

from ledgerlark.llm import hot_keys, periodic_runs, source_divergence, warc
from ledgerlark.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


# ---- source divergence -------------------------------------------------------


def _plain_divergence(rows, least_docs, top=50):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub(
        "[A-Z]", lambda m: m.group().lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        terms = sorted(t for t in {t for d in own for t in d[2]} if sum(t in d[2] for d in own) >= least_docs)

        def shares(some):
            counts = {t: sum(d[2].count(t) for d in some) for t in terms}
            below = sum(counts.values()) + 5 * len(terms)
            return counts, {t: 1 + 10**9 * (n + 5) // below for t, n in counts.items()}

        whole = shares(own)[1]
        groups = {s: shares([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        for s, (counts, p) in groups.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in terms), o) for o, (_, q) in groups.items() if o != s]
            above = [(p[t] - whole[t], t) for t in terms if counts[t] and p[t] > whole[t]]
            for part, found in (("pair", pairs), ("term", above)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                cut = found if part == "pair" else found[:top]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(cut)]
    return sorted(out)


ODD_SOURCES = [
    (None, None, None, 1), ("en", None, "a b a", 2), ("en", "x", "A-B c\x00É é", 3), ("en", "x", "A-B c\x00É é", 3),
    ("en", "y", "b b É日本 😀x", 4), ("en", "z", "", 5), ("de", "x", "einmal", 6), ("de", "y", None, 7),
    ("fr", "only", "un un deux " * 3000, 8),
]


@pytest.fixture(scope="module")
def odd_sources(spark):
    return spark.createDataFrame(ODD_SOURCES, "lang string, source string, text string, digest int").repartition(3)


@pytest.mark.parametrize("bits", [64, 2])
def test_divergence_of_odd_rows_and_of_terms_that_share_a_digest(odd_sources, bits):
    for least_docs in (1, 2, 3):
        found = source_divergence.divergence(odd_sources, least_docs, 2, bits).collect()
        assert sorted(map(tuple, found)) == _plain_divergence([r[:3] for r in ODD_SOURCES], least_docs, 2)


def test_divergence_of_an_empty_table(odd_sources):
    assert source_divergence.divergence(odd_sources.limit(0)).count() == 0


def test_counts_in_parts_and_long_texts(odd_sources, monkeypatch):
    monkeypatch.setattr(source_divergence, "_HELD_TERMS", 2)
    monkeypatch.setattr(source_divergence, "_PIECE_BYTES", 16)
    counted = source_divergence.count_terms(odd_sources)
    docs = {(r.lang, r.term): r.n for r in counted.groupBy("lang", "term").agg(F.sum("docs").alias("n")).collect()}
    assert docs["fr", "un"] == 1 and docs["en", "a"] == 3 and docs["en", "é"] == 2
    each = counted.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("s"))
    found = each.groupBy("lang", "s.sources", "term").agg(F.sum("s.counts").alias("n")).collect()
    counts = {tuple(r)[:3]: r.n for r in found}
    assert counts["fr", "only", "un"] == 6000 and counts["en", "x", "a"] == 2
    assert counts["en", "y", "b"] == 2 and counts["en", "", "a"] == 2 and counts["en", "x", "é"] == 2


def test_shares_are_exact_beyond_long_products(spark):
    rows = [(7 * 10**14 + 3, 9 * 10**14 + 1, 10**6), (0, 0, 0), (0, 0, 3)]
    found = spark.createDataFrame(rows, "n long, total long, terms long").select(source_divergence._share("n").alias("p"))
    assert [r.p for r in found.collect()] == [1 + 10**9 * (n + 5) // max(1, total + 5 * v) for n, total, v in rows]


# ---- periodic runs -----------------------------------------------------------


def _plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_transform_convolves_exactly():
    random = np.random.default_rng(5)
    a, b = random.integers(0, periodic_runs._PRIME, (2, 1, 16), dtype=np.uint64)
    product = periodic_runs.transform(a) * periodic_runs.transform(b) % np.uint64(periodic_runs._PRIME)
    want = [sum(int(a[0, i]) * int(b[0, (k - i) % 16]) for i in range(16)) % periodic_runs._PRIME for k in range(16)]
    assert periodic_runs.transform_back(product)[0].tolist() == want


def test_zero_mismatches_are_the_places_of_a_block():
    words = np.array([1, 2, 1, 2, 1, 2, 3, 1, 2, 1, 2, 9, 9, 9, 9, 9, 9, 9, 9, 9], np.uint64)
    found = periodic_runs.zero_mismatches(words, np.array([0, 2, 4]), 2)
    assert sorted(zip(*map(np.ndarray.tolist, found))) == [(0, 2), (2, 2), (4, 3)]


def test_runs_of_random_words():
    random = np.random.default_rng(11)
    total = 0
    for _ in range(600):
        words = random.integers(1, random.choice([2, 3, 4, 30]), random.integers(1, 150)).tolist()
        for _ in range(random.integers(0, 4)):
            at, period = int(random.integers(len(words))), int(random.integers(1, max(2, min(20, len(words) // 4))))
            for i in range(at + period, min(len(words), at + int(random.integers(8 * period + 1)))):
                words[i] = words[i - period]
        found = periodic_runs.find_runs(np.array(words, np.int64), len(words))
        assert found == _plain_runs(words)
        total += len(found)
    assert total > 500


def test_a_sum_that_only_the_modulus_makes_zero_is_no_run(monkeypatch):
    # every distance is taken for a seed; only words that truly repeat may count
    def all_zero(words, starts, size):
        distance = np.arange(size, 2 * size)
        return np.repeat(starts, size), np.tile(distance, len(starts))

    monkeypatch.setattr(periodic_runs, "zero_mismatches", all_zero)
    random = np.random.default_rng(2)
    for _ in range(200):
        words = random.integers(1, 3, 60).tolist()
        assert periodic_runs.find_runs(np.array(words, np.int64), 60) == _plain_runs(words)


@pytest.mark.parametrize(
    "words, longest",
    [([1] * 200_000, 200_000), (([1] * 999 + [2]) * 100, 100_000), (list(range(100_000)) + [5, 6] * 40_000, 80_000)],
)
def test_long_repetitive_texts_take_no_quadratic_time(words, longest):
    found = periodic_runs.find_runs(np.array(words, np.int64) + 1, len(words))
    assert max(length for _, length, _ in found) == longest


def test_op12_against_plain_code(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = QUERIES["op12_periodic_runs"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    planted = 0
    for row in found:
        words = re.findall("[^\x20\x09-\x0d]+", texts[row.doc_id] or "")
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = _plain_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert tuple(row)[1:] == (
            len(runs), s, length, q, length and 1000 * length // q,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest(),
        )
    assert planted > 10 and sum(r.n_runs for r in found) > 5


def test_runs_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "_GROUP_BYTES", 40)
    rows = [
        (1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "a a a a a a", 0), (4, "a a a a a a", 0), (5, "a a a a a", 0),
        (None, "x y " * 5, 0), (6, "é ü " * 4 + "é", 0), (7, "a b " * 50_000 + "end", 0), (8, "a a", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").coalesce(1)
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.detect(docs).collect()]
    assert found == [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
        (5, 5, [], "a a a a a"), (None, 10, [(0, 10, 2)], "x y"), (6, 9, [(0, 9, 2)], "é ü"),
        (7, 100_001, [(0, 100_000, 2)], "a b end"), (8, 2, [], "a a"),
    ]
    assert periodic_runs.detect(docs.limit(0)).count() == 0


# ---- web archives ------------------------------------------------------------


def _archive(*members):
    return b"".join(members)


def _read(data, keep_payload=True):
    return list(warc.read_records(io.BytesIO(data), keep_payload))


def test_record_ids_hold_the_page_id(spark):
    ids = [0, 1, 12345, 2**62, 2**63 - 1, -1, -(2**63), -(2**62)]
    assert [warc.page_of(warc.record_id(i)) for i in ids] == ids
    assert warc.page_of(warc.record_id(None)) is None and warc.page_of(None) is None
    rows = [(i, warc.record_id(i)) for i in [*ids, None]] + [(None, None)]
    found = spark.createDataFrame(rows, "id long, urn string").select("id", warc.page_column("urn").alias("page"))
    assert all(r.id == r.page for r in found.collect())


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_records_are_read_as_written(monkeypatch, chunk):
    monkeypatch.setattr(warc, "_CHUNK", chunk)
    pages = [(1, "http://a/\r\nX: y", b"<p>one</p>", None), (2, None, b"", None), (3, "http://ü/", b"\r\n\r\n" * 500, None),
             (4, "http://c/", b"\r\n\r\n" * 500, 3)]
    members = [warc.info_member("x.warc.gz"), *(warc.page_member(*p) for p in pages)]
    found = _read(_archive(*members))
    assert [r["record_type"] for r in found] == ["warcinfo", "response", "response", "response", "revisit"]
    assert [r["payload"] for r in found[1:]] == [p[2] for p in pages[:3]] + [None]
    assert [r["payload_bytes"] for r in found[1:]] == [len(p[2]) for p in pages]
    assert [r["payload_digest"] for r in found[1:]] == [hashlib.sha1(p[2]).hexdigest() for p in pages]
    assert [r["offset"] for r in found] == [sum(map(len, members[:i])) for i in range(len(members))]
    assert found[1]["target_uri"] == "http://a/ X: y" and warc.page_of(found[4]["refers_to"]) == 3
    # one member a record, each framed by its content length
    blocks = [gzip.decompress(m) for m in members]
    assert all(b.startswith(b"WARC/1.1\r\n") and b.endswith(b"\r\n\r\n") for b in blocks)


def test_broken_archives_are_found():
    good = warc.page_member(1, "u", b"payload " * 50, None)
    plain = gzip.decompress(good)
    broken = [
        good[:-9], good[:30], b"no gzip", gzip.compress(plain.replace(b"payload ", b"Payload ", 1)),
        gzip.compress(plain[:-4]), gzip.compress(plain + b"x"), gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"),
        gzip.compress(b"x" * 3_000_000),
    ]
    for data in broken:
        with pytest.raises(warc.BrokenArchive):
            _read(_archive(good, data))
    assert _read(b"") == []


def test_digests_in_hexadecimal_and_records_of_other_kinds():
    data = b"some text"
    fields = {"WARC-Type": "resource", "WARC-Record-ID": "<urn:uuid:x>", "Content-Type": "text/plain",
              "WARC-Payload-Digest": f"sha1:{hashlib.sha1(data).hexdigest()}"}
    [record] = _read(warc._member(fields, data))
    assert record["payload"] == data and record["refers_to"] is None
    with pytest.raises(warc.BrokenArchive):
        _read(warc._member(fields, data + b"!"))


def test_archives_of_odd_pages(spark):
    large = "é" * 600
    rows = [
        (1, "a", large), (5, "b", large), (5, "b", large), (3, None, large), (None, "c", large), (2, "d", None),
        (4, "e", ""), (6, "f", "small"), (7, "g", "small"), (None, "h", "n" * 2000), (None, "i", "n" * 2000),
        (8, "j", "x" * 3_000_000),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, key string")
    archives = warc.write_archives(pages.repartition(3), archive_bytes=600)
    assert archives.count() > 3 and archives.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read_archives(archives).where("record_type != 'warcinfo'").withColumn("page_id", warc.page_column("record_id"))
    got = sorted(
        (r.page_id or 0, r.target_uri, r.record_type, warc.page_of(r.refers_to), r.payload_bytes) for r in found.collect()
    )
    n = len(large.encode())
    assert got == sorted([
        (1, "a", "revisit", 5, n), (5, "b", "response", None, n), (5, "b", "response", None, n), (3, "", "revisit", 5, n),
        (0, "c", "revisit", 5, n), (2, "d", "response", None, 0), (4, "e", "response", None, 0),
        (6, "f", "response", None, 5), (7, "g", "response", None, 5), (0, "h", "response", None, 2000),
        (0, "i", "response", None, 2000), (8, "j", "response", None, 3_000_000),
    ])
    payloads = {r.target_uri: bytes(r.payload).decode() for r in found.where("record_type = 'response'").collect()}
    assert payloads == {r[1]: r[2] or "" for r in rows if r[1] and r[1] in "bdefghij"}
    empty = warc.write_archives(pages.limit(0))
    assert empty.count() == 0 and warc.read_archives(empty).count() == 0


def test_join_one_with_a_hot_key(spark):
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)] + [(None, 1)], "k long, i long")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top")).where("n > 1 or k > 2500")
    found = {tuple(r) for r in hot_keys.join_one(rows, groups, ["k"], "n").select("k", "i", "top").collect()}
    want = {(k, i) for k, i in ((0 if i % 3 else i, i) for i in range(3000)) if k == 0 or k > 2500}
    assert {r[:2] for r in found} == want and all(top == (2999 if k == 0 else k) for k, _, top in found)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_warc"])
def test_against_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None
