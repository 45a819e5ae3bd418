import re
from itertools import combinations
from random import Random

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlark.llm import simhash_pivots
from ledgerlark.llm.queries import tokenizer_file


def test_stages_keep_columns_and_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        rows = after.collect()
        assert after.columns == docs.columns and 0 < len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
    ids = [r.doc_id for r in rows]
    assert len(set(ids)) == len(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).toPandas()
    assert set(pieces.doc_id) == set(ids)
    assert simhash_pivots.keep_one(docs.limit(0)).count() == 0


def _plain_lines(docs):
    """Texts without the lines that three or more documents share, but for the last holder."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for doc_id, text in docs.items():
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc_id)
    shared = {k: max(ids) for k, ids in holders.items() if len(k) >= 20 and len(ids) >= 3}
    return {
        i: "\n".join(line for line in (text or "").split("\n") if shared.get(key(line), i) == i) for i, text in docs.items()
    }


def _plain_copies(docs):
    """The least document of every group of texts that are linked by fingerprints within three bits."""
    prints = {}
    for i, text in docs.items():
        words = text.lower().split()
        shingles = [" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(sorted(docs), 2):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return {i: text for i, text in docs.items() if root[i] == i}


def test_run_equals_plain_stages(spark, tmp_path):
    random = Random(12)
    words = ["".join(random.choices("abcdefgh", k=random.randint(3, 7))) for _ in range(400)]
    sentence = lambda n=9: " ".join(random.choices(words, k=n)) + "."
    docs = {i: "\n".join(sentence() for _ in range(random.randint(3, 7))) for i in range(420)}
    toxic = {i for i in docs if i % 6 == 1}
    for i in toxic:
        docs[i] += f"\nyou nasty rotten {random.choice(words)}"
    for i in range(0, 40, 4):
        docs[i] += "\n A line that Ten documents share "
    for i in range(2, 60, 6):
        docs[i] += f"\nwrite to user{i}@mail{i}.org or not"
    docs |= {500: docs[3], 501: docs[3].upper(), 502: docs[9] + " end", 600: None, 601: "", 602: " \n\t"}
    labels = [(i, 1, int(i in toxic)) for i in docs if i < 500]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    want = {i: t for i, t in docs.items() if i not in toxic}
    want = _plain_copies(_plain_lines(want))
    want = {i: re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", t) for i, t in want.items()}
    assert len(want) < 420 - len(toxic) + 6 and sum("[EMAIL]" in t for t in want.values()) >= 5

    found = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    encode = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")).encode
    texts = {i: [*encode(t, add_special_tokens=False).ids, 2] for i, t in want.items()}
    assert set(found.doc_id) == set(texts)
    for doc_id, pieces in found.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        ids = np.frombuffer(b"".join(pieces.ids), "<u4").tolist()
        assert ids == texts[doc_id] and pieces.start.tolist() == [0, *np.cumsum(pieces.length)[:-1]]
    for _, pieces in found.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == [0, *np.cumsum(pieces.length)[:-1]] and pieces.length.sum() <= 4096


def test_run_of_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_stay(spark):
    names = ["_score", "score", "_lines", "lines", "_spans", "_id", "id", "hash", "_fp", "_root", "row", "marks", "kept"]
    line = "A line that is long enough"
    rows = [(i, f"{line}\nown words {i} and a{i}@b.org", *range(len(names))) for i in range(4)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'{n} int' for n in names)}")
    folder = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        found = docs.collect()
        assert found and all(tuple(r)[2:] == tuple(range(len(names))) for r in found)
