"""Toxicity by multiple-instance learning: a document is a bag of sentences, only documents are labelled.

A sentence has the logit b + sum of the weights of the features (the word and its
prefixes) of its distinct words; a document is toxic unless every sentence is clean and the
label is not a stray one: 1 - (1 - leak) * product(1 - p). The leak, one
learned number, takes up labels without any offending sentence, which would
otherwise make long documents suspect by their length. Only features that toxic
documents hold more often than chance explains have a weight, by a likelihood
ratio test on numbers of documents; few labels would otherwise be learnt by
heart. The weights are fitted to document labels by gradient
ascent, on at most `TRAIN_DOCS` documents of either label drawn by a hash;
clean ones are weighted up to their true share. The gradient of a toxic
document goes to the sentences that explain it, so the sentence scores locate
the offending ones.

Nulls and edges: a null or empty text is one empty sentence. Rows without
labels or with null labels teach nothing; several labels of one id count as
toxic if any is. With no label of one kind the score is the share of toxic
labels, 0 without any label.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_DOCS = 2000
FEATURES = 1 << 18
SENTENCE_WORDS = 40
PREFIXES = (4, 5, 6)
FOLDS = 5
_STEPS = 100
_RATE = 0.5
_DECAY = 1e-5
_FIRST_BIAS = -8.0
_LEAST_RATIO = 10.83  # chi-squared with one degree of freedom, 0.001
_CACHED_WORDS = 1 << 19
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the sentences, cut at `SENTENCE_WORDS` words; one empty sentence at least."""
    found = []
    for match in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(match.group().lower())
        if len(words) <= SENTENCE_WORDS:
            if words:
                found.append((match.start(), match.end(), words))
            continue
        places = [(m.start(), m.end()) for m in _WORD.finditer(match.group())]
        words = [match.group()[a:b].lower() for a, b in places]
        for i in range(0, len(words), SENTENCE_WORDS):
            last = min(i + SENTENCE_WORDS, len(words)) - 1
            found.append((match.start() + places[i][0], match.start() + places[last][1], words[i : last + 1]))
    return found or [(0, 0, [])]


def features(word: str) -> list[int]:
    """Hashed features of a word: itself and its prefixes."""
    names = [word] + [f"{word[:n]}-" for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(name.encode("utf-8")) % FEATURES for name in names]


def telling(flat: np.ndarray, ends: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Whether a feature is in more toxic documents than chance explains. ends: end of each document in flat."""
    counts = np.zeros((2, FEATURES), np.int64)
    for start, end, toxic in zip([0, *ends[:-1]], ends, positive):
        counts[int(toxic), np.unique(flat[start:end])] += 1
    sides = np.bincount(positive, minlength=2)
    share = counts.sum(axis=0) / max(1, len(positive))
    ratio = np.zeros(FEATURES)
    for count, size in zip(counts, sides):
        for seen, expected in ((count, size * share), (size - count, size * (1 - share))):
            ratio += 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12))
    return (ratio >= _LEAST_RATIO) & (counts[1] > sides[1] * share)


def fit(
    flat: np.ndarray, sizes: np.ndarray, bags: np.ndarray, labels: np.ndarray, shares: np.ndarray
) -> tuple[np.ndarray, float, float]:
    """(weights, bias, leak logit) of the noisy-or model.

    flat: the features of all sentences; sizes: their number per sentence; bags: sentences per document.
    """
    positive = labels > 0
    bag_of = np.repeat(np.arange(len(bags), dtype=np.int32), bags)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(bags)]
    place = np.flatnonzero(telling(flat, ends, positive)[flat])
    sentence = np.searchsorted(np.cumsum(sizes), place, side="right")
    flat = flat[place]
    weights, bias, leak = np.zeros(FEATURES), _FIRST_BIAS, _FIRST_BIAS
    seen, seen_bias, seen_leak = np.full(FEATURES, 1e-10), 1e-10, 1e-10
    share = shares / shares.sum()
    for _ in range(_STEPS):
        logit = bias + np.bincount(sentence, weights[flat], len(sizes))
        clean = np.logaddexp(0.0, logit)  # -log(1 - p)
        none = np.bincount(bag_of, clean, len(bags)) + np.logaddexp(0.0, leak)  # -log of no toxic sentence
        odds = 1.0 / np.expm1(np.clip(none, 1e-9, 500.0))
        pull = np.where(positive, odds, -1.0) * share  # of one more unit of -log(1 - p)
        slope = pull[bag_of] * -np.expm1(-clean)
        step = np.bincount(flat, slope[sentence], FEATURES) - _DECAY * weights
        seen += step * step
        weights += _RATE * step / np.sqrt(seen)
        lean, lift = slope.sum(), (pull / (1.0 + math.exp(-leak))).sum()
        seen_bias, seen_leak = seen_bias + lean * lean, seen_leak + lift * lift
        bias += _RATE * lean / math.sqrt(seen_bias)
        leak += _RATE * lift / math.sqrt(seen_leak)
    return weights, bias, leak


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, folds: int = FOLDS) -> tuple:
    """(weights, bias, leak) from docs (doc_id, text) and labels (doc_id, toxic), or (None, share, 0) with one kind of label.

    Only documents whose crc32(doc_id as text) mod `folds` is not 0 are used, at most
    `train_docs` of either label, the least by a hash of the id.
    """
    taught = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(F.crc32(F.col("doc_id").cast("string")) % folds != 0)
    )
    known = docs.where("doc_id is not null").select("doc_id").distinct().join(taught, "doc_id")
    counts = dict(known.groupBy("toxic").count().collect())
    if len(counts) < 2:
        return None, float(bool(counts.get(1))), 0.0
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        chosen = some if chosen is None else chosen.unionAll(some)

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for label, text in zip(batch["toxic"], batch["text"]):
                found = [[f for word in dict.fromkeys(words) for f in features(word)] for _, _, words in sentences(text)]
                flat = np.fromiter((f for sentence in found for f in sentence), "<i4")
                rows.append((label, np.array([len(x) for x in found], "<i4").tobytes(), flat.tobytes()))
            yield pd.DataFrame(rows, columns=["toxic", "sizes", "flat"])

    found = (
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .dropDuplicates(["doc_id"])
        .select("toxic", "text")
        .mapInPandas(bag, "toxic int, sizes binary, flat binary")
        .toPandas()
    )
    target = found["toxic"].to_numpy()
    used = np.bincount(target, minlength=2)
    shares = np.where(target > 0, counts[1] / max(1, used[1]), counts[0] / max(1, used[0]))
    flat, sizes = (np.frombuffer(b"".join(found[c]), "<i4") for c in ("flat", "sizes"))
    return fit(flat, sizes, np.array([len(x) // 4 for x in found["sizes"]]), target, shares)


class _Weights(dict):
    """Summed weight of a word's features, looked up when first asked for."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = value = float(sum(self.weights[f] for f in features(word)))
        return value


def scored(text: Column, model: tuple) -> Column:
    """(score, start, end, worst) of a text: its score, and its worst sentence with that sentence's own score."""
    weights, bias, leak = model
    weights = None if weights is None else weights.astype(np.float32)
    stray = math.log1p(math.exp(leak))

    @F.pandas_udf("score double, start int, end int, worst double")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = None if weights is None else _Weights(weights).__getitem__
        for texts in batches:
            rows = []
            for text in texts:
                parts = sentences(text)
                if of is None:
                    rows.append((bias, parts[0][0], parts[0][1], bias))
                    continue
                logits = [bias + sum(map(of, dict.fromkeys(words))) for _, _, words in parts]
                none = stray + sum(z if z > 30 else math.log1p(math.exp(z)) for z in logits)
                worst = max(range(len(parts)), key=logits.__getitem__)
                start, end, _ = parts[worst]
                rows.append((-math.expm1(-none), start, end, 1.0 / (1.0 + math.exp(-max(-500.0, logits[worst])))))
            yield pd.DataFrame(rows, columns=["score", "start", "end", "worst"])

    return found(text)


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, text, score, start, end, worst) per row of docs: offsets of the worst sentence are code points."""
    return docs.select("doc_id", "text", scored(F.col("text"), model).alias("found")).select("doc_id", "text", "found.*")


def accepted(docs: DataFrame, model: tuple, threshold: float = 0.5) -> DataFrame:
    """The rows of docs with a score below the threshold."""
    return docs.where(scored(F.col("text"), model)["score"] < threshold)
