"""Stretches of a text that repeat the same words over and over, found by block convolution.

A run is a stretch of words with smallest period q, at least `LEAST_REPEATS` periods
and `LEAST_WORDS` words long, that no neighbouring word extends. Periods are searched
by scales: at scale B (1, 2, 4, ...) those from B to 2B - 1. Every run of such a period
holds whole blocks of B words that occur again, without a mismatch, one period further on.

The sums of squared differences between a block and all places of the window behind it
are taken at once by a number-theoretic transform. They are exact modulo a prime; a sum of
zero that only the modulus makes is found out when the words themselves are compared.
Distances that enough neighbouring blocks share are seeds; the words compared beyond both
ends give the run. Two rules keep this near linear and lose no run: a block is transformed
only if each of its words comes again within 2B words, and a distance that lies inside a
run of a smaller period is left out (its stretch is that run again).

All words are compared as numbers, texts of a task side by side with a number of its own
between them, so short texts cost no step of their own.

Nulls: a null text counts as empty and has no runs; a null id is kept. Repeated rows are
treated alike, an empty table has an empty result, columns other than doc_id and text are
not read. Memory of a task holds one text, or several short ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_WORDS = 6
LEAST_REPEATS = 4
_PRIME = 3 * (1 << 30) + 1  # products of two residues fit in 64 bits
_GENERATOR = 5
_GROUP_BYTES = 1 << 22
_CACHED_WORDS = 1 << 19
_TRANSFORM = 1 << 19
_FAR = np.iinfo(np.int64).max

_RUNS = "array<struct<start: long, length: long, period: long>>"
_ROW = f"doc_id long, n_words long, runs {_RUNS}, collapsed string"


# ---- exact convolution -------------------------------------------------------


@cache
def _roots(size: int, back: bool) -> np.ndarray:
    """First half of the powers of the root of unity of this order."""
    root = pow(_GENERATOR, (_PRIME - 1) // size, _PRIME)
    root = pow(root, -1, _PRIME) if back else root
    powers = np.ones(1, np.uint64)
    while len(powers) < max(1, size // 2):
        step = np.uint64(pow(root, len(powers), _PRIME))
        powers = np.concatenate([powers, powers * step % np.uint64(_PRIME)])
    return powers


def transform(rows: np.ndarray) -> np.ndarray:
    """Transform of every row, a power of two long; the order of the result is bit-reversed."""
    prime, size = np.uint64(_PRIME), rows.shape[1]
    rows = rows.copy()
    while size > 1:
        parts = rows.reshape(rows.shape[0], -1, 2, size // 2)
        low, high = parts[:, :, 0], parts[:, :, 1]
        apart = (low + prime - high) % prime * _roots(size, False) % prime
        parts[:, :, 0] = (low + high) % prime
        parts[:, :, 1] = apart
        size //= 2
    return rows


def transform_back(rows: np.ndarray) -> np.ndarray:
    """Inverse of `transform`."""
    prime, width, size = np.uint64(_PRIME), rows.shape[1], 2
    rows = rows.copy()
    while size <= width:
        parts = rows.reshape(rows.shape[0], -1, 2, size // 2)
        low, high = parts[:, :, 0].copy(), parts[:, :, 1] * _roots(size, True) % prime
        parts[:, :, 0] = (low + high) % prime
        parts[:, :, 1] = (low + prime - high) % prime
        size *= 2
    return rows * np.uint64(pow(width, -1, _PRIME)) % prime


def zero_mismatches(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) where the block of `size` words at a start occurs `distance` words on, size <= distance < 2 size.

    The sums of squared differences are compared with zero modulo the prime. `words` must go on
    for three blocks behind the last start.
    """
    prime, found = np.uint64(_PRIME), ([], [])
    step = max(1, _TRANSFORM // (2 * size))
    for at in range(0, len(starts), step):
        some = starts[at : at + step]
        block = words[some[:, None] + np.arange(size)]
        window = words[some[:, None] + size + np.arange(2 * size)]
        turned = np.zeros((len(some), 2 * size), np.uint64)
        turned[:, :size] = block[:, ::-1]
        products = transform_back(transform(turned) * transform(window) % prime)[:, size - 1 : 2 * size - 1]
        squares = np.zeros((len(some), 2 * size + 1), np.uint64)
        np.cumsum(window * window % prime, axis=1, out=squares[:, 1:])
        own = (block * block % prime).sum(axis=1, dtype=np.uint64)
        sums = own[:, None] + (squares[:, size : 2 * size] - squares[:, :size]) + np.uint64(2) * (prime - products)
        row, place = np.nonzero(sums % prime == 0)
        found[0].append(some[row])
        found[1].append(place + size)
    return tuple(np.concatenate(part) if part else np.zeros(0, np.int64) for part in found)


# ---- runs --------------------------------------------------------------------


def _next_same(words: np.ndarray) -> np.ndarray:
    """Distance of every word to the next equal one."""
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    far = np.full(len(words), _FAR)
    far[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return far


def _chains(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First number and length of every stretch of consecutive numbers in a sorted array."""
    first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    return places[first], np.diff(first, append=len(places))


def least_length(period: np.ndarray | int) -> np.ndarray:
    return np.maximum(LEAST_WORDS, LEAST_REPEATS * period)


def _blocks_needed(size: int, period: np.ndarray | int) -> np.ndarray:
    """Whole blocks that repeat at the distance of a period in every run of it, wherever the blocks begin."""
    return (least_length(period) - period - (size - 1)) // size


def find_runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of numbers below the prime, by start and period.

    No text in the array is longer than `longest`; a number that occurs once stands between two texts.
    """
    if not len(words):
        return []
    count = len(words)
    reach = _next_same(words)
    ends = np.zeros(count, np.int64)  # end of the furthest known run that holds a word
    known: dict[tuple[int, int], int] = {}
    size = 1
    while LEAST_REPEATS * size <= longest:
        number = np.flatnonzero(reach < 2 * size)
        if not number.size:
            size *= 2
            reach = _halved(reach)
            continue
        first, length = _chains(number)
        enough = length >= _blocks_needed(size, size)
        number = np.concatenate([np.arange(a, a + n) for a, n in zip(first[enough], length[enough])] or [number[:0]])
        starts = number * size
        starts = starts[ends[starts] < starts + 3 * size]
        if starts.size:
            padded = np.concatenate([words, np.full(4 * size, words.max() + 1)]).astype(np.uint64)
            for run in _extended(words, *zero_mismatches(padded, starts, size), size, ends):
                known.setdefault(run[:2], run[2])
        for (start, end), period in known.items():
            if size <= period < 2 * size:
                ends[start:end] = np.maximum(ends[start:end], end)
        size *= 2
        reach = _halved(reach)
    return sorted((start, end - start, period) for (start, end), period in known.items())


def _halved(reach: np.ndarray) -> np.ndarray:
    """Greatest value of every two neighbours."""
    if len(reach) % 2:
        reach = np.append(reach, _FAR)
    return np.maximum(reach[0::2], reach[1::2])


def _extended(
    words: np.ndarray, starts: np.ndarray, distances: np.ndarray, size: int, ends: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the runs behind the seeds, smaller periods first."""
    new = ends[starts] < starts + size + distances
    starts, distances = starts[new], distances[new]
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    cut = (np.diff(starts, prepend=-1) != size) | (np.diff(distances, prepend=-1) != 0)
    first = np.flatnonzero(cut)
    length = np.diff(first, append=len(starts))
    for at, blocks in zip(first.tolist(), length.tolist()):
        period = int(distances[at])
        if blocks < _blocks_needed(size, period):
            continue
        low, high = int(starts[at]), min(int(starts[at]) + blocks * size, len(words) - period)
        # the modulus can make a sum zero: only words that truly repeat count
        for begin, same in zip(*_chains(np.flatnonzero(words[low:high] == words[low + period : high + period]))):
            start = _left(words, low + int(begin), period, size)
            end = _right(words, low + int(begin + same), period, size) + period
            if end - start >= least_length(period):
                yield start, end, period


def _left(words: np.ndarray, low: int, period: int, step: int) -> int:
    """Least place from which all words up to `low` equal those a period on."""
    while low:
        at = max(0, low - step)
        other = np.flatnonzero(words[at:low] != words[at + period : low + period])
        if other.size:
            return at + int(other[-1]) + 1
        low, step = at, 2 * step
    return low


def _right(words: np.ndarray, high: int, period: int, step: int) -> int:
    """First place from `high` on whose word is not the one a period on."""
    last = len(words) - period
    while high < last:
        at = min(last, high + step)
        other = np.flatnonzero(words[high:at] != words[high + period : at + period])
        if other.size:
            return high + int(other[0])
        high, step = at, 2 * step
    return high


# ---- documents ---------------------------------------------------------------


class _Numbers(dict):
    """Number of every word, from 1 on, given when first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def detect(
    docs: DataFrame, rearranged: Callable[[int | None, int], np.ndarray | None] = lambda doc_id, n: None
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of docs (doc_id, text).

    `runs` are ordered by start and period and count words from 0. `collapsed` is the text
    with only the first period of every run, its words joined by one space. `rearranged` may
    give the places of the words to use instead of a text's own, for its id and number of words.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = _Numbers(), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = text.as_py() or b""
                words = data.split()
                places = rearranged(doc_id, len(words))
                if places is not None:
                    words = [words[i] for i in places.tolist()]
                held.append((doc_id, words))
                size += len(data)
                if size >= _GROUP_BYTES:
                    yield _documents(held, numbers)
                    held, size = [], 0
        if held:
            yield _documents(held, numbers)

    return docs.select("doc_id", "text").mapInArrow(found, _ROW)


def _documents(held: list[tuple[int | None, list[bytes]]], numbers: _Numbers) -> pa.RecordBatch:
    if len(numbers) >= _CACHED_WORDS:
        numbers.clear()
    sizes = np.array([len(words) for _, words in held], np.int64)
    firsts = np.cumsum(sizes + 1) - sizes - 1
    joined = np.zeros(int(sizes.sum()) + len(held), np.int64)
    for first, (_, words) in zip(firsts.tolist(), held):
        joined[first : first + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    joined[firsts + sizes] = len(numbers) + 1 + np.arange(len(held))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in held]
    for start, length, period in find_runs(joined, int(sizes.max(initial=0))):
        at = int(np.searchsorted(firsts, start, "right")) - 1
        runs[at].append((start - int(firsts[at]), length, period))
    texts = []
    for own, (_, words) in zip(runs, held):
        if own:
            gone = np.zeros(len(words), bool)
            for start, length, period in own:
                gone[start + period : start + length] = True
            words = [words[i] for i in np.flatnonzero(~gone).tolist()]
        texts.append(b" ".join(words))
    named = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    columns = [
        pa.array([doc_id for doc_id, _ in held], pa.int64()), pa.array(sizes), pa.array(named, kind),
        pa.array(texts, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])
