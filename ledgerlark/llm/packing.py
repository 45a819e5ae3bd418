"""Packing of documents into sequences of a fixed number of tokens.

A document's ids are cut into whole sequences from its start; what remains is
packed first-fit decreasing: remainders by falling size, each into the first
bin with room, found in a tournament tree of the bins' free capacity. Groups
of documents, drawn by a hash, are packed independently, so the work is spread
and a group has a bounded number of documents. After that the lightest bins of
a group are cut up to fill the gaps of the others.

Words are encoded when a worker process first meets them and looked up after
that: the tokenizer drops white space and never joins across it.

Nulls: a null text counts as empty; an empty text has the end id alone. Rows
with equal or null document ids are packed as documents of their own.
"""

from __future__ import annotations

import os
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 4096
END_ID = 2
GROUP_DOCS = 8192
GROUP_TOKENS = 1 << 24
LEAST_CUT = 16
_CACHED_WORDS = 1 << 19
_CACHED_MARKS = 1 << 10
_BATCH_BYTES = 1 << 22
_BATCH_ROWS = 256
_MARKS = ".,;:!?"

_PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it shows, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


class _Words(dict):
    """Ids of words as bytes. Words are encoded only when first met.

    A word of letters with a mark behind it is two tokens of the pre-tokenizer, encoded apart:
    so the many words that differ in the mark or in case alone cost one encoding, kept with the
    plain word. Letters of Latin-1 have one normal form, their lower case, and go to the model
    at once; all else goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.marks: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        text = word.decode("utf-8")
        body = text.rstrip(_MARKS)
        if body.isalpha() and (body.isascii() or max(body) < "\u0100"):
            plain = body.lower()
            value = self.of_part(text) if plain == text else self[plain.encode("utf-8")]
            if len(body) < len(text):
                value += self.of_marks(text[len(body) :])
        else:
            value = _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = value
        return value

    def of_part(self, part: str) -> bytes:
        known = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(self.letters)
        return _bytes([token.id for token in self.model(known)])

    def of_marks(self, marks: str) -> bytes:
        value = self.marks.get(marks)
        if value is None:
            if len(self.marks) >= _CACHED_MARKS:
                self.marks.clear()
            value = self.marks[marks] = self.of_part(marks)
        return value


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _words(path: str) -> _Words:
    """The table of this worker process, which the tasks that it runs one after another share.

    This module travels by value, so each task has globals of its own; a module of the process has not.
    """
    tables = sys.modules.setdefault("_ledgerlark_words", types.ModuleType("_ledgerlark_words")).__dict__
    if path not in tables:
        tables[path] = _Words(path)
    return tables[path]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most `capacity` ids (unsigned 32-bit, little-endian) of docs (doc_id, text), with the end id."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # of tasks of other stages that this worker process ran
        words, end = _words(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, size = ([], [], [], [], []), 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ids = b"".join(map(words.__getitem__, (text.as_py() or b"").split())) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    part = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(rows, (doc_id, start, length, total, part)):
                        column.append(value)
                size += len(ids)
                if size >= _BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = ([], [], [], [], []), 0
            yield _batch(rows)

    return docs.select("doc_id", "text").mapInArrow(pieces, _PIECE)


def _batch(rows: tuple[list, ...]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * (len(rows) - 5)
    names = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"][: len(rows)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of every item: items by falling size, each into the first bin with room."""
    width = 1 << max(0, len(sizes) - 1).bit_length()
    free = [capacity] * (2 * width)  # node n holds the most free room of bins under it
    bins = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        node, size = 1, sizes[item]
        while node < width:
            node *= 2
            if free[node] < size:
                node += 1
        bins[item] = node - width
        free[node] -= size
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
    return bins


def fill_gaps(
    bins: list[list[tuple[int, int, int]]], capacity: int, least_cut: int = LEAST_CUT
) -> list[list[tuple[int, int, int]]]:
    """Cut the lightest bins into the gaps of the fullest. A bin is a list of (item, start, length).

    Gaps of fewer than `least_cut` tokens stay as they are.
    """
    loads = [sum(length for _, _, length in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: -loads[i])
    bins, loads = [list(bins[i]) for i in order], [loads[i] for i in order]
    taker, giver = 0, len(bins) - 1
    while taker < giver:
        gap = capacity - loads[taker]
        if gap < least_cut:
            taker += 1
            continue
        item, start, length = bins[giver].pop()
        moved = min(gap, length)
        bins[taker].append((item, start + length - moved, moved))
        loads[taker] += moved
        loads[giver] -= moved
        if moved < length:
            bins[giver].append((item, start, length - moved))
        if not bins[giver]:
            giver -= 1
    return bins[: giver + 1]


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """Pieces with sequence_id and offset; a piece may be cut further.

    A sequence lies in one group, a group in one partition; a group ends at `group_docs`
    remainders or `group_tokens` tokens, so memory does not grow with the input.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, tokens = TaskContext.get().partitionId() << 33, [], 0
        for batch in (b.slice(at, _BATCH_ROWS) for b in batches for at in range(0, b.num_rows, _BATCH_ROWS)):
            whole: tuple[list, ...] = ([], [], [], [], [], [], [])
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[2] == capacity:
                    for column, value in zip(whole, (*row, number, 0)):
                        column.append(value)
                    number += 1
                    continue
                held.append(row)
                tokens += row[2]
                if len(held) >= group_docs or tokens >= group_tokens:
                    rows, number = _group(held, capacity, number)
                    yield rows
                    held, tokens = [], 0
            yield _batch(whole)
        if held:
            yield _group(held, capacity, number)[0]

    dealt = pieces.repartition(F.xxhash64("doc_id", "start", F.crc32("ids"))).sortWithinPartitions(
        F.xxhash64("doc_id", F.lit(1)), "doc_id", "start", "ids"
    )
    return dealt.mapInArrow(packed, f"{_PIECE}, sequence_id long, offset long")


def _group(held: list[tuple], capacity: int, number: int) -> tuple[pa.RecordBatch, int]:
    chosen = first_fit_decreasing([row[2] for row in held], capacity)
    bins: list[list] = [[] for _ in range(max(chosen) + 1)]
    for item, place in enumerate(chosen):
        bins[place].append((item, 0, held[item][2]))
    rows: tuple[list, ...] = ([], [], [], [], [], [], [])
    for content in fill_gaps(bins, capacity):
        offset = 0
        for item, start, length in content:
            doc_id, first, _, total, ids = held[item]
            part = ids[4 * start : 4 * (start + length)]
            for column, value in zip(rows, (doc_id, first + start, length, total, part, number, offset)):
                column.append(value)
            offset += length
        number += 1
    return _batch(rows), number


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset) per piece of every document of docs."""
    return pack(tokenize(docs, tokenizer, end_id, capacity), capacity)
