"""Language-model scores from class bigrams over words.

Words get classes by exchange clustering: the `FREQUENT` words of the training
text start in classes by rank and move, one at a time, to the class that raises
the likelihood of the class bigrams most, until a round moves none. All other
words of the training text start in classes by their frequency and move in
rounds on Spark: the classes around a word are counted, and it goes to the class
under which they are likeliest by the class bigrams of the round, taken without
its own. All words move in the first round, then either half in turn, as
neighbours that move together may spoil each other's gain. Rounds end when few
words move, or with the last one that raised the likelihood. The probability of a word is that of its
class after the class before it, times that of the word within its class:
transitions are smoothed with the class frequencies, and what an absolute
discount takes from every word's count is the share of unseen words.

Counting covers the whole training text. Documents are read in blocks; a block
holds its own list of words, and only lists and counts are shuffled: a word
meets its counts from all blocks, at most one from each, then each block gets
the totals of its words, as packed lists.
The clustering of the frequent words needs the pair counts of them and of classes
alone, a matrix whose size does not depend on the input. A round for the others
shuffles the counts of the classes around each word of a block, packed by ranges of
word hashes. Stage tables that no later step reads are removed.

Nulls and edges: a null or empty text has the end token alone. A null id is
training text. With no training text every token is unseen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.removal import drop_stage
from ledgerlark.storage import shared_folder, write_stage

FREQUENT = 1000
CLASSES = 48
BANDS = 32  # first classes of the other words, by the power of two of their count; the last one is for unseen words
ALL = 1 + CLASSES + BANDS  # the end token's class, those of frequent words, the bands
ROUNDS = 12
FEW = 0.1  # rounds end when at most this share of the words moves
FOLDS, HELD_OUT = 7, 2
_BLOCK_CHARS = 6 << 20
_PAIR_BYTES = 2 << 20
_PART_WORDS = 200_000  # words of blocks in a part of a round, about
_LISTED = [("local", np.int32), ("total", np.int64), ("symbol", np.uint16), ("first", bool), ("hash", np.int64)]
_LISTED_ROWS = 1 << 20
_ENTRIES = 1 << 16
_CHUNK = 1024  # words whose sums by class are held at once
_SMOOTHING = 4.0
END = 0  # the end token has the first place among the frequent words




def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: ids, held-out flags, lengths and local word numbers of its documents; its words and counts."""
    from zstandard import ZstdCompressor

    number, squeeze = TaskContext.get().partitionId() << 33, ZstdCompressor(level=1).compress
    names = ["block", "doc_ids", "held", "lengths", "tokens", "words", "counts"]

    def whole(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def close(docs: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, held, texts = (pa.concat_arrays([x.column(i) for x in docs]) for i in range(3))
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words, ends = pieces.flatten(), np.cumsum(pc.list_value_length(pieces).to_numpy())
        full = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves an empty piece
        lengths = np.diff(np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[ends], prepend=0)
        words = words.filter(full).dictionary_encode()
        flat, local = words.indices.to_numpy(), words.dictionary.cast(pa.binary())
        taught = np.repeat(~held.to_numpy(zero_copy_only=False), lengths)
        counts = np.bincount(flat[taught], minlength=len(local))
        lists = [whole(x) for x in (ids, held, pa.array(lengths, pa.int32()), local, pa.array(counts, pa.int64()))]
        row = [pa.array([number]), *lists[:3], pa.array([squeeze(_planes(flat))]), *lists[3:]]
        return pa.RecordBatch.from_arrays(row, names=names)

    docs, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy() + np.int64(1))
        at = 0
        while at < len(ends):  # a block ends with the document that fills it
            before = int(ends[at - 1]) if at else 0
            stop = min(int(np.searchsorted(ends, before + _BLOCK_CHARS - size)) + 1, len(ends))
            docs.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1]) - before
            at = stop
            if size >= _BLOCK_CHARS:
                yield close(docs)
                number += 1
                docs, size = [], 0
    if docs:
        yield close(docs)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for place in range(batch.num_rows):
            yield batch.slice(place, 1).to_pylist()[0]


def _planes(*lists: np.ndarray) -> bytes:
    """Numbers one after another, of each list all first bytes, then all second ones: high bytes mostly alike pack well."""
    planes = []
    for v in lists:
        each = np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize)
        planes += [each[:, i].tobytes() for i in range(v.itemsize)]
    return b"".join(planes)


def _from_planes(raw: bytes, kinds: list[tuple[type, int]], at: int = 0) -> list[np.ndarray]:
    """Lists of (kind, length) from what `_planes` made of them, from place `at`."""
    found = []
    for kind, n in kinds:
        size = np.dtype(kind).itemsize
        each = np.empty((n, size), np.uint8)
        for i in range(size):
            each[:, i] = np.frombuffer(raw, np.uint8, n, at + i * n)
        found.append(each.view(kind).reshape(n))
        at += n * size
    return found


def _unpacked(value: bytes, kind: type) -> np.ndarray:
    from zstandard import ZstdDecompressor

    raw = ZstdDecompressor().decompress(value)
    return _from_planes(raw, [(kind, len(raw) // np.dtype(kind).itemsize)])[0]


def _by_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, local, total, symbol, first, hash) of a task as packed lists, one of each block in `_LISTED_ROWS` rows."""
    from zstandard import ZstdCompressor

    squeeze = ZstdCompressor(level=1).compress

    def lists(rows: pa.Table) -> pa.RecordBatch:
        block = rows.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        begin = np.flatnonzero(np.diff(block[order], prepend=-1))
        columns = [rows.column(x).to_numpy()[order].astype(kind) for x, kind in _LISTED]
        packed = [squeeze(_planes(*(v[a:b] for v in columns))) for a, b in zip(begin, [*begin[1:], len(block)])]
        return pa.RecordBatch.from_arrays([pa.array(block[order][begin]), pa.array(packed, pa.binary())], names=["block", "packed"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= _LISTED_ROWS:
            yield lists(pa.Table.from_batches(held))
            held, size = [], 0
    if size:
        yield lists(pa.Table.from_batches(held))


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, by local word number: total, symbol, hash of the word, and whether this block is the word's first."""
    from zstandard import ZstdCompressor, ZstdDecompressor

    squeeze, size = ZstdCompressor(level=1).compress, sum(np.dtype(kind).itemsize for _, kind in _LISTED)
    for batch in batches:
        for place in range(batch.num_rows):
            row = batch.slice(place, 1)
            n = row.column("n_local")[0].as_py()
            totals, symbols = np.zeros(n, np.int64), np.full(n, FREQUENT + BANDS - 1, np.uint16)
            hashes, firsts = np.zeros(n, np.int64), np.zeros(n, bool)
            for value in row.column("packed")[0].as_py() or []:
                raw = ZstdDecompressor().decompress(value)
                local, total, symbol, first, key = _from_planes(raw, [(kind, len(raw) // size) for _, kind in _LISTED])
                totals[local], symbols[local], firsts[local], hashes[local] = total, symbol, first, key
            packed = [pa.array([squeeze(_planes(x))]) for x in (totals, symbols, hashes, firsts)]
            kept = [row.column(x) for x in ("block", "doc_ids", "held", "lengths", "tokens")]
            names = ["block", "doc_ids", "held", "lengths", "tokens", "totals", "symbols", "hashes", "firsts"]
            yield pa.RecordBatch.from_arrays(kept + packed, names=names)


def _taught(row: dict) -> np.ndarray:
    """Local word numbers of the training documents of a block, with -1 before, between and behind them."""
    flat, lengths, held = _unpacked(row["tokens"], np.int32), np.array(row["lengths"], np.int64), np.array(row["held"], bool)
    if held.all():
        return np.zeros(0, np.int64)
    kept = flat[np.repeat(~held, lengths)].astype(np.int64)
    return np.concatenate([[-1], np.insert(kept, np.cumsum(lengths[~held]), -1)])


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring symbols of training documents, before other words than the frequent ones have moved."""
    width = FREQUENT + BANDS
    total = np.zeros(width * width, np.int64)
    for row in _rows(batches):
        s = np.append(_unpacked(row["symbols"], np.uint16), END).astype(np.int64)[_taught(row)]
        total += np.bincount(s[:-1] * width + s[1:], minlength=len(total))
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])


def _classes(label: np.ndarray) -> Callable:
    """Task function: the classes of a block's words after the moves of the round before, their pairs and sizes.

    `label` has the class of every symbol at first.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        squeeze = ZstdCompressor(level=1).compress
        for row in _rows(batches):
            symbols, first = _unpacked(row["symbols"], np.uint16), _unpacked(row["firsts"], bool)
            classes = label[symbols].astype(np.uint8) if row["classes"] is None else _unpacked(row["classes"], np.uint8)
            moved = 0
            for move in row["moves"] or []:
                move = _unpacked(move, np.int64)
                at, new = move >> 8, (move & 255).astype(np.uint8)
                moved += int((first[at] & (classes[at] != new)).sum())
                classes[at] = new
            sizes = np.append(np.bincount(classes[first & _is_other(symbols)], minlength=ALL), moved)
            c = np.append(classes, END)[_taught(row)].astype(np.int32)
            grid = np.bincount(c[:-1] * ALL + c[1:], minlength=ALL * ALL)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]]), pa.array([squeeze(_planes(classes))]), pa.array([grid], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64()))],
                names=["block", "classes", "grid", "sizes"],
            )

    return settle


_SETTLED = "block long, classes binary, grid array<long>, sizes array<long>"


def _is_other(symbols: np.ndarray) -> np.ndarray:
    """Words of the training text that are not frequent."""
    return (symbols >= FREQUENT) & (symbols != FREQUENT + BANDS - 1)


def _around(turn: int | None, parts: int) -> Callable:
    """Task function: the counts of the classes around each word of a block that is not frequent, by part.

    With a `turn`, 0 or 1, half of the words are listed, by their hash. Lists come in `parts`, by the hash too.
    """

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        squeeze = ZstdCompressor(level=1).compress
        for row in _rows(batches):
            symbols, hashes = _unpacked(row["symbols"], np.uint16), _unpacked(row["hashes"], np.int64)
            classes, other, at = _unpacked(row["classes"], np.uint8), _is_other(symbols), _taught(row)
            # the listed words by part and hash; also those that this block has in held-out documents only
            listed = np.flatnonzero(other if turn is None else other & (hashes & 1 == turn))
            part = (hashes[listed] >> 1) % parts
            order = np.lexsort((hashes[listed], part))
            listed, part = listed[order], part[order]
            kind = np.int32 if len(listed) * 2 * ALL < 1 << 31 else np.int64  # short keys sort in half the time
            c = np.append(classes, END)[at].astype(kind)
            rank = np.full(len(symbols) + 1, -1, kind)
            rank[listed] = np.arange(len(listed))
            place = np.flatnonzero(rank[at] >= 0)
            base = rank[at[place]] * (2 * ALL)
            key, n = np.unique(np.concatenate([base + c[place + 1], base + ALL + c[place - 1]]), return_counts=True)
            held = np.bincount(key // (2 * ALL), minlength=len(listed))
            cut, entry = np.searchsorted(part, np.arange(parts + 1)), np.concatenate([[0], np.cumsum(held)])
            packed = []
            for x, y in zip(cut[:-1], cut[1:]):
                e = slice(entry[x], entry[y])
                lists = (hashes[listed[x:y]], listed[x:y].astype(np.int32), held[x:y].astype(np.int32), n[e].astype(np.int32))
                lists += ((key[e] % (2 * ALL)).astype(np.uint8), classes[listed[x:y]])
                packed.append(squeeze(np.array([y - x, e.stop - e.start], np.int64).tobytes() + _planes(*lists)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(parts)), pa.array(np.full(parts, row["block"])), pa.array(packed, pa.binary())],
                names=["part", "block", "packed"],
            )

    return around


def _listed(packed: bytes) -> tuple[np.ndarray, ...]:
    """Hashes, local numbers, numbers of entries, counts, codes and classes of a part, as `_around` packs them."""
    from zstandard import ZstdDecompressor

    raw = ZstdDecompressor().decompress(packed)
    words, entries = np.frombuffer(raw, np.int64, 2)
    kinds = [(np.int64, words), (np.int32, words), (np.int32, words), (np.int32, entries), (np.uint8, entries), (np.uint8, words)]
    return tuple(_from_planes(raw, kinds, 16))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(grid: np.ndarray) -> float:
    """Of class bigrams, less what does not depend on the classes."""
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(axis=1)).sum() - _xlogx(grid.sum(axis=0)).sum())


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their numbers; none of either is negative."""
    bits = int(n.max()).bit_length()
    if int(key.max()).bit_length() + bits < 64:  # both in one number, which sorts faster than places do
        both = np.sort(key << bits | n)
        key, n = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[begin], np.add.reduceat(n, begin)


def best_classes(grid: np.ndarray, old: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Class under which what stands around each word is likeliest, by a grid of class bigrams.

    `old` is the class of each word, whose own bigrams do not count there; entry i says that word[i] was met
    n[i] times before class code[i], or, from ALL on, behind class code[i] - ALL. Many words move at once, so the
    probabilities are those of the round, smoothed as in the model: a gain that a word would bring about by
    itself, as in a class without words, does not count.
    """
    if not len(n):
        return old
    key, n = _summed(word * (2 * ALL) + code, n)
    word, code = np.divmod(key, 2 * ALL)
    begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    held = np.diff(begin, append=len(word))
    times = np.add.reduceat(np.where(code < ALL, n, 0), begin)
    counts, spread = grid.sum(axis=0), _SMOOTHING * ALL
    overall = counts / max(counts.sum(), 1.0)

    def after(cell, c, size):  # a class that follows a word of one with `size` words in the text
        return np.log(np.maximum(cell + spread * overall[c], 1e-300)) - np.log(size + spread)

    def before(cell, size):  # a word of a class that follows; what depends on the class before alone is left out
        return np.log(cell + spread * size / max(counts.sum(), 1.0)) - np.log(size)

    size = np.maximum(counts, 1e-9)
    every = np.arange(ALL)
    table = np.vstack([after(grid.T, every[:, None], size), before(grid, size)])
    own = np.empty(len(n))  # under the word's own class
    for low in range(0, len(n), _ENTRIES):
        e = slice(low, low + _ENTRIES)
        of, c, follows = word[e], code[e] % ALL, code[e] < ALL
        at = old[of]
        rest = np.maximum(size[at] - times[of], 1e-9)
        cell = np.maximum(np.where(follows, grid[at, c], grid[c, at]) - n[e], 0)
        own[e] = n[e] * np.where(follows, after(cell, c, rest), before(cell, rest))
    own = np.add.reduceat(own, begin)
    closed = counts == 0
    closed[[END, ALL - 1]] = True  # the classes of the end token and of unseen words
    new, order = old.copy(), np.argsort(-held, kind="stable")
    for low in range(0, len(order), _CHUNK):
        some = order[low : low + _CHUNK]  # words with most entries first, so that those with an i-th entry stand in front
        value, many = np.zeros((len(some), ALL)), held[some]
        for i in range(many[0]):
            e = begin[some[: np.searchsorted(-many, -i)]] + i
            gain = table[code[e]]
            gain *= n[e, None]
            value[: len(e)] += gain
        every = np.arange(len(some))
        value[every, old[some]] = own[some]
        value[:, closed] = -np.inf
        best = value.argmax(axis=1)
        new[some] = np.where(value[every, best] > value[every, old[some]] + 1e-9, best, old[some])
    return new


def _moves(grid: np.ndarray) -> Callable:
    """Task function over rows (part, block, packed) sorted by part: the new classes of each block's words in the part."""

    def part_moves(blocks: list[int], packed: list[bytes]) -> pa.RecordBatch:
        from zstandard import ZstdCompressor

        squeeze = ZstdCompressor(level=1).compress
        lists = [_listed(x) for x in packed]
        hashes, local, held, n, code, old = (np.concatenate(x) for x in zip(*lists))
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        old = old[first].astype(np.int64)
        new = best_classes(grid, old, np.repeat(word, held), code.astype(np.int64), n.astype(np.int64))
        move = (local.astype(np.int64) << 8) + new[word]
        cut = np.cumsum([len(x[0]) for x in lists])[:-1]
        moves = [squeeze(_planes(x)) for x in np.split(move, cut)]
        return pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(moves, pa.binary())], names=["block", "move"])

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, packed = None, [], []
        for batch in batches:
            for now, block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if now != part and blocks:
                    yield part_moves(blocks, packed)
                    blocks, packed = [], []
                part = now
                blocks.append(block)
                packed.append(value.as_py())
        if blocks:
            yield part_moves(blocks, packed)

    return moves


def _sums(table: DataFrame, *names: str) -> list[np.ndarray]:
    """Sums by place over the rows of columns of equally long lists; one row per place comes to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * len(names)
        for row in _rows(batches):
            totals = [t + np.array(row[x], np.int64) for t, x in zip(totals, names)]
        if not isinstance(totals[0], int):
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.list_(pa.int64())) for t in totals], names=list(names))

    parts = table.select(*names).mapInArrow(add, ", ".join(f"{x} array<long>" for x in names))
    each = parts.select(F.explode(F.array(*[F.struct(F.lit(i).alias("of"), F.col(x).alias("v")) for i, x in enumerate(names)])).alias("c"))
    summed = each.select("c.of", F.posexplode("c.v").alias("place", "n")).groupBy("of", "place").agg(F.sum("n").alias("n")).toPandas()
    found = []
    for i in range(len(names)):
        own = summed[summed.of == i].sort_values("place")
        found.append(own.n.to_numpy(float) if len(own) else np.zeros(1))
    return found


def _by_block(df: DataFrame, table: str) -> DataFrame:
    """Table dealt by block once, in the shared folder, so that the joins of every round leave its rows where they are."""
    spark = df.sparkSession
    dealt = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortBy("block")
    dealt.option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table, format="parquet")
    return spark.table(table)


def classes_of_all(texts: DataFrame, label: np.ndarray, parts: int) -> tuple[DataFrame, np.ndarray]:
    """(block, classes) of the words of every block, and the number of distinct words that are not frequent per class.

    `texts` has the rows of `_known`, `label` the class of every symbol. A round deals its words to `parts`; their lists
    go straight into the shuffle, what is written of a round are classes and moves.
    """
    narrow = texts.select("block", "held", "lengths", "tokens", "symbols", "hashes", "firsts")
    moves, best, done = None, None, []
    for turn in range(ROUNDS + 1):
        if best is None:
            told = narrow.select("*", F.lit(None).cast("binary").alias("classes"), F.lit(None).cast("array<binary>").alias("moves"))
        else:
            told = narrow.join(best[1].select("block", "classes"), "block").join(moves, "block", "left")
        settled = write_stage(told.drop("hashes").mapInArrow(_classes(label), _SETTLED), "classes")
        grid, sizes = _sums(settled, "grid", "sizes")
        if len(grid) < ALL * ALL:  # no rows
            return settled.select("block", "classes"), np.zeros(ALL)
        grid = grid.reshape(ALL, ALL)
        reached = likelihood(grid)
        if best is not None and reached <= best[0]:
            drop_stage(settled)
            break
        best = (reached, settled, sizes)
        drop_stage(*done)
        if turn and sizes[ALL] <= FEW * sizes[:ALL].sum():
            break
        told = narrow.drop("firsts").join(settled.select("block", "classes"), "block")
        rows = told.mapInArrow(_around(turn % 2 if turn else None, parts), "part long, block long, packed binary")
        moves = write_stage(
            rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_moves(grid), "block long, move binary")
            .groupBy("block").agg(F.collect_list("move").alias("moves")),
            "moves",
        )
        done = [best[1], moves]
    return best[1].select("block", "classes"), best[2][:ALL]


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its symbols: places of frequent words or classes, and what does not depend on classes."""
    for row in _rows(batches):
        counts, symbols = _unpacked(row["totals"], np.int64), _unpacked(row["symbols"], np.uint16)
        classes = _unpacked(row["classes"], np.uint8).astype(np.uint16)
        symbols = np.where(symbols < FREQUENT, symbols, FREQUENT + classes).astype(np.uint16)
        flat = _unpacked(row["tokens"], np.int32)
        c, s = counts[flat], symbols[flat]
        ends = np.cumsum(row["lengths"])
        starts = ends - np.array(row["lengths"])
        known_before = np.concatenate([[0], np.cumsum(c > 0)])
        base = np.concatenate([[0.0], np.cumsum(np.log10(c + 1.0))])
        rare = np.where(s >= FREQUENT, np.log10(np.maximum(c - row["discount"], 1e-300)), 0.0)
        rare = np.concatenate([[0.0], np.cumsum(np.where(c > 0, rare, 0.0))])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["held"], pa.bool_()),
                pa.array(row["lengths"], pa.int64()),
                pa.array(known_before[ends] - known_before[starts]),
                pa.array(base[ends] - base[starts]),
                pa.array(rare[ends] - rare[starts]),
                pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends * 2).astype(np.int32)), pa.py_buffer(s)]),
            ],
            names=["doc_id", "held_out", "n_words", "n_known", "base", "rare", "symbols"],
        )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring symbols of training documents, summed per task in one matrix."""
    width, end = FREQUENT + ALL, np.uint16(END).tobytes()
    total = np.zeros(width * width, np.int64)

    def add(texts: list[bytes]) -> None:
        s = np.frombuffer(end + end.join(texts) + end, np.uint16).astype(np.int64)
        total[:] += np.bincount(s[:-1] * width + s[1:], minlength=len(total))

    texts, size = [], 0
    for batch in batches:
        for out, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not out:
                texts.append(value.as_py())
                size += len(texts[-1]) + len(end)
                if size >= _PAIR_BYTES:
                    add(texts)
                    texts, size = [], 0
    if texts:
        add(texts)
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every symbol from their pair counts. The end token and the bands stay alone.

    A word moves to the class with the greatest likelihood of the class bigrams,
    sum N(c, d) log N(c, d) - sum N(c, .) log N(c, .) - sum N(., d) log N(., d).
    """
    size = len(pairs)
    words = np.flatnonzero(pairs[:FREQUENT].sum(axis=1))[1:] if size else np.array([], int)
    words = words[words != END]
    label = np.zeros(size, np.int64)
    label[:FREQUENT] = 1  # words that never occur
    label[words] = 1 + np.arange(len(words)) % classes
    label[END] = 0
    label[FREQUENT:] = 1 + classes + np.arange(size - FREQUENT)
    total = int(label.max()) + 1
    member = np.zeros((size, total))
    member[np.arange(size), label] = 1
    after, before = pairs @ member, pairs.T @ member  # counts of a symbol with the classes after and before it
    grid = member.T @ after

    places = np.arange(1, classes + 1)
    for _ in range(rounds):
        moved = 0
        for word in words:
            old, own = label[word], pairs[word, word]
            out, into = after[word].copy(), before[word].copy()
            out[old] -= own
            into[old] -= own
            # without the word
            grid[old] -= out
            grid[:, old] -= into
            grid[old, old] -= own
            rows, columns = grid.sum(axis=1), grid.sum(axis=0)
            gain_out = (_xlogx(grid[places] + out) - _xlogx(grid[places])).sum(axis=1)
            gain_in = (_xlogx(grid[:, places] + into[:, None]) - _xlogx(grid[:, places])).sum(axis=0)
            corner = grid[places, places]
            both = _xlogx(corner + out[places] + into[places] + own)
            both += _xlogx(corner) - _xlogx(corner + out[places]) - _xlogx(corner + into[places])
            n_out, n_in = out.sum() + own, into.sum() + own
            loss = _xlogx(rows[places] + n_out) - _xlogx(rows[places]) + _xlogx(columns[places] + n_in) - _xlogx(columns[places])
            value = gain_out + gain_in + both - loss
            new = int(places[int(np.argmax(value))])
            if value[new - 1] <= value[old - 1] + 1e-9:
                new = old
            grid[new] += out
            grid[:, new] += into
            grid[new, new] += own
            if new != old:
                moved += 1
                label[word] = new
                after[:, old] -= pairs[:, word]
                after[:, new] += pairs[:, word]
                before[:, old] -= pairs[word]
                before[:, new] += pairs[word]
        if not moved:
            break
    return label


class Model:
    """Log10 probabilities per pair of classes and per symbol."""

    def __init__(self, pairs: np.ndarray, band_words: np.ndarray, discount: float, label: np.ndarray | None = None):
        """`band_words`: number of distinct words per symbol; `discount` is taken from each of their counts.

        `label`: class of every symbol, by exchange if not given. The last symbol stands for unseen words.
        """
        label = exchange(pairs) if label is None else label
        size = int(label.max()) + 1
        member = np.zeros((len(pairs), size))
        member[np.arange(len(pairs)), label] = 1
        grid = member.T @ pairs @ member
        counts, words = pairs.sum(axis=0), band_words
        per_class, taken = member.T @ counts, member.T @ (discount * words)
        share = np.minimum(1.0, np.divide(taken, per_class, out=np.zeros(size), where=per_class > 0))
        overall = (per_class + 1e-9) / (per_class + 1e-9).sum()
        rows = grid.sum(axis=1, keepdims=True)
        after = (grid + _SMOOTHING * size * overall) / (rows + _SMOOTHING * size)
        self.label = label
        self.after = np.log10(after)
        self.unseen = np.log10(np.maximum((after * share).sum(axis=1), 1e-12))  # a word of any class that is not known
        with np.errstate(divide="ignore"):
            # frequent words: their whole emission; other words: less the class total, as the word's count comes on top
            frequent = np.log10(np.maximum(counts - discount * words, 1e-300)) - np.log10(np.maximum(per_class[label], 1e-300))
            self.emit = np.where(np.arange(len(label)) < FREQUENT, frequent, -np.log10(np.maximum(per_class[label], 1e-300)))
        self.emit[-1] = 0.0
        self.following = self.after[:, label] + self.emit  # every symbol after every class
        self.following[:, -1] = self.unseen

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Of texts given by their packed symbols."""
        end = np.uint16(END).tobytes()
        symbols = np.frombuffer(end + end.join(texts) + end, np.uint16)
        each = self.following.take(self.label[symbols[:-1]] * len(self.label) + symbols[1:])
        ends = np.cumsum([len(x) // 2 + 1 for x in texts])
        return np.add.reduceat(each, np.append(0, ends[:-1]))


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs (doc_id, text).

    Learns from rows whose crc32(doc_id as text) mod `FOLDS` is not `HELD_OUT`.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    blocks = write_stage(
        docs.select("doc_id", held_out.alias("held"), "text").mapInArrow(
            _blocks,
            "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, tokens binary,"
            " words array<binary>, counts array<long>",
        ),
        "token_blocks",
    )
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "w")).select(
        "block", "local", F.col("w.words").alias("word"), F.col("w.counts").alias("n")
    )
    of_word = Window.partitionBy("word").orderBy("block")
    everywhere = of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = write_stage(
        listed.withColumn("total", F.sum("n").over(everywhere))
        .withColumn("first", F.row_number().over(of_word) == 1)
        .where("total > 0")
        .select("block", "local", "total", "first", F.xxhash64("word").alias("hash")),
        "words",
    )
    counted = seen.where("first")
    n_train = docs.where(~held_out).count()
    words, distinct, once, twice = (
        int(x or 0)
        for x in counted.agg(
            F.sum("total"), F.count("*"), F.count_if(F.col("total") == 1), F.count_if(F.col("total") == 2)
        ).first()
    )
    train_tokens, vocabulary = words + n_train, distinct + (n_train > 0)
    discount = once / (once + 2.0 * twice) if once else 0.5
    # the most frequent words have symbols 1, 2, ... (0 is the end token), a bounded table
    top = counted.orderBy(F.desc("total"), "hash").limit(FREQUENT - 1).collect()
    spark = docs.sparkSession
    places = spark.createDataFrame([(r.hash, i + 1) for i, r in enumerate(top)], "hash long, place int")
    band = F.lit(FREQUENT) + F.least(F.floor(F.log2("total")), F.lit(BANDS - 2))
    symbols = seen.join(F.broadcast(places), "hash", "left").select(
        "block", "local", "total", "first", "hash", F.coalesce("place", band).cast("int").alias("symbol")
    )
    told = symbols.mapInArrow(_by_blocks, "block long, packed binary").groupBy("block").agg(F.collect_list("packed").alias("packed"))
    text_table = f"texts_{uuid.uuid4().hex}"
    texts = _by_block(
        blocks.select("block", "doc_ids", "held", "lengths", "tokens", F.size("words").alias("n_local"))
        .join(told, "block", "left")
        .mapInArrow(
            _known,
            "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, tokens binary, totals binary,"
            " symbols binary, hashes binary, firsts binary",
        ),
        text_table,
    )

    def matrix(table: DataFrame, count: Callable, width: int) -> np.ndarray:
        pairs = np.zeros((width, width))
        summed = table.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
        pairs[summed.pair // width, summed.pair % width] = summed.n
        return pairs

    known = seen.count()
    drop_stage(blocks, seen)
    first = matrix(texts.select("held", "lengths", "tokens", "symbols"), _first_pairs, FREQUENT + BANDS)
    label = exchange(first)
    classes, sizes = classes_of_all(texts, label, known // _PART_WORDS + 1)
    coded = write_stage(
        texts.select("block", "doc_ids", "held", "lengths", "tokens", "totals", "symbols", F.lit(discount).alias("discount"))
        .join(classes, "block")
        .mapInArrow(
            _coded,
            "doc_id long, held_out boolean, n_words long, n_known long, base double, rare double, symbols binary",
        ),
        "coded",
    )
    drop_stage(texts, classes)
    spark.sql(f"DROP TABLE {text_table}")
    pairs = matrix(coded.select("held_out", "symbols"), _pairs, FREQUENT + ALL)
    kept = np.zeros(FREQUENT)
    kept[1 : len(top) + 1] = 1
    kept[END] = 1 if n_train else 0
    model = Model(pairs, np.concatenate([kept, sizes]), discount, np.concatenate([label[:FREQUENT], np.arange(ALL)]))

    @F.pandas_udf("double")
    def probability(symbols: pd.Series) -> pd.Series:
        texts, found, at = symbols.tolist(), [np.zeros(0)], 0
        while at < len(texts):  # texts of about _PAIR_BYTES together
            stop = at + 1 + int(np.searchsorted(np.cumsum([*map(len, texts[at:])]), _PAIR_BYTES))
            found.append(model.scores(texts[at:stop]))
            at = stop
        return pd.Series(np.concatenate(found))

    ends = float(np.log10(n_train + 1.0))
    whole = float(np.log10(train_tokens + vocabulary + 1.0))
    return coded.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + (1 if n_train else 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + ends - whole * (F.col("n_words") + 1)).alias("base_score"),
        (probability("symbols") + F.col("rare")).alias("score"),
    )
