"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation walks the text once: at each place the longest prefix in the
model's compiled character map is replaced, white space is handled as the model
asks, and every byte of the result remembers the source byte it came from. The
result is merged pair by pair, best score first, left before right; pieces that
the vocabulary lacks become byte pieces. Every piece is projected back to a
span of bytes of the source.

No piece goes on behind a word into the mark of the next space or line break,
so words are merged alone and looked up when they come again; a model with such
pieces is merged whole.

Nulls and edges: a null or empty text gives the begin and end ids alone.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_CACHED_WORDS = 1 << 18
_CHUNK_CHARS = 1 << 21
_SHORT = 64
_SIDE_BY_SIDE = 4096
_NONE = float("-inf")


class CharMap:
    """Compiled character map: a double-array trie over source bytes, and the texts that replace them."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.texts = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.texts = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest entry that data has at this place."""
        if not self.units:
            return None
        node, found = self._offset(self.units[0]), None
        for end in range(at, len(data)):
            node ^= data[end]
            unit = self.units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


class Encoder:
    """Ids and source spans of texts, as the model's own library gives them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        spec, kind = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = (
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            spec.escape_whitespaces,
        )
        self.scores, self.ids, self.bytes = {}, {}, [0] * 256
        self.sizes = np.zeros(len(model.pieces), np.int64)
        self.begin = self.end = self.unknown = 0
        for number, piece in enumerate(model.pieces):
            self.sizes[number] = len(piece.piece.encode("utf-8"))
            if piece.type == kind.BYTE:
                self.bytes[int(piece.piece[3:5], 16)] = number
                self.sizes[number] = 1
            elif piece.type in (kind.NORMAL, kind.USER_DEFINED):
                self.scores[piece.piece], self.ids[piece.piece] = piece.score, number
            elif piece.type == kind.UNKNOWN:
                self.unknown = number
        self.fallback = model.trainer_spec.byte_fallback
        self.decode = SentencePieceProcessor(model_file=path)
        self.begin, self.end = self.decode.bos_id(), self.decode.eos_id()
        across = re.compile(rf"[^{SPACE}]{SPACE}|.\n|\n.", re.S).search
        self.words = None if any(map(across, self.scores)) else re.compile(rf"{SPACE}+[^{SPACE}\n]*|\n+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.cache: dict[str, bytes] = {}
        self._tabulate()

    def _tabulate(self) -> None:
        """Arrays for `learn`: pieces numbered by falling score, and the piece that two of them make."""
        names = sorted(self.scores, key=lambda piece: -self.scores[piece])
        place = {piece: i for i, piece in enumerate(names)}
        scores = np.array([-self.scores[piece] for piece in names])
        self.rank = np.append(np.unique(scores, return_inverse=True)[1], len(names)).astype(np.int32)  # ties share one
        self.none = len(names)
        self.piece_ids = np.array([self.ids[piece] for piece in names], "<u4")
        self.of_char = np.full(0x110000, -1, np.int32)
        made = {}
        for piece, i in place.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
            for cut in range(1, len(piece)):
                left, right = place.get(piece[:cut]), place.get(piece[cut:])
                if left is not None and right is not None:
                    made[left * (self.none + 1) + right] = i
        self.pairs = np.array(sorted(made), np.int64)
        self.made = np.array([made[pair] for pair in self.pairs.tolist()] + [self.none], np.int32)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the piece that two pieces make, `none` if there is none."""
        pair = left.astype(np.int64) * (self.none + 1) + right
        at = np.searchsorted(self.pairs, pair)
        hit = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair
        return np.where(hit, self.made[at], self.none).astype(np.int32)

    def normalize(self, text: str) -> tuple[str, np.ndarray | None]:
        """(normalised text, source byte of each of its bytes and the end); None for the plain case of `spans`."""
        if not self.map.units and not self.squeeze and self.escape:
            if not text:
                return "", None
            return (SPACE if self.dummy else "") + text.replace(" ", SPACE), None
        data, out, source, at = text.encode("utf-8"), bytearray(), [], 0
        mark = SPACE.encode("utf-8") if self.escape else b" "
        chunks = []
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                lead = data[at]
                size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
                found = size, data[at : at + size]
            chunks.append((at, *found))
            at += found[0]
        end = len(data)
        if self.squeeze:
            while chunks and not chunks[0][2].strip(b" "):
                chunks.pop(0)
            while chunks and not chunks[-1][2].strip(b" "):
                end = chunks.pop()[0]
        if not chunks:
            return "", np.array([end])
        if self.dummy:
            out += mark
            source += [chunks[0][0]] * len(mark)
        spaced = self.squeeze
        for place, _, value in chunks:
            for byte in value:
                if byte == 32:
                    if not (self.squeeze and spaced):
                        out += mark
                        source += [place] * len(mark)
                    spaced = True
                else:
                    out.append(byte)
                    source.append(place)
                    spaced = False
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                end = min(end, source[len(out)])
                del source[len(out) :]
        return out.decode("utf-8"), np.array([*source, end])

    def merge(self, text: str) -> bytes:
        """Ids of a normalised text as unsigned 32-bit integers."""
        ids = array("I")
        for piece in self._short(text) if len(text) <= _SHORT else self._long(text):
            number = self.ids.get(piece)
            if number is not None:
                ids.append(number)
            elif self.fallback:
                ids.extend([self.bytes[byte] for byte in piece.encode("utf-8")])
            else:
                ids.append(self.unknown)
        return ids.tobytes()

    def _short(self, text: str) -> list[str]:
        """Pieces of a text: the best pair is looked for again after each merge."""
        get, part = self.scores.get, list(text)
        scores = [get(a + b, _NONE) for a, b in zip(part, part[1:])]
        while scores and (best := max(scores)) != _NONE:
            i = scores.index(best)
            part[i] += part.pop(i + 1)
            scores.pop(i)
            if i:
                scores[i - 1] = get(part[i - 1] + part[i], _NONE)
            if i < len(scores):
                scores[i] = get(part[i] + part[i + 1], _NONE)
        return part

    def _long(self, text: str) -> list[str]:
        """The same with a heap of pairs, for time that grows with the length."""
        part: list = list(text)
        after = [*range(1, len(part)), -1]
        before = [-1, *range(len(part) - 1)]
        scores, heap = self.scores, []

        def offer(left: int, right: int) -> None:
            score = scores.get(part[left] + part[right])
            if score is not None:
                heapq.heappush(heap, (-score, left, right, len(part[left]) + len(part[right])))

        for left in range(len(part) - 1):
            offer(left, left + 1)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if part[left] is None or part[right] is None or after[left] != right:
                continue
            if len(part[left]) + len(part[right]) != size:
                continue
            part[left] += part[right]
            part[right] = None
            after[left] = right = after[right]
            if right >= 0:
                before[right] = left
                offer(left, right)
            if before[left] >= 0:
                offer(before[left], left)
        return [piece for piece in part if piece is not None]

    def learn(self, words: list[str]) -> None:
        """Put the ids of words into the cache. Short words of known characters are merged side by side, as `_short` does."""
        alone = words
        if len(self.pairs):
            alone = [word for word in words if len(word) > _SHORT]
            words = sorted((word for word in words if len(word) <= _SHORT), key=len)
            for at in range(0, len(words), _SIDE_BY_SIDE):
                alone += self._side_by_side(words[at : at + _SIDE_BY_SIDE])
        for word in alone:
            self.cache[word] = self.merge(word)

    def _side_by_side(self, words: list[str]) -> list[str]:
        """Learn words of similar length; the words with characters that are no pieces are returned instead."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        filled = np.arange(sizes.max()) < sizes[:, None]
        parts = np.full(filled.shape, self.none, np.int32)
        parts[filled] = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        known = (parts >= 0).all(axis=1)
        left_out = [words[i] for i in np.flatnonzero(~known)]
        rows = np.flatnonzero(known)
        part, size, done = parts[rows], sizes[rows], {}
        # the last column is never a pair: no piece joins with the number `none`
        made = np.concatenate(
            [self._joined(part[:, :-1], part[:, 1:]), np.full((len(part), 1), self.none, np.int32)], axis=1
        )
        while len(rows):
            at = self.rank[made].argmin(axis=1)
            best = made[np.arange(len(rows)), at]
            ended = np.flatnonzero(best == self.none)
            if len(ended):
                inside = np.arange(part.shape[1]) < size[ended][:, None]
                ids = self.piece_ids[part[ended][inside]].tobytes()
                stops = (4 * np.cumsum(size[ended])).tolist()
                for row, start, stop in zip(rows[ended].tolist(), [0, *stops[:-1]], stops):
                    done[words[row]] = ids[start:stop]
                going = np.flatnonzero(best < self.none)
                rows, part, made, size, at, best = (x[going] for x in (rows, part, made, size, at, best))
                if not len(rows):
                    break
            line = np.arange(len(rows))
            part[line, at] = best
            columns = np.arange(part.shape[1] - 1)
            kept = columns + (columns > at[:, None])  # all but the right part of the merged pair
            part = np.take_along_axis(part, kept, axis=1)
            made = np.take_along_axis(made, kept, axis=1)
            size = size - 1
            after = np.where(at + 1 < size, part[line, np.minimum(at + 1, part.shape[1] - 1)], self.none)
            made[line, at] = self._joined(part[line, at], after)
            inner = np.flatnonzero(at)
            before = at[inner] - 1
            made[inner, before] = self._joined(part[inner, before], part[inner, at[inner]])
        self.cache.update(done)
        return left_out

    def encode_all(self, normals: list[str]) -> list[bytes]:
        """Ids of normalised texts, without begin and end."""
        if self.words is None:
            return [self.merge(normal) for normal in normals]
        cache, found = self.cache, [self.words.findall(normal) for normal in normals]
        if len(cache) > _CACHED_WORDS:
            cache.clear()
        self.learn(list({word for words in found for word in words} - cache.keys()))
        return [b"".join([cache[word] for word in words]) for words in found]

    def encode(self, normal: str) -> bytes:
        """Ids of one normalised text."""
        return self.encode_all([normal])[0]

    def spans(self, text: str, source: np.ndarray | None, ids: np.ndarray) -> np.ndarray:
        """Byte of the source where each piece begins, and where the last one ends."""
        if source is None:
            source = _plain_source(text, self.dummy)
        sizes = self.sizes[ids]
        if not self.fallback and (ids == self.unknown).any():
            raise ValueError("spans of unknown pieces need a model with byte pieces")
        return source[np.concatenate([[0], np.cumsum(sizes)])]


def _plain_source(text: str, dummy: bool) -> np.ndarray:
    """Source bytes when the only changes are the first mark and marks, of three bytes, for spaces."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    places = np.repeat(np.arange(len(data)), np.where(data == 32, 3, 1))
    return np.concatenate([np.zeros(3 if dummy and len(data) else 0, np.int64), places, [len(data)]])


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded, begins) per row of docs (doc_id, text).

    ids: unsigned 32-bit, little-endian, with begin and end id. begins: for every id between them the
    first source byte as a signed 64-bit integer, and the end of the last. decoded: the text of the ids.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(model)
        first, last = (np.array([i], "<u4").tobytes() for i in (encoder.begin, encoder.end))
        for batch in batches:
            texts = batch["text"].tolist()
            chunk = np.cumsum([len(text) for text in texts]) // _CHUNK_CHARS
            for at in (np.flatnonzero(chunk == number) for number in np.unique(chunk)):
                some = [texts[i] for i in at]
                normal = [encoder.normalize(text) for text in some]
                found = encoder.encode_all([value for value, _ in normal])
                decoded, begins = [], []
                for text, (_, source), ids in zip(some, normal, found):
                    numbers = np.frombuffer(ids, "<u4").astype(np.int64)
                    begins.append(encoder.spans(text, source, numbers).astype("<i8").tobytes())
                    decoded.append(encoder.decode.decode([encoder.begin, *numbers.tolist(), encoder.end]))
                ids = [first + value + last for value in found]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[at], "ids": ids, "decoded": decoded, "begins": begins})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        rows, "doc_id long, ids binary, decoded string, begins binary"
    )
